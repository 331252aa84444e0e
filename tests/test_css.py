"""Style-sheet jobs on literal sheets."""

import pytest
from pyspark.sql import functions as F

from sitecorpus.functions import columns as c
from sitecorpus.operators import css, tokens


def sheet(pages, text, extra=""):
    return pages(f"<style>{text}</style>{extra}")


def test_dark_mode(pages):
    text = ("body{background:#ffffff;color:#111111}"
            "@media (prefers-color-scheme: dark){body{background:#1a1a2e;color:#e0e0e0}.card{background:#16213e}}")
    rows = css.dark_mode_overrides(css.css_declarations(sheet(pages, text))).collect()
    assert ("body", "background", "#1a1a2e") in [(r.selector, r.property, r.dark_hex) for r in rows] and len(rows) == 3
    assert css.dark_mode_overrides(css.css_declarations(sheet(pages, "body{color:#111111}"))).count() == 0


def test_nested_at_rules_and_stray_braces(pages):
    text = "@media (max-width:390px){@supports (display:grid){.g{display:grid}}.h{gap:1px}}} .tail{color:red}"
    rows = {r.selector: r.at_rule for r in css.css_rules(css.page_css(sheet(pages, text))).collect()}
    assert rows == {".g": "@media (max-width:390px) / @supports (display:grid)", ".h": "@media (max-width:390px)", ".tail": ""}


def test_variables_keep_first_value(pages):
    d = css.css_declarations(sheet(pages, ":root{--a:#fff;--a:#000;--a:#fff} p{color:var(--b, #123)} q{color:var(--a, red)}"))
    assert [(r.value, r.occurrences, r.value_rank) for r in css.css_variables(d).orderBy("value_rank").collect()] == [("#fff", 2, 1), ("#000", 1, 2)]
    assert [(r["name"], r.fallback) for r in css.css_var_fallbacks(d).collect()] == [("--b", "#123")]


def test_responsive_deltas(pages):
    text = ".c{gap:8px;color:red}@media (min-width:1200px){.c{color:blue}}@media (max-width:809px){.c{gap:8px;color:red;top:1px}}"
    rows = {(r.property, r.variant): r.value for r in css.responsive_deltas(css.css_declarations(sheet(pages, text))).collect()}
    assert rows == {("gap", "base"): "8px", ("color", "base"): "blue", ("color", "mobile"): "red", ("top", "mobile"): "1px"}


def test_inline_styles(pages):
    d = css.css_declarations(pages('<div style="margin:0 auto;color:#abc">x</div>')).collect()
    assert [(r.selector, r.property, r.value) for r in d] == [("[inline]", "margin", "0 auto"), ("[inline]", "color", "#abc")]


@pytest.mark.parametrize("text,want", [
    ("rgb(14, 42, 59)", "#0e2a3b"), ("#0e2a3b", "#0e2a3b"), ("#F60", "#ff6600"), ("0E2A3B", "#0e2a3b"), ("rgba(255,0,0,.5)", "#ff0000"), ("red", None), ("", None)])
def test_hex(spark, text, want):
    assert spark.createDataFrame([(text,)], "v string").select(c.hex_norm(F.col("v"))).first()[0] == want


@pytest.mark.parametrize("text,num,unit", [("68px", 68.0, "px"), ("100%", 100.0, "%"), ("1.5", 1.5, "px"), ("auto", None, None)])
def test_size(spark, text, num, unit):
    r = spark.createDataFrame([(text,)], "v string").select(c.size_number(F.col("v")), c.size_unit(F.col("v"))).first()
    assert (r[0], r[1]) == (num, unit)


def test_shorthand(spark):
    r = spark.createDataFrame([("40px 20px",)], "v string").select(*[c.shorthand_side(F.col("v"), s) for s in ("top", "right", "bottom", "left")]).first()
    assert tuple(r) == ("40px", "20px", "40px", "20px")


@pytest.mark.parametrize("text,want", [(".3s", 300), ("200ms", 200), ("0.25", 250), ("1s", 1000)])
def test_millis(spark, text, want):
    assert spark.createDataFrame([(text,)], "v string").select(c.millis(F.col("v"))).first()[0] == want


def test_near_colors_equals_brute_force(spark):
    hexes = [f"#{(i * 7919) % 16777216:06x}" for i in range(60)] + [f"#{10 + i:02x}{20:02x}{30 + i % 3:02x}" for i in range(25)]
    df = spark.createDataFrame([("s", h) for h in hexes], "site string, hex string")
    ch = {h: [int(h[i:i + 2], 16) for i in (1, 3, 5)] for h in hexes}
    want = {(a, b) for a in ch for b in ch if a < b and max(abs(x - y) for x, y in zip(ch[a], ch[b])) <= 9}
    assert {(r.hex_a, r.hex_b) for r in tokens.near_colors(df, 9).collect()} == want


def test_contained_names(spark):
    need = spark.createDataFrame([("s", "color"), ("s", "zz"), ("t", "a")], "site string, needle string")
    hay = spark.createDataFrame([("s", "--brand-color-1"), ("s", "--x"), ("t", "--x")], "site string, hay string")
    assert [tuple(r) for r in tokens.name_contained_in(need, hay).collect()] == [("s", "color", "--brand-color-1")]
