"""Style sheets to rules and declarations, and the extraction jobs on top of them.

Rules come from a brace split: each token is text up to and including a brace. A running sum gives the brace
depth; the at-rules around a rule are the last headers of each smaller depth. All windows share the page_id
hash distribution, so the whole chain needs one exchange of CSS-only rows (no HTML text is shuffled).

`carry` names page columns (the site, say) that travel with the rows, which saves joining them back later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from sitecorpus.functions.columns import hex_norm, js_round, millis, trim_ws, var_fallback
from sitecorpus.functions.dims import COLOR_PROPS, DEFAULT_EASING, DESKTOP_MIN, EASING, EFFECTS, MOBILE_MAX

_FACE = r"(?is)@font-face\s*\{[^}]*\}"


def style_blocks(pages: DataFrame) -> DataFrame:
    bodies = F.regexp_extract_all("html", F.lit(r"(?is)<style[^>]*>(.*?)</style>"), F.lit(1))
    return pages.select("page_id", F.posexplode(bodies).alias("pos", "css"))


def page_css(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """All style blocks of a page as one text without comments: (page_id, css)."""
    bodies = F.regexp_extract_all("html", F.lit(r"(?is)<style[^>]*>(.*?)</style>"), F.lit(1))
    return pages.select(
        "page_id", *carry, F.regexp_replace(F.array_join(bodies, "\n"), r"(?s)/\*.*?\*/", "").alias("css")
    )


def _last_header(c):
    """A rule header is the text after the last `;` (skips @import and stray declarations)."""
    return trim_ws(F.regexp_replace(c, r"(?s)^.*;", ""))


def css_blocks(css: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Brace tokens with depth: (page_id, pos, brace, text, level, next_brace, next_text); level 1 is outermost."""
    tok = css.select(
        "page_id", *carry,
        F.posexplode(
            F.regexp_extract_all(F.regexp_replace("css", _FACE, ""), F.lit(r"[^{}]*[{}]"), F.lit(0))
        ).alias("pos", "tok"),
    ).select("page_id", *carry, "pos", F.right("tok", F.lit(1)).alias("brace"), F.expr("left(tok, length(tok) - 1)").alias("text"))
    w = W.partitionBy("page_id").orderBy("pos")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    run = tok.withColumn("run", F.sum(F.when(F.col("brace") == "{", 1).otherwise(-1)).over(upto))
    low = F.least(F.lit(0), F.min("run").over(upto))
    return run.select(
        "page_id", *carry, "pos", "brace", "text",
        (F.col("run") - low).alias("level"),
        F.lead("brace").over(w).alias("next_brace"),
        F.lead("text").over(w).alias("next_text"),
    )


def css_rules(css: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Leaf rules: (page_id, rule_pos, selector, body, at_rule); at_rule lists enclosing headers, outermost first."""
    opens = css_blocks(css, carry).filter("brace = '{'").withColumn("header", _last_header(F.col("text")))
    leaf = F.col("next_brace") == "}"
    # One row per rule at its own level plus one probe per enclosing level, so that the headers around
    # a rule at any depth come from a single window.
    rows = opens.select(
        "page_id", *carry, "pos", "level", "header", "next_text", leaf.alias("leaf"),
        F.explode(F.when(leaf, F.sequence(F.lit(1), F.col("level"))).otherwise(F.array("level"))).alias("lvl"),
    )
    own = (F.col("lvl") == F.col("level")) & ~F.col("leaf")
    w = W.partitionBy("page_id", "lvl").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("enclosing", F.last(F.when(own, F.col("header")), ignorenulls=True).over(w))
    around = F.sort_array(F.collect_list(F.when(F.col("lvl") < F.col("level"), F.struct("lvl", "enclosing"))))
    return (
        rows.filter("leaf").groupBy("page_id", *carry, "pos")
        .agg(
            F.max(F.when(F.col("lvl") == F.col("level"), F.col("header"))).alias("selector"),
            F.max(F.when(F.col("lvl") == F.col("level"), F.col("next_text"))).alias("body"),
            F.array_join(F.transform(around, lambda s: s["enclosing"]), " / ").alias("at_rule"),
        )
        .select("page_id", *carry, F.col("pos").alias("rule_pos"), "selector", "body", "at_rule")
    )


def _viewport(df: DataFrame) -> DataFrame:
    bp_max = F.regexp_extract("at_rule", r"max-width\s*:\s*(\d+(?:\.\d+)?)px", 1).try_cast("double")
    bp_min = F.regexp_extract("at_rule", r"min-width\s*:\s*(\d+(?:\.\d+)?)px", 1).try_cast("double")
    label = (
        F.when(F.col("bp_max") <= MOBILE_MAX, "mobile")
        .when(F.col("bp_min") >= DESKTOP_MIN, "desktop")
        .when(F.col("bp_min").isNotNull() | F.col("bp_max").isNotNull(), "tablet")
    )
    return df.withColumn("bp_min", bp_min).withColumn("bp_max", bp_max).withColumn("breakpoint", label)


def _pairs(body):
    pattern = r"([\w-]+)\s*:\s*([^;!\n}]+)"
    return F.posexplode(
        F.arrays_zip(
            F.regexp_extract_all(body, F.lit(pattern), F.lit(1)).alias("p"),
            F.regexp_extract_all(body, F.lit(pattern), F.lit(2)).alias("v"),
        )
    ).alias("decl_pos", "kv")


def css_declarations(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """`property: value` pairs of every rule, then of inline style attributes (selector `[inline]`)."""
    rules = _viewport(css_rules(page_css(pages, carry), carry))
    sheet = rules.select(
        "page_id", *carry, F.lit("sheet").alias("source"), "rule_pos", _pairs(F.col("body")), "selector", "at_rule", "bp_min", "bp_max", "breakpoint"
    )
    inline = pages.select(
        "page_id", *carry,
        F.posexplode(F.regexp_extract_all("html", F.lit(r"(?i)\sstyle=[\"']([^\"']+)[\"']"), F.lit(1))).alias("rule_pos", "body"),
    )
    none = F.lit(None)
    inline = inline.select(
        "page_id", *carry, F.lit("inline").alias("source"), "rule_pos", _pairs(F.col("body")),
        F.lit("[inline]").alias("selector"), F.lit("").alias("at_rule"),
        none.cast("double").alias("bp_min"), none.cast("double").alias("bp_max"), none.cast("string").alias("breakpoint"),
    )
    both = sheet.unionByName(inline)
    return both.select(
        "page_id", *carry, "source", "rule_pos", "decl_pos", "selector", F.col("kv.p").alias("property"),
        trim_ws(F.col("kv.v")).alias("value"), "at_rule", "bp_min", "bp_max", "breakpoint",
    )


# Document order of a declaration: sheets before inline styles, then rule and position in the rule.
def _order():
    return F.struct(F.when(F.col("source") == "sheet", 0).otherwise(1), "rule_pos", "decl_pos")


def css_variables(decls: DataFrame) -> DataFrame:
    """Custom properties per page and value; rank 1 is the primary value, higher ranks are alternatives."""
    v = decls.filter(F.col("property").startswith("--"))
    per_value = v.groupBy("page_id", F.col("property").alias("name"), "value").agg(
        F.count("*").alias("occurrences"), F.min(_order()).alias("first_seen")
    )
    w = W.partitionBy("page_id", "name").orderBy("first_seen")
    return per_value.select("page_id", "name", "value", "occurrences", F.row_number().over(w).alias("value_rank"))


def variable_mentions(decls: DataFrame, at) -> DataFrame:
    """Custom properties a declaration declares or falls back from, in one pass: adds (name, value, declared, o).

    `o` orders declarations before fallbacks, then by `at`, then by position in the value.
    """
    pattern = r"var\(\s*(--[\w-]+)\s*,\s*([^)]+?)\s*\)"

    def entry(name, value, declared, ix):
        return F.struct(
            name.alias("name"), value.alias("value"), F.lit(declared).alias("declared"),
            F.struct(F.lit(1 - declared).alias("d"), at.alias("at"), ix.alias("i")).alias("o"),
        )

    uses = F.arrays_zip(
        F.regexp_extract_all("value", F.lit(pattern), F.lit(1)).alias("n"), F.regexp_extract_all("value", F.lit(pattern), F.lit(2)).alias("f")
    )
    own = F.when(F.col("property").startswith("--"), entry(F.col("property"), F.col("value"), 1, F.lit(0)))
    used = F.transform(uses, lambda u, i: entry(u["n"], u["f"], 0, i))
    d = decls.filter(F.col("property").startswith("--") | F.contains("value", F.lit("var(")))
    return d.withColumn("m", F.explode(F.concat(F.array_compact(F.array(own)), used)))


def css_var_fallbacks(decls: DataFrame) -> DataFrame:
    """Names used only as `var(--x, fallback)` and declared nowhere on the page; they count 0 occurrences."""
    m = variable_mentions(decls, _order()).select("page_id", "m.*")
    g = m.groupBy("page_id", "name").agg(F.max("declared").alias("declared"), F.min_by("value", "o").alias("fallback"))
    return g.filter("declared = 0").select("page_id", "name", "fallback", F.lit(0).alias("occurrences"))


def font_faces(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    css = page_css(pages, carry).select(
        "page_id", *carry,
        F.posexplode(F.regexp_extract_all("css", F.lit(r"(?is)@font-face\s*\{([^}]*)\}"), F.lit(1))).alias("pos", "body"),
    )

    def prop(name):
        return trim_ws(F.regexp_extract("body", rf"(?i)(?:^|[;\s]){name}\s*:\s*([^;]+)", 1))

    def or_default(c, d):
        return F.when(c != "", c).otherwise(F.lit(d))

    url = F.regexp_extract("body", r"(?i)url\(\s*[\"']?([^\"')]+)[\"']?\s*\)", 1)
    fmt = F.regexp_extract("body", r"(?i)format\(\s*[\"']?([^\"')]+)[\"']?\s*\)", 1)
    f = css.select(
        "page_id", *carry, "pos",
        F.regexp_replace(prop("font-family"), "[\"']", "").alias("family"),
        or_default(prop("font-weight"), "400").alias("weight"),
        or_default(prop("font-style"), "normal").alias("style"),
        or_default(prop("font-display"), "swap").alias("display"),
        url.alias("url"), fmt.alias("format"),
    ).filter("family != ''")
    return f.withColumn(
        "source",
        F.when(F.contains("url", F.lit("fonts.gstatic.com")), "google-fonts")
        .when(F.contains("url", F.lit("framerusercontent.com")), "framer-cdn")
        .otherwise("custom-upload"),
    )


def text_style_classes(decls: DataFrame, prefix: str = ".text-style-", carry: tuple[str, ...] = ()) -> DataFrame:
    """Named text styles: classes with the prefix that set a font size or family."""
    d = decls.filter((F.col("source") == "sheet") & F.col("selector").startswith(prefix) & (F.col("at_rule") == ""))

    def last(p):
        return F.max_by(F.when(F.col("property") == p, F.col("value")), F.when(F.col("property") == p, _order()))

    g = d.groupBy("page_id", *carry, "selector").agg(
        last("font-size").alias("font_size"), last("font-weight").alias("font_weight"),
        F.regexp_replace(last("font-family"), "[\"']", "").alias("font_family"),
        last("line-height").alias("line_height"), last("letter-spacing").alias("letter_spacing"),
    )
    g = g.filter("font_size is not null or font_family is not null")
    return g.withColumn("name", F.expr(f"substring(selector, {len(prefix) + 1})"))


def media_breakpoints(decls: DataFrame) -> DataFrame:
    """Distinct max-width breakpoints per page, widest first, with their viewport class."""
    bps = decls.filter("bp_max is not null").select("page_id", F.col("bp_max").alias("width_px"), "breakpoint").distinct()
    w = W.partitionBy("page_id").orderBy(F.desc("width_px"), "breakpoint")
    return bps.withColumn("rank", F.row_number().over(w))


_DARK = r"(?i)prefers-color-scheme\s*:\s*dark"


def dark_mode_overrides(decls: DataFrame) -> DataFrame:
    d = decls.filter(
        F.col("at_rule").rlike(_DARK) & (F.col("property").isin(*COLOR_PROPS) | F.col("property").startswith("--"))
    )
    value = F.coalesce(var_fallback(F.col("value")), F.col("value"))
    return d.select("page_id", "rule_pos", "decl_pos", "selector", "property", value.alias("dark_value"), hex_norm(value).alias("dark_hex"))


def dark_light_match(decls: DataFrame) -> DataFrame:
    """Dark overrides against the light palette: by hex (the last light use wins) and by selector + property."""
    light = decls.filter(~F.col("at_rule").rlike(_DARK) & F.col("property").isin(*COLOR_PROPS)).withColumn(
        "light_value", F.coalesce(var_fallback(F.col("value")), F.col("value"))
    ).withColumn("light_hex", hex_norm(F.col("light_value"))).filter("light_hex is not null")
    by_hex = light.groupBy("page_id", F.col("light_hex").alias("dark_hex")).agg(F.max_by("light_value", _order()).alias("hex_match"))
    by_sel = light.filter("at_rule = ''").groupBy("page_id", "selector", "property").agg(
        F.max_by("light_hex", _order()).alias("selector_match")
    )
    dark = dark_mode_overrides(decls)
    is_bg = F.contains("property", F.lit("background"))
    base = F.when(is_bg, "surface").when(F.col("property") == "color", "text").otherwise("color")
    sel = F.regexp_replace(F.regexp_replace(F.regexp_replace("selector", r"[.#\[\]:>\s,]+", "-"), "-+", "-"), "^-|-$", "")
    prop = F.regexp_replace(F.regexp_replace(F.regexp_replace("property", "^--", ""), "(?i)[^a-z0-9-]", "-"), "-+", "-")
    name = F.concat_ws("-", F.lit("dark"), base, F.substring(sel, 1, 24), F.substring(prop, 1, 20))
    return (
        dark.join(by_hex, ["page_id", "dark_hex"], "left")
        .join(by_sel, ["page_id", "selector", "property"], "left")
        .select("page_id", "selector", "property", "dark_value", "dark_hex", "hex_match", "selector_match", name.alias("token_name"))
    )


def keyframes(css: DataFrame) -> DataFrame:
    """`@keyframes` blocks per page and name with the number of steps and their text length."""
    rules = css_rules(css).withColumn("name", F.regexp_extract("at_rule", r"@(?:-webkit-)?keyframes\s+([\w-]+)", 1))
    k = rules.filter("name != ''")
    return k.groupBy("page_id", "name").agg(F.count("*").alias("steps"), F.sum(F.length("body")).alias("body_chars"))


def animated_rules(decls: DataFrame) -> DataFrame:
    d = decls.filter((F.col("source") == "sheet") & F.col("property").rlike("^(animation|transition)"))
    d = d.filter(~F.contains("at_rule", F.lit("keyframes")))
    return d.groupBy("page_id", "rule_pos", "selector").agg(
        F.when(F.max(F.col("property").startswith("animation")), "animation").otherwise("transition").alias("type"),
        F.count("*").alias("declarations"),
    )


def _lookup(table: dict[str, str], key, default):
    out = F.lit(default)
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def transition_interactions(decls: DataFrame) -> DataFrame:
    """Rules with transitions or animations mapped to effect, trigger, duration, delay and easing."""
    d = decls.filter((F.col("source") == "sheet") & ~F.contains("at_rule", F.lit("keyframes")))

    def last(p):
        return F.max_by(F.when(F.col("property") == p, F.col("value")), F.when(F.col("property") == p, _order()))

    g = d.groupBy("page_id", "rule_pos", "selector").agg(
        F.max(F.col("property").rlike("^(animation|transition)")).alias("moves"),
        *[last(p).alias(p.replace("-", "_")) for p in (
            "transition", "transition-property", "transition-duration", "animation-duration", "transition-delay",
            "transition-timing-function", "animation-timing-function")],
    ).filter("moves")
    raw = F.coalesce("transition_property", F.split("transition", " ").getItem(0), F.lit("opacity"))
    prop = trim_ws(F.regexp_replace(raw, r"transform\.", ""))
    dur = millis(F.coalesce("transition_duration", "animation_duration", F.lit("0.3")))
    easing = trim_ws(F.coalesce("transition_timing_function", "animation_timing_function", F.lit("ease")))
    return g.select(
        "page_id", "rule_pos", "selector", prop.alias("animated"),
        _lookup(EFFECTS, prop, EFFECTS["opacity"]).alias("effect"),
        F.when(F.col("selector").rlike("(?i)appear|scroll"), "scroll").otherwise("entrance").alias("trigger"),
        dur.alias("duration_ms"), millis(F.coalesce("transition_delay", F.lit("0"))).alias("delay_ms"),
        _lookup(EASING, easing, DEFAULT_EASING).alias("easing"),
        js_round(dur * 0.7).alias("mobile_duration_ms"),
    )


def appear_animations(pages: DataFrame, attribute: str = "data-framer-appear-id") -> DataFrame:
    """Scroll-in markers per page; the first tag with an id stands for it."""
    pattern = rf"(?i)<([A-Za-z][A-Za-z0-9]*)[^>]*\s{attribute}\s*=\s*[\"']([^\"']+)[\"'][^>]*>"
    rows = pages.select(
        "page_id",
        F.posexplode(F.arrays_zip(
            F.regexp_extract_all("html", F.lit(pattern), F.lit(1)).alias("tag"),
            F.regexp_extract_all("html", F.lit(pattern), F.lit(2)).alias("id"),
        )).alias("pos", "m"),
    )
    return rows.groupBy("page_id", F.col("m.id").alias("appear_id")).agg(
        F.min_by(F.lower("m.tag"), "pos").alias("tag"), F.count("*").alias("uses")
    )


def _cascade(decls: DataFrame) -> DataFrame:
    """Last-wins value per (page, selector, viewport, property)."""
    sheet = decls.filter((F.col("source") == "sheet") & ~F.col("at_rule").rlike(_DARK) & ~F.contains("at_rule", F.lit("keyframes")))
    return sheet.groupBy("page_id", "selector", F.coalesce("breakpoint", F.lit("base")).alias("bp"), "property").agg(
        F.max_by("value", _order()).alias("value")
    )


def responsive_deltas(decls: DataFrame) -> DataFrame:
    """Base declarations (desktop rules on top) and the tablet/mobile values that differ from them.

    One aggregate puts the four viewport values of a property side by side, so no self-join is needed.
    """
    c = _cascade(decls).groupBy("page_id", "selector", "property").agg(
        *[F.max(F.when(F.col("bp") == b, F.col("value"))).alias(b) for b in ("base", "desktop", "tablet", "mobile")]
    )
    eff = F.coalesce("desktop", "base")
    rows = c.select(
        "page_id", "selector", "property",
        F.inline(F.array_compact(F.array(
            F.when(eff.isNotNull(), F.struct(F.lit("base").alias("variant"), eff.alias("value"))),
            *[F.when(F.col(b).isNotNull() & ~F.col(b).eqNullSafe(eff), F.struct(F.lit(b).alias("variant"), F.col(b).alias("value")))
              for b in ("tablet", "mobile")],
        ))),
    )
    return rows


def breakpoint_bounds(decls: DataFrame) -> DataFrame:
    """Viewport boundaries a page's rules imply, with the usual values where it has none."""
    r = decls.filter("breakpoint is not null")
    tablet = F.col("breakpoint") == "tablet"
    g = r.groupBy("page_id").agg(
        F.min(F.when(tablet, F.least("bp_min", "bp_max"))).alias("tablet_min"),
        F.max(F.when(F.col("breakpoint") == "mobile", F.col("bp_max"))).alias("mobile_max"),
        F.min(F.when(F.col("breakpoint") == "desktop", F.col("bp_min"))).alias("desktop_min"),
    )
    return g.select(
        "page_id",
        F.coalesce("tablet_min", F.lit(810.0)).alias("tablet_min"),
        (F.coalesce("desktop_min", F.lit(float(DESKTOP_MIN))) - 1).alias("tablet_max"),
        F.coalesce("mobile_max", F.lit(float(MOBILE_MAX))).alias("mobile_max"),
        F.coalesce("desktop_min", F.lit(float(DESKTOP_MIN))).alias("desktop_min"),
    )


