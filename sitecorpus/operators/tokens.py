"""Design tokens per site: usage, palettes, scales, catalogues, and the joins against a design system.

Every figure is built as counts per (site, key, value) first and then rolled up, so a value that fills a third
of the corpus arrives at the shuffle as one partial row per task. Design-system tables come from data and may
grow with it: the joins carry no broadcast hint, so Spark broadcasts them only below its size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from sitecorpus.functions.columns import bind, channel, hex_norm, leading_number, shorthand_side, trim_ws, var_fallback
from sitecorpus.operators.css import variable_mentions
from sitecorpus.functions.dims import (
    BREAKPOINT_TOLERANCE,
    COLOR_PROPS,
    EXPECTED_BREAKPOINTS,
    SIZE_CONTEXTS,
    WEIGHT_NAMES,
)


_ORDER = ("page_id", "source_ix", "rule_pos", "decl_pos")


def site_decls(decls: DataFrame) -> DataFrame:
    """Declarations that carry their `site`, with a document-order column `at`."""
    return decls.withColumn("source_ix", F.when(F.col("source") == "sheet", 0).otherwise(1)).withColumn("at", F.struct(*_ORDER))


def hidden_builder_token(name):
    """Builder-internal variables are hidden, except text colours."""
    return name.startswith("--framer-") & ~name.startswith("--framer-text-color")


def token_values(sd: DataFrame) -> DataFrame:
    """Occurrences per (site, variable, value)."""
    v = sd.filter(F.col("property").startswith("--"))
    return v.groupBy("site", F.col("property").alias("name"), "value").agg(F.count("*").alias("n"), F.min("at").alias("at"))


def token_usage(sd: DataFrame) -> DataFrame:
    v = token_values(sd).filter(~hidden_builder_token(F.col("name")))
    return v.groupBy("site", "name").agg(
        F.sum("n").alias("occurrences"), F.count("*").alias("distinct_values"), F.min_by("value", "at").alias("primary_value")
    )


def looks_like_color(v):
    low = F.lower(trim_ws(v))
    return low.startswith("#") | low.startswith("rgb") | low.startswith("hsl")


def token_type(name, value):
    low = F.lower(name)

    def has(*words):
        cond = F.contains(low, F.lit(words[0]))
        for w in words[1:]:
            cond = cond | F.contains(low, F.lit(w))
        return cond

    named_color = has("-color") | (has("-text") & ~has("font"))
    return (
        F.when(named_color & looks_like_color(value), "color")
        .when(has("-font", "family", "typography"), "font")
        .when(has("-size", "-spacing", "-width"), "size")
        .when(looks_like_color(value), "color")
        .when(value.rlike("^[0-9]") & value.rlike("(px|%|em|rem|vw|vh)$"), "size")
        .otherwise("unknown")
    )


def token_label(name):
    """The name as a label; whole, since labels are joined on. A shorter one is for the reader to cut."""
    base = F.regexp_replace(F.regexp_replace(name, "^--", ""), "^token-", "framer-")
    return F.regexp_replace(F.lower(base), "[^a-z0-9_-]", "-")


def token_catalog(sd: DataFrame) -> DataFrame:
    """Typed catalogue of all variables, with those met only as `var()` fallbacks at 0 occurrences.

    Declarations and fallbacks come out of one pass; a declared name keeps its first declaration, which sorts first.
    """
    m = variable_mentions(sd, F.col("at")).select("site", "m.*")
    g = m.groupBy("site", "name").agg(F.min_by("value", "o").alias("value"), F.sum("declared").alias("occurrences"))
    return g.select(
        "site", "name", "value", "occurrences", token_type(F.col("name"), F.col("value")).alias("token_type"),
        token_label(F.col("name")).alias("label"), hex_norm(F.col("value")).alias("hex"),
    )


def color_uses(sd: DataFrame) -> DataFrame:
    p = F.col("property")
    c = sd.filter(p.isin(*COLOR_PROPS) | p.startswith("--framer-text-color") | p.startswith("--extracted-"))
    return c.withColumn("val", var_fallback(trim_ws(F.col("value")))).filter("val is not null")


def color_palette(sd: DataFrame) -> DataFrame:
    """Opaque colours per site and property; `background` counts as `background-color`."""
    c = color_uses(sd).filter(~F.col("val").rlike(r"rgba\s*\(")).withColumn("hex", hex_norm(F.col("val"))).filter("hex is not null")
    prop = F.when(F.col("property") == "background", "background-color").otherwise(F.col("property"))
    return c.groupBy("site", "hex", prop.alias("property")).agg(
        F.count("*").alias("occurrences"), F.min(F.struct("at", "val")).alias("first")
    )


def palette_totals(sd: DataFrame) -> DataFrame:
    g = color_palette(sd).groupBy("site", "hex").agg(
        F.sum("occurrences").alias("occurrences"), F.count("*").alias("properties"), F.min("first").alias("first")
    )
    return g.select("site", "hex", F.col("first.val").alias("raw"), "occurrences", "properties")


def semi_transparent(sd: DataFrame) -> DataFrame:
    c = color_uses(sd).filter(F.col("val").rlike(r"rgba\s*\("))
    g = c.groupBy("site", F.regexp_replace("val", r"\s+", "").alias("rgba")).agg(F.count("*").alias("occurrences"))
    return g.select(
        "site", "rgba", hex_norm(F.col("rgba")).alias("hex_approx"),
        F.regexp_extract("rgba", r",([\d.]+)\)$", 1).try_cast("double").alias("opacity"), "occurrences",
    )


def _plain(sd: DataFrame, props) -> DataFrame:
    d = sd.filter(F.col("property").isin(*props))
    return d.withColumn("v", var_fallback(trim_ws(F.col("value")))).filter("v is not null")


def typography_counts(sd: DataFrame) -> DataFrame:
    """Counts per site, kind and typographic value; families by their first name."""
    d = _plain(sd, ("font-size", "line-height", "letter-spacing", "font-weight", "font-family"))
    fam = trim_ws(F.regexp_replace(F.split("v", ",").getItem(0), "[\"']", ""))
    d = d.withColumn("v", F.when(F.col("property") == "font-family", fam).otherwise(F.col("v")))
    return d.groupBy("site", F.col("property").alias("kind"), F.col("v").alias("value")).agg(F.count("*").alias("occurrences"))


def typography_scale(counts: DataFrame) -> DataFrame:
    """`typography_counts` with context names on the eight largest sizes of each site; stage the counts first.

    Ranking keeps at most eight rows per site (the rank filter is applied before the shuffle as well), and the
    names are joined back, so no site's sizes are sorted in one place.
    """
    px = F.coalesce(leading_number(F.col("value")), F.lit(0.0))
    w = W.partitionBy("site").orderBy(F.desc("px"), "value")
    top = counts.filter("kind = 'font-size'").withColumn("px", px).withColumn("rn", F.row_number().over(w)).filter(
        F.col("rn") <= len(SIZE_CONTEXTS)
    )
    names = F.array(*[F.lit(c) for c in SIZE_CONTEXTS])
    top = top.select("site", "kind", "value", F.element_at(names, F.col("rn")).alias("context"))
    return counts.join(top, ["site", "kind", "value"], "left")


def spacing_scale(sd: DataFrame) -> DataFrame:
    """Counts per spacing value; padding and margin shorthands expanded to four sides."""
    d = _plain(sd, ("padding", "margin", "gap", "row-gap", "column-gap", "border-radius", "max-width"))
    kind = F.when(F.col("property").isin("row-gap", "column-gap"), "gap").otherwise(F.col("property"))
    g = d.groupBy("site", kind.alias("kind"), F.col("v").alias("value")).agg(F.count("*").alias("occurrences"))
    boxed = F.col("kind").isin("padding", "margin")
    return g.select(
        "site", "kind", "value", "occurrences",
        *[F.when(boxed, shorthand_side(F.col("value"), s)).alias(s) for s in ("top", "right", "bottom", "left")],
    )


def layout_usage(sd: DataFrame) -> DataFrame:
    d = _plain(sd, ("display", "flex-direction", "justify-content", "align-items"))
    return d.groupBy("site", F.col("property").alias("kind"), F.col("v").alias("value")).agg(F.count("*").alias("occurrences"))


def style_summary(sd: DataFrame) -> DataFrame:
    """Distinct selectors, colours, families, sizes, spacings and variables per site, and for the corpus (`*`).

    Distinct counting goes through (kind, value) rows aggregated per site and then over the corpus: two
    partial aggregates instead of one expand per distinct column.
    """
    p, v = F.col("property"), F.col("value")
    spacing = p.isin("padding", "margin", "gap", "row-gap", "column-gap")
    kinds = F.array_compact(F.array(
        F.struct(F.lit("selectors").alias("kind"), F.col("selector").alias("value")),
        F.when(p.isin(*COLOR_PROPS), F.struct(F.lit("colors").alias("kind"), hex_norm(F.coalesce(var_fallback(v), v)).alias("value"))),
        F.when(p == "font-family", F.struct(F.lit("families").alias("kind"), v.alias("value"))),
        F.when(p == "font-size", F.struct(F.lit("sizes").alias("kind"), v.alias("value"))),
        F.when(spacing, F.struct(F.lit("spacings").alias("kind"), v.alias("value"))),
        F.when(p.startswith("--"), F.struct(F.lit("variables").alias("kind"), p.alias("value"))),
    ))
    per_site = sd.select("site", F.inline(kinds)).filter("value is not null").distinct()
    corpus = per_site.select("kind", "value").distinct().withColumn("site", F.lit("*"))

    def counts(df):
        return df.groupBy("site").agg(*[
            F.count(F.when(F.col("kind") == k, 1)).alias(k)
            for k in ("selectors", "colors", "families", "sizes", "spacings", "variables")
        ])

    return counts(per_site).unionByName(counts(corpus))


def _weight_number(c):
    n = F.when(c == "normal", 400).when(c == "bold", 700).otherwise(c.try_cast("int"))
    return F.when((n >= 1) & (n <= 1000), n).otherwise(400)


def font_families(sf: DataFrame) -> DataFrame:
    """Faces per site and family: weights in first-seen order, source counts, builder-CDN flag.

    Weights are numbers from 1 to 1000 (the CSS range), so the list per family is bounded.
    """
    per_weight = sf.groupBy("site", "family", _weight_number(F.col("weight")).alias("w")).agg(
        F.min(F.struct("page_id", "pos")).alias("first"), F.count("*").alias("n"),
        F.max(F.col("source") == "framer-cdn").alias("cdn"),
        F.max(F.col("source") == "google-fonts").alias("google"),
        F.max(F.col("source") == "custom-upload").alias("custom"),
    )
    g = per_weight.groupBy("site", "family").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("first", "w"))), lambda s: s["w"].cast("string")), ",").alias("weights"),
        F.sum("n").alias("faces"), F.max("cdn").alias("builder_cdn"), F.max("google").alias("google"), F.max("custom").alias("custom"),
    )
    return g.select("site", "family", "weights", "faces", F.when(F.col("builder_cdn"), "framer-cdn").when(F.col("google"), "google-fonts").otherwise("custom-upload").alias("source"))


# --- design system side -------------------------------------------------------------------------------------


def gv_id(kind: str, name, namespace: str = "site"):
    """Variable id: first 7 hex digits of an md5 over namespace, type and name."""
    return F.concat(F.lit("e-gv-"), F.substring(F.md5(F.concat(F.lit(f"{namespace}:{kind}:"), name)), 1, 7))


def gc_id(name, namespace: str = "site"):
    return F.concat(F.lit("gc-"), F.substring(F.md5(F.concat(F.lit(f"{namespace}:gc:"), name)), 1, 12))


def _last_wins(dim: DataFrame, key: str, value: str, order: str) -> DataFrame:
    return dim.filter(F.col(key).isNotNull()).groupBy("site", key).agg(F.max_by(value, order).alias(value))


def token_resolve(catalog: DataFrame, design_vars: DataFrame, previous: DataFrame) -> DataFrame:
    """Variables to design-variable ids: by hex, else by label, else as mapped before."""
    by_hex = _last_wins(design_vars, "hex", "gv_id", "ord").withColumnRenamed("gv_id", "hex_id")
    by_label = _last_wins(design_vars, "label", "gv_id", "ord").withColumnRenamed("gv_id", "label_id")
    prev = previous.groupBy("site", "name").agg(F.max("gv_id").alias("prev_id"))
    j = catalog.join(by_hex, ["site", "hex"], "left").join(by_label, ["site", "label"], "left").join(prev, ["site", "name"], "left")
    return j.select(
        "site", "name", "token_type", "value", "hex", F.coalesce("hex_id", "label_id", "prev_id").alias("gv_id"),
        F.when(F.col("hex_id").isNotNull(), "hex").when(F.col("label_id").isNotNull(), "label")
        .when(F.col("prev_id").isNotNull(), "existing").otherwise("unmapped").alias("matched_by"),
    )


def catalog_totals(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("site", "token_type").agg(
        F.count("*").alias("tokens"), F.count("gv_id").alias("mapped"), F.count(F.when(F.col("gv_id").isNull(), 1)).alias("unmapped")
    )


def variables_plan(resolved: DataFrame, namespace: str = "site") -> DataFrame:
    """Unmapped colour, font and size tokens as a creation plan with deterministic ids."""
    todo = resolved.filter(F.col("gv_id").isNull() & F.col("token_type").isin("color", "font", "size"))
    planned = F.when(F.col("token_type") == "color", gv_id("color", F.col("name"), namespace)).when(
        F.col("token_type") == "font", gv_id("font", F.col("name"), namespace)
    ).otherwise(gv_id("size", F.col("name"), namespace))
    return todo.select("site", "name", "token_type", "value", planned.alias("planned_id"))


def style_ref_match(catalog: DataFrame, style_paths: DataFrame) -> DataFrame:
    dim = _last_wins(style_paths, "hex", "path", "ord")
    j = catalog.filter("hex is not null").join(dim, ["site", "hex"], "left")
    return j.select("site", "name", "hex", "path", F.when(F.col("path").isNotNull(), "mapped").otherwise("unmapped").alias("status"))


def name_contained_in(needles: DataFrame, hay: DataFrame) -> DataFrame:
    """Pairs (site, needle, hay) where the needle occurs in the hay text, by equality on substrings.

    Each distinct hay text is expanded to its distinct substrings of the lengths that the site's needles have, so the rows
    grow with the text's length, and the containment test is an equi-join that Spark can partition.
    """
    wanted = needles.select("site", "needle").distinct().filter("needle != ''")
    lengths = wanted.select("site", F.length("needle").alias("n")).distinct()
    h = hay.select("site", "hay").distinct().join(lengths, "site").filter(F.length("hay") >= F.col("n"))
    starts = F.sequence(F.lit(1), F.length("hay") - F.col("n") + 1)
    subs = h.select("site", "hay", "n", F.explode(starts).alias("s")).select("site", "hay", F.expr("substring(hay, s, n)").alias("needle")).distinct()
    return wanted.join(subs, ["site", "needle"])


def color_crosscheck(design: DataFrame, catalog: DataFrame) -> DataFrame:
    """Design colours in the exported CSS: MATCH by hex, MISMATCH when only the name is found, else missing.

    `design` needs (site, label, hex); the first CSS variable in name order stands for several.
    """
    css = catalog.withColumn("css_hex", hex_norm(F.col("value")))
    by_hex = css.filter("css_hex is not null").groupBy("site", F.col("css_hex").alias("hex")).agg(F.min("name").alias("hex_prop"))
    d = design.select("site", "label", "hex", F.regexp_replace(F.lower("label"), r"\s+", "").alias("needle"))
    d = d.join(by_hex, ["site", "hex"], "left")
    pairs = name_contained_in(d.filter("hex_prop is null"), catalog.select("site", F.lower("name").alias("hay")))
    props = catalog.select("site", "name", F.lower("name").alias("hay"))
    by_name = pairs.join(props, ["site", "hay"]).groupBy("site", "needle").agg(F.min("name").alias("name_prop"))
    j = d.join(by_name, ["site", "needle"], "left")
    return j.select(
        "site", "label", "hex", F.coalesce("hex_prop", "name_prop").alias("css_property"),
        F.when(F.col("hex_prop").isNotNull(), "MATCH").when(F.col("name_prop").isNotNull(), "MISMATCH").otherwise("MISSING_IN_EXPORT").alias("result"),
    )


def color_unmatched(catalog: DataFrame, design: DataFrame) -> DataFrame:
    known = design.filter("hex is not null").select("site", "hex").distinct()
    return catalog.filter("hex is not null").join(known, ["site", "hex"], "left_anti").select("site", "name", "value", "hex")


def weight_name(c):
    names = F.create_map(*[x for n, name in WEIGHT_NAMES.items() for x in (F.lit(n), F.lit(name))])
    return bind(c, lambda w: F.coalesce(F.try_element_at(names, w), w.cast("string")))


def expected_font_files(fonts: DataFrame) -> DataFrame:
    """File names an exported font may have, best first: (site, family, weight, rank, file)."""
    base = F.regexp_replace("family", r"\s+", "")
    named = F.concat(base, F.lit("-"), weight_name(F.col("weight")))
    options = [F.concat(named, F.lit(e)) for e in (".woff2", ".woff", ".ttf")]
    bare = [F.when(F.col("weight") == 400, F.concat(base, F.lit(e))) for e in (".woff2", ".woff")]
    return fonts.select(
        "site", "family", "weight", F.posexplode(F.array_compact(F.array(*options, *bare))).alias("rank", "file")
    ).withColumn("file", F.lower("file"))


def decode_font(c):
    """`FR;InterDisplay-SemiBold` or `GF;Roboto-700` to (family, weight)."""
    weights = F.create_map(*[x for n, name in WEIGHT_NAMES.items() for x in (F.lit(name.lower()), F.lit(n))])

    def decode(sel):
        last = F.regexp_extract(sel, "-([^-]+)$", 1)
        weight = F.coalesce(F.when(last.rlike(r"^\d{3}$"), last.try_cast("int")), F.try_element_at(weights, F.lower(last)))
        raw = F.when(weight.isNotNull(), F.regexp_replace(F.regexp_replace(sel, "-[^-]+$", ""), "-", "")).otherwise(sel)
        return F.struct(
            F.regexp_replace(raw, "([a-z])([A-Z])", "$1 $2").alias("family"), F.coalesce(weight, F.lit(400)).alias("weight")
        )

    return bind(F.regexp_replace(c, "^(FR|GF);", ""), decode)


def font_crosscheck(fonts: DataFrame, files: DataFrame, faces: DataFrame) -> DataFrame:
    """Design fonts against exported files (best candidate) and @font-face rules (display must be swap)."""
    hits = expected_font_files(fonts).join(files.select("site", F.lower("file").alias("file")).distinct(), ["site", "file"])
    hits = hits.groupBy("site", "family", "weight").agg(F.min_by("file", "rank").alias("found_as"))
    face = faces.groupBy("site", F.lower("family").alias("fam"), _weight_number(F.col("weight")).alias("weight")).agg(
        F.min_by("display", F.struct("page_id", "pos")).alias("css_display")
    )
    f = fonts.select("site", "family", "weight", F.lower("family").alias("fam")).distinct()
    j = f.join(hits, ["site", "family", "weight"], "left").join(face, ["site", "fam", "weight"], "left")
    return j.select(
        "site", "family", "weight", "found_as",
        F.when(F.col("found_as").isNotNull(), "MATCH").otherwise("MISSING_IN_EXPORT").alias("file_result"),
        F.when(F.col("css_display").isNotNull(), "MATCH").otherwise("MISSING_IN_CSS").alias("css_result"),
        F.coalesce(F.col("css_display") != "swap", F.lit(False)).alias("swap_warning"),
    )


def font_unmatched(fonts: DataFrame, files: DataFrame) -> DataFrame:
    known = expected_font_files(fonts).select("site", "file").distinct()
    return files.select("site", F.lower("file").alias("file")).distinct().join(known, ["site", "file"], "left_anti")


def font_resolve(fonts: DataFrame, files: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces and design fonts in one list, with the local file or a download address."""
    face = faces.select("site", "family", _weight_number(F.col("weight")).alias("weight")).distinct().withColumn("in_css", F.lit(True))
    design = fonts.select("site", "family", "weight").distinct().withColumn("in_design", F.lit(True))
    both = face.join(design, ["site", "family", "weight"], "full")
    hits = expected_font_files(both).join(files.select("site", F.lower("file").alias("file")).distinct(), ["site", "file"])
    hits = hits.groupBy("site", "family", "weight").agg(F.min_by("file", "rank").alias("local_file"))
    url = F.concat(
        F.lit("https://fonts.googleapis.com/css2?family="), F.regexp_replace(F.url_encode("family"), "%20", "+"),
        F.lit(":wght@"), F.col("weight").cast("string"), F.lit("&display=swap"),
    )
    j = both.join(hits, ["site", "family", "weight"], "left")
    missing = F.col("local_file").isNull()
    return j.select(
        "site", "family", "weight", F.coalesce("in_css", F.lit(False)).alias("in_css"), F.coalesce("in_design", F.lit(False)).alias("in_design"),
        "local_file", F.when(missing, "MISSING").otherwise("RESOLVED").alias("status"), F.when(missing, url).alias("download_url"),
    )


def breakpoint_crosscheck(bps: DataFrame) -> DataFrame:
    """Design breakpoints against the CSS of each site, within a tolerance. `bps` is (site, width_px).

    The expected breakpoints are two fixed values, so they ride along as an array: no join at all.
    """
    want = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(v).alias("expected_px")) for n, v in EXPECTED_BREAKPOINTS.items()])
    rows = bps.select("site", "width_px", F.inline(want))
    near = F.when(F.abs(F.col("width_px") - F.col("expected_px")) <= BREAKPOINT_TOLERANCE, F.col("width_px"))
    g = rows.groupBy("site", "name", "expected_px").agg(F.max(near).alias("css_px"))
    return g.withColumn("result", F.when(F.col("css_px").isNotNull(), "MATCH").otherwise("MISSING_IN_EXPORT"))


def source_merge(existing: DataFrame, live: DataFrame, keys=("site", "name")) -> DataFrame:
    """Append the live rows whose key is new; what exists stays untouched."""
    fresh = live.join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return existing.withColumn("origin", F.lit("existing")).unionByName(fresh.withColumn("origin", F.lit("live")))


# Debugging colours that never become variables.
SKIP_HEXES = ("#550000", "#660000", "#770000")


def design_system_build(palette: DataFrame, faces: DataFrame, text_styles: DataFrame, namespace: str = "site") -> DataFrame:
    """Variables and classes of each site with deterministic ids."""
    palette = palette.filter(~F.col("hex").isin(*SKIP_HEXES))
    colors = palette.select("site", F.lit("color").alias("kind"), F.col("hex").alias("name"), gv_id("color", F.col("hex"), namespace).alias("id"), F.col("hex").alias("value"))
    fonts = faces.select("site", F.col("family").alias("name")).distinct().select(
        "site", F.lit("font").alias("kind"), "name", gv_id("font", F.col("name"), namespace).alias("id"), F.col("name").alias("value")
    )
    classes = text_styles.select("site", F.lit("class").alias("kind"), "name", gc_id(F.col("name"), namespace).alias("id"), F.col("font_size").alias("value"))
    bg_name = F.concat(F.lit("bg-"), F.col("hex"))
    bgs = palette.select("site", F.lit("background-class").alias("kind"), bg_name.alias("name"), gc_id(bg_name, namespace).alias("id"), F.col("hex").alias("value"))
    return colors.unionByName(fonts).unionByName(classes).unionByName(bgs)


def id_collisions(system: DataFrame) -> DataFrame:
    """Ids that stand for more than one name."""
    per_name = system.select("id", "kind", "name").distinct()
    return per_name.groupBy("id").agg(F.count("*").alias("names"), F.min("name").alias("first_name")).filter("names > 1")


def near_colors(palette: DataFrame, k: int = 12) -> DataFrame:
    """Pairs of distinct colours of a site whose channels all differ by at most k.

    Colours fall into cubes of side k; a pair can only meet in the same or a neighbouring cube. Colours are
    distinct integers, so a cube never holds more than k**3 of them, however hot a site is.
    """
    c = palette.select("site", "hex").distinct()
    chans = [channel(F.col("hex"), i) for i in range(3)]
    c = c.select("site", "hex", *[ch.alias(n) for ch, n in zip(chans, "rgb")])
    cell = [F.floor(F.col(n) / k).alias(f"c{n}") for n in "rgb"]
    own = c.select("site", F.col("hex").alias("hex_a"), *[F.col(n).alias(f"{n}1") for n in "rgb"], *cell)
    around = c
    for n in "rgb":
        around = around.withColumn(f"d{n}", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    around = around.select(
        "site", F.col("hex").alias("hex_b"), *[F.col(n).alias(f"{n}2") for n in "rgb"],
        *[(F.floor(F.col(n) / k) + F.col(f"d{n}")).alias(f"c{n}") for n in "rgb"],
    )
    dist = F.greatest(*[F.abs(F.col(f"{n}1") - F.col(f"{n}2")) for n in "rgb"])
    return (
        own.join(around, ["site", "cr", "cg", "cb"]).filter("hex_a < hex_b").withColumn("distance", dist)
        .filter(F.col("distance") <= k).select("site", "hex_a", "hex_b", "distance")
    )


def repeating_selectors(sd: DataFrame, min_dups: int = 2) -> DataFrame:
    """Selectors that differ only in trailing digits or hyphens."""
    base = F.regexp_replace("selector", r"[-\d]+$", "")
    per_sel = sd.filter("source = 'sheet'").groupBy("site", "selector").agg(F.count("*").alias("n"))
    g = per_sel.groupBy("site", base.alias("base_name")).agg(F.count("*").alias("selectors"), F.sum("n").alias("declarations"))
    return g.filter((F.col("selectors") >= min_dups) & (F.col("base_name") != ""))


def reconcile(expected: DataFrame, actual: DataFrame, keys, metric: str = "n") -> DataFrame:
    """Expected against computed figures: equal, different, missing or unexpected."""
    e = expected.select(*keys, F.col(metric).alias("expected"))
    a = actual.select(*keys, F.col(metric).alias("actual"))
    j = e.join(a, list(keys), "full")
    state = (
        F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "unexpected")
        .when(F.col("actual") == F.col("expected"), "equal").otherwise("different")
    )
    return j.withColumn("state", state)
