"""Jobs over element trees: reuse candidates, coverage figures, responsive variants, interactions, schema profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from sitecorpus.functions.columns import js_round
from sitecorpus.operators.tokens import name_contained_in

_NODE = ("page_id", "node_ix")
# Property groups whose equality makes elements share a class.
CLASS_CATEGORIES = {
    "typography": (
        "font-size", "font-family", "font-weight", "font-style",
        "line-height", "letter-spacing", "text-transform",
        "text-decoration", "color",
    ),
    "structure": (
        "padding", "padding-top", "padding-right", "padding-bottom", "padding-left",
        "padding-inline-start", "padding-inline-end", "padding-block-start", "padding-block-end",
        "margin", "margin-top", "margin-right", "margin-bottom", "margin-left",
        "gap", "row-gap", "column-gap",
        "max-width", "min-width", "max-height", "min-height",
        "width", "height",
        "flex-direction", "flex-wrap", "flex-grow", "flex-shrink",
        "justify-content", "align-items", "align-self",
        "display", "position",
    ),
    "background": ("background", "background-color"),
}
# Px above which a property gets tablet and mobile variants (other paddings and margins: 20, a set of sides when
# any is above), and the scale factors.
SCALE_LIMITS = {"font-size": 28, "gap": 24, "width": 300, "height": 200, "min-height": 200, "letter-spacing": 2, "border-radius": 12}
SCALE_SPACING = 20
SCALE_FACTORS = (("tablet", 0.75), ("mobile", 0.6))


def base_props(props: DataFrame) -> DataFrame:
    """Properties of the base variant: no breakpoint or desktop, no state."""
    return props.filter(F.coalesce("breakpoint", F.lit("")).isin("", "desktop") & F.col("state").isNull())


def tree_interactions(props: DataFrame) -> DataFrame:
    """Entrance effects from opacity below 1 and scroll effects from transforms, once per element and kind."""
    b = base_props(props).filter(~F.col("style_id").startswith("gc-") & (F.col("nested") == 0))
    kind = F.when((F.col("prop") == "opacity") & (F.col("num") < 1), "entrance").when(F.col("prop") == "transform", "scroll")
    k = b.withColumn("kind", kind).filter("kind is not null")
    return k.groupBy("page_id", "node_id", "kind").agg(F.min("node_ix").alias("node_ix")).withColumn(
        "trigger", F.when(F.col("kind") == "scroll", "scroll_into_view").otherwise("page_load")
    ).withColumn("duration_ms", F.lit(600))


def variable_drift(values: DataFrame, kit: DataFrame, pages: DataFrame) -> DataFrame:
    """Variables each page names: OK or DRIFT (not in the kit), NO_REFS for pages without any; an empty kit reports OK."""
    refs = values.filter(F.col("text").startswith("e-gv-")).select("page_id", F.col("text").alias("gv_id")).distinct()
    known = kit.select("gv_id", F.lit(True).alias("known")).distinct()
    spark = values.sparkSession
    checked = spark.sql(
        "SELECT r.*, (SELECT count(*) FROM {k}) AS kit_size FROM {r} r", k=known, r=refs.join(known, "gv_id", "left")
    )
    rows = checked.select("page_id", "gv_id", F.when(F.col("known").isNull() & (F.col("kit_size") > 0), "DRIFT").otherwise("OK").alias("result"))
    none = pages.select("page_id").join(refs.select("page_id").distinct(), "page_id", "left_anti")
    return rows.unionByName(none.select("page_id", F.lit(None).cast("string").alias("gv_id"), F.lit("NO_REFS").alias("result")))


def token_hardcode_report(props: DataFrame, samples: int = 5) -> DataFrame:
    """Literal colours, fonts and sizes with counts, sample elements and severity.

    Samples are the first few by position: partial minima per task, never a list of all members.
    """
    prop, text = F.col("prop"), F.col("text")
    literal = ~text.startswith("e-gv-") & ~text.startswith("var(")
    size = prop.isin("font-size", "width", "height", "gap", "padding") & (F.col("vtype") == "size") & (F.col("unit") == "px")
    key = (
        F.when((F.col("vtype") == "color") & literal, F.struct(F.lit("color").alias("kind"), F.substring(text, 1, 7).alias("value")))
        .when((prop == "font-family") & (F.col("vtype") == "string") & literal, F.struct(F.lit("font").alias("kind"), text.alias("value")))
        .when(size & (F.col("num") >= 16) & (F.col("num") % 4 == 0), F.struct(F.lit("size").alias("kind"), F.concat(prop, F.lit(":"), F.col("num").cast("int").cast("string"), F.lit("px")).alias("value")))
    )
    h = props.withColumn("key", key).filter("key is not null").select("page_id", "node_id", "node_ix", "key.*")
    counts = h.groupBy("kind", "value", "page_id", "node_ix", "node_id").agg(F.count("*").alias("n"))
    total = counts.groupBy("kind", "value").agg(F.sum("n").alias("occurrences"))
    w = W.partitionBy("kind", "value").orderBy("page_id", "node_ix")
    top = counts.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= samples)
    names = top.groupBy("kind", "value").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "node_id"))), lambda s: s["node_id"]), ",").alias("samples"))
    sev = F.when(F.col("occurrences") >= 3, "high").when(F.col("occurrences") >= 2, "medium").otherwise("low")
    return total.join(names, ["kind", "value"]).withColumn("severity", sev)


def class_signatures(props: DataFrame) -> DataFrame:
    """Per element and property group, an md5 over its sorted `property=value` pairs (an element's own few properties)."""
    value = F.coalesce("ref_id", "text", F.concat(F.col("num").cast("string"), F.coalesce("unit", F.lit(""))))
    cat = F.lit(None).cast("string")
    for name, members in CLASS_CATEGORIES.items():
        cat = F.when(F.split("prop", r"\.")[0].isin(*members), name).otherwise(cat)  # sides and layers go with their property
    b = base_props(props).withColumn("category", cat).filter(F.col("category").isNotNull() & value.isNotNull())
    return b.groupBy(*_NODE, "category").agg(
        F.array_join(F.sort_array(F.collect_set(F.concat_ws("=", "prop", value))), ";").alias("body")
    ).withColumn("signature", F.md5("body"))


def global_class_candidates(props: DataFrame, min_dups: int = 2) -> DataFrame:
    """Shared classes: signatures met by several elements; backgrounds always become one.

    Counting goes page by page first, so a signature every page repeats arrives as one row per page.
    """
    sig = class_signatures(props)
    per_page = sig.groupBy("category", "signature", "page_id").agg(F.count("*").alias("n"), F.min("body").alias("body"))
    g = per_page.groupBy("category", "signature").agg(F.sum("n").alias("elements"), F.count("*").alias("pages"), F.min("body").alias("body"))
    keep = g.filter((F.col("elements") >= min_dups) | (F.col("category") == "background"))
    px = F.regexp_extract("body", r"font-size=([\d.]+)", 1).try_cast("double")
    label = (
        F.when(F.col("category") == "background", "bg").when(F.col("category") == "structure", "layout")
        .when(px >= 40, "display").when(px >= 24, "heading").when(px >= 16, "body").otherwise("small")
    )
    return keep.select("category", F.substring("signature", 1, 12).alias("signature"), "elements", "pages", label.alias("label"))


def ungrouped_elements(props: DataFrame, min_dups: int = 2) -> DataFrame:
    """Elements with styled groups of which none is shared."""
    sig = class_signatures(props)
    shared = sig.groupBy("category", "signature").agg(F.count("*").alias("n")).filter((F.col("n") >= min_dups) | (F.col("category") == "background"))
    grouped = sig.join(shared.select("category", "signature"), ["category", "signature"], "left_semi").select(*_NODE).distinct()
    return sig.select(*_NODE).distinct().join(grouped, list(_NODE), "left_anti")


def tree_signatures(elements: DataFrame) -> DataFrame:
    """Structural hash of each element's children: `type|kids|style keys` in order, two children at least."""
    keys = F.array_join(F.sort_array(F.coalesce(F.expr("json_object_keys(styles)"), F.array())), ",")
    part = F.concat_ws("|", F.coalesce("widget_type", "el_type"), F.col("n_children").cast("string"), keys)
    kids = elements.filter("parent_ix is not null").groupBy("page_id", "parent_ix").agg(
        F.count("*").alias("n_children"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", part.alias("p")))), lambda s: s["p"]), "::").alias("raw"),
    )
    return kids.filter("n_children >= 2").select("page_id", "parent_ix", "n_children", F.md5("raw").alias("struct_hash"))


def tree_candidates(elements: DataFrame, min_dups: int = 2) -> DataFrame:
    """Repeated sibling structures over the corpus, with their first place."""
    s = tree_signatures(elements)
    per_page = s.groupBy("struct_hash", "n_children", "page_id").agg(F.count("*").alias("n"), F.min("parent_ix").alias("first_ix"))
    g = per_page.groupBy("struct_hash", "n_children").agg(F.sum("n").alias("occurrences"), F.count("*").alias("pages"), F.min(F.struct("page_id", "first_ix")).alias("f"))
    return g.filter(F.col("occurrences") >= min_dups).select(
        "struct_hash", "n_children", "occurrences", "pages", F.col("f.page_id").alias("page_id"), F.col("f.first_ix").alias("first_ix"))


def component_widget_fields(elements: DataFrame, candidates: DataFrame) -> DataFrame:
    """Editable widgets of each repeated structure, from the children of its first place."""
    kind = F.regexp_extract("widget_type", "^e-(heading|paragraph|image|button)$", 1)
    key = F.when(kind == "heading", "title").when(kind == "paragraph", "paragraph").when(kind == "button", "text")
    text = F.coalesce(
        F.expr("try_variant_get(parse_json(settings), '$.title.value.content.value', 'string')"),
        F.expr("try_variant_get(parse_json(settings), '$.paragraph.value.content.value', 'string')"),
        F.expr("try_variant_get(parse_json(settings), '$.text.value.content.value', 'string')"))
    c = candidates.select("struct_hash", "page_id", F.col("first_ix").alias("parent_ix"))
    e = elements.join(c, ["page_id", "parent_ix"]).withColumn("field", kind).filter("field <> ''")
    return e.select("struct_hash", "ord", "field", F.coalesce(key, F.lit("image")).alias("setting"), text.alias("default_value"))


def ancestor_rows(elements: DataFrame) -> DataFrame:
    """(page_id, node_ix, above_ix, steps) of every element and each element it lies in.

    In document order the last element before a node at each smaller depth is its ancestor, so one window per (page, depth)
    finds them all; there are as many rows as elements times depth.
    """
    e = elements.select("page_id", "node_ix", "depth", F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("level"))
    at_level = W.partitionBy("page_id", "level").orderBy("node_ix").rowsBetween(W.unboundedPreceding, 0)
    found = e.withColumn("above_ix", F.last(F.when(F.col("level") == F.col("depth"), F.col("node_ix")), ignorenulls=True).over(at_level))
    return found.filter("level < depth").select("page_id", "node_ix", "above_ix", (F.col("depth") - F.col("level")).alias("steps"))


# Words in an element's id that make it a field, in order; of several the last counts.
FIELD_WORDS = (("text", "title", "heading|title"), ("text", "paragraph", "paragraph|body|description"), ("image", "image", "image|img|icon"), ("link", "link", "button|cta|link"))
# Where each setting holds its text, address or image.
_HELD = {
    "title": ("$.title.value.content.value", "$.text.value.content.value"), "paragraph": ("$.paragraph.value.content.value",), "link": ("$.text.value.content.value",),
    "image": ("$.image.value.src.value.id.value", "$.image.value.src.value.id", "$['image-src'].value.id.value", "$['image-src'].value.id"), "href": ("$.link.value.destination.value",),
}


def component_fields(elements: DataFrame, candidates: DataFrame) -> DataFrame:
    """Editable fields of each repeated structure, from all elements below its first place, with their defaults.

    Words in an element's id make it a field: texts, images (by media id, 0 for none) and links (text and address). Of
    elements with one id the last counts. `name` is the structure's: letters and digits of its first title that has any.
    """
    found = lambda name: F.coalesce(*[F.nullif(F.expr(f"""try_variant_get(s, "{path}", 'string')"""), F.lit("")) for path in _HELD[name]], F.lit("0" if name == "image" else ""))
    c = candidates.select("struct_hash", "page_id", F.col("first_ix").alias("above_ix"))
    below = ancestor_rows(elements).join(c, ["page_id", "above_ix"]).select("struct_hash", "page_id", "node_ix", "steps")
    e = below.join(elements.select("page_id", "node_ix", F.coalesce("node_id", F.lit("")).alias("field_id"), F.expr("parse_json(settings)").alias("s")), ["page_id", "node_ix"])
    kind = prop = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for k, p, words in FIELD_WORDS:
        hit = F.col("field_id").rlike(f"(?i){words}")
        kind, prop, value = F.when(hit, k).otherwise(kind), F.when(hit, p).otherwise(prop), F.when(hit, found(p)).otherwise(value)
    is_title = F.col("field_id").rlike(f"(?i){FIELD_WORDS[0][2]}")
    title = F.when(is_title, F.nullif(F.regexp_replace(found("title"), "[^a-zA-Z0-9]", ""), F.lit("")))
    rows = e.select("struct_hash", "field_id", "node_ix", "steps", title.alias("title"), kind.alias("type"), prop.alias("prop"), value.alias("default_value"), F.when(kind == "link", found("href")).alias("href"))
    names = rows.filter("title IS NOT NULL").groupBy("struct_hash").agg(F.min_by("title", "node_ix").alias("name"))
    last = rows.filter("type IS NOT NULL").groupBy("struct_hash", "field_id").agg(F.max_by(F.struct("type", "prop", "default_value", "href", "steps"), "node_ix").alias("f"))
    return last.join(names, "struct_hash", "left").select("struct_hash", "name", "field_id", "f.*")


def component_usage(elements: DataFrame) -> DataFrame:
    """Component references: occurrences, kinds of parents, first instance."""
    cid = F.expr("try_variant_get(parse_json(settings), '$.component-id.value', 'string')")
    i = elements.withColumn("component_id", cid).filter("component_id is not null").select("component_id", "page_id", F.col("parent_ix").alias("node_ix"), "node_id")
    parents = elements.select("page_id", "node_ix", F.col("el_type").alias("parent_type"))
    j = i.join(parents, ["page_id", "node_ix"], "left")
    return j.groupBy("component_id").agg(
        F.count("*").alias("occurrences"), F.array_join(F.sort_array(F.collect_set("parent_type")), ",").alias("parent_types"),
        F.min(F.struct("page_id", "node_id")).alias("f"),
    ).select("component_id", "occurrences", "parent_types", F.concat_ws("/", "f.page_id", "f.node_id").alias("first_instance"))


PROPERTY = "property-"


def component_overrides(elements: DataFrame, definitions: DataFrame) -> DataFrame:
    """What instances of each component set themselves: one row per component and property, with how many instances set it,
    how many of those differ from the definition (definitions: component_id, settings), the value of the first instance
    and the definition's.

    Settings called property-… count, wrapped or plain. A property that only the definition has is listed with 0
    instances; components without properties have one row without. `resolved` tells whether a definition exists at all,
    `instances` counts the component's instances. Both sides' maps are compared key by key as VARIANT rows.
    """
    spark = elements.sparkSession
    explode = """
        SELECT i.*, substring(k.key, {n}) AS property,
          coalesce(try_variant_get(k.value, '$.value', 'string'), try_variant_get(k.value, '$', 'string')) AS value
        FROM {i} i, LATERAL variant_explode(parse_json(i.settings)) k WHERE startswith(k.key, '{p}')
    """.replace("{n}", str(len(PROPERTY) + 1)).replace("{p}", PROPERTY)
    cid = F.coalesce(F.expr("try_variant_get(parse_json(settings), '$[\"component-id\"].value', 'string')"), F.lit("unknown"))
    instances = elements.filter("widget_type = 'e-component'").select(cid.alias("component_id"), "page_id", "node_ix", "settings")
    totals = instances.groupBy("component_id").agg(F.count("*").alias("instances"), F.min(F.struct("page_id", "node_ix")).alias("first"))
    known = definitions.groupBy("component_id").agg(F.min("settings").alias("settings"))
    own = spark.sql(explode, i=instances).select("component_id", "page_id", "node_ix", "property", "value")
    default = spark.sql(explode, i=known).select("component_id", "property", F.col("value").alias("default_value"), F.lit(True).alias("defined"))
    differs = ~F.col("value").eqNullSafe(F.col("default_value")) | F.col("defined").isNull()
    sets = own.join(default, ["component_id", "property"], "left").groupBy("component_id", "property").agg(
        F.count("*").alias("overriding"), F.count(F.when(differs, 1)).alias("changed"), F.countDistinct("value").alias("values_"),
        F.min(F.struct("page_id", "node_ix", "value")).alias("least"))
    rows = sets.join(default, ["component_id", "property"], "full")
    out = totals.join(rows, "component_id", "left").join(known.select("component_id", F.lit(True).alias("resolved")), "component_id", "left")
    at_first = (F.col("least.page_id") == F.col("first.page_id")) & (F.col("least.node_ix") == F.col("first.node_ix"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select(
        "component_id", F.coalesce("resolved", F.lit(False)).alias("resolved"), "instances", "property", zero("overriding"), zero("changed"), zero("values_"),
        F.when(at_first, F.col("least.value")).alias("first_value"), "default_value")


def schema_profile(elements: DataFrame, variants: DataFrame, props: DataFrame) -> DataFrame:
    """What the corpus contains: element and widget types, breakpoints, states, value types per property."""
    def part(df, section, name, detail):
        return df.groupBy(F.lit(section).alias("section"), F.coalesce(name, F.lit("(none)")).alias("name"), detail.alias("detail")).agg(F.count("*").alias("n"))

    empty = F.lit("")
    return (
        part(elements, "el_type", F.col("el_type"), empty).unionByName(part(elements.filter("widget_type is not null"), "widget", F.col("widget_type"), empty))
        .unionByName(part(variants, "breakpoint", F.col("breakpoint"), empty)).unionByName(part(variants, "state", F.col("state"), empty))
        .unionByName(part(props.filter("nested = 0"), "prop", F.col("prop"), F.coalesce("vtype", F.concat(F.lit("plain-"), "kind"))))
    )


def class_samples(classes: DataFrame, elements: DataFrame, k: int = 5) -> DataFrame:
    """The `k` first class ids of each kind of element, in order: (kind, place, class_id, uses).

    Uses are counted before the rank, and a rank that is compared with a constant is limited in each task before the
    exchange, so no more than `k` rows per kind and task move.
    """
    kinds = elements.select("page_id", "node_ix", F.coalesce("widget_type", "el_type", F.lit("(none)")).alias("kind"))
    n = classes.filter("class_id is not null").join(kinds, ["page_id", "node_ix"]).groupBy("kind", "class_id").agg(F.count("*").alias("uses"))
    place = F.row_number().over(W.partitionBy("kind").orderBy("class_id"))
    return n.withColumn("place", place).filter(F.col("place") <= k).select("kind", "place", "class_id", "uses")


def _band(v, ok, warn, up=True):
    return F.when((v >= ok) if up else (v <= ok), "OK").when((v >= warn) if up else (v <= warn), "WARN").otherwise("FAIL")


def quality_metrics(elements: DataFrame, styles: DataFrame, props: DataFrame) -> DataFrame:
    """Depth, shared-class, variable and grid coverage per page with OK/WARN/FAIL bands."""
    e = elements.groupBy("page_id").agg(
        (F.max("depth") + 1).alias("dom_depth"), F.count("*").alias("total_elements"),
        F.count(F.when(F.col("el_type") == "e-div-block", 1)).alias("grids"), F.count(F.when(F.col("widget_type") == "e-component", 1)).alias("components"))
    c = styles.groupBy("page_id").agg(F.count("*").alias("styles"), F.count(F.when(F.col("style_id").startswith("gc-"), 1)).alias("shared"))
    color = F.col("vtype").isin("color", "global-color-variable") | ((F.col("kind") == "string") & F.col("text").rlike("^(#|rgb)"))
    font = (F.col("prop") == "font-family")
    p = props.filter("nested = 0").groupBy("page_id").agg(
        F.count(F.when(color, 1)).alias("colors"), F.count(F.when(F.col("vtype") == "global-color-variable", 1)).alias("gv_colors"),
        F.count(F.when(font, 1)).alias("fonts"), F.count(F.when(F.col("vtype") == "global-font-variable", 1)).alias("gv_fonts"))
    j = e.join(c, "page_id", "left").join(p, "page_id", "left").fillna(0)

    def pct(a, b):
        return F.when(F.col(b) > 0, js_round(F.col(a) * 100 / F.nullif(F.col(b), F.lit(0)))).otherwise(0)

    j = j.select("page_id", "dom_depth", "total_elements", "components", pct("shared", "styles").alias("class_pct"), pct("gv_colors", "colors").alias("color_pct"),
                 pct("gv_fonts", "fonts").alias("font_pct"), pct("grids", "total_elements").alias("grid_pct"))
    bands = {"depth_status": _band(F.col("dom_depth"), 3, 5, False), "class_status": _band(F.col("class_pct"), 90, 70), "color_status": _band(F.col("color_pct"), 95, 80),
             "font_status": _band(F.col("font_pct"), 95, 80), "grid_status": _band(F.col("grid_pct"), 35, 15), "component_status": _band(F.col("components"), 10, 3)}
    for k, v in bands.items():
        j = j.withColumn(k, v)
    return j.withColumn("failed", sum((F.when(F.col(k) == "FAIL", 1).otherwise(0) for k in bands), F.lit(0)))


def responsive_variants(props: DataFrame) -> DataFrame:
    """Tablet and mobile rows for oversize values of styles that lack the breakpoint: `max(1, round(size * factor))`.

    A grid of two columns or more collapses to one on mobile, one of three or more to half on tablet (`text`).
    """
    root = F.split("prop", r"\.")[0]
    spacing = F.contains(root, F.lit("padding")) | F.contains(root, F.lit("margin"))
    limit = F.when(spacing, SCALE_SPACING)
    for k, v in SCALE_LIMITS.items():
        limit = F.when(F.col("prop") == k, v).otherwise(limit)
    # One property's sides, or one property.
    largest = F.max("num").over(W.partitionBy(*_NODE, "style_id", "variant_ix", "root"))
    sizes = base_props(props).filter((F.col("vtype") == "size") & limit.isNotNull()).withColumn("root", root).withColumn("largest", largest)
    factors = F.array(*[F.struct(F.lit(b).alias("breakpoint"), F.lit(f).alias("factor")) for b, f in SCALE_FACTORS])
    key = [*_NODE, "style_id"]
    scaled = F.greatest(F.lit(1.0), F.floor(F.col("num") * F.col("factor") + 0.5).cast("double"))
    big = sizes.filter(F.col("largest") > limit).select(*key, "prop", "num", "unit", F.inline(factors)).select(
        *key, "breakpoint", "prop", "unit", scaled.alias("num"), F.lit(None).cast("string").alias("text"))
    columns = F.size(F.split(F.trim("text"), r"\s+"))
    grids = base_props(props).filter("prop = 'grid-template-columns' AND vtype = 'string'").select(*key, "prop", columns.alias("n"), F.inline(factors))
    tablet = F.col("breakpoint") == "tablet"
    fewer = F.array_join(F.array_repeat(F.lit("1fr"), F.when(tablet, F.floor(F.col("n") / 2)).otherwise(1).cast("int")), " ")
    grids = grids.filter(F.col("n") >= F.when(tablet, 3).otherwise(2)).select(
        *key, "breakpoint", "prop", F.lit(None).cast("string").alias("unit"), F.lit(None).cast("double").alias("num"), fewer.alias("text"))
    have = props.filter("breakpoint is not null").select(*key, "breakpoint").distinct()
    return big.unionByName(grids).join(have, [*key, "breakpoint"], "left_anti").select(*key, "breakpoint", "prop", "unit", "num", "text")


def scale_factor_lookup(styles: DataFrame, factors: DataFrame) -> DataFrame:
    """Scale factors for styles whose id occurs in a selector; the first selector wins, else the usual factors.

    `factors` (site, selector, base_px, tablet_px, mobile_px, ord), `styles` (site, style_id).
    """
    hay = factors.select("site", F.lower("selector").alias("hay"))
    need = styles.select("site", F.lower("style_id").alias("needle")).distinct()
    hits = name_contained_in(need, hay)
    f = factors.withColumn("hay", F.lower("selector"))
    best = hits.join(f, ["site", "hay"]).groupBy("site", "needle").agg(F.min_by(F.struct("selector", "base_px", "tablet_px", "mobile_px"), "ord").alias("f"))
    j = need.join(best, ["site", "needle"], "left")
    base = F.nullif(F.col("f.base_px"), F.lit(0.0))
    return j.select(
        "site", F.col("needle").alias("style_id"), F.col("f.selector").alias("selector"),
        F.round(F.coalesce(F.col("f.tablet_px") / base, F.lit(0.75)), 4).alias("tablet_factor"), F.round(F.coalesce(F.col("f.mobile_px") / base, F.lit(0.6)), 4).alias("mobile_factor"))


def fingerprint_similarity(prints: DataFrame) -> DataFrame:
    """Cosine similarity (percent) of every fingerprint to the baseline of its group: the group's first fingerprint.

    `prints` (group_id, id, vec). One baseline row per group comes from a partial aggregate; each fingerprint
    meets it once, so a hot group costs its own rows, not its pairs.
    """
    base = prints.groupBy("group_id").agg(F.min_by("vec", "id").alias("base"), F.min("id").alias("base_id"))
    j = prints.join(base, "group_id")

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)

    norm = F.sqrt(dot("vec", "vec")) * F.sqrt(dot("base", "base"))
    sim = F.when(norm > 0, F.round(dot("vec", "base") / F.nullif(norm, F.lit(0.0)) * 100, 3)).otherwise(0.0)
    return j.select("group_id", "id", "base_id", sim.alias("similarity"), (sim >= 85).alias("passes"))
