"""Layout nodes to widgets and typed style properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from sitecorpus.functions.columns import SIDE_PARTS, hex_norm, leading_number, size_number, trim_ws
from sitecorpus.functions.dims import PRO_WIDGETS

# Name word to widget, in matching order.
NAME_WIDGETS = (
    ("heading", "e-heading"), ("paragraph", "e-paragraph"), ("button", "e-button"), ("cta", "e-button"), ("image", "e-image"), ("img", "e-image"),
    ("divider", "e-divider"), ("card", "e-flexbox"), ("stats", "e-flexbox"), ("testimonial", "e-flexbox"), ("hero", "e-flexbox"), ("section", "e-flexbox"),
)
# Tags of a drawing, written in lower case.
DRAWING_TAGS = (
    "svg", "circle", "ellipse", "rect", "path", "polygon", "polyline", "line", "g", "defs", "use", "symbol", "text", "tspan", "mask",
    "clippath", "lineargradient", "radialgradient", "stop", "pattern",
)
# Constants used when neither node, text style nor theme says anything.
FALLBACK = {"e-heading": ("Inter", "32px", "#111111"), "e-paragraph": ("Inter", "16px", "#444444")}


def child_figures(nodes: DataFrame) -> DataFrame:
    """Children per node and how many different names they have (trailing digits ignored)."""
    base = F.regexp_replace(F.lower("name"), r"\d+$", "")
    per_name = nodes.filter("parent_pos is not null").groupBy("page_id", F.col("parent_pos").alias("pos"), F.nullif(base, F.lit("")).alias("b")).agg(F.count("*").alias("n"))
    return per_name.groupBy("page_id", "pos").agg(F.sum("n").alias("children"), F.count("b").alias("child_names"))


def widget_classify(nodes: DataFrame) -> DataFrame:
    """Nodes with a widget type by ordered rules, and the heading tag of texts."""
    # Merged at every size, so that nodes come out in the order of the document whether or not the figures could be sent everywhere.
    n = nodes.join(child_figures(nodes).hint("merge"), ["page_id", "pos"], "left").fillna(0, ["children", "child_names"])
    name = F.lower(F.coalesce("name", F.lit("")))

    def has(w):
        return F.contains(name, F.lit(w))

    # The first dictionary word in the name decides; a word whose guard fails ends the dictionary without a result.
    by_name = F.lit("none")
    for word, widget in reversed(NAME_WIDGETS):
        result = F.lit(widget)
        if widget == "e-button":
            result = F.when(F.col("href").isNull() & ~name.isin("button", "cta"), "none").otherwise(widget)
        if widget == "e-image":
            result = F.when(F.col("src").isNull() & F.col("background_image").isNull(), "none").otherwise(widget)
        by_name = F.when(has(word), result).otherwise(by_name)
    has_text = F.coalesce(F.length("text") > 0, F.lit(False)) | (F.col("text_given") if "text_given" in nodes.columns else F.lit(False))
    text_type = F.when(name.rlike(r"\bh[1-6]\b|heading"), "e-heading").when(name.rlike(r"\bbody|paragraph|text|description|content"), "e-paragraph").otherwise("e-heading")
    grid = ((F.col("children") >= 2) & name.rlike(r"\b(grid|gallery|cards|stats|features|logos|columns)\b")) | ((F.col("children") >= 3) & (F.col("child_names") <= 2))
    widget = (
        F.when((F.col("display") == "grid") | F.col("grid_columns").isNotNull() | F.col("grid_rows").isNotNull(), "e-div-block")
        .when(F.col("component_id").isNotNull() | F.col("component_name").isNotNull(), "e-component")
        .when(by_name != "none", by_name).when(F.col("tag").isin(*DRAWING_TAGS), "e-svg")
        .when(F.col("href").isNotNull() | has("button") | has("cta"), "e-button").when(has_text, text_type)
        .when(F.col("src").isNotNull() | F.col("background_image").isNotNull(), "e-image").when(grid, "e-div-block").otherwise("e-flexbox")
    )
    tag = F.when(name.rlike(r"\bh1\b|heading.?1|title"), "h1")
    for i in range(2, 7):
        tag = tag.when(name.rlike(rf"\bh{i}\b|heading.?{i}"), f"h{i}")
    tag = tag.when(name.rlike("paragraph|body|text"), "p").otherwise("h2")
    return n.withColumn("widget", widget).withColumn("html_tag", tag)


# Fixed values: (widgets, attribute, property, value type); the mapping from layout attributes to style properties. Grids,
# display, position and offsets depend on more than one attribute and follow in the function.
_BOXES = ("e-div-block", "e-flexbox", "e-button")
_TEXTS = ("e-heading", "e-paragraph")
_SIZED = (*_BOXES, "e-image")
PROP_MAP = (
    (("e-flexbox", "e-button"), "stack_direction", "flex-direction", "direction"), (_BOXES, "stack_gap", "gap", "size"),
    (_BOXES, "padding", "padding", "dimensions"), (_BOXES, "max_width", "max-width", "dimension"), (_SIZED, "width", "width", "dimension"),
    (_SIZED, "height", "height", "dimension"), (_BOXES, "background", "background", "color"), (_TEXTS, "font_size", "font-size", "size"),
    (_TEXTS, "font_weight", "font-weight", "string"), (_TEXTS, "line_height", "line-height", "line-height"), (_TEXTS, "letter_spacing", "letter-spacing", "size"),
    (_TEXTS, "font_family", "font-family", "family"), (_TEXTS, "color", "color", "color"), (None, "border_radius", "border-radius", "corners"), (None, "opacity", "opacity", "unitless"),
)
# Parts of a shorthand, by the side of a box that they follow.
SIDES = (("top", "block-start"), ("bottom", "block-end"), ("left", "inline-start"), ("right", "inline-end"))
CORNERS = (("top", "start-start"), ("right", "start-end"), ("bottom", "end-end"), ("left", "end-start"))
_DIMENSION = r"^-?[\d.]+(px|%|em|rem|vw|vh)?$"


def style_prop_rows(classified: DataFrame) -> DataFrame:
    """Typed style properties of classified nodes, one row per property (padding and corners as four).

    A size that is no number with a known unit stays as text. The mapping is fixed, so it is an array of guarded structs
    expanded in place; no join. A value is parsed once, in the row of its property.
    """
    rows = []
    # Each group of widgets is tested once per node.
    groups = {widgets: f"_in_{i}" for i, widgets in enumerate({w: 0 for w, *_ in PROP_MAP if w})}
    c = classified.withColumns({name: F.col("widget").isin(*widgets) for widgets, name in groups.items()})

    def entry(cond, prop, kind, value):
        rows.append(F.when(cond, F.struct(F.lit(prop).alias("prop"), F.lit(kind).alias("kind"), value.alias("raw"))))

    for widgets, attr, prop, kind in PROP_MAP:
        a = F.col(attr)
        cond = a.isNotNull() if widgets is None else a.isNotNull() & F.col(groups[widgets])
        if kind == "direction":
            entry(cond, prop, "string", F.when(a == "vertical", "column").otherwise("row"))
        elif kind in ("dimensions", "corners"):
            for side, css in SIDES if kind == "dimensions" else CORNERS:
                entry(cond, f"{prop}.{css}", side, a)
        else:
            entry(cond, prop, kind, a)
    by_count = (
        F.when(F.col("children") == 2, "1fr 1fr").when(F.col("children") == 3, "1fr 1fr 1fr").when(F.col("children") == 4, "1fr 1fr 1fr 1fr")
        .when(F.col("children") > 4, "repeat(auto-fit, minmax(250px, 1fr))")
    )
    grid = F.coalesce("grid_columns", F.when(F.col("grid_rows").isNull(), by_count))
    display = F.when(F.col("widget").isin("e-flexbox", "e-button"), "flex").when(grid.isNotNull(), "grid").otherwise("block")
    entry(F.col(groups[_BOXES]), "display", "string", display)
    entry((F.col("widget") == "e-div-block") & grid.isNotNull(), "grid-template-columns", "string", grid)
    offsets = [(side, F.col(f"{side}_offset")) for side in ("top", "right", "bottom", "left")]
    placed = F.col("position").isNotNull() & ((F.col("position") != "absolute") | F.coalesce(*[o for _, o in offsets]).isNotNull())
    entry(placed, "position", "string", F.col("position"))
    for side, o in offsets:
        entry(placed & o.isNotNull(), side, "size", o)
    given = c.select("page_id", "pos", "widget", F.inline(F.array_compact(F.array(*rows))))
    return _typed_values(given).select("page_id", "pos", "widget", "prop", "vtype", "num", "unit", "text")


def _typed_values(given: DataFrame) -> DataFrame:
    """Rows with (kind, raw) as (vtype, num, unit, text); rows whose value gives no property go."""
    kind, trimmed = F.col("kind"), F.col("trimmed")
    shorthand = kind.isin(*SIDE_PARTS)
    given = given.withColumn("trimmed", F.when(shorthand | kind.isin("dimension", "line-height"), trim_ws(F.col("raw"))))
    given = given.withColumns({"parts": F.when(shorthand, F.split("trimmed", r"\s+")), "hex": F.when(kind == "color", hex_norm(F.col("raw")))})
    given = given.filter((kind != "color") | F.col("hex").isNotNull()).filter((kind != "dimension") | trimmed.rlike(_DIMENSION))
    part = F.lit(0)
    for side, at in SIDE_PARTS.items():
        part = F.when(kind == side, F.get(F.array(*[F.lit(i) for i in at]), F.size("parts") - 1)).otherwise(part)
    pct, bare = trimmed.rlike(r"^-?[\d.]+%$"), trimmed.rlike(r"^-?[\d.]+$")
    given = given.withColumn("value", F.when(shorthand, F.coalesce(F.get("parts", part - 1), F.lit("0px"))).when(kind == "line-height", trimmed).otherwise(F.col("raw")))
    value = F.col("value")
    number = (
        F.when(kind == "line-height", F.when(pct, leading_number(value) / 100).when(bare, leading_number(value)).otherwise(size_number(value)))
        .when(kind == "unitless", F.coalesce(leading_number(value), F.lit(0.0))).when(~kind.isin("string", "family", "color"), size_number(value))
    )
    given = given.withColumn("num", number)
    num = F.col("num")
    custom = (kind == "unitless") | ((kind == "line-height") & (pct | bare))
    own = F.when(kind == "color", F.col("hex")).when(kind == "family", first_family(value)).otherwise(value)
    return given.withColumns({
        "vtype": F.when(kind == "color", "color").when(num.isNotNull(), "size").otherwise("string"),
        "unit": F.when(custom, "custom").when(num.isNotNull(), F.coalesce(F.nullif(F.regexp_extract("value", r"(px|%|em|rem|vw|vh)$", 1), F.lit("")), F.lit("px"))),
        "text": F.when(num.isNull(), own),
    })


def first_family(c):
    """The first family of a list, without quotes."""
    return F.regexp_replace(trim_ws(F.split(c, ",").getItem(0)), "[\"']", "")


def component_text(nodes: DataFrame, attributes=("name", "caption", "variant", "href", "src", "text")) -> DataFrame:
    """Best text of each component instance: its longest readable attribute, the first of several equal ones."""
    skip = {"name", "variant", "href"}
    i = nodes.filter(F.col("component_id").isNotNull() | F.col("variant").isNotNull())
    entries = F.array(*[F.struct(F.lit(ix).alias("ix"), F.lit(a).alias("attr"), trim_ws(F.col(a)).alias("v")) for ix, a in enumerate(attributes) if a not in skip])
    v = F.col("v")
    ok = (
        v.isNotNull() & (F.length(v) >= 3) & ~v.isin("true", "false") & ~v.rlike("^(http|/|#)") & ~v.rlike(r"^-?\d*\.?\d+$")
        & ~v.rlike("^[a-zA-Z0-9_-]{8,15}$") & ~F.contains(v, F.lit("/>")) & ~F.contains(v, F.lit("</")) & ~v.rlike('[A-Za-z0-9_]+="[^"]*"')
    )
    rows = i.select("page_id", "pos", "component_id", F.inline(entries)).filter(ok)
    best = F.max(F.struct(F.length("v").alias("len"), (-F.col("ix")).alias("neg"), "attr", "v")).alias("b")
    return rows.groupBy("page_id", "pos", "component_id").agg(best).select("page_id", "pos", "component_id", F.col("b.attr").alias("attr"), F.col("b.v").alias("text"))


def pro_feature_detect(nodes: DataFrame) -> DataFrame:
    """Nodes named like a premium widget, with the plain widget that stands in; earlier entries win."""
    norm = F.regexp_replace(F.lower(trim_ws(F.col("name"))), r"[\s_-]+", "-")
    found = F.lit(None)
    for key, target, graceful in reversed(PRO_WIDGETS):
        row = F.struct(F.lit(key).alias("feature"), F.lit(target).cast("string").alias("stand_in"), F.lit(graceful).alias("graceful"))
        found = F.when(F.contains(norm, F.lit(key)), row).otherwise(found)
    return nodes.select("page_id", "pos", "name", found.alias("f")).filter("f is not null").select("page_id", "pos", "name", "f.*")


def top_fallback_style(styles: DataFrame) -> DataFrame:
    """Largest, smallest and middle text style per site by size: (site, role, name, ...).

    Ranks come from counts over distinct styles, a small table per site.
    """
    s = styles.withColumn("px", leading_number(F.col("font_size"))).filter("px > 0")
    w = W.partitionBy("site")
    r = s.withColumn("rn", F.row_number().over(w.orderBy("px", "name"))).withColumn("n", F.count("*").over(w))
    role = F.array_compact(F.array(
        F.when(F.col("rn") == F.col("n"), "heading"), F.when(F.col("rn") == 1, "body"), F.when(F.col("rn") == F.floor(F.col("n") / 2) + 1, "other")))
    return r.select("site", F.explode(role).alias("role"), "name", "font_size", "font_weight", "color", "font_family", "px")


def inline_style_fill(classified: DataFrame, styles: DataFrame) -> DataFrame:
    """Text properties of a node: its own attribute, else its named style, else the site's style for its role, else constants.

    `classified` carries `site`.
    """
    t = classified.filter(F.col("widget").isin(*_TEXTS))
    name = F.lower("name")
    role = (
        F.when((F.col("widget") == "e-heading") | name.rlike("heading|title|h[1-6]|display|hero|header"), "heading")
        .when((F.col("widget") == "e-paragraph") | name.rlike("body|text|para|caption|label|note|small"), "body").otherwise("other")
    )
    t = t.withColumn("role", role)
    own = styles.select("site", F.col("name").alias("text_style"), *[F.col(c).alias(f"s_{c}") for c in ("font_size", "font_weight", "color", "font_family")])
    fall = top_fallback_style(styles).select("site", "role", *[F.col(c).alias(f"r_{c}") for c in ("font_size", "font_weight", "color", "font_family")])
    j = t.join(own, ["site", "text_style"], "left").join(fall, ["site", "role"], "left")
    bare = F.col("font_size").isNull() & F.col("color").isNull() & F.col("s_font_size").isNull()

    def fill(c, own_col, heading, body):
        default = F.when(F.col("widget") == "e-heading", heading).otherwise(body)
        return F.coalesce(own_col, F.col(f"s_{c}"), F.when(bare, F.coalesce(F.col(f"r_{c}"), default)))

    none = F.lit(None).cast("string")
    fam = fill("font_family", none, FALLBACK["e-heading"][0], FALLBACK["e-paragraph"][0])
    return j.select(
        "page_id", "pos", "widget", "role", fill("font_size", F.col("font_size"), FALLBACK["e-heading"][1], FALLBACK["e-paragraph"][1]).alias("font_size"),
        fill("font_weight", none, "600", None).alias("font_weight"),
        hex_norm(fill("color", F.col("color"), FALLBACK["e-heading"][2], FALLBACK["e-paragraph"][2])).alias("color"),
        trim_ws(F.regexp_replace(F.split(fam, ",").getItem(0), "[\"']", "")).alias("font_family"),
        F.when(~bare, F.when(F.col("s_font_size").isNotNull(), "style").otherwise("inline")).when(F.col("r_font_size").isNotNull(), "role").otherwise("constant").alias("source"),
    )


def unique_ids(nodes: DataFrame) -> DataFrame:
    """Ids from names, the n-th repeat of a page suffixed `-n`; `collides` marks suffixed ids that meet a plain one."""
    base = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower("name"), "[^a-z0-9]", "-"), "-+", "-"), "^-|-$", "")
    base = F.coalesce(F.nullif(F.substring(base, 1, 20), F.lit("")), F.lit("node"))
    n = nodes.select("page_id", "pos", base.alias("base"))
    n = n.withColumn("n", F.row_number().over(W.partitionBy("page_id", "base").orderBy("pos")))
    n = n.withColumn("uid", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", "n")))
    return n.withColumn("collides", F.count("*").over(W.partitionBy("page_id", "uid")) > 1)


def gv_substitute(props: DataFrame, kit: DataFrame) -> DataFrame:
    """Literal colours and font families replaced by the kit's variable of the same hex or family: rows with (vtype, text,
    ref_id) rewritten.

    Families are compared without quotes and case. `props` carries `site`; the kit is reduced to one variable per colour and
    per family before the join.
    """
    family = lambda c: trim_ws(F.lower(F.regexp_replace(c, "[\"']", "")))
    colors = kit.filter("hex is not null").select("site", F.lit("color").alias("kind"), F.col("hex").alias("key"), "gv_id", "ord")
    fonts = kit.filter("type = 'font' and value is not null").select("site", F.lit("font").alias("kind"), family(F.col("value")).alias("key"), "gv_id", "ord")
    dim = colors.unionByName(fonts).filter("key <> ''").groupBy("site", "kind", "key").agg(F.max_by("gv_id", "ord").alias("gv_id"))
    is_font = (F.col("prop") == "font-family") & (F.col("vtype") == "string")
    p = props.withColumns({
        "kind": F.when(F.col("vtype") == "color", "color").when(is_font, "font"),
        "key": F.when(F.col("vtype") == "color", F.col("text")).when(is_font, family(F.col("text"))),
    })
    j = p.join(dim, ["site", "kind", "key"], "left")
    hit = F.col("gv_id").isNotNull()
    return j.select(
        "site", "page_id", "pos", "prop", F.when(hit, F.concat(F.lit("global-"), "kind", F.lit("-variable"))).otherwise(F.col("vtype")).alias("vtype"),
        F.when(~hit, F.col("text")).alias("text"), F.col("gv_id").alias("ref_id"), hit.alias("substituted"),
    )
