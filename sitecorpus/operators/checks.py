"""Rule checks over element trees: every rule is a query whose rows are violations, and scorecards count them.

Checks over one property at a time share a single scan of the style rows (`style_rule_hits`); checks that look
for something absent are anti-joins or presence aggregates per style. No rule looks at more than one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitecorpus.functions.columns import hex_norm, js_round

# Guard name and severity, in report order.
GUARDS = (
    ("g01", "TOKEN_EXISTENCE", "error"), ("g02", "COLOR_CONSISTENCY", "error"), ("g03", "FONT_RESOLUTION", "error"),
    ("g04", "BREAKPOINT_CONSISTENCY", "warning"), ("g05", "STYLE_CLASSES_BINDING", "error"), ("g06", "NO_HARDCODED_HEX", "error"),
    ("g07", "NO_PLAIN_STRINGS", "error"), ("g08", "FONT_NAMES_QUOTED", "warning"), ("g09", "BASE_VARIANT_NULL", "error"),
    ("g10", "TABLET_VARIANTS", "warning"), ("g11", "BACKGROUND_COLOR_GC", "error"), ("g12", "IMAGE_SRC_FORMAT", "error"),
    ("g13", "LINE_HEIGHT_UNIT", "error"), ("g14", "STYLE_ID_HYPHEN", "error"), ("g15", "UNIQUE_ELEMENT_IDS", "error"),
    ("g16", "ELTYPE_VALIDITY", "error"),
)
MIN_SCORE = 85
# Element types a tree may contain, widget types, settings a widget needs, expected property types.
EL_TYPES = ("widget", "e-flexbox", "e-div-block", "section", "column")
WIDGETS = ("e-heading", "e-paragraph", "e-button", "e-image", "e-svg", "e-divider", "e-component")
CONTAINERS = ("e-flexbox", "e-div-block")
REQUIRED_SETTINGS = (("e-heading", "title"), ("e-paragraph", "paragraph"), ("e-button", "text"), ("e-image", "image"))
PROP_TYPES = {
    "font-size": ("size",), "line-height": ("size", "string"), "gap": ("size",), "width": ("size",), "opacity": ("size",),
    "padding": ("dimensions", "size"), "margin": ("dimensions", "size"), "color": ("color", "global-color-variable"),
    "background": ("background",), "font-family": ("string", "global-font-variable"), "flex-direction": ("string",), "flex-wrap": ("string",),
    "letter-spacing": ("size",), "font-weight": ("string",), "height": ("size",), "min-width": ("size",), "min-height": ("size",), "max-width": ("size",),
    "border-radius": ("border-radius", "size"), "display": ("string",), "position": ("string",), "top": ("size",), "right": ("size",), "bottom": ("size",), "left": ("size",),
    "inset-block-start": ("size",), "scroll-margin-top": ("size",), "align-items": ("string",), "align-self": ("string",), "justify-content": ("string",),
    "text-align": ("string",), "grid-template-columns": ("string",), "z-index": ("number",),
    "title": ("html-v3",), "paragraph": ("html-v3",), "text": ("html-v3",), "image": ("image",), "image-src": ("image-src",), "svg-icon": ("html-v3",), "link": ("link",),
    "classes": ("classes",), "tag": ("string",), "component-id": ("string",), "field-label": ("html-v3",), "field-placeholder": ("string",),
}
# What the value of each declared type is. A text names the kind of the value itself; a table names the kinds that
# each field may have, "!" marks fields that must be there; "items" stands for the entries of a list.
_VARIABLES = "global-color-variable", "global-font-variable", "global-size-variable"
SHAPES = {
    "string": "string", "number": "number", "boolean": "boolean", "url": "string", "image-attachment-id": "number", "color": "string",
    **dict.fromkeys(_VARIABLES, "string"),
    "size": {"size!": ("number",), "unit!": ("string",)},
    "dimensions": dict.fromkeys(("block-start", "block-end", "inline-start", "inline-end"), ("size", "global-size-variable")),
    "border-radius": dict.fromkeys(("start-start", "start-end", "end-end", "end-start"), ("size", "global-size-variable")),
    "background": {"color": ("color", "global-color-variable")},
    "image": {"src!": ("image-src",), "size": ("string",)},
    "image-src": {"id": ("number", "image-attachment-id", "string", "null"), "url": ("url", "null")},
    "classes": {"items": ("string",)},
    "html-v3": {"content!": ("string",), "children": ("array",)},
    "link": {"href!": ("string", "url"), "isTargetBlank": ("boolean",), "tag": ("string",)},
}
# Units of a size, and the texts of colours and variable ids.
UNITS = ("px", "%", "em", "rem", "vw", "vh", "custom")
FORMATS = {"color": "^#([0-9A-Fa-f]{3,4}|[0-9A-Fa-f]{6}|[0-9A-Fa-f]{8})$", **dict.fromkeys(_VARIABLES, "^e-gv-[0-9A-Za-z]+$")}
# Visual properties that belong in styles and may not stand in a container's settings.
VISUAL_SETTINGS = (
    "color", "font-size", "font-family", "font-weight", "line-height", "letter-spacing",
    "padding", "margin", "gap", "width", "height", "min-height", "max-width",
    "background-color", "background", "background-overlay",
    "flex-direction", "align-items", "justify-content", "flex-wrap",
    "border-radius", "border-width", "border-color", "border-style",
    "box-shadow", "opacity", "position", "overflow",
)
# Sizes in px above which a style needs a mobile variant.
OVERSIZE = {"font-size": 28, "min-height": 200, "width": 100}
OVERSIZE_PADDING = 20

_KEY = ("page_id", "node_ix")


def _rows(df: DataFrame, guard: str, detail, severity: str | None = None) -> DataFrame:
    sev = severity or next(s for g, _, s in GUARDS if g == guard)
    return df.select(*_KEY, F.lit(guard).alias("check_id"), F.lit(sev).alias("severity"), detail.cast("string").alias("detail"))


def style_rule_hits(props: DataFrame) -> DataFrame:
    """g08, g11, g13 in one pass over the style rows."""
    prop, kind, vtype, text, num = (F.col(c) for c in ("prop", "kind", "vtype", "text", "num"))
    lh = prop == "line-height"
    rules = [
        ("g08", (prop == "font-family") & (vtype == "string") & F.contains(text, F.lit(" ")) & ~text.rlike("^[\"']"), text),
        ("g11", (prop == "background.color") & (vtype == "color"), text),
        ("g13", lh & (((kind == "number")) | ((kind == "string") & text.rlike(r"^\d+(\.\d+)?px$")) | ((vtype == "size") & (F.col("unit") == "px") & (num < 5))),
         F.coalesce(text, num.cast("string"))),
    ]
    sev = {g: s for g, _, s in GUARDS}
    hits = F.array_compact(F.array(*[
        F.when(c, F.struct(F.lit(g).alias("check_id"), F.lit(sev[g]).alias("severity"), d.alias("detail"))) for g, c, d in rules
    ]))
    return props.select(*_KEY, F.inline(hits))


def value_rule_hits(values: DataFrame) -> DataFrame:
    """g06, g07, g12 in one pass over all values: bare hex colours in styles, variable ids that no variable type wraps, and
    image sources that do not name exactly one of id and url or hold an explicit null url."""
    text, parent = F.col("text"), F.coalesce("parent_type", F.lit(""))
    issue = (
        F.when(F.col("null_url"), "null-url").when(F.col("has_id") & F.col("has_url"), "both").when(~F.col("has_id") & ~F.col("has_url"), "neither")
    )
    rules = [
        ("g06", (F.col("part") == "styles") & text.rlike(r"^\s*#[0-9a-fA-F]{3,6}\s*$") & (parent != "color"), text),
        ("g07", text.startswith("e-gv-") & ~F.contains(parent, F.lit("variable")), text),
        ("g12", issue.isNotNull(), issue),
    ]
    sev = {g: s for g, _, s in GUARDS}
    hits = F.array_compact(F.array(*[
        F.when(c, F.struct(F.lit(g).alias("check_id"), F.lit(sev[g]).alias("severity"), d.alias("detail"))) for g, c, d in rules
    ]))
    return values.select(*_KEY, F.inline(hits))


def _gv_ids(values: DataFrame) -> DataFrame:
    return values.filter(F.col("text").startswith("e-gv-")).withColumn("gv_id", F.col("text"))


def g01_token_existence(values: DataFrame, kit: DataFrame) -> DataFrame:
    """Variables that styles or settings name, at any depth, and the kit does not have."""
    refs = _gv_ids(values).select(*_KEY, "gv_id").distinct()
    return _rows(refs.join(kit.select("gv_id").distinct(), "gv_id", "left_anti"), "g01", F.col("gv_id"))


def g02_color_refs(values: DataFrame, kit: DataFrame) -> DataFrame:
    """Colour references in styles that are no colour of the kit, or one without a valid hex value. `kit`: gv_id, kind, hex."""
    refs = _gv_ids(values).filter("part = 'styles' AND parent_type = 'global-color-variable'").select(*_KEY, "path", "gv_id")
    good = kit.filter("kind = 'color'").groupBy("gv_id").agg(F.max(F.col("hex").isNull() | hex_norm(F.col("hex")).isNotNull()).alias("good"))
    bad = refs.join(good, "gv_id", "left").filter("NOT coalesce(good, false)")
    return _rows(bad, "g02", F.concat_ws(":", "path", "gv_id"))


def g03_font_refs(values: DataFrame, kit: DataFrame) -> DataFrame:
    refs = _gv_ids(values).filter("part = 'styles' AND parent_type = 'global-font-variable'").select(*_KEY, "path", "gv_id")
    return _rows(refs.join(kit.select("gv_id").distinct(), "gv_id", "left_anti"), "g03", F.concat_ws(":", "path", "gv_id"))


def g04_breakpoints(variants: DataFrame) -> DataFrame:
    bad = variants.filter(F.col("breakpoint").isNotNull() & ~F.col("breakpoint").isin("tablet", "mobile", "desktop"))
    return _rows(bad, "g04", F.col("breakpoint"))


def g05_binding(styles: DataFrame, classes: DataFrame) -> DataFrame:
    bound = classes.select(*_KEY, F.col("class_id").alias("style_id")).distinct()
    return _rows(styles.select(*_KEY, "style_id").join(bound, [*_KEY, "style_id"], "left_anti"), "g05", F.col("style_id"))


def binding_report(styles: DataFrame, classes: DataFrame) -> DataFrame:
    """Local styles without a class reference, and class references without a style; shared `gc-` classes ignored."""
    unbound = g05_binding(styles.filter(~F.col("style_id").startswith("gc-")), classes).withColumn("check_id", F.lit("c2"))
    local = classes.filter(~F.col("class_id").startswith("gc-")).select(*_KEY, F.col("class_id").alias("style_id")).distinct()
    has_styles = styles.filter(~F.col("style_id").startswith("gc-")).select(*_KEY).distinct()
    orphans = local.join(has_styles, list(_KEY), "left_semi").join(styles.select(*_KEY, "style_id"), [*_KEY, "style_id"], "left_anti")
    return unbound.unionByName(_rows(orphans, "c2", F.col("style_id"), "warning"))


def g09_base_variant(variants: DataFrame) -> DataFrame:
    bad = variants.filter((F.col("variant_ix") == 0) & ~(F.col("bp_present") & F.col("breakpoint").isNull()))
    return _rows(bad, "g09", F.coalesce("breakpoint", F.lit("missing")))


def g10_tablet(variants: DataFrame) -> DataFrame:
    g = variants.groupBy(*_KEY, "style_id").agg(
        F.max(F.coalesce(F.col("breakpoint") == "mobile", F.lit(False))).alias("m"), F.max(F.coalesce(F.col("breakpoint") == "tablet", F.lit(False))).alias("t")
    )
    return _rows(g.filter("m and not t"), "g10", F.col("style_id"))


def _image_src(elements: DataFrame) -> DataFrame:
    src = F.expr("variant_get(parse_json(settings), '$.image.value.src.value')")
    e = elements.filter("widget_type = 'e-image'").withColumn("src", src).filter("src is not null")
    return e.select(
        *_KEY,
        F.expr("try_variant_get(src, '$.id.value', 'string') is not null").alias("has_id"),
        F.expr("try_variant_get(src, '$.url.value', 'string') is not null").alias("has_url"),
        F.expr("is_variant_null(variant_get(src, '$.url')) or coalesce(is_variant_null(variant_get(src, '$.url.value')), false)").alias("null_url"),
    )


_VALID_ID = "^[a-z][a-z0-9_]*$"


def g14_ids(elements: DataFrame, styles: DataFrame, classes: DataFrame) -> DataFrame:
    """Ids with characters outside a-z, 0-9 and underscore: style keys, class references, element ids."""
    ids = (
        styles.select(*_KEY, F.concat(F.lit("style:"), "style_id").alias("d"), F.col("style_id").alias("id"))
        .unionByName(classes.filter(~F.col("class_id").startswith("gc-")).select(*_KEY, F.concat(F.lit("class:"), "class_id").alias("d"), F.col("class_id").alias("id")))
        .unionByName(elements.select(*_KEY, F.concat(F.lit("element:"), "node_id").alias("d"), F.col("node_id").alias("id")))
    )
    return _rows(ids.filter(~F.col("id").rlike(_VALID_ID)), "g14", F.col("d"))


def g15_unique(elements: DataFrame) -> DataFrame:
    g = elements.filter("node_id is not null").groupBy("page_id", "node_id").agg(F.count("*").alias("n"), F.min("node_ix").alias("node_ix")).filter("n > 1")
    return _rows(g, "g15", F.concat_ws(":", "node_id", "n"))


def g16_el_types(elements: DataFrame) -> DataFrame:
    """Elements whose type is missing or not one a tree may contain."""
    kind = F.nullif(F.col("el_type"), F.lit(""))
    return _rows(elements.filter(kind.isNull() | ~kind.isin(*EL_TYPES)), "g16", F.coalesce(kind, F.lit("missing")))


def all_guards(elements, styles, variants, props, classes, values, kit) -> DataFrame:
    parts = [
        g01_token_existence(values, kit), g02_color_refs(values, kit), g03_font_refs(values, kit), g04_breakpoints(variants),
        g05_binding(styles, classes), value_rule_hits(values), style_rule_hits(props), g09_base_variant(variants), g10_tablet(variants),
        g14_ids(elements, styles, classes), g15_unique(elements), g16_el_types(elements),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def guard_scorecard(violations: DataFrame, pages: DataFrame) -> DataFrame:
    """Passed, warning and failed guards per page; blocked below the minimum score or with any error."""
    per_guard = violations.groupBy("page_id", "check_id").agg(F.max("severity").alias("severity"), F.min("severity").alias("worst"))
    g = per_guard.groupBy("page_id").agg(
        F.count(F.when(F.col("worst") == "error", 1)).alias("errors"), F.count(F.when(F.col("worst") != "error", 1)).alias("warnings")
    )
    j = pages.select("page_id").join(g, "page_id", "left")
    e, w = F.coalesce("errors", F.lit(0)), F.coalesce("warnings", F.lit(0))
    passed = F.lit(len(GUARDS)) - e - w
    score = js_round(passed * 100 / len(GUARDS))
    return j.select(
        "page_id", passed.alias("passed"), w.alias("warnings"), e.alias("errors"), score.alias("score"),
        F.when((score < MIN_SCORE) | (e > 0), "BLOCKED").otherwise("OK").alias("status"),
    )


# --- tree validation ----------------------------------------------------------------------------------------


def c1_types(props: DataFrame, variants: DataFrame, elements: DataFrame) -> DataFrame:
    """Declared types against the expected ones, plain-text custom CSS, visual settings on containers."""
    expected = F.create_map(*[x for k, v in PROP_TYPES.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))])
    allowed = F.try_element_at(expected, F.col("prop"))
    known = props.filter("nested = 0").withColumn("allowed", allowed).filter("allowed is not null")
    wrong = known.filter((F.col("kind") == "object") & F.col("vtype").isNotNull() & ~F.array_contains("allowed", F.col("vtype")))
    bare = known.filter((F.col("kind") == "string") & F.col("text").startswith("e-gv-"))
    css = variants.filter("css_kind = 'string'")
    keys = F.explode(F.expr("json_object_keys(settings)"))
    visual = elements.filter(F.col("el_type").isin(*CONTAINERS)).select(*_KEY, keys.alias("k")).filter(F.col("k").isin(*VISUAL_SETTINGS))
    return (
        _rows(wrong, "c1", F.concat_ws(":", F.lit("type"), "prop", "vtype"), "error")
        .unionByName(_rows(bare, "c1", F.concat_ws(":", F.lit("bare"), "prop"), "error"))
        .unionByName(_rows(css, "c1", F.concat_ws(":", F.lit("css"), "style_id"), "error"))
        .unionByName(_rows(visual, "c1", F.concat_ws(":", F.lit("setting"), "k"), "error"))
    )


def c1_shapes(typed: DataFrame) -> DataFrame:
    """Values that are not shaped as their declared type says, at any depth: one row per fault, "path:type:fault".

    A fault is a value of another kind, a field that is missing or of another kind, a unit or text of another form. Types
    that the table does not know are not judged.
    """
    kind, fields = F.col("kind"), F.col("fields")
    faults = F.lit(None).cast("array<string>")
    for vtype, shape in SHAPES.items():
        if isinstance(shape, str):
            found = [F.when(kind != shape, F.concat(F.lit("is "), kind))]
            if vtype in FORMATS:
                found.append(F.when(~F.col("text").rlike(FORMATS[vtype]), F.concat(F.lit("reads "), F.col("text"))))
        else:
            holder = "array" if "items" in shape else "object"
            found = [F.when(kind != holder, F.concat(F.lit("is "), kind))]
            for field, kinds in shape.items():
                name = field.rstrip("!")
                if name == "items":
                    for other in sorted({*_JSON_KINDS, *SHAPES} - set(kinds)):
                        found.append(F.when(F.array_contains(F.split(F.try_element_at(fields, F.lit("items")), ","), other), F.lit(f"holds {other}")))
                    continue
                own = F.try_element_at(fields, F.lit(name))
                wrong = F.when((kind == holder) & own.isNotNull() & ~own.isin(*kinds), F.concat(F.lit(f"{name} is "), own))
                if field.endswith("!"):
                    wrong = F.when((kind == holder) & own.isNull(), F.lit(f"{name} is missing")).otherwise(wrong)
                found.append(wrong)
            if vtype == "size":
                found.append(F.when(~F.col("unit").isin(*UNITS), F.concat(F.lit("unit reads "), F.col("unit"))))
        faults = F.when(F.col("vtype") == vtype, F.array_compact(F.array(*found))).otherwise(faults)
    rows = typed.select(*_KEY, "path", "vtype", F.explode(faults).alias("fault"))
    return _rows(rows, "c1", F.concat_ws(":", "path", "vtype", "fault"), "error")


_JSON_KINDS = ("array", "boolean", "null", "number", "object", "string")


def c3_style_ids(styles: DataFrame) -> DataFrame:
    bad = styles.filter(~F.col("style_id").startswith("gc-") & ~F.col("style_id").rlike(_VALID_ID))
    return _rows(bad, "c3", F.col("style_id"), "error")


def c4_responsive(props: DataFrame, variants: DataFrame) -> DataFrame:
    """Oversize desktop values in styles that have no mobile variant."""
    base = variants.filter(F.coalesce("breakpoint", F.lit("")).isin("", "desktop") & F.col("state").isNull())
    first = base.groupBy(*_KEY, "style_id").agg(F.min("variant_ix").alias("variant_ix"))
    mobile = variants.filter("breakpoint = 'mobile'").select(*_KEY, "style_id").distinct()
    need = first.join(mobile, [*_KEY, "style_id"], "left_anti").filter(~F.col("style_id").startswith("gc-"))
    p = props.join(need, [*_KEY, "style_id", "variant_ix"], "left_semi")
    big = F.lit(False)
    for name, limit in OVERSIZE.items():
        hit = (F.col("prop") == name) & (F.col("num") > limit)
        big = big | (hit & (F.col("unit") == "px") if name == "width" else hit)
    pad = F.col("prop").isin("padding.inline-start", "padding.inline-end") & (F.col("num") > OVERSIZE_PADDING)
    row = (F.col("prop") == "flex-direction") & (F.col("text") == "row")
    hits = p.filter(big | pad | row).select(*_KEY, "style_id", F.split("prop", r"\.").getItem(0).alias("prop")).distinct()
    return _rows(hits, "c4", F.concat_ws(":", "style_id", "prop"), "warning")


def c5_required(elements: DataFrame) -> DataFrame:
    """Settings a widget cannot do without, and paragraph tags inside paragraphs."""
    need = F.lit(None).cast("string")
    for widget, key in REQUIRED_SETTINGS:
        need = F.when(F.col("widget_type") == widget, key).otherwise(need)
    keys = F.expr("json_object_keys(settings)")
    lacking = elements.withColumn("need", need).filter(F.col("need").isNotNull() & ~F.array_contains(keys, F.col("need")))
    content = F.expr("try_variant_get(parse_json(settings), '$.paragraph.value.content.value', 'string')")
    nested = elements.filter("widget_type = 'e-paragraph'").filter(content.rlike(r"(?i)<p[>\s]"))
    return _rows(lacking, "c5", F.concat(F.lit("missing:"), "need"), "error").unionByName(_rows(nested, "c5", F.lit("p-in-p"), "error"))


def c6_format(styles: DataFrame, variants: DataFrame) -> DataFrame:
    """Incomplete style records, one row per style with the number of faults."""
    own = styles.filter(~F.col("style_id").startswith("gc-"))

    def n(cond):
        return F.coalesce(cond, F.lit(True)).cast("int")

    rec = own.select(*_KEY, "style_id", (
        F.col("legacy").cast("int") + n(F.col("rec_id") != F.col("style_id")) + n(F.col("rec_type") != "class") + (~F.col("has_label")).cast("int")
    ).alias("a"))
    var = variants.groupBy(*_KEY, "style_id").agg(
        (F.sum((~F.col("state_present")).cast("int") + F.col("css_kind").isin("missing", "string").cast("int")) + (~F.max("bp_present")).cast("int")).alias("b")
    )
    j = rec.join(var, [*_KEY, "style_id"], "left").withColumn("n", F.col("a") + F.coalesce("b", F.lit(0))).filter("n > 0")
    return _rows(j, "c6", F.concat_ws(":", "style_id", "n"), "error")


def c7_depth(elements: DataFrame, warn: int = 4, error: int = 6) -> DataFrame:
    """Documents nested too deep, at their first deepest element (a root has depth 0)."""
    deepest = elements.groupBy("page_id").agg(F.max("depth").alias("depth"), F.min_by("node_ix", F.struct((-F.col("depth")).alias("d"), "node_ix")).alias("node_ix"))
    bad = deepest.filter(F.col("depth") >= warn)
    return _rows(bad, "c7", F.col("depth"), "warning").withColumn("severity", F.when(F.col("detail").cast("int") >= error, "error").otherwise("warning"))


def c9_reuse(signatures: DataFrame) -> DataFrame:
    """Groups of children that repeat within a document: `signatures` is (page_id, parent_ix, struct_hash)."""
    g = signatures.groupBy("page_id", "struct_hash").agg(F.count("*").alias("n"), F.min("parent_ix").alias("node_ix")).filter("n > 1")
    return _rows(g, "c9", F.col("n"), "warning")


def hardcoded_colors(props: DataFrame) -> DataFrame:
    """Literal hex colours where a variable should stand."""
    own = F.col("prop").isin("color", "background-color", "border-color") & (F.col("vtype") == "color") & F.col("text").rlike("^#[0-9A-Fa-f]{3,8}$")
    return _rows(props.filter(own & (F.col("nested") == 0)), "hex", F.concat_ws(":", "prop", "text"), "warning")


def c8_grid(elements: DataFrame, props: DataFrame) -> DataFrame:
    """Wrapping or crowded flex containers that would be better as a grid."""
    wrap = props.filter("prop = 'flex-wrap' and text = 'wrap'").select(*_KEY).distinct().withColumn("wraps", F.lit(True))
    e = elements.filter("el_type = 'e-flexbox'").join(wrap, list(_KEY), "left")
    return _rows(e.filter(F.coalesce("wraps", F.lit(False)) | (F.col("n_children") >= 4)), "c8",
                 F.when(F.coalesce("wraps", F.lit(False)), "wrap").otherwise("children"), "warning")


def c10_native(pages: DataFrame) -> DataFrame:
    """Scripted animation effects a builder can do natively, per page."""
    calls = F.regexp_extract_all("html", F.lit(r"gsap\.(?:to|from|fromTo)\([^)]*\)"), F.lit(0))
    c = pages.select("page_id", F.explode(calls).alias("call"))
    native = F.col("call").rlike(r"\b(opacity|x|y|scale|rotation)\s*:")
    return c.groupBy("page_id").agg(F.count("*").alias("calls"), F.count(F.when(native, 1)).alias("native_calls"))


def validation_scorecard(violations: DataFrame, pages: DataFrame, threshold: int = 85) -> DataFrame:
    """Errors and warnings per page and the share of the six vital checks without errors (c4 only ever warns)."""
    g = violations.groupBy("page_id").agg(
        F.count(F.when(F.col("severity") == "error", 1)).alias("errors"), F.count(F.when(F.col("severity") != "error", 1)).alias("warnings"),
        *[F.max(F.when((F.col("check_id") == f"c{i}") & (F.col("severity") == "error"), 1).otherwise(0)).alias(f"f{i}") for i in range(1, 7)],
    )
    j = pages.select("page_id").join(g, "page_id", "left").fillna(0)
    ok = F.lit(6) - sum((F.col(f"f{i}") for i in range(2, 7)), F.col("f1"))
    score = js_round(ok * 100 / 6)
    return j.select("page_id", "errors", "warnings", score.alias("score"), (score >= threshold).alias("passed"))


_ID_HYPHEN = "^[a-z][a-z0-9_-]*$"


def inv_profile(elements: DataFrame, styles: DataFrame, classes: DataFrame) -> DataFrame:
    """Corpus invariants: elements violating each, hard or soft."""
    s = F.expr("parse_json(settings)")
    e = elements.withColumn("s", s)
    local = classes.filter(F.col("class_id").rlike("^(e-|s-|f)")).select(*_KEY, F.col("class_id").alias("style_id"))
    unresolved = local.join(styles.select(*_KEY, "style_id"), [*_KEY, "style_id"], "left_anti").select(*_KEY).distinct()
    ids = classes.select(*_KEY, F.col("class_id").alias("id")).unionByName(styles.select(*_KEY, F.col("style_id").alias("id")))
    bad_ids = ids.filter(~F.col("id").rlike(_ID_HYPHEN)).select(*_KEY).distinct()
    both = _image_src(elements).filter("has_id and has_url").select(*_KEY)
    w = F.col("widget_type")
    wrapper = F.expr("""CASE widget_type WHEN 'e-heading' THEN variant_get(s, '$.title') WHEN 'e-paragraph' THEN variant_get(s, '$.paragraph')
        WHEN 'e-button' THEN variant_get(s, '$.text') END""")
    not_html = e.withColumn("t", wrapper).filter("t is not null and coalesce(try_variant_get(t, '$[\"$$type\"]', 'string'), '') <> 'html-v3'").select(*_KEY)
    cls = e.filter("variant_get(s, '$.classes') is not null and coalesce(try_variant_get(s, '$.classes[\"$$type\"]', 'string'), '') <> 'classes'").select(*_KEY)
    kind = elements.filter((w.isin(*WIDGETS) & (F.col("el_type") != "widget")) | (w.isin(*CONTAINERS) & ~F.col("el_type").isin(*CONTAINERS))).select(*_KEY)
    parts = [("I", "warn", unresolved), ("III", "error", bad_ids), ("IV", "error", both), ("html-wrapper", "error", not_html), ("classes-object", "error", cls), ("el-type", "error", kind)]
    out = None
    for name, sev, df in parts:
        g = df.groupBy().agg(F.count("*").alias("violations"), F.countDistinct("page_id").alias("pages")).select(
            F.lit(name).alias("invariant"), F.lit(sev).alias("severity"), "violations", "pages")
        out = g if out is None else out.unionByName(g)
    return out
