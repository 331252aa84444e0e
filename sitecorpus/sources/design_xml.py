"""Layout documents of a design tool as XML: nested nodes of any depth, many documents in a file, and named styles.

Documents are read as text, a record each, so that children of different tags keep their order; tags are cut and nested by
windows over a document's tags, as for pages. No document's size or depth is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from sitecorpus.functions.columns import bind, trim_ws
from sitecorpus.operators.html import ATTRS, leveled_tokens, nested

ROOT = "Layout"
# Attributes of a node by the column that holds them; of several names the first that is given counts.
NODE_ATTRIBUTES = {
    "name": ("name",), "href": ("href",), "src": ("src",), "background_image": ("backgroundImage",), "display": ("display",),
    "component_id": ("componentId",), "component_name": ("componentName",), "variant": ("variant",), "caption": ("caption",),
    "stack_direction": ("stackDirection",), "stack_gap": ("stackGap",), "padding": ("padding",), "max_width": ("maxWidth",), "width": ("width",), "height": ("height",),
    "background": ("backgroundColor", "background-color"), "border_radius": ("borderRadius", "border-radius"), "color": ("color",), "opacity": ("opacity",),
    "font_family": ("font-family",), "font_size": ("font-size",), "font_weight": ("font-weight",), "line_height": ("line-height",), "letter_spacing": ("letter-spacing",),
    "text_style": ("inlineTextStyle",), "position": ("position",), "top_offset": ("top",), "right_offset": ("right",), "bottom_offset": ("bottom",), "left_offset": ("left",),
    "grid_columns": ("grid-template-columns",), "grid_rows": ("grid-template-rows",),
}
_TAG = rf"^<(/?)([A-Za-z0-9_:-]+)({ATTRS})>"
_TOKEN = rf"<[/]?[A-Za-z0-9_:-]{ATTRS}>[^<]*"
_ATTRIBUTE = r"""([^\s=>"'/]+(?:="[^"]*"|='[^']*'|=)?)"""
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def escaped(c: Column) -> Column:
    for entity, char in reversed(_ENTITIES):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def unescaped(c: Column) -> Column:
    for entity, char in _ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


# --- writing ------------------------------------------------------------------------------------------------


def layout_xml(nodes: DataFrame, root: str = ROOT) -> DataFrame:
    """One document per page: (page_id, xml). `nodes` has page_id, pos, depth, tag, text and NODE_ATTRIBUTES columns.

    Where a node ends, so do all open ones down to the next node's depth; their tags are the last ones at those depths.
    """
    shown = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f' {names[0]}="'), escaped(F.col(c)), F.lit('"'))) for c, names in NODE_ATTRIBUTES.items()]
    begin = F.concat(F.lit("<"), F.col("tag"), F.concat_ws("", *shown), F.lit(">"), escaped(F.coalesce("text", F.lit(""))))
    n = nodes.withColumn("next", F.coalesce(F.lead("depth").over(W.partitionBy("page_id").orderBy("pos")), F.lit(0)))
    ends = F.when(F.col("next") <= F.col("depth"), F.sequence(F.col("depth"), F.col("next"), F.lit(-1))).otherwise(F.array().cast("array<bigint>"))
    depth = F.col("depth").cast("bigint")
    events = n.select(
        "page_id", "pos",
        F.explode(F.concat(
            F.array(F.struct(depth.alias("level"), F.col("tag"), begin.alias("xml"))),
            F.transform(ends.cast("array<bigint>"), lambda d: F.struct(d.alias("level"), F.lit(None).cast("string").alias("tag"), F.lit(None).cast("string").alias("xml"))),
        )).alias("e"),
    ).select("page_id", "pos", "e.*").withColumn("closes", F.col("xml").isNull().cast("int"))
    tag = F.last("tag", ignorenulls=True).over(W.partitionBy("page_id", "level").orderBy("pos", "closes"))
    written = events.select("page_id", "pos", "closes", (-F.col("level")).alias("up"), F.coalesce("xml", F.concat(F.lit("</"), tag, F.lit(">"))).alias("xml"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "closes", "up", "xml"))), lambda e: e["xml"]), "")
    docs = written.groupBy("page_id").agg(body.alias("body"))
    head = F.concat(F.lit(f'<{root} page="'), F.col("page_id").cast("string"), F.lit('">'))
    return docs.select("page_id", F.concat(head, F.col("body"), F.lit(f"</{root}>")).alias("xml"))


def style_xml(styles: DataFrame, tag: str) -> DataFrame:
    """One self-closing element per row, its columns as attributes: (xml)."""
    shown = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f' {c}="'), escaped(F.col(c).cast("string")), F.lit('"'))) for c in styles.columns]
    return styles.select(F.concat(F.lit(f"<{tag}"), F.concat_ws("", *shown), F.lit("/>")).alias("xml"))


# --- reading ------------------------------------------------------------------------------------------------


def read_layout_xml(spark: SparkSession, path: str, root: str = ROOT) -> DataFrame:
    """Documents of all files below a folder, many per file: (source, page_id, xml, sound).

    A record ends with the root's closing tag, so a file is never held as a whole. What stands before the root's opening tag
    is left out; a document is sound if it has that tag and as many closing as opening tags.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("lineSep", f"</{root}>").text(path)

    def balanced(plain: Column) -> Column:
        opened = F.regexp_count(plain, F.lit(rf"<[A-Za-z0-9_:-]{ATTRS}>")) - F.regexp_count(plain, F.lit(rf"<[A-Za-z0-9_:-]{ATTRS}(?<=/)>"))
        return opened == F.regexp_count(plain, F.lit(r"</[A-Za-z0-9_:-]+\s*>")) + 1  # the root's own closing tag separates records

    def record(xml: Column) -> Column:
        page = F.regexp_extract(xml, rf"""^<{root}[^>]*\spage=["']([^"']*)["']""", 1).try_cast("bigint")
        return F.struct(
            page.alias("page_id"), F.when(xml != "", xml).otherwise(F.col("value")).alias("xml"),
            F.when(xml == "", F.lit(False)).otherwise(bind(_markup(xml), balanced)).alias("sound"))

    # A row of its own: what is read of it is not worked out again for each condition on it.
    xml = F.regexp_extract("value", rf"(?s)(<{root}[\s>].*)$", 1)
    docs = raw.select(F.col("_metadata.file_path").alias("source"), "value").filter(trim_ws(F.col("value")) != "")
    return docs.select("source", F.inline(F.array(bind(xml, record))))


def _markup(xml: Column) -> Column:
    """A document without comments and instructions; marked character data becomes plain text."""
    x = F.regexp_replace(xml, r"(?s)<!--.*?(?:-->|$)|<\?.*?(?:\?>|$)", "")
    parts = F.split(x, r"<!\[CDATA\[")
    end = lambda p: F.coalesce(F.nullif(F.instr(p, "]]>"), F.lit(0)), F.length(p) + 1)
    text = lambda p: F.concat(escaped(F.substring(p, F.lit(1), end(p) - 1)), F.substring(p, end(p) + 3, F.length(p)))
    return F.when(F.contains(x, F.lit("<![CDATA[")), F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(text(p))), "")).otherwise(x)


def xml_tokens(docs: DataFrame) -> DataFrame:
    """One row per tag: (page_id, pos, kind open|close|self, tag as written, attrs, text after the tag).

    A tag's parts follow each other, so that only its attributes need the whole pattern, once.
    """
    raw = docs.select("page_id", F.posexplode(F.regexp_extract_all(_markup(F.col("xml")), F.lit(_TOKEN), F.lit(0))).alias("pos", "tok"))
    cut = raw.select("page_id", "pos", "tok", F.startswith("tok", F.lit("</")).alias("closes"), F.regexp_extract("tok", _TAG, 3).alias("attrs"), F.regexp_extract("tok", r"^</?([A-Za-z0-9_:-]+)", 1).alias("tag"))
    after = F.length("tag") + F.length("attrs") + F.when(F.col("closes"), 4).otherwise(3)
    text = F.substring("tok", after, F.length("tok"))
    text = F.when(text == "", text).otherwise(unescaped(trim_ws(F.regexp_replace(text, r"\s+", " "))))
    kind = F.when(F.col("closes"), "close").when(F.endswith("attrs", F.lit("/")), "self").otherwise("open")
    return cut.select("page_id", "pos", kind.alias("kind"), "tag", "attrs", text.alias("text"))


def attribute_map(attrs: Column) -> Column:
    """Attributes as a map. A quoted value is taken as it stands, a bare name means 'true', a name with an unquoted value
    nothing; of repeated names the last counts."""
    found = F.filter(F.regexp_extract_all(attrs, F.lit(_ATTRIBUTE), F.lit(1)), lambda a: ~F.endswith(a, F.lit("=")))

    def pair(a: Column) -> Column:
        at = F.instr(a, "=")
        quoted = unescaped(F.substring(a, at + 2, F.length(a) - at - 2))
        return F.struct(F.when(at > 0, F.substring(a, F.lit(1), at - 1)).otherwise(a).alias("k"), F.when(at > 0, quoted).otherwise("true").alias("v"))

    def last_of_each(pairs: Column) -> Column:
        names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
        last = lambda n: F.element_at(F.filter(pairs, lambda p: p["k"] == n), F.lit(-1))["v"]
        return F.when(F.size(names) == F.size(pairs), F.map_from_entries(pairs)).otherwise(F.map_from_arrays(names, F.transform(names, last)))

    # An expression inside a lambda is evaluated for each item, so the pairs are made before.
    return bind(F.transform(found, pair), last_of_each)


def xml_elements(docs: DataFrame) -> DataFrame:
    """Nodes below each document's root: (page_id, pos, parent_pos, ord, depth, kind, tag, attributes map, text).

    A node's text is what stands right before its closing tag; text before a child is none. Any closing tag closes the
    innermost open node, surplus ones are ignored, nodes left open last to the document's end.
    """
    lv = leveled_tokens(xml_tokens(docs)).withColumn("before", F.lag("text").over(W.partitionBy("page_id").orderBy("pos")))
    at_level = W.partitionBy("page_id", "level").orderBy("pos")
    own = F.when((F.col("kind") == "open") & (F.lead("kind").over(at_level) == "close"), F.lead("before").over(at_level))
    # Self-closing nodes stand between an opening and a closing tag of one level only as their siblings, never inside.
    lv = lv.withColumn("text", F.coalesce(own, F.lit("")))
    rows = nested(lv.filter("kind <> 'close'").drop("before")).filter("depth > 0")
    top = F.when(F.col("depth") > 1, F.col("parent_pos"))
    return rows.select("page_id", "pos", top.alias("parent_pos"), "ord", (F.col("depth") - 1).alias("depth"), "kind", "tag", attribute_map(F.col("attrs")).alias("attributes"), "text")


def xml_layout_nodes(docs: DataFrame) -> DataFrame:
    """Layout nodes as `sources.layout.layout_nodes` gives them, from documents: one column per known attribute."""
    a = F.col("attributes")
    # An empty value counts as none, but for opacity and offsets.
    keeps_empty = ("opacity", "top_offset", "right_offset", "bottom_offset", "left_offset")
    value = lambda c, names: F.coalesce(*[F.try_element_at(a, F.lit(n)) if c in keeps_empty else F.nullif(F.try_element_at(a, F.lit(n)), F.lit("")) for n in names])
    given = F.try_element_at(a, F.lit("text"))
    return xml_elements(docs).select(
        "page_id", "pos", "parent_pos", "ord", "depth", "tag", F.coalesce(F.nullif(given, F.lit("")), F.col("text")).alias("text"), given.isNotNull().alias("text_given"),
        *[value(c, names).alias(c) for c, names in NODE_ATTRIBUTES.items()],
    )


def named_colors(spark: SparkSession, path: str) -> DataFrame:
    """Colour styles of style files: (name, value, tag). ColorStyle elements count before Color elements of the same name,
    which need a name of their own; later elements of one tag replace earlier ones."""
    raw = spark.read.option("recursiveFileLookup", True).option("lineSep", ">").text(path)
    tok = F.regexp_extract("value", r"(?s)<(ColorStyle|Color)(\s[^<>]*)$", 0)
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    t = raw.select(F.regexp_extract(tok, r"^<(\w+)", 1).alias("tag"), attribute_map(F.regexp_extract(tok, r"(?s)^<\w+(.*)$", 1)).alias("a"), place.alias("place")).filter("tag <> ''")
    get = lambda n: F.nullif(F.try_element_at(F.col("a"), F.lit(n)), F.lit(""))
    name = F.coalesce(get("name"), F.when(F.col("tag") == "ColorStyle", get("id")))
    rows = t.select("tag", "place", name.alias("name"), F.coalesce(get("value"), get("color"), get("hex")).alias("value")).filter("name is not null and value is not null")
    first = rows.groupBy("name", "tag").agg(F.max_by("value", "place").alias("last"), F.min_by("value", "place").alias("first"))
    chosen = F.when(F.col("tag") == "ColorStyle", F.col("last")).otherwise(F.col("first"))
    return first.groupBy("name").agg(F.max_by(F.struct(chosen.alias("value"), "tag"), F.length("tag")).alias("x")).select("name", "x.value", "x.tag")
