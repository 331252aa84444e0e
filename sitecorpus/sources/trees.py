"""Element-tree documents: readers, the flattening job, and a corpus derived from the conversations table."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sitecorpus.functions.batches import expanded
from sitecorpus.sources.files import numbered_lines
from sitecorpus.sources.styled import _expression


def read_tree_json(spark: SparkSession, path: str) -> DataFrame:
    """One document per file: (doc_id, doc) with unreadable documents left out."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    raw = raw.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("doc"))
    return raw.filter(F.try_parse_json("doc").isNotNull())


def read_tree_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Documents of files that hold one per line: (doc_id, doc, sound). A document is named by its file and the byte where
    it begins; `sound` is false for lines that are no JSON."""
    lines = numbered_lines(spark, path, pattern).filter("trim(value) <> ''")
    return lines.select(F.concat_ws("#", "source", "place").alias("doc_id"), F.col("value").alias("doc"), F.try_parse_json("value").isNotNull().alias("sound"))


_SIZE = '{"$$type":"size","value":{"size":%s,"unit":"px"}}'
_CARD = (
    """{"id":"[[CASE WHEN k % 11 = 0 THEN concat('Card-', k) WHEN k % 13 = 0 THEN 'dup' ELSE concat('card', k) END]]","elType":"[[CASE WHEN k % 17 = 0 THEN 'e-grid' ELSE 'e-flexbox' END]]","settings":{"classes":[[CASE WHEN k % 10 = 3 THEN concat('["s_card', k, '"]') WHEN k % 7 = 0 THEN '{"$$type":"classes","value":["gc-card"]}' WHEN k % 9 = 0 THEN concat('{"$$type":"classes","value":["s_card', k, '","gc-card","e-lost', k, '"]}') ELSE concat('{"$$type":"classes","value":["s_card', k, '","gc-card"]}') END]][[CASE WHEN k % 19 = 0 THEN ',"padding":"10px"' ELSE '' END]]},"styles":{"s_card[[k]]":{"id":"[[CASE WHEN k % 23 = 0 THEN 'other' ELSE concat('s_card', k) END]]","type":"class",[[CASE WHEN k % 5 = 1 THEN '' ELSE '"label":"local",' END]]"variants":[{"meta":{[[CASE WHEN k % 6 = 1 THEN '"breakpoint":"desktop",' WHEN k % 6 = 2 THEN '' ELSE '"breakpoint":null,' END]]"state":null},"props":{"padding":{"$$type":"dimensions","value":{"block-start":"""
    + _SIZE % "[[4 * (k % 9)]]" + ""","inline-start":""" + _SIZE % "[[4 * (k % 9)]]" + ""","inline-end":""" + _SIZE % "8"
    + """}},"font-size":""" + _SIZE % "[[12 + 4 * (k % 7)]]"
    + ""","color":[[CASE k % 4 WHEN 0 THEN concat('{"$$type":"global-color-variable","value":"e-gv-c', k % 30, '"}') WHEN 1 THEN '{"$$type":"color","value":"#ff6600"}' WHEN 2 THEN '"#ff6600"' ELSE concat('"e-gv-c', k % 30, '"') END]],"background":{"$$type":"background","value":{"color":[[CASE k % 3 WHEN 0 THEN concat('{"$$type":"color","value":"#', CASE k % 2 WHEN 0 THEN '222222' ELSE '0e2a3b' END, '"}') ELSE concat('{"$$type":"global-color-variable","value":"e-gv-c', k % 20, '"}') END]]}},"font-family":[[CASE k % 5 WHEN 0 THEN '{"$$type":"string","value":"Open Sans"}' WHEN 1 THEN concat('{"$$type":"global-font-variable","value":"e-gv-f', k % 6, '"}') ELSE '{"$$type":"string","value":"Inter"}' END]],"line-height":[[CASE k % 7 WHEN 0 THEN '1.5' WHEN 1 THEN '{"$$type":"size","value":{"size":1.2,"unit":"px"}}' WHEN 2 THEN '"1.4px"' ELSE '{"$$type":"size","value":{"size":1.5,"unit":"em"}}' END]],"flex-direction":{"$$type":"string","value":"[[CASE k % 2 WHEN 0 THEN 'row' ELSE 'column' END]]"},[[CASE WHEN k % 6 = 0 THEN '"flex-wrap":{"$$type":"string","value":"wrap"},' ELSE '' END]]"gap":""" + _SIZE % "[[8 * (k % 5)]]"
    + """,[[CASE WHEN k % 4 = 1 THEN '"opacity":{"$$type":"size","value":{"size":0.5,"unit":"custom"}},"transform":{"$$type":"transform","value":[]},' ELSE '' END]]"width":{"$$type":"size","value":{"size":[[80 * (k % 6)]],"unit":"px"}}}[[CASE WHEN k % 8 = 5 THEN ',"custom_css":"a{}"' WHEN k % 8 = 6 THEN '' ELSE ',"custom_css":null' END]]}[[CASE WHEN k % 3 = 1 THEN ',{"meta":{"breakpoint":"mobile","state":null},"props":{"font-size":{"$$type":"size","value":{"size":14,"unit":"px"}}},"custom_css":null}' ELSE '' END]][[CASE WHEN k % 6 = 1 THEN ',{"meta":{"breakpoint":"tablet","state":null},"props":{"gap":{"$$type":"size","value":{"size":10,"unit":"px"}}},"custom_css":null}' ELSE '' END]][[CASE WHEN k % 12 = 5 THEN ',{"meta":{"breakpoint":"watch"},"props":{},"custom_css":null}' ELSE '' END]]]}},"elements":[{"id":"h[[CASE WHEN k % 4 < 2 THEN 'x' ELSE concat('', k) END]]","elType":"[[CASE WHEN k % 16 = 0 THEN 'e-heading' ELSE 'widget' END]]","widgetType":"e-heading","settings":{[[CASE WHEN k % 15 = 0 THEN '' WHEN k % 10 = 7 THEN '"title":"plain",' ELSE concat('"title":{"$$type":"html-v3","value":{"content":{"$$type":"string","value":"', txt, '"},"children":[]}},') END]]"tag":{"$$type":"string","value":"h2"}},"styles":{},"elements":[]},[[CASE WHEN k % 2 = 0 THEN concat('{"id":"p', k, '","elType":"widget","widgetType":"e-paragraph","settings":{"paragraph":{"$$type":"html-v3","value":{"content":{"$$type":"string","value":"', CASE WHEN k % 14 = 0 THEN '<p>x</p>' ELSE role END, '"},"children":[]}}},"styles":{"s-p', k, '":{"id":"s-p', k, '","type":"class","label":"local","variants":[{"meta":{"breakpoint":null,"state":null},"props":{"font-size":{"$$type":"size","value":{"size":16,"unit":"px"}},"color":{"$$type":"color","value":"#111111"}},"custom_css":null}]}},"elements":[]}') ELSE concat('{"id":"i', k, '","elType":"widget","widgetType":"e-image","settings":{"image":{"$$type":"image","value":{"src":{"$$type":"image-src","value":{', CASE k % 5 WHEN 0 THEN concat('"id":{"$$type":"image-attachment-id","value":', k, '}') WHEN 1 THEN concat('"id":{"$$type":"image-attachment-id","value":', k, '},"url":{"$$type":"url","value":"https://x.example/a.png"}') WHEN 2 THEN '"url":{"$$type":"url","value":"https://x.example/a.png"}' WHEN 3 THEN concat('"id":{"$$type":"image-attachment-id","value":', k, '},"url":null') ELSE '' END, '}}}}},"styles":{},"elements":[]}') END]][[CASE WHEN k % 4 = 0 THEN concat(',{"id":"x', k, '","elType":"e-flexbox","settings":{},"styles":{},"elements":[{"id":"b', k, '","elType":"widget","widgetType":"e-button","settings":{"text":{"$$type":"html-v3","value":{"content":{"$$type":"string","value":"Go"},"children":[]}}},"styles":{},"elements":[]}]}') ELSE '' END]][[CASE WHEN k % 12 = 8 THEN concat(',{"id":"comp', k, '","elType":"widget","widgetType":"e-component","settings":{"component-id":{"$$type":"string","value":"cmp-', k % 3, '"}},"styles":{},"elements":[]}') ELSE '' END]]]}"""
)

CARD_SQL = _expression(_CARD, None)
TEXT_SQL = "translate(text, concat('\"', chr(92), chr(10), chr(13), chr(9)), '     ')"


def wrap_sql(cards: str) -> str:
    """The three document shapes met in practice: wrapped, array, bare root."""
    root = (
        "concat('{\"id\":\"root', conv_id, '\",\"elType\":\"e-div-block\",\"settings\":{},\"styles\":{},\"elements\":[', "
        f"{cards}, ']}}')"
    )
    return (
        f"CASE conv_id % 3 WHEN 0 THEN concat('{{\"source\":\"x\",\"element\":', {root}, '}}') "
        f"WHEN 1 THEN concat('[', {root}, ']') ELSE {root} END"
    )


# A document holds at most this many turns; longer conversations become several documents.
TURNS_PER_DOCUMENT = 8
PART_SQL = f"CAST(floor(turn / {TURNS_PER_DOCUMENT}) AS BIGINT)"
PAGE_SQL = "concat(conv_id, CASE WHEN part = 0 THEN '' ELSE concat('-', part) END)"


def conversation_trees(conversations: DataFrame) -> DataFrame:
    """Layout documents of up to eight cards, one card per turn of a conversation: (page_id, doc)."""
    turns = conversations.selectExpr("conv_id", f"{PART_SQL} AS part", "turn", "role", "conv_id * 8 + turn AS k", f"{TEXT_SQL} AS txt")
    cards = turns.select("conv_id", "part", F.struct("turn", F.expr(CARD_SQL).alias("card")).alias("c"))
    docs = cards.groupBy("conv_id", "part").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c["card"]), ",").alias("cards")
    )
    return docs.select(F.expr(PAGE_SQL).alias("page_id"), F.expr(wrap_sql("cards")).alias("doc"))


ELEMENT_SCHEMA = (
    "page_id string, node_ix int, parent_ix int, ord int, depth int, node_id string, el_type string, "
    "widget_type string, n_children int, settings string, styles string"
)


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value)


def _flatten(doc: str) -> Iterator[tuple]:
    """Nodes of one document in document order, by an explicit stack."""
    data = json.loads(doc)
    roots = data if isinstance(data, list) else [data.get("element", data)]
    stack = [(n, None, i + 1, 0) for i, n in reversed(list(enumerate(roots)))]
    ix = 0
    while stack:
        node, parent, ord_, depth = stack.pop()
        kids = node.get("elements") or node.get("children") or node.get("items") or []
        yield (
            ix, parent, ord_, depth, _text(node.get("id")), _text(node.get("elType") or node.get("type")), _text(node.get("widgetType")), len(kids),
            json.dumps(node.get("settings") or {}, ensure_ascii=False), json.dumps(node.get("styles") or {}, ensure_ascii=False),
        )
        stack.extend((c, ix, i + 1, depth + 1) for i, c in reversed(list(enumerate(kids))))
        ix += 1


_ARROW = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "map<string,string>": pa.map_(pa.string(), pa.string())}


def _arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _element_rows(page: str, doc: str) -> Iterator[tuple]:
    return ((page, *row) for row in _flatten(doc))


def tree_rows(docs: DataFrame) -> DataFrame:
    """Documents to element rows (one per node). Trees are recursive, which no Spark type can express."""
    return docs.select("page_id", "doc").mapInArrow(expanded(_element_rows, _arrow_schema(ELEMENT_SCHEMA)), ELEMENT_SCHEMA)


VALUE_SCHEMA = (
    "page_id string, node_ix int, part string, path string, key string, parent_type string, kind string, text string, "
    "has_id boolean, has_url boolean, null_url boolean"
)


def _values(part: str, root: dict) -> Iterator[tuple]:
    """All texts below styles or settings, and all image sources, whatever their depth, by an explicit stack."""
    stack = [("", root)]
    while stack:
        path, node = stack.pop()
        own = node.get("$$type") if isinstance(node, dict) else None
        own = own if isinstance(own, str) else None
        if own == "image-src":
            src = node["value"] if isinstance(node.get("value"), dict) else node
            yield part, path, None, None, "image-src", None, src.get("id") is not None, src.get("url") is not None, "url" in src and src["url"] is None
        for key, val in node.items() if isinstance(node, dict) else enumerate(node):
            at = f"{path}.{key}" if path else str(key)
            if isinstance(val, str):
                if key != "$$type":
                    yield part, at, str(key), own, "string", val, None, None, None
            elif isinstance(val, (dict, list)):
                stack.append((at, val))


def _value_rows(page: str, ix: int, settings: str, styles: str) -> Iterator[tuple]:
    return ((page, ix, *row) for part, doc in (("styles", styles), ("settings", settings)) for row in _values(part, json.loads(doc)))


def tree_values(elements: DataFrame) -> DataFrame:
    """Every text in the styles and settings of each element, with its path and the declared type of what holds it; and
    every image source, with whether it names an id and a url."""
    return elements.select("page_id", "node_ix", "settings", "styles").mapInArrow(expanded(_value_rows, _arrow_schema(VALUE_SCHEMA)), VALUE_SCHEMA)


TYPED_SCHEMA = "page_id string, node_ix int, part string, path string, vtype string, kind string, text string, unit string, fields map<string,string>"
_KINDS = {bool: "boolean", int: "number", float: "number", str: "string", list: "array", type(None): "null"}


def _kind(value) -> str:
    """What a value is: its declared type, or its JSON kind."""
    if isinstance(value, dict):
        own = value.get("$$type")
        return own if isinstance(own, str) else "object"
    return _KINDS[type(value)]


def _typed(part: str, root: dict) -> Iterator[tuple]:
    """All objects with a declared type below styles or settings, whatever their depth, by an explicit stack."""
    stack = [("", root)]
    while stack:
        path, node = stack.pop()
        if isinstance(node, dict) and isinstance(node.get("$$type"), str):
            value = node["value"] if "value" in node else {k: v for k, v in node.items() if k != "$$type"}
            fields = {k: _kind(v) for k, v in value.items()} if isinstance(value, dict) else {"items": ",".join(sorted({_kind(v) for v in value}))} if isinstance(value, list) else None
            kind = _kind(value)
            unit = value.get("unit") if isinstance(value, dict) else None
            yield part, path, node["$$type"], kind, value if isinstance(value, str) else None, unit if isinstance(unit, str) else None, fields
        for key, val in node.items() if isinstance(node, dict) else enumerate(node):
            if isinstance(val, (dict, list)):
                stack.append((f"{path}.{key}" if path else str(key), val))


def _typed_rows(page: str, ix: int, settings: str, styles: str) -> Iterator[tuple]:
    for part, doc in (("styles", styles), ("settings", settings)):
        for *row, fields in _typed(part, json.loads(doc)):
            yield page, ix, *row, None if fields is None else list(fields.items())


def typed_values(elements: DataFrame) -> DataFrame:
    """Every object with a declared type in the styles and settings of each element: its path, the kind of its value, and of
    an object's fields and a list's items what each is (a declared type or a JSON kind)."""
    return elements.select("page_id", "node_ix", "settings", "styles").mapInArrow(expanded(_typed_rows, _arrow_schema(TYPED_SCHEMA)), TYPED_SCHEMA)


def style_rows(elements: DataFrame) -> DataFrame:
    """Style records: which of their fields are there, and the variants as VARIANT."""
    return elements.sparkSession.sql(
        """
        SELECT e.page_id, e.node_ix, e.node_id, e.el_type, e.widget_type, s.key AS style_id,
          try_variant_get(s.value, '$.id', 'string') AS rec_id, try_variant_get(s.value, '$.type', 'string') AS rec_type,
          variant_get(s.value, '$.label') IS NOT NULL AS has_label,
          variant_get(s.value, '$["$$type"]') IS NOT NULL AS legacy, variant_get(s.value, '$.variants') AS variants
        FROM {e} e, LATERAL variant_explode(parse_json(e.styles)) s
        """,
        e=elements,
    )


def variant_rows(elements: DataFrame) -> DataFrame:
    """Style variants: breakpoint with its presence, state presence, kind of custom CSS, props as VARIANT.

    `bp_present` separates an explicit null from a missing key; `css_kind` is missing, null, string or object.
    """
    return elements.sparkSession.sql(
        """
        SELECT s.page_id, s.node_ix, s.node_id, s.el_type, s.widget_type, s.style_id, v.pos AS variant_ix,
          try_variant_get(v.value, '$.meta.breakpoint', 'string') AS breakpoint,
          variant_get(v.value, '$.meta.breakpoint') IS NOT NULL AS bp_present,
          try_variant_get(v.value, '$.meta.state', 'string') AS state,
          variant_get(v.value, '$.meta.state') IS NOT NULL AS state_present,
          CASE WHEN variant_get(v.value, '$.custom_css') IS NULL THEN 'missing'
            WHEN is_variant_null(variant_get(v.value, '$.custom_css')) THEN 'null'
            WHEN schema_of_variant(variant_get(v.value, '$.custom_css')) = 'STRING' THEN 'string' ELSE 'object' END AS css_kind,
          variant_get(v.value, '$.props') AS props
        FROM {s} s, LATERAL variant_explode(s.variants) v
        """,
        s=style_rows(elements),
    )


def style_props(elements: DataFrame) -> DataFrame:
    """Typed style properties in long form; typed children of a value follow as `prop.child`.

    `kind` is the JSON kind of the value (string, number, object); vtype its declared type; ref_id a variable it names.
    """
    return elements.sparkSession.sql(
        """
        WITH top AS (
          SELECT v.page_id, v.node_ix, v.node_id, v.style_id, v.variant_ix, v.breakpoint, v.state, p.key AS prop, p.value AS val, 0 AS nested
          FROM {v} v, LATERAL variant_explode(v.props) p),
        kids AS (
          SELECT t.page_id, t.node_ix, t.node_id, t.style_id, t.variant_ix, t.breakpoint, t.state, concat(t.prop, '.', c.key) AS prop, c.value AS val, 1 AS nested
          FROM top t, LATERAL variant_explode(variant_get(t.val, '$.value')) c
          WHERE c.key IS NOT NULL AND variant_get(c.value, '$["$$type"]') IS NOT NULL),
        both AS (SELECT * FROM top UNION ALL SELECT * FROM kids),
        typed AS (
          SELECT *, CASE WHEN startswith(schema_of_variant(val), 'OBJECT') THEN 'object' WHEN schema_of_variant(val) = 'STRING' THEN 'string'
              WHEN schema_of_variant(val) = 'BOOLEAN' THEN 'boolean' WHEN startswith(schema_of_variant(val), 'ARRAY') THEN 'array' ELSE 'number' END AS kind,
            try_variant_get(val, '$["$$type"]', 'string') AS vtype FROM both)
        SELECT page_id, node_ix, node_id, style_id, variant_ix, breakpoint, state, prop, nested, kind, vtype,
          CASE WHEN kind = 'number' THEN try_variant_get(val, '$', 'double') ELSE try_variant_get(val, '$.value.size', 'double') END AS num,
          try_variant_get(val, '$.value.unit', 'string') AS unit,
          CASE WHEN kind = 'string' THEN try_variant_get(val, '$', 'string')
            WHEN schema_of_variant(variant_get(val, '$.value')) = 'STRING' THEN try_variant_get(val, '$.value', 'string') END AS text,
          CASE WHEN startswith(vtype, 'global-') THEN try_variant_get(val, '$.value', 'string') END AS ref_id
        FROM typed
        """,
        v=variant_rows(elements),
    )


def element_classes(elements: DataFrame) -> DataFrame:
    """Class ids of each element, whether the list is wrapped or plain."""
    return elements.sparkSession.sql(
        """
        WITH s AS (SELECT page_id, node_ix, node_id, variant_get(parse_json(settings), '$.classes') AS c FROM {e})
        SELECT s.page_id, s.node_ix, s.node_id, k.pos AS pos, variant_get(k.value, '$', 'string') AS class_id
        FROM s, LATERAL variant_explode(CASE WHEN startswith(schema_of_variant(s.c), 'ARRAY') THEN s.c ELSE variant_get(s.c, '$.value') END) k
        """,
        e=elements,
    )
