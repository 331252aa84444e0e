"""Queries over element trees (`conversation_trees`: layout documents of up to eight conversation turns)."""

from __future__ import annotations

import re
from functools import cached_property, reduce

from pyspark.sql import DataFrame, functions as F

from sitecorpus.operators import assets, checks, trees as ops
from sitecorpus.plans.css_queries import sp
from sitecorpus.plans.registry import CTES, Tables, cte, ora, query
from sitecorpus.session import stage
from sitecorpus.sources import trees

cte("tdoc", f"""
 SELECT {trees.PAGE_SQL} AS page_id, {trees.wrap_sql('cards')}::JSON AS doc FROM (
  SELECT conv_id, part, string_agg({trees.CARD_SQL}, ',' ORDER BY turn) AS cards FROM (
   SELECT conv_id, {trees.PART_SQL} AS part, turn, role, conv_id * 8 + turn AS k, {trees.TEXT_SQL} AS txt FROM conversations) GROUP BY 1, 2)""")
# DuckDB walks the same documents with JSON functions: roots, then four levels (the documents have no more).
cte("tlv0", """SELECT page_id, [1] AS path, CASE WHEN json_type(doc) = 'ARRAY' THEN doc->0 WHEN doc->'element' IS NOT NULL THEN doc->'element' ELSE doc END AS n FROM tdoc""")
for i in range(1, 5):
    cte(f"tlv{i}", f"""SELECT page_id, list_append(path, i) AS path, n->'elements'->(i - 1)::INT AS n FROM (
      SELECT page_id, path, n, unnest(range(1, json_array_length(n->'elements')::BIGINT + 1)) AS i FROM tlv{i - 1})""")
cte("jel", """
 SELECT page_id, path, len(path) - 1 AS depth, n, n->>'id' AS node_id, n->>'elType' AS el_type, n->>'widgetType' AS widget_type,
   json_array_length(n->'elements')::BIGINT AS n_children, n->'settings' AS settings, n->'styles' AS styles, path[-1] AS ord,
   row_number() OVER (PARTITION BY page_id ORDER BY path) - 1 AS node_ix
 FROM (SELECT * FROM tlv0 UNION ALL SELECT * FROM tlv1 UNION ALL SELECT * FROM tlv2 UNION ALL SELECT * FROM tlv3 UNION ALL SELECT * FROM tlv4)""")
cte("jst", "SELECT page_id, node_ix, node_id, el_type, widget_type, sid AS style_id, styles->('$.\"' || sid || '\"') AS st FROM (SELECT *, unnest(json_keys(styles)) AS sid FROM jel)")
cte("jvar", """
 SELECT page_id, node_ix, node_id, el_type, widget_type, style_id, i AS variant_ix, v, v->'meta'->>'breakpoint' AS breakpoint, list_contains(json_keys(v->'meta'), 'breakpoint') AS bp_present,
   v->'meta'->>'state' AS state, list_contains(json_keys(v->'meta'), 'state') AS state_present,
   CASE WHEN NOT list_contains(json_keys(v), 'custom_css') THEN 'missing' WHEN json_type(v->'custom_css') = 'NULL' THEN 'null' WHEN json_type(v->'custom_css') = 'VARCHAR' THEN 'string' ELSE 'object' END AS css_kind
 FROM (SELECT *, st->'variants'->i::INT AS v FROM (SELECT *, unnest(range(0, json_array_length(st->'variants')::BIGINT)) AS i FROM jst))""")
cte("jp0", "SELECT page_id, node_ix, node_id, style_id, variant_ix, breakpoint, state, k AS prop, 0 AS nested, v->'props'->('$.\"' || k || '\"') AS val FROM (SELECT *, unnest(json_keys(v->'props')) AS k FROM jvar)")
cte("jp1", """SELECT page_id, node_ix, node_id, style_id, variant_ix, breakpoint, state, prop || '.' || k AS prop, 1 AS nested, val->'value'->('$."' || k || '"') AS val
  FROM (SELECT *, unnest(json_keys(val->'value')) AS k FROM jp0 WHERE json_type(val->'value') = 'OBJECT')""")
cte("jprop", """
 SELECT page_id, node_ix, node_id, style_id, variant_ix, breakpoint, state, prop, nested, kind, vtype,
  CASE WHEN kind = 'number' THEN val::DOUBLE WHEN kind = 'object' THEN try_cast(val->'value'->>'size' AS DOUBLE) END AS num,
  CASE WHEN kind = 'object' THEN val->'value'->>'unit' END AS unit,
  CASE WHEN kind = 'string' THEN val->>'$' WHEN json_type(val->'value') = 'VARCHAR' THEN val->>'value' END AS text,
  CASE WHEN vtype LIKE 'global-%' THEN val->>'value' END AS ref_id FROM (
  SELECT *, CASE json_type(val) WHEN 'OBJECT' THEN 'object' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS kind,
   CASE WHEN json_type(val) = 'OBJECT' THEN val->>'$."$$type"' END AS vtype
  FROM (SELECT * FROM jp0 UNION ALL SELECT * FROM jp1 WHERE json_type(val) = 'OBJECT' AND val->'$."$$type"' IS NOT NULL))""")
cte("jcls", """
 SELECT page_id, node_ix, node_id, (generate_subscripts(c, 1) - 1)::BIGINT AS pos, unnest(c) AS class_id FROM (
  SELECT *, CASE WHEN json_type(settings->'classes') = 'ARRAY' THEN from_json(settings->'classes', '["VARCHAR"]') WHEN json_type(settings->'classes') = 'OBJECT' THEN from_json(settings->'classes'->'value', '["VARCHAR"]') END AS c FROM jel)""")
cte("jkit", """SELECT DISTINCT ref_id AS gv_id, CASE WHEN vtype LIKE '%color%' THEN 'color' ELSE 'font' END AS kind,
  '#' || CASE WHEN left(md5(ref_id || 'bad'), 1) < 'e' THEN left(md5(ref_id || 'hex'), 6) ELSE 'none' END AS hex
  FROM jprop WHERE ref_id IS NOT NULL AND left(md5(ref_id), 1) < 'c'""")
# Every value below styles and settings, by DuckDB's own walk.
cte("jt", """SELECT e.page_id, e.node_ix, 'styles' AS part, t.fullkey, t.key, t.type, t.value, t.atom, t.id AS tid, t.parent AS tpar FROM jel e, json_tree(e.styles) t
  UNION ALL SELECT e.page_id, e.node_ix, 'settings', t.fullkey, t.key, t.type, t.value, t.atom, t.id, t.parent FROM jel e, json_tree(e.settings) t""")
# A value's holder is found inside the one row's own walk, so nothing is joined across rows.
cte("jtexts", """SELECT page_id, node_ix, part, unnest(list_filter(rows, lambda c: c.type = 'VARCHAR' AND c.key <> '$$type')) AS c, map_from_entries(list_transform(rows, lambda r: {'k': r.tid, 'v': r.own})) AS held FROM (
  SELECT page_id, node_ix, part, list({'fullkey': fullkey, 'key': key, 'type': type, 'atom': atom, 'tid': tid, 'tpar': tpar, 'own': CASE WHEN type = 'OBJECT' THEN value->>'$."$$type"' END}) AS rows FROM jt GROUP BY 1, 2, 3)""")
cte("jval", """SELECT page_id, node_ix, part, replace(replace(regexp_replace(c.fullkey, '\\[(\\d+)\\]', '.\\1', 'g'), '"', ''), '$.', '') AS path, c.key AS key, held[c.tpar] AS parent_type, c.atom->>'$' AS text FROM jtexts""")
cte("jimg", """SELECT page_id, node_ix, json_extract(s, '$.id') IS NOT NULL AND json_type(s, '$.id') <> 'NULL' AS i, json_extract(s, '$.url') IS NOT NULL AND json_type(s, '$.url') <> 'NULL' AS u,
  coalesce(json_type(s, '$.url') = 'NULL', false) AS nu FROM (
  SELECT page_id, node_ix, CASE WHEN json_type(value, '$.value') = 'OBJECT' THEN json_extract(value, '$.value') ELSE value END AS s FROM jt WHERE type = 'OBJECT' AND value->>'$."$$type"' = 'image-src')""")


cte("tref", f"""SELECT v.page_id, 5::BIGINT AS context_ix, 'element-tree:' || coalesce(e.node_id, '?') AS context, v.node_ix AS pos, v.text AS url FROM jval v JOIN jel e ON e.page_id = v.page_id AND e.node_ix = v.node_ix
  WHERE regexp_matches(v.path, '{assets.IMAGE_PATH}') AND starts_with(v.text, 'http')""")


class Trees:
    """The tree tables of one run. Documents are flattened once: the element rows are written, and what several rules read
    (styles, variants, properties, values) is written when it is first asked for. `staged=False` serves queries that read
    the elements a single time."""

    def __init__(self, docs: DataFrame, kit: DataFrame | None = None, staged: bool = True):
        self.keep = stage if staged else lambda df, name: df
        self.elements = self.keep(trees.tree_rows(docs), "elements")
        self._kit = kit

    @classmethod
    def of(cls, t: Tables, staged: bool = True) -> Trees:
        return cls(trees.conversation_trees(t.table("conversations")), staged=staged)

    @cached_property
    def styles(self):
        return self.keep(trees.style_rows(self.elements), "styles")

    @cached_property
    def variants(self):
        return self.keep(trees.variant_rows(self.elements), "variants")

    @cached_property
    def props(self):
        return self.keep(trees.style_props(self.elements), "style-props")

    @cached_property
    def classes(self):
        return trees.element_classes(self.elements)

    @cached_property
    def values(self):
        return self.keep(trees.tree_values(self.elements), "tree-values")

    @cached_property
    def kit(self):
        """The variable kit of the corpus: part of the ids its styles name, with kind and, of most, a valid colour."""
        if self._kit is not None:
            return self._kit
        gv = F.col("ref_id")
        ids = self.props.filter(gv.isNotNull() & (F.substring(F.md5(gv), 1, 1) < "c"))
        kind = F.when(F.contains("vtype", F.lit("color")), "color").otherwise("font")
        digits = F.when(F.substring(F.md5(F.concat(gv, F.lit("bad"))), 1, 1) < "e", F.substring(F.md5(F.concat(gv, F.lit("hex"))), 1, 6)).otherwise("none")
        return ids.select(gv.alias("gv_id"), kind.alias("kind"), F.concat(F.lit("#"), digits).alias("hex")).distinct()

    @property
    def pages(self):
        return self.elements.select("page_id").distinct()


query("tree_rows", ora("""
 SELECT e.page_id, e.node_ix, p.node_ix AS parent_ix, e.ord, e.depth, e.node_id, e.el_type, e.widget_type, e.n_children
 FROM jel e LEFT JOIN jel p ON p.page_id = e.page_id AND p.path = e.path[1:len(e.path) - 1]"""))(
    lambda t: Trees.of(t, False).elements.drop("settings", "styles"))
query("style_props", ora("SELECT * FROM jprop"))(lambda t: Trees.of(t, False).props)
query("element_classes", ora("SELECT page_id, node_ix, node_id, pos, class_id FROM jcls"))(lambda t: Trees.of(t, False).classes)
query("style_variants", ora("SELECT page_id, node_ix, node_id, el_type, widget_type, style_id, variant_ix, breakpoint, bp_present, state, state_present, css_kind FROM jvar"))(
    lambda t: Trees.of(t, False).variants.drop("props"))

query("asset_references_tree", ora("SELECT * FROM tref"))(lambda t: (lambda x: assets.tree_asset_references(x.elements, x.values))(Trees.of(t)))

_V = {
    "g01": "SELECT DISTINCT page_id, node_ix, text AS detail FROM jval WHERE text LIKE 'e-gv-%' AND text NOT IN (SELECT gv_id FROM jkit)",
    "g02": "SELECT page_id, node_ix, path || ':' || text AS detail FROM jval WHERE part = 'styles' AND parent_type = 'global-color-variable' AND text LIKE 'e-gv-%' AND text NOT IN (SELECT gv_id FROM jkit WHERE kind = 'color' AND regexp_matches(hex, '^#[0-9a-f]{6}$'))",
    "g03": "SELECT page_id, node_ix, path || ':' || text AS detail FROM jval WHERE part = 'styles' AND parent_type = 'global-font-variable' AND text LIKE 'e-gv-%' AND text NOT IN (SELECT gv_id FROM jkit)",
    "g04": "SELECT page_id, node_ix, breakpoint AS detail FROM jvar WHERE breakpoint NOT IN ('tablet', 'mobile', 'desktop')",
    "g05": "SELECT page_id, node_ix, style_id AS detail FROM jst s WHERE NOT EXISTS (SELECT 1 FROM jcls c WHERE c.page_id = s.page_id AND c.node_ix = s.node_ix AND c.class_id = s.style_id)",
    "g06": "SELECT page_id, node_ix, text AS detail FROM jval WHERE part = 'styles' AND regexp_matches(text, '^\\s*#[0-9a-fA-F]{3,6}\\s*$') AND coalesce(parent_type, '') <> 'color'",
    "g07": "SELECT page_id, node_ix, text AS detail FROM jval WHERE text LIKE 'e-gv-%' AND coalesce(parent_type, '') NOT LIKE '%variable%'",
    "g08": "SELECT page_id, node_ix, text AS detail FROM jprop WHERE prop = 'font-family' AND vtype = 'string' AND contains(text, ' ') AND NOT regexp_matches(text, '^[\"'']')",
    "g09": "SELECT page_id, node_ix, coalesce(breakpoint, 'missing') AS detail FROM jvar WHERE variant_ix = 0 AND NOT (bp_present AND breakpoint IS NULL)",
    "g10": "SELECT page_id, node_ix, style_id AS detail FROM jvar GROUP BY 1, 2, 3 HAVING bool_or(coalesce(breakpoint = 'mobile', false)) AND NOT bool_or(coalesce(breakpoint = 'tablet', false))",
    "g11": "SELECT page_id, node_ix, text AS detail FROM jprop WHERE prop = 'background.color' AND vtype = 'color'",
    "g12": "SELECT page_id, node_ix, detail FROM (SELECT page_id, node_ix, CASE WHEN nu THEN 'null-url' WHEN i AND u THEN 'both' WHEN NOT i AND NOT u THEN 'neither' END AS detail FROM jimg) WHERE detail IS NOT NULL",
    "g13": """SELECT page_id, node_ix, coalesce(text, num::VARCHAR) AS detail FROM jprop WHERE prop = 'line-height' AND (kind = 'number' OR (kind = 'string' AND regexp_matches(text, '^\\d+(\\.\\d+)?px$'))
        OR (vtype = 'size' AND unit = 'px' AND num < 5))""",
    "g14": """SELECT page_id, node_ix, d || ':' || id AS detail FROM (SELECT page_id, node_ix, 'style' AS d, style_id AS id FROM jst UNION ALL SELECT page_id, node_ix, 'class', class_id FROM jcls WHERE class_id NOT LIKE 'gc-%'
        UNION ALL SELECT page_id, node_ix, 'element', node_id FROM jel) WHERE NOT regexp_matches(id, '^[a-z][a-z0-9_]*$')""",
    "g15": "SELECT page_id, min(node_ix) AS node_ix, node_id || ':' || count(*) AS detail FROM jel WHERE node_id IS NOT NULL GROUP BY page_id, node_id HAVING count(*) > 1",
    "g16": "SELECT page_id, node_ix, coalesce(nullif(el_type, ''), 'missing') AS detail FROM jel WHERE coalesce(el_type, '') NOT IN (" + ", ".join(f"'{x}'" for x in checks.EL_TYPES) + ")",
}
_S = {g: s for g, _, s in checks.GUARDS}
for _g, _sql in _V.items():
    cte(f"v_{_g}", _sql)
cte("guard_v", " UNION ALL ".join(f"SELECT page_id, node_ix, '{g}' AS check_id, '{_S[g]}' AS severity, detail FROM v_{g}" for g in _V))


def _guard(name, fn):
    query(name, ora(f"SELECT page_id, node_ix, '{name}' AS check_id, '{_S[name]}' AS severity, detail FROM v_{name}"))(lambda t: fn(Trees.of(t)))


_guard("g01", lambda x: checks.g01_token_existence(x.values, x.kit))
_guard("g02", lambda x: checks.g02_color_refs(x.values, x.kit))
_guard("g03", lambda x: checks.g03_font_refs(x.values, x.kit))
_guard("g04", lambda x: checks.g04_breakpoints(x.variants))
_guard("g05", lambda x: checks.g05_binding(x.styles, x.classes))
for _one in ("g08", "g11", "g13"):
    _guard(_one, lambda x, g=_one: checks.style_rule_hits(x.props).filter(F.col("check_id") == g))
for _one in ("g06", "g07", "g12"):
    _guard(_one, lambda x, g=_one: checks.value_rule_hits(x.values).filter(F.col("check_id") == g))
_guard("g09", lambda x: checks.g09_base_variant(x.variants))
_guard("g10", lambda x: checks.g10_tablet(x.variants))
_guard("g14", lambda x: checks.g14_ids(x.elements, x.styles, x.classes))
_guard("g15", lambda x: checks.g15_unique(x.elements))
_guard("g16", lambda x: checks.g16_el_types(x.elements))


def guard_rows(x: Trees):
    return checks.all_guards(x.elements, x.styles, x.variants, x.props, x.classes, x.values, x.kit)


query("guard_violations", ora("SELECT check_id, severity, count(*) AS violations, count(DISTINCT page_id) AS pages FROM guard_v GROUP BY 1, 2"))(
    lambda t: guard_rows(Trees.of(t)).groupBy("check_id", "severity", "page_id").agg(F.count("*").alias("n"))
    .groupBy("check_id", "severity").agg(F.sum("n").alias("violations"), F.count("*").alias("pages")))
cte("gcard", """
 SELECT page_id, (16 - e - w) AS passed, w AS warnings, e AS errors, floor((16 - e - w) * 100 / 16 + 0.5)::BIGINT AS score,
  CASE WHEN floor((16 - e - w) * 100 / 16 + 0.5) < 85 OR e > 0 THEN 'BLOCKED' ELSE 'OK' END AS status FROM (
  SELECT d.page_id, count(DISTINCT check_id) FILTER (severity = 'error') AS e, count(DISTINCT check_id) FILTER (severity = 'warning') AS w
  FROM tdoc d LEFT JOIN guard_v USING (page_id) GROUP BY 1)""")
query("guard_scorecard", ora("SELECT * FROM gcard"))(
    lambda t: (lambda x: checks.guard_scorecard(guard_rows(x), x.pages))(Trees.of(t)))

_pt = " OR ".join(f"(prop = '{k}' AND vtype NOT IN ({', '.join(repr(v) for v in vs)}))" for k, vs in checks.PROP_TYPES.items())
_known = ", ".join(f"'{k}'" for k in checks.PROP_TYPES)
_vis = ", ".join(f"'{k}'" for k in checks.VISUAL_SETTINGS)
_req = " ".join(f"WHEN '{w}' THEN '{k}'" for w, k in checks.REQUIRED_SETTINGS)
_C = {
    "c1": ("error", f"""SELECT page_id, node_ix, 'type:' || prop || ':' || vtype AS detail FROM jprop WHERE nested = 0 AND kind = 'object' AND ({_pt})
       UNION ALL SELECT page_id, node_ix, 'bare:' || prop FROM jprop WHERE nested = 0 AND kind = 'string' AND text LIKE 'e-gv-%' AND prop IN ({_known})
       UNION ALL SELECT page_id, node_ix, 'css:' || style_id FROM jvar WHERE css_kind = 'string'
       UNION ALL SELECT page_id, node_ix, 'setting:' || k FROM (SELECT page_id, node_ix, unnest(json_keys(settings)) AS k FROM jel WHERE el_type IN ('e-flexbox', 'e-div-block')) WHERE k IN ({_vis})"""),
    "c2e": ("error", "SELECT page_id, node_ix, detail FROM v_g05 WHERE detail NOT LIKE 'gc-%'"),
    "c2w": ("warning", """SELECT DISTINCT page_id, node_ix, class_id AS detail FROM jcls c WHERE class_id NOT LIKE 'gc-%' AND EXISTS (SELECT 1 FROM jst s WHERE s.page_id = c.page_id AND s.node_ix = c.node_ix AND style_id NOT LIKE 'gc-%')
       AND NOT EXISTS (SELECT 1 FROM jst s WHERE s.page_id = c.page_id AND s.node_ix = c.node_ix AND s.style_id = c.class_id)"""),
    "c3": ("error", "SELECT page_id, node_ix, style_id AS detail FROM jst WHERE style_id NOT LIKE 'gc-%' AND NOT regexp_matches(style_id, '^[a-z][a-z0-9_]*$')"),
    "c4": ("warning", """SELECT DISTINCT p.page_id, p.node_ix, p.style_id || ':' || split_part(p.prop, '.', 1) AS detail FROM jprop p JOIN (
        SELECT page_id, node_ix, style_id, min(variant_ix) FILTER (coalesce(breakpoint, '') IN ('', 'desktop') AND state IS NULL) AS b FROM jvar WHERE style_id NOT LIKE 'gc-%'
        GROUP BY 1, 2, 3 HAVING NOT bool_or(coalesce(breakpoint = 'mobile', false))) f ON f.page_id = p.page_id AND f.node_ix = p.node_ix AND f.style_id = p.style_id AND f.b = p.variant_ix
        WHERE (prop = 'font-size' AND num > 28) OR (prop = 'min-height' AND num > 200) OR (prop = 'width' AND num > 100 AND unit = 'px')
         OR (prop IN ('padding.inline-start', 'padding.inline-end') AND num > 20) OR (prop = 'flex-direction' AND text = 'row')"""),
    "c5": ("error", f"""SELECT page_id, node_ix, 'missing:' || need AS detail FROM (SELECT *, CASE widget_type {_req} END AS need FROM jel) WHERE need IS NOT NULL AND NOT list_contains(json_keys(settings), need)
       UNION ALL SELECT page_id, node_ix, 'p-in-p' FROM jel WHERE widget_type = 'e-paragraph' AND regexp_matches(settings->>'$.paragraph.value.content.value', '(?i)<p[>\\s]')"""),
    "c6": ("error", """SELECT s.page_id, s.node_ix, s.style_id || ':' || (a + coalesce(b, 0)) AS detail FROM (
        SELECT *, (st->'$."$$type"' IS NOT NULL)::INT + (coalesce(st->>'id', '') <> style_id)::INT + (coalesce(st->>'type', '') <> 'class')::INT + (NOT list_contains(json_keys(st), 'label'))::INT AS a FROM jst WHERE style_id NOT LIKE 'gc-%') s
        LEFT JOIN (SELECT page_id, node_ix, style_id, sum((NOT state_present)::INT + (css_kind IN ('missing', 'string'))::INT) + (NOT bool_or(bp_present))::INT AS b FROM jvar GROUP BY 1, 2, 3) v
        ON v.page_id = s.page_id AND v.node_ix = s.node_ix AND v.style_id = s.style_id WHERE a + coalesce(b, 0) > 0"""),
    "c8": ("warning", """SELECT page_id, node_ix, CASE WHEN w THEN 'wrap' ELSE 'children' END AS detail FROM (SELECT e.*, EXISTS (SELECT 1 FROM jprop p WHERE p.page_id = e.page_id AND p.node_ix = e.node_ix AND prop = 'flex-wrap' AND text = 'wrap') AS w
        FROM jel e WHERE el_type = 'e-flexbox') WHERE w OR n_children >= 4"""),
}
_C["c7"] = ("warning", "SELECT page_id, min(node_ix) FILTER (depth = m) AS node_ix, m::VARCHAR AS detail FROM (SELECT *, max(depth) OVER (PARTITION BY page_id) AS m FROM jel) GROUP BY page_id, m HAVING m BETWEEN 4 AND 5")
_C["c7e"] = ("error", _C["c7"][1].replace("m BETWEEN 4 AND 5", "m >= 6"))
_C["c9"] = ("warning", """SELECT page_id, min(parent_ix) AS node_ix, count(*)::VARCHAR AS detail FROM (
        SELECT e.page_id, p.node_ix AS parent_ix, string_agg(coalesce(e.widget_type, e.el_type) || '|' || e.n_children || '|' || array_to_string(list_sort(json_keys(e.styles)), ','), '::' ORDER BY e.ord) AS sig
        FROM jel e JOIN jel p ON p.page_id = e.page_id AND p.path = e.path[1:len(e.path) - 1] GROUP BY 1, 2 HAVING count(*) >= 2) GROUP BY page_id, sig HAVING count(*) > 1""")
_C["hex"] = ("warning", "SELECT page_id, node_ix, prop || ':' || text AS detail FROM jprop WHERE nested = 0 AND prop IN ('color', 'background-color', 'border-color') AND vtype = 'color' AND regexp_matches(text, '^#[0-9A-Fa-f]{3,8}$')")
_ID = {c: "hex" if c == "hex" else c[:2] for c in _C}
for _c, (_, _sql) in _C.items():
    cte(f"v_{_c}", _sql)
cte("valid_v", " UNION ALL ".join(f"SELECT page_id, node_ix, '{_ID[c]}' AS check_id, '{s}' AS severity, detail FROM v_{c}" for c, (s, _) in _C.items()))


def _csql(*names):
    return ora(" UNION ALL ".join(f"SELECT page_id, node_ix, '{_ID[c]}' AS check_id, '{_C[c][0]}' AS severity, detail FROM v_{c}" for c in names))


query("c1_types", _csql("c1"))(lambda t: (lambda x: checks.c1_types(x.props, x.variants, x.elements))(Trees.of(t)))
# The same grammar over DuckDB's walk: typed objects, then one branch per field of each type.
# For it, part of the documents get values of other shapes, by a hash of the page.
_BENT = (
    ("01", '"unit":"px"', '"unit":"fr"'), ("23", '"unit":"em"', '"unit":1'), ("4", '"value":"#ff6600"', '"value":"orange"'),
    ("5", '"block-start":{"$$type":"size"', '"block-start":{"$$type":"string"'), ("6", '"children":[]', '"children":{}'),
    ("7", '"$$type":"global-font-variable","value":"e-gv-', '"$$type":"global-font-variable","value":"gv '),
)
BENT_SQL = "CASE " + " ".join(f"WHEN substring(md5(page_id), 1, 1) IN ({', '.join(repr(c) for c in cs)}) THEN replace(doc, '{a}', '{b}')" for cs, a, b in _BENT) + " ELSE doc END"
cte("b_tdoc", f"SELECT page_id, ({BENT_SQL})::JSON AS doc FROM (SELECT page_id, doc::VARCHAR AS doc FROM tdoc)")
_walk = ["tdoc", *[f"tlv{i}" for i in range(5)], "jel", "jt"]
for _n in _walk[1:]:
    cte(f"b_{_n}", re.sub(rf"\b(FROM|JOIN) ({'|'.join(_walk)})\b", r"\1 b_\2", CTES[_n]))


def bent_elements(t: Tables):
    return trees.tree_rows(trees.conversation_trees(t.table("conversations")).withColumn("doc", F.expr(BENT_SQL)))


cte("jtyped", """SELECT page_id, node_ix, replace(replace(regexp_replace(fullkey, '\\[(\\d+)\\]', '.\\1', 'g'), '"', ''), '$.', '') AS path, value->>'$."$$type"' AS vtype,
  CASE WHEN list_contains(json_keys(value), 'value') THEN value->'$.value' ELSE value END AS v, NOT list_contains(json_keys(value), 'value') AS flat FROM b_jt WHERE type = 'OBJECT' AND json_type(value->'$."$$type"') = 'VARCHAR'""")


def _kind_sql(x: str) -> str:
    return (f"CASE json_type({x}) WHEN 'OBJECT' THEN CASE WHEN json_type({x}->'$.\"$$type\"') = 'VARCHAR' THEN {x}->>'$.\"$$type\"' ELSE 'object' END WHEN 'VARCHAR' THEN 'string' "
            f"WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' ELSE 'number' END")


_whole = "CASE WHEN flat THEN 'object' ELSE " + _kind_sql("v") + " END"


def _fault_sql():
    for vtype, shape in checks.SHAPES.items():
        holder = shape if isinstance(shape, str) else "array" if "items" in shape else "object"
        yield f"SELECT *, 'is ' || {_whole} AS fault FROM jtyped WHERE vtype = '{vtype}' AND {_whole} <> '{holder}'"
        if vtype in checks.FORMATS:
            yield f"SELECT *, 'reads ' || (v->>'$') FROM jtyped WHERE vtype = '{vtype}' AND json_type(v) = 'VARCHAR' AND NOT regexp_matches(v->>'$', '{checks.FORMATS[vtype]}')"
        for field, kinds in () if isinstance(shape, str) else shape.items():
            allowed = ", ".join(repr(k) for k in kinds)
            if field == "items":
                yield f"SELECT DISTINCT page_id, node_ix, path, vtype, v, flat, 'holds ' || k FROM (SELECT *, {_kind_sql('i')} AS k FROM (SELECT *, unnest(v->'$[*]') AS i FROM jtyped WHERE vtype = '{vtype}' AND json_type(v) = 'ARRAY')) WHERE k NOT IN ({allowed})"
                continue
            name = field.rstrip("!")
            own, there = f"v->'$.\"{name}\"'", f"list_contains(json_keys(v), '{name}')"
            yield f"SELECT * EXCLUDE (k), '{name} is ' || k FROM (SELECT *, {_kind_sql(f'({own})')} AS k FROM jtyped WHERE vtype = '{vtype}' AND {_whole} = 'object' AND {there}) WHERE k NOT IN ({allowed})"
            if field.endswith("!"):
                yield f"SELECT *, '{name} is missing' FROM jtyped WHERE vtype = '{vtype}' AND {_whole} = 'object' AND NOT {there}"
        if vtype == "size":
            units = ", ".join(repr(u) for u in checks.UNITS)
            yield f"SELECT *, 'unit reads ' || (v->>'$.unit') FROM jtyped WHERE vtype = 'size' AND json_type(v->'$.unit') = 'VARCHAR' AND v->>'$.unit' NOT IN ({units})"


cte("v_shape", "SELECT page_id, node_ix, path || ':' || vtype || ':' || fault AS detail FROM (" + " UNION ALL ".join(_fault_sql()) + ")")
query("c1_shapes", ora("SELECT page_id, node_ix, 'c1' AS check_id, 'error' AS severity, detail FROM v_shape"))(lambda t: checks.c1_shapes(trees.typed_values(bent_elements(t))))
query("typed_values", ora("SELECT vtype, count(*) AS values_, count(*) FILTER (" + _whole + " = 'object') AS objects, count(DISTINCT page_id) AS pages FROM jtyped GROUP BY 1"))(
    lambda t: trees.typed_values(bent_elements(t)).groupBy("vtype").agg(
        F.count("*").alias("values_"), F.count(F.when(F.col("kind") == "object", 1)).alias("objects"), F.countDistinct("page_id").alias("pages")))
query("c2_binding", _csql("c2e", "c2w"))(lambda t: (lambda x: checks.binding_report(x.styles, x.classes))(Trees.of(t)))
query("c3_style_ids", _csql("c3"))(lambda t: checks.c3_style_ids(Trees.of(t, False).styles))
query("c4_responsive", _csql("c4"))(lambda t: (lambda x: checks.c4_responsive(x.props, x.variants))(Trees.of(t)))
query("c5_required", _csql("c5"))(lambda t: checks.c5_required(Trees.of(t, False).elements))
query("c6_format", _csql("c6"))(lambda t: (lambda x: checks.c6_format(x.styles, x.variants))(Trees.of(t)))
query("c8_grid", _csql("c8"))(lambda t: (lambda x: checks.c8_grid(x.elements, x.props))(Trees.of(t)))
query("c7_depth", _csql("c7", "c7e"))(lambda t: checks.c7_depth(Trees.of(t, False).elements))
query("c9_reuse", _csql("c9"))(lambda t: checks.c9_reuse(ops.tree_signatures(Trees.of(t).elements)))
query("hardcoded_colors", _csql("hex"))(lambda t: checks.hardcoded_colors(Trees.of(t, False).props))
query("c10_native", ora("""
 SELECT page_id, count(*) AS calls, count(*) FILTER (regexp_matches(c, '\\b(opacity|x|y|scale|rotation)\\s*:')) AS native_calls
 FROM (SELECT page_id, unnest(regexp_extract_all(html, 'gsap\\.(?:to|from|fromTo)\\([^)]*\\)')) AS c FROM sp) GROUP BY 1"""))(lambda t: checks.c10_native(sp(t)))


def validation_rows(x: Trees):
    parts = [
        checks.c1_types(x.props, x.variants, x.elements), checks.binding_report(x.styles, x.classes), checks.c3_style_ids(x.styles),
        checks.c4_responsive(x.props, x.variants), checks.c5_required(x.elements), checks.c6_format(x.styles, x.variants), checks.c8_grid(x.elements, x.props),
        checks.c7_depth(x.elements), checks.c9_reuse(ops.tree_signatures(x.elements)), checks.hardcoded_colors(x.props),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


query("validation_scorecard", ora("""
 SELECT page_id, errors, warnings, floor((6 - f) * 100 / 6 + 0.5)::BIGINT AS score, floor((6 - f) * 100 / 6 + 0.5) >= 85 AS passed FROM (
  SELECT d.page_id, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings,
   count(DISTINCT check_id) FILTER (severity = 'error' AND check_id IN ('c1','c2','c3','c4','c5','c6')) AS f FROM tdoc d LEFT JOIN valid_v USING (page_id) GROUP BY 1)"""))(
    lambda t: (lambda x: checks.validation_scorecard(validation_rows(x), x.pages))(Trees.of(t)))
_W = ", ".join(f"'{w}'" for w in checks.WIDGETS)
query("inv_profile", ora(f"""
 , v AS (SELECT DISTINCT 'I' AS invariant, page_id, node_ix FROM jcls c WHERE regexp_matches(class_id, '^(e-|s-|f)') AND NOT EXISTS (SELECT 1 FROM jst s WHERE s.page_id = c.page_id AND s.node_ix = c.node_ix AND s.style_id = c.class_id)
  UNION ALL SELECT DISTINCT 'III', page_id, node_ix FROM (SELECT page_id, node_ix, class_id AS id FROM jcls UNION ALL SELECT page_id, node_ix, style_id FROM jst) WHERE NOT regexp_matches(id, '^[a-z][a-z0-9_-]*$')
  UNION ALL SELECT 'IV', page_id, node_ix FROM jel WHERE widget_type = 'e-image' AND settings->>'$.image.value.src.value.id.value' IS NOT NULL AND settings->>'$.image.value.src.value.url.value' IS NOT NULL
  UNION ALL SELECT 'html-wrapper', page_id, node_ix FROM (SELECT *, CASE widget_type WHEN 'e-heading' THEN settings->'title' WHEN 'e-paragraph' THEN settings->'paragraph' WHEN 'e-button' THEN settings->'text' END AS tt FROM jel)
    WHERE tt IS NOT NULL AND coalesce(tt->>'$."$$type"', '') <> 'html-v3'
  UNION ALL SELECT 'classes-object', page_id, node_ix FROM jel WHERE settings->'classes' IS NOT NULL AND coalesce(settings->>'$.classes."$$type"', '') <> 'classes'
  UNION ALL SELECT 'el-type', page_id, node_ix FROM jel WHERE widget_type IN ({_W}) AND el_type <> 'widget')
 SELECT i AS invariant, s AS severity, count(v.page_id) AS violations, count(DISTINCT v.page_id) AS pages
 FROM (SELECT unnest(['I','III','IV','html-wrapper','classes-object','el-type']) AS i, unnest(['warn','error','error','error','error','error']) AS s) LEFT JOIN v ON v.invariant = i GROUP BY 1, 2"""))(
    lambda t: (lambda x: checks.inv_profile(x.elements, x.styles, x.classes))(Trees.of(t)))
