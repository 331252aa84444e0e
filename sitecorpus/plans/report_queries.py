"""Tree reports, merged QA reports, file sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecorpus.operators import audits, checks, html, reports, tokens, trees as ops
from sitecorpus.plans import token_queries  # noqa: F401  (defines sdecl)
from sitecorpus.plans.css_queries import hexsql, sp
from sitecorpus.plans.page_queries import _A11Y, _SEO
from sitecorpus.plans.registry import Tables, cte, ora, query
from sitecorpus.plans.token_queries import _lin, sd
from sitecorpus.plans.tree_queries import Trees, guard_rows
from sitecorpus.session import scratch_path, stage
from sitecorpus.sources import files, layout as lsrc, trees as tsrc

query("tree_interactions", ora("""
 SELECT page_id, node_id, k2 AS kind, min(node_ix) AS node_ix, CASE k2 WHEN 'scroll' THEN 'scroll_into_view' ELSE 'page_load' END AS "trigger", 600::BIGINT AS duration_ms FROM (
  SELECT *, CASE WHEN prop = 'opacity' AND num < 1 THEN 'entrance' WHEN prop = 'transform' THEN 'scroll' END AS k2 FROM jprop
  WHERE coalesce(breakpoint, '') IN ('', 'desktop') AND state IS NULL AND style_id NOT LIKE 'gc-%' AND nested = 0) WHERE k2 IS NOT NULL GROUP BY 1, 2, 3"""))(
    lambda t: ops.tree_interactions(Trees.of(t).props))
query("token_existence", ora("SELECT text AS gv_id, count(DISTINCT (page_id, node_ix)) AS elements FROM jval WHERE text LIKE 'e-gv-%' AND text NOT IN (SELECT gv_id FROM jkit) GROUP BY 1"))(
    lambda t: (lambda x: checks.g01_token_existence(x.values, x.kit).groupBy(F.col("detail").alias("gv_id")).agg(F.count("*").alias("elements")))(Trees.of(t)))
query("variable_drift", ora("""
 , r AS (SELECT DISTINCT page_id, text AS gv_id FROM jval WHERE text LIKE 'e-gv-%')
 SELECT page_id, gv_id, CASE WHEN gv_id IN (SELECT gv_id FROM jkit) THEN 'OK' ELSE 'DRIFT' END AS result FROM r
 UNION ALL SELECT page_id, NULL, 'NO_REFS' FROM tdoc WHERE page_id NOT IN (SELECT page_id FROM r)"""))(
    lambda t: (lambda x: ops.variable_drift(x.values, x.kit, x.pages))(Trees.of(t)))
query("token_hardcode_report", ora("""
 , h AS (SELECT page_id, node_id, node_ix, CASE WHEN vtype = 'color' AND lit THEN 'color' WHEN prop = 'font-family' AND vtype = 'string' AND lit THEN 'font' WHEN s THEN 'size' END AS kind,
   CASE WHEN vtype = 'color' AND lit THEN left(text, 7) WHEN prop = 'font-family' AND vtype = 'string' AND lit THEN text WHEN s THEN prop || ':' || num::INT || 'px' END AS value FROM (
   SELECT *, text NOT LIKE 'e-gv-%' AND text NOT LIKE 'var(%' AS lit, coalesce(prop IN ('font-size','width','height','gap','padding') AND vtype = 'size' AND unit = 'px' AND num >= 16 AND num % 4 = 0, false) AS s FROM jprop)),
 c AS (SELECT kind, value, page_id, node_ix, any_value(node_id) AS node_id, count(*) AS n FROM h WHERE kind IS NOT NULL GROUP BY 1, 2, 3, 4),
 r AS (SELECT *, row_number() OVER (PARTITION BY kind, value ORDER BY page_id, node_ix) AS rn FROM c)
 SELECT kind, value, sum(n)::BIGINT AS occurrences, string_agg(node_id, ',' ORDER BY rn) FILTER (rn <= 5) AS samples, CASE WHEN sum(n) >= 3 THEN 'high' WHEN sum(n) >= 2 THEN 'medium' ELSE 'low' END AS severity FROM r GROUP BY 1, 2"""))(
    lambda t: ops.token_hardcode_report(Trees.of(t).props))
_in = {k: ", ".join(f"'{p}'" for p in v) for k, v in ops.CLASS_CATEGORIES.items()}
cte("jsig", f"""
 SELECT page_id, node_ix, category, body, md5(body) AS signature FROM (SELECT page_id, node_ix, category, string_agg(DISTINCT pv, ';' ORDER BY pv) AS body FROM (
  SELECT *, CASE {" ".join(f"WHEN split_part(prop, '.', 1) IN ({v}) THEN '{k}'" for k, v in _in.items())} END AS category, prop || '=' || coalesce(ref_id, text, num::VARCHAR || coalesce(unit, '')) AS pv FROM jprop
  WHERE coalesce(breakpoint, '') IN ('', 'desktop') AND state IS NULL) WHERE category IS NOT NULL AND pv IS NOT NULL GROUP BY 1, 2, 3)""")
cte("jshare", "SELECT category, signature, count(*) AS elements, count(DISTINCT page_id) AS pages, min(body) AS body FROM jsig GROUP BY 1, 2 HAVING count(*) >= 2 OR category = 'background'")
query("global_class_candidates", ora("""
 SELECT category, left(signature, 12) AS signature, elements, pages, CASE WHEN category = 'background' THEN 'bg' WHEN category = 'structure' THEN 'layout' WHEN px >= 40 THEN 'display' WHEN px >= 24 THEN 'heading' WHEN px >= 16 THEN 'body' ELSE 'small' END AS label
 FROM (SELECT *, try_cast(nullif(regexp_extract(body, 'font-size=([\\d.]+)', 1), '') AS DOUBLE) AS px FROM jshare)"""))(lambda t: ops.global_class_candidates(Trees.of(t).props))
query("ungrouped_elements", ora("SELECT DISTINCT page_id, node_ix FROM jsig s WHERE NOT EXISTS (SELECT 1 FROM jsig x JOIN jshare h ON h.category = x.category AND h.signature = x.signature AND (h.elements >= 20 OR h.category = 'background') WHERE x.page_id = s.page_id AND x.node_ix = s.node_ix)"))(
    lambda t: ops.ungrouped_elements(Trees.of(t).props, 20))
cte("jcand", """
 SELECT struct_hash, n_children, count(*) AS occurrences, count(DISTINCT page_id) AS pages, min((page_id, parent_ix)) AS f FROM (
  SELECT e.page_id, p.node_ix AS parent_ix, count(*) AS n_children, md5(string_agg(coalesce(e.widget_type, e.el_type) || '|' || e.n_children || '|' || array_to_string(list_sort(json_keys(e.styles)), ','), '::' ORDER BY e.ord)) AS struct_hash
  FROM jel e JOIN jel p ON p.page_id = e.page_id AND p.path = e.path[1:len(e.path) - 1] GROUP BY 1, 2 HAVING count(*) >= 2) GROUP BY 1, 2 HAVING count(*) >= 2""")
query("component_candidates_tree", ora("SELECT struct_hash, n_children, occurrences, pages, f[1] AS page_id, f[2] AS first_ix FROM jcand"))(lambda t: ops.tree_candidates(Trees.of(t).elements))
query("component_widget_fields", ora("""
 SELECT struct_hash, e.ord AS ord, fld AS field, CASE fld WHEN 'heading' THEN 'title' WHEN 'paragraph' THEN 'paragraph' WHEN 'button' THEN 'text' ELSE 'image' END AS setting,
  coalesce(e.settings->>'$.title.value.content.value', e.settings->>'$.paragraph.value.content.value', e.settings->>'$.text.value.content.value') AS default_value FROM (
  SELECT *, regexp_extract(widget_type, '^e-(heading|paragraph|image|button)$', 1) AS fld FROM jel) e
 JOIN jel p ON p.page_id = e.page_id AND p.path = e.path[1:len(e.path) - 1] JOIN jcand c ON c.f[1] = e.page_id AND c.f[2] = p.node_ix WHERE fld <> ''"""))(
    lambda t: (lambda x: ops.component_widget_fields(x.elements, ops.tree_candidates(x.elements)))(Trees.of(t)))
# Ids that say what an element is, links of buttons and own properties of component instances, added to the documents' elements.
_FIELD_ID = "CASE widget_type WHEN 'e-heading' THEN concat('Title-', node_id) WHEN 'e-paragraph' THEN concat('body-', node_id) WHEN 'e-image' THEN concat('img-', node_id) WHEN 'e-button' THEN concat('CTA-', node_id) ELSE node_id END"
_FIELD_SETTINGS = """CASE widget_type WHEN 'e-button' THEN concat('{"link":{"$$type":"link","value":{"destination":{"value":"/go/', node_id, '"}}},', substring({s}, 2))
  WHEN 'e-component' THEN concat('{"property-title":{"$$type":"string","value":"T', CAST(substring(node_id, 5) AS BIGINT) % 5, '"},',
   CASE WHEN CAST(substring(node_id, 5) AS BIGINT) % 7 < 4 THEN concat('"property-size":', CAST(substring(node_id, 5) AS BIGINT) % 7, ',') ELSE '' END, substring({s}, 2)) ELSE {s} END"""
cte("jfel", f"SELECT page_id, path, depth, node_ix, ord, el_type, widget_type, {_FIELD_ID} AS node_id, ({_FIELD_SETTINGS.replace('{s}', 'settings')})::JSON AS settings FROM (SELECT * REPLACE (settings::VARCHAR AS settings) FROM jel)")


def _field_elements(x: Trees):
    return x.elements.withColumns({"settings": F.expr(_FIELD_SETTINGS.replace("{s}", "settings")), "node_id": F.expr(_FIELD_ID)})


cte("jdefs", """SELECT DISTINCT settings->>'$."component-id".value' AS component_id, '{"property-title":{"value":"T1"},"property-tone":"dark"}' AS settings FROM jfel
  WHERE widget_type = 'e-component' AND settings->>'$."component-id".value' <> 'cmp-2'""")


def _definitions(e):
    ids = e.filter("widget_type = 'e-component'").select(F.expr("""try_variant_get(parse_json(settings), '$["component-id"].value', 'string')""").alias("component_id")).distinct()
    return ids.filter("component_id <> 'cmp-2'").withColumn("settings", F.lit('{"property-title":{"value":"T1"},"property-tone":"dark"}'))


def _held_sql(name: str) -> str:
    paths = ", ".join("nullif(settings->>'" + p.replace("['image-src']", '."image-src"') + "', '')" for p in ops._HELD[name])
    return f"coalesce({paths}, '{'0' if name == 'image' else ''}')"


_hits = [(k, p, f"regexp_matches(node_id, '(?i){w}')") for k, p, w in reversed(ops.FIELD_WORDS)]
query("component_fields", ora(f"""
 , e AS (SELECT c.struct_hash, d.node_id AS field_id, d.node_ix, len(d.path) - len(p.path) AS steps,
   CASE WHEN {_hits[-1][2]} THEN nullif(regexp_replace({_held_sql('title')}, '[^a-zA-Z0-9]', '', 'g'), '') END AS title,
   CASE {" ".join(f"WHEN {h} THEN '{k}'" for k, p, h in _hits)} END AS type, CASE {" ".join(f"WHEN {h} THEN '{p}'" for k, p, h in _hits)} END AS prop,
   CASE {" ".join(f"WHEN {h} THEN {_held_sql(p)}" for k, p, h in _hits)} END AS default_value, CASE WHEN {_hits[0][2]} THEN {_held_sql('href')} END AS href
   FROM (SELECT page_id, node_ix, path FROM jel) p JOIN jcand c ON c.f[1] = p.page_id AND c.f[2] = p.node_ix JOIN jfel d ON d.page_id = p.page_id AND len(d.path) > len(p.path) AND d.path[1:len(p.path)] = p.path),
 n AS (SELECT struct_hash, arg_min(title, node_ix) AS name FROM e WHERE title IS NOT NULL GROUP BY 1)
 SELECT struct_hash, name, field_id, type, prop, default_value, href, steps FROM (SELECT *, row_number() OVER (PARTITION BY struct_hash, field_id ORDER BY node_ix DESC) AS rn FROM e WHERE type IS NOT NULL)
 LEFT JOIN n USING (struct_hash) WHERE rn = 1""").replace("d.node_id AS field_id", "d.node_id AS field_id"))(
    lambda t: (lambda x: ops.component_fields(_field_elements(x), ops.tree_candidates(x.elements)))(Trees.of(t)))
query("component_overrides", ora("""
 , i AS (SELECT coalesce(settings->>'$."component-id".value', 'unknown') AS component_id, page_id, node_ix, settings FROM jfel WHERE widget_type = 'e-component'),
 t AS (SELECT component_id, count(*) AS instances, min((page_id, node_ix)) AS first FROM i GROUP BY 1),
 o AS (SELECT component_id, page_id, node_ix, k[10:] AS property, coalesce(json_extract_string(v, '$.value'), v->>'$') AS value FROM (
   SELECT *, json_extract(settings, '$."' || k || '"') AS v FROM (SELECT *, unnest(json_keys(settings)) AS k FROM i) WHERE k LIKE 'property-%')),
 d AS (SELECT component_id, k[10:] AS property, coalesce(json_extract_string(v, '$.value'), v->>'$') AS default_value FROM (
   SELECT *, json_extract(settings::JSON, '$."' || k || '"') AS v FROM (SELECT *, unnest(json_keys(settings::JSON)) AS k FROM jdefs) WHERE k LIKE 'property-%')),
 s AS (SELECT component_id, property, count(*) AS overriding, count(*) FILTER (d.property IS NULL OR value IS DISTINCT FROM default_value) AS changed, count(DISTINCT value) AS values_, arg_min(value, (page_id, node_ix)) AS fv, min((page_id, node_ix)) AS fk
   FROM o LEFT JOIN d USING (component_id, property) GROUP BY 1, 2),
 r AS (SELECT component_id, property, overriding, changed, values_, fv, fk, default_value FROM s FULL JOIN d USING (component_id, property))
 SELECT t.component_id, t.component_id IN (SELECT component_id FROM jdefs) AS resolved, instances, property, coalesce(overriding, 0) AS overriding, coalesce(changed, 0) AS changed, coalesce(values_, 0) AS values_,
  CASE WHEN fk = first THEN fv END AS first_value, default_value FROM t LEFT JOIN r USING (component_id)"""))(
    lambda t: (lambda e: ops.component_overrides(e, _definitions(e)))(_field_elements(Trees.of(t))))
query("component_usage", ora("""
 SELECT cid AS component_id, count(*) AS occurrences, string_agg(DISTINCT p.el_type, ',' ORDER BY p.el_type) AS parent_types, arg_min(i.page_id || '/' || i.node_id, (i.page_id, i.node_id)) AS first_instance
 FROM (SELECT *, settings->>'$."component-id".value' AS cid FROM jel) i JOIN jel p ON p.page_id = i.page_id AND p.path = i.path[1:len(i.path) - 1] WHERE cid IS NOT NULL GROUP BY 1"""))(
    lambda t: ops.component_usage(Trees.of(t).elements))
query("schema_profile", ora("""
 SELECT section, name, detail, count(*) AS n FROM (SELECT 'el_type' AS section, coalesce(el_type, '(none)') AS name, '' AS detail FROM jel UNION ALL SELECT 'widget', widget_type, '' FROM jel WHERE widget_type IS NOT NULL
  UNION ALL SELECT 'breakpoint', coalesce(breakpoint, '(none)'), '' FROM jvar UNION ALL SELECT 'state', coalesce(state, '(none)'), '' FROM jvar
  UNION ALL SELECT 'prop', prop, coalesce(vtype, 'plain-' || kind) FROM jprop WHERE nested = 0) GROUP BY 1, 2, 3"""))(lambda t: (lambda x: ops.schema_profile(x.elements, x.variants, x.props))(Trees.of(t)))


query("class_samples", ora("""
 SELECT kind, place, class_id, uses FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY class_id) AS place FROM (
  SELECT coalesce(e.widget_type, e.el_type, '(none)') AS kind, class_id, count(*) AS uses FROM jcls c JOIN jel e ON e.page_id = c.page_id AND e.node_ix = c.node_ix WHERE class_id IS NOT NULL GROUP BY 1, 2)) WHERE place <= 5"""))(
    lambda t: (lambda x: ops.class_samples(x.classes, x.elements))(Trees.of(t)))


def _b(x: str, ok: int, warn: int, up: bool = True) -> str:
    op = ">=" if up else "<="
    return f"CASE WHEN {x} {op} {ok} THEN 'OK' WHEN {x} {op} {warn} THEN 'WARN' ELSE 'FAIL' END"


query("quality_metrics", ora(f"""
 , m AS (SELECT e.*, coalesce(floor(s.gc * 100 / nullif(s.n, 0) + 0.5), 0)::BIGINT AS class_pct, coalesce(floor(p.gvc * 100 / nullif(p.c, 0) + 0.5), 0)::BIGINT AS color_pct, coalesce(floor(p.gvf * 100 / nullif(p.f, 0) + 0.5), 0)::BIGINT AS font_pct
   FROM (SELECT page_id, max(depth) + 1 AS dom_depth, count(*) AS total_elements, count(*) FILTER (widget_type = 'e-component') AS components, floor(count(*) FILTER (el_type = 'e-div-block') * 100 / count(*) + 0.5)::BIGINT AS grid_pct FROM jel GROUP BY 1) e
   LEFT JOIN (SELECT page_id, count(*) AS n, count(*) FILTER (style_id LIKE 'gc-%') AS gc FROM jst GROUP BY 1) s USING (page_id)
   LEFT JOIN (SELECT page_id, count(*) FILTER (vtype IN ('color', 'global-color-variable') OR (kind = 'string' AND regexp_matches(text, '^(#|rgb)'))) AS c, count(*) FILTER (vtype = 'global-color-variable') AS gvc,
     count(*) FILTER (prop = 'font-family') AS f, count(*) FILTER (vtype = 'global-font-variable') AS gvf FROM jprop WHERE nested = 0 GROUP BY 1) p USING (page_id)),
 b AS (SELECT *, {_b('dom_depth', 3, 5, False)} AS depth_status, {_b('class_pct', 90, 70)} AS class_status, {_b('color_pct', 95, 80)} AS color_status, {_b('font_pct', 95, 80)} AS font_status,
   {_b('grid_pct', 35, 15)} AS grid_status, {_b('components', 10, 3)} AS component_status FROM m)
 SELECT *, ((depth_status = 'FAIL')::INT + (class_status = 'FAIL')::INT + (color_status = 'FAIL')::INT + (font_status = 'FAIL')::INT + (grid_status = 'FAIL')::INT + (component_status = 'FAIL')::INT)::BIGINT AS failed FROM b"""))(
    lambda t: (lambda x: ops.quality_metrics(x.elements, x.styles, x.props))(Trees.of(t)))
query("responsive_variants", ora("""
 , fac AS (SELECT unnest(['tablet', 'mobile']) AS b, unnest([0.75, 0.6]::DOUBLE[]) AS x),
 own AS (SELECT *, split_part(prop, '.', 1) AS root FROM jprop WHERE coalesce(breakpoint, '') IN ('', 'desktop') AND state IS NULL),
 sz AS (SELECT *, max(num) OVER (PARTITION BY page_id, node_ix, style_id, variant_ix, root) AS most FROM (
   SELECT *, CASE WHEN prop = 'font-size' THEN 28 WHEN prop = 'gap' THEN 24 WHEN prop = 'width' THEN 300 WHEN prop IN ('height', 'min-height') THEN 200
     WHEN prop = 'letter-spacing' THEN 2 WHEN prop = 'border-radius' THEN 12 WHEN contains(root, 'padding') OR contains(root, 'margin') THEN 20 END AS lim FROM own WHERE vtype = 'size') WHERE lim IS NOT NULL),
 r AS (SELECT page_id, node_ix, style_id, b AS breakpoint, prop, unit, greatest(1, floor(num * x + 0.5))::DOUBLE AS num, NULL::VARCHAR AS text FROM sz, fac WHERE most > lim
   UNION ALL SELECT page_id, node_ix, style_id, b, prop, NULL, NULL, CASE WHEN b = 'mobile' THEN '1fr' ELSE array_to_string(list_transform(range(0, n // 2), lambda i: '1fr'), ' ') END FROM (
     SELECT *, len(regexp_split_to_array(trim(text), '\\s+')) AS n FROM own WHERE prop = 'grid-template-columns' AND vtype = 'string'), fac WHERE n >= CASE b WHEN 'tablet' THEN 3 ELSE 2 END)
 SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM jprop h WHERE h.page_id = r.page_id AND h.node_ix = r.node_ix AND h.style_id = r.style_id AND h.breakpoint = r.breakpoint)"""))(
    lambda t: ops.responsive_variants(Trees.of(t).props))


def _scale(t: Tables):
    d = stage(sd(t), "decls")
    px = F.regexp_extract("value", r"^([\d.]+)px$", 1).try_cast("double")
    s = d.filter("source = 'sheet' and property = 'font-size'").withColumn("px", px).filter("px is not null")
    f = s.groupBy("site", "selector").agg(*[F.max(F.when(F.coalesce("breakpoint", F.when(F.col("at_rule") == "", "base")) == b, F.col("px"))).alias(f"{b}_px") for b in ("base", "tablet", "mobile")])
    f = f.filter("base_px is not null").withColumn("ord", F.col("selector"))
    ids = d.filter("source = 'sheet'").select("site", F.regexp_replace("selector", r"^\.", "").alias("style_id")).distinct()
    return ops.scale_factor_lookup(ids, f)


query("scale_factor_lookup", ora("""
 , f AS (SELECT * FROM (SELECT site, selector, max(px) FILTER (breakpoint IS NULL AND at_rule = '') AS b, max(px) FILTER (breakpoint = 'tablet') AS t, max(px) FILTER (breakpoint = 'mobile') AS m FROM (
   SELECT *, try_cast(nullif(regexp_extract(value, '^([\\d.]+)px$', 1), '') AS DOUBLE) AS px FROM sdecl WHERE source = 'sheet' AND property = 'font-size') WHERE px IS NOT NULL GROUP BY 1, 2) WHERE b IS NOT NULL),
 n AS (SELECT DISTINCT site, lower(regexp_replace(selector, '^\\.', '')) AS style_id FROM sdecl WHERE source = 'sheet'),
 h AS (SELECT n.site, n.style_id, min(f.selector) AS selector FROM n JOIN f ON f.site = n.site AND contains(lower(f.selector), n.style_id) WHERE n.style_id <> '' GROUP BY 1, 2)
 SELECT n.site, n.style_id, h.selector, round(coalesce(f.t / nullif(f.b, 0), 0.75), 4) AS tablet_factor, round(coalesce(f.m / nullif(f.b, 0), 0.6), 4) AS mobile_factor
 FROM n LEFT JOIN h ON h.site = n.site AND h.style_id = n.style_id LEFT JOIN f ON f.site = n.site AND f.selector = h.selector"""))(_scale)
query("fingerprint_similarity", ora("""
 , e AS (SELECT label::BIGINT AS group_id, vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), b AS (SELECT group_id, arg_min(v, id) AS bv, min(id) AS base_id FROM e GROUP BY 1)
 SELECT group_id, id, base_id, s AS similarity, s >= 85 AS passes FROM (SELECT e.*, base_id, coalesce(round(list_dot_product(v, bv) / nullif(sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(bv, bv)), 0) * 100, 3), 0) AS s FROM e JOIN b USING (group_id))""".replace(", e AS", "WITH e AS", 1)))(
    lambda t: ops.fingerprint_similarity(t.table("embeddings").select(F.col("label").alias("group_id"), F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))))

# --- merged reports -----------------------------------------------------------------------------------------

_CHECKS = ("status_ok", "has_title", "no_console_errors", "images_loaded", "fonts_loaded", "no_overflow", "has_content")


def observations(t: Tables):
    """Capture results per page, viewport and check; which ones fail is a hash of page, viewport and check."""
    p = t.table("pages").select("page_id", F.explode(F.array(*[F.lit(v) for v in reports.VIEWPORTS])).alias("viewport"))
    p = p.withColumn("name", F.explode(F.array(*[F.lit(c) for c in _CHECKS])))
    return p.withColumn("ok", F.substring(F.md5(F.concat_ws("|", "page_id", "viewport", "name")), 1, 2) >= "08")


def diffs(t: Tables):
    p = t.table("pages").select("page_id", F.explode(F.array(*[F.lit(v) for v in reports.VIEWPORTS])).alias("viewport"))
    n = F.conv(F.substring(F.md5(F.concat_ws("|", "page_id", "viewport", F.lit("diff"))), 1, 2), 16, 10).cast("double")
    return p.withColumn("diff_pct", n / 24)


_v = "(SELECT unnest(['desktop', 'tablet', 'mobile']) AS viewport)"
cte("obs", f"SELECT page_id, viewport, name, left(md5(page_id || '|' || viewport || '|' || name), 2) >= '08' AS ok FROM pages, {_v}, (SELECT unnest({list(_CHECKS)}) AS name)")
cte("hchk", "SELECT page_id, viewport, count(*) AS checks, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (NOT ok) = 0 AS passed FROM obs GROUP BY 1, 2")
cte("vdiff", f"SELECT page_id, max(d) AS max_diff, count(*) AS viewports, CASE WHEN max(d) >= 10 THEN 'critical' ELSE 'ok' END AS severity FROM (SELECT page_id, ('0x' || left(md5(page_id || '|' || viewport || '|diff'), 2))::INT::DOUBLE / 24 AS d FROM pages, {_v}) GROUP BY 1")
query("page_http_checks", ora("SELECT * FROM hchk"))(lambda t: reports.page_http_checks(observations(t)))
query("visual_diff_gate", ora("SELECT * FROM vdiff"))(lambda t: reports.visual_diff_gate(diffs(t)))


def page_contrast(t: Tables):
    c = tokens.color_uses(sd(t)).filter("property = 'color'").filter(~F.col("val").rlike(r"rgba\s*\("))
    hexes = c.select("page_id", tokens.hex_norm(F.col("val")).alias("hex")).filter("hex is not null").distinct()
    return audits.contrast_audit(hexes).filter("verdict <> 'PASS'")


def findings(t: Tables):
    a = audits.a11y_audit(sp(t))
    return a.withColumn("viewport", F.explode(F.array(*[F.lit(v) for v in reports.VIEWPORTS])))


def items(t: Tables):
    return reports.action_items(audits.page_issues(sp(t)), page_contrast(t), reports.page_http_checks(observations(t)), reports.visual_diff_gate(diffs(t)))


_lists = _SEO.format(pages="sp") + _A11Y.format(pages="sp")
query("a11y_rollup", ora(_A11Y.format(pages="sp") + """
 SELECT page_id, count(*) AS violations, coalesce(sum(3) FILTER (severity = 'fail'), 0)::BIGINT AS fails, coalesce(sum(3) FILTER (severity <> 'fail'), 0)::BIGINT AS warns, min(check_id) AS first_violation
 FROM (SELECT DISTINCT page_id, check_id, severity FROM a11y) GROUP BY 1"""))(lambda t: reports.a11y_rollup(findings(t)))
_items = f"""{_lists}
 , con AS (SELECT page_id, CASE WHEN ratio >= 3 THEN 3 ELSE 2 END AS pr FROM (SELECT page_id, round(1.05::DOUBLE / (0.2126::DOUBLE * {_lin('hex[2:3]')} + 0.7152::DOUBLE * {_lin('hex[4:5]')} + 0.0722::DOUBLE * {_lin('hex[6:7]')} + 0.05::DOUBLE), 2) AS ratio
   FROM (SELECT DISTINCT page_id, {hexsql('val')} AS hex FROM cuse WHERE property = 'color' AND NOT regexp_matches(val, 'rgba\\s*\\(')) WHERE hex IS NOT NULL) WHERE ratio < 4.5),
 it AS (SELECT page_id, 'seo' AS source, check_id, CASE severity WHEN 'fail' THEN 2 ELSE 3 END AS priority FROM seo UNION ALL SELECT page_id, 'a11y', check_id, CASE severity WHEN 'fail' THEN 2 ELSE 3 END FROM a11y
  UNION ALL SELECT page_id, 'contrast', 'contrast', pr FROM con UNION ALL SELECT page_id, 'http', 'http-' || viewport, 1 FROM hchk WHERE NOT passed UNION ALL SELECT page_id, 'visual', 'visual-diff', 1 FROM vdiff WHERE severity = 'critical')"""
query("qa_report", ora(_items + """
 SELECT page_id, count(i.source) AS items, min(priority)::BIGINT AS top_priority, count(*) FILTER (source = 'seo') AS seo, count(*) FILTER (source = 'a11y') AS a11y, count(*) FILTER (source = 'contrast') AS contrast,
  count(*) FILTER (source = 'http') AS http, count(*) FILTER (source = 'visual') AS visual, CASE min(priority) WHEN 1 THEN 'critical' WHEN 2 THEN 'needs-work' WHEN 3 THEN 'minor' ELSE 'passed' END AS status
 FROM pages LEFT JOIN it i USING (page_id) GROUP BY 1"""))(lambda t: reports.qa_report(items(t), t.table("pages")))
query("gate_report", ora(_items + """
 , g AS (SELECT page_id, count(DISTINCT source) FILTER (priority = 1) AS failed_steps, count(DISTINCT source) FILTER (priority > 1) AS warned_steps FROM pages LEFT JOIN it USING (page_id) GROUP BY 1)
 SELECT *, CASE WHEN failed_steps > 0 THEN 'BLOCKED' WHEN warned_steps > 0 THEN 'WARNINGS' ELSE 'PASS' END AS gate FROM g"""))(lambda t: reports.gate_report(items(t), t.table("pages")))
_act = " ".join(f"WHEN '{k}' THEN '{a}'" for k, (a, _) in reports.FIX_ACTIONS.items())
_sco = " ".join(f"WHEN '{k}' THEN '{s}'" for k, (_, s) in reports.FIX_ACTIONS.items())


def _fix_issues(t: Tables):
    page = items(t).select(F.concat(F.lit("page-"), "page_id").alias("page_id"), F.lit(None).cast("int").alias("node_ix"), "check_id")
    return page.unionByName(guard_rows(Trees.of(t)).select("page_id", "node_ix", "check_id"))


query("autofix_plan", ora(_items + f"""
 , allis AS (SELECT 'page-' || page_id AS page_id, NULL::BIGINT AS node_ix, check_id FROM it UNION ALL SELECT page_id, node_ix, check_id FROM guard_v)
 SELECT page_id, action, scope, node_ix, count(*) AS issues, min(check_id) AS first_check FROM (
  SELECT page_id, check_id, CASE check_id {_act} END AS action, CASE check_id {_sco} END AS scope, CASE WHEN CASE check_id {_sco} END = 'element' THEN node_ix END AS node_ix FROM allis) WHERE action IS NOT NULL GROUP BY 1, 2, 3, 4"""))(
    lambda t: reports.autofix_plan(_fix_issues(t)))

# --- sources and sinks: files Spark writes from the given tables, read back through the library's readers ---


ROWS_PER_FILE = 1000


def _filed(df, number, columns):
    """`df` as a folder of text or JSON files of about ROWS_PER_FILE rows, by a running number of the rows."""
    bucket = F.floor(number / ROWS_PER_FILE)
    return df.select(bucket.alias("bucket"), *columns).repartition("bucket").write.partitionBy("bucket")


def _css_folder(t: Tables):
    from sitecorpus.operators import css

    path = scratch_path(t.spark, "css-files")
    _filed(css.page_css(sp(t)), F.col("page_id"), ["css"]).text(path)
    return path


def _css_bundles(t: Tables):
    from sitecorpus.operators import css

    path = scratch_path(t.spark, "css-bundles")
    _filed(css.page_css(sp(t)), F.col("page_id"), [F.concat(F.lit("page-"), "page_id").alias("source"), "css"]).json(path)
    return path


query("src_css_files", ora("SELECT page_id, length(css) AS css_chars FROM css_text"))(
    lambda t: files.read_css_bundles(t.spark, _css_bundles(t)).select(F.regexp_extract("source", r"page-(\d+)", 1).cast("bigint").alias("page_id"), F.length("css").alias("css_chars")))
query("src_asset_inventory", ora(f"""SELECT 'txt' AS extension, 'application/octet-stream' AS mime, count(DISTINCT page_id // {ROWS_PER_FILE}) AS files, (sum(strlen(css)) + count(*))::BIGINT AS bytes FROM css_text"""))(
    lambda t: files.asset_inventory(t.spark, _css_folder(t)).filter("extension = 'txt'").groupBy("extension", "mime").agg(F.count("*").alias("files"), F.sum("length").alias("bytes")))
# A part of the lines is cut off, so that they are no documents any more.
_CUT_LINE = "substring(md5(page_id), 1, 1) = '0'"


def _tree_lines(t: Tables):
    path = scratch_path(t.spark, "tree-files")
    docs = tsrc.conversation_trees(t.table("conversations"))
    line = F.when(F.expr(_CUT_LINE), F.expr("substring(doc, 1, length(doc) - 5)")).otherwise(F.col("doc"))
    _filed(docs, F.split("page_id", "-")[0].cast("bigint"), [line.alias("value")]).text(path)
    return tsrc.read_tree_lines(t.spark, path)


query("src_tree_json", ora(f"""SELECT n->>'id' AS root_id, elements, max_depth FROM (SELECT page_id, n FROM tlv0) JOIN (SELECT page_id, count(*) AS elements, max(depth) AS max_depth FROM jel GROUP BY 1) USING (page_id) WHERE NOT {_CUT_LINE}"""))(
    lambda t: (lambda e: e.groupBy("page_id").agg(F.min_by("node_id", "node_ix").alias("root_id"), F.count("*").alias("elements"), F.max("depth").alias("max_depth")).drop("page_id"))(
        tsrc.tree_rows(_tree_lines(t).filter("sound").withColumnRenamed("doc_id", "page_id"))))
query("src_tree_json_malformed", ora(f"SELECT count(*) FILTER (NOT {_CUT_LINE}) AS sound, count(*) FILTER ({_CUT_LINE}) AS malformed FROM tdoc"))(
    lambda t: _tree_lines(t).agg(F.count(F.when(F.col("sound"), 1)).alias("sound"), F.count(F.when(~F.col("sound"), 1)).alias("malformed")))


def _style_xml(t: Tables):
    path = scratch_path(t.spark, "style-xml")
    lsrc.text_styles(html.with_site(t.table("pages"))).write.format("xml").option("rootTag", "Styles").option("rowTag", "TextStyle").save(path)
    return files.read_style_xml(t.spark, path)


query("src_tree_xml", ora("SELECT site, name, font_size, font_weight, font_family, color FROM tst"))(
    lambda t: _style_xml(t).select("site", "name", "font_size", "font_weight", "font_family", "color"))


def _report_sink(t: Tables):
    path = scratch_path(t.spark, "report")
    inv = html.page_inventory(t.table("pages")).join(html.with_site(t.table("pages")).select("page_id", "site"), "page_id")
    files.write_report(inv, path, "site")
    return t.spark.read.parquet(path).groupBy("site").agg(F.count("*").alias("pages"), F.sum("elements").alias("elements"), F.sum("links").alias("links"))


query("sink_report", ora("""
 SELECT site, count(*) AS pages, sum(e)::BIGINT AS elements, sum(l)::BIGINT AS links FROM page_site JOIN (
  SELECT page_id, count(*) AS e, count(*) FILTER (tag = 'a' AND regexp_matches(attrs, '(?i)\\shref\\s*=')) AS l FROM tags WHERE kind <> 'close' GROUP BY 1) USING (page_id) GROUP BY 1"""))(_report_sink)


def _artifacts(t: Tables):
    """Hashes registered for one export of the pages, checked against a later export in which some pages changed."""
    p = t.table("pages")
    digit = F.substring(F.md5("url"), 1, 1)
    stored = files.row_hashes(p.filter(digit < "e").select("page_id", "html"), "page_id")
    later = p.filter(digit >= "2").select("page_id", F.when(digit.between("4", "6"), F.concat("html", F.lit(" "))).otherwise(F.col("html")).alias("html"))
    return files.verify_artifacts(stored, files.row_hashes(later, "page_id"), "page_id")


query("sink_artifacts", "SELECT page_id, CASE WHEN h < '2' THEN 'missing' WHEN h >= 'e' THEN 'unexpected' WHEN h BETWEEN '4' AND '6' THEN 'changed' ELSE 'valid' END AS state FROM (SELECT page_id, left(md5(url), 1) AS h FROM pages)")(_artifacts)
