"""Design-token queries per site, over the declarations of `styled_pages`."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecorpus.functions.dims import WEIGHT_NAMES
from sitecorpus.operators import audits, css, html, tokens
from sitecorpus.plans.css_queries import COLORS, _use, fallback, hexsql, sp, trim
from sitecorpus.plans.registry import Tables, cte, ora, query
from sitecorpus.session import stage
from sitecorpus.sources import design


def sd(t: Tables):
    return tokens.site_decls(css.css_declarations(html.with_site(sp(t)), ("site",)))


def catalog(t: Tables):
    return tokens.token_catalog(sd(t))


def catalog_table(t: Tables):
    """The catalogue as a written table, for queries that read it several times."""
    return stage(catalog(t), "catalog")


def faces(t: Tables):
    return css.font_faces(html.with_site(sp(t)), ("site",))


def faces_table(t: Tables):
    return stage(faces(t), "faces")


cte("sdecl", "SELECT d.*, p.site, (d.page_id, d.o) AS so FROM decl d JOIN page_site p USING (page_id)")
cte("tok_usage", """
 SELECT site, property AS name, count(*) AS occurrences, count(DISTINCT value) AS distinct_values, arg_min(value, so) AS primary_value
 FROM sdecl WHERE property LIKE '--%' GROUP BY 1, 2""")
query("token_usage", ora("SELECT * FROM tok_usage WHERE NOT (name LIKE '--framer-%' AND name NOT LIKE '--framer-text-color%')"))(
    lambda t: tokens.token_usage(sd(t)))

_looks = "regexp_matches(lower(trim(value)), '^(#|rgb|hsl)')"
cte("cat", f"""
 SELECT *, CASE WHEN (contains(n, '-color') OR (contains(n, '-text') AND NOT contains(n, 'font'))) AND {_looks} THEN 'color'
   WHEN regexp_matches(n, '-font|family|typography') THEN 'font' WHEN regexp_matches(n, '-size|-spacing|-width') THEN 'size'
   WHEN {_looks} THEN 'color' WHEN regexp_matches(value, '^[0-9]') AND regexp_matches(value, '(px|%|em|rem|vw|vh)$') THEN 'size' ELSE 'unknown' END AS token_type,
   regexp_replace(lower(regexp_replace(regexp_replace(name, '^--', ''), '^token-', 'framer-')), '[^a-z0-9_-]', '-', 'g') AS label,
   {hexsql('value')} AS hex FROM (
  SELECT site, name, lower(name) AS n, primary_value AS value, occurrences FROM tok_usage
  UNION ALL SELECT site, name, lower(name), arg_min(v, (so, i)), 0 FROM (
   SELECT site, so, unnest(regexp_extract_all(value, {_use}, 1)) AS name, unnest(regexp_extract_all(value, {_use}, 2)) AS v,
     generate_subscripts(regexp_extract_all(value, {_use}, 1), 1) AS i FROM sdecl) u
   WHERE NOT EXISTS (SELECT 1 FROM tok_usage t WHERE t.site = u.site AND t.name = u.name) GROUP BY 1, 2)""")
query("token_catalog", ora("SELECT site, name, value, occurrences, token_type, label, hex FROM cat"))(catalog)

cte("cuse", f"""
 SELECT * FROM (SELECT *, {fallback(trim('value'))} AS val FROM sdecl
  WHERE property IN ({COLORS}) OR property LIKE '--framer-text-color%' OR property LIKE '--extracted-%') WHERE val IS NOT NULL""")
cte("pal", f"""
 SELECT site, hex, arg_min(val, so) AS raw, count(*) AS occurrences,
   count(DISTINCT CASE property WHEN 'background' THEN 'background-color' ELSE property END) AS properties
 FROM (SELECT *, {hexsql('val')} AS hex FROM cuse WHERE NOT regexp_matches(val, 'rgba\\s*\\(')) WHERE hex IS NOT NULL GROUP BY 1, 2""")
query("color_palette", ora("SELECT * FROM pal"))(lambda t: tokens.palette_totals(sd(t)))
query("color_properties", ora(f"""
 SELECT site, hex, CASE property WHEN 'background' THEN 'background-color' ELSE property END AS property, count(*) AS occurrences
 FROM (SELECT *, {hexsql('val')} AS hex FROM cuse WHERE NOT regexp_matches(val, 'rgba\\s*\\(')) WHERE hex IS NOT NULL GROUP BY 1, 2, 3"""))(
    lambda t: tokens.color_palette(sd(t)).drop("first"))
query("semi_transparent_colors", ora(f"""
 SELECT site, rgba, {hexsql('rgba')} AS hex_approx, try_cast(regexp_extract(rgba, ',([\\d.]+)\\)$', 1) AS DOUBLE) AS opacity, count(*) AS occurrences
 FROM (SELECT site, regexp_replace(val, '\\s+', '', 'g') AS rgba FROM cuse WHERE regexp_matches(val, 'rgba\\s*\\(')) GROUP BY ALL"""))(
    lambda t: tokens.semi_transparent(sd(t)))


def _plain(props: str) -> str:
    return f"(SELECT * FROM (SELECT *, {fallback(trim('value'))} AS v FROM sdecl WHERE property IN ({props})) WHERE v IS NOT NULL)"


query("typography_scale", ora(f"""
 , c AS (SELECT site, property AS kind, CASE property WHEN 'font-family' THEN {trim("regexp_replace(split_part(v, ',', 1), '[\"'']', '', 'g')")} ELSE v END AS value,
   count(*) AS occurrences FROM {_plain("'font-size','line-height','letter-spacing','font-weight','font-family'")} GROUP BY 1, 2, 3),
 r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY coalesce(try_cast(regexp_extract(value, '^\\s*(-?(?:\\d+\\.?\\d*|\\.\\d+))', 1) AS DOUBLE), 0) DESC, value) AS rn
   FROM c WHERE kind = 'font-size')
 SELECT c.*, (['H1','H2','H3','H4','H5','Body','Small','XSmall'])[r.rn] AS context FROM c LEFT JOIN r USING (site, kind, value)"""))(
    lambda t: tokens.typography_scale(stage(tokens.typography_counts(sd(t)), "sizes")))


def _side(i: tuple) -> str:
    return (f"CASE WHEN kind IN ('padding', 'margin') THEN CASE len(p) WHEN 1 THEN p[{i[0]}] WHEN 2 THEN p[{i[1]}] WHEN 3 THEN p[{i[2]}] WHEN 4 THEN p[{i[3]}] END END")


query("spacing_scale", ora(f"""
 SELECT site, kind, value, occurrences, {_side((1, 1, 1, 1))} AS "top", {_side((1, 2, 2, 2))} AS "right", {_side((1, 1, 3, 3))} AS "bottom", {_side((1, 2, 2, 4))} AS "left"
 FROM (SELECT *, regexp_split_to_array(value, '\\s+') AS p FROM (
  SELECT site, CASE WHEN property LIKE '%-gap' THEN 'gap' ELSE property END AS kind, v AS value, count(*) AS occurrences
  FROM {_plain("'padding','margin','gap','row-gap','column-gap','border-radius','max-width'")} GROUP BY 1, 2, 3))"""))(
    lambda t: tokens.spacing_scale(sd(t)))
query("layout_usage", ora(f"""
 SELECT site, property AS kind, v AS value, count(*) AS occurrences
 FROM {_plain("'display','flex-direction','justify-content','align-items'")} GROUP BY 1, 2, 3"""))(lambda t: tokens.layout_usage(sd(t)))
_sum = f"""count(DISTINCT selector) AS selectors,
  count(DISTINCT {hexsql(f"coalesce({fallback('value')}, value)")}) FILTER (property IN ({COLORS})) AS colors,
  count(DISTINCT value) FILTER (property = 'font-family') AS families, count(DISTINCT value) FILTER (property = 'font-size') AS sizes,
  count(DISTINCT value) FILTER (property IN ('padding','margin','gap','row-gap','column-gap')) AS spacings,
  count(DISTINCT property) FILTER (property LIKE '--%') AS variables"""
query("style_summary", ora(f"SELECT coalesce(site, '*') AS site, {_sum} FROM sdecl GROUP BY GROUPING SETS ((site), ())"))(
    lambda t: tokens.style_summary(sd(t)))

cte("sface", """
 SELECT f.*, p.site, CASE WHEN weight = 'normal' THEN 400 WHEN weight = 'bold' THEN 700
   WHEN try_cast(weight AS INT) BETWEEN 1 AND 1000 THEN try_cast(weight AS INT) ELSE 400 END::BIGINT AS w FROM face f JOIN page_site p USING (page_id)""")
query("font_families", ora("""
 SELECT site, family, string_agg(w::VARCHAR, ',' ORDER BY f) AS weights, sum(n)::BIGINT AS faces,
  CASE WHEN bool_or(c) THEN 'framer-cdn' WHEN bool_or(g) THEN 'google-fonts' ELSE 'custom-upload' END AS source FROM (
  SELECT site, family, w, min((page_id, pos)) AS f, count(*) AS n, bool_or(source = 'framer-cdn') AS c, bool_or(source = 'google-fonts') AS g
  FROM sface GROUP BY 1, 2, 3) GROUP BY 1, 2"""))(lambda t: tokens.font_families(faces(t)))

cte("kit", """
 SELECT site, 'e-gv-' || left(md5('kit:' || site || name), 7) AS gv_id, CASE WHEN h < 'c' THEN label ELSE 'renamed ' || label END AS label,
   token_type AS type, CASE WHEN h < '8' THEN '#123456' ELSE value END AS value, CASE WHEN h < '8' THEN '#123456' ELSE hex END AS hex, name AS ord
 FROM (SELECT *, left(md5(site || name), 1) AS h FROM cat) WHERE h >= '4'""")
cte("prevmap", "SELECT site, name, 'e-gv-prev' || left(md5(name), 3) AS gv_id FROM cat WHERE left(md5(name || 'prev'), 1) < '8'")
cte("resolved", """
 SELECT *, CASE WHEN hid IS NOT NULL THEN 'hex' WHEN lid IS NOT NULL THEN 'label' WHEN pid IS NOT NULL THEN 'existing' ELSE 'unmapped' END AS matched_by,
   coalesce(hid, lid, pid) AS gv_id FROM (
  SELECT c.site, c.name, c.token_type, c.value, c.hex,
   (SELECT arg_max(gv_id, ord) FROM kit k WHERE k.site = c.site AND k.hex = c.hex) AS hid,
   (SELECT arg_max(gv_id, ord) FROM kit k WHERE k.site = c.site AND k.label = c.label) AS lid,
   (SELECT max(gv_id) FROM prevmap p WHERE p.site = c.site AND p.name = c.name) AS pid FROM cat c)""")


def resolved(t: Tables):
    c = catalog_table(t)
    return tokens.token_resolve(c, design.design_vars(c), design.previous_mapping(c))


query("design_vars", ora("SELECT * FROM kit"))(lambda t: design.design_vars(catalog(t)))
query("token_resolve", ora("SELECT site, name, token_type, value, hex, gv_id, matched_by FROM resolved"))(resolved)
query("token_catalog_totals", ora("""
 SELECT site, token_type, count(*) AS tokens, count(gv_id) AS mapped, count(*) FILTER (gv_id IS NULL) AS unmapped FROM resolved GROUP BY 1, 2"""))(
    lambda t: tokens.catalog_totals(resolved(t)))
query("variables_plan", ora("""
 SELECT site, name, token_type, value, 'e-gv-' || left(md5('site:' || token_type || ':' || name), 7) AS planned_id
 FROM resolved WHERE gv_id IS NULL AND token_type IN ('color', 'font', 'size')"""))(lambda t: tokens.variables_plan(resolved(t)))
query("style_ref_match", ora("""
 SELECT *, CASE WHEN path IS NULL THEN 'unmapped' ELSE 'mapped' END AS status FROM (
  SELECT site, name, hex, (SELECT arg_max('/Colors/' || label, ord) FROM kit k WHERE k.site = c.site AND k.hex = c.hex) AS path FROM cat c WHERE hex IS NOT NULL)"""))(
    lambda t: (lambda c: tokens.style_ref_match(c, design.style_paths(design.design_vars(c))))(catalog_table(t)))


def kit_colors(c):
    return design.design_vars(c).filter("hex is not null and type = 'color'").select("site", "label", "hex")


query("color_crosscheck", ora("""
 SELECT site, label, hex, coalesce(p, q) AS css_property,
   CASE WHEN p IS NOT NULL THEN 'MATCH' WHEN q IS NOT NULL THEN 'MISMATCH' ELSE 'MISSING_IN_EXPORT' END AS result FROM (
  SELECT site, label, hex, (SELECT min(name) FROM cat c WHERE c.site = k.site AND c.hex = k.hex) AS p,
   (SELECT min(name) FROM cat c WHERE c.site = k.site AND contains(lower(c.name), regexp_replace(lower(k.label), '\\s+', '', 'g'))) AS q
  FROM kit k WHERE hex IS NOT NULL AND type = 'color')"""))(
    lambda t: (lambda c: tokens.color_crosscheck(kit_colors(c), c))(catalog_table(t)))
query("color_unmatched", ora("""
 SELECT site, name, value, hex FROM cat c WHERE hex IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM kit k WHERE k.site = c.site AND k.hex = c.hex AND k.type = 'color')"""))(
    lambda t: (lambda c: tokens.color_unmatched(c, kit_colors(c)))(catalog_table(t)))

_wn = "CASE {0} " + " ".join(f"WHEN {n} THEN '{v}'" for n, v in WEIGHT_NAMES.items()) + " ELSE {0}::VARCHAR END"
_wlower = "CASE lower(wn) " + " ".join(f"WHEN '{v.lower()}' THEN {n}" for n, v in WEIGHT_NAMES.items()) + " END"
cte("dfont", f"""
 SELECT DISTINCT site, selector, regexp_replace(replace(regexp_replace(substr(selector, 4), '-[^-]+$', ''), '-', ''), '([a-z])([A-Z])', '\\1 \\2', 'g') AS family, {_wlower}::BIGINT AS weight FROM (
  SELECT site, 'FR;' || replace(family, ' ', '') || '-' || {_wn.format('w2')} AS selector, {_wn.format('w2')} AS wn FROM (
   SELECT DISTINCT site, family, w, CASE WHEN left(md5(site || family), 1) >= 'c' THEN 900 ELSE w END AS w2 FROM sface))""")
cte("ffile", f"""
 SELECT DISTINCT site, lower(CASE WHEN h < '8' THEN b || '-' || {_wn.format('w')} || '.woff2' WHEN h < 'c' THEN b || '.woff' ELSE 'extra-' || b || '.ttf' END) AS file
 FROM (SELECT site, w, left(md5(family || site), 1) AS h, replace(family, ' ', '') AS b FROM sface)""")


def _expected(src: str) -> str:
    return f"""(SELECT site, family, weight, unnest(x) AS file, generate_subscripts(x, 1) AS rank FROM (
     SELECT *, list_transform(CASE WHEN weight = 400 THEN [n || '.woff2', n || '.woff', n || '.ttf', b || '.woff2', b || '.woff'] ELSE [n || '.woff2', n || '.woff', n || '.ttf'] END, lambda f: lower(f)) AS x
     FROM (SELECT site, family, weight, regexp_replace(family, '\\s+', '', 'g') AS b, regexp_replace(family, '\\s+', '', 'g') || '-' || {_wn.format('weight')} AS n FROM {src})))"""


cte("fhit", f"SELECT e.site, e.family, e.weight, arg_min(e.file, e.rank) AS found_as FROM {_expected('dfont')} e JOIN ffile f ON f.site = e.site AND f.file = e.file GROUP BY 1, 2, 3")
query("font_crosscheck", ora("""
 , d AS (SELECT DISTINCT site, family, weight FROM dfont),
 fc AS (SELECT site, lower(family) AS fam, w AS weight, arg_min(display, (page_id, pos)) AS disp FROM sface GROUP BY 1, 2, 3)
 SELECT d.site, d.family, d.weight, found_as, CASE WHEN found_as IS NULL THEN 'MISSING_IN_EXPORT' ELSE 'MATCH' END AS file_result,
  CASE WHEN disp IS NULL THEN 'MISSING_IN_CSS' ELSE 'MATCH' END AS css_result, coalesce(disp <> 'swap', false) AS swap_warning
 FROM d LEFT JOIN fhit USING (site, family, weight) LEFT JOIN fc ON fc.site = d.site AND fc.fam = lower(d.family) AND fc.weight = d.weight"""))(
    lambda t: (lambda f: tokens.font_crosscheck(design.design_fonts(f), design.font_files(f), f))(faces_table(t)))
query("font_unmatched", ora(f"SELECT site, file FROM ffile f WHERE NOT EXISTS (SELECT 1 FROM {_expected('dfont')} e WHERE e.site = f.site AND e.file = f.file)"))(
    lambda t: (lambda f: tokens.font_unmatched(design.design_fonts(f), design.font_files(f)))(faces_table(t)))
query("font_resolve", ora(f"""
 , b AS (SELECT site, family, weight, bool_or(s = 'c') AS in_css, bool_or(s = 'd') AS in_design FROM (
   SELECT site, family, w AS weight, 'c' AS s FROM sface UNION ALL SELECT site, family, weight, 'd' FROM dfont) GROUP BY 1, 2, 3),
 h AS (SELECT e.site, e.family, e.weight, arg_min(e.file, e.rank) AS local_file FROM {_expected('b')} e JOIN ffile f ON f.site = e.site AND f.file = e.file GROUP BY 1, 2, 3)
 SELECT site, family, weight, in_css, in_design, local_file, CASE WHEN local_file IS NULL THEN 'MISSING' ELSE 'RESOLVED' END AS status,
  CASE WHEN local_file IS NULL THEN 'https://fonts.googleapis.com/css2?family=' || replace(family, ' ', '+') || ':wght@' || weight || '&display=swap' END AS download_url
 FROM b LEFT JOIN h USING (site, family, weight)"""))(
    lambda t: (lambda f: tokens.font_resolve(design.design_fonts(f), design.font_files(f), f))(faces_table(t)))
query("breakpoint_crosscheck", ora("""
 , b AS (SELECT DISTINCT site, bp_max AS width_px FROM sdecl WHERE bp_max IS NOT NULL)
 SELECT site, name, expected_px, max(width_px) FILTER (abs(width_px - expected_px) <= 10) AS css_px,
  CASE WHEN max(width_px) FILTER (abs(width_px - expected_px) <= 10) IS NULL THEN 'MISSING_IN_EXPORT' ELSE 'MATCH' END AS result
 FROM b CROSS JOIN (SELECT 'tablet' AS name, 810::BIGINT AS expected_px UNION ALL SELECT 'mobile', 390) GROUP BY 1, 2, 3"""))(
    lambda t: tokens.breakpoint_crosscheck(sd(t).filter("bp_max is not null").select("site", F.col("bp_max").alias("width_px")).distinct()))
query("source_merge", ora("""
 SELECT site, name, gv_id, 'existing' AS origin FROM prevmap
 UNION ALL SELECT r.site, r.name, r.gv_id, 'live' FROM resolved r ANTI JOIN prevmap p USING (site, name)"""))(
    lambda t: (lambda c: tokens.source_merge(
        design.previous_mapping(c),
        tokens.token_resolve(c, design.design_vars(c), design.previous_mapping(c)).select("site", "name", "gv_id")))(catalog_table(t)))


def system(t: Tables):
    s = sd(t)
    styles = css.text_style_classes(s, carry=("site",)).groupBy("site", "name").agg(F.min_by("font_size", "page_id").alias("font_size"))
    return tokens.design_system_build(tokens.palette_totals(s), faces(t), styles)


cte("tstyle", """
 SELECT site, name, arg_min(fs, page_id) AS font_size FROM (
  SELECT page_id, substr(selector, 13) AS name, arg_max(value, o) FILTER (property = 'font-size') AS fs, arg_max(value, o) FILTER (property = 'font-family') AS ff
  FROM decl WHERE source = 'sheet' AND starts_with(selector, '.text-style-') AND at_rule = '' GROUP BY page_id, selector)
 JOIN page_site USING (page_id) WHERE fs IS NOT NULL OR ff IS NOT NULL GROUP BY 1, 2""")
cte("dsys", """
 SELECT site, 'color' AS kind, hex AS name, 'e-gv-' || left(md5('site:color:' || hex), 7) AS id, hex AS value FROM pal
 UNION ALL SELECT DISTINCT site, 'font', family, 'e-gv-' || left(md5('site:font:' || family), 7), family FROM sface
 UNION ALL SELECT site, 'class', name, 'gc-' || left(md5('site:gc:' || name), 12), font_size FROM tstyle
 UNION ALL SELECT site, 'background-class', 'bg-' || hex, 'gc-' || left(md5('site:gc:bg-' || hex), 12), hex FROM pal""")
query("design_system_build", ora("SELECT * FROM dsys"))(system)
query("design_id_collisions", ora("""
 SELECT id, count(DISTINCT (kind, name)) AS names, min(name) AS first_name FROM dsys GROUP BY 1 HAVING count(DISTINCT (kind, name)) > 1"""))(
    lambda t: tokens.id_collisions(system(t)))
query("near_colors", ora("""
 , c AS (SELECT site, hex, ('0x' || hex[2:3])::BIGINT AS r, ('0x' || hex[4:5])::BIGINT AS g, ('0x' || hex[6:7])::BIGINT AS b FROM pal)
 SELECT x.site, x.hex AS hex_a, y.hex AS hex_b, greatest(abs(x.r - y.r), abs(x.g - y.g), abs(x.b - y.b)) AS distance
 FROM c x JOIN c y ON x.site = y.site AND x.hex < y.hex WHERE greatest(abs(x.r - y.r), abs(x.g - y.g), abs(x.b - y.b)) <= 12"""))(
    lambda t: tokens.near_colors(tokens.palette_totals(sd(t))))


def _lin(s: str) -> str:
    v = f"(('0x' || {s})::BIGINT / 255.0::DOUBLE)"
    return f"(CASE WHEN {v} <= 0.03928 THEN {v} / 12.92::DOUBLE ELSE pow(({v} + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END)"


query("contrast_audit", ora(f"""
 SELECT *, CASE WHEN ratio >= 4.5 THEN 'PASS' WHEN ratio >= 3 THEN 'AA_LARGE' ELSE 'FAIL' END AS verdict FROM (
  SELECT site, hex, occurrences, round(1.05::DOUBLE / (0.2126::DOUBLE * {_lin('hex[2:3]')} + 0.7152::DOUBLE * {_lin('hex[4:5]')} + 0.0722::DOUBLE * {_lin('hex[6:7]')} + 0.05::DOUBLE), 2) AS ratio
  FROM (SELECT site, hex, count(*) AS occurrences FROM (SELECT *, {hexsql('val')} AS hex FROM cuse WHERE property = 'color' AND NOT regexp_matches(val, 'rgba\\s*\\(')) WHERE hex IS NOT NULL GROUP BY 1, 2))"""))(
    lambda t: audits.contrast_audit(tokens.color_palette(sd(t)).filter("property = 'color'").select("site", "hex", "occurrences")))
query("repeating_selectors", ora("""
 SELECT site, b AS base_name, count(*) AS selectors, sum(n)::BIGINT AS declarations FROM (
  SELECT site, selector, regexp_replace(selector, '[-\\d]+$', '') AS b, count(*) AS n FROM sdecl WHERE source = 'sheet' GROUP BY 1, 2)
 WHERE b <> '' GROUP BY 1, 2 HAVING count(*) >= 2"""))(lambda t: tokens.repeating_selectors(sd(t)))
query("run_reconcile", ora("""
 , e AS (SELECT site, count(*) AS expected FROM kit WHERE type = 'color' GROUP BY 1), a AS (SELECT site, count(*) AS actual FROM cat WHERE token_type = 'color' GROUP BY 1)
 SELECT site, expected, actual, CASE WHEN actual IS NULL THEN 'missing' WHEN expected IS NULL THEN 'unexpected' WHEN actual = expected THEN 'equal' ELSE 'different' END AS state
 FROM e FULL JOIN a USING (site)"""))(
    lambda t: (lambda c: tokens.reconcile(
        design.design_vars(c).filter("type = 'color'").groupBy("site").agg(F.count("*").alias("n")),
        c.filter("token_type = 'color'").groupBy("site").agg(F.count("*").alias("n")), ["site"]))(catalog_table(t)))
