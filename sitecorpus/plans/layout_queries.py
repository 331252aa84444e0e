"""Layout, graph and component queries over elements of the crawled and styled pages."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from sitecorpus.functions.dims import PRO_WIDGETS
from sitecorpus.operators import assets, graph, html, layout, tokens
from sitecorpus.plans import token_queries
from sitecorpus.plans.css_queries import hexsql, sp, trim
from sitecorpus.plans.asset_queries import _file, _type
from sitecorpus.plans.registry import CTES, Tables, cte, ora, query
from sitecorpus.plans.tree_queries import Trees
from sitecorpus.session import scratch_path, stage
from sitecorpus.sources import design, design_xml, layout as lsrc

# The element chain of page_queries again, over the styled pages.
for _n in ("tag_text", "tags", "leveled", "els"):
    _s = CTES[_n].replace("FROM pages", "FROM sp")
    for _m in ("tag_text", "tags", "leveled"):
        _s = _s.replace(f"FROM {_m}", f"FROM s_{_m}")
    cte(f"s_{_n}", _s)
cte("sels", "SELECT *, row_number() OVER (PARTITION BY page_id, parent_pos ORDER BY pos) AS ord FROM s_els")
cte("lnode", "SELECT page_id, pos, parent_pos, ord, depth, tag, text, " + ", ".join(f"({v})::VARCHAR AS {k}" for k, v in lsrc.LAYOUT_COLUMNS.items()) + " FROM sels")
cte("lchild", "SELECT page_id, parent_pos AS pos, count(*) AS children, count(DISTINCT nullif(regexp_replace(lower(name), '\\d+$', ''), '')) AS child_names FROM lnode WHERE parent_pos IS NOT NULL GROUP BY 1, 2")


PAGES_A_PART = 500  # that one task nests and writes as XML; some 0.13 MB of sorted rows a page


def nodes(t: Tables, parts: int | None = None):
    return lsrc.layout_nodes(html.element_rows(sp(t), parts))


def nodes_table(t: Tables):
    """The nodes as a written table: classification reads them as parents and as children."""
    return stage(nodes(t), "nodes")


_by_name = "CASE " + " ".join(
    f"WHEN contains(nm, '{w}') THEN " + (
        f"CASE WHEN href IS NULL AND nm NOT IN ('button', 'cta') THEN 'none' ELSE '{x}' END" if x == "e-button" else
        f"CASE WHEN src IS NULL AND background_image IS NULL THEN 'none' ELSE '{x}' END" if x == "e-image" else f"'{x}'")
    for w, x in layout.NAME_WIDGETS) + " ELSE 'none' END"
cte("wid", f"""
 SELECT *, CASE WHEN display = 'grid' OR grid_columns IS NOT NULL OR grid_rows IS NOT NULL THEN 'e-div-block' WHEN component_id IS NOT NULL OR component_name IS NOT NULL THEN 'e-component'
   WHEN bn <> 'none' THEN bn WHEN list_contains({list(layout.DRAWING_TAGS)}, tag) THEN 'e-svg'
   WHEN href IS NOT NULL OR contains(nm, 'button') OR contains(nm, 'cta') THEN 'e-button'
   WHEN length(text) > 0 THEN CASE WHEN regexp_matches(nm, '\\bh[1-6]\\b|heading') THEN 'e-heading' WHEN regexp_matches(nm, '\\bbody|paragraph|text|description|content') THEN 'e-paragraph' ELSE 'e-heading' END
   WHEN src IS NOT NULL OR background_image IS NOT NULL THEN 'e-image' WHEN (children >= 2 AND regexp_matches(nm, '\\b(grid|gallery|cards|stats|features|logos|columns)\\b')) OR (children >= 3 AND child_names <= 2) THEN 'e-div-block' ELSE 'e-flexbox' END AS widget,
  CASE WHEN regexp_matches(nm, '\\bh1\\b|heading.?1|title') THEN 'h1' {" ".join(f"WHEN regexp_matches(nm, '\\bh{i}\\b|heading.?{i}') THEN 'h{i}'" for i in range(2, 7))}
   WHEN regexp_matches(nm, 'paragraph|body|text') THEN 'p' ELSE 'h2' END AS html_tag FROM (
  SELECT *, {_by_name} AS bn FROM (
   SELECT n.*, lower(name) AS nm, coalesce(children, 0) AS children, coalesce(child_names, 0) AS child_names FROM lnode n LEFT JOIN lchild c USING (page_id, pos)))""")
query("widget_classify", ora("SELECT page_id, pos::BIGINT AS pos, tag, name, children, child_names, widget, html_tag FROM wid"))(
    lambda t: layout.widget_classify(nodes_table(t)).select("page_id", "pos", "tag", "name", "children", "child_names", "widget", "html_tag"))


def _num(x: str) -> str:
    return f"try_cast(regexp_extract({x}, '^(-?[\\d.]+)(?:px|%|em|rem|vw|vh)?$', 1) AS DOUBLE)"


def _unit(x: str) -> str:
    return f"CASE WHEN {_num(x)} IS NOT NULL THEN coalesce(nullif(regexp_extract({x}, '^-?[\\d.]+(px|%|em|rem|vw|vh)?$', 1), ''), 'px') END"


def _row(cond: str, prop: str, vtype: str, num: str = "NULL::DOUBLE", unit: str = "NULL::VARCHAR", text: str = "NULL::VARCHAR") -> str:
    return f"SELECT page_id, pos::BIGINT AS pos, widget, '{prop}' AS prop, '{vtype}' AS vtype, {num} AS num, {unit} AS unit, {text} AS text FROM wid WHERE {cond}"


_B, _F, _T = "widget IN ('e-div-block','e-flexbox','e-button')", "widget IN ('e-flexbox','e-button')", "widget IN ('e-heading','e-paragraph')"
def _side(x: str, pick: tuple) -> str:
    p = f"string_split({x}, ' ')"
    return f"{p}[CASE len({p}) WHEN 1 THEN {pick[0]} WHEN 2 THEN {pick[1]} WHEN 3 THEN {pick[2]} ELSE {pick[3]} END]"


_PICKS = {"top": (1, 1, 1, 1), "right": (1, 2, 2, 2), "bottom": (1, 1, 3, 3), "left": (1, 2, 2, 4)}
_S = "widget IN ('e-div-block','e-flexbox','e-button','e-image')"
_PLACED = "position IS NOT NULL AND (position <> 'absolute' OR coalesce(top_offset, right_offset, bottom_offset, left_offset) IS NOT NULL)"
_GRID = "coalesce(grid_columns, CASE WHEN grid_rows IS NULL THEN CASE WHEN children = 2 THEN '1fr 1fr' WHEN children = 3 THEN '1fr 1fr 1fr' WHEN children = 4 THEN '1fr 1fr 1fr 1fr' WHEN children > 4 THEN 'repeat(auto-fit, minmax(250px, 1fr))' END END)"


def _sized(cond: str, prop: str, x: str) -> str:
    return f"SELECT page_id, pos::BIGINT AS pos, widget, '{prop}' AS prop, CASE WHEN {_num(x)} IS NULL THEN 'string' ELSE 'size' END AS vtype, {_num(x)} AS num, {_unit(x)} AS unit, CASE WHEN {_num(x)} IS NULL THEN {x} END AS text FROM wid WHERE {cond}"


def _dimension(cond: str, prop: str, x: str) -> str:
    return _sized(f"{cond} AND regexp_matches({x}, '^-?[\\d.]+(px|%|em|rem|vw|vh)?$')", prop, x)


cte("lprop", " UNION ALL ".join([
    _row(f"{_F} AND stack_direction IS NOT NULL", "flex-direction", "string", text="CASE stack_direction WHEN 'vertical' THEN 'column' ELSE 'row' END"),
    _sized(f"{_B} AND stack_gap IS NOT NULL", "gap", "stack_gap"),
    *[_sized(f"{_B} AND padding IS NOT NULL", f"padding.{k}", _side("padding", _PICKS[s])) for s, k in layout.SIDES],
    *[_sized("border_radius IS NOT NULL", f"border-radius.{k}", _side("border_radius", _PICKS[s])) for s, k in layout.CORNERS],
    _dimension(_B, "max-width", "max_width"), _dimension(_S, "width", "width"), _dimension(_S, "height", "height"),
    _row(f"{_B} AND background IS NOT NULL", "background", "color", text=hexsql("background")),
    _sized(f"{_T} AND font_size IS NOT NULL", "font-size", "font_size"), _sized(f"{_T} AND letter_spacing IS NOT NULL", "letter-spacing", "letter_spacing"),
    _row(f"{_T} AND font_weight IS NOT NULL", "font-weight", "string", text="font_weight"),
    _row(f"{_T} AND font_family IS NOT NULL", "font-family", "string", text="regexp_replace(trim(split_part(font_family, ',', 1)), '[\"'']', '', 'g')"),
    _row(f"{_T} AND line_height IS NOT NULL", "line-height", "size", "CASE WHEN line_height LIKE '%\\%' ESCAPE '\\' THEN replace(line_height, '%', '')::DOUBLE / 100 ELSE replace(line_height, 'px', '')::DOUBLE END",
         "CASE WHEN line_height LIKE '%px' THEN 'px' ELSE 'custom' END"),
    _row(f"{_T} AND color IS NOT NULL", "color", "color", text=hexsql("color")),
    _row("opacity IS NOT NULL", "opacity", "size", "opacity::DOUBLE", "'custom'"),
    _row(_B, "display", "string", text=f"CASE WHEN {_F} THEN 'flex' WHEN {_GRID} IS NOT NULL THEN 'grid' ELSE 'block' END"),
    _row(f"widget = 'e-div-block' AND {_GRID} IS NOT NULL", "grid-template-columns", "string", text=_GRID),
    _row(_PLACED, "position", "string", text="position"),
    *[_sized(f"{_PLACED} AND {x}_offset IS NOT NULL", x, f"{x}_offset") for x in ("top", "right", "bottom", "left")],
]))
query("style_prop_rows", ora("SELECT * FROM lprop"))(lambda t: layout.style_prop_rows(layout.widget_classify(nodes_table(t))))


def xml_docs(t: Tables):
    """The pages' layout as XML files of many documents, read back. Parts are cut by pages, as several sorts of a part are in
    memory at once; bytes of a shuffle, by which Spark would join parts, are a small fraction of that."""
    path = scratch_path(t.spark, "layout-xml")
    parts = -(-t.table("pages").count() // PAGES_A_PART)
    design_xml.layout_xml(nodes(t, parts)).select("xml").write.text(path)
    return design_xml.read_layout_xml(t.spark, path).filter("sound")


def _nth(df):
    """Nodes by their place in the document: tag places differ between HTML and XML."""
    return df.withColumn("nth", F.row_number().over(W.partitionBy("page_id").orderBy("pos")))


def _xml_classified(t: Tables):
    return layout.widget_classify(stage(design_xml.xml_layout_nodes(xml_docs(t)), "xml-nodes"))


cte("lnth", "SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS nth FROM lnode")
query("src_tree_xml_nodes", ora(f"""
 SELECT c.page_id, c.nth, c.depth::BIGINT AS depth, c.ord, c.tag, trim(regexp_replace(c.text, '\\s+', ' ', 'g')) AS text, p.nth AS parent_nth, {" + ".join(f"(c.{x} IS NOT NULL)::BIGINT" for x in design_xml.NODE_ATTRIBUTES)} AS attributes
 FROM lnth c LEFT JOIN lnth p ON p.page_id = c.page_id AND p.pos = c.parent_pos"""))(
    lambda t: (lambda e: e.join(e.select("page_id", F.col("pos").alias("parent_pos"), F.col("nth").alias("parent_nth")), ["page_id", "parent_pos"], "left").select(
        "page_id", "nth", "depth", "ord", "tag", "text", "parent_nth", F.size("attributes").cast("bigint").alias("attributes")))(stage(_nth(design_xml.xml_elements(xml_docs(t))), "xml-elements")))
query("widget_classify_xml", ora("SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS nth, tag, name, children, child_names, widget, html_tag FROM wid"))(
    lambda t: _nth(_xml_classified(t)).select("page_id", "nth", "tag", "name", "children", "child_names", "widget", "html_tag"))
query("style_prop_rows_xml", ora("SELECT page_id, nth, widget, prop, vtype, num, unit, l.text FROM lprop l JOIN (SELECT page_id, pos, nth FROM lnth) USING (page_id, pos)"))(
    lambda t: layout.style_prop_rows(_nth(_xml_classified(t)).drop("pos").withColumnRenamed("nth", "pos")).withColumnRenamed("pos", "nth"))


cte("xref", """SELECT page_id, 6::BIGINT AS context_ix, 'mcp-xml:src' AS context, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS pos, regexp_extract(src, '^(?i)[^\"''\\s>]+', 0) AS url
  FROM lnode WHERE regexp_matches(src, '(?i)^https?://framerusercontent\\.com/[^\"''\\s>]+')""")
query("asset_references_xml", ora("SELECT * FROM xref"))(lambda t: assets.xml_asset_references(xml_docs(t)))


def _all_assets(t: Tables):
    xml = assets.xml_asset_references(xml_docs(t)).join(html.with_site(t.table("pages")).select("page_id", "site"), "page_id")
    x = Trees.of(t)
    tree = assets.tree_asset_references(x.elements, x.values).withColumn("site", F.lit("layout documents"))
    return assets.asset_manifest(sp(t), more=[tree, xml])


query("asset_manifest_all", ora(f"""
 , r AS (SELECT site, 0 AS source, page_id::VARCHAR AS page_id, context_ix, context, pos, aref.url AS url FROM aref JOIN page_site USING (page_id)
  UNION ALL SELECT 'layout documents', 1, page_id, context_ix, context, pos, url FROM tref UNION ALL SELECT site, 2, page_id::VARCHAR, context_ix, context, pos, xref.url FROM xref JOIN page_site USING (page_id))
 SELECT site, url, uses, contexts, type, filename, coalesce(nullif(lower(regexp_extract(filename, '\\.([^.]+)$', 1)), ''), 'unknown') AS extension FROM (
  SELECT *, {_type('url')} AS type, {_file('url')} AS filename FROM (
  SELECT site, arg_min(url, (source, page_id, context_ix, pos)) AS url, count(*) AS uses, string_agg(DISTINCT context, ',' ORDER BY context) AS contexts FROM r GROUP BY site, lower(r.url)))"""))(
    lambda t: _all_assets(t).drop("folder"))


def _named_colors(t: Tables):
    """The kit's colours as ColorStyle and Color elements, read back."""
    path = scratch_path(t.spark, "color-xml")
    kit = design.design_vars(stage(tokens.token_catalog(token_queries.sd(t)), "catalog")).filter("hex is not null")
    named = kit.groupBy(F.concat_ws("/", "site", "label").alias("name")).agg(F.max("hex").alias("value"))
    style = F.substring(F.md5("name"), 1, 1) < "9"
    design_xml.style_xml(named.filter(style), "ColorStyle").write.mode("append").text(path)
    design_xml.style_xml(named.withColumnRenamed("value", "hex"), "Color").write.mode("append").text(path)
    return design_xml.named_colors(t.spark, path)


query("src_color_styles", ora("""
 SELECT site || '/' || label AS name, max(hex) AS value, CASE WHEN left(md5(site || '/' || label), 1) < '9' THEN 'ColorStyle' ELSE 'Color' END AS tag FROM kit WHERE hex IS NOT NULL GROUP BY site || '/' || label"""))(_named_colors)
query("component_text", ora("""
 , a AS (SELECT page_id, pos, component_id, 1 AS ix, 'caption' AS attr, trim(caption) AS v FROM lnode WHERE component_id IS NOT NULL OR variant IS NOT NULL
  UNION ALL SELECT page_id, pos, component_id, 4, 'src', trim(src) FROM lnode WHERE component_id IS NOT NULL OR variant IS NOT NULL
  UNION ALL SELECT page_id, pos, component_id, 5, 'text', trim(text) FROM lnode WHERE component_id IS NOT NULL OR variant IS NOT NULL)
 SELECT page_id, pos::BIGINT AS pos, component_id, attr, v AS text FROM (SELECT *, row_number() OVER (PARTITION BY page_id, pos ORDER BY length(v) DESC, ix) AS rn FROM a
  WHERE length(v) >= 3 AND v NOT IN ('true', 'false') AND NOT regexp_matches(v, '^(http|/|#)') AND NOT regexp_matches(v, '^-?\\d*\\.?\\d+$') AND NOT regexp_matches(v, '^[a-zA-Z0-9_-]{8,15}$')
   AND NOT contains(v, '/>') AND NOT contains(v, '</') AND NOT regexp_matches(v, '[A-Za-z0-9_]+="[^"]*"')) WHERE rn = 1"""))(lambda t: layout.component_text(nodes(t)))
_pro = "CASE " + " ".join(f"WHEN contains(n, '{k}') THEN {i}" for i, (k, _, _) in enumerate(PRO_WIDGETS, 1)) + " END"
query("pro_feature_detect", ora(f"""
 SELECT page_id, pos::BIGINT AS pos, name, ({[k for k, _, _ in PRO_WIDGETS]})[ix] AS feature, ({str([s for _, s, _ in PRO_WIDGETS]).replace('None', 'NULL')})[ix] AS stand_in, ({[str(g).lower() for _, _, g in PRO_WIDGETS]})[ix]::BOOLEAN AS graceful
 FROM (SELECT *, {_pro} AS ix FROM (SELECT *, regexp_replace(lower(trim(name)), '[\\s_-]+', '-', 'g') AS n FROM lnode)) WHERE ix IS NOT NULL"""))(lambda t: layout.pro_feature_detect(nodes(t)))
cte("tst", "SELECT " + ", ".join(lsrc.TEXT_STYLE_COLUMNS) + " FROM (SELECT site, unnest(range(0, 4)) AS n FROM (SELECT DISTINCT site FROM page_site))")
cte("tfb", """
 SELECT site, role, name, font_size, font_weight, color, font_family, px FROM (SELECT *, replace(font_size, 'px', '')::DOUBLE AS px, row_number() OVER (PARTITION BY site ORDER BY replace(font_size, 'px', '')::DOUBLE, name) AS rn,
   count(*) OVER (PARTITION BY site) AS n FROM tst) JOIN (SELECT unnest(['heading', 'body', 'other']) AS role) ON (role = 'heading' AND rn = n) OR (role = 'body' AND rn = 1) OR (role = 'other' AND rn = n // 2 + 1)""")


def sited(t: Tables, df):
    return df.join(html.with_site(t.table("pages")).select("page_id", "site"), "page_id")


def styles(t: Tables):
    return lsrc.text_styles(html.with_site(t.table("pages")))


query("top_fallback_style", ora("SELECT * FROM tfb"))(lambda t: layout.top_fallback_style(styles(t)))
query("inline_style_fill", ora(f"""
 , x AS (SELECT w.*, site, CASE WHEN widget = 'e-heading' OR regexp_matches(nm, 'heading|title|h[1-6]|display|hero|header') THEN 'heading'
    WHEN widget = 'e-paragraph' OR regexp_matches(nm, 'body|text|para|caption|label|note|small') THEN 'body' ELSE 'other' END AS role FROM wid w JOIN page_site USING (page_id) WHERE {_T}),
 y AS (SELECT x.*, s.font_size AS sfs, s.font_weight AS sfw, s.color AS sco, s.font_family AS sff, f.font_size AS rfs, f.font_weight AS rfw, f.color AS rco, f.font_family AS rff,
   x.font_size IS NULL AND x.color IS NULL AND s.font_size IS NULL AS bare FROM x LEFT JOIN tst s ON s.site = x.site AND s.name = x.text_style LEFT JOIN tfb f ON f.site = x.site AND f.role = x.role),
 z AS (SELECT *, coalesce(font_size, sfs, CASE WHEN bare THEN coalesce(rfs, CASE widget WHEN 'e-heading' THEN '32px' ELSE '16px' END) END) AS fs,
   coalesce(sfw, CASE WHEN bare THEN coalesce(rfw, CASE widget WHEN 'e-heading' THEN '600' END) END) AS fw,
   coalesce(color, sco, CASE WHEN bare THEN coalesce(rco, CASE widget WHEN 'e-heading' THEN '#111111' ELSE '#444444' END) END) AS co,
   coalesce(sff, CASE WHEN bare THEN coalesce(rff, 'Inter') END) AS fa FROM y)
 SELECT page_id, pos::BIGINT AS pos, widget, role, fs AS font_size, fw AS font_weight, {hexsql('co')} AS color, {trim("regexp_replace(split_part(fa, ',', 1), '[\"'']', '', 'g')")} AS font_family,
  CASE WHEN NOT bare THEN CASE WHEN sfs IS NOT NULL THEN 'style' ELSE 'inline' END WHEN rfs IS NOT NULL THEN 'role' ELSE 'constant' END AS source FROM z"""))(
    lambda t: layout.inline_style_fill(sited(t, layout.widget_classify(nodes_table(t))), styles(t)))
query("unique_ids", ora("""
 SELECT page_id, pos::BIGINT AS pos, base, n, uid, count(*) OVER (PARTITION BY page_id, uid) > 1 AS collides FROM (
  SELECT *, CASE n WHEN 1 THEN base ELSE base || '-' || n END AS uid FROM (SELECT page_id, pos, base, row_number() OVER (PARTITION BY page_id, base ORDER BY pos) AS n FROM (
   SELECT page_id, pos, coalesce(nullif(left(regexp_replace(regexp_replace(regexp_replace(lower(name), '[^a-z0-9]', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g'), 20), ''), 'node') AS base FROM lnode)))"""))(
    lambda t: layout.unique_ids(nodes(t)))


def _substituted(t: Tables):
    kit = stage(tokens.token_catalog(token_queries.sd(t)), "catalog")
    props = sited(t, layout.style_prop_rows(layout.widget_classify(nodes_table(t))))
    return layout.gv_substitute(props, design.design_vars(kit))


cte("kitcol", """
 SELECT site, 'color' AS kind, hex AS key, arg_max(gv_id, ord) AS gv FROM kit WHERE hex IS NOT NULL GROUP BY 1, 2, 3
 UNION ALL SELECT site, 'font', trim(lower(regexp_replace(value, '["'']', '', 'g'))), arg_max(gv_id, ord) FROM kit WHERE type = 'font' AND value IS NOT NULL GROUP BY 1, 2, 3""")
cte("lkeyed", """
 SELECT l.*, p.site, CASE WHEN vtype = 'color' THEN 'color' WHEN prop = 'font-family' AND vtype = 'string' THEN 'font' END AS kind,
  CASE WHEN vtype = 'color' THEN text WHEN prop = 'font-family' AND vtype = 'string' THEN trim(lower(regexp_replace(text, '["'']', '', 'g'))) END AS key
 FROM lprop l JOIN page_site p USING (page_id)""")
query("gv_substitute", ora("""
 SELECT x.site, page_id, pos, prop, CASE WHEN gv IS NOT NULL THEN 'global-' || x.kind || '-variable' ELSE vtype END AS vtype, CASE WHEN gv IS NULL THEN text END AS text, gv AS ref_id, gv IS NOT NULL AS substituted
 FROM lkeyed x LEFT JOIN kitcol k ON k.site = x.site AND k.kind = x.kind AND k.key = x.key AND x.key <> ''"""))(_substituted)
query("gv_coverage", ora("""
 SELECT x.site, count(*) FILTER (x.kind = 'color') AS colors, count(*) FILTER (x.kind = 'font') AS families, count(gv) AS substituted
 FROM lkeyed x LEFT JOIN kitcol k ON k.site = x.site AND k.kind = x.kind AND k.key = x.key AND x.key <> '' GROUP BY 1"""))(
    lambda t: _substituted(t).groupBy("site").agg(
        F.count(F.when(F.col("vtype").isin("color", "global-color-variable"), 1)).alias("colors"), F.count(F.when(F.col("prop") == "font-family", 1)).alias("families"),
        F.count(F.when(F.col("substituted"), 1)).alias("substituted")))

# --- graphs -------------------------------------------------------------------------------------------------


def overlap_issues(t: Tables):
    """Overlap reports between neighbouring siblings, as an audit writes them; which pairs overlap is a hash."""
    e = html.element_rows(t.table("pages")).select("page_id", "parent_pos", "ord", "pos", "tag")
    nxt = e.select("page_id", "parent_pos", (F.col("ord") - 1).alias("ord"), F.col("pos").alias("pos2"), F.col("tag").alias("tag2"))
    j = e.join(nxt, ["page_id", "parent_pos", "ord"])
    hit = F.substring(F.md5(F.concat_ws("-", "page_id", "pos")), 1, 1) < "a"
    msg = F.concat(F.col("tag"), F.lit("#n"), "pos", F.lit(" overlaps "), "tag2", F.lit("#n"), "pos2")
    return j.select("page_id", F.when(hit, msg).otherwise(F.concat(F.lit("low contrast at n"), "pos")).alias("message"))


cte("el_ord", "SELECT *, row_number() OVER (PARTITION BY page_id, parent_pos ORDER BY pos) AS ord FROM els")
cte("oissue", """
 SELECT a.page_id, a.pos, b.pos AS pos2, a.tag, b.tag AS tag2, left(md5(a.page_id || '-' || a.pos), 1) < 'a' AS hit FROM el_ord a JOIN el_ord b
  ON b.page_id = a.page_id AND b.parent_pos = a.parent_pos AND b.ord = a.ord + 1""")
# Overlap chains run along siblings, so a component starts where the link from the previous sibling is missing.
cte("ocomp", """
 SELECT page_id, pos, tag, grp FROM (SELECT *, sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY page_id, parent_pos ORDER BY ord) AS grp0, page_id || '/' || parent_pos || '/' AS k FROM (
   SELECT e.*, EXISTS (SELECT 1 FROM oissue o WHERE o.page_id = e.page_id AND o.pos2 = e.pos AND o.hit) AS linked FROM el_ord e WHERE parent_pos IS NOT NULL)), LATERAL (SELECT k || grp0 AS grp)""")
cte("ogroup", """
 SELECT page_id, min('n' || pos) AS group_id, count(*) AS elements, count(*) * (count(*) - 1) // 2 AS pair_count, count(*) - 1 AS observed_pairs, string_agg(DISTINCT tag, ',' ORDER BY tag) AS types
 FROM ocomp GROUP BY page_id, grp HAVING count(*) > 1""")
query("overlap_groups", ora("SELECT * FROM ogroup"))(lambda t: graph.overlap_groups(stage(overlap_issues(t), "issues")))
query("overlap_noise_reduction", ora("""
 , b AS (SELECT page_id, count(*) AS issues FROM oissue GROUP BY 1), a AS (SELECT page_id, count(*) AS g, sum(observed_pairs) AS m FROM ogroup GROUP BY 1)
 SELECT page_id, issues, (issues - coalesce(m, 0) + coalesce(g, 0))::BIGINT AS after, floor((coalesce(m, 0) - coalesce(g, 0)) * 100 / issues + 0.5)::BIGINT AS reduction_pct FROM b LEFT JOIN a USING (page_id)"""))(
    lambda t: (lambda i: graph.noise_reduction(i, graph.overlap_groups(i)))(stage(overlap_issues(t), "issues")))

# Elements that count as components, named by tag and depth (deep ones share a name, which makes cycles).
COMPONENT_TAGS = ("nav", "ul", "li", "article", "p", "b", "footer", "div", "body", "html")
_ct = ", ".join(f"'{x}'" for x in COMPONENT_TAGS)
_COMPONENT = f"CASE WHEN tag IN ({_ct}) THEN concat(tag, '-', depth) END"
_TAG_COMPONENT = f"CASE WHEN tag IN ({_ct}) THEN tag END"  # one name at all depths: lists in lists need each other


def component_nodes(t: Tables, component: str = _COMPONENT):
    # Chosen before they are written, so that attributes and texts are neither dealt out nor sorted.
    e = html.element_rows(t.table("pages"))
    return stage(e.select("page_id", F.col("pos").alias("node"), F.col("parent_pos").alias("parent"), F.expr(component).alias("component")), "elements")


def component_graph(t: Tables, component: str = _COMPONENT):
    return graph.dependency_edges(component_nodes(t, component), html.with_site(t.table("pages")).select("page_id", "site"))


_anc = f"""
 , cn AS (SELECT page_id, pos AS node, parent_pos AS parent, {_COMPONENT} AS c FROM els),
 up AS (SELECT page_id, node, parent AS a FROM cn WHERE c IS NOT NULL
   UNION ALL SELECT u.page_id, u.node, p.parent FROM up u JOIN cn p ON p.page_id = u.page_id AND p.node = u.a AND p.c IS NULL),
 dep AS (SELECT DISTINCT s.site AS graph_id, p.c AS src, n.c AS dst FROM up u JOIN cn p ON p.page_id = u.page_id AND p.node = u.a AND p.c IS NOT NULL
   JOIN cn n ON n.page_id = u.page_id AND n.node = u.node JOIN page_site s ON s.page_id = u.page_id)"""
query("dependency_edges", ora(_anc + " SELECT * FROM dep").replace("WITH ", "WITH RECURSIVE ", 1))(component_graph)
query("build_order_layers", ora(_anc + """
 , nd AS (SELECT graph_id, src AS node FROM dep UNION SELECT graph_id, dst FROM dep),
 rch AS (SELECT graph_id, src, dst FROM dep UNION SELECT r.graph_id, r.src, d.dst FROM rch r JOIN dep d ON d.graph_id = r.graph_id AND d.src = r.dst),
 bad AS (SELECT DISTINCT graph_id, n AS node FROM (SELECT r.graph_id, r.src AS n FROM rch r JOIN rch c ON c.graph_id = r.graph_id AND c.src = r.dst AND c.dst = r.dst
   UNION SELECT graph_id, src FROM rch WHERE src = dst)),
 pth AS (SELECT graph_id, node, 1 AS layer FROM nd ANTI JOIN bad USING (graph_id, node)
   UNION SELECT p.graph_id, d.src, p.layer + 1 FROM pth p JOIN dep d ON d.graph_id = p.graph_id AND d.dst = p.node ANTI JOIN bad b ON b.graph_id = d.graph_id AND b.node = d.src)
 SELECT n.graph_id, n.node, (SELECT max(layer) FROM pth p WHERE p.graph_id = n.graph_id AND p.node = n.node)::BIGINT AS layer FROM nd n""").replace("WITH ", "WITH RECURSIVE ", 1))(
    lambda t: graph.build_order_layers(component_graph(t)))

_RCH = """
 , nd AS (SELECT graph_id, src AS node FROM dep UNION SELECT graph_id, dst FROM dep),
 rch AS (SELECT graph_id, src, dst FROM dep UNION SELECT r.graph_id, r.src, d.dst FROM rch r JOIN dep d ON d.graph_id = r.graph_id AND d.src = r.dst),
 mut AS (SELECT a.graph_id, a.src AS node, a.dst AS other FROM rch a JOIN rch b ON b.graph_id = a.graph_id AND b.src = a.dst AND b.dst = a.src),
 scc AS (SELECT n.graph_id, n.node, coalesce(min(least(m.other, n.node)), n.node) AS component, greatest(count(DISTINCT m.other), 1) AS members, count(m.other) > 0 AS cyclic
   FROM nd n LEFT JOIN mut m ON m.graph_id = n.graph_id AND m.node = n.node GROUP BY n.graph_id, n.node),
 cdep AS (SELECT DISTINCT d.graph_id, a.component AS src, b.component AS dst FROM dep d JOIN scc a ON a.graph_id = d.graph_id AND a.node = d.src JOIN scc b ON b.graph_id = d.graph_id AND b.node = d.dst WHERE a.component <> b.component),
 pth AS (SELECT DISTINCT graph_id, component, 1 AS layer FROM scc UNION SELECT p.graph_id, c.src, p.layer + 1 FROM pth p JOIN cdep c ON c.graph_id = p.graph_id AND c.dst = p.component)
 SELECT graph_id, node, component, members, cyclic, max(layer)::BIGINT AS layer FROM scc JOIN pth USING (graph_id, component) GROUP BY ALL"""
query("build_order", ora(_anc.replace(_COMPONENT, _TAG_COMPONENT) + _RCH).replace("WITH ", "WITH RECURSIVE ", 1))(lambda t: graph.build_order(component_graph(t, _TAG_COMPONENT)))

_PASS = "tag IN ('html', 'body', 'div', 'section', 'nav', 'ul', 'article') AND kids = 1 AND coalesce(trim(attrs), '') = ''"


def _pass_nodes(t: Tables):
    e = stage(html.element_rows(t.table("pages")), "elements")
    kids = e.groupBy("page_id", F.col("parent_pos").alias("pos")).agg(F.count("*").alias("kids"))
    j = e.join(kids.filter("pos is not null"), ["page_id", "pos"], "left")
    return j.select("page_id", F.col("pos").alias("node"), F.col("parent_pos").alias("parent"), F.expr(f"coalesce({_PASS}, false)").alias("pass_through"))


query("pass_through_collapse", ora(f"""
 , pn AS (SELECT e.page_id, e.pos AS node, e.parent_pos AS parent, coalesce({_PASS}, false) AS p FROM els e LEFT JOIN kids k ON k.page_id = e.page_id AND k.parent_pos = e.pos),
 up AS (SELECT page_id, node, parent AS a FROM pn WHERE NOT p
   UNION ALL SELECT u.page_id, u.node, x.parent FROM up u JOIN pn x ON x.page_id = u.page_id AND x.node = u.a AND x.p)
 SELECT u.page_id, u.node::BIGINT AS node, u.a::BIGINT AS new_parent FROM up u LEFT JOIN pn x ON x.page_id = u.page_id AND x.node = u.a WHERE u.a IS NULL OR NOT x.p"""
 .replace("coalesce(trim(attrs)", "coalesce(trim(e.attrs)")).replace("WITH ", "WITH RECURSIVE ", 1))(lambda t: graph.pass_through_collapse(_pass_nodes(t)))


# Components of the crawl: list items, navigations and footers, defined by their first occurrence.
def _expanded(t: Tables):
    e = stage(html.element_rows(t.table("pages")), "elements")
    names = F.regexp_extract_all("attrs", F.lit(r'([A-Za-z-]+)="([^"]*)"'), F.lit(1))
    vals = F.regexp_extract_all("attrs", F.lit(r'([A-Za-z-]+)="([^"]*)"'), F.lit(2))
    pairs = F.filter(F.arrays_zip(names.alias("k"), vals.alias("v")), lambda x, i: F.array_position(names, x["k"]) == i + 1)
    e = e.withColumn("amap", F.map_from_entries(F.transform(pairs, lambda x: F.struct(x["k"], x["v"]))))
    inst = e.filter(F.col("tag").isin("li", "nav", "footer", "article")).select(
        "page_id", F.col("pos").alias("node"), F.col("tag").alias("component_id"), F.map_concat(F.create_map(F.lit("data-instance"), F.col("pos").cast("string")), "amap").alias("attrs"))
    firsts = e.filter(F.col("tag").isin("li", "nav", "footer")).groupBy(F.col("tag").alias("component_id")).agg(F.min(F.struct("page_id", "pos", "depth")).alias("f"))
    firsts = firsts.select("component_id", F.col("f.page_id").alias("page_id"), F.col("f.pos").alias("start"), F.col("f.depth").alias("base"))
    sizes = html.subtree_counts(t.table("pages")).select("page_id", F.col("pos").alias("start"), "descendants")
    firsts = firsts.join(sizes, ["page_id", "start"])
    ranked = e.join(firsts, "page_id").filter("pos >= start")
    inside = ranked.groupBy("component_id", "pos").agg(F.first("tag").alias("tag"), (F.first("depth") - F.first("base")).alias("depth"), F.first("amap").alias("attrs"), F.first("start").alias("start"), F.first("descendants").alias("d"))
    inside = inside.withColumn("def_pos", F.row_number().over(W.partitionBy("component_id").orderBy("pos")) - 1).filter("def_pos <= d")
    return graph.component_expand(inst, inside.select("component_id", "def_pos", "depth", "tag", "attrs"))


_am = "list_sort(list_distinct(regexp_extract_all(attrs, '[A-Za-z-]+=\"[^\"]*\"')))"
query("component_expand", ora(f"""
 , fst AS (SELECT tag AS component_id, min((page_id, pos)) AS f FROM els WHERE tag IN ('li', 'nav', 'footer') GROUP BY 1),
 sub AS (SELECT component_id, e.page_id, e.pos, 0 AS depth FROM fst JOIN els e ON (e.page_id, e.pos) = f
   UNION ALL SELECT s.component_id, e.page_id, e.pos, s.depth + 1 FROM sub s JOIN els e ON e.page_id = s.page_id AND e.parent_pos = s.pos),
 d AS (SELECT s.component_id, s.depth, e.tag, e.attrs, row_number() OVER (PARTITION BY s.component_id ORDER BY s.pos) - 1 AS dp FROM sub s JOIN els e ON e.page_id = s.page_id AND e.pos = s.pos)
 SELECT i.page_id, i.pos::BIGINT AS node, i.tag AS component_id, i.pos || '-' || coalesce(dp, 0) AS new_id, d.tag AS tag, coalesce(d.depth, 0)::BIGINT AS depth, d.dp IS NOT NULL AS expanded
 FROM els i LEFT JOIN d ON d.component_id = i.tag WHERE i.tag IN ('li', 'nav', 'footer', 'article')""").replace("WITH ", "WITH RECURSIVE ", 1))(lambda t: _expanded(t).drop("attrs"))
