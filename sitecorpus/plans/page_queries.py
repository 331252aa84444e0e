"""Queries over the crawled `pages` table."""

from __future__ import annotations

from sitecorpus.functions.dims import STRIP_RULES, VOID_TAGS
from sitecorpus.operators import audits, html, links
from sitecorpus.plans.registry import cte, ora, query
from sitecorpus.session import stage

_void = ",".join(f"'{t}'" for t in VOID_TAGS)

cte("page_site", "SELECT page_id, url, html, regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\\.', '') AS site FROM pages")
# The same token pattern, said without look-ahead.
_attrs = """(?:[^>"'']*(?:(?:"[^"]*"|''[^'']*'')[^>"'']*)*|[^>]*)"""
cte("tag_text", f"""
 SELECT page_id, unnest(a) AS tok, generate_subscripts(a, 1) - 1 AS pos FROM (
  SELECT page_id, regexp_extract_all(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?s)<!\\[CDATA\\[(.*?)\\]\\]>', '\\1', 'g'),
      '(?is)<script([^>]*)>.*?</script>', '<script\\1></script>', 'g'),
      '(?is)<style([^>]*)>.*?</style>', '<style\\1></style>', 'g'),
    '<[/]?[A-Za-z]{_attrs}>[^<]*(?:<(?:[^/A-Za-z<]|/[^A-Za-z<])[^<]*)*') AS a FROM pages)""")
cte("tags", f"""
 SELECT page_id, pos, tag, attrs, text,
   CASE WHEN slash = '/' THEN 'close' WHEN attrs LIKE '%/' OR tag IN ({_void}) THEN 'self' ELSE 'open' END AS kind
 FROM (SELECT page_id, pos, regexp_extract(tok, '^<(/?)', 1) AS slash,
   lower(regexp_extract(tok, '^</?([A-Za-z][A-Za-z0-9-]*)', 1)) AS tag,
   regexp_extract(tok, '^</?[A-Za-z][A-Za-z0-9-]*({_attrs})>', 1) AS attrs,
   regexp_replace(regexp_replace(tok, '^<{_attrs}>', ''), '^\\s+|\\s+$', '', 'g') AS text FROM tag_text)""")
cte("leveled", """
 SELECT *, after + CASE WHEN kind = 'open' THEN 0 ELSE 1 END AS level FROM (
  SELECT *, run - least(0, min(run) OVER w) AS after FROM (
   SELECT *, sum(CASE kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END) OVER w AS run
   FROM tags WINDOW w AS (PARTITION BY page_id ORDER BY pos))
  WINDOW w AS (PARTITION BY page_id ORDER BY pos))""")
cte("els", """
 SELECT e.page_id, e.pos, p.pos AS parent_pos, e.level - 1 AS depth, e.kind, e.tag, e.attrs,
   CASE WHEN e.kind = 'open' AND e.nk = 'close' THEN e.text ELSE '' END AS text
 FROM (SELECT * FROM (SELECT *, lead(kind) OVER (PARTITION BY page_id ORDER BY pos) AS nk FROM leveled)
       WHERE kind <> 'close') e
 ASOF LEFT JOIN (SELECT page_id, pos, level + 1 AS child_level FROM leveled WHERE kind = 'open') p
   ON e.page_id = p.page_id AND e.level = p.child_level AND e.pos > p.pos""")

query("src_pages", ora("SELECT page_id, url, site, length(html) AS html_chars FROM page_site"))(
    lambda t: html.with_site(t.table("pages")).selectExpr("page_id", "url", "site", "length(html) AS html_chars")
)

query("html_tokens", ora("SELECT page_id, pos::BIGINT AS pos, kind, tag, attrs, text FROM tags"))(
    lambda t: html.html_tokens(t.table("pages"))
)

query("element_rows", ora("""
 SELECT page_id, pos::BIGINT AS pos, parent_pos::BIGINT AS parent_pos,
   row_number() OVER (PARTITION BY page_id, parent_pos ORDER BY pos) AS ord,
   depth::BIGINT AS depth, kind, tag, attrs, text FROM els"""))(lambda t: html.element_rows(t.table("pages")))

query("dom_depth", ora("""
 , d AS (SELECT page_id, pos, tag, level FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY level DESC, pos) AS rn
   FROM leveled WHERE kind <> 'close') WHERE rn = 1),
 up AS (SELECT page_id, pos, tag, depth, parent_pos FROM els SEMI JOIN d USING (page_id, pos)
   UNION ALL SELECT e.page_id, e.pos, e.tag, e.depth, e.parent_pos FROM up JOIN els e ON e.page_id = up.page_id AND e.pos = up.parent_pos)
 SELECT page_id, max(depth)::BIGINT AS max_depth, string_agg(tag, '/' ORDER BY depth) AS deepest_path,
   any_value(n.elements) AS elements,
   CASE WHEN max(depth) >= 6 THEN 'error' WHEN max(depth) >= 4 THEN 'warning' ELSE 'ok' END AS status
 FROM up JOIN (SELECT page_id, count(*) AS elements FROM els GROUP BY 1) n USING (page_id) GROUP BY page_id"""
 ).replace("WITH ", "WITH RECURSIVE ", 1))(lambda t: html.dom_depth(t.table("pages")))

query("subtree_counts", ora("""
 , walk AS (SELECT page_id, pos AS anc, pos FROM els
   UNION ALL SELECT w.page_id, w.anc, e.pos FROM walk w JOIN els e ON e.page_id = w.page_id AND e.parent_pos = w.pos)
 SELECT w.page_id, w.anc::BIGINT AS pos, e.tag, count(*) - 1 AS descendants
 FROM walk w JOIN els e ON e.page_id = w.page_id AND e.pos = w.anc GROUP BY ALL"""
 ).replace("WITH ", "WITH RECURSIVE ", 1))(lambda t: html.subtree_counts(t.table("pages")))

query("page_inventory", ora("""
 SELECT page_id, count(*) AS elements,
   count(*) FILTER (tag IN ('div','section','main','header','footer','nav','article','aside','ul','ol')) AS containers,
   count(*) FILTER (tag = 'style') AS css_blocks, count(*) FILTER (tag = 'script') AS scripts,
   count(*) FILTER (tag = 'img') AS images,
   count(*) FILTER (tag = 'a' AND regexp_matches(attrs, '(?i)\\shref\\s*=')) AS links,
   count(*) FILTER (tag = 'form') AS forms, count(*) FILTER (regexp_matches(tag, '^h[1-6]$')) AS headings
 FROM tags WHERE kind <> 'close' GROUP BY page_id"""))(lambda t: html.page_inventory(t.table("pages")))

query("page_text_summary", ora("""
 , b AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM (
   SELECT page_id, pos, tag, regexp_replace(regexp_replace(text, '[\\s\\x{00A0}]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS text FROM tags)
   WHERE length(text) > 20 AND tag NOT IN ('title', 'script', 'style')),
 j AS (SELECT page_id, string_agg(text, ' ' ORDER BY rn) AS t, count(*) AS blocks FROM b WHERE rn <= 3 GROUP BY 1)
 SELECT page_id, left(regexp_replace(regexp_extract(html, '(?i)<title[^>]*>([^<]*)</title>', 1), '^\\s+|\\s+$', '', 'g'), 60) AS title,
   CASE WHEN length(t) > 155 THEN regexp_replace(left(t, 155), '\\s+\\S*$', '') || '…' ELSE t END AS description,
   coalesce(blocks, 0) AS blocks
 FROM pages LEFT JOIN j USING (page_id)"""))(lambda t: html.page_text_summary(t.table("pages")))

cte("kids", "SELECT page_id, parent_pos, count(*) AS kids FROM els WHERE parent_pos IS NOT NULL GROUP BY 1, 2")
cte("sigs", """
 SELECT e.page_id, e.parent_pos, count(*) AS n_children,
   md5(string_agg(e.tag || '|' || coalesce(k.kids, 0), '::' ORDER BY e.pos)) AS struct_hash
 FROM els e LEFT JOIN kids k ON k.page_id = e.page_id AND k.parent_pos = e.pos
 WHERE e.parent_pos IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2""")
query("component_candidates", ora("""
 , s AS (SELECT s.*, p.site FROM sigs s JOIN page_site p USING (page_id))
 SELECT 'page' AS scope, page_id::VARCHAR AS scope_key, struct_hash, n_children, count(*) AS occurrences, 1::BIGINT AS pages
 FROM s GROUP BY ALL HAVING count(*) >= 2
 UNION ALL SELECT 'site', site, struct_hash, n_children, count(*), count(DISTINCT page_id) FROM s GROUP BY ALL HAVING count(*) >= 2
 UNION ALL SELECT 'corpus', '*', struct_hash, n_children, count(*), count(DISTINCT page_id) FROM s GROUP BY ALL HAVING count(*) >= 2"""))(
    lambda t: (lambda p: html.component_candidates(p, stage(html.element_rows(p).select("page_id", "pos", "parent_pos", "ord", "tag"), "elements")))(t.table("pages"))
)


def _strip_sql() -> str:
    steps, prev, cols = [], "html", []
    for i, (name, pat) in enumerate(STRIP_RULES):
        p = pat.replace("'", "''")
        steps.append(f"s{i} AS (SELECT *, regexp_replace({prev}, '{p}', '', 'g') AS h{i} FROM {'page_site' if i == 0 else f's{i-1}'})")
        cols.append(f"SELECT site, '{name}' AS rule, length({prev}) - length(h{i}) AS removed FROM s{len(STRIP_RULES)-1}")
        prev = f"h{i}"
    return ora(", " + ",\n".join(steps) + " SELECT site, rule, sum(removed)::BIGINT AS removed_chars, count(*) FILTER (removed > 0) AS pages_hit FROM ("
               + " UNION ALL ".join(cols) + ") GROUP BY ALL")


query("boilerplate_strip", _strip_sql())(lambda t: html.boilerplate_report(t.table("pages"), STRIP_RULES))

cte("hrefs", """
 SELECT page_id, lower(regexp_extract(url, '^(https?)://', 1)) AS scheme, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host,
   trim(unnest(a)) AS href, generate_subscripts(a, 1) AS pos
 FROM (SELECT page_id, url, regexp_extract_all(html, '(?i)<a\\s[^>]*href=["'']([^"'']*)["'']', 1) AS a FROM pages)""")
cte("internal", """
 SELECT page_id, site, target_url, target_path, min(pos) - 1 AS first_pos, row_number() OVER (PARTITION BY page_id ORDER BY min(pos)) AS rank FROM (
  SELECT page_id, pos, regexp_replace(host, '^www\\.', '') AS site, u AS target_url,
    regexp_replace(lower(regexp_extract(u, '^https?://([^/?#]+)', 1)), '^www\\.', '') AS target_site,
    regexp_extract(u, '^https?://[^/?#]+([^?#]*)', 1) AS target_path FROM (
   SELECT *, regexp_replace(CASE WHEN regexp_matches(href, '^https?://') THEN href WHEN href LIKE '//%' THEN scheme || ':' || href
     WHEN href LIKE '/%' THEN scheme || '://' || host || href END, '#.*$', '') AS u FROM hrefs
   WHERE href <> '' AND NOT regexp_matches(href, '(?i)^(javascript:|mailto:|tel:|#)')) WHERE u IS NOT NULL)
 WHERE site = target_site AND target_path NOT IN ('', '/') GROUP BY 1, 2, 3, 4""")
query("internal_links", ora("SELECT page_id, site, target_url, target_path, first_pos, rank FROM internal"))(
    lambda t: links.internal_links(t.table("pages"))
)
query("site_link_graph", ora("""
 , nodes AS (SELECT site, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, count(*) AS pages, coalesce(sum(n), 0)::BIGINT AS out_links
   FROM page_site LEFT JOIN (SELECT page_id, count(*) AS n FROM internal GROUP BY 1) USING (page_id) GROUP BY 1, 2),
 inb AS (SELECT site, target_path AS path, count(*) AS in_links FROM internal GROUP BY 1, 2)
 SELECT site, path, coalesce(pages, 0) AS pages, coalesce(out_links, 0) AS out_links, coalesce(in_links, 0) AS in_links,
   pages IS NOT NULL AND in_links IS NULL AS orphan, pages IS NULL AS uncrawled
 FROM nodes FULL JOIN inb USING (site, path)"""))(lambda t: links.site_link_graph(t.table("pages")))

_SEO = """
 , m AS (SELECT page_id, html, regexp_extract(html, '(?i)<title[^>]*>([^<]*)</title>', 1) AS t,
   regexp_extract(html, '(?i)<meta\\s+name=["'']description["'']\\s+content=["'']([^"'']*)["'']', 1) AS d FROM {pages}),
 seo AS (SELECT page_id, 'title-missing' AS check_id, 'fail' AS severity, 0::BIGINT AS amount FROM m WHERE trim(t) = ''
 UNION ALL SELECT page_id, 'title-length', 'warn', length(t) FROM m WHERE trim(t) <> '' AND length(t) > 60
 UNION ALL SELECT page_id, 'meta-desc-missing', 'fail', 0 FROM m WHERE trim(d) = ''
 UNION ALL SELECT page_id, 'meta-desc-length', 'warn', length(d) FROM m WHERE trim(d) <> '' AND length(d) > 155
 UNION ALL SELECT page_id, 'og-title', 'warn', 0 FROM m WHERE NOT regexp_matches(html, '(?i)<meta\\s+property=["'']og:title["'']')
 UNION ALL SELECT page_id, 'og-description', 'warn', 0 FROM m WHERE NOT regexp_matches(html, '(?i)<meta\\s+property=["'']og:description["'']')
 UNION ALL SELECT page_id, 'h1', 'fail', 0 FROM m WHERE NOT regexp_matches(html, '(?i)<h1[\\s>]')
 UNION ALL SELECT page_id, 'canonical', 'warn', 0 FROM m WHERE NOT regexp_matches(html, '(?i)<link\\s+rel=["'']canonical["'']'))"""
_A11Y = """
 , f AS (SELECT page_id, html, len(regexp_extract_all(html, '(?i)<h1[\\s>]')) AS h1s,
   len(list_filter(regexp_extract_all(html, '(?i)<img[^>]*>'), lambda x: NOT regexp_matches(x, '(?i)\\salt\\s*='))) AS no_alt,
   len(regexp_extract_all(html, '(?i)<a[^>]*>\\s*</a>')) AS empty_links,
   regexp_extract_all(html, '(?i)<h([1-6])[\\s>]', 1) AS hs FROM {pages}),
 hl AS (SELECT page_id, unnest(hs)::BIGINT AS level, generate_subscripts(hs, 1) AS pos FROM f),
 sk AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM (
   SELECT *, lag(level) OVER (PARTITION BY page_id ORDER BY pos) AS prev FROM hl) WHERE level > prev + 1),
 a11y AS (SELECT page_id, 'h1-missing' AS check_id, 'fail' AS severity, 0::BIGINT AS amount FROM f WHERE h1s = 0
 UNION ALL SELECT page_id, 'h1-multiple', 'warn', h1s FROM f WHERE h1s > 1
 UNION ALL SELECT page_id, 'img-alt', 'fail', no_alt FROM f WHERE no_alt > 0
 UNION ALL SELECT page_id, 'link-empty', 'fail', empty_links FROM f WHERE empty_links > 0
 UNION ALL SELECT page_id, 'heading-skip', 'warn', level FROM sk WHERE rn = 1)"""
ONE_CTE = "SELECT 1 AS one"
cte("one_row", ONE_CTE)


def chain(*parts: str) -> str:
    """Glue CTE fragments that start with a comma onto a generated WITH clause."""
    sql = " ".join(parts)
    made = ora(sql)
    return made if made.startswith("WITH") else "WITH one_row AS (SELECT 1 AS one)" + sql


query("seo_audit", chain(_SEO.format(pages="pages"), "SELECT * FROM seo"))(lambda t: audits.seo_audit(t.table("pages")))
query("a11y_audit", chain(_A11Y.format(pages="pages"), "SELECT * FROM a11y"))(lambda t: audits.a11y_audit(t.table("pages")))
query("seo_a11y_scorecard", chain(_SEO.format(pages="pages"), _A11Y.format(pages="pages"), """
 , u AS (SELECT DISTINCT page_id, check_id, severity FROM (SELECT * FROM seo UNION ALL SELECT * FROM a11y)),
 tot AS (SELECT site, count(*) AS site_pages FROM page_site GROUP BY 1)
 SELECT site, check_id, severity, count(*) AS pages, any_value(site_pages) AS site_pages,
   round(count(*) / any_value(site_pages), 4) AS fail_rate
 FROM u JOIN page_site USING (page_id) JOIN tot USING (site) GROUP BY ALL"""))(
    lambda t: audits.rule_failure_rates(t.table("pages"))
)
query("seo_backfill", ora("""
 , p AS (SELECT page_id, regexp_replace(split_part(url, '?', 1), '/$', '') AS canonical,
   NOT contains(html, 'rel="canonical"') AS add_canonical, NOT contains(html, 'name="description"') AS add_description,
   NOT contains(html, 'property="og:') AS add_og, NOT contains(html, 'name="robots"') AS add_robots FROM page_site)
 SELECT *, count(*) OVER (PARTITION BY canonical) AS canonical_pages FROM p"""))(
    lambda t: audits.seo_backfill(t.table("pages"))
)
