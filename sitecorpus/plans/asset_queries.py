"""Asset, media and form queries over `styled_pages`."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecorpus.functions.dims import MIME
from sitecorpus.operators import assets
from sitecorpus.operators.html import srcset_strip
from sitecorpus.plans.css_queries import sp, trim
from sitecorpus.plans.registry import Tables, cte, ora, query
from sitecorpus.session import stage
from sitecorpus.sources import design

_q = "[\"'']"
_nq = "[^\"'']"
_kinds = [
    ("html:img[src]", f"regexp_extract_all(html, '(?i)<img[^>]*?\\ssrc={_q}({_nq}+){_q}', 1)"),
    ("html:img[srcset]", f"list_transform(flatten(list_transform(regexp_extract_all(html, '(?i)<img[^>]+srcset={_q}({_nq}+){_q}', 1), lambda s: string_split(s, ','))), lambda p: regexp_extract(p, '^\\s*(\\S+)', 1))"),
    ("html:background-image", f"regexp_extract_all(html, '(?i)background(?:-image)?\\s*:[^;]*?url\\(\\s*{_q}?([^\"'')]+){_q}?\\s*\\)', 1)"),
    ("html:video[src]", f"regexp_extract_all(html, '(?i)<video[^>]+src={_q}({_nq}+){_q}', 1)"),
    ("html:source[src]", f"regexp_extract_all(html, '(?i)<source[^>]+src={_q}({_nq}+){_q}', 1)"),
]
cte("aref", "SELECT page_id, context_ix, context, pos, url FROM (" + " UNION ALL ".join(
    f"SELECT page_id, {i}::BIGINT AS context_ix, '{k}' AS context, (generate_subscripts({x}, 1) - 1)::BIGINT AS pos, {trim(f'unnest({x})')} AS url FROM sp" for i, (k, x) in enumerate(_kinds)
) + ") WHERE starts_with(url, 'http')")
query("asset_references", ora("SELECT * FROM aref"))(lambda t: assets.asset_references(sp(t)))


query("srcset_strip", ora("""
 , p AS (SELECT page_id, length(html) AS n, string_split(html, 'srcset="') AS parts FROM sp),
 c AS (SELECT page_id, n, parts[1] || array_to_string(list_transform(parts[2:], lambda x: CASE WHEN instr(x, '"') = 0 THEN 'srcset="' || x ELSE
   coalesce('srcset="' || nullif(array_to_string(list_filter(list_transform(string_split(split_part(x, '"', 1), ','), lambda e: regexp_replace(e, '^\\s+|\\s+$', '', 'g')), lambda e: NOT starts_with(e, 'http')), ', '), '') || '"', '') || x[instr(x, '"') + 1:] END), '') AS html FROM p)
 SELECT page_id, md5(html) AS html_md5, n - length(html) AS removed FROM c"""))(lambda t: srcset_strip(sp(t)).select("page_id", F.md5("html").alias("html_md5"), "removed"))


def _type(u: str) -> str:
    low = f"lower(split_part({u}, '?', 1))"
    return (f"CASE WHEN regexp_matches({low}, '\\.(mp4|webm|mov|ogg|avi)$') THEN 'video' WHEN regexp_matches({low}, '\\.svg$') THEN 'svg' "
            f"WHEN regexp_matches({low}, '\\.(png|jpg|jpeg|gif|webp|avif|bmp|ico|tiff?)$') THEN 'image' WHEN contains({low}, 'framerusercontent.com/images/') THEN 'image' "
            f"WHEN contains({low}, 'framerusercontent.com/assets/') THEN CASE WHEN regexp_matches({low}, '\\.(mp4|webm|mov)') THEN 'video' ELSE 'image' END ELSE 'other' END")


def _file(u: str) -> str:
    return f"regexp_extract(split_part({u}, '?', 1), '([^/]*)$', 1)"


cte("manifest", f"""
 SELECT *, coalesce(nullif(lower(regexp_extract(filename, '\\.([^.]+)$', 1)), ''), 'unknown') AS extension,
   CASE WHEN contains(lower(url), '//framerusercontent.com/images/') THEN 'assets/images' END AS folder FROM (
  SELECT *, {_type('url')} AS type, {_file('url')} AS filename FROM (
  SELECT site, arg_min(aref.url, (page_id, context_ix, pos)) AS url, count(*) AS uses, string_agg(DISTINCT context, ',' ORDER BY context) AS contexts
  FROM aref JOIN page_site USING (page_id) GROUP BY site, lower(aref.url)))""")
query("asset_manifest", ora("SELECT * FROM manifest"))(lambda t: assets.asset_manifest(sp(t)))
query("asset_manifest_cdn_images", ora("SELECT * FROM manifest WHERE type = 'image' AND contains(url, 'framerusercontent.com')"))(
    lambda t: assets.asset_manifest(sp(t), only="image", cdn="framerusercontent.com"))
query("asset_manifest_totals", ora("""
 SELECT site, sum(uses)::BIGINT AS total_urls, count(*) AS unique_urls, (sum(uses) - count(*))::BIGINT AS duplicates_removed,
  count(*) FILTER (type = 'image') AS images, count(*) FILTER (type = 'video') AS videos, count(*) FILTER (type = 'svg') AS svg, count(*) FILTER (type = 'other') AS other
 FROM manifest GROUP BY 1"""))(lambda t: assets.manifest_totals(assets.asset_manifest(sp(t))))
_mime = "CASE extension " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MIME.items()) + " ELSE 'application/octet-stream' END"
query("inventory_rollup", ora(f"""
 SELECT site, mime, count(*) AS files, sum(uses)::BIGINT AS uses, grouping_id(site, mime) AS level
 FROM (SELECT *, {_mime} AS mime FROM manifest) GROUP BY ROLLUP (site, mime)"""))(lambda t: assets.inventory_rollup(assets.asset_manifest(sp(t))))


def manifest_table(t: Tables):
    return stage(assets.asset_manifest(sp(t)), "manifest")


query("upload_queue", ora("""
 SELECT site, url, type, CASE WHEN left(md5(url || 'up'), 1) < '8' THEN 'skip' WHEN type = 'other' THEN 'error' ELSE 'queue' END AS state FROM manifest"""))(
    lambda t: (lambda m: assets.upload_queue(m, design.uploaded(m)))(manifest_table(t)))
query("upload_results_merge", ora("""
 SELECT site, url, CASE WHEN h < '7' THEN n END AS media_id, CASE WHEN h >= '7' AND h < 'a' THEN 'timeout' END AS error,
  CASE WHEN h < '7' THEN 'uploaded' WHEN h < 'a' THEN 'failed' ELSE 'pending' END AS status
 FROM (SELECT *, left(md5(url || 'res'), 1) AS h, ('0x' || left(md5(url), 6))::BIGINT AS n FROM manifest)"""))(
    lambda t: (lambda m: assets.upload_results_merge(m, design.upload_results(m)))(manifest_table(t)))
cte("media", """
 SELECT CASE WHEN h < '6' THEN url END AS url, filename, CASE WHEN h < '3' THEN n WHEN h < '6' THEN n + 1 ELSE n + 2 END AS mid FROM (
  SELECT url, min(filename) AS filename, left(md5(url), 1) AS h, ('0x' || left(md5(url), 6))::BIGINT AS n FROM manifest GROUP BY url) WHERE h < 'a'""")
query("media_resolve", ora(f"""
 SELECT page_id, context, pos, CASE WHEN coalesce(a, b) IS NULL THEN url END AS url, coalesce(a, b) AS media_id,
  CASE WHEN a IS NOT NULL THEN 'url' WHEN b IS NOT NULL THEN 'filename' ELSE 'none' END AS matched_by FROM (
  SELECT *, (SELECT min(mid) FROM media m WHERE m.url = r.url) AS a, (SELECT min(mid) FROM media m WHERE m.filename = {_file('r.url')}) AS b FROM aref r)"""))(
    lambda t: assets.media_resolve(assets.asset_references(sp(t)), design.media_library(manifest_table(t))))
_clean = trim("regexp_replace(regexp_replace(regexp_replace({0}, '[-_]', ' ', 'g'), '([a-z])([A-Z])', '\\1 \\2', 'g'), '\\s+', ' ', 'g')")
query("alt_text_suggestions", ora(f"""
 , mt AS (SELECT filename, CASE WHEN h < '5' THEN 'Picture of_the ' || filename END AS de, CASE WHEN h < 'a' THEN 'theTitle-of ' || repeat(filename, 6) END AS ti
   FROM (SELECT DISTINCT filename, left(md5(filename), 1) AS h FROM manifest)),
 im AS (SELECT page_id, pos, {_file('src')} AS filename, alt FROM (
  SELECT page_id, pos, regexp_extract(tag, '(?i)\\ssrc={_q}({_nq}+){_q}', 1) AS src, regexp_extract(tag, '(?i)\\salt\\s*=\\s*{_q}({_nq}*){_q}', 1) AS alt FROM (
   SELECT page_id, unnest(a) AS tag, (generate_subscripts(a, 1) - 1)::BIGINT AS pos FROM (SELECT page_id, regexp_extract_all(html, '(?i)(<img[^>]*>)', 1) AS a FROM sp)))
  WHERE src NOT LIKE 'data:%'),
 w AS (SELECT *, lower({_clean.format("coalesce(de, ti, regexp_replace(filename, '\\.[^.]+$', ''))")}) AS x FROM im LEFT JOIN mt USING (filename)),
 y AS (SELECT *, upper(x[1]) || x[2:] AS tx FROM w)
 SELECT page_id, pos, filename, CASE WHEN alt <> '' THEN alt WHEN length(tx) > 60 THEN left(tx, 59) || '…' ELSE tx END AS alt_text,
  CASE WHEN alt <> '' THEN 'skip' WHEN de IS NOT NULL THEN 'description' WHEN ti IS NOT NULL THEN 'title' ELSE 'filename' END AS action FROM y"""))(
    lambda t: assets.alt_text_suggestions(sp(t), design.media_texts(manifest_table(t))))


def _a(n: str) -> str:
    return f"nullif(regexp_extract(attrs, '(?i)(?:^|\\s){n}={_q}({_nq}+){_q}', 1), '')"


cte("ff", f"""
 SELECT page_id, 'form' AS mode, form_ix, field_ix, CASE WHEN area THEN 'textarea' WHEN lower(ty) = 'email' THEN 'email' ELSE 'text' END AS type,
  CASE WHEN area THEN nm ELSE coalesce(nullif({trim("regexp_extract(chunk, '(?is)<label[^>]*>([^<]*)</label>\\s*(?:<input\\s[^>]*>)$', 1)")}, ''),
   CASE WHEN fi = nm THEN nullif({trim(f"regexp_extract(chunk, '(?is)<label[^>]*for={_q}{_nq}+{_q}[^>]*>([^<]*)</label>', 1)")}, '') END, nm, ph, 'Field') END AS label,
  NOT area AND regexp_matches(attrs, '(?i)\\brequired\\b') AS required FROM (
  SELECT *, {_a('name')} AS nm, {_a('placeholder')} AS ph, {_a('type')} AS ty, regexp_extract(chunk, '(?is)<label[^>]*for={_q}({_nq}+){_q}[^>]*>', 1) AS fi FROM (
   SELECT *, regexp_extract(chunk, '(?is)(?:<input\\s|<textarea)([^>]*)>$', 1) AS attrs, regexp_matches(chunk, '(?is)<textarea[^>]*>$') AS area FROM (
    SELECT page_id, form_ix, unnest(c) AS chunk, (generate_subscripts(c, 1) - 1)::BIGINT AS field_ix FROM (
     SELECT page_id, form_ix, regexp_extract_all(body, '(?is).*?(?:<input\\s[^>]*>|<textarea[^>]*>)') AS c FROM (
      SELECT page_id, unnest(a) AS body, (generate_subscripts(a, 1) - 1)::BIGINT AS form_ix FROM (
       SELECT page_id, regexp_extract_all(html, '(?is)<form[^>]*>(.*?)</form>', 1) AS a FROM sp)))))) WHERE NOT area OR nm IS NOT NULL""")
cte("lf", f"""
 SELECT page_id, 'loose' AS mode, 0::BIGINT AS form_ix, field_ix, CASE WHEN lower(ty) = 'email' THEN 'email' ELSE 'text' END AS type,
  coalesce(nm, ph, 'Field ' || (count(*) FILTER (nm IS NULL AND ph IS NULL) OVER (PARTITION BY page_id ORDER BY field_ix))) AS label,
  regexp_matches(attrs, '(?i)required') AS required FROM (
  SELECT *, {_a('name')} AS nm, {_a('placeholder')} AS ph, count(*) OVER (PARTITION BY page_id) AS n FROM (
   SELECT *, {_a('type')} AS ty FROM (
    SELECT page_id, unnest(a) AS attrs, (generate_subscripts(a, 1) - 1)::BIGINT AS field_ix FROM (
     SELECT page_id, regexp_extract_all(html, '(?i)<input\\s+([^>]*?)/?>', 1) AS a FROM sp)))
  WHERE coalesce(lower(ty), 'text') NOT IN ('hidden', 'submit') AND page_id NOT IN (SELECT page_id FROM ff)) WHERE n >= 2""")
query("form_fields", ora("SELECT * FROM ff UNION ALL SELECT * FROM lf"))(lambda t: assets.form_fields(sp(t)))
query("form_inventory", ora(f"""
 , g AS (SELECT page_id, mode, form_ix, count(*) AS fields, count(*) FILTER (required) AS required_fields, count(*) FILTER (type = 'email') AS email_fields
   FROM (SELECT * FROM ff UNION ALL SELECT * FROM lf) GROUP BY 1, 2, 3)
 SELECT g.*, coalesce(nullif(CASE mode WHEN 'form' THEN {trim(f"regexp_extract(regexp_extract_all(html, '(?is)<form[^>]*>(.*?)</form>', 1)[form_ix + 1], '(?is)<button[^>]*type={_q}submit{_q}[^>]*>(.*?)</button>', 1)")}
   ELSE regexp_extract(html, '(?i)<button[^>]*>(Submit|Send|Absenden|Senden|Sign Up|Subscribe)</button>', 1) END, ''), 'Submit') AS submit_text
 FROM g JOIN sp USING (page_id)"""))(lambda t: assets.form_inventory(sp(t)))
