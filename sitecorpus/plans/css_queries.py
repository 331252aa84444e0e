"""Queries over the style sheets of `styled_pages` (pages with design markup added)."""

from __future__ import annotations

from sitecorpus.functions.dims import COLOR_PROPS, EASING, EFFECTS
from sitecorpus.operators import audits, css, html, links
from sitecorpus.plans.page_queries import _A11Y, _SEO, chain
from sitecorpus.plans.registry import Tables, cte, ora, query
from sitecorpus.session import stage
from sitecorpus.sources.styled import STYLED_HTML_SQL, styled_pages

WSTRIM = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


def trim(x: str) -> str:
    return WSTRIM.format(x)


def hexsql(x: str) -> str:
    v = f"regexp_replace(lower({trim(x)}), '^#', '')"
    six = f"(CASE WHEN length({v}) = 3 THEN repeat({v}[1], 2) || repeat({v}[2], 2) || repeat({v}[3], 2) ELSE {v} END)"
    rgb = "rgba?\\(\\s*(\\d+)\\s*,\\s*(\\d+)\\s*,\\s*(\\d+)"
    parts = " || ".join(f"format('{{:02x}}', regexp_extract({v}, '{rgb}', {i})::INT)" for i in (1, 2, 3))
    return (f"(CASE WHEN regexp_matches({six}, '^[0-9a-f]{{6}}$') THEN '#' || {six} "
            f"WHEN regexp_matches({v}, '{rgb}') THEN '#' || {parts} END)")


def fallback(x: str) -> str:
    fb = trim(f"regexp_extract({x}, 'var\\([^,]+,\\s*([^)]+)\\)', 1)")
    return f"(CASE WHEN starts_with({x}, 'var(') THEN nullif({fb}, '') ELSE {x} END)"


def msql(x: str) -> str:
    n = f"try_cast(regexp_extract({x}, '^\\s*(-?(?:\\d+\\.?\\d*|\\.\\d+))', 1) AS DOUBLE)"
    return f"floor(CASE WHEN regexp_matches({x}, '^\\s*-?[\\d.]+\\s*ms') THEN {n} ELSE {n} * 1000 END + 0.5)::BIGINT"


def listing(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def mapping(table: dict[str, str], x: str, default: str) -> str:
    return f"(CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE '{default}' END)"


COLORS = listing(COLOR_PROPS)
DARK = "(?i)prefers-color-scheme\\s*:\\s*dark"

cte("sp", f"SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), '^www\\.', '') AS site, {STYLED_HTML_SQL} AS html FROM pages")
cte("css_text", "SELECT page_id, regexp_replace(array_to_string(regexp_extract_all(html, '(?is)<style[^>]*>(.*?)</style>', 1), chr(10)), '(?s)/\\*.*?\\*/', '', 'g') AS css FROM sp")
cte("css_tok", """
 SELECT page_id, pos, right(tok, 1) AS brace, left(tok, length(tok) - 1) AS text FROM (
  SELECT page_id, unnest(a) AS tok, generate_subscripts(a, 1) - 1 AS pos FROM (
   SELECT page_id, regexp_extract_all(regexp_replace(css, '(?is)@font-face\\s*\\{[^}]*\\}', '', 'g'), '[^{}]*[{}]') AS a FROM css_text))""")
cte("css_lv", """
 SELECT page_id, pos, brace, text, run - least(0, min(run) OVER w) AS level,
   lead(brace) OVER w2 AS nb, lead(text) OVER w2 AS nt,
   regexp_replace(regexp_replace(text, '(?s)^.*;', ''), '^\\s+|\\s+$', '', 'g') AS header FROM (
  SELECT *, sum(CASE brace WHEN '{' THEN 1 ELSE -1 END) OVER (PARTITION BY page_id ORDER BY pos) AS run FROM css_tok)
 WINDOW w AS (PARTITION BY page_id ORDER BY pos), w2 AS (PARTITION BY page_id ORDER BY pos)""")
cte("css_rule", """
 SELECT r.page_id, r.pos AS rule_pos, r.header AS selector, r.nt AS body, coalesce(a.at_rule, '') AS at_rule
 FROM css_lv r LEFT JOIN (
  SELECT page_id, pos, string_agg(h, ' / ' ORDER BY lvl) AS at_rule FROM (
   SELECT r.page_id, r.pos, o.level AS lvl, arg_max(o.header, o.pos) AS h
   FROM css_lv r JOIN css_lv o ON o.page_id = r.page_id AND o.pos < r.pos AND o.level < r.level
   WHERE r.brace = '{' AND r.nb = '}' AND o.brace = '{' AND o.nb IS DISTINCT FROM '}' GROUP BY 1, 2, 3) GROUP BY 1, 2) a
 ON a.page_id = r.page_id AND a.pos = r.pos WHERE r.brace = '{' AND r.nb = '}'""")
_pair = "'([\\w-]+)\\s*:\\s*([^;!\\n}]+)'"
cte("decl", f"""
 SELECT *, CASE WHEN bp_max <= 809 THEN 'mobile' WHEN bp_min >= 1200 THEN 'desktop'
   WHEN bp_min IS NOT NULL OR bp_max IS NOT NULL THEN 'tablet' END AS breakpoint,
   (CASE source WHEN 'sheet' THEN 0 ELSE 1 END) * 1000000000000 + rule_pos * 1000000 + decl_pos AS o FROM (
  SELECT page_id, source, rule_pos, decl_pos, selector, p AS property, {trim('v')} AS value, at_rule,
   try_cast(nullif(regexp_extract(at_rule, 'max-width\\s*:\\s*(\\d+(?:\\.\\d+)?)px', 1), '') AS DOUBLE) AS bp_max,
   try_cast(nullif(regexp_extract(at_rule, 'min-width\\s*:\\s*(\\d+(?:\\.\\d+)?)px', 1), '') AS DOUBLE) AS bp_min FROM (
   SELECT page_id, 'sheet' AS source, rule_pos, selector, at_rule, unnest(regexp_extract_all(body, {_pair}, 1)) AS p,
     unnest(regexp_extract_all(body, {_pair}, 2)) AS v, generate_subscripts(regexp_extract_all(body, {_pair}, 1), 1) - 1 AS decl_pos FROM css_rule
   UNION ALL
   SELECT page_id, 'inline', rule_pos, '[inline]', '', unnest(regexp_extract_all(body, {_pair}, 1)),
     unnest(regexp_extract_all(body, {_pair}, 2)), generate_subscripts(regexp_extract_all(body, {_pair}, 1), 1) - 1 FROM (
     SELECT page_id, unnest(a) AS body, generate_subscripts(a, 1) - 1 AS rule_pos FROM (
       SELECT page_id, regexp_extract_all(html, '(?i)\\sstyle=["'']([^"'']+)["'']', 1) AS a FROM sp))))""")


def sp(t: Tables):
    return styled_pages(t.table("pages"))


def decls(t: Tables):
    return css.css_declarations(sp(t))


query("style_blocks", ora("""
 SELECT page_id, unnest(a) AS css, (generate_subscripts(a, 1) - 1)::BIGINT AS pos
 FROM (SELECT page_id, regexp_extract_all(html, '(?is)<style[^>]*>(.*?)</style>', 1) AS a FROM sp)"""))(
    lambda t: css.style_blocks(sp(t)))
query("css_rules", ora("SELECT page_id, rule_pos::BIGINT AS rule_pos, selector, body, at_rule FROM css_rule"))(
    lambda t: css.css_rules(css.page_css(sp(t))))
query("css_declarations", ora("""
 SELECT page_id, source, rule_pos::BIGINT AS rule_pos, decl_pos::BIGINT AS decl_pos, selector, property, value, at_rule, bp_min, bp_max, breakpoint FROM decl"""))(decls)
query("css_variables", ora("""
 SELECT page_id, property AS name, value, count(*) AS occurrences,
   row_number() OVER (PARTITION BY page_id, property ORDER BY min(o)) AS value_rank
 FROM decl WHERE property LIKE '--%' GROUP BY 1, 2, 3"""))(lambda t: css.css_variables(decls(t)))
_use = "'var\\(\\s*(--[\\w-]+)\\s*,\\s*([^)]+?)\\s*\\)'"
cte("var_use", f"""
 SELECT page_id, o, unnest(regexp_extract_all(value, {_use}, 1)) AS name, unnest(regexp_extract_all(value, {_use}, 2)) AS fb,
   generate_subscripts(regexp_extract_all(value, {_use}, 1), 1) AS i FROM decl""")
query("css_var_fallbacks", ora("""
 SELECT page_id, name, arg_min(fb, (o, i)) AS fallback, 0::BIGINT AS occurrences FROM var_use u
 WHERE NOT EXISTS (SELECT 1 FROM decl d WHERE d.page_id = u.page_id AND d.property = u.name) GROUP BY 1, 2"""))(
    lambda t: css.css_var_fallbacks(decls(t)))


def _face(name: str) -> str:
    return trim(f"regexp_extract(body, '(?i)(?:^|[;\\s]){name}\\s*:\\s*([^;]+)', 1)")


cte("face", f"""
 SELECT *, CASE WHEN contains(url, 'fonts.gstatic.com') THEN 'google-fonts' WHEN contains(url, 'framerusercontent.com') THEN 'framer-cdn'
   ELSE 'custom-upload' END AS source FROM (
 SELECT page_id, pos, regexp_replace({_face('font-family')}, '["'']', '', 'g') AS family, coalesce(nullif({_face('font-weight')}, ''), '400') AS weight,
   coalesce(nullif({_face('font-style')}, ''), 'normal') AS style, coalesce(nullif({_face('font-display')}, ''), 'swap') AS display,
   regexp_extract(body, '(?i)url\\(\\s*["'']?([^"'')]+)["'']?\\s*\\)', 1) AS url,
   regexp_extract(body, '(?i)format\\(\\s*["'']?([^"'')]+)["'']?\\s*\\)', 1) AS format FROM (
  SELECT page_id, unnest(a) AS body, (generate_subscripts(a, 1) - 1)::BIGINT AS pos FROM (
   SELECT page_id, regexp_extract_all(css, '(?is)@font-face\\s*\\{{([^}}]*)\\}}', 1) AS a FROM css_text))) WHERE family <> ''""")
query("font_faces", ora("SELECT * FROM face"))(lambda t: css.font_faces(sp(t)))


def _last(p: str) -> str:
    return f"arg_max(value, o) FILTER (property = '{p}')"


query("text_style_classes", ora(f"""
 SELECT * FROM (SELECT page_id, selector, {_last('font-size')} AS font_size, {_last('font-weight')} AS font_weight,
   regexp_replace({_last('font-family')}, '["'']', '', 'g') AS font_family, {_last('line-height')} AS line_height,
   {_last('letter-spacing')} AS letter_spacing, substr(selector, 13) AS name
 FROM decl WHERE source = 'sheet' AND starts_with(selector, '.text-style-') AND at_rule = '' GROUP BY page_id, selector)
 WHERE font_size IS NOT NULL OR font_family IS NOT NULL"""))(lambda t: css.text_style_classes(decls(t)))
query("media_breakpoints", ora("""
 SELECT page_id, width_px, breakpoint, row_number() OVER (PARTITION BY page_id ORDER BY width_px DESC, breakpoint) AS rank
 FROM (SELECT DISTINCT page_id, bp_max AS width_px, breakpoint FROM decl WHERE bp_max IS NOT NULL)"""))(
    lambda t: css.media_breakpoints(decls(t)))
_fbv = f"coalesce({fallback('value')}, value)"
cte("dark", f"""
 SELECT page_id, rule_pos::BIGINT AS rule_pos, decl_pos::BIGINT AS decl_pos, selector, property, v AS dark_value, {hexsql('v')} AS dark_hex
 FROM (SELECT *, {_fbv} AS v FROM decl) WHERE regexp_matches(at_rule, '{DARK}') AND (property IN ({COLORS}) OR property LIKE '--%')""")
query("dark_mode_overrides", ora("SELECT * FROM dark"))(lambda t: css.dark_mode_overrides(decls(t)))
query("dark_light_match", ora(f"""
 , light AS (SELECT * FROM (SELECT *, {hexsql('v')} AS hex FROM (SELECT *, {_fbv} AS v FROM decl)
   WHERE NOT regexp_matches(at_rule, '{DARK}') AND property IN ({COLORS})) WHERE hex IS NOT NULL)
 SELECT page_id, selector, property, dark_value, dark_hex,
  (SELECT arg_max(v, o) FROM light l WHERE l.page_id = d.page_id AND l.hex = d.dark_hex) AS hex_match,
  (SELECT arg_max(hex, o) FROM light l WHERE l.page_id = d.page_id AND l.selector = d.selector AND l.property = d.property AND at_rule = '') AS selector_match,
  'dark-' || CASE WHEN contains(property, 'background') THEN 'surface' WHEN property = 'color' THEN 'text' ELSE 'color' END || '-' ||
  left(regexp_replace(regexp_replace(regexp_replace(selector, '[.#\\[\\]:>\\s,]+', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g'), 24) || '-' ||
  left(regexp_replace(regexp_replace(regexp_replace(property, '^--', ''), '(?i)[^a-z0-9-]', '-', 'g'), '-+', '-', 'g'), 20) AS token_name
 FROM dark d"""))(lambda t: css.dark_light_match(stage(decls(t), "declarations")))
query("keyframes", ora("""
 SELECT page_id, name, count(*) AS steps, sum(length(body))::BIGINT AS body_chars FROM (
  SELECT *, regexp_extract(at_rule, '@(?:-webkit-)?keyframes\\s+([\\w-]+)', 1) AS name FROM css_rule) WHERE name <> '' GROUP BY 1, 2"""))(
    lambda t: css.keyframes(css.page_css(sp(t))))
query("animated_rules", ora("""
 SELECT page_id, rule_pos::BIGINT AS rule_pos, selector,
   CASE WHEN bool_or(property LIKE 'animation%') THEN 'animation' ELSE 'transition' END AS type, count(*) AS declarations
 FROM decl WHERE source = 'sheet' AND regexp_matches(property, '^(animation|transition)') AND NOT contains(at_rule, 'keyframes')
 GROUP BY 1, 2, 3"""))(lambda t: css.animated_rules(decls(t)))
query("transition_interactions", ora(f"""
 , g AS (SELECT page_id, rule_pos, selector, {_last('transition')} AS tr, {_last('transition-property')} AS tp,
   coalesce({_last('transition-duration')}, {_last('animation-duration')}, '0.3') AS du, coalesce({_last('transition-delay')}, '0') AS de,
   {trim(f"coalesce({_last('transition-timing-function')}, {_last('animation-timing-function')}, 'ease')")} AS ea
   FROM decl WHERE source = 'sheet' AND NOT contains(at_rule, 'keyframes') GROUP BY 1, 2, 3
   HAVING bool_or(regexp_matches(property, '^(animation|transition)')))
 , h AS (SELECT *, {trim("regexp_replace(coalesce(tp, split_part(tr, ' ', 1), 'opacity'), 'transform\\.', '', 'g')")} AS animated FROM g)
 SELECT page_id, rule_pos::BIGINT AS rule_pos, selector, animated, {mapping(EFFECTS, 'animated', 'fade')} AS effect,
   CASE WHEN regexp_matches(selector, '(?i)appear|scroll') THEN 'scroll' ELSE 'entrance' END AS "trigger",
   {msql('du')} AS duration_ms, {msql('de')} AS delay_ms, {mapping(EASING, 'ea', 'ease-out')} AS easing,
   floor({msql('du')} * 0.7 + 0.5)::BIGINT AS mobile_duration_ms FROM h"""))(lambda t: css.transition_interactions(decls(t)))
_app = "'(?i)<([A-Za-z][A-Za-z0-9]*)[^>]*\\sdata-framer-appear-id\\s*=\\s*[\"'']([^\"'']+)[\"''][^>]*>'"
query("appear_animations", ora(f"""
 SELECT page_id, id AS appear_id, arg_min(lower(tag), i) AS tag, count(*) AS uses FROM (
  SELECT page_id, unnest(regexp_extract_all(html, {_app}, 1)) AS tag, unnest(regexp_extract_all(html, {_app}, 2)) AS id,
    generate_subscripts(regexp_extract_all(html, {_app}, 1), 1) AS i FROM sp) GROUP BY 1, 2"""))(lambda t: css.appear_animations(sp(t)))
cte("cascade", f"""
 SELECT page_id, selector, coalesce(breakpoint, 'base') AS bp, property, arg_max(value, o) AS value FROM decl
 WHERE source = 'sheet' AND NOT regexp_matches(at_rule, '{DARK}') AND NOT contains(at_rule, 'keyframes') GROUP BY 1, 2, 3, 4""")
query("responsive_deltas", ora("""
 , eff AS (SELECT page_id, selector, property, arg_min(value, CASE bp WHEN 'desktop' THEN 0 ELSE 1 END) AS value
   FROM cascade WHERE bp IN ('base', 'desktop') GROUP BY 1, 2, 3)
 SELECT page_id, selector, property, 'base' AS variant, value FROM eff
 UNION ALL SELECT c.page_id, c.selector, c.property, c.bp, c.value FROM cascade c LEFT JOIN eff e USING (page_id, selector, property)
 WHERE c.bp IN ('tablet', 'mobile') AND c.value IS DISTINCT FROM e.value"""))(lambda t: css.responsive_deltas(decls(t)))
query("breakpoint_bounds", ora("""
 SELECT page_id, coalesce(min(least(bp_min, bp_max)) FILTER (breakpoint = 'tablet'), 810) AS tablet_min,
   coalesce(min(bp_min) FILTER (breakpoint = 'desktop'), 1200) - 1 AS tablet_max,
   coalesce(max(bp_max) FILTER (breakpoint = 'mobile'), 809) AS mobile_max,
   coalesce(min(bp_min) FILTER (breakpoint = 'desktop'), 1200) AS desktop_min
 FROM decl WHERE breakpoint IS NOT NULL GROUP BY 1"""))(lambda t: css.breakpoint_bounds(decls(t)))

# Audits that find nothing on the plain crawl run over the styled pages.
query("a11y_audit_styled", chain(_A11Y.format(pages="sp"), "SELECT * FROM a11y"))(lambda t: audits.a11y_audit(sp(t)))
query("seo_audit_styled", chain(_SEO.format(pages="sp"), "SELECT * FROM seo"))(lambda t: audits.seo_audit(sp(t)))
query("heading_skips", ora("""
 , h AS (SELECT page_id, unnest(a)::BIGINT AS level, (generate_subscripts(a, 1) - 1)::BIGINT AS pos FROM (
   SELECT page_id, regexp_extract_all(html, '(?i)<h([1-6])[\\s>]', 1) AS a FROM sp)),
 l AS (SELECT *, lag(level) OVER (PARTITION BY page_id ORDER BY pos) AS prev_level FROM h)
 SELECT page_id, pos, prev_level, level, row_number() OVER (PARTITION BY page_id ORDER BY pos) = 1 AS is_first
 FROM l WHERE level > prev_level + 1"""))(lambda t: html.heading_skips(sp(t)))
query("project_match", ora("""
 SELECT page_id, site, e AS embedded_id, s AS url_slug, e = s AS matches FROM (
  SELECT page_id, site, lower(regexp_extract(html, '(?i)data-project-id=["'']([^"'']+)["'']', 1)) AS e,
   lower(regexp_extract(url, '^https?://([^/?#.]+)', 1)) AS s FROM sp) WHERE e <> ''"""))(lambda t: links.project_match(sp(t)))
_plug = "list_filter(['ScrollTrigger','SplitText','ScrollToPlugin','Flip','Observer','Draggable','MotionPathPlugin'], lambda p: regexp_matches(code, '(?i)' || p || CASE p WHEN 'Flip' THEN '\\b' ELSE '' END))"
query("script_inventory", ora(f"""
 , s AS (SELECT page_id, {trim('unnest(regexp_extract_all(html, $$(?is)<script[^>]*>(.*?)</script>$$, 1))')} AS code FROM sp),
 c AS (SELECT *, regexp_matches(code, '(?i)\\bgsap\\.|ScrollTrigger') AS g FROM s WHERE code <> '')
 SELECT site, CASE WHEN g THEN 'gsap' WHEN regexp_matches(code, '(?i)\\banimat|\\.animate\\(|requestAnimationFrame|intersectionObserver')
    OR (regexp_matches(code, '(?i)\\btransform\\b|\\.style\\.\\w+') AND length(code) > 50) THEN 'js' ELSE 'other' END AS script_type,
  CASE WHEN g THEN array_to_string({_plug}, ',') ELSE '' END AS plugins,
  count(*) AS scripts, sum(length(code))::BIGINT AS code_chars, max(length(code)) AS longest
 FROM c JOIN sp USING (page_id) GROUP BY 1, 2, 3"""))(lambda t: links.script_inventory(sp(t)))
query("third_party_requests", ora("""
 , dom AS (SELECT unnest(['sentry.io','www.googletagmanager.com','connect.facebook.net','stats.g.doubleclick.net','google-analytics.com',
   'events.framer.com','api.framer.com','collect.frameranalytics.com','js-agent.newrelic.com','cdn.heapanalytics.com','tr.snapchat.com',
   'frog.wix.com','bi.wixapi.com','fed.wixcodescheduler.com','editor.wix.com','panorama.wixapps.net']) AS domain,
   unnest(['shared','shared','shared','shared','shared','framer','framer','framer','webflow','webflow','webflow','wix','wix','wix','wix','wix']) AS list),
 r AS (SELECT page_id, site, lower(regexp_extract(unnest(regexp_extract_all(html, '(?i)\\s(?:src|href)=["''](https?://[^"'']+)["'']', 1)), '^https?://([^/?#:]+)', 1)) AS host FROM sp)
 SELECT site, domain, list, count(*) AS requests, count(DISTINCT page_id) AS pages FROM r JOIN dom ON contains(host, domain) GROUP BY 1, 2, 3"""))(
    lambda t: links.third_party_requests(sp(t)))
cte("plat", """
 SELECT page_id, site, CASE WHEN regexp_matches(url, '\\.framer\\.(app|website)|framercanvas\\.com') THEN 'framer'
   WHEN regexp_matches(url, '\\.webflow\\.(io|com)') THEN 'webflow' WHEN regexp_matches(url, '\\.wixsite\\.com|\\.wix\\.com') THEN 'wix'
   WHEN contains(html, 'id="main"') AND (contains(html, 'framerstatic.com') OR contains(html, 'framerusercontent.com')) THEN 'framer'
   WHEN regexp_matches(html, 'data-wf-site|w-webflow-badge|Webflow|webflow\\.js') THEN 'webflow'
   WHEN regexp_matches(html, 'wix-viewer-model|id="WIX_ADS"|X-Wix-|Wix\\.com|wixcode-sdk|data-wix|wix-code|WixCode|\\bwix\\.com\\b|(?i)_wix_|wix-ecom') THEN 'wix' END AS platform
 FROM sp""")
query("platform_detect", ora("SELECT page_id, site, platform, CASE WHEN platform IS NOT NULL THEN 'html' END AS evidence FROM plat"))(
    lambda t: links.platform_detect(sp(t)))
query("platform_by_site", ora("""
 , n AS (SELECT site, platform, count(*) AS n FROM plat GROUP BY 1, 2)
 SELECT site, sum(n)::BIGINT AS pages, first(platform ORDER BY n DESC, platform) FILTER (platform IS NOT NULL) AS platform,
   coalesce(max(n) FILTER (platform IS NOT NULL), 0) AS platform_pages FROM n GROUP BY 1"""))(lambda t: links.platform_by_site(sp(t)))
