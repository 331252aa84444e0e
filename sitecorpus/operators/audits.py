"""Accessibility and SEO rule audits over raw pages; every rule yields issue rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitecorpus.functions.columns import hex_norm, luminance, trim_ws
from sitecorpus.operators.html import heading_skip_array, with_site


def _features() -> dict:
    """What the rules look at, one column each, from a single look at the page."""
    html = F.col("html")
    title = F.regexp_extract("html", r"(?i)<title[^>]*>([^<]*)</title>", 1)
    desc = F.regexp_extract("html", r"(?i)<meta\s+name=[\"']description[\"']\s+content=[\"']([^\"']*)[\"']", 1)

    def found(pattern):
        return F.regexp_extract_all("html", F.lit(pattern), F.lit(0))

    return {
        "t": trim_ws(title), "tl": F.length(title), "d": trim_ws(desc), "dl": F.length(desc),
        "og_t": html.rlike(r"(?i)<meta\s+property=[\"']og:title[\"']"),
        "og_d": html.rlike(r"(?i)<meta\s+property=[\"']og:description[\"']"),
        "canon": html.rlike(r"(?i)<link\s+rel=[\"']canonical[\"']"),
        "h1s": F.size(found(r"(?i)<h1[\s>]")),
        "no_alt": F.size(F.filter(found(r"(?i)<img[^>]*>"), lambda t: ~t.rlike(r"(?i)\salt\s*="))),
        "empty_links": F.size(found(r"(?i)<a[^>]*>\s*</a>")),
        "skip": F.get(heading_skip_array(html), F.lit(0))["level"],
    }


def _rules(sources: tuple[str, ...]) -> list:
    c, none = F.col, F.lit(0)
    rules = [
        ("seo", "title-missing", "fail", c("t") == "", none),
        ("seo", "title-length", "warn", (c("t") != "") & (c("tl") > 60), c("tl")),
        ("seo", "meta-desc-missing", "fail", c("d") == "", none),
        ("seo", "meta-desc-length", "warn", (c("d") != "") & (c("dl") > 155), c("dl")),
        ("seo", "og-title", "warn", ~c("og_t"), none),
        ("seo", "og-description", "warn", ~c("og_d"), none),
        ("seo", "h1", "fail", c("h1s") == 0, none),
        ("seo", "canonical", "warn", ~c("canon"), none),
        ("a11y", "h1-missing", "fail", c("h1s") == 0, none),
        ("a11y", "h1-multiple", "warn", c("h1s") > 1, c("h1s")),
        ("a11y", "img-alt", "fail", c("no_alt") > 0, c("no_alt")),
        ("a11y", "link-empty", "fail", c("empty_links") > 0, c("empty_links")),
        ("a11y", "heading-skip", "warn", c("skip").isNotNull(), c("skip")),
    ]
    return [r for r in rules if r[0] in sources]


def page_issues(pages: DataFrame, sources: tuple[str, ...] = ("seo", "a11y"), carry: tuple[str, ...] = ()) -> DataFrame:
    """Issues of all rules as rows (page_id, source, check_id, severity, amount): one scan however many rules there are."""
    features = pages.select("page_id", *carry, *[v.alias(k) for k, v in _features().items()])
    entries = [
        F.when(cond, F.struct(
            F.lit(source).alias("source"), F.lit(check).alias("check_id"), F.lit(sev).alias("severity"),
            F.coalesce(n, F.lit(0)).cast("bigint").alias("amount")))
        for source, check, sev, cond, n in _rules(sources)
    ]
    return features.select("page_id", *carry, F.inline(F.array_compact(F.array(*entries))))


def seo_audit(pages: DataFrame) -> DataFrame:
    return page_issues(pages, ("seo",)).drop("source")


def a11y_audit(pages: DataFrame) -> DataFrame:
    return page_issues(pages, ("a11y",)).drop("source")


def rule_failure_rates(pages: DataFrame) -> DataFrame:
    """Which rules fail on which sites, and how often: the corpus scorecard.

    A page has at most one issue per rule, so failing pages are plain counts: issues leave the scan already
    counted per site and rule, and a site with a third of all pages is a few partial rows per task.
    """
    p = with_site(pages)
    totals = p.groupBy("site").agg(F.count("*").alias("site_pages"))
    failed = page_issues(p, carry=("site",)).groupBy("site", "check_id", "severity").agg(F.count("*").alias("pages"))
    return failed.join(totals, "site").select(
        "site", "check_id", "severity", "pages", "site_pages",
        F.round(F.col("pages") / F.col("site_pages"), 4).alias("fail_rate"),
    )


def seo_backfill(pages: DataFrame) -> DataFrame:
    """Which head tags an export would add, the canonical URL, and how many pages share that canonical."""
    html = F.col("html")
    canonical = F.regexp_replace(F.regexp_extract("url", r"^([^?]*)", 1), "/$", "")
    p = pages.select(
        "page_id", canonical.alias("canonical"),
        (~F.contains(html, F.lit('rel="canonical"'))).alias("add_canonical"),
        (~F.contains(html, F.lit('name="description"'))).alias("add_description"),
        (~F.contains(html, F.lit('property="og:'))).alias("add_og"),
        (~F.contains(html, F.lit('name="robots"'))).alias("add_robots"),
    )
    shared = p.groupBy("canonical").agg(F.count("*").alias("canonical_pages"))
    return p.join(shared, "canonical")


def contrast_audit(palette: DataFrame, background: str = "#ffffff") -> DataFrame:
    """WCAG contrast of text colours against a background; below 3 fails, below 4.5 passes for large text only."""
    lt = luminance(F.col("hex"))
    lb = luminance(hex_norm(F.lit(background)))
    ratio = (F.greatest(lt, lb) + 0.05) / (F.least(lt, lb) + 0.05)
    return palette.withColumn("ratio", F.round(ratio, 2)).withColumn(
        "verdict", F.when(F.col("ratio") >= 4.5, "PASS").when(F.col("ratio") >= 3, "AA_LARGE").otherwise("FAIL")
    )
