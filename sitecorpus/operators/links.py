"""Links, site graph, scripts, third parties and site-builder detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitecorpus.functions.columns import site_of, trim_ws
from sitecorpus.functions.dims import (
    FRAMER_HOST_MARKER,
    FRAMER_MAIN_MARKER,
    GSAP_PLUGINS,
    PLATFORM_RULES,
    PLATFORM_TRACKING_HOSTS,
    SHARED_TRACKING_HOSTS,
)
from sitecorpus.operators.html import with_site


def _resolved_links(pages: DataFrame) -> DataFrame:
    """Pages with their anchors as an array of absolute URLs without fragment (NULL for what is not a link)."""
    hrefs = F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*href=[\"']([^\"']*)[\"']"), F.lit(1))
    scheme = F.lower(F.regexp_extract("url", r"^(https?)://", 1))
    host = F.lower(F.regexp_extract("url", r"^https?://([^/?#]+)", 1))
    p = pages.select("page_id", scheme.alias("scheme"), host.alias("host"), hrefs.alias("hrefs"))

    def resolve(raw):
        h = trim_ws(raw)
        skip = (h == "") | h.rlike(r"(?i)^(javascript:|mailto:|tel:|#)")
        full = (
            F.when(skip, None).when(h.rlike("^https?://"), h).when(h.startswith("//"), F.concat("scheme", F.lit(":"), h))
            .when(h.startswith("/"), F.concat("scheme", F.lit("://"), "host", h))
        )
        return F.regexp_replace(full, "#.*$", "")

    return p.select("page_id", F.regexp_replace("host", r"^www\.", "").alias("site"), F.transform("hrefs", resolve).alias("urls"))


def _target(url):
    site = F.regexp_replace(F.lower(F.regexp_extract(url, r"^https?://([^/?#]+)", 1)), r"^www\.", "")
    return site, F.regexp_extract(url, r"^https?://[^/?#]+([^?#]*)", 1)


def page_links(pages: DataFrame) -> DataFrame:
    """Every anchor resolved against its page: (page_id, pos, site, target_site, target_url, target_path)."""
    rows = _resolved_links(pages).select("page_id", "site", F.posexplode("urls").alias("pos", "target_url")).filter("target_url is not null")
    site, path = _target(F.col("target_url"))
    return rows.select("page_id", "pos", "site", site.alias("target_site"), "target_url", path.alias("target_path"))


def internal_links(pages: DataFrame) -> DataFrame:
    """Distinct same-site links per page in document order, with their rank; a crawl queue of n takes rank <= n.

    A page's anchors are one array: resolved, filtered and made distinct in place, without a shuffle.
    """
    p = _resolved_links(pages)

    def internal(u):
        site, path = _target(u)
        return (site == F.col("site")) & ~path.isin("", "/")

    kept = F.array_distinct(F.filter("urls", internal))
    rows = p.select("page_id", "site", "urls", F.posexplode(kept).alias("nth", "target_url"))
    return rows.select(
        "page_id", "site", "target_url", _target(F.col("target_url"))[1].alias("target_path"),
        (F.array_position("urls", F.col("target_url")) - 1).alias("first_pos"), (F.col("nth") + 1).alias("rank"),
    )


def site_link_graph(pages: DataFrame) -> DataFrame:
    """In- and out-degree per crawled path of a site; `orphan` marks paths nothing links to.

    Edges are aggregated to degrees before the join, so a site's hub paths arrive as single rows.
    """
    edges = internal_links(pages)
    inbound = edges.groupBy("site", F.col("target_path").alias("path")).agg(F.count("*").alias("in_links"))
    outbound = edges.groupBy("page_id").agg(F.count("*").alias("out_links"))
    nodes = with_site(pages).select(
        "page_id", "site", F.regexp_extract("url", r"^https?://[^/?#]+([^?#]*)", 1).alias("path")
    )
    nodes = nodes.join(outbound, "page_id", "left").groupBy("site", "path").agg(
        F.count("*").alias("pages"), F.coalesce(F.sum("out_links"), F.lit(0)).alias("out_links")
    )
    joined = nodes.join(inbound, ["site", "path"], "full")
    return joined.select(
        "site", "path",
        F.coalesce("pages", F.lit(0)).alias("pages"),
        F.coalesce("out_links", F.lit(0)).alias("out_links"),
        F.coalesce("in_links", F.lit(0)).alias("in_links"),
        (F.col("pages").isNotNull() & F.col("in_links").isNull()).alias("orphan"),
        F.col("pages").isNull().alias("uncrawled"),
    )


def script_blocks(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    code = F.regexp_extract_all("html", F.lit(r"(?is)<script[^>]*>(.*?)</script>"), F.lit(1))
    rows = pages.select("page_id", *carry, F.posexplode(code).alias("pos", "code")).withColumn("code", trim_ws(F.col("code")))
    rows = rows.filter("code != ''")
    gsap = F.col("code").rlike(r"(?i)\bgsap\.|ScrollTrigger")
    anim = F.col("code").rlike(r"(?i)\banimat|\.animate\(|requestAnimationFrame|intersectionObserver")
    transform = F.col("code").rlike(r"(?i)\btransform\b|\.style\.\w+") & (F.length("code") > 50)
    plugins = F.array_compact(
        F.array(*[F.when(F.col("code").rlike("(?i)" + p + (r"\b" if p == "Flip" else "")), F.lit(p)) for p in GSAP_PLUGINS])
    )
    return rows.select(
        "page_id", *carry, "pos",
        F.when(gsap, "gsap").when(anim | transform, "js").otherwise("other").alias("script_type"),
        F.when(gsap, F.array_join(plugins, ",")).otherwise("").alias("plugins"),
        F.length("code").alias("length"),
    )


def script_inventory(pages: DataFrame) -> DataFrame:
    """Inline scripts per site and class, with code length and the plugins met."""
    s = script_blocks(with_site(pages), ("site",))
    return s.groupBy("site", "script_type", "plugins").agg(
        F.count("*").alias("scripts"), F.sum("length").alias("code_chars"), F.max("length").alias("longest")
    )


def third_party_requests(pages: DataFrame) -> DataFrame:
    """Requests to tracking hosts per site: `src`/`href` hosts containing a listed domain.

    The list is a fixed value, so the match is an expression on the request row, not a join.
    """
    urls = F.regexp_extract_all("html", F.lit(r"(?i)\s(?:src|href)=[\"'](https?://[^\"']+)[\"']"), F.lit(1))
    rows = with_site(pages).select("page_id", "site", F.explode(urls).alias("u"))
    host = F.lower(F.regexp_extract("u", r"^https?://([^/?#:]+)", 1))
    domains = [(d, "shared") for d in SHARED_TRACKING_HOSTS]
    domains += [(d, p) for p, ds in PLATFORM_TRACKING_HOSTS.items() for d in ds]
    hits = F.array_compact(
        F.array(*[F.when(F.contains(host, F.lit(d)), F.struct(F.lit(d).alias("domain"), F.lit(p).alias("list"))) for d, p in domains])
    )
    rows = rows.select("page_id", "site", F.inline(hits))
    per_page = rows.groupBy("site", "domain", "list", "page_id").agg(F.count("*").alias("n"))
    return per_page.groupBy("site", "domain", "list").agg(F.sum("n").alias("requests"), F.count("*").alias("pages"))


def platform_detect(pages: DataFrame, default: str | None = None) -> DataFrame:
    """Site builder per page: URL rules first, then markers in the HTML; `default` when nothing matches."""
    tests = [
        (prio, name, kind, F.col(kind).rlike(pattern)) for name, prio, kind, pattern in PLATFORM_RULES
    ]
    tests.append(
        (4, "framer", "html", F.contains(F.col("html"), F.lit(FRAMER_MAIN_MARKER)) & F.col("html").rlike(FRAMER_HOST_MARKER))
    )
    tests.sort(key=lambda t: t[0])
    platform, evidence = F.lit(default), F.lit(None).cast("string")
    for _, name, kind, cond in reversed(tests):
        platform = F.when(cond, name).otherwise(platform)
        evidence = F.when(cond, kind).otherwise(evidence)
    return with_site(pages).select("page_id", "site", platform.alias("platform"), evidence.alias("evidence"))


def platform_by_site(pages: DataFrame) -> DataFrame:
    """Most frequent builder of each site (ties: name order) with its share of the site's pages."""
    n = platform_detect(pages).groupBy("site", "platform").agg(F.count("*").alias("n"))
    g = n.groupBy("site").agg(
        F.sum("n").alias("pages"),
        F.min(F.when(F.col("platform").isNotNull(), F.struct((-F.col("n")).alias("neg"), "platform"))).alias("best"),
    )
    return g.select(
        "site", "pages", F.col("best.platform").alias("platform"),
        F.coalesce(-F.col("best.neg"), F.lit(0)).alias("platform_pages"),
    )


def project_match(pages: DataFrame) -> DataFrame:
    """Project id written in the page against the slug of its URL; one row per page carrying an id."""
    embedded = F.lower(F.regexp_extract("html", r"(?i)data-project-id=[\"']([^\"']+)[\"']", 1))
    slug = F.lower(F.regexp_extract("url", r"^https?://([^/?#.]+)", 1))
    p = pages.select("page_id", site_of(F.col("url")).alias("site"), embedded.alias("embedded_id"), slug.alias("url_slug"))
    p = p.filter("embedded_id != ''")
    return p.withColumn("matches", F.col("embedded_id") == F.col("url_slug"))
