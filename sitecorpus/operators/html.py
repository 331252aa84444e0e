"""Pages to tags, tags to nested elements, and the per-page figures built on them.

Everything after the tag split is keyed by page_id: one exchange on slim tag rows serves every later window,
because a hash distribution on page_id also satisfies (page_id, level) and (page_id, pos) requirements.
A page's tags come out of one HTML cell, so a page group is never larger than a single input value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from sitecorpus.functions.columns import bind, site_of, trim_ws
from sitecorpus.functions.dims import VOID_TAGS

# A tag's attributes, where a quoted value may hold ">" (one with a lone quote ends at the first); and the text after a tag,
# up to the next "<" that begins a tag. Loops run per quoted value and per bare "<", not per character.
ATTRS = r"""(?:[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*|[^>]*)"""
TEXT = r"[^<]*(?:<(?![/]?[A-Za-z])[^<]*)*"
_TAG = rf"^<(/?)([A-Za-z][A-Za-z0-9-]*)({ATTRS})>"
_TOKEN = rf"<[/]?[A-Za-z]{ATTRS}>{TEXT}"


def with_site(pages: DataFrame) -> DataFrame:
    return pages.withColumn("site", site_of(F.col("url")))


def _markup(html):
    h = F.regexp_replace(html, r"(?is)<!--.*?-->", "")
    h = F.regexp_replace(h, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")
    h = F.regexp_replace(h, r"(?is)<script([^>]*)>.*?</script>", "<script$1></script>")
    return F.regexp_replace(h, r"(?is)<style([^>]*)>.*?</style>", "<style$1></style>")


def html_tokens(pages: DataFrame) -> DataFrame:
    """One row per tag: (page_id, pos, kind open|close|self, tag, attrs, text after the tag)."""
    raw = pages.select(
        "page_id",
        F.posexplode(F.regexp_extract_all(_markup(F.col("html")), F.lit(_TOKEN), F.lit(0))).alias(
            "pos", "tok"
        ),
    )
    parts = raw.select(
        "page_id",
        "pos",
        F.regexp_extract("tok", _TAG, 1).alias("slash"),
        F.lower(F.regexp_extract("tok", _TAG, 2)).alias("tag"),
        F.regexp_extract("tok", _TAG, 3).alias("attrs"),
        F.regexp_replace("tok", rf"^<{ATTRS}>", "").alias("text"),
    )
    kind = (
        F.when(F.col("slash") == "/", "close")
        .when(F.col("attrs").endswith("/") | F.col("tag").isin(*VOID_TAGS), "self")
        .otherwise("open")
    )
    return parts.select("page_id", "pos", kind.alias("kind"), "tag", "attrs", trim_ws(F.col("text")).alias("text"))


def leveled_tokens(tokens: DataFrame) -> DataFrame:
    """Tags with their nesting level (root = 1). Any close tag pops one level; surplus close tags are ignored."""
    by_page = W.partitionBy("page_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    step = F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)
    run = tokens.withColumn("run", F.sum(step).over(by_page))
    low = F.least(F.lit(0), F.min("run").over(by_page))
    after = run.withColumn("after", F.col("run") - low).drop("run")
    return after.withColumn(
        "level", F.when(F.col("kind") == "open", F.col("after")).otherwise(F.col("after") + 1)
    ).drop("after")


def element_rows(pages: DataFrame, parts: int | None = None) -> DataFrame:
    """Nested elements: (page_id, pos, parent_pos, ord, depth, tag, attrs, text); depth of a root is 0.

    The parent of an element at level L is the last opening tag at level L-1 before it. Each element
    contributes an opener row at L and a probe row at L-1, so one window per (page, level) finds every
    parent without a join. `parts` fixes in how many parts the pages are dealt out; the sorts of later windows hold a part each.
    """
    t = html_tokens(pages)
    lv = leveled_tokens(t.repartition(parts, "page_id") if parts else t)
    by_page = W.partitionBy("page_id").orderBy("pos")
    lv = lv.withColumn("next_kind", F.lead("kind").over(by_page)).filter(F.col("kind") != "close")
    lv = lv.withColumn(
        "text", F.when((F.col("kind") == "open") & (F.col("next_kind") == "close"), F.col("text")).otherwise("")
    ).drop("next_kind")
    return nested(lv)


def nested(leveled: DataFrame) -> DataFrame:
    """Opening and self-closing tags with a level and text, as nested elements."""
    # The opener rows only mark positions, so they travel without attributes and text.
    two = leveled.withColumn("probe", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns({
        "lvl": F.col("level") - F.col("probe"),
        "attrs": F.when(F.col("probe") == 1, F.col("attrs")),
        "text": F.when(F.col("probe") == 1, F.col("text")),
    })
    opener = F.when((F.col("probe") == 0) & (F.col("kind") == "open"), F.col("pos"))
    by_level = W.partitionBy("page_id", "lvl").orderBy("pos", "probe").rowsBetween(W.unboundedPreceding, 0)
    probes = two.withColumn("parent_pos", F.last(opener, ignorenulls=True).over(by_level)).filter("probe = 1")
    siblings = W.partitionBy("page_id", "parent_pos").orderBy("pos")
    return probes.select(
        "page_id",
        "pos",
        "parent_pos",
        F.row_number().over(siblings).alias("ord"),
        (F.col("level") - 1).alias("depth"),
        "kind",
        "tag",
        "attrs",
        "text",
    )


def dom_depth(pages: DataFrame) -> DataFrame:
    """Deepest element per page with its tag path; warn from depth 4, error from depth 6.

    Ancestors of the deepest element are the last openers of each smaller level before it, so the path
    costs one aggregate per (page, level) instead of a walk.
    """
    lv = leveled_tokens(html_tokens(pages)).filter(F.col("kind") != "close")
    deepest = lv.groupBy("page_id").agg(
        F.min(F.struct((-F.col("level")).alias("neg"), "pos", "tag")).alias("d"), F.count("*").alias("elements")
    )
    deepest = deepest.select(
        "page_id",
        (-F.col("d.neg")).alias("deep"),
        F.col("d.pos").alias("deep_pos"),
        F.col("d.tag").alias("deep_tag"),
        "elements",
    )
    above = lv.filter(F.col("kind") == "open").join(deepest, "page_id").filter("pos < deep_pos and level < deep")
    chain = above.groupBy("page_id", "level").agg(F.max_by("tag", "pos").alias("tag"))
    chain = chain.groupBy("page_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("level", "tag"))), lambda s: s["tag"]), "/").alias(
            "above"
        )
    )
    out = deepest.join(chain, "page_id", "left")
    depth = F.col("deep") - 1
    return out.select(
        "page_id",
        depth.alias("max_depth"),
        F.concat_ws("/", F.when(F.col("above") != "", F.col("above")), "deep_tag").alias("deepest_path"),
        "elements",
        F.when(depth >= 6, "error").when(depth >= 4, "warning").otherwise("ok").alias("status"),
    )


def subtree_counts(pages: DataFrame) -> DataFrame:
    """Elements below each element, from the interval between its opening and the event that closes it."""
    lv = leveled_tokens(html_tokens(pages))
    by_page = W.partitionBy("page_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    counted = lv.withColumn("seen", F.sum(F.when(F.col("kind") != "close", 1).otherwise(0)).over(by_page)).withColumn(
        "total", F.count(F.when(F.col("kind") != "close", 1)).over(W.partitionBy("page_id"))
    )
    # A close tag sits on the level it closes; the next such tag on the same level ends the subtree.
    by_level = W.partitionBy("page_id", "level").orderBy("pos")
    ends = counted.filter(F.col("kind") != "self").withColumn("end_seen", F.lead("seen").over(by_level))
    opened = ends.filter(F.col("kind") == "open").select(
        "page_id", "pos", "tag", (F.coalesce("end_seen", "total") - F.col("seen")).alias("descendants")
    )
    leaves = counted.filter(F.col("kind") == "self").select("page_id", "pos", "tag", F.lit(0).cast("bigint").alias("descendants"))
    return opened.unionByName(leaves)


_CONTAINERS = ("div", "section", "main", "header", "footer", "nav", "article", "aside", "ul", "ol")


def page_inventory(pages: DataFrame) -> DataFrame:
    """Per page: elements, containers, css blocks, scripts, images, links, forms, headings.

    Counts per tag class need no nesting, so there is no window: a partial aggregate per page.
    """
    t = html_tokens(pages).filter(F.col("kind") != "close")

    def n(cond):
        return F.count(F.when(cond, 1))

    tag = F.col("tag")
    return t.groupBy("page_id").agg(
        F.count("*").alias("elements"),
        n(tag.isin(*_CONTAINERS)).alias("containers"),
        n(tag == "style").alias("css_blocks"),
        n(tag == "script").alias("scripts"),
        n(tag == "img").alias("images"),
        n((tag == "a") & F.col("attrs").rlike(r"(?i)\shref\s*=")).alias("links"),
        n(tag == "form").alias("forms"),
        n(tag.rlike("^h[1-6]$")).alias("headings"),
    )


def heading_skip_array(html):
    """Headings more than one level below the one before, as an array of (pos, prev_level, level)."""
    levels = F.transform(F.regexp_extract_all(html, F.lit(r"(?i)<h([1-6])[\s>]"), F.lit(1)), lambda x: x.cast("int"))
    steps = bind(levels, lambda ls: F.transform(
        ls, lambda x, i: F.struct(i.alias("pos"), F.get(ls, i - 1).alias("prev_level"), x.alias("level"))
    ))
    return F.filter(steps, lambda s: s["level"] > s["prev_level"] + 1)


def heading_skips(pages: DataFrame) -> DataFrame:
    """Heading skips per page, compared in place (no shuffle); `is_first` marks the one an audit reports."""
    rows = pages.select("page_id", F.posexplode(heading_skip_array(F.col("html"))).alias("nth", "s"))
    return rows.select("page_id", "s.pos", "s.prev_level", "s.level", (F.col("nth") == 0).alias("is_first"))


def page_text_summary(pages: DataFrame) -> DataFrame:
    """Title (60 characters at most) and the first three text blocks over 20 characters as a description.

    A page's tags and texts are one array, so the blocks are picked in place and no text is shuffled.
    """
    tokens = F.regexp_extract_all(_markup(F.col("html")), F.lit(_TOKEN), F.lit(0))

    def block(t):
        tag = F.lower(F.regexp_extract(t, _TAG, 2))
        text = trim_ws(F.regexp_replace(F.regexp_replace(t, rf"^<{ATTRS}>", ""), r"[\s\x{00A0}]+", " "))
        return F.when(~tag.isin("title", "script", "style"), text)

    blocks = F.filter(F.transform(tokens, block), lambda x: F.length(x) > 20)
    p = pages.select(
        "page_id", trim_ws(F.regexp_extract("html", r"(?i)<title[^>]*>([^<]*)</title>", 1)).alias("title"), F.slice(blocks, 1, 3).alias("b")
    ).withColumn("t", F.when(F.size("b") > 0, F.array_join("b", " ")))
    cut = F.regexp_replace(F.substring("t", 1, 155), r"\s+\S*$", "")
    desc = F.when(F.length("t") > 155, F.concat(cut, F.lit("…"))).otherwise(F.col("t"))
    return p.select("page_id", F.substring("title", 1, 60).alias("title"), desc.alias("description"), F.size("b").alias("blocks"))


def element_signatures(elements: DataFrame) -> DataFrame:
    """Per parent with two or more children: md5 over the ordered `tag|child count` of its children."""
    kids = elements.groupBy("page_id", F.col("parent_pos").alias("pos")).agg(F.count("*").alias("kids"))
    sized = elements.join(kids.filter("pos is not null"), ["page_id", "pos"], "left")
    part = F.concat_ws("|", "tag", F.coalesce("kids", F.lit(0)).cast("string"))
    per_parent = sized.filter("parent_pos is not null").groupBy("page_id", "parent_pos").agg(
        F.count("*").alias("n_children"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", part.alias("p")))), lambda s: s["p"]), "::").alias("raw"),
    )
    return per_parent.filter("n_children >= 2").select(
        "page_id", "parent_pos", "n_children", F.md5("raw").alias("struct_hash")
    )


def component_candidates(pages: DataFrame, elements: DataFrame | None = None, min_dups: int = 2) -> DataFrame:
    """Repeated child structures in a page, a site and the whole corpus.

    The corpus level aggregates the site level, which aggregates the page level: hot structures reach
    the shuffle already counted. `elements` may name a written table of the pages' element rows, which are read twice.
    """
    sigs = element_signatures(element_rows(pages) if elements is None else elements)
    sites = with_site(pages).select("page_id", "site")
    per_page = sigs.groupBy("page_id", "struct_hash", "n_children").agg(F.count("*").alias("n"))
    per_page = per_page.join(sites, "page_id")
    per_site = per_page.groupBy("site", "struct_hash", "n_children").agg(F.sum("n").alias("n"), F.count("*").alias("pages"))
    corpus = per_site.groupBy("struct_hash", "n_children").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"))

    def out(df, scope, key):
        return df.filter(F.col("n") >= min_dups).select(
            F.lit(scope).alias("scope"), key.alias("scope_key"), "struct_hash", "n_children",
            F.col("n").alias("occurrences"), F.col("pages").alias("pages"),
        )

    return (
        out(per_page.withColumn("pages", F.lit(1).cast("bigint")), "page", F.col("page_id").cast("string"))
        .unionByName(out(per_site, "site", F.col("site")))
        .unionByName(out(corpus, "corpus", F.lit("*")))
    )


def boilerplate_strip(pages: DataFrame, rules) -> DataFrame:
    """Characters each removal rule takes from a page, in rule order, and the length that remains."""
    cols = []
    h = F.col("html")
    for name, pattern in rules:
        nxt = F.regexp_replace(h, pattern, "")
        cols.append(F.struct(F.lit(name).alias("rule"), (F.length(h) - F.length(nxt)).alias("removed")))
        h = nxt
    return pages.select("page_id", "url", F.length("html").alias("before"), F.array(*cols).alias("steps"))


def without_cdn_srcset(html):
    """A page whose srcset lists keep only entries that are no absolute addresses; an empty list goes with its attribute."""

    def cleaned(part):
        end = F.instr(part, '"')
        entries = F.transform(F.split(F.substring(part, F.lit(1), end - 1), ","), trim_ws)
        left = F.array_join(F.filter(entries, lambda e: ~F.startswith(e, F.lit("http"))), ", ")
        rest = F.substring(part, end + 1, F.length(part))
        return F.when(end == 0, F.concat(F.lit('srcset="'), part)).otherwise(F.concat(F.when(left != "", F.concat(F.lit('srcset="'), left, F.lit('"'))).otherwise(""), rest))

    return F.array_join(F.transform(F.split(html, 'srcset="'), lambda p, i: F.when(i == 0, p).otherwise(cleaned(p))), "")


def srcset_strip(pages: DataFrame) -> DataFrame:
    """Pages with their absolute srcset entries removed: (page_id, html, removed characters)."""
    out = without_cdn_srcset(F.col("html"))
    return pages.select("page_id", out.alias("html"), (F.length("html") - F.length(out)).alias("removed"))


def boilerplate_report(pages: DataFrame, rules) -> DataFrame:
    """Removed characters per site and rule."""
    s = with_site(boilerplate_strip(pages, rules)).select("site", F.inline("steps"))
    return s.groupBy("site", "rule").agg(
        F.sum("removed").alias("removed_chars"), F.count(F.when(F.col("removed") > 0, 1)).alias("pages_hit")
    )
