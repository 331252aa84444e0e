"""Assets, forms and media: references in pages, manifest, upload queue, media ids, alternative texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from sitecorpus.functions.columns import trim_ws
from sitecorpus.functions.dims import MIME
from sitecorpus.operators.html import with_site


def _matches(pattern, group=1):
    return F.regexp_extract_all("html", F.lit(pattern), F.lit(group))


def asset_references(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every http(s) asset URL of a page with its context, in document order per context."""
    srcsets = F.flatten(F.transform(
        _matches(r"(?i)<img[^>]+srcset=[\"']([^\"']+)[\"']"),
        lambda s: F.transform(F.split(s, ","), lambda p: F.regexp_extract(p, r"^\s*(\S+)", 1)),
    ))
    kinds = [
        ("html:img[src]", _matches(r"(?i)<img[^>]*?\ssrc=[\"']([^\"']+)[\"']")),
        ("html:img[srcset]", srcsets),
        ("html:background-image", _matches(r"(?i)background(?:-image)?\s*:[^;]*?url\(\s*[\"']?([^\"')]+)[\"']?\s*\)")),
        ("html:video[src]", _matches(r"(?i)<video[^>]+src=[\"']([^\"']+)[\"']")),
        ("html:source[src]", _matches(r"(?i)<source[^>]+src=[\"']([^\"']+)[\"']")),
    ]
    # One pass: five arrays side by side, exploded together, instead of five scans under a union.
    def tagged(n, k, urls):
        return F.transform(urls, lambda u, i: F.struct(
            F.lit(n).alias("context_ix"), F.lit(k).alias("context"), i.alias("pos"), trim_ws(u).alias("url")))

    all_refs = F.flatten(F.array(*[tagged(n, k, urls) for n, (k, urls) in enumerate(kinds)]))
    return pages.select("page_id", *carry, F.inline(all_refs)).filter(F.col("url").startswith("http"))


# Paths of a value that name an image's address, and the host that layout XML loads images from.
IMAGE_PATH = r"(^|\.)(image[-_]src|src)(\.value)?\.url(\.value)?$"
_XML_SRC = r"""(?i)src=["']?(https?://framerusercontent\.com/[^"'\s>]+)"""


def tree_asset_references(elements: DataFrame, values: DataFrame) -> DataFrame:
    """Image addresses in element trees (elements, and every text below them with its path, `sources.trees.tree_values`):
    (page_id, context_ix, context with the element's id, pos, url), at any depth of settings and styles."""
    found = values.filter((F.col("kind") == "string") & F.col("path").rlike(IMAGE_PATH) & F.col("text").startswith("http"))
    named = elements.select("page_id", "node_ix", F.coalesce("node_id", F.lit("?")).alias("node_id"))
    j = found.join(named, ["page_id", "node_ix"])
    return j.select("page_id", F.lit(5).alias("context_ix"), F.concat(F.lit("element-tree:"), "node_id").alias("context"), F.col("node_ix").alias("pos"), F.col("text").alias("url"))


def xml_asset_references(docs: DataFrame) -> DataFrame:
    """Image addresses in layout XML (page_id, xml): (page_id, context_ix, context, pos, url) in document order."""
    urls = F.transform(F.regexp_extract_all("xml", F.lit(_XML_SRC), F.lit(1)), lambda u, i: F.struct(i.alias("pos"), F.replace(u, F.lit("&amp;"), F.lit("&")).alias("url")))
    return docs.select("page_id", F.lit(6).alias("context_ix"), F.lit("mcp-xml:src").alias("context"), F.inline(urls))


def classify_asset_url(url):
    """(type, extension, filename) of an asset URL without its query."""
    low = F.lower(F.regexp_extract(url, r"^([^?]*)", 1))
    kind = (
        F.when(low.rlike(r"\.(mp4|webm|mov|ogg|avi)$"), "video")
        .when(low.rlike(r"\.svg$"), "svg")
        .when(low.rlike(r"\.(png|jpg|jpeg|gif|webp|avif|bmp|ico|tiff?)$"), "image")
        .when(F.contains(low, F.lit("framerusercontent.com/images/")), "image")
        .when(F.contains(low, F.lit("framerusercontent.com/assets/")), F.when(low.rlike(r"\.(mp4|webm|mov)"), "video").otherwise("image"))
        .otherwise("other")
    )
    name = F.regexp_extract(url, r"^[^?]*?([^/?]*)(?:\?.*)?$", 1)
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    return kind, F.coalesce(F.nullif(ext, F.lit("")), F.lit("unknown")), name


_IMG = r"\.(jpg|jpeg|png|gif|svg|webp|avif|ico)$"
_FONT = r"\.(woff2|woff|ttf|otf|eot)$"


def asset_folder(url):
    """Export folder of an asset: rules by host first, then by file type. Hosts are fixed values."""
    host = F.lower(F.regexp_extract(url, r"(?i)^https?://([^/?#]+)", 1))
    path = F.regexp_extract(url, r"(?i)^https?://[^/?#]+([^?#]*)", 1)
    low = F.lower(path)

    def on(h):
        return F.contains(host, F.lit(h))

    framer_user = (
        F.when(path.startswith("/images/"), "assets/images")
        .when(path.startswith("/assets/"), F.when(low.rlike(_FONT), "assets/fonts").otherwise("assets/misc"))
        .when(path.startswith("/sites/"), F.when(low.rlike(r"\.m?js$"), "scripts/vendor").when(low.rlike(r"\.(json|framercms)$"), "data").when(low.rlike(r"\.css$"), "styles").otherwise("assets/misc"))
        .when(path.startswith("/modules/"), F.when(low.rlike(r"\.framercms$"), "data").otherwise("scripts/modules"))
        .otherwise("assets/misc")
    )
    by_type = (
        F.when(low.rlike(r"\.(mp4|webm|ogg)$"), "assets/videos").when(low.rlike(_IMG), "assets/images")
        .when(low.rlike(r"\.css$"), "styles").when(low.rlike(r"\.js$"), "scripts/vendor")
        .when(low.rlike(_FONT), "assets/fonts").otherwise("assets/misc")
    )
    known = on("website-files.com") | on("webflow.com") | on("d3e54v103j8qbb.cloudfront.net") | on("wixstatic.com") | on("parastorage.com")
    return F.when(on("framerusercontent.com"), framer_user).when(host == "video.wixstatic.com", "assets/videos").when(known, by_type)


def filter_assets(refs: DataFrame, only: str = "all", cdn: str | None = None) -> DataFrame:
    """Keep one asset type and/or one CDN host."""
    if cdn:
        refs = refs.filter(F.contains("url", F.lit(cdn)))
    if only != "all":
        refs = refs.filter(classify_asset_url(F.col("url"))[0] == only)
    return refs


def asset_manifest(pages: DataFrame, only: str = "all", cdn: str | None = None, more: list[DataFrame] | None = None) -> DataFrame:
    """Assets per site, case-insensitively distinct, first spelling kept.

    Counts go through (site, asset, context) first: a logo on every page of a huge site is one partial row per task.
    `more` are references of other sources, each (site, page_id, context_ix, context, pos, url); their places follow those
    of the pages in the order of the list.
    """
    columns = ["site", "source", "page_id", "context_ix", "context", "pos", "url"]
    refs = asset_references(with_site(pages), ("site",)).withColumn("source", F.lit(0))
    if more:
        refs = refs.withColumn("page_id", F.col("page_id").cast("string"))
    for n, other in enumerate(more or [], 1):
        refs = refs.select(columns).unionByName(other.withColumn("source", F.lit(n)).withColumn("page_id", F.col("page_id").cast("string")).select(columns))
    refs = filter_assets(refs, only, cdn)
    at = F.struct("source", "page_id", "context_ix", "pos")
    per_context = refs.groupBy("site", F.lower("url").alias("key"), "context").agg(
        F.count("*").alias("n"), F.min(F.struct(at.alias("at"), "url")).alias("first")
    )
    g = per_context.groupBy("site", "key").agg(
        F.sum("n").alias("uses"), F.min("first").alias("first"), F.array_join(F.sort_array(F.collect_set("context")), ",").alias("contexts")
    )
    g = g.withColumn("url", F.col("first.url"))
    kind, ext, name = classify_asset_url(F.col("url"))
    return g.select(
        "site", "url", "uses", "contexts", kind.alias("type"), ext.alias("extension"), name.alias("filename"),
        asset_folder(F.col("url")).alias("folder"),
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    def n(k):
        return F.count(F.when(F.col("type") == k, 1))

    return manifest.groupBy("site").agg(
        F.sum("uses").alias("total_urls"), F.count("*").alias("unique_urls"), (F.sum("uses") - F.count("*")).alias("duplicates_removed"),
        n("image").alias("images"), n("video").alias("videos"), n("svg").alias("svg"), n("other").alias("other"),
    )


def mime_of(ext):
    out = F.lit("application/octet-stream")
    for k, v in MIME.items():
        out = F.when(ext == k, v).otherwise(out)
    return out


def inventory_rollup(manifest: DataFrame) -> DataFrame:
    """Files and uses per site and mime type, per site, and in total."""
    m = manifest.withColumn("mime", mime_of(F.col("extension")))
    r = m.rollup("site", "mime").agg(F.count("*").alias("files"), F.sum("uses").alias("uses"), F.grouping_id().alias("level"))
    return r


def upload_queue(manifest: DataFrame, uploaded: DataFrame) -> DataFrame:
    """What remains to upload: files not yet uploaded; unknown types are marked as errors."""
    m = manifest.withColumn("key", F.lower("url"))
    done = uploaded.select("site", F.lower("url").alias("key")).distinct().withColumn("done", F.lit(True))
    todo = m.join(done, ["site", "key"], "left")
    state = F.when(F.col("done"), "skip").when(F.col("type") == "other", "error").otherwise("queue")
    return todo.select("site", "url", "type", state.alias("state"))


def upload_results_merge(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """Upsert of upload results: a success sets the media id and clears the error, a failure records it."""
    m = manifest.select("site", F.lower("url").alias("key"), "url", F.lit(None).cast("bigint").alias("media_id0"))
    r = results.select("site", F.lower("url").alias("key"), F.col("url").alias("new_url"), "media_id", "error", F.lit(True).alias("seen"))
    j = m.join(r, ["site", "key"], "full")
    ok = F.col("media_id").isNotNull()
    return j.select(
        "site", F.coalesce("url", "new_url").alias("url"), F.coalesce("media_id", "media_id0").alias("media_id"),
        F.when(ok, F.lit(None)).otherwise(F.col("error")).alias("error"),
        F.when(F.col("seen").isNull(), "pending").when(ok, "uploaded").otherwise("failed").alias("status"),
    )


def media_resolve(refs: DataFrame, media: DataFrame) -> DataFrame:
    """Image references to media ids: by URL, else by file name; ids by precedence of their columns.

    Both dimensions are reduced to one row per key before the joins.
    """
    mid = F.coalesce("wp_media_id", "media_id", "id")
    by_url = media.filter(mid.isNotNull()).groupBy("url").agg(F.min(mid).alias("url_id"))
    by_name = media.filter(mid.isNotNull()).groupBy("filename").agg(F.min(mid).alias("name_id"))
    r = refs.withColumn("filename", classify_asset_url(F.col("url"))[2])
    j = r.join(by_url, "url", "left").join(by_name, "filename", "left")
    got = F.coalesce("url_id", "name_id")
    return j.select(
        "page_id", "context", "pos", F.when(got.isNull(), F.col("url")).alias("url"), got.alias("media_id"),
        F.when(F.col("url_id").isNotNull(), "url").when(F.col("name_id").isNotNull(), "filename").otherwise("none").alias("matched_by"),
    )


def alt_text_suggestions(pages: DataFrame, media: DataFrame, max_length: int = 60, overwrite: bool = False) -> DataFrame:
    """Alternative texts for images: description, else title, else the file name in words.

    `media` is (filename, description, title), one row per file name.
    """
    imgs = pages.select("page_id", F.posexplode(_matches(r"(?i)(<img[^>]*>)")).alias("pos", "tag"))
    src = F.regexp_extract("tag", r"(?i)\ssrc=[\"']([^\"']+)[\"']", 1)
    imgs = imgs.select(
        "page_id", "pos", classify_asset_url(src)[2].alias("filename"),
        F.regexp_extract("tag", r"(?i)\salt\s*=\s*[\"']([^\"']*)[\"']", 1).alias("alt"), src.alias("src"),
    ).filter(~F.col("src").startswith("data:"))
    j = imgs.join(media, "filename", "left")
    base = F.regexp_replace("filename", r"\.[^.]+$", "")
    source = _filled(F.col("description"), F.col("title"), base)
    words = F.regexp_replace(F.regexp_replace(source, "[-_]", " "), "([a-z])([A-Z])", "$1 $2")
    words = F.lower(trim_ws(F.regexp_replace(words, r"\s+", " ")))
    text = F.concat(F.upper(F.left(words, F.lit(1))), F.substring(words, 2, 2**31 - 1))
    short = F.when(F.length(text) > max_length, F.concat(F.substring(text, 1, max_length - 1), F.lit("…"))).otherwise(text)
    keep = (F.col("alt") != "") & F.lit(not overwrite)
    return j.select(
        "page_id", "pos", "filename", F.when(keep, F.col("alt")).otherwise(short).alias("alt_text"),
        F.when(keep, "skip").when(F.col("description") != "", "description").when(F.col("title") != "", "title").otherwise("filename").alias("action"),
    )


# --- forms --------------------------------------------------------------------------------------------------


def _attr(c, name):
    return F.regexp_extract(c, rf"(?i)(?:^|\s){name}=[\"']([^\"']+)[\"']", 1)


def _filled(*cols):
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def form_fields(pages: DataFrame, include_hidden: bool = True) -> DataFrame:
    """Fields of explicit forms; pages without one fall back to two or more loose inputs as a single form.

    The text before a field travels with it (a split at the field tags), so labels need no second look at the page.
    """
    forms = pages.select("page_id", F.posexplode(_matches(r"(?is)<form[^>]*>(.*?)</form>")).alias("form_ix", "body"))
    pattern = r"(?is).*?(?:<input\s[^>]*>|<textarea[^>]*>)"
    f = forms.select("page_id", "form_ix", F.posexplode(F.regexp_extract_all("body", F.lit(pattern), F.lit(0))).alias("field_ix", "chunk"))
    f = f.withColumn("attrs", F.regexp_extract("chunk", r"(?is)(?:<input\s|<textarea)([^>]*)>$", 1)).withColumn(
        "is_area", F.col("chunk").rlike(r"(?is)<textarea[^>]*>$")
    )
    before = F.regexp_extract("chunk", r"(?is)<label[^>]*>([^<]*)</label>\s*(?:<input\s[^>]*>)$", 1)
    for_id = F.regexp_extract("chunk", r"(?is)<label[^>]*for=[\"']([^\"']+)[\"'][^>]*>", 1)
    for_text = F.regexp_extract("chunk", r"(?is)<label[^>]*for=[\"'][^\"']+[\"'][^>]*>([^<]*)</label>", 1)
    name, ph, typ = _attr("attrs", "name"), _attr("attrs", "placeholder"), _attr("attrs", "type")
    f = f.filter(~F.col("is_area") | (name != ""))
    label = _filled(trim_ws(before), F.when((for_id != "") & (for_id == name), trim_ws(for_text)), name, ph, F.lit("Field"))
    out = f.select(
        "page_id", F.lit("form").alias("mode"), "form_ix", "field_ix",
        F.when(F.col("is_area"), "textarea").when(F.lower(typ) == "email", "email").otherwise("text").alias("type"),
        F.when(F.col("is_area"), name).otherwise(label).alias("label"),
        (~F.col("is_area") & F.col("attrs").rlike(r"(?i)\brequired\b")).alias("required"),
        F.lower(typ).isin("hidden", "submit").alias("hidden"),
    )
    if not include_hidden:
        out = out.filter(~F.col("hidden"))
    out = out.drop("hidden")
    loose = pages.select("page_id", F.posexplode(_matches(r"(?i)<input\s+([^>]*?)/?>")).alias("field_ix", "attrs"))
    loose = loose.filter(~F.lower(typ).isin("hidden", "submit")).join(out.select("page_id").distinct(), "page_id", "left_anti")
    w = W.partitionBy("page_id")
    loose = loose.withColumn("n", F.count("*").over(w)).filter("n >= 2")
    unnamed = (name == "") & (ph == "")
    nth = F.sum(unnamed.cast("int")).over(w.orderBy("field_ix").rowsBetween(W.unboundedPreceding, 0))
    loose = loose.select(
        "page_id", F.lit("loose").alias("mode"), F.lit(0).alias("form_ix"), "field_ix",
        F.when(F.lower(typ) == "email", "email").otherwise("text").alias("type"),
        _filled(name, ph, F.concat(F.lit("Field "), nth.cast("string"))).alias("label"),
        F.col("attrs").rlike("(?i)required").alias("required"),
    )
    return out.unionByName(loose)


def form_inventory(pages: DataFrame) -> DataFrame:
    """Forms per page with field counts and submit text."""
    g = form_fields(pages).groupBy("page_id", "mode", "form_ix").agg(
        F.count("*").alias("fields"), F.count(F.when(F.col("required"), 1)).alias("required_fields"),
        F.count(F.when(F.col("type") == "email", 1)).alias("email_fields"),
    )
    bodies = _matches(r"(?is)<form[^>]*>(.*?)</form>")
    submit = r"(?is)<button[^>]*type=[\"']submit[\"'][^>]*>(.*?)</button>"
    any_submit = r"(?i)<button[^>]*>(Submit|Send|Absenden|Senden|Sign Up|Subscribe)</button>"
    texts = pages.select("page_id", F.posexplode(F.transform(bodies, lambda b: F.regexp_extract(b, submit, 1))).alias("form_ix", "t"))
    texts = texts.select("page_id", F.lit("form").alias("mode"), "form_ix", trim_ws(F.col("t")).alias("t")).unionByName(
        pages.select("page_id", F.lit("loose").alias("mode"), F.lit(0).alias("form_ix"), F.regexp_extract("html", any_submit, 1).alias("t"))
    )
    return g.join(texts, ["page_id", "mode", "form_ix"], "left").select(
        "page_id", "mode", "form_ix", "fields", "required_fields", "email_fields", _filled(F.col("t"), F.lit("Submit")).alias("submit_text")
    )
