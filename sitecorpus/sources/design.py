"""Design-system tables derived from the corpus itself: a kit that agrees with the CSS in part only.

Each token or font face is kept, changed or left out by a hash of its key, so the cross-checks meet matches,
mismatches and gaps in every site, and the tables grow with the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitecorpus.operators.tokens import _weight_number, decode_font, weight_name


def _digit(*cols):
    return F.substring(F.md5(F.concat(*cols)), 1, 1)


def design_vars(catalog: DataFrame) -> DataFrame:
    """(site, gv_id, label, type, value, hex, ord) of the site's kit; `ord` orders its entries."""
    d = catalog.withColumn("h", _digit("site", "name")).filter("h >= '4'")
    drifted = F.col("h") < "8"
    return d.select(
        "site", F.concat(F.lit("e-gv-"), F.substring(F.md5(F.concat(F.lit("kit:"), "site", "name")), 1, 7)).alias("gv_id"),
        F.when(F.col("h") < "c", F.col("label")).otherwise(F.concat(F.lit("renamed "), "label")).alias("label"),
        F.col("token_type").alias("type"),
        F.when(drifted, F.lit("#123456")).otherwise(F.col("value")).alias("value"),
        F.when(drifted, F.lit("#123456")).otherwise(F.col("hex")).alias("hex"),
        F.col("name").alias("ord"),
    )


def previous_mapping(catalog: DataFrame) -> DataFrame:
    p = catalog.filter(_digit("name", F.lit("prev")) < "8")
    return p.select("site", "name", F.concat(F.lit("e-gv-prev"), F.substring(F.md5("name"), 1, 3)).alias("gv_id"))


def style_paths(kit: DataFrame) -> DataFrame:
    return kit.filter("hex is not null").select("site", F.concat(F.lit("/Colors/"), "label").alias("path"), "hex", "ord")


def design_fonts(site_faces: DataFrame) -> DataFrame:
    """Fonts as the design tool writes them, decoded to family and weight."""
    f = site_faces.select("site", "family", _weight_number(F.col("weight")).alias("w")).distinct()
    w = F.when(_digit("site", "family") >= "c", F.lit(900)).otherwise(F.col("w"))
    sel = F.concat(F.lit("FR;"), F.regexp_replace("family", " ", ""), F.lit("-"), weight_name(w))
    return f.select("site", sel.alias("selector"), decode_font(sel).alias("d")).select(
        "site", "selector", F.col("d.family").alias("family"), F.col("d.weight").alias("weight")
    ).distinct()


def font_files(site_faces: DataFrame) -> DataFrame:
    f = site_faces.select("site", "family", _weight_number(F.col("weight")).alias("w")).distinct()
    h = _digit("family", "site")
    base = F.regexp_replace("family", " ", "")
    file = (
        F.when(h < "8", F.concat(base, F.lit("-"), weight_name(F.col("w")), F.lit(".woff2")))
        .when(h < "c", F.concat(base, F.lit(".woff")))
        .otherwise(F.concat(F.lit("extra-"), base, F.lit(".ttf")))
    )
    return f.select("site", file.alias("file")).distinct()


def _number(*cols):
    """Six hex digits of a hash as a whole number."""
    return F.conv(F.substring(F.md5(F.concat(*cols)), 1, 6), 16, 10).cast("bigint")


def media_library(manifest: DataFrame) -> DataFrame:
    """Media records of part of the manifest: some by URL, some known by file name only."""
    m = manifest.groupBy("url").agg(F.min("filename").alias("filename")).withColumn("h", _digit("url")).filter("h < 'a'")
    by_url = F.col("h") < "6"
    n = _number("url")
    none = F.lit(None).cast("bigint")
    return m.select(
        F.when(by_url, F.col("url")).alias("url"), "filename",
        F.when(F.col("h") < "3", n).otherwise(none).alias("wp_media_id"),
        F.when(by_url, n + 1).otherwise(none).alias("media_id"), (n + 2).alias("id"),
    )


def media_texts(manifest: DataFrame) -> DataFrame:
    f = manifest.select("filename").distinct().withColumn("h", _digit("filename"))
    return f.select(
        "filename", F.when(F.col("h") < "5", F.concat(F.lit("Picture of_the "), "filename")).alias("description"),
        F.when(F.col("h") < "a", F.concat(F.lit("theTitle-of "), F.repeat("filename", 6))).alias("title"),
    )


def uploaded(manifest: DataFrame) -> DataFrame:
    return manifest.filter(_digit("url", F.lit("up")) < "8").select("site", "url")


def upload_results(manifest: DataFrame) -> DataFrame:
    r = manifest.withColumn("h", _digit("url", F.lit("res"))).filter("h < 'a'")
    ok = F.col("h") < "7"
    return r.select("site", "url", F.when(ok, _number("url")).alias("media_id"), F.when(~ok, F.lit("timeout")).alias("error"))
