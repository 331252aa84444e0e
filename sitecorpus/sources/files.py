"""File sources and sinks: style sheets, design-tool XML, asset folders, reports, verified artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sitecorpus.operators.assets import mime_of

_SKIPPED = r"(^|/)(\.[^/]+|node_modules|Thumbs\.db)(/|$)"
TEXT_STYLE_SCHEMA = (
    "site string, name string, font_size string, font_weight string, font_family string, line_height string, letter_spacing string, color string"
)


def read_css(spark: SparkSession, path: str, pattern: str = "*.css") -> DataFrame:
    """Style sheets below a folder, one row per file: (source, css)."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("css"))


def read_css_bundles(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Style sheets of bundle files, many records a file: (source, css). A record names its sheet; without a name the file
    and the record's place in it do. Records that are no JSON objects are left out."""
    lines = numbered_lines(spark, path, pattern)
    record = F.from_json("value", "source string, css string")
    return lines.select(F.coalesce(record["source"], F.concat_ws("#", "source", "place")).alias("source"), record["css"].alias("css")).filter("css is not null")


def numbered_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Lines of all files below a folder: (source, place, value); place is the byte at which the line begins, if lines end
    in one byte.

    Lines of a block are added up within the block, blocks by one row each, so a huge file is not ordered in one task.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    at = F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth")
    lines = raw.select(*at, "value", (F.octet_length("value") + 1).cast("bigint").alias("bytes"))
    blocks = lines.groupBy("source", "block").agg(F.sum("bytes").alias("size"))
    start = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("bytes").over(Window.partitionBy("source", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.withColumn("inside", inside).join(blocks.select("source", "block", start.alias("start")), ["source", "block"])
    return placed.select("source", (F.col("start") + F.col("inside")).alias("place"), "value")


def read_style_xml(spark: SparkSession, path: str, tag: str = "TextStyle", schema: str = TEXT_STYLE_SCHEMA) -> DataFrame:
    """Named styles of design-tool XML, one row per `tag` element (TextStyle, ColorStyle or Color)."""
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def looks_like_xml(c):
    return F.when(F.ltrim(c).startswith("<"), "xml").otherwise("json")


def asset_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder with size, extension and mime type; file contents are not read.

    Hidden files, dependency folders and thumbnails databases are skipped.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    rel = F.regexp_extract("path", rf"{path.rstrip('/').replace('.', '[.]')}/(.*)$", 1)
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    f = files.withColumn("rel", rel).filter(~F.col("rel").rlike(_SKIPPED))
    return f.select(F.col("rel").alias("path"), "length", ext.alias("extension"), mime_of(ext).alias("mime"))


def write_report(df: DataFrame, path: str, partition_by: str | None = None, fmt: str = "parquet") -> None:
    """A report table, replaced as a whole; rows of a partition are gathered first, so each gets few files."""
    w = (df.repartition(partition_by) if partition_by and fmt == "json" else df).write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).format(fmt).save(path)


def row_hashes(df: DataFrame, key: str) -> DataFrame:
    """(key, sha256) of every row of an output table."""
    rest = [c for c in df.columns if c != key]
    return df.select(key, F.sha2(F.to_json(F.struct(*rest)), 256).alias("sha256"))


def verify_artifacts(stored: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Stored hashes against recomputed ones: valid, changed, missing or unexpected."""
    j = stored.select(key, F.col("sha256").alias("want")).join(actual.select(key, F.col("sha256").alias("got")), key, "full")
    state = (
        F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "unexpected")
        .when(F.col("want") == F.col("got"), "valid").otherwise("changed")
    )
    return j.select(key, state.alias("state"))
