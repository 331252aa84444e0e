"""Exact duplicates by deterministic block naming.

A text without white space is cut into blocks of a fixed size. Equal blocks get equal integer names: blocks are dealt
into 2^64 buckets by a hash, and the distinct blocks of a bucket are sorted and numbered, so a name is (bucket, number).
Adjacent names are named in the same way, level by level, until one name is left: with the number of blocks it is the
identity of the text, and two texts have one identity only if they are equal. Numbers above 1 arise only in buckets
that hold several distinct contents; those are found over all data at every level, so no collision goes unseen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitecorpus.llm.frames import row_key
from sitecorpus.session import stage

BLOCK = 2048  # code points
WHITE = r"[\x20\x09-\x0D]+"


def _bucket(*content: Column) -> Column:
    return F.xxhash64(*content)


def _numbers(contents: DataFrame) -> DataFrame | None:
    """(bucket, content, number) of the buckets that hold several distinct contents, or None if there is no such bucket.

    contents has (bucket, content), a row per occurrence; equal ones are merged before they are shuffled.
    """
    distinct = contents.distinct()
    shared = stage(distinct.groupBy("bucket").count().filter("count > 1").select("bucket"), "shared-buckets")
    if shared.isEmpty():
        return None
    number = F.row_number().over(Window.partitionBy("bucket").orderBy("content"))
    return stage(distinct.join(shared, "bucket", "left_semi").select("bucket", "content", number.alias("number")), "block-numbers")


def _names(blocks: Column, bucket) -> Column:
    return F.transform(blocks, lambda b: F.struct(bucket(b).alias("k"), F.lit(1).alias("r")))


def _renamed(rows: DataFrame, contents: DataFrame, numbers: DataFrame) -> DataFrame:
    """rows(rid, …, names) with numbers taken from (bucket, content, number); contents has (rid, pos, bucket, content)."""
    changed = (
        contents.join(numbers.filter("number > 1"), ["bucket", "content"])
        .groupBy("rid").agg(F.map_from_entries(F.collect_set(F.struct("pos", "number"))).alias("new"))  # one text's blocks
    )
    names = F.transform("names", lambda x, i: F.struct(x["k"].alias("k"), F.coalesce(F.col("new")[i], x["r"]).alias("r")))
    return rows.join(changed, "rid", "left").withColumn("names", F.when(F.col("new").isNull(), F.col("names")).otherwise(names)).drop("new")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, bucket=_bucket) -> DataFrame:
    """Per row: rid (frames.row_key of id and text), doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id (null last), then the smallest key;
    rows repeated as a whole share a key and are kept or not together. Null text counts as empty, and all empty texts
    form one group. An empty table gives no rows. Other columns of `docs` are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    parted = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("rid"), F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "rid", "doc_id", F.char_length("text").alias("n"), F.regexp_replace("text", WHITE, "").alias("norm"),
    ).select("rid", "doc_id", "n", "norm", F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block}}}"), F.lit(0)).alias("blocks"))
    rows = stage(
        parted.select(
            "rid", "doc_id", "n", F.sha2("norm", 256).alias("text_sha256"), F.size("blocks").alias("n_blocks"),
            _names(F.col("blocks"), bucket).alias("names"),
        ),
        "block-names",
    )
    finished = []
    placed = parted.select("rid", F.posexplode("blocks").alias("pos", "content")).withColumn("bucket", bucket(F.col("content")))
    while True:
        numbers = _numbers(placed.select("bucket", "content"))
        if numbers is not None:
            rows = stage(_renamed(rows, placed, numbers), "block-names")
        finished.append(rows.filter(F.size("names") <= 1))
        rows = rows.filter(F.size("names") > 1)
        if rows.isEmpty():
            break
        # Every level is written, as half the names of the texts that still have several. An odd last name moves up as it is.
        pair = F.sequence(F.lit(0), F.ceil(F.size("names") / 2).cast("int") - 1)
        pairs = F.transform(pair, lambda i: F.struct(F.get("names", 2 * i).alias("left"), F.get("names", 2 * i + 1).alias("right")))
        paired = rows.withColumn("pairs", pairs)
        placed = paired.select("rid", F.posexplode("pairs").alias("pos", "content")).filter("content.right IS NOT NULL").withColumn(
            "bucket", bucket(F.col("content.left.k"), F.col("content.left.r"), F.col("content.right.k"), F.col("content.right.r"))
        )
        up = F.transform("pairs", lambda p: F.when(p["right"].isNull(), p["left"]).otherwise(
            F.struct(bucket(p["left"]["k"], p["left"]["r"], p["right"]["k"], p["right"]["r"]).alias("k"), F.lit(1).alias("r"))))
        rows = stage(paired.withColumn("names", up).drop("pairs"), "block-names")

    top = F.get("names", F.lit(0))
    named = reduce(DataFrame.unionByName, finished).select("rid", "doc_id", "n", "text_sha256", "n_blocks", F.coalesce(top["k"], F.lit(0)).alias("k"), F.coalesce(top["r"], F.lit(0)).alias("r"))
    identity = ["n_blocks", "k", "r"]
    best = F.min(F.struct((-F.col("n")).alias("longest"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    # Written, so that the join below sees its size and can split a hot group's rows.
    groups = stage(
        named.groupBy(*identity).agg(F.count("*").alias("group_size"), best.alias("best")).filter("group_size > 1")
        .select(*identity, "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid")),
        "copy-groups",
    )
    copied = F.col("group_size").isNotNull()
    return named.join(groups, identity, "left").select(
        "rid", "doc_id", F.when(copied, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(True)).alias("kept"), "text_sha256",
    )
