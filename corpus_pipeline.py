"""From raw documents to packed training sequences: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitecorpus.llm import automaton, naming, packing, sketch, toxic
from sitecorpus.llm.frames import crc_mod, free_name, row_key
from sitecorpus.session import prepare, stage, temporary

TOKENIZER = "byte_bpe_50k.json"
BATCH_ROWS, READ_ROWS = 2048, 1024  # rows with whole texts that a task hands to Python, and reads from a file, at once
MAP_BITS = 1 << 26  # at most, of the map of the rows that may go


def prepared(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage with the session set for it, as stages are also called one by one. Rows wait in the JVM while Python has
    their keys only, so that bounded bytes of a batch do not bound them."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))
        return function(spark, docs, sf_dir)

    return run


@prepared
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`docs` without the rows that the machine holds toxic. It learns from labelled rows whose crc32 of the id mod 3 is
    not 1; without both labels among them nothing goes. Null texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    with temporary(spark):
        model = toxic.train(docs.filter(crc_mod(F.col("doc_id"), 3) != 1), labels)
    added = free_name(docs, "toxic_score"), free_name(docs, "toxic_predicted")
    return toxic.scored(docs, model, returned=docs.columns, added=added).filter(F.col(added[1]) == 0).select(docs.columns)


def _mapped(docs: DataFrame, key: str, flag: str, keys: DataFrame) -> DataFrame:
    """`docs` with `flag`: true for all rows with a `key` in `keys` (rid) and for one in sixteen of the others, or for more
    where the keys are too many for the largest bit map. DataFrame functions only; words of 64 bits are sent out."""
    bits = min(MAP_BITS, max(1 << 16, 1 << (16 * keys.count()).bit_length()))
    slot, word, marks = (free_name(docs, n) for n in ("map_slot", "map_word", "map_marks"))
    placed = lambda df, c: df.withColumn(slot, F.pmod(F.xxhash64(c), F.lit(bits))).withColumn(word, F.expr(f"{slot} div 64")).withColumn(slot, F.expr(f"cast({slot} % 64 AS int)"))
    table = placed(keys.select("rid"), "rid").groupBy(word).agg(F.bit_or(F.expr(f"shiftleft(1L, {slot})")).alias(marks))
    met = placed(docs, key).join(F.broadcast(table), word, "left")  # bounded by MAP_BITS
    return met.withColumn(flag, F.coalesce(F.getbit(marks, slot) == 1, F.lit(False))).drop(slot, word, marks)


def _sketched(docs: DataFrame, key: str, flag: str, keys: DataFrame) -> DataFrame:
    """The same by a Bloom filter in Python, which few others pass."""
    return docs.withColumn(flag, sketch.may_be_in(keys)(F.col(key)))


def _without(docs: DataFrame, gone: DataFrame, repeated: DataFrame, flagged: Callable[..., DataFrame] = _sketched) -> DataFrame:
    """`docs` without the rows with a key in `gone`; of rows repeated as a whole (keys in `repeated`) one stays."""
    key, flag = free_name(docs, "row_key"), free_name(docs, "may_go")
    named = lambda keys: keys.select(F.col("rid").alias(key))
    # Only rows that may have such a key meet the keys; all other texts stay where they are.
    split = flagged(docs.withColumn(key, row_key(F.col("doc_id"), F.col("text"))), key, flag, gone.select("rid").unionByName(repeated.select("rid")))
    stays, met = split.filter(~F.col(flag)), split.filter(F.col(flag))
    kept = met.join(named(gone), key, "left_anti")
    if not repeated.isEmpty():
        once = kept.join(named(repeated), key, "left_semi").dropDuplicates([key])
        kept = kept.join(named(repeated), key, "left_anti").unionByName(once)
    return stays.unionByName(kept).drop(key, flag)


@prepared
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, as in naming.exact_groups; of rows repeated as a whole, one. DataFrame functions only."""
    with temporary(spark):
        groups = stage(naming.exact_groups(docs).filter("group_size > 1").select("rid", "kept"), "copies", keep=True)
        repeated = stage(groups.filter("kept").groupBy("rid").count().filter("count > 1").select("rid"), "repeated", keep=True)
    return _without(docs, groups.filter("NOT kept").select("rid"), repeated, _mapped)


@prepared
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies stays, as in sketch.near_groups; rows without words all stay."""
    with temporary(spark):
        gone = stage(sketch.near_groups(docs).filter("NOT kept").select("rid"), "near-copies", keep=True)
    return _without(docs, gone, gone.limit(0))


@prepared
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stretches from benchmark items are cut out of the texts, and n_chars follows; rows that are mostly such go."""
    clean = automaton.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


@prepared
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place, as in packing.pack."""
    return packing.pack(packing.pieces(docs, TOKENIZER))


STAGES = [
    ("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None  # the toxicity stage is a trained model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
