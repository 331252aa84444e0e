"""Registered queries of the operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitecorpus.llm import alignment, anchors, automaton, boosted, bpe, licences, naming, packing, ppm, sketch, toxic, whitening, wrapper
from sitecorpus.llm.frames import crc_mod
from sitecorpus.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_licence_scan")
def op1_licence_scan(table):
    """Licence passages of every document, with the best score and where each stands."""
    found = licences.scan(table("documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("licences").cast("bigint").alias("n_passages"), F.array_join(F.array_sort(F.array_distinct("licences.licence")), ",").alias("licences"),
        F.coalesce(F.array_max("licences.score"), F.lit(0.0)).alias("best_score"),
        F.array_join(F.transform("licences", lambda x: F.concat_ws(":", x["licence"], x["first"].cast("string"), x["last"].cast("string"))), ",").alias("passages"),
    )


@query("op2_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
""")
def op2_exact_dedup(table):
    """Every document with the one that stays for it."""
    return naming.exact_groups(table("documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op3_near_dedup")
def op3_near_dedup(table):
    """Every document with its component of near copies."""
    return sketch.near_groups(table("documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op4_html_extraction")
def op4_html_extraction(table):
    """Main text of every page."""
    return wrapper.extract(table("pages")).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op5_decontamination", r"""
WITH RECURSIVE item AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM win), doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), run AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lens)
), hit AS (SELECT doc_id, item_id, i, r.n FROM run r JOIN win USING (n, run)
), words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
""")
def op5_decontamination(table):
    """Every document with its hit words and the benchmark items they come from."""
    found = automaton.scan(table("documents").select("doc_id", "text"), table("benchmark"), returned=["doc_id"])
    return found.select(
        "doc_id", "n_words", automaton.n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


@query("op6_language_id")
def op6_language_id(table):
    """Language of every document, learnt from those whose crc32 mod 4 is not 2."""
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    docs = table("documents")
    model = ppm.train(docs.filter(~held_out))
    return ppm.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@query("op7_toxicity")
def op7_toxicity(table):
    """Toxicity of every document, learnt from labelled ones whose crc32 mod 3 is not 1."""
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    docs = table("documents")
    model = toxic.train(docs.filter(~held_out), table("labels").select("doc_id", F.col("toxic").alias("label")))
    return toxic.scored(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@query("op8_quality")
def op8_quality(table):
    """Quality of every document, learnt from labelled ones whose crc32 mod 3 is not 1."""
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    docs = table("documents")
    model = boosted.train(docs.filter(~held_out), table("labels").select("doc_id", F.col("quality").alias("label")))
    return boosted.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


TOKENIZER = "byte_bpe_50k.json"


@query("op9_packing")
def op9_packing(table):
    """Every piece of every document with its sequence and place."""
    return packing.pack(packing.pieces(table("documents"), TOKENIZER))


@query("op10_pii")
def op10_pii(table):
    """Personal data of every document: counts, and spans of the base kinds and of all kinds."""
    base = anchors.KINDS[:4]
    found = anchors.find(table("documents").select("doc_id", "text"))
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, base),
        F.sha2(F.array_join(F.transform(F.filter("spans", lambda s: s["kind"].isin(*base)), written), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", written), ",").alias("spans"),
    )


@query("op11_bpe_codec")
def op11_bpe_codec(table):
    """Ids of every document by the word tokenizer, and the text decoded from them, as digests."""
    coded = bpe.encode(table("documents"), "word_bpe_49k.json")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op12_tokenizer_alignment")
def op12_tokenizer_alignment(table):
    """Groups and links between two tokenizers' tokens of every document, weighed by how often their pairs are linked."""
    return alignment.align(table("documents"), TOKENIZER, "piece_bpe_32k.model", full=False).withColumnRenamed("groups", "groups_sha256")


@query("op13_embedding_whitening")
def op13_embedding_whitening(table):
    """Every vector on the first eight principal components, each scaled to variance one."""
    return whitening.whiten(table("embeddings").select("vec_id", "embedding"), components=8).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
    )
