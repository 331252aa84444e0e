"""Near-duplicate documents: fast similarity sketches, banding, and verification on full shingle sets.

A sketch has `COORDS` coordinates, filled in rounds: in each round every shingle falls into one coordinate, and a
coordinate keeps the least value of the first round that reached it. After `COORDS` rounds the shingles visit the
coordinates one by one, so every coordinate fills; equal coordinates of two sketches estimate their similarity with
Chernoff-like bounds. `BANDS` bands of `ROWS` coordinates key the buckets. With a similarity of 0.85 a pair misses all
32 buckets with probability (1 - 0.85^6)^32 < 3e-7.

Documents with one shingle set form a class first, so copies meet no bucket twice. Within a bucket, every class is held
against the bucket's hub (the member met most often); what these links already join is done. The pairs left over, between
different components, are compared in a second step: those of small buckets one by one. In wide buckets (a passage that
many texts share) that would grow with the square of the bucket, so there a pair must also meet in the rare shingles
that any two sets of this similarity have to share: each set is put in order from rare to frequent, and linked sets
have a common shingle within their first 15 %, at places that leave enough after them for the overlap asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sitecorpus.llm.frames import forget, per_batch, row_key
from sitecorpus.llm.words import SMALL_BYTES, SPACES, Words, mix, shingles, text_slices
from sitecorpus.operators.graph import connected_components
from sitecorpus.session import stage

COORDS, ROWS = 192, 6
BANDS = COORDS // ROWS
WORDS = 5
LEAST = 85  # hundredths of the union
WIDE = 8  # members of a bucket up to which all its pairs are made
BLOOM_BITS, BLOOM_HASHES = 1 << 26, 4  # at most, of the filter of the texts that are read again
SLOTS = 1 << 18  # counters of shingle frequencies; they only put shingles in order
# Equal coordinates (by 8 bits) below which a pair need not be verified: at similarity 0.85, 163 of 192 are expected, with a
# standard deviation of 5; 128 is seven deviations less.
FEWEST = 128

_U64 = np.uint64
_SEEDS = mix(np.arange(1, 2 * COORDS + 1, dtype=np.uint64) * _U64(0xD6E8FEB86659FD93))
_EMPTY = np.iinfo(np.uint64).max


def sketch(items: np.ndarray) -> np.ndarray:
    """Coordinates (round << 32 | value) of a non-empty set of 64-bit items."""
    out = np.full(COORDS, _EMPTY)
    for r in range(2 * COORDS):
        h = mix(items ^ _SEEDS[r])
        value = (h & _U64(0xFFFFFFFF)) | _U64(r << 32)
        if r < COORDS:
            np.minimum.at(out, ((h >> _U64(32)) % _U64(COORDS)).astype(np.int64), value)
            if r == 0 and len(items) < 4:
                continue
        else:
            out[r - COORDS] = min(out[r - COORDS], value.min())
        if out.max() != _EMPTY:
            break
    return out


def _bands(coords: np.ndarray) -> np.ndarray:
    rows = coords.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * _U64(0x9FB21C651E98DF25) + rows[:, k])
    return key.astype(np.int64)


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, n_shingles, digest, bands, bits) per row; digest names the shingle set, null when it is empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, data, offsets in text_slices(batch.column(2), SMALL_BYTES):
            words = Words(data, offsets, SPACES)
            n, digest, bands, bits = [], [], [], []
            for i in range(hi - lo):
                s = shingles(words, i, WORDS)
                n.append(len(s))
                if not len(s):
                    digest.append(None), bands.append(None), bits.append(None)
                    continue
                coords = sketch(s)
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(_bands(coords))
                bits.append(mix(coords).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                ["rid", "doc_id", "n_shingles", "digest", "bands", "bits"],
            )

    rows = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(per_batch(run), f"rid binary, doc_id {kind}, n_shingles bigint, digest binary, bands array<bigint>, bits binary")


def _places(rids: pa.Array, size: int) -> np.ndarray:
    """The bits of each row key in the Bloom filter; the keys are hashes already."""
    halves = np.frombuffer(b"".join(rids.to_pylist()), "<u8").reshape(-1, 2)
    return (halves[:, :1] + np.arange(BLOOM_HASHES, dtype=np.uint64) * halves[:, 1:]) % _U64(size)


def _bloom(rids: DataFrame, size: int) -> np.ndarray:
    """A Bloom filter of the row keys as words of 32 bits; it may pass more than it should, never less."""

    def marked(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = np.unique(_places(batch.column(0), size))
        word, first = np.unique(at >> _U64(5), return_index=True)
        bits = np.bitwise_or.reduceat(_U64(1) << (at & _U64(31)), first) if len(at) else at
        return pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bits.astype(np.int64))], ["word", "bits"])

    table = rids.mapInArrow(per_batch(marked), "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size // 32, np.uint32)
    words[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return words


def _filter_size(n: int) -> int:
    """Sixteen bits a key keep false hits under one in four hundred; beyond the largest size more rows than needed pass."""
    return min(BLOOM_BITS, max(1 << 16, 1 << (16 * n).bit_length()))


def may_be_in(keys: DataFrame):
    """A test of a column of row keys: true for all of `keys` (rid) and few others."""
    bloom = _bloom(keys, _filter_size(keys.count()))

    @F.arrow_udf("boolean")
    def test(rids: pa.Array) -> pa.Array:
        forget()
        at = _places(rids, 32 * len(bloom))
        return pa.array(((bloom[at >> _U64(5)] >> (at & _U64(31)).astype(np.uint32)) & 1).all(1))

    return test


def _sets(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, set) of the classes: the sorted shingle hashes of the row that stands for each, from the whole text again."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, data, offsets in text_slices(batch.column(1), SMALL_BYTES):
            words = Words(data, offsets, SPACES)
            own = [shingles(words, i, WORDS).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(own, pa.binary())], ["digest", "set"])

    wanted_keys = classes.select("rid")
    bloom = _bloom(wanted_keys, _filter_size(wanted_keys.count()))

    def wanted(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = _places(batch.column(0), 32 * len(bloom))
        return batch.filter(pa.array(((bloom[at >> _U64(5)] >> (at & _U64(31)).astype(np.uint32)) & 1).all(1)))

    # The same plan at every size: the classes may be too many to send everywhere. Most texts stay where they are.
    texts = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("rid"), F.col(text_col).alias("text"))
    rows = texts.mapInArrow(per_batch(wanted), "rid binary, text string").join(classes.select("rid", "digest").hint("merge"), "rid").select("digest", "text")
    # A row that is repeated as a whole comes several times.
    return stage(rows.mapInArrow(per_batch(run), "digest binary, set binary").dropDuplicates(["digest"]), "shingle-sets")


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes with 100 * intersection >= LEAST * union on their full sets."""
    side = lambda k: classes.select(F.col("digest").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}"))
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * LEAST

    def alike(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, COORDS) for k in (2, 3))
        return batch.select([0, 1]).filter(pa.array((x == y).sum(1) >= FEWEST))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").filter(fits).select("a", "b", "bits_a", "bits_b")
    close = joined.mapInArrow(per_batch(alike), "a binary, b binary")

    def linked(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for p, q in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (p, q))
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= LEAST * (len(both) - common))
        return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    named = lambda k: sets.select(F.col("digest").alias(k), F.col("set").alias(f"set_{k}")).hint("merge")
    both = close.join(named("a"), "a").join(named("b"), "b").select("a", "b", "set_a", "set_b")
    return stage(both.mapInArrow(per_batch(linked), "a binary, b binary"), "links")


def _rare_first(sets: DataFrame) -> DataFrame:
    """(digest, n, token, place): the first 15 % of each set's shingles in the order from rare to frequent among `sets`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for v in batch.column(0):
                n += np.bincount((np.frombuffer(v.as_buffer(), np.uint64) % _U64(SLOTS)).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["slot", "n"])

    table = sets.select("set").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # at most SLOTS rows
    frequency = np.zeros(SLOTS, np.int64)
    frequency[table["slot"]] = table["n"]

    def first(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, v in enumerate(batch.column(1)):
            own = np.frombuffer(v.as_buffer(), np.uint64)
            n = len(own)
            order = np.lexsort((own, frequency[(own % _U64(SLOTS)).astype(np.int64)]))[: n - (LEAST * n + 99) // 100 + 1]
            at = pa.array(np.full(len(order), i))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(np.full(len(order), n, np.int64)), pa.array(own[order].astype(np.int64)), pa.array(np.arange(len(order)))],
                ["digest", "n", "token", "place"],
            )

    return sets.select("digest", "set").mapInArrow(per_batch(first), "digest binary, n bigint, token bigint, place bigint")


def _apart(rows: DataFrame, key: list[str], fits: str = "true") -> DataFrame:
    """Pairs (a, b) of rows(key…, digest, component, …) in one cell but different components, if they fit."""
    several = rows.groupBy(*key).agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select(*key)
    rows = rows.join(several, key)
    left, right = rows.alias("x"), rows.alias("y")
    on = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in key]
    pairs = left.join(right, on).filter(f"x.digest < y.digest AND x.component <> y.component AND {fits}")
    return pairs.select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")).distinct()


def _components(links: DataFrame) -> DataFrame:
    """(digest, component) of the linked classes."""
    edges = links.select(F.lit(0).alias("graph_id"), F.col("a").alias("src"), F.col("b").alias("dst"))
    return connected_components(edges).select(F.col("node").alias("digest"), "component")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: rid (frames.row_key of id and text), doc_id, n_shingles, component_id, kept.

    Words are ASCII-lower-cased runs of non-space. Documents are linked when their sets of 5-word shingles have
    100 * intersection >= 85 * union; fewer words are one shingle; texts without words (null, empty) link with nothing
    and keep their own id. component_id is the smallest id in the component (null ids last). One row of each component
    is kept: the smallest key among those with that id; rows repeated as a whole share it. Extra columns are not read.
    """
    rows = stage(sketched(docs, id_col, text_col), "sketches")
    classes = stage(
        rows.filter("digest IS NOT NULL").groupBy("digest").agg(
            F.min("rid").alias("rid"), F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.min("bits").alias("bits"),
            F.min("bands").alias("bands"),
        ),
        "classes",
    )
    placed = classes.select("digest", F.posexplode("bands").alias("band", "key"))
    crowded = placed.groupBy("band", "key").agg(F.count("*").alias("members")).filter("members > 1")
    # Written with what each class meets in all: the member met most often is its buckets' hub.
    buckets = stage(placed.join(crowded, ["band", "key"]), "buckets")
    met = buckets.groupBy("digest").agg(F.sum("members").alias("met"))
    ranked = buckets.join(met, "digest").select("band", "key", "digest", "members", F.struct((-F.col("met")).alias("met"), "digest").alias("rank"))
    hubs = ranked.groupBy("band", "key").agg(F.min("rank").alias("hub"))
    near = ranked.join(hubs, ["band", "key"]).filter("digest <> hub.digest").groupBy("digest", "hub").agg(F.count("*").alias("shared"))
    best = near.groupBy("digest").agg(F.max_by("hub", F.struct("shared", (-F.col("hub.met")).alias("met"), "hub.digest")).alias("hub"))
    tried = stage(best.select(*_ordered(F.col("digest"), F.col("hub.digest"))).distinct(), "hub-pairs")
    sets = _sets(docs, classes.join(met.select("digest"), "digest", "left_semi"), id_col, text_col)
    links = _verified(tried, classes, sets)
    joined = stage(_components(links), "components")

    # Pairs of one bucket that are still apart.
    open_ = buckets.join(joined, "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    mixed = open_.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("band", "key")
    rest = stage(open_.join(mixed, ["band", "key"]).select("band", "key", "digest", "component", "members"), "unsettled")
    few = _apart(rest.filter(F.col("members") <= WIDE), ["band", "key"])
    wide = rest.filter(F.col("members") > WIDE).select("digest", "component").distinct()
    rare = stage(_rare_first(sets.join(wide, "digest", "left_semi")).join(wide, "digest"), "rare-shingles")
    enough = f"least(x.n - x.place, y.n - y.place) * {100 + LEAST} >= {LEAST} * (x.n + y.n)"
    more = _verified(few.unionByName(_apart(rare, ["token"], enough)).distinct().join(tried, ["a", "b"], "left_anti"), classes, sets)
    final = stage(_components(links.unionByName(more)), "components")

    lowest = classes.join(final, "digest").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = stage(final.join(lowest, "component").select("digest", "component", "component_id"), "linked")
    # Written, so that a hot class's rows can be split in the joins that follow.
    own = classes.join(linked, "digest", "left").select("digest", F.coalesce("component", "digest").alias("component"), F.coalesce("component_id", "doc_id").alias("component_id"))
    own = stage(own, "class-components")
    named = rows.select("rid", "doc_id", "n_shingles", "digest").join(own, "digest", "left")
    member = named.withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    first = member.filter("component IS NOT NULL AND doc_id <=> component_id").groupBy("component").agg(F.min("rid").alias("keep_rid"))
    first = stage(first.select("keep_rid"), "kept-rows")
    return member.join(first, F.col("rid") == F.col("keep_rid"), "left").select(
        "rid", "doc_id", "n_shingles", "component_id", (F.col("component").isNull() | F.col("keep_rid").isNotNull()).alias("kept")
    )
