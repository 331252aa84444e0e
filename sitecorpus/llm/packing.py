"""Best-fit packing of tokenised documents by a non-negative least-squares fit of length patterns.

Documents become pieces of at most `limit` tokens. The histogram of piece lengths (at most `limit` numbers, whatever
the corpus) is fitted by repeat counts of patterns: sets of few lengths that fill a sequence exactly. The counts are
rounded down to what the histogram can serve, and the rest is packed best-fit decreasing, again on counts. The plan says
for the i-th piece of each length where it goes; pieces are numbered within their length without bringing them together.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sitecorpus.llm.frames import in_parts, per_batch
from sitecorpus.llm.tokens import tokenizer as worker_tokenizer
from sitecorpus.session import stage

LIMIT = 1024
DEPTH = 3  # most lengths in a fitted pattern
ROUNDS = 400


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, place) of every document; a null text is empty and gives one piece.

    Only the first piece of a longer document may be shorter than `limit`. (part, length, place) numbers the pieces of
    one length within a task; written at once, so a repeated task cannot renumber them.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_tokenizer(tokenizer)
        counts = np.zeros(limit + 1, np.int64)
        for batch in in_parts(batches):
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                own, first = encode(part.column(2).fill_null("").to_pylist(), end_id)
                rows = []
                for i in range(part.num_rows):
                    b, e = int(first[i]), int(first[i + 1])
                    at = b
                    stop = b + ((e - b) % limit or limit)
                    while at < e:
                        n = stop - at
                        rows.append((i, at - b, n, zlib.crc32(own[at:stop].tobytes()), int(counts[n])))
                        counts[n] += 1
                        at, stop = stop, stop + limit
                at = np.array(rows, np.int64).reshape(-1, 5)
                new = np.diff(at[:, 0], prepend=-1) != 0
                number = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at[:, 0])), part.column(1).take(pa.array(at[:, 0])), pa.array(number.astype(np.int32))]
                    + [pa.array(at[:, k]) for k in (1, 2, 3, 4)],
                    ["part", "doc_id", "piece", "start", "length", "ids_crc32", "place"],
                )

    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"part int, doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, place bigint"
    return stage(rows.mapInArrow(run, schema), "pieces")


def patterns(limit: int, depth: int) -> np.ndarray:
    """All ways to fill `limit` exactly with up to `depth` (2 or 3) lengths, largest first, padded with zeros."""
    a = np.arange(1, limit)
    two = np.stack([limit - a, a, np.zeros_like(a)], 1)
    found = [np.array([[limit, 0, 0]]), two[two[:, 0] >= two[:, 1]]]
    if depth >= 3:
        x, y = np.meshgrid(a, a, indexing="ij")
        z = limit - x - y
        ok = (z >= 1) & (x >= y) & (y >= z)
        found.append(np.stack([x[ok], y[ok], z[ok]], 1))
    return np.concatenate(found)


def fit(histogram: np.ndarray, shapes: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that minimise the weighted squared error of the histogram, by projected
    accelerated gradient steps; the columns are sparse, so a step costs a few passes over the patterns."""
    size = len(histogram)
    weight = np.where(histogram > 0, 1.0, 4.0)  # a length that does not occur must not be used
    weight[0] = 0.0
    scale = max(1.0, float(histogram.max()))
    target = histogram / scale
    x = z = np.zeros(len(shapes))
    # The largest eigenvalue of A'WA, by power iteration.
    v = np.ones(len(shapes))
    for _ in range(20):
        v = _apply_t(shapes, weight * _apply(shapes, v, size))
        norm = float(np.linalg.norm(v))
        v /= norm
    step, t = 1 / (1.05 * norm), 1.0
    for _ in range(rounds):
        grad = _apply_t(shapes, weight * (_apply(shapes, z, size) - target))
        new = np.maximum(0, z - step * grad)
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, x, t = new + (t - 1) / nt * (new - x), new, nt
    return x * scale


def _apply(shapes: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size)
    for k in range(shapes.shape[1]):
        out += np.bincount(shapes[:, k], x, size)
    out[0] = 0
    return out


def _apply_t(shapes: np.ndarray, y: np.ndarray) -> np.ndarray:
    y = y.copy()
    y[0] = 0
    return y[shapes].sum(1)


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a sequence, how many such sequences)] that use every piece of the histogram (index: length) once."""
    limit = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[limit]:
        out.append(((limit,), int(left[limit])))
        left[limit] = 0
    if left.any() and limit >= 2:
        shapes = patterns(limit, depth)[1:]
        shapes = shapes[((left[shapes] > 0) | (shapes == 0)).all(1)]
        if len(shapes):
            x = fit(left, shapes)
            for i in np.argsort(-x, kind="stable"):
                if x[i] < 0.5:
                    break
                lengths = [int(v) for v in shapes[i] if v]
                n = min(int(np.rint(x[i])), min(int(left[v]) // lengths.count(v) for v in set(lengths)))
                if n > 0:
                    out.append((tuple(lengths), n))
                    for v in lengths:
                        left[v] -= n
    return out + _best_fit(left)


def _best_fit(left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: sequences with equal content are handled as one number."""
    limit = len(left) - 1
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # space left -> sequences
    spaces: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def put(space: int, lengths: tuple[int, ...], n: int) -> None:
        if not space:
            done.append((lengths, n))
            return
        if space not in open_:
            open_[space] = []
            spaces.insert(bisect_left(spaces, space), space)
        open_[space].append((lengths, n))

    for v in range(limit, 0, -1):
        n = int(left[v])
        while n:
            i = bisect_left(spaces, v)
            if i == len(spaces):
                many = limit // v  # a fresh sequence takes as many of this length as fit
                if n >= many:
                    put(limit - many * v, (v,) * many, n // many)
                    n %= many
                else:
                    put(limit - n * v, (v,) * n, 1)
                    n = 0
                continue
            space = spaces[i]
            lengths, have = open_[space].pop()
            if not open_[space]:
                del open_[space]
                spaces.pop(i)
            used = min(n, have)
            if used < have:
                put(space, lengths, have - used)
            put(space - v, (*lengths, v), used)
            n -= used
    return done + [x for s in spaces for x in open_[s]]


def slots(made: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length: rows (first piece, first sequence, offset). Piece i goes to sequence + i - first piece of its row."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, n in made:
        offset = 0
        for v in lengths:
            rows.setdefault(v, []).append((used.get(v, 0), sequence, offset))
            used[v] = used.get(v, 0) + n
            offset += v
        sequence += n
    return {v: np.array(r, np.int64) for v, r in rows.items()}


def pack(cut: DataFrame, limit: int = LIMIT, depth: int = DEPTH) -> DataFrame:
    """`cut` (the rows of pieces()) with sequence_id and offset. An empty table gives no rows.

    Pieces of equal length, copies too, are told apart by (part, place). The plan's size is bounded by `limit`.
    """
    counts = stage(cut.groupBy("length", "part").count(), "piece-counts")
    histogram = np.zeros(limit + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most `limit` rows
        histogram[row["length"]] = row["n"]
    where = slots(plan(histogram, depth))
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.schema.names
        length = batch.column(names.index("length")).to_numpy()
        number = batch.column(names.index("place")).to_numpy() + batch.column(names.index("before")).to_numpy()
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for v in np.unique(length):
            of = np.flatnonzero(length == v)
            rows = where[int(v)]
            at = np.searchsorted(rows[:, 0], number[of], "right") - 1
            sequence[of] = rows[at, 1] + number[of] - rows[at, 0]
            offset[of] = rows[at, 2]
        kept = names[: names.index("place")]
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    numbered = cut.join(firsts, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", "place", "before")
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return numbered.mapInArrow(per_batch(place), schema)
