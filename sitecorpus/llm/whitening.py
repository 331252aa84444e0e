"""Principal components of vectors by Golub-Kahan-Lanczos bidiagonalisation, and the vectors whitened on them.

With X the centred rows, the iteration builds orthonormal v_1, v_2 ... (one entry per dimension) and u_1, u_2 ... (one per
row) with X v_j = β_{j-1} u_{j-1} + α_j u_j and Xᵀ u_j = α_j v_j + β_j v_{j+1}. Each half step is one pass over the rows
that adds up a few numbers per dimension. Every u_j is X times a known combination c_j of dimensions, so a row's entries of
all u's come from the row itself: nothing as long as the corpus is kept, moved or written between passes, and a lost
executor only costs its tasks. Both sides are made orthogonal to all their predecessors. The bidiagonal matrix of α and β
is small; its singular vectors give the components, its singular values the deviations.

Entries become integers first, so that the mean and every row's distance from it are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sitecorpus.llm.frames import in_parts
from sitecorpus.session import stage

SCALE, SHIFT = 1024.0, 100_000  # an entry c becomes floor(SCALE * c) + SHIFT
LARGEST = float(1 << 40)  # of a scaled entry; what lies beyond is set to it
TOLERANCE = 1e-13  # of a component's remainder against the largest singular value
SLOTS = 64  # partial sums that reach the driver
SPREAD = 1e-12  # variances below this share of the largest count as none


def usable(vector: Column) -> Column:
    """Whether a vector has entries, none of them null or not finite."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, sound), F.lit(False))


def whole(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the usable vectors; x holds floor(SCALE * c) + SHIFT as long."""
    scaled = lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))) + F.lit(SHIFT)
    named = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].alias("x"))
    return named.filter(usable(F.col("x"))).withColumn("x", F.transform("x", scaled))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _added(rows: DataFrame, values: Callable[[np.ndarray], np.ndarray], dims: int, dtype: type) -> np.ndarray:
    """The sum over all batches of what `values` gives for a batch's matrix: summed per task, then in SLOTS groups of
    tasks, then on the driver."""
    kind = "bigint" if dtype is np.int64 else "double"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                new = values(_matrix(batch.column(0), dims))
                total = new if total is None else total + new
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64() if dtype is np.int64 else pa.float64()))], ["s"])

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.array(x, dtype) for batch in batches for x in batch.column(0).to_pylist()]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([sum(parts).tolist()], pa.list_(pa.int64() if dtype is np.int64 else pa.float64()))], ["s"])

    parts = rows.select("x").mapInArrow(sums, f"s array<{kind}>")
    if rows.rdd.getNumPartitions() > SLOTS:
        parts = parts.repartition(SLOTS).mapInArrow(grouped, f"s array<{kind}>")
    found = [np.array(r.s, dtype) for r in parts.collect()]
    return sum(found) if found else np.zeros(0, dtype)


class Centred:
    """The rows less their mean, as a distributed matrix."""

    def __init__(self, rows: DataFrame, n: int, sums: np.ndarray):
        self.rows, self.n, self.sums, self.dims = rows, n, sums, len(sums)

    def added(self, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of `values` over batches of centred rows."""
        n, sums = self.n, self.sums
        return _added(self.rows, lambda x: values(centred(x, n, sums)), self.dims, np.float64)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n: the difference n*x - S is exact in integers before it is divided."""
    if n < 1 << 21:
        return (x * n - sums) / n
    mean = sums // n
    return (x - mean) - (sums - mean * n) / n


def _fresh(v: np.ndarray, d: int) -> np.ndarray:
    """A direction at right angles to all rows of `v`, the same for the same `v`."""
    new = np.cos((len(v) + 1) * np.arange(1, d + 1, dtype=float) ** 2)
    for _ in range(2):
        new = new - (v @ new) @ v
        new /= np.linalg.norm(new)
    return new


def bidiagonal(matrix: Centred, wanted: int, total: float, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right singular vectors as columns) of the `wanted` largest, by falling value; `total` is the sum of
    all squared entries.

    Where the rows have no part in new directions (α or β is zero) the iteration goes on with a fresh direction, as equal
    singular values show only once from one start, unless what is left of `total` cannot hold a wanted one.
    """
    d, least = matrix.dims, tolerance * np.sqrt(total)
    v, c = np.zeros((0, d)), np.zeros((0, d))  # v_j and c_j with u_j = X c_j
    alphas: list[float] = []
    betas: list[float] = []
    new = _fresh(v, d)
    while True:
        v = np.vstack([v, new])
        z = new - betas[-1] * c[-1] if betas else new
        for again in range(2):  # X v_j less its predecessor, then less what it has in common with the u's before

            def product(rows, z=z, past=c):
                w = rows @ z
                return np.concatenate([(rows @ past.T).T @ w, [w @ w]])

            got = matrix.added(product)
            z = z - got[:-1] @ c
            left_over = got[-1] - got[:-1] @ got[:-1]
            if left_over > 0.5 * got[-1]:
                break
        alpha = float(np.sqrt(max(0.0, left_over)))
        r = np.zeros(d)
        if alpha <= least:
            alpha, z = 0.0, np.zeros(d)
        else:

            def back(rows, z=z / alpha):
                u = rows @ z
                return np.concatenate([rows.T @ u, [u @ u]])

            got = matrix.added(back)
            length = float(np.sqrt(got[-1]))  # near one; taken out, so that u_j has length one
            z = z / (alpha * length)
            alpha *= length
            r = got[:-1] / length - alpha * new
            for _ in range(2):
                r = r - (v @ r) @ v
        c = np.vstack([c, z])
        alphas.append(alpha)
        beta = float(np.linalg.norm(r))
        left, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        enough = min(wanted, d)
        if len(v) == d:
            break
        if beta > least:
            if len(v) >= enough and np.all(beta * np.abs(left[-1, :enough]) <= tolerance * values[0]):
                break
            betas.append(beta)
            new = r / beta
        else:
            hidden = total - sum(x * x for x in alphas + betas)
            if hidden <= max(SPREAD * total, values[enough - 1] ** 2 if len(v) >= enough else 0.0):
                break
            betas.append(0.0)
            new = _fresh(v, d)
    return values[:wanted], (right @ v).T[:, :wanted]


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable vector and component.

    Vectors that are null or empty, or hold null or non-finite entries, are left out, as are those of another length than
    most have (of equally frequent lengths the longest counts). `n` vectors remain; repeated ones and null ids count and
    come out like others. `deviation` is the sum over dimensions of (n*x - S)^2, null if it does not fit a long.
    Components are numbered by falling variance; those without variance (fewer dimensions or distinct vectors than
    components, or all vectors alike) give no rows. `explained` is the component's share of the variance. `identity_error`
    is the largest entry of the covariance of the whitened vectors less the identity. Other columns of `vectors` do not
    matter; an empty table gives no rows.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = whole(vectors, id_col, vector_col)
    lengths = [(r["count"], r["d"]) for r in rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()]
    if not lengths:
        return rows.sparkSession.createDataFrame([], schema)
    n, d = lengths[0]
    rows = stage(rows.filter(F.size("x") == d), "vectors")
    sums = _added(rows, lambda x: x.sum(0), d, np.int64)
    matrix = Centred(rows, n, sums)
    total = float(matrix.added(lambda x: np.array([(x * x).sum()]))[0])
    singular, axes = bidiagonal(matrix, components, total) if total else (np.zeros(0), np.zeros((d, 0)))
    variance = singular**2 / n
    kept = int((variance > SPREAD * variance[:1].sum()).sum())
    variance, axes = variance[:kept], axes[:, :kept]
    onto = axes / np.sqrt(variance)
    got = matrix.added(lambda x: np.concatenate([(x @ onto).sum(0), ((x @ onto).T @ (x @ onto)).ravel()]))
    mean = got[:kept] / n
    covariance = got[kept:].reshape(kept, kept) / n - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(kept)).max(initial=0.0))
    explained = variance / (total / n) if kept else variance

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            x = _matrix(batch.column(1), d)
            y = centred(x, n, sums) @ onto
            where = np.repeat(np.arange(len(x)), kept)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(where)), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))), pa.array(np.full(len(where), n)),
                    deviations(x, n, sums).take(pa.array(where)), pa.array(y.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(where), error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("vec_id", "x").mapInArrow(run, schema)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sums over dimensions of (n*x - S)^2, exact; null where the result does not fit a long."""
    top = np.iinfo(np.int64).max
    if len(x) and float(n) * np.abs(x - sums // n).max() + n < (top / 2 / x.shape[1]) ** 0.5:
        return pa.array(((x * n - sums) ** 2).sum(1))
    wide = ((x.astype(object) * n - sums.astype(object)) ** 2).sum(1) if len(x) else []
    return pa.array([v if v <= top else None for v in wide], pa.int64())
