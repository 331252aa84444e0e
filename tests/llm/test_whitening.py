"""Principal components against a dense solver, exact sums against Python integers."""

import math
import random

import numpy as np
import pytest

from sitecorpus.llm import whitening

SF = "/root/testdata/sf0.001"


def truth(vectors, most=8):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(0)
    centred = (x * n - s) / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)
    e, axes = e[order], axes[:, order]
    kept = int((e[:most] > 1e-12 * e[0]).sum())
    exact = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s)) for row in x]
    return n, exact, e[:kept], (centred @ axes[:, :kept]) / np.sqrt(e[:kept]), e[:kept] / e.sum()


def check(rows, vectors, ids):
    n, exact, e, white, share = truth(vectors)
    assert len(rows) == n * len(e)
    got = np.zeros((n, len(e)))
    at = {i: k for k, i in enumerate(ids)}
    for r in rows:
        k = at[r.vec_id]
        got[k, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == exact[k] and r.explained == pytest.approx(share[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
    for c in range(len(e)):
        gap = min([abs(e[c] - e[o]) for o in range(len(e)) if o != c], default=e[c]) / e[0]
        if gap > 1e-6:
            sign = np.sign(got[:, c] @ white[:, c])
            assert np.abs(got[:, c] * sign - white[:, c]).max() < 1e-9 / gap


def test_given_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    kept = [(r.vec_id, r.embedding) for r in table.collect() if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    check(whitening.whiten(table).collect(), [v for _, v in kept], [i for i, _ in kept])


@pytest.mark.parametrize("shape", ["spread", "few dims", "few rows", "repeated", "large", "flat"])
def test_shapes(spark, shape):
    rnd = random.Random(shape)
    d = {"few dims": 3}.get(shape, 12)
    n = 5 if shape == "few rows" else 90
    scale = {"large": 1e3}.get(shape, 1.0)
    vectors = [[rnd.gauss(0, 1) * scale * (0.5**j if shape == "spread" else 1) for j in range(d)] for _ in range(n)]
    if shape == "repeated":
        vectors = vectors[:4] * 20
    if shape == "flat":
        vectors = [[(i == j) * 4.0 for j in range(d)] for i in range(d)] * 3
    rows = [(i, v) for i, v in enumerate(vectors)]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)).collect(), vectors, range(len(vectors)))


def test_what_is_left_out(spark):
    good = [(i, [float(i), float(i * i % 7), 1.0]) for i in range(9)]
    odd = [(20, None), (21, []), (22, [1.0, None, 2.0]), (23, [float("nan"), 1.0, 1.0]), (24, [float("inf"), 1.0, 1.0]), (25, [1.0, 2.0]), (26, [1.0, 2.0, 3.0, 4.0])]
    rows = [(i, v, "clash", 1) for i, v in good + odd]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, x string, n int")).collect()
    check(got, [v for _, v in good], range(9))
    assert {r.component for r in got} == {1, 2}
    alike = spark.createDataFrame([(1, [1.0, 2.0])] * 3 + [(None, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(alike).collect() == []
    for none in (alike.limit(0), spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")):
        assert whitening.whiten(none).collect() == [] and whitening.whiten(none).columns == whitening.whiten(alike).columns


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 3.0]), (4, [2.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert len(got) == 8 and sum(r.vec_id is None for r in got) == 2 and sum(r.vec_id == 1 for r in got) == 4


def test_deviations_that_do_not_fit():
    x = np.array([[100_000, 100_000], [1 << 40, 0]], np.int64)
    n, s = 1 << 22, x.sum(0)
    want = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s)) for row in x]
    assert whitening.deviations(x, n, s).to_pylist() == [w if w < 1 << 63 else None for w in want]
