"""Toxicity by a support vector machine with a subsequence string kernel and Nyström landmarks.

Two words are alike by the three-letter subsequences they share within SPAN letters, each occurrence weighing DECAY to the
power of the stretch it spans, so that inserted letters and gaps cost a little and do not hide a word. The kernel is
normalised and sharpened, exp(SHARP (k - 1)), where similarities under LEAST count as none; two texts are alike by the sum over
their pairs of words over the root of their lengths, which is a kernel again. The
landmarks are words: those that set toxic training texts apart. Words are mapped to the Nyström
features of the landmarks, a text to the sum over its words, and a linear support vector machine with squared hinge
loss learns from the labelled texts. Its margin is turned into a probability by a logistic fit. A text of more than WINDOW
words has the highest margin of the whole and its overlapping windows, so that its length does not hide a word.

A word is a run of letters or digits with signs inside it; a row of single characters, as in i-d-i-o-t, is one word too.
It is read with its signs as gaps and without them, words longer than LONGEST in overlapping windows, and the best counts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sitecorpus.llm.frames import bounded, in_parts, kept, per_batch
from sitecorpus.session import stage

SAMPLE = 20_000  # labelled texts to learn from, at most about this many
TELLING, EVIDENCE = 200, 6.0  # landmarks at most, and the likelihood ratio they need
DECAY, SPAN, SHARP, LEAST = 0.9, 6, 6.0, 0.5
LONGEST = 24
CACHED = 160_000  # words whose features a task keeps; the earliest half, the frequent ones, outlives the rest
KEPT, WORD_BYTES = 40 << 20, 180  # bytes of scored words that a worker keeps, and what a word takes
THRESHOLD = 0.7
RIDGE = 2.0
SCALE = 3.0
WINDOW = 512  # words; longer texts are also scored in windows of so many, each half over the next

_WORD = re.compile(r"[^\W_](?:[\W_]{1,2}[^\W_]){2,}(?![^\W_])|[^\W_]+(?:[*@$!.'_~-]+[^\W_]+)*")


def words_of(text: str) -> list[str]:
    """The words of a text, lower-cased."""
    return _WORD.findall(text.lower())


def readings(word: str) -> list[str]:
    """The word, without its signs if it has any, in windows if it is long."""
    plain = word if word.isalnum() else "".join(c for c in word if c.isalnum())
    half = LONGEST // 2
    return [v[i : i + LONGEST] for v in {word: 0, plain: 0} for i in range(0, max(1, len(v) - half), half)]


@lru_cache(maxsize=LONGEST + 1)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the three-letter subsequences of a word of n letters, and their weights."""
    found = [(i, j, k) for i, j, k in combinations(range(n), 3) if k - i < SPAN]
    at = np.array(found, np.int64).reshape(-1, 3)
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1).astype(np.float64)


_ALNUM = np.array([chr(i).isalnum() for i in range(0xD800)] + [True] * (0x10000 - 0xD800))


class Kernel:
    """Sharpened similarity of words to landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        letters = sorted({c for w in landmarks for c in w if c.isalnum() and ord(c) < 0x10000})
        self.code = np.zeros(0x10000, np.int32)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.base = len(letters) + 1
        self.columns = np.zeros(self.base**3, np.int32)  # column of a subsequence, 0 for one of no landmark
        own = []
        for w in landmarks:
            keys, weight, valid, points = self._keys([w])
            summed, norm = self._merged(weight, valid, points)
            own.append((keys[0], summed[0] / max(norm[0], 1e-12)))
        known = np.unique(np.concatenate([k[k > 0] for k, _ in own]))
        self.columns[known] = np.arange(1, len(known) + 1)
        weights = np.zeros((len(known) + 1, len(landmarks)))
        for i, (k, w) in enumerate(own):
            np.add.at(weights[:, i], self.columns[k], w)
        weights[0] = 0
        # By subsequence, the landmarks that have it and its weight there: few of all.
        column, self.having = np.nonzero(weights)
        self.weights = weights[column, self.having]
        self.many = np.bincount(column, minlength=len(weights))
        self.first = np.cumsum(self.many) - self.many

    def _keys(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For words of one length, a row each: keys of the subsequences in the landmarks' letters (0 if others), their
        weights, whether they are free of signs, and the words' letters."""
        n = len(words[0])
        at, weight = _triples(n)
        points = np.minimum(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n), 0xFFFF)
        codes, letters = self.code[points], _ALNUM[points]
        x, y, z = (codes[:, at[:, k]] for k in range(3))
        keys = np.where((x > 0) & (y > 0) & (z > 0), (x * self.base + y) * self.base + z, 0)
        valid = letters[:, at[:, 0]] & letters[:, at[:, 1]] & letters[:, at[:, 2]]
        return keys, weight, valid, points

    @staticmethod
    def _merged(weight: np.ndarray, valid: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights as they are, 0 where a sign is touched, and the norms with equal subsequences taken together."""
        at, _ = _triples(points.shape[1])
        a, b, c = (points[:, at[:, k]].astype(np.int64) for k in range(3))
        full = (a << 32) | (b << 16) | c
        own = np.where(valid, weight, 0.0)
        order = np.argsort(full, axis=1)
        total = np.cumsum(np.take_along_axis(own, order, 1), axis=1)
        full = np.take_along_axis(full, order, 1)
        last = np.ones_like(valid)
        last[:, :-1] = full[:, 1:] != full[:, :-1]
        upto = np.maximum.accumulate(np.where(last, total, 0.0), axis=1)
        groups = np.diff(upto, axis=1, prepend=0)
        return own, np.sqrt((groups**2).sum(1))

    def __call__(self, words: list[str]) -> np.ndarray:
        """Rows of sharpened similarities; words shorter than three letters are like nothing."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) >= 3:
                by.setdefault(len(w), []).append(i)
        for at in by.values():
            for lo in range(0, len(at), 4096):
                some = np.array(at[lo : lo + 4096])
                keys, weight, valid, points = self._keys([words[i] for i in some])
                # By Cauchy-Schwarz a word with too little of its weight in the landmarks' subsequences is like none.
                square = np.where(valid, weight**2, 0.0)
                near = np.flatnonzero(np.where(self.columns[keys] > 0, square, 0.0).sum(1) >= 0.8 * LEAST**2 * np.maximum(square.sum(1), 1e-12))
                if not len(near):
                    continue
                own, norm = self._merged(weight, valid[near], points[near])
                columns = self.columns[keys[near]]
                row, col = np.nonzero((columns > 0) & (own > 0))
                column, value = columns[row, col], own[row, col] / norm[row]
                many = self.many[column]
                upto = np.cumsum(many)
                at = np.repeat(self.first[column] - upto + many, many) + np.arange(upto[-1] if len(upto) else 0)
                cell = np.repeat(row * len(self.landmarks), many) + self.having[at]
                k = np.bincount(cell, self.weights[at] * np.repeat(value, many), len(near) * len(self.landmarks)).reshape(len(near), -1)
                row, col = np.nonzero(k >= LEAST)
                out[some[near[row]], col] = np.exp(SHARP * (np.minimum(k[row, col], 1) - 1))
        return out


@dataclass
class Model:
    kernel: Kernel
    root: np.ndarray  # landmarks to Nyström features
    weights: np.ndarray | None = None
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def probabilities(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


class _Sums:
    """Sum over the words of texts of their similarities to the landmarks, or of those times `into`, over the root of the
    number of words; with a bounded cache of the words' vectors. With `window`, the highest over the text and its windows."""

    def __init__(self, kernel: Kernel, into: np.ndarray | None = None, window: int | None = None):
        self.kernel, self.into, self.window = kernel, into, window
        self.width = len(kernel.landmarks) if into is None else into.shape[1]
        self.most = min(CACHED, 10_000_000 // self.width)
        self.known: dict[str, int] = {}
        self.values = np.zeros((0, self.width), np.float32)

    def _learn(self, words: list[str]) -> None:
        used = len(self.known)
        if used + len(words) > len(self.values):
            more = np.zeros((max(2 * len(self.values), used + len(words), 4096), self.width), np.float32)
            more[:used] = self.values[:used]
            self.values = more
        for lo in range(0, len(words), 8192):
            some = words[lo : lo + 8192]
            self.values[used + lo : used + lo + len(some)] = self._new(some)
        self.known.update(zip(words, range(used, used + len(words)), strict=True))

    def _new(self, words: list[str]) -> np.ndarray:
        if all(w.isalnum() and len(w) <= LONGEST for w in words):
            k = self.kernel(words)
        else:
            read = [readings(w) for w in words]
            k = self.kernel([r for rs in read for r in rs])
            k = np.maximum.reduceat(k, np.cumsum([0, *map(len, read)])[:-1], axis=0)  # the best of a word's readings
        return k if self.into is None else k @ self.into

    def _vectors(self, words: list[str]) -> np.ndarray:
        new = set(words).difference(self.known)
        if new:
            if len(self.known) + len(new) > self.most:
                self.known = dict(islice(self.known.items(), self.most // 2))
                new = set(words).difference(self.known)
            plain = {w for w in new if w.isalnum() and len(w) <= LONGEST}
            self._learn(list(plain))
            self._learn(list(new - plain))
        return self.values[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), self.width))
        lo = 0
        while lo < len(texts):
            words: list[str] = []
            ends, size = [0], 0
            while lo + len(ends) <= len(texts) and size < max(1 << 13, (1 << 20) // self.width):
                t = texts[lo + len(ends) - 1] or ""
                words += words_of(t)
                ends.append(len(words))
                size += len(t)
            values = self._vectors(words)
            sizes = np.diff(ends)
            some = np.flatnonzero(sizes)
            if len(some):
                out[lo + some] = np.add.reduceat(values, np.array(ends[:-1])[some], axis=0, dtype=np.float64) / np.sqrt(sizes[some])[:, None]
            for i in np.flatnonzero(sizes > self.window).tolist() if self.window else ():
                total = np.vstack([np.zeros(self.width), np.cumsum(values[ends[i] : ends[i + 1]], axis=0, dtype=np.float64)])
                first = np.append(np.arange(0, sizes[i] - self.window, self.window // 2), sizes[i] - self.window)
                best = (total[first + self.window] - total[first]).max(axis=0) / np.sqrt(self.window)
                out[lo + i] = np.maximum(out[lo + i], best)
            lo += len(sizes)
        return out


class _Scores(_Sums):
    """The same with one number per word, kept by the worker within a number of bytes; words not met lately go first."""

    def __init__(self, kernel: Kernel, into: np.ndarray, window: int):
        super().__init__(kernel, into, window)
        self.young: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def _vectors(self, words: list[str]) -> np.ndarray:
        if len(self.young) > KEPT // WORD_BYTES // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = set(words).difference(young)
        if old:
            again = [w for w in new if w in old]
            young.update((w, old[w]) for w in again)
            new.difference_update(again)
        plain = {w for w in new if w.isalnum() and len(w) <= LONGEST}
        long: dict[str, float] = {}
        for some in (list(plain), list(new - plain)):
            for lo in range(0, len(some), 8192):
                part = some[lo : lo + 8192]
                made = zip(part, self._new(part)[:, 0].tolist(), strict=True)
                for w, v in made:
                    (young if len(w) <= 2 * LONGEST else long)[w] = v
        get = young.__getitem__ if not long else lambda w: long[w] if w in long else young[w]
        return np.fromiter(map(get, words), np.float32, len(words))[:, None]


def _kept_scores(model: Model, into: np.ndarray) -> _Scores:
    """The worker's scores for a model, so that what a task has learnt serves the next."""
    name = hashlib.blake2b("\n".join(model.kernel.landmarks).encode() + into.tobytes()).digest()
    return kept(name, lambda: _Scores(model.kernel, into, WINDOW))


def _words_udf(text: pd.Series) -> pd.Series:
    return pd.Series([list(dict.fromkeys(w for w in words_of(t or "") if 3 <= len(w) <= LONGEST)) for t in text])


def landmarks(known: DataFrame, telling: int = TELLING) -> list[str]:
    """The words whose presence tells toxic texts (text, label) best, by the likelihood ratio against one rate for both
    labels. Each text counts a word once; only as many words as asked for reach the driver."""
    split = F.pandas_udf(_words_udf, T.ArrayType(T.StringType()))
    total = known.agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).first()
    pos, neg = float(total["pos"] or 0), float(total["neg"] or 0)
    counts = known.select("label", F.explode(split("text")).alias("word")).groupBy("word").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    p, n = F.col("p"), F.col("n")
    part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / ((p + n) * share))).otherwise(0.0)
    ratio = 2 * (part(p, pos / max(1.0, pos + neg)) + part(n, neg / max(1.0, pos + neg)))
    top = counts.withColumn("ratio", ratio).filter((p >= 2) & (p * neg > n * pos) & (F.col("ratio") > EVIDENCE)).orderBy(F.desc("ratio"), "word").limit(telling)
    return [r["word"] for r in top.collect()]


def support_vectors(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss, by Newton steps; y is -1 or 1."""
    rows = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(rows.shape[1], ridge)
    penalty[-1] = 1e-8
    cost = np.where(y > 0, (y < 0).sum() / max(1, (y > 0).sum()), 1.0) ** 0.5
    w = np.zeros(rows.shape[1])

    def loss(v):
        return (penalty * v * v).sum() + (cost * np.maximum(0, 1 - y * (rows @ v)) ** 2).sum()

    for _ in range(rounds):
        inside = y * (rows @ w) < 1
        r, c = rows[inside], cost[inside]
        target = np.linalg.solve(r.T @ (r * c[:, None]) + np.diag(penalty), r.T @ (c * y[inside]))
        step, now = 1.0, loss(w)
        while step > 1e-4 and loss(w + step * (target - w)) > now:
            step /= 2
        if np.abs(step * (target - w)).max() < 1e-9:
            break
        w = w + step * (target - w)
    return w[:-1], float(w[-1])


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a one-dimensional logistic fit to smoothed targets, by damped Newton steps."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    rows = np.stack([margin, np.ones_like(margin)], 1)

    def loss(v):
        f = rows @ v
        return (np.logaddexp(0, f) - target * f).sum()

    v = np.array([0.0, np.log((pos + 1) / (neg + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ v, -500, 500)))
        step = np.linalg.solve(rows.T @ (rows * (p * (1 - p))[:, None]) + 1e-9 * np.eye(2), rows.T @ (target - p))
        size, now = 1.0, loss(v)
        while size > 1e-8 and loss(v + size * step) > now:
            size /= 2
        v = v + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(v[0]), float(v[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, ridge: float = RIDGE) -> Model | None:
    """A model from the documents with a label 0 or 1 (labels: id, label); None unless both occur.

    Rows with a null id or label are left out; repeated ones count each. At most about `sample` texts are read.
    """
    chosen = bounded(labels.filter(F.col("label").isin(0, 1) & F.col(id_col).isNotNull()), sample, F.col(id_col))
    chosen = F.broadcast(chosen.select(id_col, F.col("label").cast("int").alias("label")))  # bounded by the sample
    known = stage(docs.select(id_col, F.col(text_col).alias("text")).join(chosen, id_col).select("text", "label"), "labelled-texts")
    marks = landmarks(known)
    if not marks:
        return None
    kernel = Kernel(marks)
    values, vectors = np.linalg.eigh(kernel(marks).astype(np.float64))
    root = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = _Sums(kernel)
        for b in in_parts(batches):
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(list(mean(b.column(0).to_pylist())), pa.list_(pa.float64()))], ["label", "x"])

    table = known.mapInArrow(means, "label int, x array<double>").toPandas()  # bounded by the sample
    if table["label"].nunique() < 2:
        return None
    x, y = np.stack(table["x"].to_list()), np.where(table["label"].to_numpy() > 0, 1.0, -1.0)
    order = np.lexsort([*x.T, y])  # the same model whatever order the rows came in
    x, y = x[order] @ root * SCALE, y[order]
    # Margins for the logistic fit come from machines that have not seen the text.
    fold = np.arange(len(y)) % 3
    margin = np.zeros(len(y))
    for f in range(3):
        if len(set(y[fold != f])) == 2:
            w, b = support_vectors(x[fold != f], y[fold != f], ridge)
            margin[fold == f] = x[fold == f] @ w + b
    model = Model(kernel, root)
    model.weights, model.bias = support_vectors(x, y, ridge)
    model.slope, model.shift = _logistic(margin, y)
    return model


def scored(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD, returned: list[str] | None = None, added: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The columns `returned` of `docs` (all but the text) with score and predicted (1 if score >= threshold), called as in `added`.

    Null and empty texts have the score of a text without a telling word; without a model all scores are 0.
    """
    names = docs.columns
    at = names.index(text_col)
    shown = [i for i, n in enumerate(names) if (n != text_col if returned is None else n in returned)]
    # A linear machine needs one number per word.
    into = None if model is None else (SCALE * model.root @ model.weights).astype(np.float32)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = None if model is None else _kept_scores(model, into)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            score = np.zeros(batch.num_rows)
            if mean is not None:
                score = model.probabilities(mean(batch.column(at).to_pylist())[:, 0] + model.bias)
            made = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            return pa.RecordBatch.from_arrays([*(batch.column(i) for i in shown), *made], [*(names[i] for i in shown), *added])

        yield from per_batch(one)(batches)

    fields = [f"`{docs.schema[i].name}` {docs.schema[i].dataType.simpleString()}" for i in shown]
    return docs.mapInArrow(run, ", ".join([*fields, f"`{added[0]}` double", f"`{added[1]}` int"]))
