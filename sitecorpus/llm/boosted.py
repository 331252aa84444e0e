"""Text quality by histogram gradient-boosted trees over document statistics.

Statistics are worked out for a slice of texts at a time. Trees are grown level by level on histograms of binned
features (logistic loss, second-order gains), all of one depth, and stored as flat arrays: a batch of documents walks
down a tree by indexing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitecorpus.llm.frames import bounded, per_batch
from sitecorpus.llm.words import SPACES, Words, mix, text_slices

SAMPLE = 20_000  # labelled texts to learn from, at most about this many
TREES, DEPTH, RATE, BINS, LEAST, RIDGE = 150, 4, 0.1, 64, 8, 1.0
THRESHOLD = 0.5


def _set(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_BYTES = {
    "upper": _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "lower": _set("abcdefghijklmnopqrstuvwxyz"), "digit": _set("0123456789"), "stop": _set(".?"),
    "bang": _set("!"), "comma": _set(",;:"), "quote": _set("\"'`()"), "pipe": _set("|"), "symbol": _set("#$%&*@^~<>{}[]\\/=+_"), "line": _set("\n"),
    "space": SPACES, "wide": np.arange(256) >= 128,
}
FEATURES = (
    "bytes", "words", "word_mean", "word_std", *_BYTES, "entropy", "longest_run", "distinct_words", "top_word", "same_as_before", "distinct_threes", "capital_words",
    "stopped_words", "lines", "line_words", "distinct_lines", "top_line", "short_lines",
)
_NEWLINE = _set("\n")


def _top(values: np.ndarray) -> tuple[float, float]:
    """Share of distinct values, and of the most frequent one."""
    if not len(values):
        return 0.0, 0.0
    _, n = np.unique(values, return_counts=True)
    return len(n) / len(values), n.max() / len(values)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text; an empty one has zeros."""
    rows = len(offsets) - 1
    out = np.zeros((rows, len(FEATURES)))
    col = {f: i for i, f in enumerate(FEATURES)}
    size = np.diff(offsets)
    some = np.maximum(1, size)
    out[:, col["bytes"]] = np.log1p(size)
    for name, members in _BYTES.items():
        sums = np.concatenate([[0], np.cumsum(members[data], dtype=np.int64)])
        out[:, col[name]] = (sums[offsets[1:]] - sums[offsets[:-1]]) / some
    words, lines = Words(data, offsets, SPACES), Words(data, offsets, _NEWLINE)
    lengths = words.end - words.start
    capital = _BYTES["upper"][data[words.start]] if len(lengths) else np.zeros(0, bool)
    stopped = (_BYTES["stop"] | _BYTES["bang"])[data[words.end - 1]] if len(lengths) else np.zeros(0, bool)
    line_at = np.searchsorted(words.start, lines.start)
    line_words = np.searchsorted(words.start, lines.end) - line_at
    for i in range(rows):
        if not size[i]:
            continue
        text = data[offsets[i] : offsets[i + 1]]
        p = np.bincount(text, minlength=256) / size[i]
        p = p[p > 0]
        change = np.flatnonzero(np.diff(text)) + 1
        runs = np.diff(np.concatenate([[0], change, [len(text)]]))
        out[i, col["entropy"]] = -(p * np.log2(p)).sum()
        out[i, col["longest_run"]] = np.log1p(runs.max())
        b, e = words.first[i], words.first[i + 1]
        n = e - b
        if n:
            h, w = words.hash[b:e], lengths[b:e]
            out[i, col["words"]] = np.log1p(n)
            out[i, col["word_mean"]], out[i, col["word_std"]] = w.mean(), w.std()
            out[i, col["distinct_words"]], out[i, col["top_word"]] = _top(h)
            out[i, col["same_as_before"]] = (h[1:] == h[:-1]).sum() / n
            out[i, col["distinct_threes"]] = _top(mix(mix(h[:-2]) + h[1:-1]) ^ h[2:])[0] if n > 2 else 1.0
            out[i, col["capital_words"]], out[i, col["stopped_words"]] = capital[b:e].mean(), stopped[b:e].mean()
        b, e = lines.first[i], lines.first[i + 1]
        if e > b:
            out[i, col["lines"]] = np.log1p(e - b)
            out[i, col["line_words"]] = line_words[b:e].mean()
            out[i, col["distinct_lines"]], out[i, col["top_line"]] = _top(lines.hash[b:e])
            out[i, col["short_lines"]] = (line_words[b:e] <= 3).mean()
    return out


@dataclass
class Trees:
    """Flat complete trees: node i's children are 2i + 1 and 2i + 2; nodes that split nothing send all to the left."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, c, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    rows, width = x.shape
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(width)], 1)  # bin b: value <= cuts[b]
    slot = binned + np.arange(width) * BINS
    start = float(np.log(mean / (1 - mean)))
    score = np.full(rows, start)
    inner = 2**depth - 1
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, 2**depth))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(rows, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * BINS) + slot).ravel()
            shape = (many, width, BINS)
            g, h, n = (np.bincount(at, np.repeat(v, width), many * width * BINS).reshape(shape).cumsum(2) for v in (grad, hess, np.ones(rows)))
            G, H, N = g[:, :, -1:], h[:, :, -1:], n[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (G - g) ** 2 / (H - h + RIDGE) - G**2 / (H + RIDGE)
            gain[(n < LEAST) | (N - n < LEAST)] = 0
            best = gain.reshape(many, -1).argmax(1)
            for k in range(many):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-6 and b < len(cuts[f]):
                    feature[t, first + k], cut[t, first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(rows), feature[t, node]] > cut[t, node])
        at = node - inner
        leaf[t] = -rate * np.bincount(at, grad, 2**depth) / (np.bincount(at, hess, 2**depth) + RIDGE)
        score += leaf[t][at]
    return Trees(start, feature, cut, leaf)


def _measured(rows: DataFrame) -> DataFrame:
    """(label, x) of (text, label)."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, data, offsets in text_slices(batch.column(0)):
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), pa.array(list(features(data, offsets)), pa.list_(pa.float64()))], ["label", "x"])

    return rows.mapInArrow(per_batch(run), "label int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Trees | None:
    """Trees from the documents with a label 0 or 1 (labels: id, label); None without any.

    Rows with a null id or label are left out; repeated ones count each. At most about `sample` rows are measured.
    """
    chosen = bounded(labels.filter(F.col("label").isin(0, 1) & F.col(id_col).isNotNull()), sample, F.col(id_col))
    chosen = F.broadcast(chosen.select(id_col, F.col("label").cast("int").alias("label")))  # bounded by the sample
    known = docs.select(id_col, text_col).join(chosen, id_col).select(F.col(text_col), "label")
    table = _measured(known).toPandas()  # bounded by the sample
    if not len(table):
        return None
    order = np.lexsort([*np.stack(table["x"].to_list()).T, table["label"]])  # the same trees whatever order the rows came in
    return fit(np.stack(table["x"].to_list())[order], table["label"].to_numpy(np.float64)[order])


def predict(docs: DataFrame, model: Trees | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the text column, with score and predicted (1 if score >= threshold); 0 without a model."""
    names = docs.columns
    at = names.index(text_col)
    kept = [i for i in range(len(names)) if i != at]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, data, offsets in text_slices(batch.column(at)):
            part = batch.slice(lo, hi - lo)
            score = model.scores(features(data, offsets)) if model else np.zeros(hi - lo)
            made = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *made], [*(names[i] for i in kept), "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col]
    return docs.mapInArrow(per_batch(run), ", ".join([*fields, "score double", "predicted int"]))
