"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of up to ORDER bytes is counted over training texts. A byte's probability in a
context is (2c - 1) / 2n; the rest, (distinct followers) / 2n, is the escape to the context one byte shorter, down to
1/256. The statistics stay frozen while texts are scored, so the code length of a byte depends on the ORDER bytes
before it and itself: it is worked out once for every (ORDER + 1)-byte string met in training, and looked up. Strings
never met escape to the longest suffix known. The language with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitecorpus.llm.frames import per_batch
from sitecorpus.llm.words import text_slices

ORDER = 3
SAMPLE = 3000  # training texts per language, at most about this many
TABLE = 1 << 24  # entries of the look-up table for strings
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Bytes that are no part of a letter become a space, so markup, numbers and punctuation do not count.
_LOWER[:97][~np.isin(np.arange(97), np.arange(65, 91))] = 32
_LOWER[123:128] = 32


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte that is kept: it and the three bytes before it as one number; texts begin after three spaces."""
    text = _LOWER[data].astype(np.uint32)
    prior = [text]
    edge = np.zeros(len(text), bool)
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    edge[begin] = True
    for _ in range(ORDER):
        before = np.empty_like(text)
        before[1:] = prior[-1][:-1]
        before[edge] = 32
        prior.append(before)
    return prior[0] | prior[1] << 8 | prior[2] << 16 | prior[3] << 24


def _kept(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """False for spaces after a space, which carry no language."""
    space = _LOWER[data] == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    return keep


@dataclass
class Model:
    """languages; counted strings of each length, and code lengths in bits for each language (rows: sorted strings)."""

    languages: list[str]
    strings: list[np.ndarray]
    bits: list[np.ndarray]
    escapes: list[tuple[np.ndarray, np.ndarray]]

    def __post_init__(self):
        # A string of four bytes is found by way of its two halves, each one of a few thousand.
        full = self.strings[ORDER]
        self.low, self.high = (np.zeros(1 << 16, np.int32) for _ in range(2))
        low, high = np.unique(full & 0xFFFF), np.unique(full >> 16)
        self.low[low], self.high[high] = np.arange(1, len(low) + 1), np.arange(1, len(high) + 1)
        self.width = len(low) + 1
        self.row = None
        if (len(high) + 1) * self.width > TABLE:
            return  # many scripts: searched instead
        self.row = np.full((len(high) + 1) * self.width, -1, np.int32)
        self.row[self.high[full >> 16].astype(np.int64) * self.width + self.low[full & 0xFFFF]] = np.arange(len(full))

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each string's last byte, a column per language."""
        if self.row is None:
            row = np.minimum(np.searchsorted(self.strings[ORDER], grams), len(self.strings[ORDER]) - 1)
            row = np.where(self.strings[ORDER][row] == grams, row, -1)
        else:
            row = self.row[self.high[grams >> 16].astype(np.int64) * self.width + self.low[grams & 0xFFFF]]
        out = self.bits[ORDER][row]
        rare = np.flatnonzero(row < 0)
        if len(rare):
            distinct, back = np.unique(grams[rare], return_inverse=True)
            out[rare] = self._escaped(distinct)[back]
        return out

    def _escaped(self, grams: np.ndarray) -> np.ndarray:
        """Bits of strings that were met in no language, from those of their suffixes."""
        out = np.zeros((len(grams), len(self.languages)), np.float32)
        done = np.zeros(len(grams), bool)
        for k in range(ORDER, 0, -1):
            context = (grams >> 8) & np.uint32((1 << 8 * k) - 1)
            out += np.where(done[:, None], 0, self._escape(k, context))
            suffix = grams & np.uint32((1 << 8 * k) - 1)
            at = np.minimum(np.searchsorted(self.strings[k - 1], suffix), len(self.strings[k - 1]) - 1)
            met = (self.strings[k - 1][at] == suffix) & ~done
            out[met] += self.bits[k - 1][at[met]]
            done |= met
        out[~done] += self._escape(0, np.zeros(1, np.uint32)) + 8
        return out

    def _escape(self, k: int, context: np.ndarray) -> np.ndarray:
        strings, bits = self.escapes[k]
        at = np.minimum(np.searchsorted(strings, context), len(strings) - 1)
        return np.where((strings[at] == context)[:, None], bits[at], 0)


def _fit(languages: list[str], grams: list[np.ndarray], counts: list[np.ndarray]) -> Model:
    """The code lengths of all strings met in any language."""
    every = [np.unique(np.concatenate([g & np.uint32((1 << 8 * (k + 1)) - 1) for g in grams])) for k in range(ORDER + 1)]
    bits = [np.zeros((len(s), len(languages)), np.float32) for s in every]
    contexts = [np.unique(s >> 8) for s in every]
    escapes = [(c, np.zeros((len(c), len(languages)), np.float32)) for c in contexts]
    for lang, (g, n) in enumerate(zip(grams, counts, strict=True)):
        for k in range(ORDER + 1):
            own, back = np.unique(g & np.uint32((1 << 8 * (k + 1)) - 1), return_inverse=True)
            c = np.bincount(back, n, len(own))
            ctx, of = np.unique(own >> 8, return_inverse=True)
            total = np.bincount(of, c)
            followers = np.bincount(of)
            p = (2 * c - 1) / (2 * total[of])
            escape = -np.log2(followers / (2 * total))
            escapes[k][1][np.searchsorted(contexts[k], ctx), lang] = escape
            if k:
                shorter = bits[k - 1][np.searchsorted(every[k - 1], every[k] & np.uint32((1 << 8 * k) - 1)), lang]
            else:
                shorter = np.full(len(every[0]), 8.0)
            bits[k][:, lang] = shorter + escapes[k][1][np.searchsorted(contexts[k], every[k] >> 8), lang]
            bits[k][np.searchsorted(every[k], own), lang] = -np.log2(p)
    return Model(languages, every, bits, escapes)


def train(texts: DataFrame, lang_col: str = "lang", text_col: str = "text", key_col: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """A model of the languages in `texts`; rows without a language or text are left out; None if nothing is left.

    Of a language with many texts, about `sample` are taken by a hash of the key: the bound of what is counted.
    """
    rows = texts.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    per_lang = rows.groupBy(lang_col).count().collect()  # one row per language
    if not per_lang:
        return None
    share = F.lit(1.0)
    for r in per_lang:
        share = F.when(F.col(lang_col) == r[lang_col], F.lit(min(1.0, sample / r["count"]))).otherwise(share)
    chosen = rows.filter(F.pmod(F.xxhash64(F.col(key_col).cast("string")), F.lit(1_000_000)) < share * 1_000_000).select(lang_col, text_col)

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lo, hi, data, offsets in text_slices(batch.column(1)):
            grams = _grams(data, offsets)
            keep = _kept(data, offsets)
            of = np.repeat(np.arange(lo, hi), np.diff(offsets))
            for lang in sorted(set(langs[lo:hi])):
                g, n = np.unique(grams[keep & (langs[of] == lang)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counted = chosen.mapInArrow(per_batch(count), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = counted.toPandas()  # bounded by the sample
    languages = sorted(table["lang"].unique())
    if not languages:
        return None
    parts = [table[table["lang"] == lang] for lang in languages]
    return _fit(languages, [p["gram"].to_numpy(np.uint32) for p in parts], [p["n"].to_numpy(np.float64) for p in parts])


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """`docs` without the text column, with lang_pred and score.

    score is the winner's share of 2^(-bits / sqrt(bytes)) over the languages, 0 for `und`: a null or empty text, one
    without any letter, or no model. Ties go to the first language by name. Repeated rows get the same answer.
    """
    names = docs.columns
    at = names.index(text_col)
    kept = [i for i in range(len(names)) if i != at]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, data, offsets in text_slices(batch.column(at)):
            part = batch.slice(lo, hi - lo)
            lettered = np.array([any(map(str.isalpha, t)) if t else False for t in part.column(at).to_pylist()], bool)
            pred, score = [UNKNOWN] * (hi - lo), np.zeros(hi - lo)
            if model is not None and len(data):
                keep = np.flatnonzero(_kept(data, offsets))
                bits = model.code_lengths(_grams(data, offsets)[keep])
                ends = np.searchsorted(keep, offsets)
                sums = np.zeros((len(keep) + 1, bits.shape[1]))
                np.cumsum(bits, axis=0, dtype=np.float64, out=sums[1:])
                total = sums[ends[1:]] - sums[ends[:-1]]
                total -= total.min(1, keepdims=True)
                share = np.exp2(-total / np.sqrt(np.maximum(1, np.diff(ends)))[:, None])
                best = share.argmax(1)
                for i in np.flatnonzero(lettered):
                    pred[i] = model.languages[best[i]]
                score = np.where(lettered, share.max(1) / share.sum(1), 0.0)
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pa.array(pred), pa.array(score)], [*(names[i] for i in kept), "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col]
    return docs.mapInArrow(per_batch(run), ", ".join([*fields, "lang_pred string", "score double"]))
