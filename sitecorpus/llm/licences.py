"""Licence scan: passages of a text against licence templates by the Dice coefficient over word bigrams.

Texts and templates become words (lower-cased, split at everything that is no letter or digit). A template of b bigrams
can reach a coefficient t only with a passage of at least b t / (2 - t) and at most b (2 - t) / t bigrams, and only if it
shares at least b t / (2 - t) of them; both bounds drop most templates before anything is compared. The best passages
begin and end at a shared bigram, so only those are scored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitecorpus.llm.frames import per_batch
from sitecorpus.llm.licence_texts import TEMPLATES
from sitecorpus.llm.words import NON_ALNUM, Words, mix, text_slices

THRESHOLD = 0.8

_U64 = np.uint64


def _bigrams(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * _U64(0x9E3779B97F4A7C15) + h[1:])


class Scanner:
    """Finds (licence, score, first word, word after the last) in the words of a text."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.names = [name for name, _ in templates]
        self.counts = []
        for _, text in templates:
            data = np.frombuffer(text.encode(), np.uint8)
            self.counts.append(Counter(_bigrams(Words(data, np.array([0, len(data)]), NON_ALNUM).hash).tolist()))
        self.sizes = [sum(c.values()) for c in self.counts]
        self.least = [math.ceil(b * threshold / (2 - threshold) - 1e-9) for b in self.sizes]
        self.most = [math.floor(b * (2 - threshold) / threshold + 1e-9) for b in self.sizes]
        # The templates of each known bigram, and how often it stands there, one after the other.
        grams = np.array([g for c in self.counts for g in c], np.uint64)
        of = np.array([k for k, c in enumerate(self.counts) for _ in c], np.int64)
        times = np.array([n for c in self.counts for n in c.values()], np.int64)
        order = np.argsort(grams, kind="stable")
        self.of, self.times = of[order], times[order]
        self.known, self.start = np.unique(grams[order], return_index=True)
        self.many = np.diff(np.append(self.start, len(grams)))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.known & _U64(0xFFFF)).astype(np.int64)] = True

    def hits(self, bigrams: np.ndarray) -> np.ndarray:
        """Places of bigrams that stand in some template."""
        maybe = np.flatnonzero(self.seen[(bigrams & _U64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, bigrams[maybe]), len(self.known) - 1)
        return maybe[self.known[at] == bigrams[maybe]]

    def passages(self, places: np.ndarray | list[int], grams: np.ndarray | list[int]) -> list[tuple[int, float, int, int]]:
        """(template, score, first bigram, bigram after the last), disjoint, from the bigrams of one text that hit."""
        place, at = np.asarray(places, np.int64), np.searchsorted(self.known, np.asarray(grams, np.uint64))
        many = self.many[at]
        own = np.repeat(np.arange(len(place)), many)
        entry = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.start[at], many)
        template = self.of[entry]
        found = []
        for k in np.flatnonzero(np.bincount(template, minlength=len(self.sizes)) >= self.least).tolist():
            mine = np.flatnonzero(template == k)
            found += self._passages(k, place[own[mine]], at[own[mine]], self.times[entry[mine]])
        # The best first; then the longer, the earlier, and the template listed first.
        found.sort(key=lambda f: (-f[1], f[2] - f[3], f[2], f[0]))
        out: list[tuple[int, float, int, int]] = []  # in text order
        for f in found:
            at = bisect_left(out, f[2], key=lambda o: o[2])
            if (at == 0 or out[at - 1][3] <= f[2]) and (at == len(out) or f[3] <= out[at][2]):
                out.insert(at, f)
        return out

    def _passages(self, k: int, place: np.ndarray, gram: np.ndarray, times: np.ndarray) -> list[tuple[int, float, int, int]]:
        """The best passage from each start, for one template, if it reaches the threshold.

        times: how often the template holds each bigram. One that has stood so often since the start counts no more.
        """
        b, least, most = self.sizes[k], self.least[k], self.most[k]
        starts = np.flatnonzero(place[least - 1 :] - place[: len(place) - least + 1] < most) if least else np.arange(len(place))
        if not len(starts):
            return []
        order = np.argsort(gram, kind="stable")
        before = np.arange(len(gram)) - times[order]
        same = (before >= 0) & (gram[order][before] == gram[order])
        used = np.full(len(gram), -1)  # the place among the bigrams from which on this one is one too many
        used[order[same]] = order[before[same]]
        ends = np.searchsorted(place, place[starts] + most)
        out = []
        for i, end in zip(starts.tolist(), ends.tolist(), strict=True):
            score = 2 * np.cumsum(used[i:end] < i) / (b + place[i:end] - place[i] + 1)
            j = int(score.argmax())
            if score[j] >= self.threshold:
                out.append((k, float(score[j]), int(place[i]), int(place[i + j]) + 1))
        return out


_SPANS = pa.list_(pa.struct([("licence", pa.string()), ("score", pa.float64()), ("first", pa.int64()), ("last", pa.int64())]))


def scan(docs: DataFrame, text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the text column, with licences: array<struct<licence, score, first, last>>, passages in text order,
    as words [first, last). They do not overlap: the better one stays.

    Null and empty texts have none; whole texts are read; each row is scanned by itself.
    """
    names = docs.columns
    at = names.index(text_col)
    kept = [i for i in range(len(names)) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)

        def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for lo, hi, data, offsets in text_slices(batch.column(at)):
                words = Words(data, offsets, NON_ALNUM)
                made: list[list] = [[] for _ in range(hi - lo)]
                if len(words.hash) > 1:
                    grams = _bigrams(words.hash)
                    hits = scanner.hits(grams)
                    row = np.searchsorted(words.first, hits, "right") - 1
                    inside = hits + 1 < words.first[row + 1]  # not across two texts
                    hits, row = hits[inside], row[inside]
                    for i in np.unique(row):
                        own = hits[np.searchsorted(row, i) : np.searchsorted(row, i, "right")]
                        base = int(words.first[i])
                        found = scanner.passages(own - base, grams[own])
                        made[i] = [{"licence": scanner.names[k], "score": s, "first": b, "last": e + 1} for k, s, b, e in found]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pa.array(made, _SPANS)], [*(names[i] for i in kept), "licences"])

        yield from per_batch(one)(batches)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col]
    return docs.mapInArrow(run, ", ".join([*fields, "licences array<struct<licence:string,score:double,first:bigint,last:bigint>>"]))
