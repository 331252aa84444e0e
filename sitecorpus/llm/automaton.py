"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words (lower-cased, split at everything that is no letter or digit) form one automaton. The words of a
document stream through it; at each word it knows the longest run that ends there and stands in some item. A run of
`window` words, or a whole item that is shorter, is a hit. Items come in blocks of bounded size, each an automaton of
its own, so what is sent to the executors does not grow with the benchmark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sitecorpus.llm.frames import free_name, per_batch
from sitecorpus.llm.words import NON_ALNUM, SMALL_BYTES, Words, text_slices
from sitecorpus.session import stage

WINDOW = 10
BLOCK_WORDS = 200_000  # words of items in one automaton
MAX_COVERAGE = 0.5


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each `window`-word run and each short item."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        self.window = window
        hashes = [h for _, h in items]
        self.vocabulary = np.unique(np.concatenate(hashes))
        words = [np.searchsorted(self.vocabulary, h).tolist() for h in hashes]
        self.shortest = min(min(window, len(w)) for w in words)
        size = len(self.vocabulary)
        self.pairs = np.unique(np.concatenate([np.array(w[:-1], np.int64) * size + np.array(w[1:], np.int64) for w in words]))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = [self._add(w) for w in words]
        self._mark([i for i, _ in items], words, ends)

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:  # the run stands in an earlier item
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._split(last, word, q)
        state = self._state(length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = state
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[state] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return state

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _add(self, words: list[int]) -> int:
        state = 0
        for w in words:
            state = self._extend(state, w)
        return state

    def _mark(self, ids: list[str | None], words: list[list[int]], ends: list[int]) -> None:
        """`holds[v]`: the items of the window-long run that ends in v. `short[v]`: (words, item) of the short items that end in v."""
        of: list[set] = [set() for _ in self.link]
        self.short: list[list] = [[] for _ in self.link]
        for item, ws in zip(ids, words, strict=True):
            v = 0
            if len(ws) < self.window:
                continue
            for w in ws:
                v = u = self.next[v][w]
                while u > 0 and self.length[u] >= self.window and item not in of[u]:
                    of[u].add(item)
                    u = self.link[u]
        for item, ws in zip(ids, words, strict=True):
            if len(ws) < self.window:
                v = 0
                for w in ws:
                    v = self.next[v][w]
                self.short[v].append((len(ws), item))
        self.holds: list[tuple] = [()] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[v]
            self.short[v] = self.short[v] + self.short[up]
            if self.length[v] >= self.window:
                self.holds[v] = self.holds[up] if self.length[up] >= self.window else tuple(of[v])

    def runs(self, words: Words) -> Iterator[tuple[int, list[int]]]:
        """(first word, word numbers) of stretches whose adjacent pairs all stand in items; hits lie within them."""
        h = words.hash
        known = np.flatnonzero(self.seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, h[known]), len(self.vocabulary) - 1)
        right = self.vocabulary[at] == h[known]
        number = np.full(len(h), -1, np.int64)
        number[known[right]] = at[right]
        follows = np.zeros(len(h), bool)
        near = np.flatnonzero((number[1:] >= 0) & (number[:-1] >= 0)) + 1
        if len(near) and len(self.pairs):
            code = number[near - 1] * len(self.vocabulary) + number[near]
            place = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            follows[near] = self.pairs[place] == code
        follows[words.first[:-1][words.first[:-1] < len(h)]] = False
        begin = np.flatnonzero((number >= 0) & ~follows)
        inside = np.append((number >= 0) & follows, False)
        stop = np.flatnonzero(~inside)
        end = stop[np.searchsorted(stop, begin, "right")] if len(begin) else begin
        long = end - begin >= self.shortest
        for b, e in zip(begin[long].tolist(), end[long].tolist(), strict=True):
            yield b, number[b:e].tolist()

    def hits(self, run: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Hit stretches (first word, word after the last) in a run, and the items they come from."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        v = n = 0
        spans: list[tuple[int, int]] = []
        items: set = set()
        for p, w in enumerate(run, 1):
            while v and w not in nxt[v]:
                v = link[v]
                n = length[v]
            v = nxt[v].get(w, 0)
            n = n + 1 if v else 0
            back = 0
            if n >= window:
                back = window
                items.update(self.holds[v])
            if self.short[v]:
                for k, item in self.short[v]:
                    if k <= n:
                        back = max(back, k)
                        items.add(item)
            if back:
                if spans and p - back <= spans[-1][1]:
                    while spans and p - back <= spans[-1][1]:
                        back = max(back, p - spans.pop()[0])
                spans.append((p - back, p))
        return spans, items


def _blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str | None, np.ndarray]]]:
    """The items' word hashes in blocks, fetched one partition at a time; items without words are left out."""
    block: list[tuple[str | None, np.ndarray]] = []
    held = 0
    rows = items.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    for row in rows.orderBy("id", "text").toLocalIterator():
        data = np.frombuffer(row["text"].encode(), np.uint8)
        h = Words(data, np.array([0, len(data)]), NON_ALNUM).hash
        if not len(h):
            continue
        block.append((row["id"], h))
        held += len(h)
        if held >= block_words:
            yield block
            block, held = [], 0
    if block:
        yield block


_SPANS = pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "last", "start", "stop")]))
_FOUND = {"n_words": ("bigint", pa.int64()), "spans": ("array<struct<first:bigint,last:bigint,start:bigint,stop:bigint>>", _SPANS), "items": ("array<string>", pa.list_(pa.string()))}


def _joined(spans: list[tuple]) -> list[tuple]:
    """Spans (first, last, start, stop) in order, with those that touch or overlap merged."""
    out: list[tuple] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            b = out.pop()
            s = (b[0], max(b[1], s[1]), b[2], max(b[3], s[3]))
        out.append(s)
    return out


def _scan(automaton: Automaton | None, text_at: int, names: list[str], before: bool, returned: list[str]):
    """Adds a block's hits to a batch. before: its last three columns hold what earlier blocks have found."""
    kept = [i for i, n in enumerate(names) if n in returned]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, data, offsets in text_slices(batch.column(text_at), SMALL_BYTES):
            words = Words(data, offsets, NON_ALNUM)
            found: dict[int, tuple[list, set]] = {}
            for b, numbers in automaton.runs(words) if automaton else ():
                spans, items = automaton.hits(numbers)
                if spans:
                    i = int(np.searchsorted(words.first, b, "right")) - 1
                    own, ids = found.setdefault(i, ([], set()))
                    at = int(words.first[i])
                    own += [(b + x - at, b + y - at, int(words.start[b + x] - offsets[i]), int(words.end[b + y - 1] - offsets[i])) for x, y in spans]
                    ids |= items
            part = batch.slice(lo, hi - lo)
            if before:
                for i, (spans, items) in enumerate(zip(part.column(-2).to_pylist(), part.column(-1).to_pylist(), strict=True)):
                    own, ids = found.setdefault(i, ([], set()))
                    own += [tuple(x.values()) for x in spans]
                    ids.update(items)
            rows = [found.get(i, ([], ())) for i in range(hi - lo)]
            made = [
                pa.array(np.diff(words.first).astype(np.int64)),
                pa.array([[dict(zip(("first", "last", "start", "stop"), x, strict=True)) for x in _joined(r[0])] for r in rows], _SPANS),
                pa.array([sorted(x for x in r[1] if x is not None) for r in rows], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([part.column(i) for i in kept] + made, [names[i] for i in kept] + list(_FOUND))

    return run


def scan(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    returned: list[str] | None = None, block_words: int = BLOCK_WORDS, finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
) -> DataFrame:
    """`docs` (or its columns named in `returned`) with n_words, spans and items.

    spans: disjoint stretches of hit words in order, as words [first, last) and UTF-8 bytes [start, stop) of the text.
    items: sorted ids, as strings, of the items with a run of `window` words, or the whole shorter item, in the text.
    Null and empty texts have no words; items without words never hit; an item without an id hits but is not listed.
    Repeated items count once, repeated rows are scanned each. Columns of `docs` called like the three are replaced.
    `finish` makes batches of `docs` alone out of the rows with the three, in the worker that has scanned them.
    """
    docs = docs.drop(*_FOUND)
    names = docs.columns
    returned = names if returned is None else returned
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    out, before = docs, False
    blocks = _blocks(items, item_id, item_text, block_words)
    block = next(blocks, None)
    while True:
        following = next(blocks, None)
        automaton = Automaton(block, window) if block else None
        last = following is None
        kept = [n for n in names if n in returned or not last]
        schema = [f"`{n}` {kind[n]}" for n in kept]
        found = _scan(automaton, names.index(text_col), names, before, kept)
        if last and finish:
            return out.mapInArrow(per_batch(lambda batch: map(finish, found(batch))), ", ".join(schema))
        out = out.mapInArrow(per_batch(found), ", ".join(schema + [f"{n} {t}" for n, (t, _) in _FOUND.items()]))
        if last:
            return out
        out, before, block = stage(out, "item-hits"), True, following


def n_hit() -> Column:
    """Hit words of a row of scan()."""
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])


def _cut(text: str, spans: list[dict]) -> str:
    raw, at, parts = text.encode(), 0, []
    for s in spans:
        parts.append(raw[at : s["start"]].decode())
        at = s["stop"]
    return "".join([*parts, raw[at:].decode()])


def _cleaned(text_col: str, max_coverage: float):
    """A batch of scan()'s rows without the hit stretches, the rows that are mostly such, and the columns of scan()."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, spans = (batch.column(n).to_pylist() for n in ("n_words", "spans"))
        out = batch.drop_columns(list(_FOUND))
        if not any(spans):
            return out
        texts = [_cut(t, s) if s else t for t, s in zip(batch.column(text_col).to_pylist(), spans, strict=True)]
        at = out.schema.get_field_index(text_col)
        out = out.set_column(at, out.schema.field(at), pa.array(texts, out.schema.field(at).type))
        return out.filter(pa.array([sum(x["last"] - x["first"] for x in s) <= n * max_coverage for n, s in zip(n_words, spans, strict=True)], pa.bool_()))

    return run


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, text_col: str = "text", **options) -> DataFrame:
    """`docs` without the hit stretches of their texts; rows with over `max_coverage` of their words hit go altogether.

    Rows without a hit come back as they are, null texts too.
    """
    other = {c: free_name(docs, f"_{c}") for c in docs.columns if c.lower() in _FOUND}
    clean = scan(docs.withColumnsRenamed(other), items, window, text_col, finish=_cleaned(text_col, max_coverage), **options)
    return clean.withColumnsRenamed({v: k for k, v in other.items()}).select(docs.columns)
