"""Alignment of two tokenizers' tokens over the same bytes, and corpus-wide counts of the id pairs that overlap.

Tokens are placed by byte offsets. For a batch of documents `pandas.merge_asof`, keyed by document, finds for each token's start
the token of the other side that covers it; both directions together give every overlap, ends that both sides share cut
the tokens into groups.

Neither side's tokens cross a single space between visible characters, so such chunks are tokenised once per worker, and
a document's links are those of its chunks. A part (some MB of text within one task) therefore keeps its documents as
chunk numbers and its links once per chunk. Only (part, pair, count) rows are shuffled for the corpus-wide counts, which
then come back to the part; no document is multiplied into its links.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sitecorpus.llm.bpe import byte_characters, text_steps
from sitecorpus.llm.frames import in_parts, kept
from sitecorpus.session import stage

CUT = re.compile(r"(?<=\S) (?=\S)")
WIDE = re.compile(r"\s\s")
LONGEST = 48  # characters of a chunk that a worker keeps
KEPT = 400_000  # chunks that a worker keeps; the earliest half, the frequent ones, outlives the rest
PART = 8 << 20  # characters of text in a part


class Numbers:
    """Lists of integers in a row, by number."""

    def __init__(self):
        self.values, self.ends = np.zeros(1 << 20, np.int32), np.zeros(1 << 18, np.int64)

    def put(self, first: int, values: np.ndarray, sizes: np.ndarray) -> None:
        """Sets the lists from number `first` on."""
        at = int(self.ends[first - 1]) if first else 0
        while at + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while first + len(sizes) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.values[at : at + len(values)] = values
        self.ends[first : first + len(sizes)] = at + np.cumsum(sizes)

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all values in a row, how many each list has)."""
        stops = self.ends[numbers]
        sizes = stops - np.where(numbers > 0, self.ends[numbers - 1], 0)
        return self.values[spread(stops - sizes, sizes)], sizes


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges that begin at `starts`, one after the other."""
    upto = np.cumsum(sizes)
    return np.repeat(starts - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)


class TwoSides:
    """Tokens of both tokenizers for chunks of text, kept by chunk number."""

    def __init__(self, a_name: str, b_name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        path = lambda name: name if os.path.isabs(name) else public_tokenizers.path(name)
        lib = Tokenizer.from_file(path(a_name))
        special = {t.content for t in lib.get_added_tokens_decoder().values()}
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in lib.get_vocab(with_added_tokens=False).items() if t not in special}
        self.a = tiktoken.Encoding(a_name, pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in a_bytes.items()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path(b_name))
        self.n_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{b_name} has pieces that cross a space")
        self.a_size = np.zeros(max(a_bytes) + 1, np.int64)
        for i, b in a_bytes.items():
            self.a_size[i] = len(b)
        self.b_size = np.array([len(b) for b in self.b_bytes], np.int64)
        # Decimal ids with what follows them: a comma, or the bar or semicolon that ends a side or group.
        self.a_text = np.array([f"{i}," for i in range(len(self.a_size))] + [f"{i}|" for i in range(len(self.a_size))], object)
        self.b_text = np.array([f"{i}," for i in range(self.n_b)] + [f"{i};" for i in range(self.n_b)], object)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.a_ids, self.b_ids = Numbers(), Numbers()
        self.unequal: set[int] = set()  # chunks whose B bytes are not the text's
        self.long = 0  # characters of chunks that are not to stay

    def trim(self) -> None:
        """Forgets long chunks, and the later half of all when there are too many; only between parts, as the rest is numbered anew."""
        if len(self.known) <= KEPT and self.long <= PART:
            return
        most = KEPT // 2 if len(self.known) > KEPT else len(self.known)
        kept = [(c, n) for c, n in islice(self.known.items(), most) if len(c) <= LONGEST]
        numbers, unequal = np.array([n for _, n in kept], np.int64), self.unequal
        a, b = self.a_ids.get(numbers), self.b_ids.get(numbers)
        self._clear()
        self.a_ids.put(0, *a)
        self.b_ids.put(0, *b)
        self.known = {c: i for i, (c, _) in enumerate(kept)}
        self.unequal = {i for i, (_, n) in enumerate(kept) if n in unequal}

    def _learn(self, chunks: list[str]) -> None:
        n = len(self.known)
        raw = [c.encode() for c in chunks]
        plain = [i for i, c in enumerate(chunks) if len(c) > 1 and not c[1].isspace() and not c[-1].isspace()]  # these can be joined and cut again
        a_of: list = [None] * len(chunks)
        if plain:
            ids = np.array(self.a.encode_ordinary("".join(chunks[i] for i in plain)), np.int32)
            cut = np.searchsorted(np.cumsum(self.a_size[ids]), np.cumsum([len(raw[i]) for i in plain]), "left") + 1
            for i, part in zip(plain, np.split(ids, cut[:-1]), strict=True):
                a_of[i] = part
        for i, part in enumerate(a_of):
            if part is None:
                a_of[i] = np.array(self.a.encode_ordinary(chunks[i]), np.int32)
        b_of = self.b.encode([c[1:] for c in chunks], num_threads=1)  # it puts the space before
        for i, (ids, data) in enumerate(zip(b_of, raw, strict=True)):
            if b"".join(map(self.b_bytes.__getitem__, ids)) != data:
                self.unequal.add(n + i)
        self.a_ids.put(n, np.concatenate(a_of) if a_of else np.zeros(0, np.int32), np.array([len(x) for x in a_of], np.int64))
        self.b_ids.put(n, np.fromiter((i for ids in b_of for i in ids), np.int32), np.array([len(x) for x in b_of], np.int64))
        self.known.update(zip(chunks, range(n, n + len(chunks)), strict=True))
        self.long += sum(len(c) for c in chunks if len(c) > LONGEST)

    def chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(chunk numbers of all texts in a row, how many each text has); texts that have no tokens have no chunks."""
        found: list[str] = []
        many = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                cut = CUT.split(t) if WIDE.search(t) else t.split(" ")
                if cut[0] == "" or cut[-1] == "":  # a space at an end has no visible neighbour there
                    cut = CUT.split(t)
                many[i] = len(cut)
                found += [" " + c for c in cut]
        new = set(found).difference(self.known)
        if new:
            self._learn(list(new))
        number = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        if self.unequal:
            doc = np.repeat(np.arange(len(texts)), many)
            wrong = np.unique(doc[np.isin(number, np.fromiter(self.unequal, np.int64))])
            number = number[~np.isin(doc, wrong)]
            many[wrong] = 0
        return number, many


def two_sides(a_name: str, b_name: str) -> TwoSides:
    """One for each worker process."""
    return kept(("sides", a_name, b_name), lambda: TwoSides(a_name, b_name))


def overlaps(a_size: np.ndarray, a_doc: np.ndarray, b_size: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token) of every overlap, by place, and for each A and each B token the number of its group.

    Takes the byte sizes of tokens that follow each other and their documents; both sides cover the same bytes.
    """
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    a = pd.DataFrame({"start": a_end - a_size, "doc": a_doc, "i": np.arange(len(a_size))})
    b = pd.DataFrame({"start": b_end - b_size, "doc": b_doc, "j": np.arange(len(b_size))})
    of_a = pd.merge_asof(a, b, on="start", by="doc")
    of_b = pd.merge_asof(b, a, on="start", by="doc")
    inside = a["start"].to_numpy()[of_b["i"].to_numpy()] != of_b["start"].to_numpy()  # a pair with equal starts is in `of_a` already
    i = np.concatenate([of_a["i"].to_numpy(), of_b["i"].to_numpy()[inside]])
    j = np.concatenate([of_a["j"].to_numpy(), of_b["j"].to_numpy()[inside]])
    order = np.argsort(i + j, kind="stable")  # each link moves on one token on at least one side
    shared = b_end[np.searchsorted(b_end, a_end)] == a_end
    a_group = np.cumsum(shared) - shared
    ends = a_end[shared]
    return i[order], j[order], a_group, np.searchsorted(ends, b_end)


def _grouped(own: TwoSides, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, a_many: np.ndarray, b_many: np.ndarray) -> list[str]:
    """The groups of every document as text: ids of A with commas, a bar, ids of B with commas; a semicolon between groups."""
    groups = int(a_group[-1]) + 1 if len(a_group) else 0
    a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    text = np.empty(len(a) + len(b), object)
    last_a, last_b = np.diff(a_group, append=groups) != 0, np.diff(b_group, append=groups) != 0
    text[np.arange(len(a)) + (np.cumsum(b_in) - b_in)[a_group]] = own.a_text[a + last_a * len(own.a_size)]
    text[np.arange(len(b)) + np.cumsum(a_in)[b_group]] = own.b_text[b + last_b * own.n_b]
    ends = np.cumsum(a_many + b_many)
    words = text.tolist()
    return ["".join(words[e - n : e])[:-1] for e, n in zip(ends.tolist(), (a_many + b_many).tolist(), strict=True)]


def _sums(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `many` values."""
    upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(many)
    return upto[ends] - upto[ends - many]


def packed(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.astype("<u4").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)


class _Part:
    """What a part holds: its documents' rows and chunk numbers, and each chunk's links once."""

    def __init__(self, own: TwoSides):
        self.own, self.size = own, 0
        self.ids: list[pa.Array] = []
        self.columns: list[list] = [[], [], [], [], []]
        self.uses: list[np.ndarray] = []
        self.many: list[np.ndarray] = []
        self.codes, self.code_sizes, self.seen = [], [], np.zeros(0, np.int64)

    def add(self, ids: pa.Array, texts: list[str], full: bool) -> None:
        own = self.own
        number, many = own.chunks(texts)
        a, a_sizes = own.a_ids.get(number)
        b, b_sizes = own.b_ids.get(number)
        a_many, b_many = _sums(a_sizes, many), _sums(b_sizes, many)
        doc = np.arange(len(texts))
        i, j, a_group, b_group = overlaps(own.a_size[a], np.repeat(doc, a_many), own.b_size[b], np.repeat(doc, b_many))
        link_doc = np.repeat(doc, a_many)[i]
        group_doc = np.repeat(doc, a_many)[np.flatnonzero(np.diff(a_group, prepend=-1))]
        groups = _grouped(own, a, b, a_group, b_group, a_many, b_many)
        n_links, n_groups = np.bincount(link_doc, minlength=len(doc)), np.bincount(group_doc, minlength=len(doc))
        for column, values in zip(self.columns, (a_many, b_many, n_groups, n_links, groups if full else [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]), strict=True):
            column += values.tolist() if isinstance(values, np.ndarray) else values
        # Links of chunks that this part has not met before, from where each first stands.
        unit = np.repeat(np.arange(len(number)), a_sizes)[i]
        per_unit = np.bincount(unit, minlength=len(number))
        new, first = np.unique(number, return_index=True)
        fresh = ~np.isin(new, self.seen)
        at = first[fresh]
        codes = a[i].astype(np.int64) * own.n_b + b[j]
        self.codes.append(codes[spread((np.cumsum(per_unit) - per_unit)[at], per_unit[at])])
        self.code_sizes.append(per_unit[at])
        self.seen = np.concatenate([self.seen, new[fresh]])
        self.ids.append(ids)
        self.uses.append(number)
        self.many.append(many)
        self.size += sum(map(len, texts))

    def rows(self, part: int) -> pa.RecordBatch:
        """The documents' rows, then one with the part's links by chunk and how often each pair is linked."""
        own, n = self.own, sum(map(len, self.ids))
        place = np.zeros(int(self.seen.max()) + 1 if len(self.seen) else 0, np.int64)
        place[self.seen] = np.arange(len(self.seen))
        uses, many = place[np.concatenate(self.uses)], np.concatenate(self.many)
        codes, sizes = np.concatenate(self.codes), np.concatenate(self.code_sizes)
        times = np.bincount(uses, minlength=len(self.seen))
        pairs, inverse = np.unique(codes, return_inverse=True)
        counts = np.bincount(inverse, np.repeat(times, sizes), len(pairs)).astype(np.int64)
        ends = np.cumsum(many)
        own.trim()
        none = [None] * n
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part] * (n + 1), pa.int64()), pa.concat_arrays([*self.ids, pa.nulls(1, self.ids[0].type)]),
                *(pa.array([*c, None], pa.int64()) for c in self.columns[:4]), pa.array([*self.columns[4], None], pa.string()),
                pa.array([packed(uses[e - m : e]) for e, m in zip(ends, many, strict=True)] + [packed(sizes)], pa.binary()),
                pa.array([*none, packed(codes)], pa.binary()), pa.array([*none, pairs.tolist()], pa.list_(pa.int64())), pa.array([*none, counts.tolist()], pa.list_(pa.int64())),
            ],
            ["part", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "uses", "links", "pairs", "counts"],
        )


def align(docs: DataFrame, a_tokenizer: str, b_tokenizer: str, full: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row of `docs`.

    A: space and text by a byte-level BPE file; B: the text by a sentencepiece file, which adds the space. `groups` is
    "a1,a2|b1;a3|b2,b3": between two ends that both sides share, A's ids, then B's; its SHA-256 if not `full`. A pair's count
    is the number of links in all of `docs` between its two ids; n_best counts the links whose pair has the highest count of
    its B id, ties included, and count_sum adds up all links' counts.

    Null and empty texts, and those that a side's bytes do not give back, have zeros and '' and count nowhere. Repeated
    rows, null and equal ids give a row each and count each time; other columns do not matter; an empty table gives no rows.
    A part is held in memory, and so is a text longer than one.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = two_sides(a_tokenizer, b_tokenizer)
        number = TaskContext.get().partitionId() << 32
        part = _Part(own)
        for batch in in_parts(batches):
            for at, texts in text_steps(batch.column(1).to_pylist()):
                part.add(batch.column(0).slice(at, len(texts)), texts, full)
                if part.size >= PART:
                    yield part.rows(number)
                    number, part = number + 1, _Part(own)
        if part.ids:
            yield part.rows(number)

    schema = f"part bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, uses binary, links binary, pairs array<bigint>, counts array<bigint>"
    rows = stage(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema), "aligned")
    held = rows.filter("links IS NOT NULL").select("part", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("part", "x.pairs", "x.counts")
    totals = held.groupBy("pairs").agg(F.sum("counts").alias("total"))
    n_b = _pieces(b_tokenizer)
    of_b = Window.partitionBy(F.col("pairs") % n_b)  # at most one pair for each id of A
    totals = totals.withColumn("best", F.col("total") == F.max("total").over(of_b))
    back = held.join(totals, "pairs").select(F.col("part").alias("of_part"), "pairs", "total", "best")
    made = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
    return rows.drop("pairs", "counts").groupBy("part").cogroup(back.groupBy("of_part")).applyInArrow(_counted, made)


def _pieces(b_tokenizer: str) -> int:
    import public_tokenizers
    import sentencepiece

    path = b_tokenizer if os.path.isabs(b_tokenizer) else public_tokenizers.path(b_tokenizer)
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def _counted(rows: pa.Table, back: pa.Table) -> pa.Table:
    """A part's documents with the sums over their links, from the corpus-wide counts of the part's pairs."""
    is_doc = rows.column("links").is_null()
    docs, own = rows.filter(is_doc), rows.filter(is_doc.cast(pa.int8()).to_numpy() == 0).to_pylist()[0]
    pairs = back.column("pairs").to_numpy()
    order = np.argsort(pairs)
    at = order[np.searchsorted(pairs, unpacked(own["links"]), sorter=order)]
    sizes = unpacked(own["uses"])
    uses = [unpacked(u) for u in docs.column("uses").to_pylist()]
    many = np.array([len(u) for u in uses], np.int64)
    uses = np.concatenate(uses)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    made = {
        "n_best": _sums(_sums(back.column("best").to_numpy()[at], sizes)[uses], many), "count_sum": _sums(_sums(back.column("total").to_numpy()[at], sizes)[uses], many),
    }
    return pa.table([pa.array(made[n], pa.int64()) if n in made else docs.column(n) for n in names], names)
