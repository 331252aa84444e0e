"""Byte-pair encoding by a priority queue of merge ranks over a doubly linked list of symbols, and decoding by joining vocabulary strings.

The file is in the format of the `tokenizers` library: a BPE model with an end-of-word suffix behind a normaliser and a
pattern that cuts the text into words, white space dropped. Merging is done here; words that a worker has merged lately
are kept within a fixed number of bytes.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from sitecorpus.llm.frames import in_parts, kept

# The file's normaliser and word pattern, and the characters whose class and case are the same in every
# version of Unicode in use. Texts with others are normalised and cut by the library's own parts.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SETTLED = (
    r"\x00-\x1b\x20-ɏ̀-ͅΑ-ΡΣ-ωЀ-ҁҊ-ԣ -‧‰-⁞₠-₵"
    r"←-⏧─-☄　-〩ぁ-ゖァ-ヺ一-龥가-힣！-～\U0001f300-\U0001f320\U0001f600-\U0001f640"
)
ODD = re.compile(f"[^{SETTLED}]")

KEPT = 256 << 20  # bytes of words and their ids that a worker keeps
OVERHEAD = 200  # bytes of a kept word besides its characters and ids
LONGEST = 64  # characters of a word that is kept
PLACES = list(range(66))


class Recent:
    """A dict of bounded size: what has not been asked for during the last half of its bytes is forgotten."""

    def __init__(self, most: int):
        self.half = most // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.used = 0

    def get(self, key: str) -> bytes | None:
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key: str, value: bytes) -> None:
        self.young[key] = value
        self.used += len(key) + len(value) + OVERHEAD

    def age(self) -> None:
        if self.used > self.half:
            self.old, self.young, self.used = self.young, {}, 0


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if visible, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Codec:
    """Ids of texts, and texts of ids, for a tokenizer file (a name among the public ones, or a path)."""

    def __init__(self, name: str, most: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core
        import public_tokenizers
        from tokenizers import Tokenizer

        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        if (spec["normalizer"] or {}).get("normalizers") != NORMALIZER or cut.get("pattern") != {"Regex": WORD} or spec["decoder"]:
            raise ValueError(f"{name} has another normaliser, word pattern or decoder than this operator knows")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        strings = {i: s for s, i in (vocab | added).items()}
        self.strings = np.array([strings.get(i, "") for i in range(max(strings) + 1)], object)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(strings) + 2)]  # of (left)[right]; the last, also (-1), stays empty
        self.made_by = []
        for rank, (a, b) in enumerate(pairs):
            self.ranks[vocab[a]][vocab[b]] = rank
            self.made_by.append(vocab[a + b])
        self.characters = byte_characters()
        self.inner = [vocab[c] for c in self.characters]
        self.last = [vocab[c + suffix] for c in self.characters]
        self.parts = Tokenizer.from_file(path)  # its normaliser and word cutter serve odd characters
        self.added = {f" {s}": array("i", [i]).tobytes() for s, i in added.items()}
        self.cut_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.cut_words = regex.compile(WORD)
        self.known = Recent(most)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one word. The queue gives the pair of lowest rank, leftmost first; an entry whose pair has changed since is skipped."""
        n, known, made_by = len(data), self.ranks, self.made_by
        symbols = [*map(self.inner.__getitem__, data), -1]  # a pair with -1 is no merge, nor is one with a symbol that has been merged away
        symbols[n - 1] = self.last[data[n - 1]]
        queue = [rank << 32 | i for i, rank in enumerate(map(dict.get, map(known.__getitem__, symbols), symbols[1:])) if rank is not None]
        heapify(queue)
        after, before = (PLACES[1 : n + 2], PLACES[:n]) if n < 64 else (list(range(1, n + 2)), list(range(n)))
        before.append(0)  # before[i] is one more than the place of the symbol on the left, 0 for none
        while queue:
            item = heappop(queue)
            i, rank = item & 0xFFFFFFFF, item >> 32
            j = after[i]
            if known[symbols[i]].get(symbols[j]) != rank:
                continue
            made = symbols[i] = made_by[rank]
            symbols[j] = -1
            k = after[i] = after[j]
            before[k] = i + 1
            rank = known[made].get(symbols[k])
            if rank is not None:
                heappush(queue, rank << 32 | i)
            h = before[i]
            if h:
                rank = known[symbols[h - 1]].get(made)
                if rank is not None:
                    heappush(queue, rank << 32 | h - 1)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = array("i", self.merge(word.encode())).tobytes()
            if len(word) <= LONGEST:
                self.known.put(word, ids)
        return ids

    def _odd(self, text: str) -> bytes:
        """Ids of a text with characters whose class depends on the version of Unicode."""
        byte = {c: b for b, c in enumerate(self.characters)}
        cut = self.parts.pre_tokenizer.pre_tokenize_str(self.parts.normalizer.normalize_str(text))
        return array("i", chain.from_iterable(self.merge(bytes(map(byte.__getitem__, word))) for word, _ in cut)).tobytes()

    def _keys(self, text: str) -> list[str]:
        """What a text is made of: words between spaces, added tokens and stretches with odd characters; the last two begin with a space."""
        out: list[str] = []
        for part in self.cut_added.split(text) if self.cut_added and self.cut_added.search(text) else (text,):
            if f" {part}" in self.added:
                out.append(f" {part}")
            elif part.isascii() and not any(c in part for c in "\x1c\x1d\x1e\x1f"):
                out += part.lower().split()
            elif ODD.search(part):
                out.append(f" {part}")
            else:
                part = unicodedata.normalize("NFC", part)
                out += ("".join(c.lower() for c in part) if "Σ" in part else part.lower()).split()  # no final form of sigma
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many each text has)."""
        keys, many = [], np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            keys += self._keys(text)
            many[i + 1] = len(keys)
        self.known.age()
        once: dict[str, bytes] = {}
        young = self.known.young
        for key in set(keys).difference(young):
            if key[0] == " ":
                once[key] = self.added.get(key) or self._odd(key[1:])
            elif self.known.get(key) is None:
                ids = self._word(key) if key.isalpha() else b"".join(map(self._word, self.cut_words.findall(key)))
                if len(key) > LONGEST:
                    once[key] = ids
                elif key not in young:
                    self.known.put(key, ids)
        found = [young[k] if k in young else once[k] for k in keys] if once else list(map(young.__getitem__, keys))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])[many]
        return np.frombuffer(b"".join(found), np.intc), np.diff(ends)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: their vocabulary strings with one space between; ids that the file does not have are left out."""
        ids = ids[(ids >= 0) & (ids < len(self.strings))]
        return " ".join(filter(None, self.strings[ids].tolist()))


def codec(name: str) -> Codec:
    """One for each worker process: words that a task has merged serve the next."""
    return kept(("codec", name), lambda: Codec(name))


STEP = 1 << 20  # characters of text handled at once


def text_steps(texts: list[str | None], most: int = STEP) -> Iterator[tuple[int, list[str]]]:
    """(first place, texts) of consecutive texts of about `most` characters together, nulls as empty."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= most):
            size += len(texts[stop] or "")
            stop += 1
        yield at, [t or "" for t in texts[at:stop]]
        at = stop


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row of `docs`: the ids that the `tokenizers` library gives for the text with
    add_special_tokens=False, and the text that it decodes from them with special tokens kept.

    A null or empty text, or one of white space only, has no ids and decodes to the empty text. Added tokens' strings in a
    text become their ids. Rows are handled one by one: repeated rows, null ids and ties give a row each; other columns of
    `docs` do not matter; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in in_parts(batches):
            for at, texts in text_steps(batch.column(1).to_pylist()):
                ids, many = own.encode(texts)
                ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(many)])
                decoded = [own.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def decode(rows: DataFrame, tokenizer: str, ids_col: str = "ids", as_col: str = "decoded") -> DataFrame:
    """`rows` with the text that their ids stand for in column `as_col`; null ids give null, null entries are left out."""
    columns = rows.columns
    at = columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in in_parts(batches):
            texts = [None if ids is None else own.decode(np.array([i for i in ids if i is not None], np.int64)) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*columns, as_col])

    return rows.mapInArrow(run, StructType([*rows.schema, StructField(as_col, StringType())]))
