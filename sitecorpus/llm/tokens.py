"""Token ids of whole texts by a public byte-level BPE file, with a bounded cache of chunks that tokenise on their own."""

from __future__ import annotations

import os
import re
from itertools import islice

import numpy as np

from sitecorpus.llm.frames import kept

# A text is cut before single spaces between visible characters: no pre-token of the byte-level pattern spans such a
# place, so the chunks' ids in a row are the text's.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s\s")
CACHED = 160_000  # chunks a worker keeps; the earliest half, the frequent ones, outlives the rest
LONGEST = 48  # characters of a chunk that is kept


class CachedTokenizer:
    """Token ids as the `tokenizers` library gives them for the file. Chunks that are new are merged by `tiktoken` with the
    file's own vocabulary, whose ids are in merge order; texts that hold a special token's string go to `tokenizers`."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_of = {c: b for b, c in _byte_characters().items()}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t not in self.special}
        self.merges = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.bytes[i] = len(token)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(1 << 18, np.int64)  # ends[i]: where the ids of chunk i end

    def _encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.merges.encode_ordinary(text), np.uint32)

    def _learn(self, chunks: list[str]) -> None:
        """Adds new chunks; those that begin with a space are tokenised in one go."""
        spaced = [c for c in chunks if c[0] == " " and len(c) > 1]
        rest = [c for c in chunks if not (c[0] == " " and len(c) > 1)]
        parts, sizes = [], []
        if spaced:
            text = "".join(spaced)
            if any(s in text for s in self.special):
                rest, spaced = spaced + rest, []
            else:
                ids = np.array(self.merges.encode_ordinary(text), np.uint32)
                cut = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum([len(c.encode()) for c in spaced]), "left") + 1
                parts.append(ids)
                sizes.append(np.diff(cut, prepend=0))
        for c in rest:
            parts.append(self._encode(c))
            sizes.append(np.array([len(parts[-1])]))
        if not parts:
            return
        ids, size, n = np.concatenate(parts), np.concatenate(sizes), len(self.known)
        at = int(self.ends[n - 1]) if n else 0
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(size) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[at : at + len(ids)] = ids
        self.ends[n : n + len(size)] = at + np.cumsum(size)
        self.known.update(zip(spaced + rest, range(n, n + len(size)), strict=True))

    def __call__(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each followed by end_id; where each text begins)."""
        if len(self.known) > CACHED:
            self.known = dict(islice(self.known.items(), CACHED // 2))
        chunks: list[str] = []
        many = [0]
        for t in texts:
            if any(s in t for s in self.special):
                chunks.append(t)
            else:
                cut = _CUT.split(t) if _WIDE.search(t) else t.split(" ")
                if cut[0]:
                    chunks.append(cut[0])
                chunks += [" " + c for c in cut[1:]]
            many.append(len(chunks))
        new = set(chunks).difference(self.known)
        long = {c for c in new if len(c) > LONGEST}
        self._learn(list(new - long))
        kept = len(self.known)
        self._learn(list(long))
        number = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        stops = self.ends[number]
        sizes = stops - np.where(number > 0, self.ends[number - 1], 0)
        upto = np.cumsum(sizes)
        ids = self.ids[np.repeat(stops - upto, sizes) + np.arange(upto[-1] if len(upto) else 0)]
        for c in long:  # used once; they are the last
            del self.known[c]
        assert len(self.known) == kept
        ends = np.concatenate([np.zeros(1, np.int64), upto])[many[1:]]
        return np.insert(ids, ends, np.uint32(end_id)), np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if visible, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    return out | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in out)}


def tokenizer(name: str) -> CachedTokenizer:
    """One for each worker process, so that what a task has learnt serves the next."""
    return kept(("tokens", name), lambda: CachedTokenizer(name))
