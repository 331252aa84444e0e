"""Operators on tokenizers, against the libraries and a pair-by-pair count."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from sitecorpus.llm import alignment, bpe, frames, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

WORDS, BYTES, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"
SF = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "\n\t ", "It's a test, isn't it? 123", "STRASSE Straße ΣΊΣΥΦΟΣ İstanbul", "é ﬁ ² ½ Ⅷ", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>", "\x00\x1c\x1d x\x85y​z﻿",
    "漢字かな 한국어 😀👩‍👩 ٣ ꙮ 𐐀𞤀", "x" * 5000, "ab" * 3000 + " end", "  leading and  double \n\n spaces  ", "▁ already ▁marked", "<s> </s> <unk> <0x0A>", "tail ", "same text", "same text", "word " * 2000,
]
ALPHABET = st.text(st.sampled_from("ab'sSéß İΣσ<|>\n\t\x1c\x85​漢한ﬁ😀12٣▁"), max_size=30)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(WORDS))


@settings(max_examples=400, deadline=None)
@given(ALPHABET)
def test_codec_is_the_library(library, text):
    own = bpe.codec(WORDS)
    ids, _ = own.encode([text])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_codec_with_a_small_memory(library):
    own, rnd = bpe.Codec(WORDS, most=20_000), random.Random(5)
    for _ in range(30):
        texts = [" ".join("".join(rnd.choice("abcdeilnorst") for _ in range(rnd.randint(1, 12))) for _ in range(rnd.randint(0, 60))) for _ in range(10)]
        ids, many = own.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(many)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_merges_by_rank_not_by_length():
    """Against merging by looking for the lowest rank anew each time."""
    own, rnd = bpe.codec(WORDS), random.Random(2)
    for _ in range(500):
        word = "".join(rnd.choice("aehinorst'é") for _ in range(rnd.randint(1, 14))).encode()
        symbols = [own.inner[b] for b in word[:-1]] + [own.last[word[-1]]]
        while True:
            ranks = [(own.ranks[a][b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if b in own.ranks[a]]
            if not ranks:
                break
            rank, i = min(ranks)
            symbols[i : i + 2] = [own.made_by[rank]]
        assert own.merge(word) == symbols


def test_op11_digests(spark, library, tmp_path):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "clash", "clash"), (None, "no id", None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, ids string, decoded string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op11_bpe_codec"](spark, str(tmp_path)).collect())
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((str(i), len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want)


def test_decode_rows(spark, library):
    rows = spark.createDataFrame([(1, [320, 49407, 1929]), (2, []), (3, None), (4, [None, 320, 999_999])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in bpe.decode(rows, WORDS).collect()} == {1: "a</w> <|endoftext|> " + library.id_to_token(1929), 2: "", 3: None, 4: "a</w>"}


def sides():
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path(BYTES))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    byte_of = {c: i for i, c in enumerate(bpe.byte_characters())}

    def tokens(text):
        one = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            two.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (one, two) if text and b"".join(x for _, x in one) == whole == b"".join(x for _, x in two) else ([], [])

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def aligned(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every text, pair by pair."""
    tokens, docs, count = sides(), [], Counter()
    for t in texts:
        a, b = map(spans, tokens(t or ""))
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        count.update(links)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, low = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x[0]) for x in side if low < x[2] <= end) for side in (a, b)))
            low = end
        docs.append((len(a), len(b), links, groups))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(n_a, n_b, len(g), len(k), sum(count[x] == most[x[1]] for x in k), sum(count[x] for x in k), ";".join(g)) for n_a, n_b, k, g in docs]


def odd_texts(seed):
    rnd = random.Random(seed)
    words = ["the", "there", "naïve", "Straße", "12,5", "don't", "\n", "", "x" * 60, "漢字", "😀", "<|endoftext|>", "▁", "unglaublich", "é", "a\tb"]
    return [t if t is None or len(t) < 300 else t[:300] for t in TEXTS] + [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 25))) for _ in range(60)]


@pytest.mark.parametrize("part", [40, 1 << 23])
def test_alignment_pair_by_pair(spark, monkeypatch, part):
    monkeypatch.setattr(alignment, "PART", part)
    texts = odd_texts(part)
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    got = alignment.align(spark.createDataFrame(rows, "doc_id bigint, text string, part string").repartition(3), BYTES, PIECES).collect()
    want = aligned(texts)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == want[r.doc_id], texts[r.doc_id]


def test_alignment_after_forgetting(monkeypatch):
    monkeypatch.setattr(alignment, "KEPT", 30)
    own, rnd, tokens = alignment.TwoSides(BYTES, PIECES), random.Random(1), sides()
    for _ in range(40):
        texts = [" ".join(rnd.choice(["ab", "abc", "▁x", "long" * 20, "naïve", f"n{rnd.randint(0, 99)}"]) for _ in range(6)) for _ in range(5)]
        number, many = own.chunks(texts)
        a, sizes = own.a_ids.get(number)
        b, _ = own.b_ids.get(number)
        want = [tokens(t) for t in texts]
        assert a.tolist() == [i for one, _ in want for i, _ in one] and b.tolist() == [i for _, two in want for i, _ in two]
        own.trim()


def test_op12_on_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [(r.doc_id, r.text) for r in rows if len(r.text or "") < 2000]
    got = {r.doc_id: r for r in alignment.align(spark.createDataFrame(short, "doc_id bigint, text string"), BYTES, PIECES, full=False).collect()}
    for (i, _), want in zip(short, aligned([t for _, t in short]), strict=True):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == (*want[:6], hashlib.sha256(want[6].encode()).hexdigest() if want[6] else "")


def test_what_a_worker_keeps():
    a = frames.kept("a", lambda: ["a"])
    list(frames.in_parts(iter([])))
    assert frames.kept("a", lambda: ["b"]) is a  # asked for again
    list(frames.in_parts(iter([])))
    frames.kept("c", lambda: ["c"])
    list(frames.in_parts(iter([])))
    assert frames.kept("a", lambda: ["b"]) == ["b"]  # a task came between that did not ask
