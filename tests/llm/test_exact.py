"""Operators with an exact answer, against brute force on small tables."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from sitecorpus.llm import anchors, automaton, frames, licence_full, licences, naming, packing, sketch, words
from sitecorpus.llm.frames import row_key

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def test_word_spans_and_hashes():
    text = "Ab ab\x0bÉé,x 12"
    data = np.frombuffer(text.encode(), np.uint8)
    w = words.Words(data, np.array([0, len(data)]), words.SPACES)
    assert [bytes(data[a:b]).decode() for a, b in zip(w.start, w.end)] == ["Ab", "ab", "Éé,x", "12"]
    assert w.hash[0] == w.hash[1] == words.hash_words([b"ab"])[0] and len(set(w.hash.tolist())) == 3
    w = words.Words(data, np.array([0, 1, len(data)]), words.SPACES)  # a text never continues the one before
    assert list(w.first) == [0, 1, 5]


def test_scanning_takes_few_times_the_text():
    texts = ["Some words of a text, and the number %d " % i * 60 for i in range(frames.ROWS)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    item = np.frombuffer(b"words of a text and", np.uint8)
    made = automaton.Automaton([("i", words.Words(item, np.array([0, len(item)]), words.NON_ALNUM).hash)], 10)
    scan = automaton._scan(made, 1, ["doc_id", "text"], False, ["doc_id"])
    tracemalloc.start()
    out = list(scan(batch))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, texts)) > 1 << 20 and peak < 36 << 20
    assert [r["doc_id"] for b in out for r in b.to_pylist()] == list(range(len(texts)))
    assert all(len(r["spans"]) == 60 and r["items"] == ["i"] for b in out for r in b.to_pylist())


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    rnd = random.Random(3)
    texts = ["", None, " \t\n", "a b", "ab ", "x" * 50, "x" * 25 + " " + "x" * 25, "x" * 49, "é" * 33, "ab"]
    texts += ["".join(rnd.choice("ab \n") for _ in range(rnd.randint(0, 14))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, "zz"), (None, "z z")]
    bucket = (lambda *c: F.pmod(F.xxhash64(*c), F.lit(3))) if weak else naming._bucket  # three buckets: collisions everywhere
    got = naming.exact_groups(table(spark, rows), block=4, bucket=bucket).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    want = []
    for norm, members in groups.items():
        keep = min(members)[2]
        want += [(i, keep, len(members), hashlib.sha256(norm.encode()).hexdigest()) for _, _, i in members]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.doc_id is not None)
    assert sum(r.kept for r in got) == len(groups) + 1  # the repeated row counts twice


def near_truth(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_groups(spark, monkeypatch):
    monkeypatch.setattr(sketch, "WIDE", 3)  # so that buckets of this test count as wide
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows, i = [(0, None), (1, "  "), (2, "one two"), (3, "ONE  two"), (4, "one two three")], 5
    for _ in range(12):
        base = [word() for _ in range(rnd.choice([30, 80, 160]))]
        for _ in range(6):
            t = list(base)
            for _ in range(rnd.randint(0, 4)):
                t[rnd.randrange(len(t))] = word()
            rows.append((i, " ".join(t)))
            i += 1
    for _ in range(40):  # a passage that many texts share
        rows.append((i, " ".join([word() for _ in range(rnd.randint(5, 40))] + passage)))
        i += 1
    want = near_truth(rows)
    got = sketch.near_groups(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_sketches_fill_and_estimate():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 3000):
        a = rnd.integers(0, 1 << 63, n).astype(np.uint64)
        assert sketch.sketch(a).max() != sketch._EMPTY
    a = rnd.integers(0, 1 << 63, 1000).astype(np.uint64)
    same = (sketch.sketch(a) == sketch.sketch(np.concatenate([a[:920], a[:80] ^ np.uint64(1)]))).mean()
    assert abs(same - 920 / 1080) < 0.12


def hits_truth(text, items, window):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    w, hit, ids = split(text), set(), set()
    for item, t in items:
        x = split(t)
        n = min(window, len(x))
        runs = {tuple(x[j : j + n]) for j in range(len(x) - n + 1)} if n else set()
        for p in range(len(w) - n + 1):
            if n and tuple(w[p : p + n]) in runs:
                hit |= set(range(p, p + n))
                ids.add(item)
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("block", [200_000, 12])
def test_scan(spark, block):
    rnd = random.Random(9)
    say = lambda n: " ".join(rnd.choice(["a", "B", "c1", "é", "d"]) for _ in range(n))
    items = [(k, say(n)) for k, n in enumerate([0, 1, 2, 3, 5, 8, 9, 12, 12])] + [(20, None), (5, "x y z"), (21, "d, d! d")]
    items[1] = (1, "zeta")
    rows = [(i, say(rnd.randint(0, 40))) for i in range(60)] + [(60, None), (61, ""), (62, "Zeta"), (63, "--"), (3, "x y z x y z")]
    got = automaton.scan(table(spark, rows), table(spark, items, "item_id bigint, text string"), window=4, block_words=block).withColumn("n", automaton.n_hit()).collect()
    assert len(got) == len(rows)
    for r in got:
        n, hit, ids = hits_truth(r.text, [(str(k), t) for k, t in items], 4)
        assert (r.n_words, r.n, r["items"]) == (n, hit, ids), r.text
        spans = [(s["first"], s["last"]) for s in r.spans]
        assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_decontaminate(spark):
    docs = table(spark, [(1, "Keep é this, one two three four, and that.", "x"), (2, "one two three four", "y"), (3, None, None), (4, "clean", "z")], "doc_id bigint, text string, spans string")
    items = table(spark, [(1, "One two three four")], "item_id bigint, text string")
    got = {r.doc_id: r for r in automaton.decontaminate(docs, items, window=4).collect()}
    assert got[1].text == "Keep é this, , and that." and got[1].spans == "x"
    assert 2 not in got and got[3].text is None and got[4].text == "clean"


@pytest.mark.parametrize("block", [6, 10_000])
def test_one_worker_of_a_task_scans_and_cuts(spark, block):
    rnd = random.Random(8)
    text = lambda n: rnd.choice([" ", ", é "]).join(rnd.choice(["one", "Two", "Öl", "three", "x1"]) for _ in range(rnd.randint(0, n)))
    docs = table(spark, [(i, text(40)) for i in range(300)] + [(7, None), (8, "one"), (8, "one")])
    items = table(spark, [(i, text(9)) for i in range(4)], "item_id bigint, text string")
    want = []
    for r in automaton.scan(docs, items, window=4).collect():
        raw, at, parts = (r.text or "").encode(), 0, []
        for x in r.spans:
            parts.append(raw[at : x["start"]])
            at = x["stop"]
        if sum(x["last"] - x["first"] for x in r.spans) <= 0.5 * r.n_words:
            want.append((r.doc_id, None if r.text is None else b"".join([*parts, raw[at:]]).decode()))
    got = automaton.decontaminate(docs, items, window=4, block_words=block)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert len(want) < 300 and any(a != b for a, b in zip(sorted(want, key=str), sorted(map(tuple, docs.collect()), key=str)))


def test_the_key_test_drops_what_earlier_tasks_kept(spark):
    keys = spark.createDataFrame([(bytearray(b"0123456789abcdef"),)], "rid binary")
    test = sketch.may_be_in(keys).func
    frames.kept("earlier", lambda: 1)
    frames.forget()
    assert "earlier" in frames._kept  # asked for
    assert test(pa.array([b"0123456789abcdef", b"fedcba9876543210"], pa.binary()))[0].as_py() and "earlier" not in frames._kept


def test_packing(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["the", "worthless", "ééü", "x\n\ny", "  ", "123"]) for _ in range(rnd.choice([0, 1, 5, 60, 300, 900])))) for i in range(120)] + [(None, None), (5, None)]
    rows.append((900, "a <|endoftext|> b"))
    cut = packing.pieces(table(spark, rows), "byte_bpe_50k.json", limit=64)
    got = packing.pack(cut, limit=64).toPandas()
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], np.uint32)
        at, n = 0, len(ids) % 64 or 64
        for piece in range(-(-len(ids) // 64)):
            want.append((str(i), piece, at, n, zlib.crc32(ids[at : at + n].tobytes())))
            at, n = at + n, 64
    ids = ["None" if x != x else str(int(x)) for x in got.doc_id]
    assert sorted(zip(ids, got.piece, got.start, got.length, got.ids_crc32)) == sorted(want)
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s.offset) == list(np.cumsum([0, *s.length])[:-1]) and s.length.sum() <= 64
    assert got.sequence_id.nunique() <= 1.05 * -(-got.length.sum() // 64) + 1


@given(st.lists(st.integers(0, 9), min_size=33, max_size=33))
@settings(max_examples=30, deadline=None)
def test_plans_use_every_piece_once(counts):
    counts[0] = 0
    left = np.array(counts)
    for lengths, n in packing.plan(np.array(counts)):
        assert n > 0 and sum(lengths) <= 32
        for v in lengths:
            left[v] -= n
    assert not left.any()


@given(st.text(alphabet="0123456789..  --++@@ab.()é\n\x1f", max_size=60))
@settings(max_examples=600, deadline=None)
def test_base_spans_are_those_of_the_patterns(text):
    got = anchors.Finder()(text)
    number = lambda m: re.sub("[^0-9]", "", m[0])
    assert got["email"] == [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert got["ip"] == [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    assert got["card"] == [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(number(m)) <= 19 and anchors.luhn(number(m))]
    assert got["phone"] == [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(number(m)) <= 15]


def test_added_spans():
    text = 'see https://a.example/x?y=1. Account no: AB-12345, IBAN GB82 WEST 1234 5698 7654 32 by @some_one, é 4111 1111 1111 1111'
    got = {k: [text[a:b] for a, b in v] for k, v in anchors.Finder()(text).items()}
    assert got["url"] == ["https://a.example/x?y=1"] and got["account"][0] == "AB-12345" and got["iban"] == ["GB82 WEST 1234 5698 7654 32"]
    assert got["handle"] == ["@some_one"] and got["card"] == ["4111 1111 1111 1111"]


def test_long_secrets_are_whole():
    for secret in ("0f" * 64, "a" * 64 + "1", "Ab-_" * 500 + "9"):
        text = f"my token: {secret}. secret={secret}"
        assert [text[a:b] for a, b in anchors.Finder()(text)["account"]] == [secret, secret]


def _licences(text):
    scanner = licences.Scanner()
    data = np.frombuffer(text.encode(), np.uint8)
    grams = licences._bigrams(words.Words(data, np.array([0, len(data)]), words.NON_ALNUM).hash)
    hits = scanner.hits(grams)
    return [(scanner.names[k], round(score, 2), first, last + 1) for k, score, first, last in scanner.passages(hits, grams[hits])]


def test_plain_notice_and_whole_licences_are_found():
    assert _licences("Some text here. All rights reserved.") == [("all-rights-reserved", 1.0, 3, 6)]
    for name, text in licence_full.FULL:
        w = re.findall("[A-Za-z0-9]+", text)
        assert _licences("Before it " + text + " after it") == [(name, 1.0, 2, 2 + len(w))]
    # Some words changed: the licence that is nearest, over nearly all of its text.
    terms = {name: text for name, text in reversed(licence_full.FULL)}
    for name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "EPL-1.0"):
        w = re.findall("[A-Za-z0-9]+", terms[name])
        w[::150] = ["changed"] * len(w[::150])
        got = max(_licences(" ".join(w)), key=lambda x: x[3] - x[2])
        assert got[0] == name and got[3] - got[2] > 0.95 * len(w), (name, got)


def test_licence_passages():
    rnd = random.Random(4)
    templates = (("A", "a b c d e"), ("B", "b c d x y z a b"), ("C", "c c c d"))
    scanner = licences.Scanner(templates, 0.7)
    for _ in range(300):
        text = " ".join(rnd.choice("abcdxyzq") for _ in range(rnd.randint(0, 25)))
        w = text.split()
        found = []
        for k, (_, t) in enumerate(templates):
            own = list(zip(t.split(), t.split()[1:]))
            for i in range(len(w) - 1):
                best = (0.0, 0)
                for j in range(i + 1, len(w)):
                    grams = list(zip(w[i : j + 1], w[i + 1 : j + 1]))
                    shared = sum(min(grams.count(g), own.count(g)) for g in set(grams))
                    score = 2 * shared / (len(grams) + len(own))
                    if grams[0] in own and grams[-1] in own and score > best[0]:
                        best = (score, j)
                if best[0] >= 0.7:
                    found.append((k, best[0], i, best[1]))
        found.sort(key=lambda f: (-f[1], f[2] - f[3], f[2], f[0]))
        want = []
        for f in found:
            if all(f[3] <= o[2] or f[2] >= o[3] for o in want):
                want.append(f)
        data = np.frombuffer(text.encode(), np.uint8)
        grams = licences._bigrams(words.Words(data, np.array([0, len(data)]), words.NON_ALNUM).hash) if len(w) > 1 else np.zeros(0, np.uint64)
        hits = scanner.hits(grams)
        assert scanner.passages(hits.tolist(), grams[hits].tolist()) == sorted(want, key=lambda f: f[2]), text


def test_bloom_filter_misses_nothing(spark):
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(300)]
    bloom = sketch._bloom(spark.createDataFrame([(bytearray(k),) for k in keys[:100]], "rid binary").repartition(3), 1 << 10)  # so small that it passes others too
    at = sketch._places(pa.array(keys, pa.binary()), 1 << 10)
    hit = ((bloom[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32)) & 1).all(1)
    assert hit[:100].all() and hit[100:].sum() < 100


def test_rows_without_gone_keys_stay_in_place(spark):
    rows = [(i, f"text {i}") for i in range(300)] + [(1000, "twice"), (1000, "twice"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("rid"))
    gone, repeated = keys.filter("doc_id % 10 = 3").select("rid"), keys.filter("doc_id = 1000").select("rid").distinct()
    left = corpus_pipeline._without(docs, gone, repeated)
    assert sorted((r.doc_id or -1, r.text or "") for r in left.collect()) == sorted({(d or -1, t or "") for d, t in rows if d is None or d % 10 != 3})
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "ArrowEvalPython" in plan.split("Join Left")[0]
