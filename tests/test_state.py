"""Ordered replays, graphs and streams against plain Python on random data, hot keys included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sitecorpus.operators import graph, ops
from sitecorpus.session import scratch_path
from sitecorpus.streaming import jobs

SCHEMA = "event_id bigint, ts timestamp, service string, ability string, k int, status string"


def log(spark, n, seed, hot=0.4, step=400, fail=0.4):
    rnd = random.Random(seed)
    t, rows = dt.datetime(2024, 1, 1), []
    for i in range(n):
        t += dt.timedelta(seconds=rnd.randint(0, step))
        svc = "hot" if rnd.random() < hot else f"s{rnd.randint(0, 5)}"
        rows.append((i, t, svc, f"a{rnd.randint(0, 1)}", rnd.randint(0, 2), "error" if rnd.random() < fail else "ok"))
    return rows, spark.createDataFrame(rows, SCHEMA)


def us(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def breaker_by_hand(rows, threshold, reset_ms):
    state, out = {}, {}
    for i, t, svc, _, _, status in sorted(rows, key=lambda r: (r[1], r[0])):
        state[svc], decision = ops.breaker_step(state.get(svc), us(t), status == "error", threshold, reset_ms * 1000, 2)
        out[i] = (decision, state[svc][0])
    return out


@pytest.mark.parametrize("seed,fail", [(1, 0.2), (2, 0.5), (3, 0.9)])
def test_breaker_segments(spark, monkeypatch, seed, fail):
    rows, df = log(spark, 1500, seed, fail=fail, step=20000)
    got = {r.event_id: (r.decision, r.state) for r in ops.breaker_replay(df, 3, 60000).collect()}
    assert got == breaker_by_hand(rows, 3, 60000)


def test_breaker_defaults():
    state, seen = None, []
    for i in range(5):
        state, d = ops.breaker_step(state, i, True, 5, 30_000_000, 2)
    assert state[0] == "OPEN"
    for at, failed in ((10, False), (30_000_004, False), (30_000_005, False)):
        state, d = ops.breaker_step(state, at, failed, 5, 30_000_000, 2)
        seen.append((d, state[0]))
    assert seen == [("rejected", "OPEN"), ("ok", "HALF_OPEN"), ("ok", "CLOSED")]


@pytest.mark.parametrize("ttl", [1, 600, 5000])
def test_ttl_dedupe(spark, ttl):
    rows, df = log(spark, 1200, 7)
    last, want = {}, {}
    for i, t, svc, a, k, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        key = (svc, a, k)
        dup = key in last and us(t) < last[key] + ttl * 1_000_000
        want[i] = dup
        if not dup:
            last[key] = us(t)
    assert {r.event_id: r.duplicate for r in ops.ttl_dedupe(df, ttl).collect()} == want


def test_segments_split_a_hot_service(spark):
    _, df = log(spark, 3000, 5, hot=1.0, fail=0.1, step=4000)
    seg = ops.segments(df.select("service", "ts", "event_id"), ["service"],
                       lambda d, w: d.withColumn("sync", F.coalesce(F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(w)) >= 1000000, F.lit(False))), 86400)
    assert seg.select("service", "segment").distinct().count() > 10


@pytest.mark.parametrize("parts", [1, 3])
def test_streams_do_not_depend_on_the_split(spark, parts):
    rows, df = log(spark, 400, 11, fail=0.5)
    path = scratch_path(spark, "log")
    for p in range(parts):
        part = df.filter((F.col("event_id") >= p * 400 // parts) & (F.col("event_id") < (p + 1) * 400 // parts))
        part.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = {r.event_id: (r.decision, r.state) for r in jobs.run_to_table(jobs.breaker(stream, 3, 60000), "b").collect()}
    want = breaker_by_hand(rows, 3, 60000)
    assert len(got) > 350 and all(want[i] == v for i, v in got.items())


def random_edges(n, m, seed):
    rnd = random.Random(seed)
    return [("g", f"n{rnd.randint(0, n)}", f"n{rnd.randint(0, n)}") for _ in range(m)] + [("h", "hub", f"x{i}") for i in range(40)]


def test_components_equal_union_find(spark):
    edges = random_edges(80, 60, 3)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for g, a, b in edges:
        ra, rb = find((g, a)), find((g, b))
        if a != b:
            root[max(ra, rb)] = min(ra, rb)
    want = {(g, n): find((g, n))[1] for g, a, b in edges if a != b for n in (a, b)}
    got = {(r.graph_id, r.node): r.component for r in graph.connected_components(spark.createDataFrame(edges, "graph_id string, src string, dst string")).collect()}
    assert got == want


def test_layers_and_cycles(spark):
    e = [("g", "a", "b"), ("g", "b", "c"), ("g", "a", "c"), ("g", "x", "y"), ("g", "y", "x"), ("g", "z", "x")]
    got = {r.node: r.layer for r in graph.build_order_layers(spark.createDataFrame(e, "graph_id string, src string, dst string")).collect()}
    assert got == {"c": 1, "b": 2, "a": 3, "x": None, "y": None, "z": None}


def test_nearest_ancestor_on_a_long_chain(spark):
    rows = [(1, i, i - 1 if i else None, i % 13 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id bigint, node int, parent int, keep boolean")
    got = {r.node: r.ancestor for r in graph.nearest_ancestor(df).collect()}
    assert all(got[i] == (None if i == 0 else ((i - 1) // 13) * 13) for i in range(60))


def test_component_expand_overrides_root_attributes(spark):
    inst = spark.createDataFrame([(1, 7, "card", {"a": "new"}), (1, 9, "none", {})], "page_id bigint, node int, component_id string, attrs map<string,string>")
    defs = spark.createDataFrame([("card", 0, 0, "div", {"a": "old", "b": "1"}), ("card", 1, 1, "p", {})], "component_id string, def_pos int, depth int, tag string, attrs map<string,string>")
    got = {r.new_id: (r.tag, r.attrs, r.expanded) for r in graph.component_expand(inst, defs).collect()}
    assert got == {"7-0": ("div", {"a": "new", "b": "1"}, True), "7-1": ("p", {}, True), "9-0": (None, None, False)} or got["7-0"][1] == {"a": "new", "b": "1"}


def test_lessons(spark):
    d = [("x", dt.date(2024, 1, 1)), ("x", dt.date(2024, 3, 1)), ("y", dt.date(2024, 12, 1))]
    up = ops.lesson_upsert(spark.createDataFrame(d, "content string, created_at date"))
    kept = {r.reinforced_count: (r.confidence, r.decayed) for r in ops.lesson_decay(up, "2025-01-01").collect()}
    assert kept == {1: (0.45, True), 0: (0.5, False)}


@pytest.mark.parametrize("seed", [1, 2])
def test_streaks_do_not_depend_on_the_buckets(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice("ab"), rnd.randint(0, 400), rnd.choice(["error", "error", "success"])) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id bigint, service string, s bigint, status string").selectExpr("event_id", "service", "timestamp_seconds(s) AS ts", "status")
    want = []
    for svc in "ab":
        run = []
        for _, _, t, status in sorted((r for r in rows if r[1] == svc), key=lambda r: (r[2], r[0])):
            if status == "error":
                run.append(t)
                continue
            if len(run) >= 3:
                want.append((svc, run[0], run[-1], len(run), t))
            run = []
        if len(run) >= 3:
            want.append((svc, run[0], run[-1], len(run), None))
    for bucket in (1, 7, 60, 10_000):
        got = ops.failure_streaks(df, bucket_seconds=bucket).collect()
        cut = lambda us: None if us is None else us // 1_000_000
        assert sorted(((r.service, cut(r.started_us), cut(r.ended_us), r.failures, cut(r.recovered_us)) for r in got), key=str) == sorted(want, key=str)


def dedupe_by_hand(rows, ttl):
    last, want = {}, {}
    for i, t, svc, a, k, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        key = (svc, a, k)
        want[i] = key in last and us(t) < last[key] + ttl * 1_000_000
        if not want[i]:
            last[key] = us(t)
    return want


@pytest.mark.parametrize("parts, ttl, chunk", [(1, 600, 10_000), (4, 2, 7), (4, 5000, 7)])
def test_stream_dedupe_does_not_depend_on_the_split(spark, monkeypatch, parts, ttl, chunk):
    monkeypatch.setattr(jobs.SlottedDedupe, "CHUNK", chunk)
    rows, df = log(spark, 900, 13)
    path = scratch_path(spark, "log")
    for p in range(parts):  # each part holds every fifth call of its neighbour, within the delay
        part = df.filter((F.col("event_id") >= p * 900 // parts) & (F.col("event_id") < (p + 1) * 900 // parts))
        part.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = [(r.event_id, r.duplicate) for r in jobs.run_to_table(jobs.dedupe(stream, ttl, buckets=3), "d").collect()]
    want = dedupe_by_hand(rows, ttl)
    assert len(got) == len(dict(got)) > 850 and all(want[i] == d for i, d in got)


class Held:
    """Map state in memory, for one processor on its own."""

    def __init__(self):
        self.data = {}

    def getMapState(self, name, key_schema, value_schema):
        return Held() if name else self

    def registerTimer(self, ms):
        self.timer = ms

    def keys(self):
        return iter(list(self.data))

    def updateValue(self, key, value):
        self.data[key] = value

    def getValue(self, key):
        return self.data[key]

    def containsKey(self, key):
        return key in self.data

    def removeKey(self, key):
        del self.data[key]


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _hot_key_peak(n, ttl):
    """(largest memory that judging takes, results) of one key with `n` calls a millisecond apart."""
    import tracemalloc

    import pandas as pd

    p = jobs.SlottedDedupe(ttl)
    p.init(Held())
    for at in range(0, n, 10_000):
        ids = list(range(at, min(n, at + 10_000)))
        list(p.handleInputRows((0,), iter([pd.DataFrame({"service": "s", "ability": "a", "k": 1, "ts_us": [i * 1000 for i in ids], "event_id": ids})]), None))
    tracemalloc.start()
    accepted, rows = [], 0
    for out in p.handleExpiredTimer((0,), Clock(n), None):
        rows += len(out)
        accepted += out.loc[~out["duplicate"], "event_id"].tolist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak, rows, accepted, p


@pytest.mark.parametrize("ttl", [1, 1000])
def test_a_hot_key_takes_constant_memory(ttl):
    small, _, _, _ = _hot_key_peak(30_000, ttl)
    large, rows, accepted, p = _hot_key_peak(200_000, ttl)
    assert rows == 200_000 and accepted == list(range(0, 200_000, ttl * 1000))
    assert large < 1.5 * small and not p.rows.data and len(p.accepted.data) <= 2


class Handle(Held):
    """The same with a single value as well."""

    value = None

    def getValueState(self, name, schema):
        return Handle()

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def _breaker_frame(rows):
    import pandas as pd

    return pd.DataFrame([(s, i, status == "error", us(t)) for i, t, s, _, _, status in rows], columns=["service", "event_id", "failed", "ts_us"])


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
@pytest.mark.parametrize("most", [300, 200_000])
def test_breakers_that_share_a_group_of_state(spark, hot, most):
    rows, _ = log(spark, 6000, 21, hot=hot, step=60, fail=0.5)
    p = jobs.Breaker(3, 60000, 2)
    p.MOST, p.GATHERED = most, 1000
    p.init(Handle())
    ends, got, largest = [us(rows[i][1]) // 1000 for i in (2000, 4500)] + [us(rows[-1][1]) // 1000 + 1], {}, 0
    for at, end in zip((0, 2500, 5000), ends, strict=True):
        part = rows[at : at + 2500 if at < 5000 else len(rows)]
        random.Random(at).shuffle(part)
        list(p.handleInputRows((0,), iter([_breaker_frame(part[:900]), _breaker_frame(part[900:])]), None))
        assert p.handle.timer < end
        for out in p.handleExpiredTimer((0,), Clock(end), None):
            largest = max(largest, len(out))
            got |= {i: (d, s) for i, d, s in zip(out["event_id"].tolist(), out["decision"], out["state"], strict=True)}
    assert got == breaker_by_hand(rows, 3, 60000)
    assert largest <= most + 50 and not p.rows.data and not p.pieces.data  # a few calls have the same time


def test_a_lone_call_is_decided_when_the_watermark_is_at_it(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, "a", "x", 1, "error"), (2, t + dt.timedelta(minutes=10), "b", "x", 1, "ok"), (3, None, "c", "x", 1, "ok")]
    path = scratch_path(spark, "edge")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(SCHEMA).parquet(path)
    assert [tuple(r) for r in jobs.run_to_table(jobs.breaker(stream, 3, 60000), "edge").collect()] == [("a", 1, "failed", "CLOSED")]


def test_temporary_tables_go(spark):
    import os

    from sitecorpus.session import stage, temporary

    with temporary(spark):
        gone = stage(spark.range(5), "gone")
        kept = stage(gone.filter("id > 2"), "kept", keep=True)
        paths = [df.inputFiles()[0].removeprefix("file://") for df in (gone, kept)]
        assert all(map(os.path.exists, paths))
    assert [os.path.exists(p) for p in paths] == [False, True] and kept.count() == 2
    assert os.path.exists(stage(spark.range(1), "outside").inputFiles()[0].removeprefix("file://"))


def tarjan(edges):
    """Strongly connected components by depth-first search: node to its set."""
    import sys

    sys.setrecursionlimit(10_000)
    out = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
        out.setdefault(b, [])
    index, low, stack, on, found = {}, {}, [], set(), {}

    def visit(v):
        index[v] = low[v] = len(index)
        stack.append(v)
        on.add(v)
        for w in out[v]:
            if w not in index:
                visit(w)
                low[v] = min(low[v], low[w])
            elif w in on:
                low[v] = min(low[v], index[w])
        if low[v] == index[v]:
            members = set()
            while True:
                w = stack.pop()
                on.discard(w)
                members.add(w)
                if w == v:
                    break
            found.update(dict.fromkeys(members, frozenset(members)))

    for v in out:
        if v not in index:
            visit(v)
    return found


def test_strong_components_are_tarjans(spark):
    rnd = random.Random(4)
    graphs = {f"g{n}-{m}": {(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)} for n, m in ((1, 1), (6, 9), (12, 14), (12, 30), (25, 28), (30, 45))}
    graphs["chain"] = {(i, i + 1) for i in range(9)}
    graphs["ring-and-tail"] = {(0, 1), (1, 2), (2, 0), (3, 2), (4, 3), (2, 5), (5, 6), (6, 5), (7, 7), (8, 7)}
    rows = [(g, f"n{a:02}", f"n{b:02}") for g, es in graphs.items() for a, b in es]
    got = graph.build_order(spark.createDataFrame(rows, "graph_id string, src string, dst string")).collect()
    by = {(r.graph_id, r.node): r for r in got}
    assert len(by) == len(got)
    for g, es in graphs.items():
        edges = {(f"n{a:02}", f"n{b:02}") for a, b in es}
        want = tarjan(edges)
        for node, members in want.items():
            r = by.pop((g, node))
            assert (r.component, r.members, r.cyclic) == (min(members), len(members), len(members) > 1 or (node, node) in edges)
            below = [by_layer for a, b in edges if a in members and b not in members for by_layer in [next(x.layer for x in got if (x.graph_id, x.node) == (g, b))]]
            assert r.layer == 1 + max(below, default=0)
    assert not by
