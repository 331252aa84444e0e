"""Structured Streaming twins of the reliability jobs.

Windowed counts use watermarks and append mode. The time-to-live dedupe and the breaker keep waiting rows in the state store, cut
into slots of time, until the watermark has passed them; the one holds a chunk of them at once, the other a piece of bounded
size that it folds in time order. Neither depends on how the input was split into batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sitecorpus.operators.ops import breaker_step, with_category
from sitecorpus.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_to_table(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything available into a parquet table in the shared folder and return that table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    q = (
        df.writeStream.format("parquet").outputMode(mode).option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/data")


def error_windows(calls: DataFrame, delay: str = "10 minutes", size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Failures per category and (tumbling or sliding) window."""
    e = with_category(calls).filter("status = 'error'").withWatermark("ts", delay)
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    g = e.groupBy(w.alias("w"), "category").agg(F.count("*").alias("errors"))
    return g.select(F.unix_seconds("w.start").alias("window_start"), F.unix_seconds("w.end").alias("window_end"), "category", "errors")


def error_sessions(calls: DataFrame, delay: str = "10 minutes", gap: str = "2 hours") -> DataFrame:
    """Failures per service grouped into sessions of activity."""
    e = calls.filter("status = 'error'").withWatermark("ts", delay)
    g = e.groupBy(F.session_window("ts", gap).alias("w"), "service").agg(F.count("*").alias("errors"))
    return g.select("service", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "errors")


def updates_to_table(df: DataFrame, name: str, keys: list[str], version) -> DataFrame:
    """Run an update-mode stream; each batch writes only the changed keys, and the highest version of a key is current.

    A batch that is replayed after a failure overwrites its own folder, so the table stays exact.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    spark.createDataFrame([], df.schema).write.parquet(f"{path}/data/batch=none")  # a stream without rows runs no batch

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")

    q = (
        df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    rows = spark.read.schema(df.schema).parquet(f"{path}/data/batch=*")
    values = [c for c in df.columns if c not in keys]
    g = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), version).alias("l"))
    return g.select(*keys, *[F.col(f"l.{v}") for v in values])


def latest_phases(runs: DataFrame) -> DataFrame:
    """Latest record per run and phase, kept as streaming state (last event time wins)."""
    g = runs.groupBy("run_id", "phase").agg(F.max(F.struct("started_at", "event_id", "status", "duration_ms")).alias("l"))
    return g.select("run_id", "phase", F.unix_micros("l.started_at").alias("started_us"), "l.event_id", "l.status", "l.duration_ms")


class Slotted(StatefulProcessor):
    """Rows of the many keys of a bucket, which wait in the state store in chunks per slot of time until the watermark has
    passed them. Keys share the cost of a group of state; rows need no list per key."""

    COLUMNS: list[str]  # of a waiting row, without its time
    CHUNK = 10_000
    GATHERED = 100_000  # rows of a bucket cut into slots at once, so that a chunk is no sliver of a batch

    def __init__(self, slot_us: int):
        self.slot_us = slot_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "slot bigint, n bigint", "data binary")

    @staticmethod
    def _packed(frame: pd.DataFrame) -> bytes:
        table = pa.Table.from_pandas(frame, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def _frame(data: bytes) -> pd.DataFrame:
        return pa.ipc.open_stream(data).read_all().to_pandas()

    def _gathered(self, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames, many = [], 0
        for frame in rows:
            frames.append(frame[[*self.COLUMNS, "ts_us"]])
            many += len(frame)
            if many >= self.GATHERED:
                yield pd.concat(frames, ignore_index=True)
                frames, many = [], 0
        if many:
            yield pd.concat(frames, ignore_index=True)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        oldest, n = None, 1 + max((k[1] for k in self.rows.keys()), default=-1)
        for frame in self._gathered(rows):
            for slot, part in frame.groupby(frame["ts_us"] // self.slot_us):
                for at in range(0, len(part), self.CHUNK):
                    self.rows.updateValue((int(slot), n), (self._packed(part.iloc[at : at + self.CHUNK]),))
                    n += 1
            low = int(frame["ts_us"].min())
            oldest = low if oldest is None else min(oldest, low)
        self._wake_at(oldest)
        return iter([])

    def _wake_at(self, ts_us: int | None) -> None:
        """A timer fires once the watermark is past it, so this one as soon as a row of that time can be decided."""
        if ts_us is not None:
            self.handle.registerTimer(-(-ts_us // 1000) - 1)

    def _waiting(self) -> dict[int, list[int]]:
        """The numbers of the chunks in each slot."""
        slots: dict[int, list[int]] = {}
        for slot, n in self.rows.keys():
            slots.setdefault(slot, []).append(n)
        return {slot: sorted(slots[slot]) for slot in sorted(slots)}

    def _chunk(self, slot: int, n: int) -> pd.DataFrame:
        return self._frame(self.rows.getValue((slot, n))[0])

    def close(self) -> None:
        pass


class Breaker(Slotted):
    """The breakers of the services of a bucket, each fed its calls in (time, id) order.

    Slots come in the order of time. One of at most MOST calls is sorted and folded at once; a larger one is dealt out to pieces
    of that size first, cut at times of its calls, so that memory holds a piece, the calls' times and the services' states.
    """

    COLUMNS = ["service", "event_id", "failed"]
    SLOT_US = 86_400_000_000
    MOST = 200_000

    def __init__(self, threshold: int, reset_ms: int, successes: int):
        super().__init__(self.SLOT_US)
        self.threshold, self.reset_us, self.successes = threshold, reset_ms * 1000, successes

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.states = handle.getValueState("states", "data binary")
        self.pieces = handle.getMapState("pieces", "piece bigint, n bigint", "data binary")

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        due_us = timerValues.getCurrentWatermarkInMs() * 1000
        known = self._frame(self.states.get()[0]) if self.states.exists() else pd.DataFrame(columns=["service", "mode", "fails", "opened", "good"])
        names = known["service"].astype(object).where(known["service"].notna(), None)
        states = dict(zip(names, zip(*(known[c].tolist() for c in known.columns[1:]), strict=True), strict=True))
        pending = None
        for slot, chunks in self._waiting().items():
            low = slot * self.slot_us
            if low <= due_us:
                for calls in self._pieces(slot, chunks, due_us):
                    yield self._fold(calls, states)
                low = self._settled(slot, chunks, due_us)
            if low is not None:
                pending = low if pending is None else min(pending, low)
        self.states.update((self._packed(pd.DataFrame([(s, *v) for s, v in states.items()], columns=known.columns)),))
        self._wake_at(pending)

    def _due(self, slot: int, n: int, due_us: int) -> pd.DataFrame:
        c = self._chunk(slot, n)
        return c[c["ts_us"] <= due_us]

    def _pieces(self, slot: int, chunks: list[int], due_us: int) -> Iterator[pd.DataFrame]:
        """The calls of a slot up to `due_us`, in pieces that follow each other in time."""
        held, times, many = [], [], 0
        for n in chunks:
            c = self._due(slot, n, due_us)
            times.append(c["ts_us"].to_numpy())
            many += len(c)
            held = [*held, c] if many <= self.MOST else []
        if many <= self.MOST:
            if many:
                yield pd.concat(held)
            return
        edges = np.unique(np.sort(np.concatenate(times))[self.MOST :: self.MOST])
        parts: dict[int, list[int]] = {}
        for n in chunks:
            c = self._due(slot, n, due_us)
            for piece, part in c.groupby(np.searchsorted(edges, c["ts_us"].to_numpy(), "right")):
                self.pieces.updateValue((int(piece), n), (self._packed(part),))
                parts.setdefault(int(piece), []).append(n)
        for piece in sorted(parts):
            yield pd.concat([self._frame(self.pieces.getValue((piece, n))[0]) for n in parts[piece]])
            for n in parts[piece]:
                self.pieces.removeKey((piece, n))

    def _fold(self, calls: pd.DataFrame, states: dict) -> pd.DataFrame:
        calls = calls.sort_values(["ts_us", "event_id"], kind="stable", ignore_index=True)
        names = calls["service"].astype(object).where(calls["service"].notna(), None)
        decisions, modes = [], []
        for service, ts_us, failed in zip(names.tolist(), calls["ts_us"].tolist(), calls["failed"].tolist(), strict=True):
            states[service], decision = breaker_step(states.get(service), ts_us, failed, self.threshold, self.reset_us, self.successes)
            decisions.append(decision)
            modes.append(states[service][0])
        return pd.DataFrame({"service": names, "event_id": calls["event_id"], "decision": decisions, "state": modes})

    def _settled(self, slot: int, chunks: list[int], due_us: int) -> int | None:
        """Removes a slot's calls up to `due_us`; returns the earliest time among those that wait on."""
        rest = None
        for n in chunks:
            waiting = None
            if (slot + 1) * self.slot_us > due_us + 1:
                c = self._chunk(slot, n)
                waiting = c[c["ts_us"] > due_us]
            if waiting is None or waiting.empty:
                self.rows.removeKey((slot, n))
            else:
                self.rows.updateValue((slot, n), (self._packed(waiting),))
                low = int(waiting["ts_us"].min())
                rest = low if rest is None else min(rest, low)
        return rest


class SlottedDedupe(Slotted):
    """Repeats of a call within a time to live after the last accepted one, for the many call keys of a bucket.

    Time is cut into slots as long as the time to live. A slot then accepts at most one call per key: the earliest that lies
    far enough behind the one accepted in the slot before. So calls need no sorting and no list per key. They wait in the
    state store in chunks per slot; when the watermark has passed them, one sweep over a slot's chunks finds each key's
    earliest call, a second writes them out. Memory holds one chunk and one entry per key of a slot, whatever a key's calls;
    what is kept of a slot after the next one is nothing.
    """

    KEYS = ["service", "ability", "k"]
    COLUMNS = [*KEYS, "event_id"]

    def __init__(self, ttl_seconds: int):
        super().__init__(ttl_seconds * 1000000)
        self.ttl_us = self.slot_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.accepted = handle.getMapState("accepted", "slot bigint", "data binary")

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        due_us = timerValues.getCurrentWatermarkInMs() * 1000
        pending, held = None, {s for (s,) in self.accepted.keys()}
        for slot, chunks in self._waiting().items():
            if slot * self.ttl_us > due_us:
                low = slot * self.ttl_us
                pending = low if pending is None else min(pending, low)
                continue
            for old in [s for s in held if s < slot - 1]:  # nothing accepted there reaches a call that is still to come
                self.accepted.removeKey((old,))
                held.remove(old)
            held.add(slot)
            rest = yield from self._slot(slot, chunks, due_us)
            if rest is not None:
                pending = rest if pending is None else min(pending, rest)
        for slot in held:
            if (slot + 2) * self.ttl_us <= due_us:
                self.accepted.removeKey((slot,))
        self._wake_at(pending if pending is None else max(pending, due_us + 1))

    def _slot(self, slot: int, chunks: list[int], due_us: int):
        """Decides a slot's calls up to `due_us`; returns the earliest time among those that wait on."""
        before = [self._frame(self.accepted.getValue((s,))[0]) for s in (slot - 1, slot) if self.accepted.containsKey((s,))]
        last = pd.concat(before).groupby(self.KEYS, dropna=False, as_index=False)["ts_us"].max().rename(columns={"ts_us": "last"}) if before else None
        best = None
        only = self._chunk(slot, chunks[0]) if len(chunks) == 1 else None  # then read it once
        for n in chunks:
            c, _ = self._due(only if only is not None else self._chunk(slot, n), due_us)
            if last is not None:
                c = c.merge(last, on=self.KEYS, how="left")
                c = c[c["last"].isna() | (c["ts_us"] >= c["last"] + self.ttl_us)].drop(columns="last")
            c = c.assign(chunk=n).sort_values(["ts_us", "event_id"], kind="stable").drop_duplicates(self.KEYS)
            best = c if best is None else pd.concat([best, c]).sort_values(["ts_us", "event_id", "chunk"], kind="stable").drop_duplicates(self.KEYS)
        rest = None
        for n in chunks:
            c, waiting = self._due(only if only is not None else self._chunk(slot, n), due_us)
            out = c[[*self.KEYS, "event_id"]].copy()
            out["duplicate"] = True
            out.loc[best.loc[best["chunk"] == n, "place"], "duplicate"] = False
            if len(waiting):
                self.rows.updateValue((slot, n), (self._packed(waiting),))
                low = int(waiting["ts_us"].min())
                rest = low if rest is None else min(rest, low)
            else:
                self.rows.removeKey((slot, n))
            if len(out):
                yield out
        made = best[[*self.KEYS, "ts_us"]]
        if self.accepted.containsKey((slot,)):
            made = pd.concat([self._frame(self.accepted.getValue((slot,))[0]), made])
        self.accepted.updateValue((slot,), (self._packed(made),))
        return rest

    @staticmethod
    def _due(c: pd.DataFrame, due_us: int) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The rows of a chunk that can be decided, with their place among them, and those that wait on."""
        now = c["ts_us"] <= due_us
        due = c[now].reset_index(drop=True)
        return due.assign(place=due.index), c[~now]


def _bucketed(calls: DataFrame, keys: list, buckets: int, columns: list, processor: Slotted, schema: str, delay: str) -> DataFrame:
    """A stream through `processor`, with the keys dealt out to `buckets` groups of state. A call without a time is never due."""
    calls.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")
    rows = calls.filter(F.col("ts").isNotNull()).withWatermark("ts", delay).select(bucket, *columns, "ts", F.unix_micros("ts").alias("ts_us"), "event_id")
    return rows.groupBy("bucket").transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def breaker(calls: DataFrame, threshold: int, reset_ms: int, successes: int = 2, delay: str = "10 minutes", buckets: int = 128) -> DataFrame:
    """Breaker decisions as the log streams in; the batch twin is `breaker_replay`. Services share `buckets` groups of state; the
    number must stay the same when a stream goes on from its checkpoint."""
    failed = F.coalesce(F.col("status") == "error", F.lit(False)).alias("failed")
    return _bucketed(calls, ["service"], buckets, ["service", failed], Breaker(threshold, reset_ms, successes),
                     "service string, event_id bigint, decision string, state string", delay)


def dedupe(calls: DataFrame, ttl_seconds: int, delay: str = "10 minutes", buckets: int = 16) -> DataFrame:
    """Repeats within a time to live; the batch twin is `ttl_dedupe`. Call keys share `buckets` groups of state, so that the
    cost of a group is not paid for each key; the number must stay the same when a stream goes on from its checkpoint."""
    schema = "service string, ability string, k int, event_id bigint, duplicate boolean"
    keys = ["service", "ability", F.col("k").cast("int").alias("k")]
    return _bucketed(calls, ["service", "ability", "k"], buckets, keys, SlottedDedupe(ttl_seconds), schema, delay)


def dedupe_within_watermark(calls: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The built-in approximation: one call per (service, ability, payload) within the watermark delay."""
    key = F.md5(F.concat_ws("|", "service", "ability", F.col("k").cast("string")))
    return calls.withColumn("call_key", key).withWatermark("ts", delay).dropDuplicatesWithinWatermark(["call_key"])


def lessons(notes: DataFrame) -> DataFrame:
    """Confidence and repeat count per lesson as streaming state; repeats are counted before the shuffle."""
    g = notes.groupBy(F.md5("content").alias("id")).agg(F.count("*").alias("n"))
    conf = F.least(F.lit(95), F.lit(50) + F.lit(5) * (F.col("n") - 1)) / 100
    return g.select("id", (F.col("n") - 1).alias("reinforced_count"), conf.alias("confidence"))


def quality_gate(spark: SparkSession, docs: DataFrame, score, name: str = "gate") -> DataFrame:
    """Score documents as they arrive: `score(batch)` gives (page_id, score, status); the newest batch wins per page.

    Every batch writes its own folder, so a replayed batch replaces itself.
    """
    path = scratch_path(spark, name)

    def judge(batch: DataFrame, batch_id: int) -> None:
        score(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")

    q = docs.writeStream.foreachBatch(judge).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.parquet(f"{path}/data")
    return rows.groupBy("page_id").agg(F.max(F.struct("batch_id", "score", "status")).alias("l")).select("page_id", "l.score", "l.status")
