"""Reliability analytics over call logs, phase runs and lessons (batch).

Windows run over pre-aggregated rows (hours, days, abilities) so that a service holding a third of the log
costs one row per hour, not one task over all its calls. Ordered replays (breaker, time-to-live dedupe) are cut
into segments at points where the state is known whatever came before; segments of one hot service replay in
different tasks, and rows stream through with constant memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from sitecorpus.functions.columns import js_round
from sitecorpus.functions.dims import METHOD_MISSING_PATTERN, RETRYABLE_WORDS
from sitecorpus.sources.events import PHASES


def with_category(calls: DataFrame) -> DataFrame:
    """Failures classed as method-missing, retryable or fatal."""
    low = F.lower("message")
    words = F.lit(False)
    for w in RETRYABLE_WORDS:
        words = words | F.contains(low, F.lit(w))
    timeout = F.contains(low, F.lit("timeout")) & low.rlike("ms|seconds")
    retry = words | timeout | F.col("http_status").between(500, 599) | (F.col("http_status") == 429)
    return calls.withColumn(
        "category",
        F.when(F.col("status") != "error", F.lit(None)).when(F.col("message").rlike(METHOD_MISSING_PATTERN), "method-missing")
        .when(retry, "retryable").otherwise("fatal"),
    )


def error_summary(calls: DataFrame) -> DataFrame:
    e = with_category(calls).filter("status = 'error'")
    return e.groupBy("category").agg(
        F.count("*").alias("errors"), F.approx_count_distinct("service").alias("services_approx"),
        F.unix_micros(F.min("ts")).alias("first_us"), F.unix_micros(F.max("ts")).alias("last_us"),
    )


def recent_errors(calls: DataFrame, n: int = 10) -> DataFrame:
    """The last n failures (a top-n report)."""
    e = with_category(calls).filter("status = 'error'").orderBy(F.desc("ts"), F.desc("event_id")).limit(n)
    return e.select("event_id", F.unix_micros("ts").alias("ts_us"), "service", "ability", "category", "message")


def errors_last_window(calls: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Failures per service in the trailing hours before `as_of` (default: the newest call in the log)."""
    e = calls.filter("status = 'error'")
    if as_of is None:
        newest = calls.agg(F.max("ts").alias("m"))
        rows = calls.sparkSession.sql(
            f"SELECT service, ts FROM {{e}} WHERE ts > (SELECT m FROM {{n}}) - INTERVAL {int(hours)} HOURS", e=e, n=newest
        )
    else:
        rows = e.filter(F.col("ts") > F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours)))
    return rows.groupBy("service").agg(F.count("*").alias("errors"))


def error_trailing(calls: DataFrame, hours: int = 24) -> DataFrame:
    """Failures per service and hour with the trailing total, from hourly counts."""
    hour = (F.unix_seconds("ts") / 3600).cast("bigint")
    h = calls.filter("status = 'error'").groupBy("service", hour.alias("hour")).agg(F.count("*").alias("errors"))
    w = W.partitionBy("service").orderBy("hour").rangeBetween(-(hours - 1), 0)
    return h.withColumn("trailing_errors", F.sum("errors").over(w))


def perf_trend(calls: DataFrame) -> DataFrame:
    """First against last daily duration per service: over +20 % regression, under -10 % improvement."""
    day = F.date_format("ts", "yyyy-MM-dd")
    d = calls.groupBy("service", day.alias("day")).agg(F.sum("duration_ms").alias("ms"))
    g = d.groupBy("service").agg(F.count("*").alias("runs"), F.min_by("ms", "day").alias("first_ms"), F.max_by("ms", "day").alias("last_ms"))
    change = (F.col("last_ms") - F.col("first_ms")) * 100 / F.nullif(F.col("first_ms"), F.lit(0))
    return g.withColumn("change_pct", js_round(change)).withColumn(
        "trend", F.when(F.col("runs") < 2, "baseline").when(change > 20, "regression").when(change < -10, "improvement").otherwise("stable")
    )


def run_over_run(calls: DataFrame) -> DataFrame:
    """Daily durations per service with the difference to the run before."""
    day = F.date_format("ts", "yyyy-MM-dd")
    d = calls.groupBy("service", day.alias("day")).agg(F.sum("duration_ms").alias("ms"), F.count("*").alias("calls"))
    return d.withColumn("delta_ms", F.col("ms") - F.lag("ms").over(W.partitionBy("service").orderBy("day")))


def bottlenecks(calls: DataFrame, top: int = 3) -> DataFrame:
    """The slowest abilities per service with their share of the service's time."""
    a = calls.groupBy("service", "ability").agg(F.sum("duration_ms").alias("ms"))
    w = W.partitionBy("service")
    r = a.withColumn("total_ms", F.sum("ms").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("ms"), "ability")))
    return r.filter(F.col("rank") <= top).withColumn("pct", js_round(F.col("ms") * 1000 / F.col("total_ms")) / 10)


def latest_phases(runs: DataFrame) -> DataFrame:
    """Latest record per run and phase; one aggregate, no sort."""
    last = F.max(F.struct("started_at", "event_id", "status", "duration_ms"))
    g = runs.groupBy("run_id", "phase", "phase_ord").agg(last.alias("l"), F.count("*").alias("records"))
    return g.select("run_id", "phase", "phase_ord", "records", "l.status", "l.duration_ms", F.unix_micros("l.started_at").alias("started_us"))


def resumable_phase(runs: DataFrame) -> DataFrame:
    """First phase of each run that is neither completed nor skipped (or was never recorded)."""
    done = F.col("status").isin("completed", "skipped")
    flags = [F.coalesce(F.max(F.when(F.col("phase_ord") == i + 1, done)), F.lit(False)).alias(f"d{i}") for i in range(len(PHASES))]
    g = latest_phases(runs).groupBy("run_id").agg(*flags)
    first = F.lit(None).cast("string")
    for i in reversed(range(len(PHASES))):
        first = F.when(~F.col(f"d{i}"), PHASES[i]).otherwise(first)
    return g.select("run_id", first.alias("resume_at"))


def run_status_summary(runs: DataFrame) -> DataFrame:
    """Success, failure and pending counts, elapsed time and failed phases per run."""
    l = latest_phases(runs)

    def n(*states):
        return F.count(F.when(F.col("status").isin(*states), 1))

    failed = [F.max(F.when((F.col("phase") == p) & (F.col("status") == "failed"), F.lit(p))) for p in PHASES]
    return l.groupBy("run_id").agg(
        n("completed", "skipped").alias("succeeded"), n("failed").alias("failed"), n("running").alias("pending"),
        F.sum("duration_ms").alias("elapsed_ms"), F.concat_ws(",", *failed).alias("failed_phases"),
    )


def retry_stats(calls: DataFrame, base_ms: int = 500) -> DataFrame:
    """Attempts and outcome per task (service and payload), expected back-off, success after a failure."""
    failed = F.col("status") == "error"
    g = calls.groupBy("service", "k").agg(
        F.count("*").alias("attempts"), F.count(F.when(failed, 1)).alias("failures"),
        F.min(F.when(failed, F.struct("ts", "event_id"))).alias("first_failure"), F.max(F.when(~failed, F.struct("ts", "event_id"))).alias("last_success"),
    )
    return g.select(
        "service", "k", "attempts", "failures",
        (F.lit(float(base_ms)) * (F.pow(F.lit(2.0), "failures") - 1)).alias("expected_backoff_ms"),
        F.coalesce(F.col("last_success") > F.col("first_failure"), F.lit(False)).alias("recovered"),
    )


def health_snapshot(calls: DataFrame, stale_days: int = 7) -> DataFrame:
    """One row of health: failures in the last day, age of the last good call, calls that need a workaround."""
    c = with_category(calls)
    day = F.col("ts") > F.col("newest") - F.expr("INTERVAL 24 HOURS")
    joined = calls.sparkSession.sql("SELECT *, (SELECT max(ts) FROM {c}) AS newest FROM {c}", c=c)
    g = joined.agg(
        F.count(F.when((F.col("status") == "error") & day, 1)).alias("errors_24h"),
        F.count(F.when(F.col("category") == "method-missing", 1)).alias("workarounds"),
        ((F.unix_seconds(F.max("newest")) - F.unix_seconds(F.max(F.when(F.col("status") == "ok", F.col("ts"))))) / 86400).alias("age"),
    )
    stale = F.col("age") > stale_days
    return g.select("errors_24h", "workarounds", stale.alias("stale_build"),
                    F.when((F.col("errors_24h") > 0) | stale | (F.col("workarounds") > 0), "degraded").otherwise("ok").alias("status"))


# --- lessons ------------------------------------------------------------------------------------------------


def lesson_upsert(notes: DataFrame, start_pct: int = 50, step_pct: int = 5, cap_pct: int = 95) -> DataFrame:
    """Notes (content, created_at) to lessons: equal content reinforces, raising confidence up to a cap."""
    g = notes.groupBy(F.md5("content").alias("id")).agg(
        F.count("*").alias("n"), F.min("created_at").alias("created_at"), F.max("created_at").alias("last_reinforced_at"),
        F.min(F.length("content")).alias("chars"),
    )
    conf = F.least(F.lit(cap_pct), F.lit(start_pct) + F.lit(step_pct) * (F.col("n") - 1)) / 100
    return g.select("id", "chars", "created_at", "last_reinforced_at", conf.alias("confidence"), (F.col("n") - 1).alias("reinforced_count"))


def lesson_decay(lessons: DataFrame, as_of: str, days: int = 180, loss: float = 0.1) -> DataFrame:
    """Lessons untouched for long lose confidence; at zero they go."""
    old = F.datediff(F.lit(as_of).cast("date"), F.col("last_reinforced_at").cast("date")) > days
    conf = F.round(F.when(old, F.greatest(F.lit(0.0), F.col("confidence") - loss)).otherwise(F.col("confidence")), 2)
    return lessons.withColumn("decayed", old).withColumn("confidence", conf).filter("confidence > 0")


def lesson_stats(lessons: DataFrame) -> DataFrame:
    c = F.col("confidence")
    return lessons.agg(
        F.count("*").alias("lessons"), F.count(F.when(c >= 0.7, 1)).alias("high"), F.count(F.when((c >= 0.4) & (c < 0.7), 1)).alias("medium"),
        F.count(F.when(c < 0.4, 1)).alias("low"), F.round(F.avg(F.round(c * 100).cast("bigint")) / 100, 2).alias("mean_confidence"),
    )


# --- ordered replays ----------------------------------------------------------------------------------------


def failure_streaks(calls: DataFrame, least: int = 3, bucket_seconds: int = 3600) -> DataFrame:
    """Outages: runs of `least` or more failed calls of a service with no success between them, with the success that
    ended each (`recovered_us`, NULL while it lasts).

    Runs are found inside time buckets. Those at a bucket's edges are joined over one summary row per bucket, so a busy
    service's calls are never ordered in one task.
    """
    ok = F.col("status") != "error"
    us = F.unix_micros("ts")
    b = calls.select("service", "event_id", us.alias("us"), ok.cast("int").alias("ok"), F.floor(us / (bucket_seconds * 1000000)).alias("bucket"))
    cell = W.partitionBy("service", "bucket")
    upto = cell.orderBy("us", "event_id").rowsBetween(W.unboundedPreceding, 0)
    runs = b.withColumn("run", F.sum("ok").over(upto)).groupBy("service", "bucket", "run").agg(
        F.sum(1 - F.col("ok")).alias("failures"), F.min(F.when(F.col("ok") == 0, F.col("us"))).alias("started_us"),
        F.max(F.when(F.col("ok") == 0, F.col("us"))).alias("ended_us"), F.min(F.when(F.col("ok") == 1, F.col("us"))).alias("ok_us"),
    )
    # Run n begins with the n-th success of its bucket; run 0 has none. The success that ends a run begins the next one.
    runs = runs.withColumn("recovered_us", F.lead("ok_us").over(cell.orderBy("run"))).withColumn("last", F.max("run").over(cell))
    if_first, if_last = F.col("run") == 0, F.col("run") == F.col("last")
    inner = runs.filter(~if_first & ~if_last).select("service", "started_us", "ended_us", "failures", "recovered_us")
    # Every bucket has its first piece, if only to tell when it recovered, and its last.
    buckets = runs.groupBy("service", "bucket").agg(
        F.max("last").alias("successes"), F.min("ok_us").alias("first_ok"),
        *[F.max_by(F.struct("failures", "started_us", "ended_us"), F.when(c, 1)).alias(n) for n, c in (("head", if_first), ("tail", if_last))],
    )
    ordered = W.partitionBy("service").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    some = F.col("successes") > 0
    buckets = buckets.withColumn("segment", F.sum(some.cast("int")).over(ordered))
    head = buckets.filter(some).select("service", (F.col("segment") - 1).alias("segment"), "head.*", F.col("first_ok").alias("recovered_us"))
    tail = buckets.select("service", "segment", "tail.*", F.lit(None).cast("bigint").alias("recovered_us"))
    edge = head.unionByName(tail).groupBy("service", "segment").agg(
        F.min("started_us").alias("started_us"), F.max("ended_us").alias("ended_us"), F.sum("failures").alias("failures"), F.min("recovered_us").alias("recovered_us"))
    return inner.unionByName(edge.select(inner.columns)).filter(F.col("failures") >= least)


def segments(rows: DataFrame, keys: list[str], sync, bucket_seconds: int) -> DataFrame:
    """Cut each key's rows into segments that can be replayed on their own.

    `sync(window)` marks a row after which (inclusive) the state does not depend on earlier rows, judged inside a
    time bucket. The first such row of a bucket starts a segment; rows before it belong to the segment of an
    earlier bucket, found over one summary row per bucket. Nothing but summaries is ordered per key.
    """
    b = rows.withColumn("bucket", F.floor(F.unix_micros("ts") / (bucket_seconds * 1000000)))
    w = W.partitionBy(*keys, "bucket").orderBy("ts", "event_id")
    flagged = sync(b, w)
    started = F.max(F.col("sync").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)) == 1
    flagged = flagged.withColumn("started", started)
    per_bucket = flagged.groupBy(*keys, "bucket").agg(F.max("started").alias("has_sync"))
    back = W.partitionBy(*keys).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    per_bucket = per_bucket.withColumn("before", F.last(F.when(F.col("has_sync"), F.col("bucket")), ignorenulls=True).over(back))
    j = flagged.join(per_bucket.select(*keys, "bucket", "before"), [*keys, "bucket"])
    segment = F.when(F.col("started"), F.col("bucket")).otherwise(F.coalesce("before", F.lit(-1)))
    return j.withColumn("segment", segment).drop("bucket", "sync", "started", "before")


def replay(seg: DataFrame, keys: list[str], fold, columns: list[str], schema: str) -> DataFrame:
    """Stream each segment in time order through `fold(state, row) -> (state, output)`; state is per segment."""
    order = [*keys, "segment", "ts_us", "event_id"]
    width = len(keys) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False, name=None):
                if row[:width] != current:
                    current, state = row[:width], None
                state, result = fold(state, row[width:])
                out.append((*row[: width - 1], *result))
            yield pd.DataFrame(out, columns=names)

    names = [c.split()[0] for c in schema.split(", ")]
    ordered = seg.withColumn("ts_us", F.unix_micros("ts")).select(*order, *columns)
    return ordered.repartition(*keys, "segment").sortWithinPartitions(*order).mapInPandas(run, schema)


# Breaker settings (failures to open, rejection time, successes to close).
FAILURE_THRESHOLD = 5
RESET_MS = 30000
SUCCESS_THRESHOLD = 2


def breaker_step(state, ts_us: int, failed: bool, threshold: int, reset_us: int, successes: int):
    """One call through the breaker: (mode, failures in a row, opened at, trial successes) -> new state, decision."""
    mode, fails, opened, good = state or ("CLOSED", 0, 0, 0)
    if mode == "OPEN":
        if ts_us < opened + reset_us:
            return (mode, fails, opened, good), "rejected"
        mode, good = "HALF_OPEN", 0
    if failed:
        fails += 1
        if mode == "HALF_OPEN" or fails >= threshold:
            return ("OPEN", 0, ts_us, 0), "failed"
        return (mode, fails, opened, good), "failed"
    if mode == "HALF_OPEN":
        good += 1
        return (("CLOSED", 0, 0, 0) if good >= successes else (mode, 0, opened, good)), "ok"
    return ("CLOSED", 0, 0, 0), "ok"


def breaker_replay(calls: DataFrame, threshold: int = FAILURE_THRESHOLD, reset_ms: int = RESET_MS, successes: int = SUCCESS_THRESHOLD) -> DataFrame:
    """Decision and breaker state per call.

    A run of good calls is a known point once enough of them lie past the rejection time after the run began:
    whatever the state was, the breaker is closed with no failures counted.
    """
    reset_us = reset_ms * 1000

    def sync(df, w):
        failed = (F.col("status") == "error").cast("int")
        df = df.withColumn("run_no", F.sum(failed).over(w.rowsBetween(W.unboundedPreceding, 0)))
        wr = W.partitionBy("service", "bucket", "run_no").orderBy("ts", "event_id")
        good = F.when(F.col("status") != "error", F.col("ts"))
        df = df.withColumn("run_start", F.min(good).over(W.partitionBy("service", "bucket", "run_no")))
        past = (F.col("status") != "error") & (F.unix_micros("ts") >= F.unix_micros("run_start") + reset_us)
        df = df.withColumn("past", past)
        upto = wr.rowsBetween(W.unboundedPreceding, 0)
        # The row after the known point starts the segment, so that the point itself is replayed before it.
        known = F.sum(F.col("past").cast("int")).over(upto) > successes
        return df.withColumn("sync", F.coalesce(known & F.col("past"), F.lit(False))).drop("run_no", "run_start", "past")

    def fold(state, row):
        ts_us, event_id, status = row
        state, decision = breaker_step(state, ts_us, status == "error", threshold, reset_us, successes)
        return state, (event_id, decision, state[0])

    seg = segments(calls.select("service", "ts", "event_id", "status"), ["service"], sync, 7 * 86400)
    return replay(seg, ["service"], fold, ["status"], "service string, event_id bigint, decision string, state string")


def breaker_summary(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("service").agg(
        F.count("*").alias("calls"), F.count(F.when(F.col("decision") == "rejected", 1)).alias("fast_failed"),
        F.count(F.when((F.col("decision") == "failed") & (F.col("state") == "OPEN"), 1)).alias("openings"),
    )


def ttl_dedupe(calls: DataFrame, ttl_seconds: int = 2) -> DataFrame:
    """Repeats of a call (service, ability, payload) within a time to live after the last accepted one."""
    ttl_us = ttl_seconds * 1000000
    keys = ["service", "ability", "k"]

    def sync(df, w):
        gap = F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(w))
        return df.withColumn("sync", F.coalesce(gap >= ttl_us, F.lit(False)))

    def fold(state, row):
        ts_us, event_id = row
        accept = state is None or ts_us >= state + ttl_us
        return (ts_us if accept else state), (event_id, not accept)

    seg = segments(calls.select(*keys, "ts", "event_id"), keys, sync, max(86400, ttl_seconds * 100))
    return replay(seg, keys, fold, [], "service string, ability string, k int, event_id bigint, duplicate boolean")


def dedupe_stats(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("ability").agg(F.count("*").alias("calls"), F.count(F.when(F.col("duplicate"), 1)).alias("hits"))
