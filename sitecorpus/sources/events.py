"""Operational logs: readers for JSONL call logs and the views of the `events` table as calls and phase runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CALL_SCHEMA = (
    "event_id bigint, ts timestamp, service string, ability string, params map<string,string>, status string, http_status int, "
    "duration_ms bigint, message string"
)
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_calls_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Append-only call log; malformed lines are left out."""
    return spark.read.schema(CALL_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def call_lines(calls: DataFrame) -> DataFrame:
    """Calls as the lines of such a log, many to a file when written as text."""
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ts")
    params = F.create_map(F.lit("k"), F.col("k").cast("string")).alias("params")
    return calls.select(F.to_json(F.struct("event_id", ts, "service", "ability", params, "status", "http_status", "duration_ms", "message")).alias("value"))


def stream_calls_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CALL_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def stream_events(spark: SparkSession, sf_dir: str, batch_bytes: int = 4 << 30) -> DataFrame:
    """The `events` table of a folder as a stream, in batches of bounded size."""
    return spark.readStream.schema(EVENT_SCHEMA).option("maxBytesPerTrigger", str(batch_bytes)).parquet(stream_path(sf_dir, "events"))


def stream_path(sf_dir: str, name: str) -> str:
    """A table as a stream's path, be it one file or a folder of files. A stream takes a single file only by a pattern, and
    this one matches no other name."""
    return f"{sf_dir}/{name}.parque[t]"


# Error messages by payload number, written the way clients report them.
_MESSAGES = ("fetch failed: ECONNRESET", "method read_page not found", "timeout after 30000 ms", "resource does not exist", "server error", "bad input")


def call_events(events: DataFrame) -> DataFrame:
    """Calls: the user is the service key, `error` events are failed calls, `value` stands for the duration."""
    k = F.from_json("props", "k int")["k"]
    failed = F.col("event_type") == "error"
    pick = k % len(_MESSAGES)
    message = F.element_at(F.array(*[F.lit(m) for m in _MESSAGES]), pick + 1)
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("svc-"), "user_id").alias("service"),
        F.when(failed, F.concat(F.lit("ability-"), (k % 5).cast("string"))).otherwise(F.col("event_type")).alias("ability"),
        k.alias("k"), F.when(failed, "error").otherwise("ok").alias("status"),
        F.when(failed & (pick == 4), 503).when(failed & (pick == 5) & (k % 4 == 1), 429).when(failed, 400).otherwise(200).alias("http_status"),
        F.floor(F.col("value") * 100 + 0.5).alias("duration_ms"), F.when(failed, message).alias("message"),
    )


# Phases of a run in order.
PHASES = ("export", "tokens", "convert", "validate", "publish")
_PHASE_OF = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}


def phase_runs(events: DataFrame) -> DataFrame:
    """Phase records of runs (one run per user and day); a phase may be recorded several times."""
    k = F.from_json("props", "k int")["k"]
    ord_ = F.lit(None).cast("int")
    for name, n in _PHASE_OF.items():
        ord_ = F.when(F.col("event_type") == name, n).otherwise(ord_)
    names = F.array(*[F.lit(p) for p in PHASES])
    status = F.element_at(F.array(*[F.lit(s) for s in ("completed", "failed", "running", "skipped", "completed")]), k % 5 + 1)
    return events.select(
        "event_id", F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.element_at(names, ord_).alias("phase"), ord_.alias("phase_ord"), status.alias("status"),
        F.col("ts").cast("timestamp").alias("started_at"), F.floor(F.col("value") * 100 + 0.5).alias("duration_ms"),
    )
