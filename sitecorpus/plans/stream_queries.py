"""Streaming queries over the `events`, `documents` and `conversations` tables, run over all available data."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecorpus.operators import checks
from sitecorpus.plans import ops_queries as oq
from sitecorpus.plans.registry import ORACLES, Tables, ora, query
from sitecorpus.plans.tree_queries import Trees, guard_rows
from sitecorpus.session import stage
from sitecorpus.sources import events as src, trees
from sitecorpus.streaming import jobs


def calls(t: Tables):
    return src.call_events(src.stream_events(t.spark, t.sf_dir))


_WM = "(SELECT max(ts) FROM calls WHERE status = 'error') - INTERVAL 10 MINUTES"
query("stream_error_windows", ora(f"""
 SELECT h * 3600 AS window_start, h * 3600 + 3600 AS window_end, category, count(*) AS errors FROM (SELECT *, epoch_us(ts) // 3600000000 AS h FROM calls WHERE status = 'error')
 WHERE h * 3600 + 3600 <= epoch({_WM}) GROUP BY 1, 2, 3"""))(lambda t: jobs.run_to_table(jobs.error_windows(calls(t)), "error-windows"))
query("stream_error_windows_24h", ora(f"""
 , e AS (SELECT category, epoch_us(ts) // 3600000000 - unnest(range(0, 24)) AS h FROM calls WHERE status = 'error')
 SELECT h * 3600 AS window_start, h * 3600 + 86400 AS window_end, category, count(*) AS errors FROM e WHERE h * 3600 + 86400 <= epoch({_WM}) GROUP BY 1, 2, 3"""))(
    lambda t: jobs.run_to_table(jobs.error_windows(calls(t), size="24 hours", slide="1 hour"), "error-day-windows"))
query("stream_error_sessions", ora(f"""
 , e AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY service ORDER BY us) < 7200000000 THEN 0 ELSE 1 END AS fresh FROM (SELECT service, epoch_us(ts) AS us FROM calls WHERE status = 'error')),
 s AS (SELECT *, sum(fresh) OVER (PARTITION BY service ORDER BY us) AS sid FROM e)
 SELECT service, min(us) AS start_us, max(us) + 7200000000 AS end_us, count(*) AS errors FROM s GROUP BY service, sid HAVING (max(us) + 7200000000) // 1000 <= epoch_ms({_WM})"""))(
    lambda t: jobs.run_to_table(jobs.error_sessions(calls(t)), "error-sessions"))
query("stream_latest_phase", ora("SELECT run_id, phase, started_us, status, duration_ms FROM lphase"))(
    lambda t: jobs.updates_to_table(jobs.latest_phases(src.phase_runs(src.stream_events(t.spark, t.sf_dir))), "phases",
                                    ["run_id", "phase"], F.struct("started_us", "event_id")).drop("event_id"))


def _until_watermark(name: str) -> str:
    """The batch twin's SQL, limited to the calls the watermark has passed when the stream ends."""
    return f"""SELECT * FROM ({ORACLES[name]}) WHERE event_id IN (
      SELECT event_id FROM events WHERE epoch_us(ts) <= ((SELECT epoch_ms(max(ts)) FROM events) - 600000) * 1000)"""


query("stream_breaker", _until_watermark("breaker_replay"))(lambda t: jobs.run_to_table(jobs.breaker(calls(t), 3, oq._RESET * 1000), "breaker"))
query("stream_dedupe", _until_watermark("ttl_dedupe"))(lambda t: jobs.run_to_table(jobs.dedupe(calls(t), oq._TTL), "dedupe"))
# Which call of a key stays depends on the order of arrival, so the keys are compared.
query("stream_dedupe_watermark", ora("SELECT DISTINCT service, ability, k FROM calls"))(
    lambda t: jobs.run_to_table(jobs.dedupe_within_watermark(calls(t)).select("service", "ability", "k"), "dedupe-watermark"))


def notes_stream(t: Tables):
    schema = t.table("documents").schema
    d = t.spark.readStream.schema(schema).parquet(src.stream_path(t.sf_dir, "documents"))
    return d.select(F.col("text").alias("content"))


query("stream_lesson_upsert", ora("SELECT id, max(reinforced_count) AS reinforced_count, max(confidence) AS confidence FROM lessons GROUP BY 1"))(
    lambda t: jobs.updates_to_table(jobs.lessons(notes_stream(t)), "lessons", ["id"], F.col("reinforced_count")))


def _gate(t: Tables):
    docs_path = jobs.scratch_path(t.spark, "docs")
    docs = trees.conversation_trees(t.table("conversations"))
    docs.write.parquet(docs_path)
    kit = stage(Trees(t.spark.read.schema(docs.schema).parquet(docs_path)).kit, "kit")

    def score(batch):
        docs_in = batch.select("page_id", "doc")
        cards = checks.guard_scorecard(guard_rows(Trees(docs_in, kit)), docs_in.select("page_id"))
        return cards.select("page_id", "score", "status")

    stream = t.spark.readStream.schema(docs.schema).parquet(docs_path)
    return jobs.quality_gate(t.spark, stream, score)


query("stream_quality_gate", ora("SELECT page_id, score, status FROM gcard"))(_gate)
