"""Reliability queries over the `events` and `documents` tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecorpus.operators import ops
from sitecorpus.plans.registry import Tables, cte, ora, query
from sitecorpus.session import scratch_path
from sitecorpus.sources import events as src

_msg = "['" + "', '".join(src._MESSAGES) + "']"
cte("calls", f"""
 SELECT *, CASE WHEN status <> 'error' THEN NULL WHEN regexp_matches(message, 'method.*not found|read_page|does not exist') THEN 'method-missing'
   WHEN regexp_matches(lower(message), 'fetch failed|network|econnrefused|enotfound|etimedout|econnreset') OR (contains(lower(message), 'timeout') AND regexp_matches(lower(message), 'ms|seconds'))
    OR http_status BETWEEN 500 AND 599 OR http_status = 429 THEN 'retryable' ELSE 'fatal' END AS category FROM (
 SELECT event_id, ts, 'svc-' || user_id AS service, CASE event_type WHEN 'error' THEN 'ability-' || (k % 5) ELSE event_type END AS ability, k,
  CASE event_type WHEN 'error' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN event_type <> 'error' THEN 200 WHEN k % 6 = 4 THEN 503 WHEN k % 6 = 5 AND k % 4 = 1 THEN 429 ELSE 400 END::BIGINT AS http_status,
  floor(value * 100 + 0.5)::BIGINT AS duration_ms, CASE event_type WHEN 'error' THEN ({_msg})[k % 6 + 1] END AS message
 FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k FROM events))""")
cte("pruns", """
 SELECT event_id, user_id || '-' || strftime(ts, '%Y%m%d') AS run_id, (['export','tokens','convert','validate','publish'])[o] AS phase, o::BIGINT AS phase_ord,
  (['completed','failed','running','skipped','completed'])[k % 5 + 1] AS status, ts AS started_at, floor(value * 100 + 0.5)::BIGINT AS duration_ms
 FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS o FROM events)""")
cte("lphase", """
 SELECT run_id, phase, phase_ord, count(*) AS records, arg_max(status, (started_at, event_id)) AS status, arg_max(duration_ms, (started_at, event_id)) AS duration_ms,
  epoch_us(max(started_at)) AS started_us FROM pruns GROUP BY 1, 2, 3""")


def calls(t: Tables):
    return src.call_events(t.table("events"))


def runs(t: Tables):
    return src.phase_runs(t.table("events"))


def _call_log(t: Tables):
    """The calls written as a log, with a broken line for every hundredth, and read by the log reader."""
    path = scratch_path(t.spark, "calls")
    lines = src.call_lines(calls(t))
    broken = calls(t).filter("event_id % 100 = 0").select(F.lit('{"ts": "2024-01-01", "service":').alias("value"))
    lines.unionByName(broken).write.text(path)
    return src.read_calls_jsonl(t.spark, path)


query("src_events_jsonl", ora("SELECT event_id, epoch_us(ts) AS ts_us, service, ability, k, status, http_status, duration_ms, message FROM calls"))(
    lambda t: _call_log(t).select("event_id", F.unix_micros("ts").alias("ts_us"), "service", "ability", F.col("params")["k"].cast("int").alias("k"),
                                  "status", "http_status", "duration_ms", "message"))
query("failure_streaks", ora("""
 SELECT service, min(us) FILTER (ok = 0) AS started_us, max(us) FILTER (ok = 0) AS ended_us, (count(*) FILTER (ok = 0))::BIGINT AS failures, any_value(next_ok) AS recovered_us FROM (
  SELECT *, min(us) FILTER (ok = 1) OVER (PARTITION BY service ORDER BY us, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ok FROM (
   SELECT service, event_id, epoch_us(ts) AS us, (status <> 'error')::INT AS ok, sum((status <> 'error')::INT) OVER (PARTITION BY service ORDER BY ts, event_id) AS run FROM calls))
 GROUP BY service, run HAVING count(*) FILTER (ok = 0) >= 3"""))(lambda t: ops.failure_streaks(calls(t)))
query("error_summary", ora("SELECT category, count(*) AS errors, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM calls WHERE status = 'error' GROUP BY 1"))(
    lambda t: ops.error_summary(calls(t)).drop("services_approx"))
query("recent_errors", ora("SELECT event_id, epoch_us(ts) AS ts_us, service, ability, category, message FROM calls WHERE status = 'error' ORDER BY ts DESC, event_id DESC LIMIT 10"))(
    lambda t: ops.recent_errors(calls(t)))
query("errors_last_window", ora("SELECT service, count(*) AS errors FROM calls WHERE status = 'error' AND ts > (SELECT max(ts) FROM calls) - INTERVAL 24 HOURS GROUP BY 1"))(
    lambda t: ops.errors_last_window(calls(t)))
query("error_trailing_24h", ora("""
 , h AS (SELECT service, epoch_us(ts) // 3600000000 AS hour, count(*) AS errors FROM calls WHERE status = 'error' GROUP BY 1, 2)
 SELECT a.service, a.hour, a.errors, (SELECT sum(b.errors) FROM h b WHERE b.service = a.service AND b.hour BETWEEN a.hour - 23 AND a.hour)::BIGINT AS trailing_errors FROM h a"""))(
    lambda t: ops.error_trailing(calls(t)))
query("perf_trend", ora("""
 , d AS (SELECT service, strftime(ts, '%Y-%m-%d') AS day, sum(duration_ms)::BIGINT AS ms FROM calls GROUP BY 1, 2),
 g AS (SELECT service, count(*) AS runs, arg_min(ms, day) AS first_ms, arg_max(ms, day) AS last_ms FROM d GROUP BY 1)
 SELECT *, floor((last_ms - first_ms) * 100 / nullif(first_ms, 0) + 0.5)::BIGINT AS change_pct, CASE WHEN runs < 2 THEN 'baseline' WHEN (last_ms - first_ms) * 100 / nullif(first_ms, 0) > 20 THEN 'regression'
  WHEN (last_ms - first_ms) * 100 / nullif(first_ms, 0) < -10 THEN 'improvement' ELSE 'stable' END AS trend FROM g"""))(lambda t: ops.perf_trend(calls(t)))
query("run_over_run", ora("""
 SELECT *, ms - lag(ms) OVER (PARTITION BY service ORDER BY day) AS delta_ms FROM (
  SELECT service, strftime(ts, '%Y-%m-%d') AS day, sum(duration_ms)::BIGINT AS ms, count(*) AS calls FROM calls GROUP BY 1, 2)"""))(lambda t: ops.run_over_run(calls(t)))
query("bottlenecks", ora("""
 SELECT *, floor(ms * 1000 / total_ms + 0.5) / 10 AS pct FROM (
  SELECT *, (sum(ms) OVER (PARTITION BY service))::BIGINT AS total_ms, row_number() OVER (PARTITION BY service ORDER BY ms DESC, ability) AS rank FROM (
   SELECT service, ability, sum(duration_ms)::BIGINT AS ms FROM calls GROUP BY 1, 2)) WHERE rank <= 3"""))(lambda t: ops.bottlenecks(calls(t)))
query("phase_durations", ora("SELECT * FROM lphase"))(lambda t: ops.latest_phases(runs(t)))
query("resumable_phase", ora("""
 SELECT run_id, (SELECT p FROM (SELECT unnest(['export','tokens','convert','validate','publish']) AS p, unnest(range(1, 6)) AS o)
   WHERE NOT list_contains(done, o) ORDER BY o LIMIT 1) AS resume_at FROM (
  SELECT run_id, list(phase_ord) FILTER (status IN ('completed', 'skipped')) AS d0, coalesce(list(phase_ord) FILTER (status IN ('completed', 'skipped')), []) AS done FROM lphase GROUP BY 1)"""))(
    lambda t: ops.resumable_phase(runs(t)))
query("run_status_summary", ora("""
 SELECT run_id, count(*) FILTER (status IN ('completed', 'skipped')) AS succeeded, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'running') AS pending,
  sum(duration_ms)::BIGINT AS elapsed_ms, coalesce(string_agg(phase, ',' ORDER BY phase_ord) FILTER (status = 'failed'), '') AS failed_phases FROM lphase GROUP BY 1"""))(
    lambda t: ops.run_status_summary(runs(t)))
query("retry_stats", ora("""
 SELECT service, k, count(*) AS attempts, count(*) FILTER (status = 'error') AS failures, 500.0 * (2.0 ** (count(*) FILTER (status = 'error')) - 1)::DOUBLE AS expected_backoff_ms,
  coalesce(max((ts, event_id)) FILTER (status = 'ok') > min((ts, event_id)) FILTER (status = 'error'), false) AS recovered FROM calls GROUP BY 1, 2"""))(
    lambda t: ops.retry_stats(calls(t)))
query("health_snapshot", ora("""
 SELECT *, CASE WHEN errors_24h > 0 OR stale_build OR workarounds > 0 THEN 'degraded' ELSE 'ok' END AS status FROM (
  SELECT count(*) FILTER (status = 'error' AND ts > m - INTERVAL 24 HOURS) AS errors_24h, count(*) FILTER (category = 'method-missing') AS workarounds,
   date_diff('second', max(ts) FILTER (status = 'ok'), max(m)) / 86400.0 > 7 AS stale_build FROM calls, (SELECT max(ts) AS m FROM calls))"""))(lambda t: ops.health_snapshot(calls(t)))


def notes(t: Tables):
    """Documents as lesson notes; the document number stands for the day a note was taken."""
    d = t.table("documents")
    return d.select(F.col("text").alias("content"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias("created_at"))


def lessons(t: Tables):
    return ops.lesson_upsert(notes(t))


def _dated(df):
    return df.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd")).withColumn("last_reinforced_at", F.date_format("last_reinforced_at", "yyyy-MM-dd"))


cte("lessons", """
 SELECT md5(text) AS id, min(length(text)) AS chars, strftime(min(d), '%Y-%m-%d') AS created_at, strftime(max(d), '%Y-%m-%d') AS last_reinforced_at,
  least(95, 50 + 5 * (count(*) - 1)) / 100 AS confidence, count(*) - 1 AS reinforced_count
 FROM (SELECT *, DATE '2024-01-01' + (doc_id % 365)::INT AS d FROM documents) GROUP BY 1""")
query("lesson_upsert", ora("SELECT * FROM lessons"))(lambda t: _dated(lessons(t)))
query("lesson_decay", ora("""
 SELECT * REPLACE (round(CASE WHEN decayed THEN greatest(0, confidence - 0.1) ELSE confidence END, 2) AS confidence) FROM (
  SELECT *, date_diff('day', last_reinforced_at::DATE, DATE '2025-01-01') > 180 AS decayed FROM lessons)"""))(lambda t: _dated(ops.lesson_decay(lessons(t), "2025-01-01")))
query("lesson_stats", ora("""
 SELECT count(*) AS lessons, count(*) FILTER (confidence >= 0.7) AS high, count(*) FILTER (confidence >= 0.4 AND confidence < 0.7) AS medium, count(*) FILTER (confidence < 0.4) AS low,
  round(avg(round(confidence * 100)) / 100, 2) AS mean_confidence FROM lessons"""))(lambda t: ops.lesson_stats(lessons(t)))

# The logs are sparse (minutes between calls of a service), so the replays use wider settings than the defaults.
_RESET = 3600
cte("bcalls", "SELECT service, event_id, epoch_us(ts) AS us, status, row_number() OVER (PARTITION BY service ORDER BY ts, event_id) AS rn FROM calls")
_OPEN = f"b.mode = 'OPEN' AND c.us < b.opened + {_RESET}000000"
_HALF = f"(b.mode = 'HALF_OPEN' OR (b.mode = 'OPEN' AND c.us >= b.opened + {_RESET}000000))"
query("breaker_replay", ora(f"""
 , b AS (SELECT service, 0::BIGINT AS event_id, 0::BIGINT AS rn, 'CLOSED' AS mode, 0::BIGINT AS fails, 0::BIGINT AS opened, 0::BIGINT AS good, '' AS decision FROM bcalls GROUP BY service
  UNION ALL SELECT c.service, c.event_id, c.rn,
   CASE WHEN {_OPEN} THEN 'OPEN' WHEN c.status = 'error' THEN CASE WHEN {_HALF} OR b.fails + 1 >= 3 THEN 'OPEN' ELSE 'CLOSED' END
     WHEN {_HALF} AND (CASE WHEN b.mode = 'OPEN' THEN 0 ELSE b.good END) + 1 < 2 THEN 'HALF_OPEN' ELSE 'CLOSED' END,
   CASE WHEN {_OPEN} THEN 0 WHEN c.status = 'error' THEN CASE WHEN {_HALF} OR b.fails + 1 >= 3 THEN 0 ELSE b.fails + 1 END ELSE 0 END,
   CASE WHEN {_OPEN} THEN b.opened WHEN c.status = 'error' AND ({_HALF} OR b.fails + 1 >= 3) THEN c.us ELSE b.opened END,
   CASE WHEN c.status <> 'error' AND {_HALF} THEN (CASE WHEN b.mode = 'OPEN' THEN 0 ELSE b.good END) + 1 ELSE 0 END,
   CASE WHEN {_OPEN} THEN 'rejected' WHEN c.status = 'error' THEN 'failed' ELSE 'ok' END
  FROM b JOIN bcalls c ON c.service = b.service AND c.rn = b.rn + 1)
 SELECT service, event_id, decision, mode AS state FROM b WHERE rn > 0""").replace("WITH ", "WITH RECURSIVE ", 1))(
    lambda t: ops.breaker_replay(calls(t), threshold=3, reset_ms=_RESET * 1000))
_TTL = 6 * 86400
query("ttl_dedupe", ora(f"""
 , s AS (SELECT service, ability, k, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY service, ability, k ORDER BY ts, event_id) AS rn FROM calls),
 b AS (SELECT service, ability, k, event_id, rn, us AS acc, false AS duplicate FROM s WHERE rn = 1
  UNION ALL SELECT s.service, s.ability, s.k, s.event_id, s.rn, CASE WHEN s.us >= b.acc + {_TTL}000000 THEN s.us ELSE b.acc END, s.us < b.acc + {_TTL}000000
  FROM b JOIN s ON s.service = b.service AND s.ability = b.ability AND s.k = b.k AND s.rn = b.rn + 1)
 SELECT service, ability, k, event_id, duplicate FROM b""").replace("WITH ", "WITH RECURSIVE ", 1))(lambda t: ops.ttl_dedupe(calls(t), _TTL))
