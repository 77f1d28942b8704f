"""Queries on the run log: a run is a user's day of events, an error event a failed job."""

from __future__ import annotations

from pyspark.sql import functions as F

from presskiln.catalog import tables as T
from presskiln.operators import runs


def _results(spark, folder):
    failed = F.col("event_type") == "error"
    day = F.date_diff(F.to_date("ts"), F.lit(T.LOG_START).cast("date"))
    return T.read(spark, folder, "events").select(
        (F.col("user_id") * 1000 + day).alias("run_id"),
        F.col("user_id").alias("source_id"),
        F.col("event_id").alias("job_seq"),
        F.when(failed, F.concat(F.lit("event "), "event_id", F.lit(": "), "props")).alias("error"),
    )


def _runs(spark, folder):
    """Runs of the log, and one without jobs per customer, numbered below zero."""
    busy = _results(spark, folder).select("run_id", "source_id").distinct()
    idle = T.read(spark, folder, "customer").select(
        (-F.col("c_custkey") - 1).alias("run_id"), F.col("c_custkey").alias("source_id")
    )
    return busy.unionByName(idle)


def _opened(spark, folder):
    started = (F.timestamp_seconds(F.lit(1704067200)) + F.make_dt_interval(F.abs("run_id") % 1000)).cast("timestamp")
    return runs.open_runs(_runs(spark, folder), started)


def _closing(spark, folder):
    results = _results(spark, folder)
    outcomes = runs.run_outcomes(_runs(spark, folder), results)
    return outcomes.join(runs.run_errors(results), "run_id", "left")


def run_outcomes(spark, folder):
    return runs.run_outcomes(_runs(spark, folder), _results(spark, folder))


def run_errors(spark, folder):
    return runs.run_errors(_results(spark, folder))


def run_log(spark, folder):
    """All runs opened, then closed with outcome and errors."""
    return T.plain(runs.finish_runs(_opened(spark, folder), _closing(spark, folder), T.run_ts()))


def finish_runs(spark, folder):
    """Only failed runs are closed; the others stay open."""
    closing = _closing(spark, folder).where(F.col("status") == runs.FAILED)
    return T.plain(runs.finish_runs(_opened(spark, folder), closing, T.run_ts()))


QUERIES = {f.__name__: f for f in (run_outcomes, run_errors, run_log, finish_runs)}

_LOG = f"""WITH results AS (
  SELECT user_id * 1000 + date_diff('day', DATE '{T.LOG_START}', ts::DATE) AS run_id, user_id AS source_id, event_id AS job_seq,
    CASE WHEN event_type = 'error' THEN 'event ' || event_id || ': ' || props END AS error
  FROM events),
runs AS (
  SELECT DISTINCT run_id, source_id FROM results
  UNION ALL SELECT -c_custkey - 1, c_custkey FROM customer),
outcomes AS (
  SELECT runs.run_id, count(job_seq) FILTER (error IS NULL) AS saved, count(error) AS failed
  FROM runs LEFT JOIN results USING (run_id) GROUP BY runs.run_id),
stated AS (
  SELECT *, CASE WHEN failed = 0 THEN 'success' WHEN saved > 0 THEN 'partial' ELSE 'failed' END AS status FROM outcomes),
errors AS (
  SELECT run_id, string_agg(error, '; ' ORDER BY job_seq) AS error_message FROM results WHERE error IS NOT NULL GROUP BY run_id),
closing AS (SELECT * FROM stated LEFT JOIN errors USING (run_id)),
opened AS (
  SELECT run_id, source_id, TIMESTAMP '2024-01-01 00:00:00' + to_days((abs(run_id) % 1000)::INT) AS started_at FROM runs)
"""
_CLOSED = """SELECT opened.run_id, source_id, started_at,
  CASE WHEN status IS NOT NULL THEN TIMESTAMP '{ts}' END AS finished_at, coalesce(status, 'running') AS status, error_message
FROM opened LEFT JOIN (SELECT * FROM closing WHERE {which}) c ON c.run_id = opened.run_id"""

ORACLES = {
    "run_outcomes": _LOG + "SELECT * FROM stated",
    "run_errors": _LOG + "SELECT * FROM errors",
    "run_log": _LOG + _CLOSED.format(ts=T.RUN_TS, which="true"),
    "finish_runs": _LOG + _CLOSED.format(ts=T.RUN_TS, which="status = 'failed'"),
}
