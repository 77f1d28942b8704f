"""Run log: opening runs, their outcome and error text, closing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presskiln.operators.updates import update_rows

# States of a run.
RUNNING, SUCCESS, PARTIAL, FAILED = "running", "success", "partial", "failed"

# Errors per piece of text.
PART_ERRORS = 10_000


def open_runs(runs: DataFrame, started_at: Column) -> DataFrame:
    return runs.select(
        "run_id",
        "source_id",
        started_at.alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit(RUNNING).alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )


def run_outcomes(runs: DataFrame, results: DataFrame, run: str = "run_id") -> DataFrame:
    """Saved and failed jobs of every run and its status; a run without jobs is a success."""
    counts = results.groupBy(run).agg(
        F.count_if(F.col("error").isNull()).alias("saved"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )
    full = runs.select(run).join(counts, run, "left").na.fill(0, ["saved", "failed"])
    status = (
        F.when(F.col("failed") == 0, SUCCESS).when(F.col("saved") > 0, PARTIAL).otherwise(FAILED)
    )
    return full.select(run, "saved", "failed", status.alias("status"))


def error_parts(results: DataFrame, run: str = "run_id", order: str = "job_seq") -> DataFrame:
    """Errors of every run in job order, in pieces of a bounded number of errors.

    ``order`` is a number, unique within a run. A piece covers a fixed span of it, so no task
    gathers more than ``PART_ERRORS`` errors at once, whatever the size of the run.
    """
    text = F.expr(f"listagg(error, '; ') WITHIN GROUP (ORDER BY `{order}`)")
    return (
        results.where(F.col("error").isNotNull())
        .groupBy(run, F.floor(F.col(order) / PART_ERRORS).alias("part_no"))
        .agg(text.alias("error_message"))
    )


def error_texts(parts: DataFrame, run: str = "run_id") -> DataFrame:
    """One text per run, its pieces joined in order."""
    text = F.expr("listagg(error_message, '; ') WITHIN GROUP (ORDER BY part_no)")
    return parts.groupBy(run).agg(text.alias("error_message"))


def run_errors(results: DataFrame, run: str = "run_id", order: str = "job_seq") -> DataFrame:
    return error_texts(error_parts(results, run, order), run)


def with_errors(log: DataFrame, parts: DataFrame) -> DataFrame:
    """The run log with the errors of each run as one text, for those who read it so."""
    return log.drop("error_message").join(error_texts(parts), "run_id", "left").select(*log.columns)


def finish_runs(opened: DataFrame, closing: DataFrame, finished_at: Column) -> DataFrame:
    """Runs with the status and error text of their ``closing`` row, and its finishing time."""
    return update_rows(
        opened,
        closing.select("run_id", finished_at.alias("finished_at"), "status", "error_message"),
        "run_id",
    )
