"""New snapshots as they arrive: every page whose URL is not stored becomes an article."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from presskiln.operators import fetch, ranking, runs
from presskiln.operators.skew import join_splittable
from presskiln.plans.articles import article_rows
from presskiln.plans.ingest import utc
from presskiln.schemas import SNAPSHOTS
from presskiln.session import cut_lineage, tune
from presskiln.sources.files import addressed
from presskiln.sources.raw_html import stage_raw_html
from presskiln.sources.store import ArticleStore

ARRIVALS = StructType([StructField("source_id", LongType()), *SNAPSHOTS.fields])


def slice_results(arrived: DataFrame, seen_among: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What becomes of the snapshots of a slice: the earliest good one of every URL that is not
    stored is saved; a refused one that came before it, or where there is none, is an error.

    Every snapshot is judged by those before it alone, so slices taken in the order of fetching
    give what one run over all of them gives. Text is read once, in the scan.
    """
    facts = fetch.page_facts(arrived, keep=("source_id",)).where(F.col("url").isNotNull())
    facts = cut_lineage(facts)
    facts = cut_lineage(join_splittable(facts, seen_among(facts).select("url"), "url", "left_anti"))
    saved = fetch.one_per_url(facts.where(~F.col("denied")), latest=False)
    good = saved.select("url", F.col("fetched_at").alias("_good_at"))
    refused = join_splittable(facts.where("denied"), good, "url", "left").where("_good_at is null or fetched_at < _good_at")
    kept = ["source_id", "url", "fetched_at", "snapshot_url", "title", "published_at", "content_hash", *fetch.ADDRESS]
    reason = fetch.error(F.lit(True), F.col("denied"))
    return saved.select(*kept, F.lit(None).cast("string").alias("error")).unionByName(refused.select(*kept, reason.alias("error")))


def ingest_snapshots(arrived: DataFrame, store: ArticleStore, run_ts: datetime, batch: str) -> None:
    """Store the articles of one slice of snapshots, with a run for each source in it and its
    outcome; a committed batch does nothing. Everything becomes visible at once."""
    if store.is_committed(batch, "articles"):
        return
    tune(arrived.sparkSession)
    now = utc(run_ts)
    articles = store.read("articles")
    results = cut_lineage(
        ranking.ranked(
            slice_results(arrived, store.seen_among), ["source_id", "url", "fetched_at", "snapshot_url", *fetch.ADDRESS], name="job_seq"
        )
    )
    active = arrived.select("source_id").where(F.col("source_id").isNotNull()).distinct()
    active = cut_lineage(ranking.with_next_ids(active, ["source_id"], "run_id", store.read("scrape_runs")))
    results = results.join(active, "source_id", "left")
    saved = results.where(F.col("error").isNull())
    closing = runs.run_outcomes(active, results).withColumn("error_message", F.lit(None).cast("string"))
    store.seen.grow(saved, batch)
    store.commit(
        store.stage("articles", article_rows(saved, ["source_id", "url"], now, articles), batch),
        stage_raw_html(store, saved, arrived, now, batch),
        store.stage("run_error_parts", runs.error_parts(results), batch),
        store.stage("scrape_runs", runs.finish_runs(runs.open_runs(active, now), closing, now), batch),
    )


def start(
    spark: SparkSession,
    folder: str,
    store_root: str,
    state_folder: str,
    run_ts: datetime,
    max_files: int | None = None,
) -> StreamingQuery:
    """Take in every file not yet seen in ``folder``, then stop.

    ``state_folder`` is the streaming checkpoint and must be shared by the cluster. The sink
    may be called twice for a batch; the commit log makes the second call do nothing.
    """
    tune(spark)
    store = ArticleStore(spark, store_root)
    reader = spark.readStream.schema(ARRIVALS)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def take_in(arrived: DataFrame, batch_id: int) -> None:
        ingest_snapshots(arrived, store, run_ts, f"stream-{batch_id:012d}")

    return (
        addressed(reader.parquet(folder))
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", state_folder)
        .trigger(availableNow=True)
        .start()
    )
