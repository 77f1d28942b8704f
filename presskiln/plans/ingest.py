"""The whole ingest: registry, jobs, fetch, articles, page store, run log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presskiln.operators import fetch, jobs, ranking, registry, runs
from presskiln.operators.skew import join_splittable
from presskiln.operators.updates import conform
from presskiln.plans import runs as R
from presskiln.plans.articles import article_rows
from presskiln.schemas import RESULTS
from presskiln.session import cut_lineage, tune
from presskiln.sources.raw_html import stage_raw_html
from presskiln.sources.store import ArticleStore


@dataclass(frozen=True)
class Ingest:
    """What one ingest did, as DataFrames. ``problems`` are sources that could not run."""

    problems: DataFrame
    results: DataFrame


def utc(moment: datetime) -> Column:
    """Literal of a point in time; a value without zone is taken as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment.isoformat()).cast("timestamp")


def plan_results(
    sources: DataFrame,
    snapshots: DataFrame,
    redirects: DataFrame,
    seen: DataFrame | Callable[[DataFrame], DataFrame],
    settings: R.Settings,
    as_of: Column | None = None,
) -> DataFrame:
    """Results of all jobs of all sources: saved pages and errors, in job order.

    ``seen`` holds the stored URLs, or gives those among some jobs. Keys come first: the URLs of searches and listings pick their snapshots by narrow columns, then
    the text of those is read for its links; the links that are not stored pick theirs, and only
    the text of those is read for titles, dates and hashes.
    """
    read = cut_lineage(R.expanded(R.link_pages(sources), snapshots, settings))
    found = cut_lineage(R.listing_links(read))
    due = R.direct_jobs(sources).unionByName(R.search_jobs(read, redirects, as_of))
    due = cut_lineage(due)
    known = cut_lineage(seen(due.select("url").union(found.select("url")))) if callable(seen) else seen
    due, fresh = cut_lineage(jobs.skip_seen(due, known)), cut_lineage(jobs.skip_seen(found, known))
    wanted = due.select("url").union(fresh.select("url"))
    facts = cut_lineage(fetch.wanted_facts(wanted, snapshots))

    fixed = cut_lineage(R.run_fixed(due, facts))
    taken = fixed.where("ok").groupBy("url").agg(F.min("source_seq").alias("source_seq"))
    visited, walks = R.run_listing(fresh, facts, taken)

    # Search jobs leave alone what a listing source before them visited or was led to.
    touched = visited.select("url", "source_seq").union(
        visited.where("ok").select("final_url", "source_seq")
    )
    touched = touched.groupBy("url").agg(F.min("source_seq").alias("_touched_by"))
    fixed = (
        join_splittable(fixed, touched, "url", "left")
        .where(
            F.col("allow_rescrape")
            | F.col("_touched_by").isNull()
            | (F.col("_touched_by") > F.col("source_seq"))
        )
        .drop("_touched_by")
    )

    page = ["title", "published_at", "content_hash", *fetch.ADDRESS]
    saved = (
        fixed.select(*R.RUN, "page_no", F.col("url").alias("job_url"), "url", "error", *page)
        .unionByName(
            # A visit that leads nowhere is no error of a listing run, only a missing article.
            visited.where("ok").select(
                *R.RUN, "page_no", F.col("url").alias("job_url"), F.col("final_url").alias("url"), "error", *page
            )
        )
    )
    failed = R.failed_pages(read, walks).withColumn("job_url", F.col("url"))
    # The page a job was found on comes before the job.
    everything = saved.withColumn("step", F.lit(1)).unionByName(
        failed.withColumn("step", F.lit(0)), allowMissingColumns=True
    )
    order = ["source_seq", "page_no", "step", "job_url"]
    return conform(ranking.ranked(everything, order, name="job_seq"), RESULTS)


def ingest(
    registry_table: DataFrame,
    snapshots: DataFrame,
    redirects: DataFrame,
    store: ArticleStore,
    run_ts: datetime,
    batch: str,
    settings: R.Settings = R.Settings(),
) -> Ingest:
    """Run every enabled source of the registry once and write all tables.

    One bad page never loses others: each job has its own outcome. Limits come from the settings of
    the document a source is in. ``run_ts`` stands for the current time throughout, so a run can be
    repeated with equal results, and redirects followed later are not looked at. A batch that is
    already committed writes nothing.
    """
    spark = tune(registry_table.sparkSession)
    now = utc(run_ts)

    entries = cut_lineage(
        ranking.ranked(registry.registry_entries(registry_table), ["entry_order"], name="source_seq")
    )
    problems = entries.where(F.col("problem").isNotNull())
    if store.is_committed(batch, "articles"):
        return Ingest(problems, spark.createDataFrame([], RESULTS))

    valid = entries.where(F.col("problem").isNull())
    # Every configured source with an address is kept up to date; only valid ones are run.
    sources = cut_lineage(registry.upsert_sources(store.read("sources"), entries, "source_seq"))
    enabled = registry.with_source_ids(registry.enabled_sources(valid), sources)
    active = cut_lineage(
        ranking.with_next_ids(
            enabled.select("source_seq", "source_id", "type", "base_url", "url", "terms", *registry.LIMITS),
            ["source_seq"],
            "run_id",
            store.read("scrape_runs"),
        )
    )
    # Runs are open, and stay so, if this attempt dies; the next one opens its own.
    attempt = f"{batch}.{store.next_seq()}"
    opened = runs.open_runs(active, now)
    store.commit(
        store.stage("sources", sources, attempt, whole=True),
        store.stage("scrape_runs", opened, attempt),
    )

    articles = store.read("articles")
    results = cut_lineage(plan_results(active, snapshots, redirects, store.seen_among, settings, now))
    saved = results.where(F.col("error").isNull())
    parts = cut_lineage(runs.error_parts(results))
    # The errors of a run stay in pieces; who wants them as one text joins them (runs.with_errors).
    closing = runs.run_outcomes(active, results).withColumn("error_message", F.lit(None).cast("string"))
    store.seen.grow(saved, batch)
    store.commit(
        stage_raw_html(store, saved, snapshots, now, batch),
        store.stage("articles", article_rows(saved, ["job_seq"], now, articles), batch),
        store.stage("run_error_parts", parts, batch),
        store.stage("scrape_runs", runs.finish_runs(opened, closing, now), attempt, rev=1),
    )
    return Ingest(problems, results)
