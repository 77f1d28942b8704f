"""Which job URLs are to be fetched: seen filters, conflicts between jobs, limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presskiln.functions.urls import normalize_url
from presskiln.operators.ranking import top_n
from presskiln.operators.skew import join_splittable


def seen_urls(articles: DataFrame) -> DataFrame:
    """Distinct stored URLs, blank ones left out; reads one column."""
    return articles.select("url").where(F.col("url").isNotNull() & (F.col("url") != "")).distinct()


def url_exists(jobs: DataFrame, articles: DataFrame) -> DataFrame:
    return join_splittable(jobs, seen_urls(articles), "url", "left_semi")


def skip_seen(jobs: DataFrame, seen: DataFrame) -> DataFrame:
    """Jobs whose URL is not in ``seen``; rescraped jobs always stay."""
    marked = seen.select("url").distinct().withColumn("_seen", F.lit(True))
    kept = join_splittable(jobs, marked, "url", "left")
    return kept.where(F.col("allow_rescrape") | F.col("_seen").isNull()).select(*jobs.columns)


def skip_stored(jobs: DataFrame, articles: DataFrame, direct_urls: DataFrame) -> DataFrame:
    """Second guard: drop jobs that are stored, unless their URL is a direct source."""
    guarded = seen_urls(articles).join(direct_urls.select("url"), "url", "left_anti")
    return skip_seen(jobs, guarded)


def first_success_wins(jobs: DataFrame, ok: str = "ok", order: str = "job_seq") -> DataFrame:
    """Drop a job if an earlier one with its URL succeeded; failures block nothing.

    The earliest success per URL is an aggregate combined before its shuffle. A window over
    the jobs of a URL would put a URL that most jobs share into one task.
    """
    first = (
        jobs.where(F.col(ok)).groupBy("url").agg(F.min(order).alias("_first_ok"))
    )
    return (
        join_splittable(jobs, first, "url", "left")
        .where(
            F.col("allow_rescrape")
            | F.col("_first_ok").isNull()
            | (F.col(order) <= F.col("_first_ok"))
        )
        .select(*jobs.columns)
    )


def limit_per_source(jobs: DataFrame, n: int | str | None, source: str = "source_id") -> DataFrame:
    """First ``n`` jobs of a source by URL, before any seen filter; none or <= 0 is no limit.
    ``n`` may be a column of the jobs."""
    return top_n(jobs, [source], ["url"], n)


def first_unseen(links: DataFrame, seen: DataFrame, page: str) -> DataFrame:
    """Lowest URL of every page that is not seen yet."""
    fresh = join_splittable(links, seen.select("url"), "url", "left_anti")
    return fresh.groupBy(page).agg(F.min("url").alias("url"))


def grow_seen(seen: DataFrame, saved: DataFrame) -> DataFrame:
    return seen.select("url").union(saved.select("url")).distinct()


def latest_redirects(redirects: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Where every normalised link led when it was last followed, up to ``as_of``.

    Rows without a time are the oldest; of equal times the greatest address counts, a failed
    attempt (no final URL) before any. Combined before its shuffle.
    """
    at = F.coalesce("fetched_at", F.timestamp_seconds(F.lit(0)))
    known = redirects if as_of is None else redirects.where(at <= as_of)
    rows = known.select(normalize_url(F.col("url")).alias("url"), at.alias("_at"), normalize_url(F.col("final_url")).alias("_final"))
    return (
        rows.where(F.col("url").isNotNull())
        .groupBy("url")
        .agg(F.max(F.struct("_at", F.col("_final").isNull().alias("failed"), "_final")).alias("_last"))
        .select("url", F.col("_last._final").alias("_final"))
    )


def resolve_redirects(
    wrapped: DataFrame, redirects: DataFrame, dropped_text: str = "google.com", as_of: Column | None = None
) -> DataFrame:
    """Final, normalised URL of wrapped links; unresolved ones and those of the search site go.

    Of several rows of a link the latest counts, up to ``as_of``. ``dropped_text`` is looked for
    anywhere in the final URL. Distinct per other columns.
    """
    rest = [c for c in wrapped.columns if c != "url"]
    return (
        join_splittable(wrapped, latest_redirects(redirects, as_of), "url", "inner")
        .where(F.col("_final").isNotNull() & ~F.col("_final").contains(dropped_text))
        .select(*rest, F.col("_final").alias("url"))
        .distinct()
    )
