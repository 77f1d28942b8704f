"""The page store: one copy per source, day and content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presskiln.functions.content import raw_path
from presskiln.operators.fetch import ADDRESS, page_texts
from presskiln.session import cut_lineage
from presskiln.sources.store import ArticleStore

KEY = ["source_id", "scrape_date", "content_hash"]


def raw_keys(pages: DataFrame, scraped_at: Column) -> DataFrame:
    """Distinct keys of pages with the path each is stored under; the text is not needed."""
    day = F.to_date(scraped_at)
    return (
        pages.select("source_id", day.alias("scrape_date"), "content_hash")
        .distinct()
        .withColumn("s3_raw_html_path", raw_path(F.col("source_id"), F.col("scrape_date"), F.col("content_hash")))
    )


def pages_to_store(saved: DataFrame, stored: DataFrame, scraped_at: Column) -> DataFrame:
    """One snapshot per key that is not stored yet, still without its text.

    Equal keys mean equal text, so leaving a stored page alone is the same as writing it
    again. The aggregate is combined before its shuffle: content that a third of all pages
    share sends one narrow row per task.
    """
    day = F.to_date(scraped_at)
    chosen = saved.groupBy("source_id", "content_hash").agg(
        F.min(F.struct(*ADDRESS)).alias("at")
    )
    dated = chosen.select("source_id", day.alias("scrape_date"), "content_hash", "at.*")
    return dated.join(stored.select(*KEY), KEY, "left_anti")


def stage_raw_html(
    store: ArticleStore, saved: DataFrame, snapshots: DataFrame, scraped_at: Column, batch: str
) -> tuple:
    """Write the pages of ``saved`` that are new, by day.

    What is written is settled on keys first; only then are texts fetched, once. A folder per
    source would mean millions of small files: rows are sorted by source inside a file
    instead, so a reader of one source skips the row groups of the others, and a source of
    any size is spread over all files.
    """
    stored = store.read("raw_html").where(F.col("scrape_date") == F.to_date(scraped_at))
    texts = page_texts(cut_lineage(pages_to_store(saved, stored, scraped_at)), snapshots)
    path = raw_path(F.col("source_id"), F.col("scrape_date"), F.col("content_hash"))
    rows = texts.withColumn("s3_raw_html_path", path)
    return store.stage(
        "raw_html", rows.sortWithinPartitions("scrape_date", "source_id"), batch, by=["scrape_date"]
    )
