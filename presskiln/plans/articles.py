"""From saved pages to article rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presskiln.functions.content import raw_path
from presskiln.operators.ranking import with_next_ids
from presskiln.operators.updates import conform
from presskiln.schemas import ARTICLES


def article_rows(
    saved: DataFrame, order: Sequence[str], scraped_at: Column, articles: DataFrame | None = None
) -> DataFrame:
    """Article rows of saved pages with ids that go on from ``articles``, in ``order``."""
    needed = dict.fromkeys(["source_id", "url", "title", "published_at", "content_hash", *order])
    numbered = with_next_ids(saved.select(*needed), order, "article_id", articles)
    path = raw_path(F.col("source_id"), F.to_date(scraped_at), F.col("content_hash"))
    return conform(numbered.withColumns({"scraped_at": scraped_at, "s3_raw_html_path": path}), ARTICLES)
