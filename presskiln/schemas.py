"""Explicit schemas of every table that is read or written; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _B, _TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


SOURCES = _table(
    ("source_id", _L),
    ("name", _S),
    ("base_url", _S),
    ("robots_txt_status", _S),
    ("scrape_frequency", _S),
    ("enabled", _B),
)

SCRAPE_RUNS = _table(
    ("run_id", _L),
    ("source_id", _L),
    ("started_at", _TS),
    ("finished_at", _TS),
    ("status", _S),
    ("error_message", _S),
)

# Names and order of the columns of the article table.
ARTICLES = _table(
    ("article_id", _L),
    ("source_id", _L),
    ("url", _S),
    ("title", _S),
    ("published_at", _TS),
    ("scraped_at", _TS),
    ("content_hash", _S),
    ("s3_raw_html_path", _S),
    ("s3_text_path", _S),
)

ARTICLE_CLASSIFICATIONS = _table(
    ("article_id", _L),
    ("topic", _S),
    ("relevance_score", T.FloatType()),
    ("summary", _S),
    ("model_name", _S),
    ("classified_at", _TS),
)

# The page store: one row per source, day and content. The path of the page is a column.
RAW_HTML = _table(
    ("source_id", _L),
    ("content_hash", _S),
    ("s3_raw_html_path", _S),
    ("html", _S),
    ("scrape_date", T.DateType()),
)

# Errors of a run in bounded pieces, for runs whose whole text exceeds one Spark cell.
RUN_ERROR_PARTS = _table(
    ("run_id", _L),
    ("part_no", _L),
    ("error_message", _S),
)

TABLES = {
    "sources": SOURCES,
    "scrape_runs": SCRAPE_RUNS,
    "articles": ARTICLES,
    "article_classifications": ARTICLE_CLASSIFICATIONS,
    "raw_html": RAW_HTML,
    "run_error_parts": RUN_ERROR_PARTS,
}

# What became of every job of an ingest, in job order.
RESULTS = _table(
    ("job_seq", _L),
    ("source_seq", _L),
    ("run_id", _L),
    ("source_id", _L),
    ("page_no", T.IntegerType()),
    ("job_url", _S),
    ("url", _S),
    ("error", _S),
    ("title", _S),
    ("published_at", _TS),
    ("content_hash", _S),
    ("page_file", _S),
    ("page_row", _L),
)

SNAPSHOTS = _table(("url", _S), ("final_url", _S), ("html", _S), ("fetched_at", _TS))

# Where a link led when it was followed; a row without a time counts as the oldest.
REDIRECTS = _table(("url", _S), ("final_url", _S), ("fetched_at", _TS))

REGISTRY = _table(
    ("search_terms", T.ArrayType(_S)),
    (
        "direct_sources",
        T.ArrayType(
            _table(("name", _S), ("url", _S), ("enabled", _B), ("scrape_frequency", _S))
        ),
    ),
    (
        "meta_sources",
        T.ArrayType(
            _table(
                ("name", _S),
                ("type", _S),
                ("enabled", _B),
                ("url", _S),
                ("search_terms", T.ArrayType(_S)),
                ("scrape_frequency", _S),
            )
        ),
    ),
    (
        "settings",
        _table(("max_listing_pages", T.IntegerType()), ("max_articles_per_source", T.IntegerType())),
    ),
)
