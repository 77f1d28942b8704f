"""Source registry: reading the configured lists, checking them, syncing the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presskiln.functions.urls import build_search_url, normalize_url
from presskiln.operators.ranking import with_next_ids

# Kinds of source and the defaults of missing fields.
DIRECT, LISTING, SEARCH = "direct", "link_page", "google_news"
DEFAULT_TERM = "online safety"
DEFAULT_FREQUENCY = "daily"
UNKNOWN_ROBOTS = "unknown"
MAX_PAGES = 5
# Settings of a registry document that its sources carry.
LIMITS = ("max_pages", "max_articles")


def registry_entries(registry: DataFrame) -> DataFrame:
    """One row per configured source, direct ones first, in the order of the lists.

    ``source_seq`` is that order, ``terms`` the terms a search source uses, ``max_pages`` and
    ``max_articles`` the settings of its document, ``problem`` what keeps a source from running
    (NULL if nothing does).
    """
    document = registry.withColumn("registry_seq", F.monotonically_increasing_id()).withColumns(
        {
            "max_pages": F.coalesce("settings.max_listing_pages", F.lit(MAX_PAGES)),
            "max_articles": F.col("settings.max_articles_per_source"),
        }
    )
    return entries_from_lists(
        document.select(
            "registry_seq", *LIMITS, F.posexplode("direct_sources").alias("list_seq", "item")
        ).select("registry_seq", *LIMITS, "list_seq", "item.*"),
        document.select(
            "registry_seq",
            *LIMITS,
            F.col("search_terms").alias("shared_terms"),
            F.posexplode("meta_sources").alias("list_seq", "item"),
        ).select("registry_seq", *LIMITS, "shared_terms", "list_seq", "item.*"),
    )


def entries_from_lists(direct: DataFrame, meta: DataFrame) -> DataFrame:
    """Union of both lists under one order, with defaults, base address and problems.

    Limits of a list are handed on where it has them.
    """
    common = ("name", "type", "url", "terms", "enabled", "scrape_frequency", "base_url")
    limits = [c for c in LIMITS if c in meta.columns]
    enabled = F.coalesce("enabled", F.lit(True)).alias("enabled")
    frequency = F.coalesce("scrape_frequency", F.lit(DEFAULT_FREQUENCY)).alias("scrape_frequency")
    order = F.struct(F.lit(0).alias("part"), "registry_seq", "list_seq")
    direct_rows = direct.select(
        order.alias("entry_order"),
        "name",
        F.lit(DIRECT).alias("type"),
        "url",
        F.lit(None).cast("array<string>").alias("terms"),
        enabled,
        frequency,
        *limits,
        normalize_url(F.col("url")).alias("base_url"),
    )
    own = F.coalesce("search_terms", F.array().cast("array<string>"))
    terms = F.when(F.size(own) > 0, own).otherwise(F.col("shared_terms"))
    first_term = F.coalesce(F.get(terms, F.lit(0)), F.lit(DEFAULT_TERM))
    meta_rows = meta.select(
        order.withField("part", F.lit(1)).alias("entry_order"),
        "name",
        "type",
        "url",
        F.when(F.col("type") == SEARCH, terms).alias("terms"),
        enabled,
        frequency,
        *limits,
        normalize_url(
            F.when(F.col("type") == SEARCH, build_search_url(first_term)).when(
                F.col("url") != "", F.col("url")
            )
        ).alias("base_url"),
    )
    problem = (
        F.when(F.col("base_url").isNull(), "requires a url")
        .when((F.col("type") == SEARCH) & (F.coalesce(F.size("terms"), F.lit(0)) < 1), "requires search terms")
        .when(~F.col("type").isin(DIRECT, LISTING, SEARCH), "unsupported type")
    )
    both = direct_rows.unionByName(meta_rows)
    return both.select("entry_order", *common, *limits, problem.alias("problem"))


def enabled_sources(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("enabled"))


def upsert_sources(sources: DataFrame, entries: DataFrame, order: str = "entry_order") -> DataFrame:
    """New state of the source table.

    Matched by ``base_url``: name, frequency and enabled are replaced, id and robots status
    stay. New addresses get the next ids in the order they first appear; of equal addresses
    in one registry the last wins. Rows not listed stay. The per-address aggregate is
    combined before its shuffle, so a much repeated address does no harm.
    """
    listed = (
        entries.where(F.col("base_url").isNotNull())
        .groupBy("base_url")
        .agg(
            F.min(order).alias("first_seen"),
            F.max_by(F.struct("name", "scrape_frequency", "enabled"), order).alias("last"),
        )
    )
    added = with_next_ids(
        listed.join(sources.select("base_url"), "base_url", "left_anti"),
        ["first_seen"],
        "source_id",
        sources,
    ).select(
        "source_id",
        "last.name",
        "base_url",
        F.lit(UNKNOWN_ROBOTS).alias("robots_txt_status"),
        "last.scrape_frequency",
        "last.enabled",
    )
    found = F.col("last").isNotNull()
    kept = sources.join(listed, "base_url", "left").select(
        "source_id",
        F.when(found, F.col("last.name")).otherwise(F.col("name")).alias("name"),
        "base_url",
        "robots_txt_status",
        F.when(found, F.col("last.scrape_frequency"))
        .otherwise(F.col("scrape_frequency"))
        .alias("scrape_frequency"),
        F.when(found, F.col("last.enabled")).otherwise(F.col("enabled")).alias("enabled"),
    )
    return kept.unionByName(added)


def with_source_ids(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Source id of rows that carry a ``base_url``. Spark broadcasts the table if it is small."""
    return rows.join(sources.select("base_url", "source_id"), "base_url")
