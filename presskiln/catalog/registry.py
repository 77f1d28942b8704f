"""Queries on the source registry, ids and table checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from presskiln.catalog import sql as Q
from presskiln.catalog import tables as T
from presskiln.functions.urls import normalize_url
from presskiln.operators import ranking, registry, updates


def _lists(spark, folder):
    """Registry lists: suppliers as direct sources, parts as meta sources of every kind.

    Blank and missing fields follow from the data: no balance above zero means no ``enabled``,
    and so on.
    """
    balance = F.col("s_acctbal")
    direct = T.read(spark, folder, "supplier").select(
        F.lit(0).alias("registry_seq"),
        F.lit(None).cast("array<string>").alias("search_terms"),
        F.col("s_suppkey").alias("list_seq"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("https://Nation-"), "s_nationkey", F.lit(".example.com/")).alias("url"),
        F.when(balance > 0, balance < 5000).alias("enabled"),
        F.when(balance > 2000, F.lit("hourly")).alias("scrape_frequency"),
    )
    brand = F.col("p_brand")
    meta = T.read(spark, folder, "part").select(
        F.lit(0).alias("registry_seq"),
        F.when(F.col("p_size") > 20, F.array(F.lit("shared term"))).alias("shared_terms"),
        F.col("p_partkey").alias("list_seq"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_type") == "ECONOMY", registry.LISTING)
        .when(F.col("p_type") == "SMALL", "feed")
        .otherwise(registry.SEARCH)
        .alias("type"),
        F.when(brand != "Brand#1", F.concat(F.lit("https://x.example.com/topic/"), F.replace(brand, F.lit("#"), F.lit("-")), F.lit("/1"))).alias("url"),
        (F.col("p_retailprice") > 950).alias("enabled"),
        F.lit(None).cast("string").alias("scrape_frequency"),
        F.when(F.col("p_size") > 10, F.array("p_name", "p_type")).alias("search_terms"),
    )
    return direct, meta


def _entries(spark, folder):
    entries = registry.entries_from_lists(*_lists(spark, folder))
    return entries.withColumn("terms", F.array_join("terms", "|"))


def source_registry(spark, folder):
    return _entries(spark, folder).drop("entry_order")


def _old_sources(spark, folder):
    """Sources of an earlier sync: nations of three regions."""
    return T.read(spark, folder, "nation").where(F.col("n_regionkey") <= 2).select(
        (F.col("n_nationkey") + 1).cast("long").alias("source_id"),
        F.col("n_name").alias("name"),
        normalize_url(F.concat(F.lit("https://nation-"), "n_nationkey", F.lit(".example.com"))).alias("base_url"),
        F.lit("allowed").alias("robots_txt_status"),
        F.lit("weekly").alias("scrape_frequency"),
        F.lit(True).alias("enabled"),
    )


def _synced(spark, folder):
    direct, meta = _lists(spark, folder)
    # Sources that cannot run are kept up to date like any other, where they have an address.
    return registry.upsert_sources(_old_sources(spark, folder), registry.entries_from_lists(direct, meta))


def upsert_sources(spark, folder):
    return _synced(spark, folder)


def enabled_sources(spark, folder):
    return registry.enabled_sources(_synced(spark, folder)).select("source_id", "base_url")


def job_source_ids(spark, folder):
    """Source id of every supplier's site, looked up by its base address."""
    sites = T.read(spark, folder, "supplier").select(
        "s_suppkey",
        normalize_url(F.concat(F.lit("https://NATION-"), "s_nationkey", F.lit(".example.com//"))).alias("base_url"),
    )
    return registry.with_source_ids(sites, _old_sources(spark, folder))


def next_ids(spark, folder):
    """Ids for orders going on from the customers' highest, by date."""
    new = T.read(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    customers = T.read(spark, folder, "customer").select("c_custkey")
    return ranking.with_next_ids(new, ["o_orderdate", "o_orderkey"], "new_id", customers.withColumnRenamed("c_custkey", "new_id")).select(
        "o_orderkey", "new_id"
    )


def integrity_checks(spark, folder):
    """Broken keys of three kinds, counted."""
    orders, customers = T.read(spark, folder, "orders"), T.read(spark, folder, "customer")
    lines, pages = T.read(spark, folder, "lineitem"), T.read(spark, folder, "pages")
    urls = pages.select(normalize_url(F.col("url")).alias("url"))
    checks = {
        "duplicate_url": updates.duplicate_keys(urls, "url"),
        "duplicate_line": updates.duplicate_keys(lines, "l_orderkey", "l_linenumber"),
        "orphan_order": updates.orphans(orders, customers, "o_custkey", "c_custkey"),
        "orphan_line": updates.orphans(lines, orders.where("o_orderstatus <> 'F'"), "l_orderkey", "o_orderkey"),
        "orphan_customer": updates.orphans(customers, orders, "c_custkey", "o_custkey"),
    }
    counted = [
        rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")
        for name, rows in checks.items()
    ]
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result


QUERIES = {
    f.__name__: f
    for f in (
        source_registry, upsert_sources, enabled_sources, job_source_ids, next_ids, integrity_checks,
    )
}

_ENTRIES = f"""entries AS (
  SELECT 0 AS part, s_suppkey AS seq, s_name AS name, 'direct' AS type, 'https://Nation-' || s_nationkey || '.example.com/' AS url,
    NULL::VARCHAR AS terms, CASE WHEN s_acctbal > 0 THEN s_acctbal < 5000 ELSE true END AS enabled,
    CASE WHEN s_acctbal > 2000 THEN 'hourly' ELSE 'daily' END AS scrape_frequency,
    'https://nation-' || s_nationkey || '.example.com/' AS base_url, NULL::VARCHAR AS problem
  FROM supplier
  UNION ALL
  SELECT 1, p_partkey, p_name, type, url, CASE WHEN type = 'google_news' THEN array_to_string(list, '|') END, p_retailprice > 950, 'daily',
    base_url,
    CASE WHEN base_url IS NULL THEN 'requires a url'
         WHEN type = 'google_news' AND list IS NULL THEN 'requires search terms'
         WHEN type = 'feed' THEN 'unsupported type' END
  FROM (
    SELECT *, CASE WHEN type = 'google_news'
      THEN 'https://news.google.com/search?q=' || replace(url_encode(coalesce(list[1], 'online safety')), '%20', '+') || '&hl=en-GB&gl=GB&ceid=GB:en'
      ELSE {Q.normalize('url')} END AS base_url
    FROM (
      SELECT *, CASE WHEN p_type = 'ECONOMY' THEN 'link_page' WHEN p_type = 'SMALL' THEN 'feed' ELSE 'google_news' END AS type,
        CASE WHEN p_brand <> 'Brand#1' THEN 'https://x.example.com/topic/' || replace(p_brand, '#', '-') || '/1' END AS url,
        CASE WHEN p_size > 10 THEN [p_name, p_type] WHEN p_size > 20 THEN ['shared term'] END AS list
      FROM part)))"""
_OLD = """old AS (
  SELECT (n_nationkey + 1)::BIGINT AS source_id, n_name AS name, 'https://nation-' || n_nationkey || '.example.com/' AS base_url,
    'allowed' AS robots_txt_status, 'weekly' AS scrape_frequency, true AS enabled
  FROM nation WHERE n_regionkey <= 2)"""
_SYNCED = """valid AS (SELECT *, row_number() OVER (ORDER BY part, seq) AS entry FROM entries WHERE base_url IS NOT NULL),
listed AS (
  SELECT base_url, min(entry) AS first_entry, arg_max(name, entry) AS name, arg_max(scrape_frequency, entry) AS scrape_frequency,
    arg_max(enabled, entry) AS enabled FROM valid GROUP BY base_url),
synced AS (
  SELECT old.source_id, coalesce(listed.name, old.name) AS name, old.base_url, old.robots_txt_status,
    coalesce(listed.scrape_frequency, old.scrape_frequency) AS scrape_frequency, coalesce(listed.enabled, old.enabled) AS enabled
  FROM old LEFT JOIN listed USING (base_url)
  UNION ALL
  SELECT (SELECT max(source_id) FROM old) + row_number() OVER (ORDER BY first_entry), name, base_url, 'unknown', scrape_frequency, enabled
  FROM listed WHERE base_url NOT IN (SELECT base_url FROM old))"""

ORACLES = {
    "source_registry": Q.with_(_ENTRIES)
    + "SELECT name, type, url, terms, enabled, scrape_frequency, base_url, problem FROM entries",
    "upsert_sources": Q.with_(_ENTRIES, _OLD, _SYNCED) + "SELECT * FROM synced",
    "enabled_sources": Q.with_(_ENTRIES, _OLD, _SYNCED) + "SELECT source_id, base_url FROM synced WHERE enabled",
    "job_source_ids": Q.with_(_OLD)
    + """SELECT 'https://nation-' || s_nationkey || '.example.com/' AS base_url, s_suppkey, source_id
FROM supplier JOIN old ON old.base_url = 'https://nation-' || s_nationkey || '.example.com/'""",
    "next_ids": """
SELECT o_orderkey, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS new_id FROM orders""",
    "integrity_checks": f"""
SELECT 'duplicate_url' AS "check", count(*) AS n FROM (SELECT {Q.normalize('url')} AS u FROM pages GROUP BY u HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_line', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'orphan_order', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'orphan_line', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
UNION ALL SELECT 'orphan_customer', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
}
