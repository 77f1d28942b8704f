"""The test tables with explicit schemas, and inputs that several queries derive from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presskiln.functions.urls import normalize_url, url_host
from presskiln.operators.fetch import ADDRESS
from presskiln.operators.links import page_links
from presskiln.operators.ranking import with_next_ids
from presskiln.schemas import SNAPSHOTS
from presskiln.session import tune, written_to
from presskiln.sources.files import addressed, read_snapshots

SCHEMAS = {
    "pages": "page_id long, url string, html string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

# The moment all runs of the queries take place, and the first day of the event log.
RUN_TS = "2024-05-01 08:30:00"
LOG_START = "2024-01-01"
DOMAIN, MARKER = "example.com", "/t"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return tune(spark).read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the compared SQL gives them (the session is in UTC)."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as snapshots; a page whose address has a fragment is a refusal page."""
    refused = F.replace(F.col("html"), F.lit("<title>"), F.lit("<title>Access Denied "))
    return addressed(read(spark, folder, "pages")).select(
        "url",
        F.lit(None).cast("string").alias("final_url"),
        F.when(F.col("url").contains("#"), refused).otherwise(F.col("html")).alias("html"),
        run_ts().alias("fetched_at"),
        *ADDRESS,
    )


def stored_snapshots(rows: DataFrame) -> DataFrame:
    """Snapshots as a table of their own, the form a run finds them in."""
    names = SNAPSHOTS.names
    return read_snapshots(rows.sparkSession, written_to(rows.select(*names), "snapshots"))


def hosts(spark: SparkSession, folder: str) -> DataFrame:
    """Hosts of the pages as sources, with dense ids in their order."""
    names = read(spark, folder, "pages").select(url_host(F.col("url")).alias("host")).distinct()
    return with_next_ids(names, ["host"], "source_id")


def with_host_ids(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    return df.withColumn("host", url_host(F.col("url"))).join(hosts(spark, folder), "host")


def links(spark: SparkSession, folder: str, domain: str = "", marker: str = "/") -> DataFrame:
    """Distinct links (page_id, url) of all pages."""
    pages = read(spark, folder, "pages").withColumnRenamed("url", "page_url")
    return page_links(pages, "page_url", domain, marker).select("page_id", "page_url", "url")


def page_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """One job per page, under its host; pages with a query may be fetched again."""
    jobs = read(spark, folder, "pages").select(
        normalize_url(F.col("url")).alias("url"),
        F.col("page_id").alias("job_seq"),
        F.col("url").contains("?").alias("allow_rescrape"),
    )
    return with_host_ids(jobs, spark, folder)


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """Stored articles: the pages of https addresses."""
    pages = read(spark, folder, "pages").where(F.col("url").startswith("https:"))
    return pages.select(normalize_url(F.col("url")).alias("url"))

