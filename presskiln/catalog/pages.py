"""Queries on page content, article rows and table forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from presskiln import schemas
from presskiln.catalog import sql as Q
from presskiln.catalog import tables as T
from presskiln.functions import content, dates, html
from presskiln.operators import fetch, updates
from presskiln.plans.articles import article_rows
from presskiln.sources import files, raw_html


def scan_tables(spark, folder):
    return T.read(spark, folder, "pages")


def content_hashes(spark, folder):
    return T.read(spark, folder, "pages").select(
        "page_id", content.content_hash(F.col("html")).alias("content_hash")
    )


def extract_titles(spark, folder):
    return T.read(spark, folder, "pages").select(
        "page_id", html.extract_title(F.col("html")).alias("title")
    )


def access_denied(spark, folder):
    """Pages as they are, as refusal pages, and as pages that only mention a refusal."""
    page = F.col("html")
    forms = F.array(
        page,
        F.replace(page, F.lit("<title>"), F.lit("<title>ACCESS Denied ")),
        F.concat(page, F.lit("<p>Access denied</p>")),
    )
    rows = T.read(spark, folder, "pages").select("page_id", F.posexplode(forms).alias("form", "html"))
    denied = html.is_access_denied(html.extract_title(F.col("html")), F.col("html"))
    return rows.select("page_id", F.col("form").cast("long").alias("form"), denied.alias("denied"))


def _saved_pages(spark, folder, by_content=False):
    """Good pages, one per normalised address, with the source their host is."""
    facts = fetch.one_per_url(fetch.page_facts(T.snapshots(spark, folder)), by_content=by_content)
    return T.with_host_ids(facts.where(~F.col("denied")), spark, folder)


def build_articles(spark, folder):
    rows = article_rows(_saved_pages(spark, folder), ["source_id", "url"], T.run_ts())
    return T.plain(rows)


def raw_html_keys(spark, folder):
    keys = raw_html.raw_keys(_saved_pages(spark, folder, by_content=True), T.run_ts())
    return keys.withColumn("scrape_date", F.date_format("scrape_date", "yyyy-MM-dd"))


def append_articles(spark, folder):
    """Stored articles with new rows behind them that know only some columns."""
    old = updates.conform(
        T.read(spark, folder, "pages").where(F.col("url").startswith("https:")).select(
            F.col("page_id").alias("article_id"), "url", html.extract_title(F.col("html")).alias("title")
        ),
        schemas.ARTICLES,
    )
    new = T.read(spark, folder, "pages").where(~F.col("url").startswith("https:")).select(
        F.col("page_id").alias("article_id"), "url", F.length("html").alias("extra")
    )
    return updates.append_rows(old, new).select("article_id", "url", "title", "content_hash")


def csv_export(spark, folder):
    """Run log rows in their CSV form."""
    failed = F.col("event_type") == "error"
    rows = T.read(spark, folder, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("user_id").alias("source_id"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.when(~failed, F.date_trunc("minute", "ts")).cast("timestamp").alias("finished_at"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.col("props")).alias("error_message"),
        (~failed).alias("enabled"),
    )
    return files.csv_rows(rows)




def _dated_page():
    """A page per order; its priority decides where and how the order date is written."""
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    words = F.date_format("o_orderdate", "d MMMM yyyy")
    kind = F.col("o_orderpriority")
    return (
        F.when(
            kind == "1-URGENT",
            F.concat(F.lit('<META property="article:published_time" data-x content="'), iso, F.lit('">')),
        )
        .when(
            kind == "2-HIGH",
            F.concat(
                F.lit('<meta property="article:published_time" content="soon"><meta name=\'pubdate\' content=\''),
                words,
                F.lit("'>"),
            ),
        )
        .when(kind == "3-MEDIUM", F.concat(F.lit('<meta name="publish-date" content="'), day, F.lit('">')))
        .when(
            kind == "4-NOT SPECIFIED",
            F.concat(F.lit('<time class="t" datetime="'), day, F.lit('">x</time>')),
        )
        .otherwise(F.lit('<meta charset="utf-8"><title>none</title>'))
    )


def published_dates(spark, folder):
    rows = T.read(spark, folder, "orders").select("o_orderkey", html.published_at(_dated_page()).alias("published_at"))
    return T.plain(rows)


def _json_ld_page():
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.col("o_orderpriority")
    body = (
        F.when(kind == "1-URGENT", F.concat(F.lit('{"datePublished": "'), iso, F.lit('", "dateCreated": "1970-01-01"}')))
        .when(kind == "2-HIGH", F.concat(F.lit('[7, {"name": "x"}, {"datePublished": "", "dateCreated": "'), iso, F.lit('"}]')))
        .when(kind == "3-MEDIUM", F.concat(F.lit('{"dateCreated": "'), iso, F.lit('"}')))
        .when(kind == "4-NOT SPECIFIED", F.concat(F.lit('{"datePublished": 7, "dateCreated": "'), iso, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"datePublished": "'), iso))
    )
    return F.concat(F.lit("<html><script id=a type='application/ld+json'>\n"), body, F.lit("\n</script></html>"))


def jsonld_dates(spark, folder):
    rows = T.read(spark, folder, "orders").select("o_orderkey", html.published_at(_json_ld_page()).alias("published_at"))
    return T.plain(rows)


# Layouts of one date: text pattern for Spark, for the compared SQL, and whether it can be read.
_LAYOUTS = (
    ("yyyy-MM-dd", "%Y-%m-%d"),
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("yyyyMMdd", "%Y%m%d"),
    ("d MMMM yyyy", "%-d %B %Y"),
    ("MMM d, yyyy", "%b %-d, %Y"),
    ("yyyy/M/d", "%Y/%-m/%-d"),
)


def parse_dates(spark, folder):
    """Every order date written in several layouts, behind a weekday too, and unreadable."""
    written = [F.date_format("o_orderdate", layout) for layout, _ in _LAYOUTS]
    texts = F.array(
        *written, F.concat(F.lit("Friday, "), written[3]), F.date_format("o_orderdate", "HH:mm"), F.lit("")
    )
    rows = T.read(spark, folder, "orders").select("o_orderkey", F.explode(texts).alias("text"))
    parsed = rows.select(
        "o_orderkey",
        "text",
        dates.parse_date(F.col("text")).alias("parsed"),
        dates.parse_iso(F.when(F.col("text").rlike("^[0-9]{4}-"), F.col("text")).otherwise("")).alias("iso"),
    )
    return T.plain(parsed)


def fetch_join(spark, folder):
    """Jobs for all pages and all links; most links have no snapshot."""
    links = T.links(spark, folder).select("url")
    wanted = T.page_jobs(spark, folder).select("url").union(links).distinct()
    facts = fetch.one_per_url(fetch.page_facts(T.snapshots(spark, folder)), by_content=True)
    return fetch.fetch(wanted, facts).select("url", "title", "content_hash", "outcome", "error")


def fetch_outcomes(spark, folder):
    """Outcomes per host; refused and missing pages are counted, not raised."""
    fetched = fetch_join(spark, folder).withColumn("host", F.regexp_extract("url", "//([^/]*)", 1))
    return fetched.groupBy("host", "outcome").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_tables, content_hashes, extract_titles, access_denied, build_articles, raw_html_keys,
        append_articles, csv_export, published_dates, jsonld_dates, parse_dates, fetch_join,
        fetch_outcomes,
    )
}

_FORMS = """forms AS (
  SELECT page_id, unnest([0, 1, 2])::BIGINT AS form, unnest([
    html, replace(html, '<title>', '<title>ACCESS Denied '), html || '<p>Access denied</p>']) AS html FROM pages)"""
_SAVED = f"saved AS (SELECT facts.*, source_id FROM facts JOIN hosts ON {Q.host('facts.url')} = hosts.host WHERE NOT denied)"
_WANTED = f"""wanted AS (SELECT {Q.normalize('url')} AS url FROM pages UNION SELECT url FROM all_links),
fetched AS (
  SELECT wanted.url, title, content_hash,
    CASE WHEN facts.url IS NULL THEN 'missing' WHEN denied THEN 'denied' ELSE 'ok' END AS outcome,
    wanted.url || ': ' || CASE WHEN facts.url IS NULL THEN 'no snapshot' WHEN denied THEN 'Site blocked automated access' END AS error
  FROM wanted LEFT JOIN facts ON wanted.url = facts.url)"""
_ISO = """strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({0}) % 1000000 <> 0 THEN strftime({0}, '.%f') ELSE '' END || '+00:00'"""

ORACLES = {
    "scan_tables": "SELECT page_id, url, html FROM pages",
    "content_hashes": "SELECT page_id, sha256(html) AS content_hash FROM pages",
    "extract_titles": f"SELECT page_id, {Q.title('html')} AS title FROM pages",
    "access_denied": Q.with_(_FORMS)
    + f"SELECT page_id, form, {Q.denied(Q.title('html'), 'html')} AS denied FROM forms",
    "build_articles": Q.with_(Q.HOSTS, Q.SNAPSHOTS, _SAVED)
    + f"""SELECT row_number() OVER (ORDER BY source_id, url) AS article_id, source_id, url, title,
  NULL::TIMESTAMP AS published_at, TIMESTAMP '{Q.RUN_TS}' AS scraped_at, content_hash,
  {Q.raw_path('source_id', 'content_hash')} AS s3_raw_html_path, NULL::VARCHAR AS s3_text_path FROM saved""",
    "raw_html_keys": Q.with_(Q.HOSTS, Q.SNAPSHOTS_BY_CONTENT, _SAVED)
    + f"""SELECT DISTINCT source_id, '{Q.RUN_TS[:10]}' AS scrape_date, content_hash,
  {Q.raw_path('source_id', 'content_hash')} AS s3_raw_html_path FROM saved""",
    "append_articles": f"""
SELECT page_id AS article_id, url, {Q.title('html')} AS title, NULL::VARCHAR AS content_hash FROM pages WHERE starts_with(url, 'https:')
UNION ALL
SELECT page_id, url, NULL, NULL FROM pages WHERE NOT starts_with(url, 'https:')""",
    "csv_export": f"""
SELECT event_id::VARCHAR AS run_id, user_id::VARCHAR AS source_id, {_ISO.format('ts')} AS started_at,
  CASE WHEN event_type = 'error' THEN '' ELSE strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S+00:00') END AS finished_at,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN event_type = 'error' THEN coalesce(props, '') ELSE '' END AS error_message,
  CASE WHEN event_type = 'error' THEN 'false' ELSE 'true' END AS enabled
FROM events""",
    "published_dates": """
SELECT o_orderkey, CASE
  WHEN o_orderpriority = '1-URGENT' THEN date_trunc('second', o_orderdate)
  WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') THEN date_trunc('day', o_orderdate)::TIMESTAMP
  END::TIMESTAMP AS published_at FROM orders""",
    "jsonld_dates": """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  THEN date_trunc('second', o_orderdate) END::TIMESTAMP AS published_at FROM orders""",
    "parse_dates": "\nUNION ALL\n".join(
        [
            f"SELECT o_orderkey, strftime(o_orderdate, '{form}') AS text, "
            f"{'date_trunc($$second$$, o_orderdate)' if 'HH' in layout else 'o_orderdate::DATE'}::TIMESTAMP AS parsed, "
            f"{('date_trunc($$second$$, o_orderdate)' if 'HH' in layout else 'o_orderdate::DATE') if layout.startswith('yyyy-') else 'NULL'}::TIMESTAMP AS iso FROM orders"
            for layout, form in _LAYOUTS
        ]
        + [
            "SELECT o_orderkey, 'Friday, ' || strftime(o_orderdate, '%-d %B %Y'), o_orderdate::DATE::TIMESTAMP, NULL::TIMESTAMP FROM orders",
            "SELECT o_orderkey, strftime(o_orderdate, '%H:%M'), NULL::TIMESTAMP, NULL::TIMESTAMP FROM orders",
            "SELECT o_orderkey, '', NULL::TIMESTAMP, NULL::TIMESTAMP FROM orders",
        ]
    ),
    "fetch_join": Q.with_(Q.LINKS, Q.SNAPSHOTS_BY_CONTENT, _WANTED)
    + "SELECT url, title, content_hash, outcome, error FROM fetched",
    "fetch_outcomes": Q.with_(Q.LINKS, Q.SNAPSHOTS_BY_CONTENT, _WANTED)
    + "SELECT regexp_extract(url, '//([^/]*)', 1) AS host, outcome, count(*) AS n FROM fetched GROUP BY ALL",
}
