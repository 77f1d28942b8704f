"""Queries on whole runs: direct, search and listing sources, and all of them together."""

from __future__ import annotations

from pyspark.sql import functions as F

from presskiln.catalog import jobs as J
from presskiln.catalog import sql as Q
from presskiln.catalog import tables as T
from presskiln.functions.urls import build_search_url, normalize_url, url_host
from presskiln.operators import fetch, jobs, registry
from presskiln.plans import ingest as I
from presskiln.plans import runs as R
from presskiln.schemas import SNAPSHOTS
from presskiln.session import cut_lineage

SETTINGS = R.Settings(domain="", marker="/")


def _source(seq, kind, base_url, terms=None):
    """Columns of an enabled source whose run and id are its place in the order."""
    return (
        seq.cast("long").alias("source_seq"),
        seq.cast("long").alias("run_id"),
        seq.cast("long").alias("source_id"),
        F.lit(kind).alias("type"),
        base_url.alias("base_url"),
        (F.lit(None).cast("array<string>") if terms is None else terms).alias("terms"),
        (J.PAGES - seq % 2).cast("int").alias("max_pages"),
        J.limit_of(seq).alias("max_articles"),
    )


def _direct_sources(spark, folder):
    """Every page with a query in its address."""
    pages = T.read(spark, folder, "pages").where(F.col("url").contains("?"))
    return pages.select(*_source(F.col("page_id"), registry.DIRECT, normalize_url(F.col("url"))))


def _listing_sources(spark, folder):
    """Every host twice, as a numbered listing that starts with page 0, and one with page 1."""
    hosts = T.hosts(spark, folder)

    def listing(first, seq):
        start = F.concat(F.lit("https://"), "host", F.lit(f"/topic/t/{first}"))
        return hosts.select(*_source(F.col("source_id") + seq, registry.LISTING, start))

    return listing(0, 1_000_000).unionByName(listing(1, 1_500_000))


def _search_sources(spark, folder):
    """Every page, as a search for its own title and its id."""
    term = F.concat(F.lit("page "), F.col("page_id"))
    pages = T.read(spark, folder, "pages")
    return pages.select(
        *_source(F.col("page_id") + 2_000_000, registry.SEARCH, normalize_url(F.col("url")), F.array(term))
    )


def _as_snapshots(rows, url, html, final_url=None):
    final = F.lit(None).cast("string") if final_url is None else final_url
    return rows.select(url.alias("url"), final.alias("final_url"), html.alias("html"), T.run_ts().alias("fetched_at"))


def _listing_snapshots(spark, folder):
    """Listing pages, which are the pages of a host in order, and the pages their links lead to.

    A link with a full stop has no snapshot, one with a comma a refusal page; one that ends with e
    leads to another link of its host.
    """
    texts = T.read(spark, folder, "pages").select("page_id", "html")
    numbered = J.numbered_pages(spark, folder).where(F.col("page_no") < J.PAGES).join(texts, "page_id")
    address = F.concat(F.lit("https://"), "host", F.lit("/topic/t/"), "page_no")
    url = F.col("url")
    title = F.concat(F.when(url.contains(","), "Access denied ").otherwise(""), F.regexp_extract(url, "([^/]*)$", 1))
    targets = T.links(spark, folder).select(F.regexp_replace("url", "^http:", "https:").alias("url")).distinct()
    targets = J.with_targets(targets.where(~F.regexp_extract(url, "//[^/]*(.*)$", 1).contains(".")), spark, folder)
    page = F.concat(F.lit("<html><title>"), title, F.lit("</title></html>"))
    return _as_snapshots(numbered, address, F.col("html")).unionByName(_as_snapshots(targets, url, page, F.col("final_url")))


def _search_snapshots(spark, folder):
    """Search pages: each page with its links turned into wrapped ones."""
    address = build_search_url(F.concat(F.lit("page "), F.col("page_id")))
    wrapped = F.replace(F.col("html"), F.lit('href="/'), F.lit('href="./articles/'))
    return _as_snapshots(T.read(spark, folder, "pages"), address, wrapped)


def _redirects(spark, folder):
    """A wrapped link leads to the first page address, in sorted order, that has the link; it led
    elsewhere before, and does after the run."""
    path = F.regexp_replace("url", "^https?://[^/]*/", "https://news.google.com/articles/")
    now = T.links(spark, folder).groupBy(path.alias("url")).agg(F.min("page_url").alias("final_url"))
    before = now.select(F.replace("url", F.lit("news.google"), F.lit("News.Google")).alias("url"), F.lit("https://old.example.com").alias("final_url"))
    day = F.expr("INTERVAL 1 DAY")
    return (
        now.withColumn("fetched_at", T.run_ts())
        .unionByName(before.withColumn("fetched_at", T.run_ts() - day))
        .unionByName(before.withColumn("fetched_at", T.run_ts() + day))
    )


def _seen(spark, folder):
    """Stored before: pages of https addresses on hosts named www, and links in capitals."""
    www = T.stored(spark, folder).where(url_host(F.col("url")).startswith("www."))
    capital = T.links(spark, folder).select("url").where(F.col("url").rlike("//[^/]*/[A-Z]"))
    return www.union(capital).distinct()


def run_direct(spark, folder):
    snapshots = T.snapshots(spark, folder)
    due = jobs.skip_seen(R.direct_jobs(_direct_sources(spark, folder)), T.stored(spark, folder))
    results = R.run_fixed(due, fetch.wanted_facts(due, snapshots))
    return results.select("source_seq", "url", "title", "content_hash", "outcome", "error")


def run_search(spark, folder):
    snapshots = T.stored_snapshots(T.snapshots(spark, folder).select(*SNAPSHOTS.names).unionByName(_search_snapshots(spark, folder)))
    read = cut_lineage(R.expanded(R.link_pages(_search_sources(spark, folder)), snapshots, SETTINGS))
    found = R.search_jobs(read, _redirects(spark, folder), T.run_ts())
    due = cut_lineage(jobs.skip_seen(found, _seen(spark, folder)))
    results = R.run_fixed(due, fetch.wanted_facts(due, snapshots))
    return results.select("source_seq", "url", "title", "outcome", "error")


def run_listing(spark, folder):
    """Visited links, and the listing pages that are missing before a source has enough."""
    snapshots = T.stored_snapshots(_listing_snapshots(spark, folder))
    read = cut_lineage(R.expanded(R.link_pages(_listing_sources(spark, folder)), snapshots, SETTINGS))
    fresh = cut_lineage(jobs.skip_seen(R.listing_links(read), _seen(spark, folder)))
    visited, walks = R.run_listing(fresh, fetch.wanted_facts(fresh, snapshots))
    failed = R.failed_pages(read, walks).withColumn("outcome", F.lit("no page"))
    return visited.unionByName(failed.drop("error"), allowMissingColumns=True).select(
        "source_seq", F.col("page_no").cast("long").alias("page_no"), "url", "final_url", "title", "outcome"
    )


def ingest(spark, folder):
    """All three kinds of source in one run: saved pages and errors in job order."""
    sources = (
        _direct_sources(spark, folder)
        .unionByName(_listing_sources(spark, folder))
        .unionByName(_search_sources(spark, folder))
    )
    snapshots = T.stored_snapshots(
        T.snapshots(spark, folder).select(*SNAPSHOTS.names)
        .unionByName(_listing_snapshots(spark, folder))
        .unionByName(_search_snapshots(spark, folder))
    )
    results = I.plan_results(
        cut_lineage(sources), snapshots, _redirects(spark, folder), _seen(spark, folder), SETTINGS, T.run_ts()
    )
    return results.select("job_seq", "source_seq", "url", "title", "content_hash", "error")


QUERIES = {f.__name__: f for f in (run_direct, run_search, run_listing, ingest)}

_OUTCOME = """CASE WHEN f.url IS NULL THEN 'missing' WHEN f.denied THEN 'denied' ELSE 'ok' END"""
_ERROR = """{url} || ': ' || CASE WHEN f.url IS NULL THEN 'no snapshot' WHEN f.denied THEN 'Site blocked automated access' END"""
_SEEN = f"""seen AS (
  SELECT {Q.normalize('url')} AS url FROM pages WHERE starts_with(url, 'https:') AND starts_with({Q.host('url')}, 'www.')
  UNION SELECT url FROM all_links WHERE regexp_matches(url, '//[^/]*/[A-Z]'))"""
_DIRECT = f"""direct AS (
  SELECT page_id AS source_seq, f.title, f.content_hash, {Q.normalize('pages.url')} AS url, {_OUTCOME} AS outcome,
    {_ERROR.format(url=Q.normalize('pages.url'))} AS error
  FROM pages LEFT JOIN facts f ON f.url = {Q.normalize('pages.url')} WHERE contains(pages.url, '?'))"""
_SEARCH = f"""redirects AS (
  SELECT regexp_replace(url, '^https?://[^/]*/', 'https://news.google.com/articles/') AS url, min(page_url) AS final_url FROM all_links GROUP BY 1),
searched AS (
  SELECT DISTINCT page_id + 2000000 AS source_seq, {Q.normalize('final_url')} AS url
  FROM all_links JOIN redirects ON redirects.url = regexp_replace(all_links.url, '^https?://[^/]*/', 'https://news.google.com/articles/')
  WHERE NOT contains(final_url, 'google.com')),
limited AS (
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY source_seq ORDER BY url) AS place FROM searched)
  WHERE coalesce(place <= {J.LIMIT}, true)),
tried AS (
  SELECT source_seq, limited.url, f.title, f.content_hash, {_OUTCOME} AS outcome, {_ERROR.format(url='limited.url')} AS error
  FROM limited LEFT JOIN facts f ON f.url = limited.url
  WHERE limited.url NOT IN (SELECT url FROM seen)),
search AS (
  SELECT * EXCLUDE (done) FROM (
    SELECT *, coalesce(bool_or(outcome = 'ok') OVER (PARTITION BY url ORDER BY source_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS done
    FROM tried) WHERE NOT done)"""
_OUTCOME_OF_LINK = "CASE WHEN contains(regexp_extract(url, '//[^/]*(.*)$', 1), '.') THEN 'missing' WHEN contains(url, ',') THEN 'denied' ELSE 'ok' END"


def _turn(k):
    """Links of the k-th listing sources, which begin with page k."""
    return f"""turn{k} AS (
  SELECT *, {J.LIMIT} AS cap, {J.final_url('url')} AS final_url, {_OUTCOME_OF_LINK} = 'ok' AS ok FROM (
    SELECT DISTINCT source_seq + {1_000_000 + 500_000 * k} AS source_seq, source_seq AS grp, page_no - {k} AS page_no, regexp_replace(url, '^http:', 'https:') AS url
    FROM all_links JOIN numbered USING (page_id) WHERE page_no < {J.PAGES} AND page_no >= {k})
  WHERE url NOT IN (SELECT url FROM seen) AND page_no < {J.PAGES} - source_seq % 2)"""


_LISTING = f"""{J.NUMBERED},
{J.TARGETS},
{_turn(0)},
{J.walks('first', 'turn0')},
{_turn(1)},
{J.walks('second', 'turn1', 'first')},
both_turns AS (SELECT * FROM done_first UNION ALL SELECT * FROM done_second),
visited AS (SELECT source_seq, unnest(visits, recursive := true) FROM both_turns),
listing AS (
  SELECT source_seq, page_no, url, {_OUTCOME_OF_LINK} AS outcome,
    CASE WHEN {_OUTCOME_OF_LINK} <> 'missing' THEN {J.final_url('url')} END AS final_url,
    CASE WHEN {_OUTCOME_OF_LINK} <> 'missing'
      THEN CASE WHEN contains(url, ',') THEN 'Access denied ' ELSE '' END || regexp_extract(url, '([^/]*)$', 1) END AS title
  FROM visited),
lost AS (
  SELECT source_seq, n AS page_no, url FROM (
    SELECT source_id + 1000000 + 500000 * k AS source_seq, source_id, n, n + k AS place, 'https://' || host || '/topic/t/' || (n + k) AS url
    FROM hosts, (SELECT unnest([0, 1]) AS k), (SELECT unnest(range({J.PAGES})) AS n)) s
  WHERE n < {J.PAGES} - source_seq % 2 AND (place >= {J.PAGES} OR place >= (SELECT count(*) FROM numbered WHERE numbered.source_seq = s.source_id))
    AND n <= coalesce((SELECT stop_page FROM both_turns b WHERE b.source_seq = s.source_seq), 99))"""
_EVERYTHING = f"""jobs AS (
  SELECT source_seq, 0 AS page_no, 1 AS step, url, title, content_hash, error FROM direct
  UNION ALL SELECT source_seq, 0, 1, url, title, content_hash, error FROM search
    WHERE url NOT IN (SELECT url FROM direct WHERE outcome = 'ok')
  UNION ALL SELECT source_seq, page_no, 1, url, title, sha256('<html><title>' || title || '</title></html>'), NULL
    FROM listing WHERE outcome = 'ok'
  UNION ALL SELECT source_seq, page_no, 0, url, NULL, NULL, url || ': no snapshot' FROM lost),
named AS (
  SELECT j.* REPLACE (coalesce(l.final_url, j.url) AS url), j.url AS job_url FROM jobs j
  LEFT JOIN listing l ON step = 1 AND l.source_seq = j.source_seq AND l.page_no = j.page_no AND l.url = j.url)"""

ORACLES = {
    "run_direct": Q.with_(Q.SNAPSHOTS, _DIRECT)
    + "SELECT source_seq, url, title, content_hash, outcome, error FROM direct",
    "run_search": Q.with_(Q.LINKS, Q.SNAPSHOTS, _SEEN, _SEARCH)
    + "SELECT source_seq, url, title, outcome, error FROM search",
    "run_listing": "WITH RECURSIVE "
    + ",\n".join([Q.HOSTS, Q.LINKS, _SEEN, _LISTING])
    + """
SELECT source_seq, page_no, url, final_url, title, outcome FROM listing
UNION ALL SELECT source_seq, page_no, url, NULL, NULL, 'no page' FROM lost""",
    "ingest": "WITH RECURSIVE "
    + ",\n".join([Q.HOSTS, Q.LINKS, Q.SNAPSHOTS, _SEEN, _DIRECT, _SEARCH, _LISTING, _EVERYTHING])
    + """
SELECT row_number() OVER (ORDER BY source_seq, page_no, step, job_url) AS job_seq, source_seq, url, title, content_hash, error FROM named""",
}
