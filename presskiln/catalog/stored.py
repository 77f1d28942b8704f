"""Queries that write tables and read them back: store, page store, seen URLs, runs, registry, stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from presskiln import schemas
from presskiln.catalog import registry as G
from presskiln.catalog import runs as L
from presskiln.catalog import sql as Q
from presskiln.catalog import tables as T
from presskiln.functions.urls import url_host
from presskiln.operators import fetch, registry, runs, updates
from presskiln.plans.articles import article_rows
from presskiln.session import cut_lineage, new_folder
from presskiln.sources import files, raw_html
from presskiln.sources.seen import SeenUrls
from presskiln.sources.store import ArticleStore
from presskiln.streaming import incremental

RUN = datetime.fromisoformat(T.RUN_TS)


def stored_articles(spark, folder):
    """Good pages stored in two batches, those of https addresses first, each committed twice: ids
    go on from batch to batch, the second time changes nothing, and every article leads to its page."""
    store = ArticleStore(spark, new_folder(spark, "articles"))
    snapshots = T.snapshots(spark, folder)
    facts = fetch.one_per_url(fetch.page_facts(snapshots)).where(~F.col("denied"))
    facts = cut_lineage(T.with_host_ids(facts, spark, folder))
    for batch, mine in (("a", F.col("url").startswith("https:")), ("b", ~F.col("url").startswith("https:"))) * 2:
        if store.is_committed(batch, "articles"):
            continue
        saved = facts.where(mine)
        rows = article_rows(saved, ["source_id", "url"], T.run_ts(), store.read("articles"))
        store.commit(store.stage("articles", rows, batch), raw_html.stage_raw_html(store, saved, snapshots, T.run_ts(), batch))
    pages = store.read("raw_html").select("s3_raw_html_path", F.length("html").alias("n_chars"))
    found = store.read("articles").join(pages, "s3_raw_html_path", "left")
    return T.plain(found.select("article_id", "source_id", "url", "title", "scraped_at", "s3_raw_html_path", F.col("n_chars").cast("long").alias("n_chars")))


def seen_between_runs(spark, folder):
    """URLs kept over two runs, links of https pages first: the second adds what it does not find.

    A third batch is not committed: its URLs do not count."""
    seen = SeenUrls(spark, new_folder(spark, "seen"), buckets=16)
    links = T.links(spark, folder)
    secure = F.col("page_url").startswith("https:")
    done = []
    for batch, found in (("one", links.where(secure)), ("two", links), ("lost", links.select(F.concat("url", F.lit("?new")).alias("url")))):
        urls = cut_lineage(found.select("url").distinct())
        known = seen.among(urls, spark.createDataFrame(done, "batch string"))
        seen.grow(urls.join(known, "url", "left_anti"), batch)
        done += [(batch,)] if batch != "lost" else []
    asked = links.select("url").union(links.select(F.concat("url", F.lit("?new")))).distinct()
    known = seen.among(asked, spark.createDataFrame(done, "batch string"))
    return known.join(spark.table(seen.table), "url").select("url", "batch")


def close_runs(spark, folder):
    """The run log as a table in folders by run; closing failed runs replaces theirs only."""
    path = new_folder(spark, "runs") + "/log"
    updates.write_bucketed(L._opened(spark, folder), path, "run_id")
    closing = L._closing(spark, folder).where(F.col("status") == runs.FAILED)
    closing = closing.select("run_id", T.run_ts().alias("finished_at"), "status", "error_message")
    updates.update_bucketed(spark, path, schemas.SCRAPE_RUNS, cut_lineage(closing), "run_id")
    return T.plain(updates.read_bucketed(spark, path, schemas.SCRAPE_RUNS))


def registry_documents(spark, folder):
    """Registry documents, one for each kind of part, written as JSON and read again: every source
    with the settings of its document."""
    meta = G._lists(spark, folder)[1].join(
        T.read(spark, folder, "part").select(F.col("p_partkey").alias("list_seq"), "p_type", "p_size"), "list_seq"
    )
    item = F.struct("list_seq", "name", "type", "enabled", "url", "search_terms", "scrape_frequency")
    documents = meta.groupBy("p_type").agg(F.array_sort(F.collect_list(item)).alias("meta_sources"), F.min("p_size").alias("least"), F.count("*").alias("n"))
    documents = documents.select(
        F.array(F.lower("p_type")).alias("search_terms"),
        F.array(
            F.struct(F.col("p_type").alias("name"), F.concat(F.lit("https://"), "p_type", F.lit(".example.com/")).alias("url"))
        ).alias("direct_sources"),
        F.transform("meta_sources", lambda x: x.dropFields("list_seq")).alias("meta_sources"),
        F.struct(
            F.when(F.col("n") % 2 == 0, F.col("n") % 7).alias("max_listing_pages"), F.when(F.col("n") % 3 > 0, F.col("n") % 11).alias("max_articles_per_source")
        ).alias("settings"),
    )
    path = f"{new_folder(spark, 'registry')}/documents"
    documents.write.json(path)
    entries = registry.registry_entries(files.read_registry(spark, path, lines=True))
    return entries.withColumn("terms", F.array_join("terms", "|")).select(
        "name", "type", "url", "terms", "enabled", "scrape_frequency", "base_url", "max_pages", "max_articles", "problem"
    )


def stream_runs(spark, folder):
    """Pages that arrive in two files are taken in by a stream: articles and the run of each source
    and file, with its errors; a refused page leaves one."""
    root = new_folder(spark, "stream")
    pages = T.snapshots(spark, folder).withColumn("host", url_host(F.col("url"))).join(T.hosts(spark, folder), "host")
    second = F.length("html") % 2 == 1
    for mine in (~second, second):
        pages.where(mine).select(*incremental.ARRIVALS.names).coalesce(1).write.mode("append").parquet(f"{root}/incoming")
        incremental.start(spark, f"{root}/incoming", f"{root}/store", f"{root}/state", RUN, max_files=1).awaitTermination()
    store = ArticleStore(spark, f"{root}/store")
    log = runs.with_errors(store.read("scrape_runs"), store.read("run_error_parts"))
    stored = store.read("articles").groupBy("source_id").agg(F.count("*").alias("articles"), F.max("article_id").alias("last_id"))
    return T.plain(log.join(stored, "source_id", "left"))


QUERIES = {f.__name__: f for f in (stored_articles, seen_between_runs, close_runs, registry_documents, stream_runs)}

_SAVED = f"saved AS (SELECT facts.*, source_id FROM facts JOIN hosts ON {Q.host('facts.url')} = hosts.host WHERE NOT denied)"

ORACLES = {
    "stored_articles": Q.with_(Q.HOSTS, Q.SNAPSHOTS, _SAVED)
    + f"""SELECT row_number() OVER (ORDER BY starts_with(url, 'https:') DESC, source_id, url) AS article_id, source_id, url, title,
  TIMESTAMP '{T.RUN_TS}' AS scraped_at, {Q.raw_path('source_id', 'content_hash')} AS s3_raw_html_path,
  (SELECT any_value(length(html)) FROM snaps WHERE sha256(snaps.html) = saved.content_hash) AS n_chars
FROM saved""",
    "seen_between_runs": Q.with_(Q.LINKS)
    + "SELECT url, CASE WHEN bool_or(starts_with(page_url, 'https:')) THEN 'one' ELSE 'two' END AS batch FROM all_links GROUP BY url",
    "close_runs": L.ORACLES["finish_runs"],
    "registry_documents": f"""WITH lists AS (
  SELECT *, CASE WHEN p_type = 'ECONOMY' THEN 'link_page' WHEN p_type = 'SMALL' THEN 'feed' ELSE 'google_news' END AS type,
    CASE WHEN p_brand <> 'Brand#1' THEN 'https://x.example.com/topic/' || replace(p_brand, '#', '-') || '/1' END AS url,
    CASE WHEN p_size > 10 THEN [p_name, p_type] ELSE [lower(p_type)] END AS list
  FROM part),
documents AS (SELECT p_type, count(*) AS n FROM part GROUP BY p_type),
entries AS (
  SELECT p_type, p_name AS name, type, url, CASE WHEN type = 'google_news' THEN array_to_string(list, '|') END AS terms, p_retailprice > 950 AS enabled,
    'daily' AS scrape_frequency, CASE WHEN type = 'google_news'
      THEN 'https://news.google.com/search?q=' || replace(url_encode(list[1]), '%20', '+') || '&hl=en-GB&gl=GB&ceid=GB:en'
      ELSE {Q.normalize('url')} END AS base_url FROM lists
  UNION ALL
  SELECT p_type, p_type, 'direct', 'https://' || p_type || '.example.com/', NULL, true, 'daily', 'https://' || lower(p_type) || '.example.com/' FROM documents)
SELECT name, type, url, terms, enabled, scrape_frequency, base_url, (CASE WHEN n % 2 = 0 THEN n % 7 ELSE 5 END)::INT AS max_pages,
  (CASE WHEN n % 3 > 0 THEN n % 11 END)::INT AS max_articles,
  CASE WHEN base_url IS NULL THEN 'requires a url' WHEN type = 'feed' THEN 'unsupported type' END AS problem
FROM entries JOIN documents USING (p_type)""",
    "stream_runs": Q.with_(
        Q.HOSTS,
        Q.SNAPSHOTS,
        f"""arrived AS (
  SELECT described.*, source_id, length(snaps.html) % 2 AS part FROM described JOIN snaps ON snaps.url = described.snapshot_url
  JOIN hosts ON {Q.host('described.url')} = hosts.host),
firsts AS (
  SELECT url, min(part) AS part, min(source_id) AS source_id FROM arrived WHERE NOT denied GROUP BY url),
refused AS (
  SELECT a.* FROM arrived a LEFT JOIN firsts USING (url) WHERE denied AND coalesce(a.part < firsts.part, true)),
runs AS (SELECT *, row_number() OVER (ORDER BY part, source_id) AS run_id FROM (SELECT DISTINCT part, source_id FROM arrived)),
errors AS (
  SELECT part, source_id, count(*) AS n, string_agg(url || ': Site blocked automated access', '; ' ORDER BY url, snapshot_url) AS error_message
  FROM refused GROUP BY part, source_id),
ids AS (SELECT *, row_number() OVER (ORDER BY part, source_id, url) AS article_id FROM firsts),
stored AS (SELECT source_id, count(*) AS articles, max(article_id) AS last_id FROM ids GROUP BY source_id),
saved AS (SELECT part, source_id, count(*) AS n FROM firsts GROUP BY part, source_id)""",
    )
    + f"""SELECT run_id, runs.source_id, TIMESTAMP '{T.RUN_TS}' AS started_at, TIMESTAMP '{T.RUN_TS}' AS finished_at,
  CASE WHEN errors.n IS NULL THEN 'success' WHEN saved.n > 0 THEN 'partial' ELSE 'failed' END AS status, error_message, articles, last_id
FROM runs LEFT JOIN errors ON errors.part = runs.part AND errors.source_id = runs.source_id
LEFT JOIN saved ON saved.part = runs.part AND saved.source_id = runs.source_id LEFT JOIN stored ON stored.source_id = runs.source_id""",
}
