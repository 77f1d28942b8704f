"""Queries on seen URLs, conflicts between jobs, limits and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from presskiln.catalog import sql as Q
from presskiln.catalog import tables as T
from presskiln.operators import clicks, jobs, links, ranking

CAP, PAGES = 3, 5


def seen_urls(spark, folder):
    return jobs.seen_urls(T.stored(spark, folder))


def skip_seen(spark, folder):
    return jobs.skip_seen(T.page_jobs(spark, folder), jobs.seen_urls(T.stored(spark, folder)))


def skip_stored(spark, folder):
    """Jobs that are not stored, or whose host is a direct source (www)."""
    found = T.page_jobs(spark, folder)
    direct = found.where(F.col("host").startswith("www.")).select("url")
    return jobs.skip_stored(found, T.stored(spark, folder), direct)


def url_exists(spark, folder):
    return jobs.url_exists(T.page_jobs(spark, folder), T.stored(spark, folder))


def incremental_seen(spark, folder):
    """Seen URLs after two slices of links: of https pages, then of the others."""
    found = T.links(spark, folder)
    first = F.col("page_url").startswith("https:")
    return jobs.grow_seen(jobs.seen_urls(found.where(first)), found.where(~first))


def first_success_wins(spark, folder):
    """Jobs for the site of every page; a short page is a failure."""
    pages = T.read(spark, folder, "pages").select(
        F.concat(F.lit("https://"), F.regexp_extract("url", "//([^/]*)", 1), F.lit("/")).alias("url"),
        F.col("page_id").alias("job_seq"),
        F.col("url").contains("?").alias("allow_rescrape"),
        (F.length("html") > 2500).alias("ok"),
    )
    return jobs.first_success_wins(pages)


def limit_per_source(spark, folder):
    found = T.with_host_ids(T.links(spark, folder).select("url").distinct(), spark, folder)
    return jobs.limit_per_source(found.select("source_id", "url"), CAP)


def numbered_pages(spark, folder):
    """Pages as listing pages of their host, numbered from 0 by id."""
    pages = T.with_host_ids(T.read(spark, folder, "pages"), spark, folder)
    numbered = ranking.ranked(pages.select("source_id", "host", "page_id"), ["page_id"], ["source_id"])
    return numbered.select(
        F.col("source_id").alias("source_seq"), "host", "page_id", (F.col("rank") - 1).cast("int").alias("page_no")
    )


def pagination_stop(spark, folder):
    """Pages and their article links up to the first page of a host without any."""
    pages = numbered_pages(spark, folder)
    found = T.links(spark, folder, "", T.MARKER).join(pages, "page_id")
    kept = links.reachable(pages, found, "source_seq", F.col("page_no") == 0)
    return kept.select("source_seq", F.col("page_no").cast("long").alias("page_no"), "page_id", "n_links")


def with_targets(found, spark, folder):
    """Links with where they lead: one that ends with e leads to the last good link of its host."""
    host = F.regexp_extract("url", "//([^/]*)", 1)
    good = T.links(spark, folder).where(~F.regexp_extract("url", "//[^/]*(.*)$", 1).rlike("[.,]"))
    last = good.groupBy(host.alias("_host")).agg(F.max(F.regexp_replace("url", "^http:", "https:")).alias("_last"))
    joined = found.join(last, host == F.col("_host"), "left")
    return joined.withColumn("final_url", F.when(F.col("url").endswith("e"), F.col("_last")).otherwise(F.col("url"))).drop("_host", "_last")


def limit_of(seq):
    """The limit on articles of a source: 2, 3 or none."""
    return F.when(seq % 3 == 0, CAP).when(seq % 3 == 1, CAP - 1).cast("int")


def _candidates(spark, folder):
    """Links of numbered pages; a link with a comma is refused."""
    found = T.links(spark, folder).select("page_id", F.regexp_replace("url", "^http:", "https:").alias("url"))
    found = with_targets(found.join(numbered_pages(spark, folder), "page_id").where(F.col("page_no") < PAGES), spark, folder)
    return found.select(
        "source_seq", "page_no", "url", "final_url", (~F.col("url").contains(",")).alias("ok")
    ).distinct()


def listing_cap(spark, folder):
    """Links visited under the limit of each source."""
    visited = clicks.visited_links(_candidates(spark, folder).withColumn("max_articles", limit_of(F.col("source_seq"))))
    return visited.select("source_seq", F.col("page_no").cast("long").alias("page_no"), "url", "ok")


def listing_handover(spark, folder):
    """Three sources with the same pages, forth, back and forth: what each visits and where it stops."""
    found = _candidates(spark, folder)
    turns = [
        found.select(
            (F.col("source_seq") * 3 + k).alias("source_seq"),
            (F.lit(PAGES) - 1 - F.col("page_no") if k == 1 else F.col("page_no")).cast("int").alias("page_no"),
            "url", "final_url", "ok",
        ).withColumn("max_articles", F.lit((CAP, 1, 4)[k]))
        for k in range(3)
    ]
    walks = clicks.settled_walks(turns[0].unionByName(turns[1]).unionByName(turns[2]))
    urls = F.array_join(F.transform("visits", lambda visit: visit["url"]), "|")
    return walks.where(F.size("visits") > 0).select("source_seq", urls.alias("urls"), F.col("stop_page").cast("long").alias("stop_page"))


def redirects_as_of(spark, folder):
    """Every link followed three times: long ago to its own page, before the run to where it leads
    (with other letters in its address), and after the run."""
    links_ = T.links(spark, folder).select("page_id", "url")
    wrapped = links_.select("page_id", F.regexp_replace("url", "^https?://", "https://news.google.com/articles/").alias("url"))
    to = links_.groupBy(F.regexp_replace("url", "^https?://", "").alias("path")).agg(F.min("page_id").alias("first"))
    path, at = F.col("path"), T.run_ts()

    def row(site, final, moment):
        return to.select(F.concat(F.lit(site), path).alias("url"), final.alias("final_url"), moment.alias("fetched_at"))

    final = F.concat(F.lit("https://Site-"), F.col("first") % 7, F.lit(".example.com/"), path)
    redirects = (
        row("https://news.google.com/articles/", F.lit("https://old.example.com/"), at - F.expr("INTERVAL 9 DAYS"))
        .unionByName(row("HTTPS://News.Google.com/articles/", F.when(F.col("first") % 5 > 0, final), at - F.expr("INTERVAL 1 HOUR")))
        .unionByName(row("https://news.google.com/articles/", F.lit("https://late.example.com/"), at + F.expr("INTERVAL 1 HOUR")))
        .unionByName(row("https://news.google.com/articles/", F.lit("https://undated.example.com/"), F.lit(None).cast("timestamp")))
    )
    return jobs.resolve_redirects(wrapped, redirects, as_of=at)


QUERIES = {
    f.__name__: f
    for f in (
        seen_urls, skip_seen, skip_stored, url_exists, incremental_seen, first_success_wins,
        limit_per_source, pagination_stop, listing_cap, listing_handover, redirects_as_of,
    )
}

NUMBERED = f"""numbered AS (
  SELECT source_id AS source_seq, hosts.host, page_id, url AS page_url,
    row_number() OVER (PARTITION BY source_id ORDER BY page_id) - 1 AS page_no
  FROM pages JOIN hosts ON {Q.host('pages.url')} = hosts.host)"""


# The last good link of a host, to which its links that end with e lead.
TARGETS = f"""targets AS (
  SELECT {Q.host('url')} AS host, max(regexp_replace(url, '^http:', 'https:')) AS target FROM all_links
  WHERE NOT regexp_matches(regexp_extract(url, '//[^/]*(.*)$', 1), '[.,]') GROUP BY 1)"""
LIMIT = f"CASE source_seq % 3 WHEN 0 THEN {CAP} WHEN 1 THEN {CAP - 1} END"


def final_url(url: str) -> str:
    return f"CASE WHEN ends_with({url}, 'e') THEN (SELECT target FROM targets WHERE host = {Q.host(url)}) ELSE {url} END"


def walks(name: str, candidates: str, before: str | None = None) -> str:
    """Click by click what listing sources visit, from a CTE (source_seq, grp, cap, page_no, url,
    final_url, ok), as ``done_<name>``; of a group those of ``before`` have taken their turn."""
    start, others = "[]::VARCHAR[]", ""
    if before:
        start, others = "coalesce(b.touched, [])", f"LEFT JOIN done_{before} b ON b.grp = l.grp"
    return f"""lists_{name} AS (
  SELECT source_seq, grp, any_value(cap)::BIGINT AS cap,
    list({{'page_no': page_no, 'url': url, 'final_url': final_url, 'ok': ok}} ORDER BY page_no, url) AS links FROM {candidates} GROUP BY source_seq, grp),
walk_{name}(source_seq, grp, cap, links, i, page_no, tried, saved, touched, visits, stop_page) AS (
  SELECT l.source_seq, l.grp, l.cap, l.links, 0::BIGINT, -1::BIGINT, 0::BIGINT, 0::BIGINT, {start}, []::STRUCT(page_no BIGINT, url VARCHAR, ok BOOLEAN)[],
    CASE WHEN l.cap <= 0 THEN 0::BIGINT END
  FROM lists_{name} l {others}
  UNION ALL
  SELECT source_seq, grp, cap, links, i + 1, x.page_no, tried + visit::BIGINT, saved + (visit AND x.ok)::BIGINT,
    CASE WHEN visit THEN list_concat(touched, CASE WHEN x.ok THEN [x.url, x.final_url] ELSE [x.url] END) ELSE touched END,
    CASE WHEN visit THEN list_append(visits, {{'page_no': x.page_no, 'url': x.url, 'ok': x.ok}}) ELSE visits END,
    coalesce(stop_page, CASE WHEN saved + (visit AND x.ok)::BIGINT >= cap THEN x.page_no END)
  FROM (
    SELECT *, stop_page IS NULL AND NOT list_contains(touched, x.url) AND coalesce(tried < cap, true) AS visit
    FROM (SELECT * REPLACE (CASE WHEN links[i + 1].page_no = page_no THEN tried ELSE 0 END AS tried), links[i + 1] AS x FROM walk_{name} WHERE i < len(links)))),
done_{name} AS (SELECT * FROM walk_{name} WHERE i = len(links))"""


_CANDIDATES = f"""found AS (
  SELECT DISTINCT source_seq, page_no, url, {final_url('url')} AS final_url, NOT contains(url, ',') AS ok
  FROM (SELECT page_id, regexp_replace(url, '^http:', 'https:') AS url FROM all_links) JOIN numbered USING (page_id) WHERE page_no < {PAGES})"""

ORACLES = {
    "seen_urls": Q.with_(Q.JOBS) + "SELECT DISTINCT url FROM stored",
    "skip_seen": Q.with_(Q.JOBS)
    + "SELECT * FROM jobs WHERE allow_rescrape OR url NOT IN (SELECT url FROM stored)",
    "skip_stored": Q.with_(Q.JOBS)
    + """SELECT * FROM jobs WHERE allow_rescrape OR starts_with(host, 'www.') OR url NOT IN (SELECT url FROM stored)""",
    "url_exists": Q.with_(Q.JOBS) + "SELECT * FROM jobs WHERE url IN (SELECT url FROM stored)",
    "incremental_seen": Q.with_(Q.LINKS) + "SELECT DISTINCT url FROM all_links",
    "first_success_wins": """
SELECT url, job_seq, allow_rescrape, ok FROM (
  SELECT *, coalesce(bool_or(ok) OVER (PARTITION BY url ORDER BY job_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS done
  FROM (
    SELECT 'https://' || regexp_extract(url, '//([^/]*)', 1) || '/' AS url, page_id AS job_seq,
      contains(url, '?') AS allow_rescrape, length(html) > 2500 AS ok FROM pages))
WHERE allow_rescrape OR NOT done""",
    "limit_per_source": Q.with_(Q.HOSTS, Q.LINKS)
    + f"""SELECT source_id, url FROM (
  SELECT source_id, url, row_number() OVER (PARTITION BY source_id ORDER BY url) AS place
  FROM (SELECT DISTINCT url FROM all_links) u JOIN hosts ON {Q.host('u.url')} = hosts.host)
WHERE place <= {CAP}""",
    "pagination_stop": Q.with_(
        Q.HOSTS,
        Q.LINKS,
        NUMBERED,
        f"""counted AS (
  SELECT source_seq, page_no, numbered.page_id, count(l.url) AS n_links
  FROM numbered LEFT JOIN (SELECT * FROM all_links WHERE contains({Q.parts('url')}.path, '{T.MARKER}')) l USING (page_id)
  GROUP BY ALL)""",
    )
    + """SELECT * FROM counted WHERE page_no < coalesce(
  (SELECT min(c.page_no) FROM counted c WHERE c.source_seq = counted.source_seq AND c.n_links = 0 AND c.page_no > 0), 9223372036854775807)""",
    "listing_cap": "WITH RECURSIVE "
    + ",\n".join(
        [
            Q.HOSTS, Q.LINKS, NUMBERED, TARGETS, _CANDIDATES,
            f"turn AS (SELECT *, source_seq AS grp, {LIMIT} AS cap FROM found)",
            walks("all", "turn"),
        ]
    )
    + "\nSELECT source_seq, unnest(visits, recursive := true) FROM done_all",
    "listing_handover": "WITH RECURSIVE "
    + ",\n".join(
        [
            Q.HOSTS, Q.LINKS, NUMBERED, TARGETS, _CANDIDATES,
            *[
                f"turn{k} AS (SELECT * REPLACE (source_seq * 3 + {k} AS source_seq, {'4 - page_no' if k == 1 else 'page_no'} AS page_no), source_seq AS grp, {(CAP, 1, 4)[k]} AS cap FROM found),\n"
                + walks(str(k), f"turn{k}", str(k - 1) if k else None)
                for k in range(3)
            ],
        ]
    )
    + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT source_seq, array_to_string(list_transform(visits, lambda v: v.url), '|') AS urls, stop_page FROM done_{k} WHERE len(visits) > 0" for k in range(3)
    ),
    "redirects_as_of": Q.with_(
        Q.LINKS, "paths AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS path FROM all_links)"
    )
    + """SELECT DISTINCT page_id, 'https://site-' || (first % 7) || '.example.com/' || path AS url
FROM (SELECT *, min(page_id) OVER (PARTITION BY path) AS first FROM paths) WHERE first % 5 > 0""",
}
