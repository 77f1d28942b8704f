"""Queries on URLs and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from presskiln.catalog import sql as Q
from presskiln.catalog import tables as T
from presskiln.functions import urls as U
from presskiln.operators import jobs, links, ranking


def normalize_urls(spark, folder):
    """Every address in five spellings."""
    url = F.col("url")
    spellings = F.array(
        url,
        F.upper(url),
        F.concat(F.lit("  "), url, F.lit("/ ")),
        F.regexp_replace(url, "^https?:", ""),
        F.concat(F.substring_index(url, "?", 1), F.lit(";v=1")),
    )
    pages = T.read(spark, folder, "pages").select(
        "page_id", F.posexplode(spellings).alias("spelling", "raw_url")
    )
    return pages.select(
        "page_id",
        F.col("spelling").cast("long").alias("spelling"),
        "raw_url",
        U.normalize_url(F.col("raw_url")).alias("url"),
    )


def same_domain(spark, folder):
    return T.read(spark, folder, "pages").select(
        "page_id", U.is_same_domain(F.col("url"), "Example.COM").alias("same_domain")
    )


def url_paths(spark, folder):
    return T.read(spark, folder, "pages").select("page_id", U.url_path(F.col("url")).alias("path"))


def resolve_links(spark, folder):
    """Every href of every page in eight forms: as it is, absolute, relative, dead and more."""
    hrefs = links.page_hrefs(T.read(spark, folder, "pages"))
    href = F.col("href")
    forms = F.array(
        href,
        F.concat(F.lit("https://Other.example.net"), href),
        F.concat(F.lit("//Cdn.example.net"), href, F.lit("/")),
        F.concat(F.lit("sub"), href),
        F.concat(F.lit("?to="), href),
        F.concat(F.lit("#"), href),
        F.concat(F.lit("mailto:"), href),
        F.concat(F.lit("javascript:"), href),
    )
    formed = hrefs.select("page_id", U.url_parts(F.col("url")).alias("base"), F.explode(forms).alias("href"))
    resolved = U.resolve_against(F.col("base"), F.col("href"))
    return formed.select("page_id", "href", resolved.alias("url")).distinct()


def article_links(spark, folder):
    found = T.links(spark, folder)
    return found.select(
        "page_id", "url", U.is_article_url(F.col("url"), T.DOMAIN, T.MARKER).alias("is_article")
    )


def extract_links(spark, folder):
    return T.links(spark, folder, T.DOMAIN, T.MARKER).select("page_id", "url")


def sorted_links(spark, folder):
    """All distinct links with their position in sorted order."""
    distinct = T.links(spark, folder).select("url").distinct()
    return ranking.ranked(distinct, ["url"], name="position").orderBy("position")


def first_unseen(spark, folder):
    """Lowest link of a page that no page with a query in its address has."""
    found = T.links(spark, folder)
    seen = found.where(F.col("page_url").contains("?"))
    return jobs.first_unseen(found, seen, "page_id")


def listing_pages(spark, folder):
    """Five pages of a numbered listing per page of the table, and the plain page itself."""
    pages = T.read(spark, folder, "pages")
    numbered = F.concat(
        F.lit("https://"), U.url_host(F.col("url")), F.lit("/topic/t-"), F.col("page_id"), F.lit("/"),
        F.length("html"), F.lit("/more?x=1"),
    )
    starts = pages.select("page_id", F.explode(F.array(numbered, F.col("url"))).alias("start_url"))
    found = links.listing_pages(starts, "start_url", 5)
    return found.select("page_id", F.col("page_no").cast("long").alias("page_no"), "listing_url")


def search_urls(spark, folder):
    parts = T.read(spark, folder, "part").select(
        "p_partkey", F.array("p_name", F.concat_ws(" & ", "p_type", "p_brand")).alias("terms")
    )
    return links.search_urls(parts)


def unwrap_links(spark, folder):
    key = F.col("o_orderkey").cast("string")
    hrefs = F.array(
        F.concat(F.lit("./articles/"), key),
        F.concat(F.lit("https://News.Google.com/articles/"), key, F.lit("/#top")),
    )
    rows = T.read(spark, folder, "orders").select("o_orderkey", F.explode(hrefs).alias("href"))
    return rows.select("o_orderkey", "href", U.unwrap_href(F.col("href")).alias("url"))


def _search_page():
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    return F.concat(
        F.lit('<p><a class=x href="./articles/'), key, F.lit('">1</a><a href="./articles/'), key,
        F.lit("\">2</a><A HREF='https://news.google.com/articles/"), customer,
        F.lit("?a=1&amp;b=2'>3</A><a href=\"./read/"), key, F.lit('">4</a>'),
    )


def search_result_links(spark, folder):
    pages = T.read(spark, folder, "orders").select("o_orderkey", _search_page().alias("html"))
    return links.search_result_links(pages)


def resolve_redirects(spark, folder):
    """Wrapped addresses lead to their page; those of two kinds of host to the search site."""
    url = U.normalize_url(F.col("url"))
    lost = F.col("url").contains("spam-farm") | F.col("url").contains("cheap-pills")
    final = F.when(lost, F.concat(F.lit("https://www.google.com/sorry?u="), F.col("page_id"))).otherwise(
        F.col("url")
    )
    redirects = T.read(spark, folder, "pages").select(url.alias("url"), final.alias("final_url"), F.lit(None).cast("timestamp").alias("fetched_at"))
    return jobs.resolve_redirects(T.page_jobs(spark, folder).select("source_id", "url"), redirects)


QUERIES = {
    f.__name__: f
    for f in (
        normalize_urls, same_domain, url_paths, resolve_links, article_links, extract_links,
        sorted_links, first_unseen, listing_pages, search_urls, unwrap_links,
        search_result_links, resolve_redirects,
    )
}

_BASE = f"({Q.parts('page_url')}.scheme || '://' || {Q.parts('page_url')}.host)"
_FOLDER = f"regexp_replace({Q.parts('page_url')}.path, '[^/]*$', '')"
_FORMED = (
    ("href", f"{_BASE} || href"),
    ("'https://Other.example.net' || href", "'https://Other.example.net' || href"),
    ("'//Cdn.example.net' || href || '/'", f"{Q.parts('page_url')}.scheme || '://Cdn.example.net' || href || '/'"),
    ("'sub' || href", f"{_BASE} || coalesce(nullif({_FOLDER}, ''), '/') || 'sub' || href"),
    ("'?to=' || href", f"{_BASE} || {Q.parts('page_url')}.path || '?to=' || href"),
    ("'#' || href", "NULL"),
    ("'mailto:' || href", "NULL"),
    ("'javascript:' || href", "NULL"),
)
_UNION = "\nUNION\n".join(
    f"SELECT page_id, {form} AS href, {Q.normalize(target) if target != 'NULL' else 'NULL::VARCHAR'} AS url FROM plain"
    for form, target in _FORMED
)
_IS_ARTICLE = rf"(ends_with({Q.host('url')}, '{T.DOMAIN}') AND contains({Q.parts('url')}.path, '{T.MARKER}'))"

ORACLES = {
    "normalize_urls": f"""
SELECT page_id, spelling, raw_url, {Q.normalize('raw_url')} AS url FROM (
  SELECT page_id, unnest([0, 1, 2, 3, 4])::BIGINT AS spelling, unnest([
    url, upper(url), '  ' || url || '/ ', regexp_replace(url, '^https?:', ''), split_part(url, '?', 1) || ';v=1'
  ]) AS raw_url FROM pages)""",
    "same_domain": f"SELECT page_id, ends_with({Q.host('url')}, 'example.com') AS same_domain FROM pages",
    "url_paths": f"SELECT page_id, {Q.path('url')} AS path FROM pages",
    "resolve_links": Q.with_(
        Q.LINKS, f"plain AS (SELECT page_id, page_url, {Q.href('quoted')} AS href FROM hrefs WHERE quoted <> '')"
    )
    + _UNION,
    "article_links": Q.with_(Q.LINKS) + f"SELECT page_id, url, {_IS_ARTICLE} AS is_article FROM all_links",
    "extract_links": Q.with_(Q.LINKS) + f"SELECT page_id, url FROM all_links WHERE {_IS_ARTICLE}",
    "sorted_links": Q.with_(Q.LINKS)
    + "SELECT url, row_number() OVER (ORDER BY url) AS position FROM (SELECT DISTINCT url FROM all_links)",
    "first_unseen": Q.with_(Q.LINKS)
    + """SELECT page_id, min(url) AS url FROM all_links
WHERE url NOT IN (SELECT url FROM all_links WHERE contains(page_url, '?')) GROUP BY page_id""",
    "listing_pages": f"""
SELECT page_id, n AS page_no, 'https://' || {Q.host('url')} || '/topic/t-' || page_id || '/' || (length(html) + n) AS listing_url
FROM pages, (SELECT unnest([0, 1, 2, 3, 4])::BIGINT AS n)
UNION ALL SELECT page_id, 0::BIGINT, {Q.normalize('url')} FROM pages""",
    "search_urls": f"""
SELECT p_partkey, term, 'https://news.google.com/search?q=' || replace(url_encode(term), '%20', '+') || '&hl=en-GB&gl=GB&ceid=GB:en' AS search_url
FROM (SELECT p_partkey, unnest([p_name, p_type || ' & ' || p_brand]) AS term FROM part)""",
    "unwrap_links": """
SELECT o_orderkey, './articles/' || o_orderkey AS href, 'https://news.google.com/articles/' || o_orderkey AS url FROM orders
UNION ALL
SELECT o_orderkey, 'https://News.Google.com/articles/' || o_orderkey || '/#top', 'https://news.google.com/articles/' || o_orderkey FROM orders""",
    "search_result_links": """
SELECT o_orderkey, 'https://news.google.com/articles/' || o_orderkey AS url FROM orders
UNION
SELECT o_orderkey, 'https://news.google.com/articles/' || o_custkey || '?a=1&b=2' FROM orders""",
    "resolve_redirects": Q.with_(Q.JOBS)
    + f"""SELECT DISTINCT jobs.source_id, jobs.url FROM jobs
JOIN pages ON {Q.normalize('pages.url')} = jobs.url
WHERE NOT contains(pages.url, 'spam-farm') AND NOT contains(pages.url, 'cheap-pills')""",
}
