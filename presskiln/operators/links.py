"""Row expansion: listing pages, links of pages, search terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presskiln.functions import html as H
from presskiln.functions import urls as U
from presskiln.operators.skew import join_splittable


def listing_pages(df: DataFrame, url: str, max_pages: int | str, pattern: str = U.LISTING_PAGE) -> DataFrame:
    """Addresses of the pages of a listing, as ``listing_url`` with its ``page_no`` from 0.
    ``max_pages`` is a number or a column.

    A numbered listing gives ``max_pages`` consecutive pages and loses what follows the
    number; any other address gives itself.
    """
    start = df.withColumn("_start", U.normalize_url(F.col(url)))
    found = F.col("_start").rlike(pattern)
    # sequence() counts down when its end is below its start, hence the guard.
    most = F.col(max_pages) if isinstance(max_pages, str) else F.lit(max_pages)
    numbers = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
    pages = start.withColumn(
        "page_no", F.explode(F.when(found, numbers).otherwise(F.array(F.lit(0))))
    )
    base = F.regexp_extract("_start", f"(?s)^(.*?{pattern})", 1)
    stem = F.regexp_extract(base, r"(?s)^(.*/)\d+\z", 1)
    number = F.regexp_extract(base, r"(\d+)\z", 1).try_cast("decimal(38,0)")
    return pages.select(
        *df.columns,
        "page_no",
        F.when(found, F.concat(stem, (number + F.col("page_no")).cast("string")))
        .otherwise(F.col("_start"))
        .alias("listing_url"),
    )


def page_hrefs(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every quoted href of every page as ``href``; the page text is dropped at once."""
    rest = [c for c in pages.columns if c != html]
    quoted = pages.select(*rest, F.explode(H.anchors(F.col(html))).alias("_quoted"))
    return quoted.where(F.col("_quoted") != "").select(
        *rest, H.unquote_href(F.col("_quoted")).alias("href")
    )


def article_links(html: Column, base: Column, domain: str, marker: str) -> Column:
    """Array of the distinct article links of a page; ``base`` holds the parts of its address.

    Links are resolved, tested and made distinct inside the row, before they become rows of
    their own: there is no shuffle, and a test behind the explode would have Spark resolve
    each link once more for the pushed-down filter.
    """
    hrefs = F.filter(H.anchors(html), lambda quoted: quoted != "")
    resolved = F.transform(hrefs, lambda quoted: U.resolve_against(base, H.unquote_href(quoted)))
    return F.array_distinct(F.filter(resolved, lambda url: url.isNotNull() & U.is_article_url(url, domain, marker)))


def wrapped_links(html: Column) -> Column:
    """Array of the distinct wrapped article links of a search page."""
    wrapped = F.filter(H.anchors(html), lambda quoted: H.unquote_href(quoted).contains(H.WRAPPED_ARTICLE))
    urls = F.transform(wrapped, lambda quoted: U.unwrap_href(H.unquote_href(quoted)))
    return F.filter(F.array_distinct(urls), F.isnotnull)


def page_links(
    pages: DataFrame,
    base: str,
    domain: str = U.ARTICLE_DOMAIN,
    marker: str = U.ARTICLE_MARKER,
) -> DataFrame:
    """Distinct article links of every page row, resolved against column ``base``."""
    rest = [c for c in pages.columns if c != "html"]
    split = pages.withColumn("_base", U.url_parts(F.col(base)))
    return split.select(*rest, F.explode(article_links(F.col("html"), F.col("_base"), domain, marker)).alias("url"))


def search_result_links(pages: DataFrame) -> DataFrame:
    """Wrapped article links of search pages, distinct over pages with equal other columns."""
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, F.explode(wrapped_links(F.col("html"))).alias("url")).distinct()


def search_urls(sources: DataFrame, terms: str = "terms") -> DataFrame:
    """One search address per source and term."""
    rest = [c for c in sources.columns if c != terms]
    return sources.select(*rest, F.explode(terms).alias("term")).withColumn(
        "search_url", U.normalize_url(U.build_search_url(F.col("term")))
    )


def reachable(pages: DataFrame, links: DataFrame, group: str, start: Column) -> DataFrame:
    """Pages before the first one without links, which ends its listing unless it is the start.

    ``pages`` holds one row per (group, page_no), ``links`` the links found on them.
    """
    counts = links.groupBy(group, "page_no").agg(F.count("*").alias("n_links"))
    counted = pages.join(counts, [group, "page_no"], "left").withColumn(
        "n_links", F.coalesce("n_links", F.lit(0))
    )
    ends = counted.groupBy(group).agg(
        F.min(F.when((F.col("n_links") == 0) & ~start, F.col("page_no"))).alias("end_page")
    )
    return (
        join_splittable(counted, ends, group, "inner")
        .where(F.col("end_page").isNull() | (F.col("page_no") < F.col("end_page")))
        .drop("end_page")
    )
