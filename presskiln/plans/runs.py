"""The jobs of a run by kind of source.

Sources arrive as (source_seq, run_id, source_id, type, base_url, url, terms, max_pages,
max_articles), one row per enabled source; the last two are its limits (NULL articles: none). Jobs
leave as (source_seq, run_id, source_id, page_no, url, allow_rescrape); (source_seq, page_no, url)
is the order the jobs of a run are taken in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presskiln.functions import html as H
from presskiln.functions import urls as U
from presskiln.operators import clicks, fetch, jobs, links
from presskiln.operators.registry import DIRECT, LISTING, SEARCH
from presskiln.operators.skew import join_splittable
from presskiln.session import cut_lineage

RUN = ["source_seq", "run_id", "source_id"]
ORDER = ["source_seq", "page_no", "url"]


@dataclass(frozen=True)
class Settings:
    """What an article link looks like on the pages of listings."""

    domain: str = U.ARTICLE_DOMAIN
    marker: str = U.ARTICLE_MARKER


def _jobs(rows: DataFrame, rescrape: bool, *more: str) -> DataFrame:
    page_no = F.col("page_no") if "page_no" in rows.columns else F.lit(0)
    return rows.select(
        *RUN, page_no.cast("int").alias("page_no"), "url", F.lit(rescrape).alias("allow_rescrape"), *more
    )


def direct_jobs(sources: DataFrame) -> DataFrame:
    """One job per direct source, fetched on every run."""
    return _jobs(sources.where(F.col("type") == DIRECT).withColumn("url", F.col("base_url")), True)


def link_pages(sources: DataFrame) -> DataFrame:
    """The pages sources get their links from: of searches one per term, of listings all in order."""
    kept = [*RUN, "type", "max_articles"]
    wanted = links.search_urls(sources.where(F.col("type") == SEARCH).select(*kept, "terms"))
    searches = wanted.select(*kept, F.lit(0).alias("page_no"), F.col("search_url").alias("url")).distinct()
    listings = sources.where(F.col("type") == LISTING).select(*kept, "max_pages", "base_url")
    pages = links.listing_pages(listings, "base_url", "max_pages")
    return searches.unionByName(pages.select(*kept, "page_no", F.col("listing_url").alias("url")))


def expanded(pages: DataFrame, snapshots: DataFrame, settings: Settings) -> DataFrame:
    """``pages`` with the distinct ``links`` of their text, or an ``error`` where a page is missing
    or refused. The text of these pages, and of no others, is read once."""
    known = fetch.wanted_keys(pages, snapshots).withColumn("_found", F.lit(True))
    # Lineage is cut: what is chosen is used twice and must be the same both times.
    looked_up = cut_lineage(join_splittable(pages, known, "url", "left"))
    texts = fetch.page_texts(looked_up.where("_found"), snapshots)
    html, address = F.col("html"), F.col("_base")
    found = F.when(F.col("type") == SEARCH, links.wrapped_links(html)).otherwise(
        links.article_links(html, address, settings.domain, settings.marker)
    )
    denied = H.is_access_denied(H.extract_title(html), html)
    read = texts.withColumn("_base", U.url_parts(F.col("url"))).withColumn("denied", denied)
    read = read.select(
        *pages.columns, fetch.error(F.col("_found"), F.col("denied")).alias("error"), F.when(~F.col("denied"), found).alias("links")
    )
    lost = looked_up.where("_found is null").select(
        *pages.columns, fetch.error(F.col("_found"), F.lit(None).cast("boolean")).alias("error"), F.lit(None).cast("array<string>").alias("links")
    )
    return read.unionByName(lost)


def search_jobs(read: DataFrame, redirects: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Jobs of search sources after the limit, from their pages with links."""
    wrapped = read.where(F.col("type") == SEARCH).select(*RUN, "max_articles", F.explode("links").alias("url")).distinct()
    found = jobs.resolve_redirects(wrapped, redirects, as_of=as_of)
    return jobs.limit_per_source(_jobs(found, False, "max_articles"), "max_articles", "source_seq").drop("max_articles")


def listing_links(read: DataFrame) -> DataFrame:
    """Article links of listing sources by page, with the limit of their source."""
    found = read.where(F.col("type") == LISTING).select(*RUN, "max_articles", "page_no", F.explode("links").alias("url"))
    return _jobs(found, False, "max_articles")


def collect_article_urls(found: DataFrame, pages: DataFrame, start_page: int = 0) -> DataFrame:
    """Links of the pages up to the first empty one; used where links are wanted, not visits."""
    kept = links.reachable(pages, found, "source_seq", F.col("page_no") == start_page)
    return found.join(kept.select("source_seq", "page_no"), ["source_seq", "page_no"], "left_semi")


def run_fixed(due: DataFrame, facts: DataFrame) -> DataFrame:
    """Direct and search jobs that are due (not stored), with their outcome; what an earlier job of
    this ingest fetched is left out."""
    results = fetch.fetch(due, facts).withColumns(
        {"ok": F.col("outcome") == fetch.OK, "job_order": F.struct(*ORDER)}
    )
    return jobs.first_success_wins(results, "ok", "job_order").drop("job_order")


def run_listing(fresh: DataFrame, facts: DataFrame, taken: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Links that listing sources visit, with their outcome, and the walks of the sources, which
    tell the page each of them stopped at.

    ``fresh`` holds the links that are not stored. ``taken`` holds the URLs direct and search jobs
    fetch, with the ``source_seq`` of the first to do so: later listing sources do not visit them.
    """
    if taken is not None:
        first = taken.select("url", F.col("source_seq").alias("_taken_by"))
        fresh = join_splittable(fresh, first, "url", "left").where("_taken_by is null or _taken_by >= source_seq").drop("_taken_by")
    candidates = cut_lineage(fetch.fetch(fresh, facts).withColumn("ok", F.col("outcome") == fetch.OK))
    walks = clicks.settled_walks(candidates)
    visited = candidates.join(clicks.visits_of(walks), ORDER, "left_semi")
    return visited, walks


def failed_pages(read: DataFrame, walks: DataFrame) -> DataFrame:
    """Search and listing pages that could not be had, as failed results. A listing source that had
    enough does not go on to its further pages, so they are no errors."""
    stops = walks.select("source_seq", "stop_page")
    reached = read.where(F.col("error").isNotNull()).join(stops, "source_seq", "left")
    none_wanted = (F.col("type") == LISTING) & (F.col("max_articles") <= 0)
    last = F.when(none_wanted, 0).otherwise(F.col("stop_page"))
    return reached.where(last.isNull() | (F.col("page_no") <= last)).select(*RUN, "page_no", "url", "error")
