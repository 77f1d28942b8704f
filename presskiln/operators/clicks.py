"""Listing runs: which links of the listing pages are visited under the caps of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presskiln.operators.skew import join_splittable
from presskiln.session import cut_lineage

_STEP = "struct<page_no: int, url: string, final_url: string, ok: boolean>"


def _visit(cap: Column):
    """One step of a source: its next link, in order of page and URL."""

    def step(at: Column, link: Column) -> Column:
        tried = F.when(at["page_no"] == link["page_no"], at["tried"]).otherwise(0)
        fresh = ~F.array_contains(at["touched"], link["url"])
        visit = at["stop_page"].isNull() & fresh & (cap.isNull() | (tried < cap))
        saved = at["saved"] + (visit & link["ok"]).cast("int")
        # Without a cap a link stands in the list once, and only where links lead to can recur.
        target = F.when(link["ok"] & (link["final_url"] != link["url"]), F.array(link["final_url"])).otherwise(F.array().cast("array<string>"))
        touched = F.when(cap.isNull(), target).otherwise(F.array_append(target, link["url"]))
        return F.struct(
            link["page_no"].alias("page_no"),
            (tried + visit.cast("int")).alias("tried"),
            saved.alias("saved"),
            F.when(visit, F.concat(at["touched"], touched)).otherwise(at["touched"]).alias("touched"),
            F.when(visit, F.array_append(at["visits"], link)).otherwise(at["visits"]).alias("visits"),
            F.coalesce(at["stop_page"], F.when(saved >= cap, link["page_no"])).alias("stop_page"),
        )

    return step


def _start(cap: Column) -> Column:
    return F.struct(
        F.lit(-1).alias("page_no"), F.lit(0).alias("tried"), F.lit(0).alias("saved"),
        F.array().cast("array<string>").alias("touched"), F.array().cast(f"array<{_STEP}>").alias("visits"),
        F.when(cap <= 0, 0).cast("int").alias("stop_page"),
    )


def walk(links: DataFrame) -> DataFrame:
    """One row per source: the ``visits`` of its run and the ``stop_page`` at which it had enough
    (NULL: it went on to the end).

    ``links`` holds (source_seq, max_articles, page_no, url, final_url, ok). Pages are taken in order
    and their links by URL; a visited link and the page it leads to are not visited again. With a
    cap a source stops at that many successes and leaves a page after that many attempts; a cap of
    0 or less visits nothing. A run is a fold over the links of its source, which come out of its
    listing pages, one cell each.
    """
    once = F.min("page_no").over(Window.partitionBy("source_seq", "url"))
    needed = links.withColumn("_once", once).where(F.col("max_articles").isNotNull() | (F.col("page_no") == F.col("_once")))
    link = F.struct("page_no", "url", "final_url", "ok").cast(_STEP)
    lists = needed.groupBy("source_seq").agg(
        F.first("max_articles").alias("max_articles"), F.array_sort(F.collect_list(link)).alias("links")
    )
    cap = F.col("max_articles")
    run = F.aggregate("links", _start(cap), _visit(cap), lambda at: F.struct(at["visits"].alias("visits"), at["stop_page"].alias("stop_page")))
    return lists.select("source_seq", run.alias("run")).select("source_seq", "run.*")


def _touched(walks: DataFrame) -> DataFrame:
    """URLs sources visited or were led to."""
    visits = walks.select("source_seq", F.explode("visits").alias("visit")).select("source_seq", "visit.*")
    return visits.select("source_seq", F.explode(F.when(F.col("ok"), F.array("url", "final_url")).otherwise(F.array("url"))).alias("url"))


def _mark(walks: DataFrame) -> tuple:
    """Number and combined hash of all visits: equal for equal visits."""
    visits = walks.select("source_seq", F.explode("visits").alias("visit"))
    return tuple(visits.agg(F.count("*"), F.bit_xor(F.xxhash64("source_seq", "visit"))).first())


def settled_walks(links: DataFrame) -> DataFrame:
    """``walk`` of sources that take their turns in order: a link an earlier source touched is not
    visited by later ones, and one it left to them under its cap is.

    All sources walk at once, then again without what earlier ones touched, until nothing changes.
    The first k sources are settled after k rounds at the latest; without a link that two sources
    touch there is one.
    """
    links = cut_lineage(links.select("source_seq", "max_articles", "page_no", "url", "final_url", "ok"))
    walks = cut_lineage(walk(links))
    shared = _touched(walks).groupBy("url").agg(F.min("source_seq").alias("a"), F.max("source_seq").alias("b"))
    if shared.where("a < b").isEmpty():
        return walks
    before = None
    while before != (before := _mark(walks)):
        first = _touched(walks).groupBy("url").agg(F.min("source_seq").alias("_by"))
        left = join_splittable(links, first, "url", "left").where("_by is null or _by >= source_seq")
        walks = cut_lineage(walk(left.select(*links.columns)))
    return walks


def visits_of(walks: DataFrame) -> DataFrame:
    """(source_seq, page_no, url) of all visits."""
    return walks.select("source_seq", F.explode("visits").alias("visit")).select("source_seq", "visit.page_no", "visit.url")


def visited_links(candidates: DataFrame) -> DataFrame:
    """Rows of ``candidates`` (as ``links`` of ``walk``, with more columns) that are visited."""
    return candidates.join(visits_of(settled_walks(candidates)), ["source_seq", "page_no", "url"], "left_semi")
