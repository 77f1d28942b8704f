"""Page fetch as a join: keys of snapshots first, texts of wanted pages by their address."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from presskiln.functions import html as H
from presskiln.functions.content import content_hash
from presskiln.functions.urls import normalize_url
from presskiln.operators.skew import join_splittable
from presskiln.session import cut_lineage

# Outcomes of a job and the reason texts of the failed ones.
OK, DENIED, MISSING = "ok", "denied", "missing"
MISSING_TEXT = "no snapshot"
DENIED_TEXT = "Site blocked automated access"

# Where the text of a page lies: its file and its row there (see ``sources.files.addressed``).
ADDRESS = ["page_file", "page_row"]
# Rows of a file that are looked up together, and chosen rows that are broadcast at a time.
SPAN_ROWS = BLOCK_ROWS = 1 << 20


def address_of(pages: DataFrame) -> list[str]:
    """The address, where the rows carry it."""
    return [c for c in ADDRESS if c in pages.columns]


def _moment(column: str) -> Column:
    """Time of a snapshot; one without a time is the oldest, and still equal to itself."""
    return F.coalesce(column, F.timestamp_seconds(F.lit(0)))


def page_keys(snapshots: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """What is known of pages without their text: only narrow columns are read."""
    return snapshots.select(
        *keep,
        normalize_url(F.col("url")).alias("url"),
        F.col("url").alias("snapshot_url"),
        _moment("fetched_at").alias("fetched_at"),
        normalize_url(F.coalesce("final_url", "url")).alias("final_url"),
        *address_of(snapshots),
    )


def text_facts(html: Column) -> list[Column]:
    """What the pipeline needs to know of the text of a page."""
    title = H.extract_title(html)
    return [
        title.alias("title"),
        H.published_at(html).alias("published_at"),
        content_hash(html).alias("content_hash"),
        H.is_access_denied(title, html).alias("denied"),
    ]


def page_facts(snapshots: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keys and facts of all pages, without their text.

    One pass over the scan, no shuffle: the text is read, turned into a few hundred bytes
    and dropped before anything is joined. Columns in ``keep`` are passed on.
    """
    keys = page_keys(snapshots.select("*", F.struct(*text_facts(F.col("html"))).alias("_facts")), [*keep, "_facts"])
    return keys.select(*[c for c in keys.columns if c != "_facts"], "_facts.*")


def one_per_url(pages: DataFrame, latest: bool = True, by_content: bool = False) -> DataFrame:
    """One snapshot per normalised URL, the latest or the earliest.

    An aggregate that is combined before its shuffle, so a URL with a great many snapshots
    sends one row per task. Of equal times the snapshot URL and then the address decide; with
    ``by_content``, for facts of all texts, the content hash goes before these.
    """
    rest = [c for c in pages.columns if c != "url"]
    pick = F.max_by if latest else F.min_by
    first = ["fetched_at", "content_hash"] if by_content else ["fetched_at"]
    chosen = pick(F.struct(*rest), F.struct(*first, "snapshot_url", *address_of(pages)))
    return (
        pages.where(F.col("url").isNotNull())
        .groupBy("url")
        .agg(chosen.alias("page"))
        .select("url", "page.*")
    )


def wanted_keys(urls: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The latest snapshot of every wanted URL that has one, still without its text."""
    wanted = urls.select("url").where(F.col("url").isNotNull()).distinct()
    return one_per_url(join_splittable(page_keys(snapshots), wanted, "url", "left_semi"))


def wanted_facts(urls: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Keys and facts of the latest snapshots of wanted URLs; no other text is looked at."""
    chosen = cut_lineage(wanted_keys(urls, snapshots))
    facts = page_texts(chosen, snapshots).withColumn("_facts", F.struct(*text_facts(F.col("html"))))
    return facts.select(*chosen.columns, "_facts.*")


def fetch(jobs: DataFrame, facts: DataFrame) -> DataFrame:
    """Jobs with the facts of their page, an ``outcome`` and the ``error`` of failed ones."""
    found = join_splittable(jobs, facts.withColumn("_found", F.lit(True)), "url", "left")
    return found.withColumns(
        {"outcome": outcome(F.col("_found"), F.col("denied")), "error": error(F.col("_found"), F.col("denied"))}
    ).drop("_found")


def outcome(found: Column, denied: Column) -> Column:
    return F.when(found.isNull(), MISSING).when(denied, DENIED).otherwise(OK)


def error(found: Column, denied: Column) -> Column:
    """Error text of a job for ``url``; NULL where it went well."""
    reason = F.when(found.isNull(), MISSING_TEXT).when(denied, DENIED_TEXT)
    return F.concat(F.col("url"), F.lit(": "), reason)


def _blocks(spans: Sequence[Row], most: int) -> Iterator[list[Row]]:
    """Spans of files in order, cut where ``most`` chosen rows are reached."""
    block: list[Row] = []
    for span in spans:
        if block and sum(s["n"] for s in block) + span["n"] > most:
            yield block
            block = []
        block.append(span)
    if block:
        yield block


def page_texts(chosen: DataFrame, snapshots: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of ``chosen`` with the text of their page as ``html``; only files that hold such
    pages are read, and texts of other pages are dropped where they are read.

    ``chosen`` names pages by ADDRESS and must not change from one use to the next (checkpoint
    it). The number of chosen rows by file is known first. The narrow chosen rows are broadcast,
    BLOCK_ROWS at most at a time together with the files they are in, so no exchange or sort
    carries a text. Only the list of files comes to the driver.
    """
    span = F.floor(F.col("page_row") / SPAN_ROWS)
    spans = chosen.groupBy("page_file", span.alias("span")).agg(F.count("*").alias("n")).collect()
    spans.sort(key=lambda s: (s["page_file"], s["span"]))
    parts = []
    for block in _blocks(spans, block_rows):
        files = sorted({s["page_file"] for s in block})
        texts = snapshots.where(F.col("page_file").isin(files)).select(*ADDRESS, "html")
        mine = chosen
        if len(block) < len(spans):
            mine = chosen.where(F.concat_ws(":", span.cast("string"), "page_file").isin([f"{s['span']}:{s['page_file']}" for s in block]))
        parts.append(texts.join(F.broadcast(mine), ADDRESS).select(*chosen.columns, "html"))
    if not parts:
        return chosen.where(F.lit(False)).withColumn("html", F.lit(None).cast("string"))
    return reduce(DataFrame.unionAll, parts)
