"""Plans that must hold at any size: what is read, what is shuffled, how skew is split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from presskiln.operators import clicks, fetch, jobs, ranking
from presskiln.schemas import SNAPSHOTS
from presskiln.session import cut_lineage
from presskiln.sources.files import read_snapshots
from presskiln.sources.seen import SeenUrls


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = {}

    def put(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_url_is_split_at_run_time(spark, conf, tmp_path):
    """A third of all jobs share a URL: the joins of fetch, seen and conflicts split it."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="16",
    )
    hot = F.when(F.col("id") % 3 == 0, F.lit("https://h/hot")).otherwise(F.concat(F.lit("https://h/"), F.col("id")))
    path = str(tmp_path / "jobs")
    spark.range(0, 60000, 1, 8).select(
        hot.alias("url"), F.col("id").alias("job_seq"), (F.col("id") % 5 > 0).alias("ok"), F.lit(False).alias("allow_rescrape"),
        F.sha2(F.col("id").cast("string"), 512).alias("ballast"),
    ).write.parquet(path)
    found = spark.read.parquet(path)
    other = spark.range(0, 60000, 2, 4).select(F.concat(F.lit("https://h/"), F.col("id")).alias("url"))
    facts = other.groupBy("url").agg(F.lit(False).alias("denied"))
    for result in (
        jobs.skip_seen(found, other),
        jobs.first_success_wins(found),
        jobs.url_exists(found, other),
        fetch.fetch(found, facts),
    ):
        result.collect()
        assert "skew=true" in plan_of(result), plan_of(result)


def test_page_facts_need_no_shuffle_and_links_read_once(spark):
    snaps = spark.createDataFrame([("https://h/a", None, "<title>t</title>", None)], SNAPSHOTS)
    assert "Exchange" not in plan_of(fetch.page_facts(snaps))


def test_seen_reads_one_column(spark, tmp_path):
    path = str(tmp_path / "articles")
    spark.createDataFrame([(1, "u", "t")], "article_id long, url string, title string").write.parquet(path)
    plan = plan_of(jobs.seen_urls(spark.read.parquet(path)))
    assert "ReadSchema: struct<url:string>" in plan and "PushedFilters: [IsNotNull(url)" in plan


def test_no_exchange_or_sort_carries_texts(spark, conf, tmp_path):
    """Texts of chosen pages stay where they are read, even where Spark broadcasts nothing by
    itself; files without a chosen page are not opened; no key is worked out from a text."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    path = str(tmp_path / "snaps")
    spark.range(0, 60, 1, 6).select(
        F.concat(F.lit("https://h/"), "id").alias("url"), F.lit(None).cast("string").alias("final_url"),
        F.concat(F.lit("<title>t"), "id", F.lit("</title>")).alias("html"), F.lit(None).cast("timestamp").alias("fetched_at"),
    ).write.parquet(path)
    snaps = read_snapshots(spark, path)
    wanted = spark.range(11, 16).select(F.concat(F.lit("https://h/"), "id").alias("url"))
    keys = plan_of(fetch.wanted_keys(wanted, snaps))
    assert "html" not in keys
    chosen = cut_lineage(fetch.wanted_keys(wanted, snaps))
    for most in (1 << 20, 2):  # one block, and several
        texts = fetch.page_texts(chosen, snaps, most)
        assert sorted(r.html for r in texts.collect()) == [f"<title>t{k}</title>" for k in range(11, 16)]
        plan = plan_of(texts)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "sha2" not in plan
        assert "Exchange hashpartitioning" not in plan and "Sort " not in plan
    scans = [m for leaf in leaves(texts) if (m := leaf.metrics()).contains("numFiles")]
    assert sum(m.apply("numFiles").value() for m in scans) == 1
    assert fetch.page_texts(chosen.where("url = 'none'"), snaps).collect() == []


def leaves(df):
    found = df._jdf.queryExecution().executedPlan().collectLeaves().iterator()
    while found.hasNext():
        yield found.next()


def test_a_listing_run_takes_a_fixed_number_of_jobs(spark):
    """No loop over pages: as many jobs for 40 listing pages as for two."""
    tracker = spark.sparkContext.statusTracker()

    def jobs_for(pages):
        rows = [(s, 3, n, f"{s}-{n}-{k}", f"{s}-{n}-{k}", k > 1) for s in range(5) for n in range(pages) for k in range(3)]
        links = spark.createDataFrame(rows, "source_seq int, max_articles int, page_no int, url string, final_url string, ok boolean")
        spark.sparkContext.setJobGroup(f"pages-{pages}", "")
        clicks.visited_links(links).collect()
        return len(tracker.getJobIdsForGroup(f"pages-{pages}"))

    few, many = jobs_for(2), jobs_for(40)
    spark.sparkContext.setJobGroup("", "")
    assert few == many < 30


def test_top_n_is_cut_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("k"))
    plan = plan_of(ranking.cut_parts(rows, ["g"], ["k"], F.lit(3)))
    assert plan.count("WindowGroupLimit") >= 2
    assert sorted(map(tuple, ranking.top_n(rows, ["g"], ["k"], 3).collect())) == [(g, k) for g in (0, 1) for k in (g, g + 2, g + 4)]


def test_stored_urls_are_not_shuffled_to_find_a_few(spark, conf, tmp_path):
    """Looking URLs up shuffles those to the buckets of the table, and nothing of the table."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    seen = SeenUrls(spark, str(tmp_path / "seen"), buckets=8)

    def urls(*ids):
        return spark.createDataFrame([(f"https://h/{k}",) for k in ids], "url string")

    seen.grow(urls(*range(300), 5, 5), "a")
    seen.grow(urls(*range(250, 400)), "b")
    done = spark.createDataFrame([("a",)], "batch string")
    found = seen.among(urls(3, 7, 7, 260, 350, 999), done)
    assert sorted(r.url for r in found.collect()) == ["https://h/260", "https://h/3", "https://h/7"]
    # 350 stands in the table, in a batch that is not committed; of the others few are looked for.
    possible = {r.url for r in seen.possible(urls(*range(0, 4000))).collect()}
    assert {f"https://h/{k}" for k in range(400)} <= possible and len(possible) < 420
    plan = plan_of(found)
    table_side = plan[plan.rindex("BroadcastHashJoin") :]
    assert "SelectedBucketsCount" in plan or "Bucketed: true" in plan, plan
    assert "Exchange hashpartitioning(url" not in table_side, plan
    # Another session that only knows the folder reads the same table.
    spark.sql(f"DROP TABLE {seen.table}")
    again = SeenUrls(spark, str(tmp_path / "seen"), buckets=8)
    assert again.among(urls(3, 999), done).count() == 1
    assert SeenUrls(spark, str(tmp_path / "none"), buckets=8).among(urls(1), done).count() == 0
