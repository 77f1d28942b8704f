"""Table operators on small inputs, several against a step-by-step simulation."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from presskiln import schemas
from presskiln.operators import clicks, fetch, jobs, links, ranking, registry, runs, updates
from presskiln.plans.runs import collect_article_urls
from presskiln.sources.files import read_csv, read_registry, write_csv


LINKS = "source_seq int, max_articles int, page_no int, url string, final_url string, ok boolean"


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_ranked_splits_a_hot_group(spark):
    """One group holds nearly all rows; its rank is dense and its rows are in many partitions."""
    rows = spark.range(5000).select(
        F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(99).alias("g"), F.col("id").alias("k")
    )
    got = ranking.ranked(rows, ["k"], ["g"]).collect()
    places = {}
    for r in sorted(got, key=lambda r: (r.g, r.k)):
        places[r.g] = places.get(r.g, 0) + 1
        assert r["rank"] == places[r.g]
    assert len(got) == 5000


def test_next_ids_go_on_from_the_highest(spark):
    old = spark.createDataFrame([(3,), (7,)], "id long")
    new = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert values(ranking.with_next_ids(new, ["k"], "id", old), "id", "k") == [(8, "a"), (9, "b"), (10, "c")]
    none = spark.createDataFrame([], "id long")
    assert values(ranking.with_next_ids(new, ["k"], "id", none), "id", "k") == [(1, "a"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("n", [None, 0, 2, 1500])
def test_top_n(spark, n):
    rows = spark.range(4000).select((F.col("id") % 2).alias("g"), F.format_string("%05d", "id").alias("k"))
    got = ranking.top_n(rows, ["g"], ["k"], n)
    expected = n or 2000
    assert [(r.g, r.n) for r in got.groupBy("g").agg(F.count("*").alias("n")).orderBy("g").collect()] == [
        (0, expected), (1, expected),
    ]
    assert got.agg(F.max("k")).first()[0] == f"{expected * 2 - 1:05d}"


def test_registry_defaults_problems_and_sync(spark, tmp_path):
    document = {
        "direct_sources": [
            {"name": "A", "url": "https://Example.com"},
            {"name": "B", "url": "https://b.com/x", "enabled": False, "scrape_frequency": "hourly"},
            {"name": "A2", "url": "https://example.com/"},
        ],
        "meta_sources": [{"name": "N", "type": "google_news", "search_terms": ["custom term"]}],
    }
    path = tmp_path / "r.json"
    path.write_text(json.dumps(document))
    entries = ranking.ranked(registry.registry_entries(read_registry(spark, str(path))), ["entry_order"], name="source_seq")
    rows = entries.orderBy("source_seq").collect()
    assert [(r.name, r.enabled, r.scrape_frequency) for r in rows] == [
        ("A", True, "daily"), ("B", False, "hourly"), ("A2", True, "daily"), ("N", True, "daily"),
    ]
    assert "news.google.com/search" in rows[3].base_url and "custom+term" in rows[3].base_url
    old = spark.createDataFrame(
        [(5, "Old B", "https://b.com/x", "allowed", "daily", True), (2, "Kept", "https://kept/", "unknown", "daily", True)],
        schemas.SOURCES,
    )
    synced = registry.upsert_sources(old, entries, "source_seq")
    assert values(synced, "source_id", "name", "robots_txt_status", "scrape_frequency", "enabled") == [
        (2, "Kept", "unknown", "daily", True),
        (5, "Old B".replace("Old ", ""), "allowed", "hourly", False),
        (6, "A2", "unknown", "daily", True),
        (7, "N", "unknown", "daily", True),
    ]


def test_empty_registry(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text("{}")
    assert registry.registry_entries(read_registry(spark, str(path))).count() == 0


def test_listing_pages(spark):
    df = spark.createDataFrame(
        [("https://news.sky.com/topic/internet-safety-6281/1",), ("https://example.com/news",), ("https://h/topic/a/09/more?x=1",)],
        "u string",
    )
    got = links.listing_pages(df, "u", 3).orderBy("u", "page_no").select("listing_url").collect()
    assert [r[0] for r in got] == [
        "https://example.com/news",
        "https://h/topic/a/9", "https://h/topic/a/10", "https://h/topic/a/11",
        "https://news.sky.com/topic/internet-safety-6281/1",
        "https://news.sky.com/topic/internet-safety-6281/2",
        "https://news.sky.com/topic/internet-safety-6281/3",
    ]
    assert links.listing_pages(df, "u", 0).count() == 1


def test_page_links(spark):
    hrefs = ["/story/article-one", "/topic/internet-safety-6281/2", "javascript:void(0)", "https://news.sky.com/story/article-two", "/story/article-one/"]
    html = "".join(f'<a href="{h}">x</a>' for h in hrefs)
    df = spark.createDataFrame([("https://news.sky.com/topic/a/1", html)], "listing_url string, html string")
    assert values(links.page_links(df, "listing_url"), "url") == [
        ("https://news.sky.com/story/article-one",), ("https://news.sky.com/story/article-two",),
    ]


def test_pagination_stop(spark):
    pages = spark.createDataFrame([(s, p) for s in (1, 2, 3) for p in range(4)], "s int, page_no int")
    found = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 3, "d"), (2, 1, "e"), (3, 0, "f")], "s int, page_no int, url string")
    got = links.reachable(pages, found, "s", F.col("page_no") == 0)
    assert values(got, "s", "page_no", "n_links") == [(1, 0, 1), (1, 1, 1), (2, 0, 0), (2, 1, 1), (3, 0, 1)]


def test_links_of_a_listing_end_with_its_pages(spark):
    pages = spark.createDataFrame([(1, p) for p in range(4)], "source_seq int, page_no int")
    found = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 1, "a"), (1, 3, "d")], "source_seq int, page_no int, url string")
    assert values(collect_article_urls(found, pages).select("url").distinct(), "url") == [("a",), ("b",)]


def test_seen_filters(spark):
    found = spark.createDataFrame([("a", False), ("a", True), ("b", False), ("c", False)], "url string, allow_rescrape boolean")
    stored = spark.createDataFrame([("a",), ("a",), ("c",), ("",), (None,)], "url string")
    direct = spark.createDataFrame([("c",)], "url string")
    assert values(jobs.seen_urls(stored), "url") == [("a",), ("c",)]
    assert values(jobs.skip_seen(found, stored), "url", "allow_rescrape") == [("a", True), ("b", False)]
    assert values(jobs.skip_stored(found, stored, direct), "url") == [("a",), ("b",), ("c",)]
    assert values(jobs.url_exists(found, stored), "url") == [("a",), ("a",), ("c",)]


def test_limit_comes_before_the_seen_filter(spark):
    found = spark.createDataFrame([(1, u, False) for u in "abcde"], "source_id int, url string, allow_rescrape boolean")
    seen = spark.createDataFrame([("a",), ("b",)], "url string")
    assert jobs.skip_seen(jobs.limit_per_source(found, 2), seen).count() == 0
    assert jobs.limit_per_source(found, None).count() == 5 and jobs.limit_per_source(found, 0).count() == 5


def test_first_success_wins(spark):
    rows = [("u", 1, False, False), ("u", 2, True, False), ("u", 3, True, False), ("u", 4, True, True), ("v", 5, False, False)]
    found = spark.createDataFrame(rows, "url string, job_seq int, ok boolean, allow_rescrape boolean")
    assert values(jobs.first_success_wins(found), "job_seq") == [(1,), (2,), (4,), (5,)]


def test_redirects(spark):
    wrapped = spark.createDataFrame([(1, f"https://h/{x}") for x in "abcd"], "source_id int, url string")
    to = spark.createDataFrame(
        [("https://h/a", "https://X.com/p/", None), ("https://h/b", "https://x.com/p", None), ("https://h/c", "https://x.com/?u=google.com", None)],
        schemas.REDIRECTS,
    )
    assert values(jobs.resolve_redirects(wrapped, to), "source_id", "url") == [(1, "https://x.com/p")]


def test_the_latest_redirect_up_to_a_time_counts(spark):
    from datetime import datetime

    wrapped = spark.createDataFrame([(f"https://h/{x}",) for x in "abcde"], "url string")
    day = [datetime(2024, 1, d) for d in range(1, 5)]
    rows = [
        ("https://h/a", "https://x/old", day[0]), ("HTTPS://H/a/", "https://x/new", day[1]), ("https://h/a", "https://x/late", day[3]),
        ("https://h/b", "https://x/b", day[0]), ("https://h/b", None, day[1]),
        ("https://h/c", "https://x/c", None), ("https://h/c", None, None),
        ("https://h/d", None, day[0]), ("https://h/d", "https://x/d", day[1]),
        ("https://h/e", "https://x/e", day[3]),
    ]
    to = spark.createDataFrame(rows, schemas.REDIRECTS)
    as_of = F.lit("2024-01-03").cast("timestamp")
    assert values(jobs.resolve_redirects(wrapped, to, as_of=as_of), "url") == [("https://x/d",), ("https://x/new",)]


@pytest.mark.parametrize(
    "cap, expected",
    [
        (None, [(0, "a"), (0, "b"), (0, "c"), (1, "d"), (1, "e")]),
        (-1, []),
        (0, []),
        (1, [(0, "a"), (1, "c")]),
        (2, [(0, "a"), (0, "b"), (1, "c")]),
        (3, [(0, "a"), (0, "b"), (0, "c"), (1, "d")]),
    ],
)
def test_visited_links_of_one_source(spark, cap, expected):
    """a is refused, b leads to f; c waits for the second page where a low cap ends the first."""
    rows = [(0, "a", "a", False), (0, "b", "f", True), (0, "c", "c", True), (1, "c", "c", True), (1, "d", "d", True), (1, "e", "e", True), (1, "f", "f", True)]
    candidates = spark.createDataFrame([(5, cap, *r) for r in rows], LINKS)
    assert values(clicks.visited_links(candidates), "page_no", "url") == expected


def _click_by_click(sources):
    """Visits and stop page of sources in turn; each is (cap, pages of {url: (final, ok)})."""
    seen, visits, stops = set(), [], {}
    for seq, (cap, pages) in sorted(sources.items()):
        saved = 0
        for n, links_of_page in enumerate(pages):
            tried = 0
            while True:
                if cap is not None and saved >= cap:
                    stops[seq] = n
                    break
                fresh = sorted(u for u in links_of_page if u not in seen)
                if not fresh or cap is not None and tried >= cap:
                    break
                url, tried = fresh[0], tried + 1
                final, ok = links_of_page[url]
                visits.append((seq, n, url))
                seen.add(url)
                if ok:
                    seen.add(final)
                    saved += 1
            if seq in stops:
                break
    return sorted(visits), stops


@pytest.mark.parametrize("seed", range(2))
def test_sources_take_turns_as_click_by_click(spark, seed):
    """Many sources that share links, with caps of their own and links that lead to others."""
    dice, sources = random.Random(seed), {}
    target = {u: (dice.choice("abcdefgh") if dice.random() < 0.4 else u, dice.random() < 0.7) for u in "abcdefghijkl"}
    for source in range(40):
        # Sources of a group share links, of another group none.
        names = [f"{u}{source % 6}" for u in "abcdefghijkl"]
        pages = [
            {u: (target[u[0]][0] + u[1:], target[u[0]][1]) for u in dice.sample(names, dice.randint(0, 8))} for _ in range(3)
        ]
        sources[source] = (dice.choice([None, 0, 1, 2, 4]), pages)
    rows = [(seq, cap, n, u, *to) for seq, (cap, pages) in sources.items() for n, page in enumerate(pages) for u, to in page.items()]
    walks = clicks.settled_walks(spark.createDataFrame(rows, LINKS))
    visits, stops = _click_by_click(sources)
    assert values(clicks.visits_of(walks), "source_seq", "page_no", "url") == visits
    found = {r.source_seq: r.stop_page for r in walks.collect() if r.stop_page is not None}
    assert found == {seq: n for seq, n in stops.items() if seq in found or sources[seq][0] > 0}


def test_sources_without_shared_links_walk_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(clicks, "walk", lambda links, walk=clicks.walk: calls.append(1) or walk(links))
    rows = [(s, 2, n, f"{s}-{n}-{k}", f"{s}-{n}-{k}", True) for s in range(50) for n in range(3) for k in range(4)]
    walks = clicks.settled_walks(spark.createDataFrame(rows, LINKS))
    assert len(calls) == 1 and {len(r.visits) for r in walks.collect()} == {2}


def test_fetch_outcomes_and_choice_of_snapshot(spark):
    from datetime import datetime

    snaps = spark.createDataFrame(
        [
            ("https://H/a", None, "<title>old</title>", datetime(2024, 1, 1)),
            ("https://h/a/", None, "<title>new</title>", datetime(2024, 1, 2)),
            ("https://h/b", None, "<title>Access denied</title>", datetime(2024, 1, 1)),
        ],
        schemas.SNAPSHOTS,
    )
    facts = fetch.page_facts(snaps)
    wanted = spark.createDataFrame([("https://h/a",), ("https://h/b",), ("https://h/c",)], "url string")
    got = fetch.fetch(wanted, fetch.one_per_url(facts)).orderBy("url").collect()
    assert [(r.title, r.outcome, r.error) for r in got] == [
        ("new", "ok", None),
        ("Access denied", "denied", "https://h/b: Site blocked automated access"),
        (None, "missing", "https://h/c: no snapshot"),
    ]
    assert fetch.one_per_url(facts, latest=False).where("title = 'old'").count() == 1


def test_run_outcomes_and_errors_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(runs, "PART_ERRORS", 3)
    opened = spark.createDataFrame([(r, r) for r in (1, 2, 3, 4)], "run_id long, source_id long")
    rows = [(1, i, f"e{i}") for i in range(10)] + [(2, 0, None), (2, 1, "x"), (3, 0, None)]
    results = spark.createDataFrame(rows, "run_id long, job_seq long, error string")
    assert values(runs.run_outcomes(opened, results), "run_id", "status") == [
        (1, "failed"), (2, "partial"), (3, "success"), (4, "success"),
    ]
    assert values(runs.error_parts(results), "run_id", "part_no", "error_message")[1] == (1, 1, "e3; e4; e5")
    log = opened.withColumn("error_message", F.lit(None).cast("string")).withColumn("status", F.lit("x"))
    whole = runs.with_errors(log, runs.error_parts(results))
    assert whole.columns == log.columns and values(whole.where("run_id > 1"), "run_id", "error_message")[0] == (2, "x")
    assert values(runs.run_errors(results), "run_id", "error_message") == [
        (1, "; ".join(f"e{i}" for i in range(10))), (2, "x"),
    ]


def test_updates_and_checks(spark):
    table = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, w string")
    new = spark.createDataFrame([(2, None)], "id int, v string")
    assert sorted(map(tuple, updates.update_rows(table, new, "id").collect()), key=str) == [(1, "a", "x"), (2, None, "y")]
    assert updates.append_rows(table, new).where("w IS NULL").count() == 1
    assert updates.duplicate_keys(table.union(table), "id").count() == 2
    assert values(updates.orphans(table, new, "id", "id"), "id") == [(1,)]


def test_an_update_replaces_only_folders_it_touches(spark, tmp_path):
    import glob
    import os

    path = str(tmp_path / "runs")
    rows = [(k, 1, None, None, "running", None) for k in range(200)]
    table = spark.createDataFrame(rows, schemas.SCRAPE_RUNS)
    updates.write_bucketed(table, path, "run_id", 16)

    def files():
        return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}

    before = files()
    new = spark.createDataFrame([(3, "failed", "e"), (900, "failed", "no such run")], "run_id long, status string, error_message string")
    updates.update_bucketed(spark, path, schemas.SCRAPE_RUNS, new, "run_id", 16)
    after = files()
    kept = {os.path.dirname(f) for f in before if after.get(f) == before[f]}
    changed = {os.path.dirname(f) for f in set(before) ^ set(after)}
    assert len(changed) in (1, 2) and len(kept) >= 14 and not kept & changed
    got = spark.read.schema(schemas.SCRAPE_RUNS).parquet(path)
    assert got.count() == 200 and values(got.where("status <> 'running'"), "run_id", "status", "error_message") == [(3, "failed", "e")]
    updates.update_bucketed(spark, path, schemas.SCRAPE_RUNS, new, "run_id", 16)
    assert spark.read.schema(schemas.SCRAPE_RUNS).parquet(path).count() == 200


def test_csv_round_trip(spark, tmp_path):
    from datetime import datetime

    rows = spark.createDataFrame(
        [
            (1, 1, datetime(2024, 1, 1, 8, 0, 0, 5), None, "failed", 'a: "b"\nc; d'),
            (2, 1, datetime(2024, 1, 2), datetime(2024, 1, 2, 1), "success", None),
        ],
        schemas.SCRAPE_RUNS,
    )
    write_csv(rows, str(tmp_path / "runs"))
    back = read_csv(spark, str(tmp_path / "runs"), "scrape_runs")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
