"""End to end: registry, listing, search and direct runs, run log, second run."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from presskiln.plans.ingest import ingest
from presskiln.schemas import REDIRECTS, SCRAPE_RUNS, SNAPSHOTS
from presskiln.operators import runs as run_log
from presskiln.sources.files import read_registry, read_snapshots
from presskiln.sources.store import ArticleStore

DAY_1, DAY_2 = datetime(2024, 5, 1, 8), datetime(2024, 5, 2, 8)
LISTING = "https://news.sky.com/topic/safety-1/1"
SEARCH = "https://news.google.com/search?q=online+safety&hl=en-GB&gl=GB&ceid=GB:en"


def page(title, body="", filler=True):
    return f"<html><title>{title}</title>{body}{'x' * 2500 if filler else ''}</html>"


def anchors(*hrefs):
    return "".join(f'<a class="l" href="{h}">t</a>' for h in hrefs)


@pytest.fixture
def world(spark, tmp_path):
    story = "https://news.sky.com/story/"
    snapshots = [
        ("https://example.com", "https://example.com/", page("Example"), DAY_1),
        (LISTING, LISTING, page("L1", anchors("/story/a", "/story/b", "/topic/x/2", "/story/gone")), DAY_1),
        (LISTING[:-1] + "2", None, page("L2", anchors("/story/c", "/story/a")), DAY_1),
        (story + "a", story + "a", page("A", '<meta property="article:published_time" content="2024-03-15T10:30:00+00:00">'), DAY_1),
        (story + "b", story + "moved", page("B"), DAY_1),
        (story + "c", None, page("Access Denied", filler=False), DAY_1),
        (SEARCH, None, page("S", anchors("./articles/1", "./articles/2", "./articles/3", "./read/4")), DAY_1),
        ("https://bbc.co.uk/news/1", None, page("BBC"), DAY_1),
    ]
    redirects = [
        ("https://news.google.com/articles/1", "https://bbc.co.uk/news/1/", DAY_1),
        ("https://news.google.com/articles/1", "https://bbc.co.uk/old", None),
        ("https://news.google.com/articles/2", "https://bbc.co.uk/news/missing", None),
        ("https://news.google.com/articles/3", "https://www.google.com/sorry", None),
    ]
    document = {
        "search_terms": ["online safety"],
        "direct_sources": [{"name": "Example", "url": "https://example.com"}],
        "meta_sources": [
            {"name": "Sky", "type": "link_page", "url": LISTING},
            {"name": "News", "type": "google_news"},
            {"name": "Off", "type": "link_page", "url": "https://off.example/", "enabled": False},
            {"name": "Nowhere", "type": "link_page"},
            {"name": "Odd", "type": "rss", "url": "https://rss.example/"},
        ],
        "settings": {"max_listing_pages": 2},
    }
    path = tmp_path / "registry.json"
    path.write_text(json.dumps(document))
    spark.createDataFrame(snapshots, SNAPSHOTS).write.parquet(str(tmp_path / "snapshots"))
    return (
        read_registry(spark, str(path)),
        read_snapshots(spark, str(tmp_path / "snapshots")),
        spark.createDataFrame(redirects, REDIRECTS),
        ArticleStore(spark, str(tmp_path / "store")),
    )


def test_two_runs(world):
    registry, snapshots, redirects, store = world
    done = ingest(registry, snapshots, redirects, store, DAY_1, "day-1")
    assert {(r.name, r.problem) for r in done.problems.collect()} == {
        ("Nowhere", "requires a url"),
        ("Odd", "unsupported type"),
    }
    sources = store.read("sources").orderBy("source_id").collect()
    assert [(s.source_id, s.name, s.enabled, s.robots_txt_status) for s in sources] == [
        (1, "Example", True, "unknown"),
        (2, "Sky", True, "unknown"),
        (3, "News", True, "unknown"),
        (4, "Off", False, "unknown"),
        (5, "Odd", True, "unknown"),  # of a type that is not run, but configured
    ]
    articles = store.read("articles").orderBy("article_id").collect()
    assert [(a.article_id, a.source_id, a.url, a.title) for a in articles] == [
        (1, 1, "https://example.com/", "Example"),
        (2, 2, "https://news.sky.com/story/a", "A"),
        (3, 2, "https://news.sky.com/story/moved", "B"),
        (4, 3, "https://bbc.co.uk/news/1", "BBC"),
    ]
    assert articles[1].published_at == datetime(2024, 3, 15, 10, 30)
    assert articles[0].s3_raw_html_path == f"raw/1/2024-05-01/{articles[0].content_hash}.html"
    raw = store.read("raw_html").collect()
    assert {r.s3_raw_html_path for r in raw} == {a.s3_raw_html_path for a in articles}
    runs = run_log.with_errors(store.read("scrape_runs"), store.read("run_error_parts")).orderBy("run_id").collect()
    assert [(r.run_id, r.source_id, r.status, r.error_message) for r in runs] == [
        (1, 1, "success", None),
        (2, 2, "success", None),
        (3, 3, "partial", "https://bbc.co.uk/news/missing: no snapshot"),
    ]
    assert all(r.finished_at == DAY_1 for r in runs)

    # The same batch again changes nothing.
    again = ingest(registry, snapshots, redirects, store, DAY_1, "day-1")
    assert again.results.schema == done.results.schema and again.results.count() == 0
    assert store.read("articles").count() == 4 and store.read("scrape_runs").count() == 3

    # A second day adds the rescraped direct page, and the moved story, whose own address
    # was never stored.
    ingest(registry, snapshots, redirects, store, DAY_2, "day-2")
    added = store.read("articles").where("article_id > 4").orderBy("article_id").collect()
    assert [(a.article_id, a.url) for a in added] == [
        (5, "https://example.com/"),
        (6, "https://news.sky.com/story/moved"),
    ]
    assert [r.run_id for r in store.read("scrape_runs").orderBy("run_id").collect()] == [1, 2, 3, 4, 5, 6]
    assert store.read("sources").count() == 5


def test_settings_of_each_document(spark, tmp_path):
    """Two documents: one with a page and an article per source, one without limits. The first has
    enough on its first page, so the pages it lacks are no errors, and the second takes over the
    links the first left."""
    listing = {"name": "L", "type": "link_page", "url": "https://news.sky.com/topic/a-1/1"}
    other = {"name": "M", "type": "link_page", "url": "https://news.sky.com/topic/b-1/1"}
    (tmp_path / "r").mkdir()
    one = {"meta_sources": [listing], "settings": {"max_listing_pages": 3, "max_articles_per_source": 1}}
    two = {"meta_sources": [other], "settings": {"max_listing_pages": 2}}
    (tmp_path / "r" / "lines.json").write_text(json.dumps(one) + "\n" + json.dumps(two) + "\n")
    story = "https://news.sky.com/story/"
    rows = [
        (listing["url"], None, page("L1", anchors("/story/a", "/story/b")), DAY_1),
        (other["url"], None, page("M1", anchors("/story/a", "/story/b", "/story/c")), DAY_1),
        *[(story + x, None, page(x), DAY_1) for x in "abc"],
    ]
    spark.createDataFrame(rows, SNAPSHOTS).coalesce(1).write.parquet(str(tmp_path / "snapshots"))
    store = ArticleStore(spark, str(tmp_path / "store"))
    registry = read_registry(spark, str(tmp_path / "r"), lines=True)
    ingest(registry, read_snapshots(spark, str(tmp_path / "snapshots")), spark.createDataFrame([], REDIRECTS), store, DAY_1, "one")
    assert sorted((a.source_id, a.title) for a in store.read("articles").collect()) == [(1, "a"), (2, "b"), (2, "c")]
    runs = run_log.with_errors(store.read("scrape_runs"), store.read("run_error_parts")).orderBy("run_id").collect()
    assert [(r.status, r.error_message) for r in runs] == [
        ("success", None), ("partial", "https://news.sky.com/topic/b-1/2: no snapshot"),
    ]


def test_writes_become_visible_by_commit_only(spark, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "store"))

    def runs(*ids, status="running"):
        return spark.createDataFrame([(i, 1, None, None, status, None) for i in ids], SCRAPE_RUNS)

    def seen():
        return sorted((r.run_id, r.status) for r in store.read("scrape_runs").collect())

    first = store.stage("scrape_runs", runs(1, 2), "a")
    assert seen() == []
    store.commit(first)
    store.stage("scrape_runs", runs(9), "lost")
    assert seen() == [(1, "running"), (2, "running")]
    store.commit(store.stage("scrape_runs", runs(1, 2, status="success"), "a", rev=1))
    store.commit(store.stage("scrape_runs", runs(3), "b"))
    assert seen() == [(1, "success"), (2, "success"), (3, "running")]
    assert store.is_committed("b", "scrape_runs") and not store.is_committed("lost", "scrape_runs")
    store.commit(store.stage("scrape_runs", runs(4), "c", whole=True))
    assert seen() == [(4, "running")]
