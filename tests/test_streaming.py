"""A stream over arriving snapshots gives what one batch over all of them gives."""

from __future__ import annotations

from datetime import datetime

from presskiln.operators import runs as run_log
from presskiln.sources.files import addressed
from presskiln.sources.store import ArticleStore
from presskiln.streaming import incremental

NOW = datetime(2024, 5, 1)


def _arrivals(spark):
    rows = [
        (1, "https://h/a", None, "<title>A</title>", datetime(2024, 1, 1)),
        (1, "https://h/b", None, "<title>B</title>", datetime(2024, 1, 1)),
        (2, "https://H/a/", None, "<title>A later</title>", datetime(2024, 1, 2)),
        (2, "https://h/c", None, "<title>Access denied</title>", datetime(2024, 1, 2)),
        (2, "https://h/c", None, "<title>C</title>", datetime(2024, 1, 3)),
        (2, "https://h/d", None, "<title>B</title>", datetime(2024, 1, 3)),
        (3, "https://h/e", None, "<title>Access denied</title>", datetime(2024, 1, 3)),
        (3, "https://h/a", None, "<title>Access denied</title>", datetime(2024, 1, 3)),
    ]
    return spark.createDataFrame(rows, incremental.ARRIVALS)


def _titles(store):
    return sorted((a.source_id, a.url, a.title) for a in store.read("articles").collect())


def _errors(store):
    log = run_log.with_errors(store.read("scrape_runs"), store.read("run_error_parts"))
    return sorted((r.source_id, text) for r in log.where("error_message is not null").collect() for text in r.error_message.split("; "))


def test_stream_equals_batch(spark, tmp_path):
    arrivals = _arrivals(spark)
    incoming = str(tmp_path / "incoming")
    streamed = ArticleStore(spark, str(tmp_path / "streamed"))

    def run():
        query = incremental.start(spark, incoming, streamed.root, str(tmp_path / "state"), NOW, max_files=1)
        query.awaitTermination(300)
        assert query.exception() is None

    for day in (1, 2, 3):
        arrivals.where(f"fetched_at = TIMESTAMP '2024-01-0{day}'").coalesce(1).write.mode("append").parquet(incoming)
        if day > 1:
            run()
    whole = ArticleStore(spark, str(tmp_path / "whole"))
    arrivals.write.parquet(str(tmp_path / "all"))
    arrivals = addressed(spark.read.schema(incremental.ARRIVALS).parquet(str(tmp_path / "all")))
    incremental.ingest_snapshots(arrivals, whole, NOW, "all")
    assert _titles(streamed) == _titles(whole) == [
        (1, "https://h/a", "A"), (1, "https://h/b", "B"), (2, "https://h/c", "C"), (2, "https://h/d", "B"),
    ]
    ids = [a.article_id for a in streamed.read("articles").collect()]
    assert sorted(ids) == [1, 2, 3, 4]
    # Refused pages leave an error, the same whatever the slices, and runs say how they went.
    assert _errors(streamed) == _errors(whole) == [
        (2, "https://h/c: Site blocked automated access"), (3, "https://h/e: Site blocked automated access"),
    ]
    assert sorted((r.run_id, r.source_id, r.status) for r in whole.read("scrape_runs").collect()) == [
        (1, 1, "success"), (2, 2, "partial"), (3, 3, "failed"),
    ]
    log = sorted((r.run_id, r.source_id, r.status) for r in streamed.read("scrape_runs").collect())
    assert [r[0] for r in log] == list(range(1, len(log) + 1))
    assert {r[1:] for r in log} == {(1, "success"), (2, "failed"), (2, "success"), (3, "failed")}
    # A batch that is delivered again changes nothing.
    incremental.ingest_snapshots(arrivals, whole, NOW, "all")
    assert whole.read("articles").count() == 4
    assert whole.read("raw_html").count() == 4 and whole.read("scrape_runs").count() == 3
