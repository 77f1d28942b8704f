"""Every registered query against its SQL, on the tables of PRESSKILN_SF_DIR."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__
from presskiln.catalog import AREAS

FOLDER = os.environ.get("PRESSKILN_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()
OWN = {key for area in AREAS for key in area.QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = compare.connect(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert OWN <= set(QUERIES) and OWN <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(OWN))
def test_query(spark, duck, key):
    assert compare.spark_rows(QUERIES[key](spark, FOLDER)) == compare.sql_rows(duck, ORACLES[key])


def _contested(spark, folder):
    """Pages of which two spellings are one address: the lesser spelling has the greater content hash,
    once with a refusal page among them, once with one spelling twice."""
    from hashlib import sha256

    texts = sorted((f"<title>t{k}</title>" for k in range(60)), key=lambda t: sha256(t.encode()).hexdigest())
    refused = sorted(texts, key=lambda t: sha256(t.replace("<title>", "<title>Access Denied ").encode()).hexdigest())
    rows = [("https://h/a/", texts[1]), ("https://h/a", texts[-1]), ("https://i/b/", texts[0]), ("https://i/b#x", refused[-1]), ("https://i/b#x", refused[0])]
    rows += [("https://h/c", texts[k]) for k in (3, 9, 5)] + [("https://h/c/", None)]
    pages = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "page_id long, url string, html string")
    pages.repartition(3).write.parquet(f"{folder}/pages.parquet")
    hashes = {"https://h/a": texts[-1], "https://h/c": texts[9], "https://i/b": refused[-1].replace("<title>", "<title>Access Denied ")}
    return {url: sha256(t.encode()).hexdigest() for url, t in hashes.items()}


def _own(folder, key):
    connection = compare.duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    return compare.sql_rows(connection, ORACLES[key])


def test_raw_html_keys_choose_among_the_contents_of_all_pages(spark, tmp_path):
    hashes = _contested(spark, tmp_path)
    found = QUERIES["raw_html_keys"](spark, str(tmp_path))
    assert sorted(r["content_hash"] for r in found.collect()) == sorted(v for url, v in hashes.items() if url != "https://i/b")
    assert compare.spark_rows(found) == _own(tmp_path, "raw_html_keys")


def test_fetch_join_chooses_among_the_contents_of_all_pages(spark, tmp_path):
    hashes = _contested(spark, tmp_path)
    found = QUERIES["fetch_join"](spark, str(tmp_path))
    assert {r["url"]: r["content_hash"] for r in found.collect()} == hashes
    assert compare.spark_rows(found) == _own(tmp_path, "fetch_join")


def test_fetch_outcomes_choose_among_the_contents_of_all_pages(spark, tmp_path):
    _contested(spark, tmp_path)
    found = QUERIES["fetch_outcomes"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [("h", "ok", 2), ("i", "denied", 1)]
    assert compare.spark_rows(found) == _own(tmp_path, "fetch_outcomes")
