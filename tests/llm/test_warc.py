"""Archives written and read back."""

from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from presskiln.llm.common import filesystem, shared_folder
from presskiln.llm.warc import payload_digest, ranges, read_records, write_archives


def _expected(rows):
    least = {}
    for page, _, html in rows:
        if page is not None:
            least[html or ""] = min(least.get(html or "", page), page)
    out = []
    for page, url, html in rows:
        data, first = (html or "").encode(), least.get(html or "")
        again = first is not None and page != first
        out.append((page, url, len(data), payload_digest(data), "revisit" if again else "response", first if again else None, None if again else data))
    return out


def _check(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit(1)).withColumn("offset", F.lit(2))
    index = write_archives(pages.repartition(3), shared_folder(spark, "warc"))
    found = [tuple(r) for r in read_records(index).collect()]
    found = [(*r[:6], None if r[6] is None else bytes(r[6])) for r in found]
    key = lambda r: tuple(map(str, r))
    assert sorted(found, key=key) == sorted(_expected(rows), key=key)
    return index


def test_round_trip_of_given_and_odd_pages(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    rows += [
        (9001, "http://a/ b\r\nc%0D%25", "same"), (9000, None, "same"), (9000, "http://x", "same"), (9002, "http://é", None), (9003, "u", ""),
        (None, "n", "same"), (None, "n", "alone"), (9004, "u", "\r\n\r\nContent-Length: 7\r\n\r\n"), (9005, "long", "é" * 200000),
    ]
    index = _check(spark, rows)
    row = index.where("url = 'long'").first()
    store, path = filesystem(row["path"])
    with store.open_input_file(path) as file:
        plain = gzip.decompress(file.read_at(row["length"], row["offset"]))
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and plain.endswith(b"\r\n\r\n")
    one = read_records(index.where("page_id = 9005")).collect()
    assert [r["payload_bytes"] for r in one] == [400000]


def test_empty_table(spark):
    _check(spark, [])


def test_ranges_join_neighbours():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 20, 5), ("a", 10**6, 5), ("b", 0, 3)]
    assert list(ranges(iter(rows))) == [
        ("a", 0, 25, [(0, 10), (10, 5), (20, 5)]), ("a", 10**6, 10**6 + 5, [(10**6, 5)]), ("b", 0, 3, [(0, 3)]),
    ]


def test_archives_and_token_files_are_read_by_many_tasks(spark, monkeypatch):
    import public_tokenizers

    from presskiln.llm import common, token_files

    monkeypatch.setattr(common, "READ_BYTES", 20_000)
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").repartition(4)
    records = read_records(write_archives(pages, shared_folder(spark, "warc")))
    assert records.rdd.getNumPartitions() > 10 and records.count() == pages.count()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = public_tokenizers.path("byte_bpe_50k.json")
    one, two = (token_files.write_token_files(docs.where(f"doc_id % 2 = {k}"), model, shared_folder(spark, "tokens")) for k in (0, 1))
    read = token_files.read_token_files(one.unionByName(two.withColumn("shard", F.col("shard") + 1000)))
    assert read.rdd.getNumPartitions() > 1 and read.count() == docs.count()
