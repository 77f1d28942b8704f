"""The pipeline, stage by stage, against plain versions on small tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F
from test_links import plain_documents
from test_winnowing import plain

from presskiln.llm.ngram_join import keep_one
from presskiln.llm.quality import score, train

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    scored = {r["doc_id"]: r["score"] for r in score(docs, train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))).collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), "test-stage")
        rows = docs.collect()
        kept = sorted(r["doc_id"] for r in rows)
        if name == "quality":
            assert kept == sorted(i for i, _ in before if scored[i] >= 0.5) and len(kept) < len(before)
        elif name == "near_duplicates":
            assert kept == sorted(i for i, _, c in plain_documents(before) if i == c)
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
            assert kept == sorted(r[0] for r in plain(before, items) if not r[5])
        elif name == "personal_data":
            assert kept == sorted(i for i, _ in before) and all(r["n_chars"] == len(r["text"]) for r in rows)
        else:
            assert {r["doc_id"] for r in rows} == {i for i, _ in before}
        if name != "packing":
            assert docs.columns == names
        seen.append(len(rows))
    assert corpus_pipeline.run(spark, FOLDER).count() == seen[-1]


def test_one_of_each_group_stays(spark):
    rows = [(None, "a b"), (None, "a b"), (4, "a b"), (4, "a b"), (4, "A b"), (5, "c"), (None, "only"), (None, "only"), (6, None), (6, None), (7, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_id", F.lit(1))
    kept = sorted(map(str, keep_one(docs).select("doc_id", "text").collect()))
    assert len(kept) == 6 and sum("a b" in k.lower() for k in kept) == 1 and sum("only" in k for k in kept) == 1


def test_stages_on_odd_rows_and_empty_tables(spark):
    """Columns named like results keep their values; null, empty, long and repeated texts pass."""
    clashes = ["score", "n_words", "n_hit", "items", "spans", "redacted", "n_email", "base_sha256"]
    texts = [(1, None), (2, ""), (2, ""), (None, "write to x@y.zz"), (3, "1.2.3.4 says so " * 4000), (4, " \n"), (5, "plain words here")]
    docs = spark.createDataFrame([(*t, 7, *clashes) for t in texts], "doc_id long, text string, n_chars long, " + ", ".join(f"{c} string" for c in clashes))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.written(stage(spark, docs, FOLDER), "odd")
        assert rows.columns == docs.columns
        found = rows.collect()
        assert all([r[c] for c in clashes] == clashes for r in found), name
        # Texts without words are like nothing, so both rows of document 2 stay.
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(d) for d, _ in texts), name
        if name == "personal_data":
            by_id = {r["doc_id"]: r for r in found}
            assert by_id[None]["text"] == "write to [EMAIL]" and by_id[None]["n_chars"] == 16
            assert by_id[1]["text"] is None and by_id[1]["n_chars"] == 7 and by_id[2]["n_chars"] == 0
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == 6
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), FOLDER).count() == 0
