"""The tree against plain code and SQL, at several widths, and odd rows."""

from __future__ import annotations

import hashlib

import compare
import pytest
from pyspark.sql import functions as F

from presskiln.llm import merkle


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(values):
    return _hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _climb(nodes, arity):
    paths, own = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, leaves = [], []
        for k in range(0, len(nodes), arity):
            run = nodes[k : k + arity]
            for s in range(len(run)):
                for i in own[k + s]:
                    paths[i].append(("".join(run[:s]), "".join(run[s + 1 :])))
            above.append(_hash(*run))
            leaves.append(sum(own[k : k + arity], []))
        nodes, own = above, leaves
    return nodes[0], paths


def plain(rows, arity=2, changed=()):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        said = (*r[:3], r[3] + 1, r[4]) if r[0] in changed and r[3] is not None else r
        groups.setdefault(r[2], []).append((r[0], _leaf(r), _leaf(said)))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = _climb([x[1] for x in groups[g]], arity)
    root, tops = _climb([trees[g][0] for g in langs], arity)
    out = []
    for g, top in zip(langs, tops, strict=True):
        for (doc_id, leaf, said), path in zip(groups[g], trees[g][1], strict=True):
            node = said
            for before, after in path + top:
                node = _hash(before, node, after)
            out.append((doc_id, leaf, trees[g][0], root, _hash(*[b + a for b, a in path + top]), node, node == root))
    return sorted(out, key=str)


def _rows():
    rows = [(k * 3 % 211, "s" if k % 5 else None, ["en", "de", None, "éü", ""][min(k % 9, 4)], k if k % 7 else None, "x" * (k % 4) or None) for k in range(211)]
    return rows + [(7, "s", "en", 3, "tie"), (7, "s", "en", 3, "tie"), (7, "t", "en", 3, "tie"), (None, None, None, None, None), (1, "é", "alone", -1, "")]


@pytest.mark.parametrize(("arity", "height"), [(2, 3), (3, 2)])
def test_against_plain_code(spark, arity, height):
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    docs = docs.withColumn("path", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("idx", F.lit(0)).withColumn("_group", F.lit(0))
    claimed = {"n_chars": F.when(F.col("doc_id").isin(7, 12, 30), F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    found = merkle.manifest(docs, claimed, arity=arity, height=height).drop("path")
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows, arity, {7, 12, 30})


def test_one_row_and_no_row(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    row = (5, "s", None, 4, "text")
    (found,) = merkle.manifest(spark.createDataFrame([row], schema), height=2).collect()
    assert found["leaf"] == found["subroot"] == found["root"] == found["folded_root"] == _leaf(row) and found["verified"]
    assert found["path"] == [] and found["proof_sha256"] == _hash("")
    assert merkle.manifest(spark.createDataFrame([], schema), height=2).count() == 0


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = compare.spark_rows(merkle.op12_merkle(spark, folder))
    assert found == compare.sql_rows(compare.connect(folder), merkle.ORACLE)
    assert 0 < sum(r[-1] == "False" for r in found[1]) < len(found[1]) / 3
