"""Near-duplicate operators against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from presskiln.llm import ngram_join
from presskiln.llm.components import components
from presskiln.llm.embeddings import close_pairs, link_vectors, quantised
from presskiln.llm.ngram_join import link_documents


def _reach(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def _least(ids, roots):
    out = {}
    for i, r in zip(ids, roots, strict=True):
        if i is not None:
            out[r] = min(out.get(r, i), i)
    return [out.get(r) for r in roots]


def plain_documents(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    index, links = {}, set()
    for i, s in enumerate(sets):
        for g in s:
            index.setdefault(g, []).append(i)
    for own in index.values():
        links |= {(a, b) for k, a in enumerate(own) for b in own[:k]}
    links = [(a, b) for a, b in links if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    ids = [r[0] for r in rows]
    return [(i, len(s), c) for i, s, c in zip(ids, sets, _least(ids, _reach(len(rows), links)), strict=True)]


def _key(r):
    return tuple(map(str, r))


def test_documents_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r) for r in link_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()]
    assert sorted(found, key=_key) == sorted(plain_documents(rows), key=_key)


def test_chains_shared_passages_and_odd_rows(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 5000)}"
    shared, rows = [word() for _ in range(40)], []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(8, 120))]
        for _ in range(12):  # drifting copies: links make chains
            if rng.random() < 0.5:
                base = list(base)
                base[rng.randrange(len(base))] = word()
            rows.append(" ".join(base))
    rows += [" ".join(shared + [word() for _ in range(k % 30)]) for k in range(60)]
    texts = [None, "", " \n", "a b", "A  b", "a b c d e", "a b c d", "a b c d", "x " * 30000, "x " * 20000, "Ä b", "ä b", "a\x0bb"]
    rows = [(i, t) for i, t in enumerate(rows)] + [(1000 + i, t) for i, t in enumerate(texts)]
    rows += [(None, "a b"), (None, "only here"), (5, "a b c d e"), (5, "another of five"), rows[3], rows[3]]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cls", F.lit("x")).withColumn("_id", F.lit(0)).repartition(5)
    expected = sorted(plain_documents(rows), key=_key)
    assert sorted((tuple(r) for r in link_documents(docs).collect()), key=_key) == expected
    monkeypatch.setattr(ngram_join, "FREQUENT", 10)
    assert sorted((tuple(r) for r in link_documents(docs).collect()), key=_key) == expected
    assert link_documents(docs.limit(0)).count() == 0


def test_pairs_are_made_only_where_links_may_be(spark, monkeypatch):
    """Groups with more classes than are compared with all others: near misses of one text make no
    pairs, and links between such classes are still found."""
    rng = random.Random(7)
    word = lambda: f"w{rng.randint(0, 10**9)}"
    made = []

    def counted(df, name, known=ngram_join.written):
        table = known(df, name)
        made.extend([table.count()] if name == "pairs" else [])
        return table

    monkeypatch.setattr(ngram_join, "written", counted)
    monkeypatch.setattr(ngram_join, "FREQUENT", 1)

    def variants(count, changed):
        base = [word() for _ in range(120)]
        out = []
        for _ in range(count):
            own = list(base)
            for at in rng.sample(range(0, 120, 6), changed):
                own[at] = word()
            out.append(own)
        return out

    rows = [(i, " ".join(v)) for i, v in enumerate(variants(90, 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((tuple(r) for r in link_documents(docs).collect()), key=_key) == sorted(plain_documents(rows), key=_key)
    assert sum(made[1:]) == 0

    mixed = variants(90, 4) + variants(60, 3) + variants(60, 2)
    mixed += [v[:40] + ["other"] + v[41:] for v in rng.sample(mixed, 40)] + [v[3:] for v in rng.sample(mixed, 40)]
    rows = [(i, " ".join(v)) for i, v in enumerate(mixed)]
    rows += [(None, rows[3][1]), rows[5], rows[5]]
    rng.shuffle(rows)
    made.clear()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((tuple(r) for r in link_documents(docs).collect()), key=_key) == sorted(plain_documents(rows), key=_key)
    assert len(made) == 2 and made[1] > 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 300)] + [(400, 400 + k) for k in range(1, 200)] + [(900 - k, 900) for k in range(1, 50)]
    links += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(120)] + [(7, 7)]
    rng.shuffle(links)
    roots = _reach(1300, links)
    found = components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()
    assert sorted(map(tuple, found)) == [(i, r) for i, r in enumerate(roots) if i != r]


def plain_vectors(rows, threshold=0.93):
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links, count = [], [0] * len(rows)
    for k, i in enumerate(good):
        for j in good[:k]:
            a, b = np.array(rows[i][1], "f4").astype(float), np.array(rows[j][1], "f4").astype(float)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links.append((i, j))
                count[i] += 1
                count[j] += 1
    ids = [r[0] for r in rows]
    least = _least(ids, _reach(len(rows), links))
    return [(i, n, c, i is not None and i == c) for i, n, c in zip(ids, count, least, strict=True)]


def test_vectors(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").limit(300).collect()]
    rng = np.random.default_rng(2)
    for k in range(120):
        base = rng.normal(size=8)
        rows += [(2000 + 3 * k + i, (base + rng.normal(size=8) * 0.3).astype("f4").tolist(), k % 2) for i in range(3)]
    rows += [(5000, None, 1), (5001, [], 1), (5002, [0.0] * 8, 1), (5003, [1.0, None], 1), (5004, [float("nan")] * 8, 1), (5005, [1.0] * 8, None)]
    rows += [(5006, [1.0] * 8, None), (None, [2.0] * 8, 1), (5008, [2.0] * 8, 1), (5008, [2.0] * 8, 1), (5009, [float("inf")] * 8, 1), (5010, [-0.0] + [2.0] * 7, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("data", F.lit(1)).withColumn("key", F.lit("k"))
    expected = sorted(plain_vectors(rows), key=_key)
    assert sorted((tuple(r) for r in link_vectors(table.repartition(3)).collect()), key=_key) == expected
    assert link_vectors(table.limit(0)).count() == 0


def test_bound_of_quantisation_loses_no_pair():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(200, 16))
    v = np.concatenate([base, base + rng.normal(size=base.shape) * 0.38]).astype("f4").astype(float)
    tile = (v, *quantised(v))
    i, j = close_pairs(tile, tile, 0.93, True)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(u @ u.T >= 0.93, 1))
    assert len(a) > 20 and set(zip(i.tolist(), j.tolist())) == set(zip(a.tolist(), b.tolist()))
