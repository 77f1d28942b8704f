"""Winnowing against all windows of all items."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from presskiln.llm.winnowing import digest, find_leaks, sha256_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = _words(text)
        for i in range(max(1, len(w) - 9) if w and item is not None else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = _words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    found |= got
                    hit |= set(range(i, i + n))
        out.append((doc, len(w), len(hit), len(found), sha256_of(list(found)), bool(hit)))
    return out


def _same(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit(1)).withColumn("x", F.lit(3))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    key = lambda r: tuple(map(str, r))
    found = [tuple(r) for r in digest(find_leaks(d.repartition(3), b)).collect()]
    assert sorted(found, key=key) == sorted(plain(docs, items), key=key)
    return found


def test_given_tables(spark):
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet").select(c, "text").collect()]
    found = _same(spark, read("documents", "doc_id"), read("benchmark", "item_id"))
    assert any(r[5] for r in found) and not all(r[5] for r in found)


def test_random_words_short_items_and_odd_rows(spark):
    rng = random.Random(3)
    text = lambda n, k: " ".join(rng.choice("abcdefg"[:k]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60), 2 + i % 6)) for i in range(300)]
    docs += [(1, None), (1, ""), (None, "A-b,c"), (7, "é È é"), (7, "é È é"), (8, "a " * 40000)]
    items = [(i, text(rng.randint(0, 30), 2 + i % 5)) for i in range(60)]
    items += [(5, "a"), (6, "A b, c"), (7, ""), (8, None), (None, "a b"), (9, "é È"), (9, "é È"), (10, docs[0][1])]
    _same(spark, docs, items)
    _same(spark, docs, [])
    _same(spark, [], items)
    _same(spark, docs, [(i, t) for i, t in items if len(_words(t)) >= 10])
