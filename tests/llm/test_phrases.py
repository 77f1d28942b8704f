"""Phrases against plain counting, and odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import compare
import numpy as np
from pyspark.sql import functions as F

from presskiln.llm import phrases


def plain(rows, least, share=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= share * found[q]}
        rows = []
        for p, a in found.items():
            if p not in inside:
                score, _, left, right = min(
                    (10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
                )
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(docs, **given):
    return sorted(tuple(r) for r in phrases.mine_phrases(docs, **given).collect())


def _made():
    rng = random.Random(5)
    words = ["a", "B", "cé", "d d", "'", "\x1c", "the"]
    rows = []
    for k in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "fr"), (" \t", None), ("a b " * 3000, "en"), ("a b " * 3000, "en"), ("...", "xx")]


def test_against_plain_counting(spark):
    rows = _made()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    # Columns of the names used inside.
    docs = docs.withColumn("f", F.lit("x")).withColumn("n", F.lit(1)).withColumn("h1", F.lit(1)).withColumn("phrase", F.lit(1))
    assert mined(docs, least=3) == plain(rows, 3)
    assert mined(docs, least=3, share=100, top=7) == plain(rows, 3, 100, 7)


def test_ties_of_cuts_and_ranks(spark):
    rows = [("x y z. p q. q p. r s", "en")] * 4
    found = mined(spark.createDataFrame(rows, "text string, lang string"), least=2)
    assert found == plain(rows, 2)
    assert [r[2] for r in found] == ["r s", "x y z", "p q", "q p"] and found[1][4:6] == (4, 4)


def test_merging_in_many_slices():
    rows = _made()
    stripes, blocks = phrases.Stripes(), defaultdict(list)
    for k, (text, lang) in enumerate(rows):
        stripes.add(lang or "und", [(text or "").encode()])
        if k % 40 == 0:
            for bucket, block in stripes.blocks(11):
                blocks[bucket].append(block)
    for bucket, block in stripes.blocks(11):
        blocks[bucket].append(block)
    pairs, whole = Counter(), Counter()
    for held in blocks.values():
        for r in phrases.merged_rows(held, 1).to_pylist():
            (pairs if r["kind"] == 2 else whole)[r["kind"], r["f"]] += 1
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                counts[k].update((lang or "und", *words[i : i + k]) for i in range(len(words) - k + 1))
    assert pairs == Counter((2, f) for f in counts[2].values())
    assert {x: n for x, n in whole.items() if x[0] in (1, 3)} == Counter((k, f) for k in (1, 3) for f in counts[k].values())


def test_a_long_text_is_counted_whole(monkeypatch):
    monkeypatch.setattr(phrases, "PIECE_BYTES", 100)
    for text in (b"a b c, " * 400, b"word " * 500 + b"." + b"x" * 900, b"no break at all " * 60, b""):
        parts = list(phrases.pieces(text))
        assert b"".join(parts) == text and all(p[:1] in b".,\n!?;:" for p in parts[1:])


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    connection = compare.connect(folder)
    found = compare.spark_rows(phrases.op13_phrases(spark, folder))
    assert found == compare.sql_rows(connection, phrases.ORACLE)
    rows = connection.execute("SELECT text, lang FROM documents").fetchall()
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found[1] == compare.rows_of(columns, plain(rows, 10)) and len(found[1]) > 50


def test_empty_table(spark):
    assert mined(spark.createDataFrame([], "text string, lang string")) == []


def test_summed():
    order, starts, sums = phrases.summed([np.array([2, 1, 2, 1]), np.array([1, 1, 1, 0])], np.array([5, 6, 7, 8]))
    assert sums.tolist() == [8, 6, 12] and order[starts].tolist() == [3, 1, 0]
