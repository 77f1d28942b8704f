"""Anchor expansion against plain patterns, and redaction."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from presskiln.llm.pii import BASE, Finder, find_pii, listed, redacted

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return {k: [m.span() for m in re.finditer(p, text) if _passes(k, m[0])] for k, p in PATTERNS.items()}


@pytest.mark.parametrize("alphabet", ["a1.@-", "0123456789 -+.()", "12.@+ a_é\n", "4539148803436467 -", "@.a"])
def test_base_spans_are_those_of_the_patterns(alphabet):
    rng, finder = random.Random(7), Finder()
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        found = finder.find(text)
        assert {k: found[k] for k in BASE} == plain(text), text


def test_added_spans_and_redaction():
    finder = Finder()
    text = 'Mail a.b@c.org, IBAN: DE89370400440532013000; token = "0123456789abcdef0123", ftp://joe:pw@host.example/x, account holders 5'
    found = finder.find(text)
    assert [text[a:b] for a, b in found["account"]] == ["DE89370400440532013000", "0123456789abcdef0123"]
    assert [text[a:b] for a, b in found["login"]] == ["ftp://joe:pw@host.example"]
    assert redacted(text, found) == 'Mail [EMAIL], IBAN: [ACCOUNT]; token = "[ACCOUNT]", [LOGIN]/x, account holders 5'


def test_query_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(
        [(1, None), (1, ""), (None, "x@y.zz"), (1, "x@y.zz"), (1, "x@y.zz"), (2, "1.2.3.4 " * 20000)], "doc_id long, text string"
    )
    docs = docs.union(odd).withColumn("spans", F.lit("clash")).withColumn("other", F.lit(2))
    rows = find_pii(docs).collect()
    assert len(rows) == 1006
    some = 0
    for r in rows:
        expected = plain(r["text"] or "")
        some += any(expected.values())
        assert [r[f"n_{k}"] for k in BASE] == [len(expected[k]) for k in BASE]
        assert r["base_sha256"] == hashlib.sha256(listed(expected, BASE).encode()).hexdigest()
        assert r["other"] == 2 and (r["text"] is None) == (r["redacted"] is None)
        assert r["redacted"] is None or not any(plain(r["redacted"]).values()) or any(expected.values())
    assert some > 30
    assert find_pii(docs.limit(0)).count() == 0
