"""Base spans against plain patterns, encodings that must or must not be confirmed, odd rows."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from presskiln.llm import secrets

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(a, secrets.BASE[k], b) for a, k, b in sorted(found)]


def added(text):
    return [(kind, text[a:b]) for a, kind, b in secrets.find(text)[1] if kind not in secrets.BASE]


def b64(data, url=False):
    return (base64.urlsafe_b64encode(data).rstrip(b"=") if url else base64.b64encode(data)).decode()


def element(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8)
    return bytes([tag]) + size + body


def number(data):
    return element(2, data)


RSA = element(0x30, number(b"\0") + number(b"\1" + b"n" * 128) + number(b"\1\0\1") + b"".join(number(b"\2" + b"p" * 63) for _ in range(6)))
GENERAL = element(0x30, number(b"\0") + element(0x30, element(6, b"\x2a\x86\x48") + element(5, b"")) + element(4, RSA))
CURVE = element(0x30, number(b"\1") + element(4, b"k" * 32) + element(0xA0, element(6, b"\x2a\x86\x48\xce\x3d")))
LOCKED = element(0x30, element(0x30, element(6, b"\x2a\x86") + element(0x30, element(4, b"salt") + number(b"\10"))) + element(4, b"c" * 64))


def string(data):
    return len(data).to_bytes(4) + data


SSH = secrets.SSH_MAGIC + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4) + string(b"public") + string(b"p" * 48)
KEYS = {"rsa": RSA, "general": GENERAL, "curve": CURVE, "locked": LOCKED, "ssh": SSH}


@pytest.mark.parametrize("alphabet", ["tokenT:= '\"ab1", "AKIAZ09 ", "0123abcdef g", "password=secretapi_key:é "])
def test_base_spans_are_those_of_the_patterns(alphabet):
    rng = random.Random(3)
    parts = [*alphabet, "token", "PassWord=", "api_key: ", "AKIA", "secret'", "passwd\" =", "ſecret=", "toKen=", "f" * 15, "A" * 9]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert secrets.find(text)[0] == plain(text), text


@pytest.mark.parametrize("name", KEYS)
@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", ""])
def test_keys_in_all_forms(name, end):
    body = b64(KEYS[name])
    lines = end.join(body[k : k + 64] for k in range(0, len(body), 64))
    text = f"Here -----BEGIN PRIVATE KEY-----{end}{lines}{end}-----END PRIVATE KEY----- it is"
    assert added(text) == [("key", lines.rstrip("="))]
    assert added(f"key={body} end") == [("key", body.rstrip("="))]
    assert added(f"x {KEYS[name].hex()} y") == [("key", KEYS[name].hex())]
    assert added(f"x {KEYS[name].hex().upper()}") == [("key", KEYS[name].hex().upper())]


@pytest.mark.parametrize("name", KEYS)
def test_one_wrong_length_is_no_key(name):
    data = KEYS[name]
    assert added(b64(data[:-1])) == []
    places = [15, 18] if name == "ssh" else [1, 2]
    for k in places:
        wrong = data[:k] + bytes([data[k] ^ 5]) + data[k + 1 :]
        assert added("x " + b64(wrong)) == [] and added("x " + wrong.hex()) == []
    public = element(0x30, element(0x30, element(6, b"\x2a") + element(5, b"")) + element(3, b"\0" + b"q" * 90))
    assert added(b64(public)) == []


def test_signed_tokens():
    def token(fields, body=b'{"sub":1}', signature=b"s" * 32):
        return ".".join(b64(x, True) for x in (json.dumps(fields).encode(), body, signature))

    good = [
        token({"alg": "HS256", "typ": "JWT"}), token({"typ": "x", "alg": "RS256"}, signature=b"r" * 256),
        token({"alg": "ES512"}, signature=b"e" * 132), token({"alg": "none"}, signature=b""),
    ]
    for t in good:
        assert added(f"Bearer {t}, and") == [("signed", t)]
    bad = [
        token({"alg": "HS256"}, signature=b"s" * 31), token({"alg": 7}), token({"typ": "JWT"}), token({"alg": "RS256"}),
        good[0] + ".more", good[0].replace(".", " ", 1), "eyJhbGciOiJIUzI1NiJ.e30." + "a" * 43, "eyJ" + "A" * 40 + "." + "b" * 8 + "." + "c" * 43,
    ]
    for t in bad:
        assert added(f"Bearer {t} and") == [], t


def test_wrapped_secrets():
    inner = b"user=joe\npassword=correct-horse-battery\n"
    assert added(f"data: {b64(inner)} end") == [("wrapped", b64(inner))]
    assert added(f"data: {inner.hex()} end") == [("wrapped", inner.hex())]
    assert added(f"data: {b64(b'AKIA' + b'Z9' * 10)} end")[0][0] == "wrapped"
    for other in (b"only some harmless words in here, nothing more", b"password=short and then some words", bytes(range(128, 200))):
        assert added(f"data: {b64(other)} end") == []


def test_long_odd_texts_take_time_in_proportion():
    for text in ("ey" * 300_000, "eyaaaaaaaaaa." * 40_000, "token" + " " * 10**6, "token " * 10**5, "A" * 10**6, "MIIE" * 200_000, "-" * 10**6):
        begin = time.perf_counter()
        secrets.find(text)
        assert time.perf_counter() - begin < 3


def test_query_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(
        [(1, None), (1, ""), (None, "é token=abcdefghijkl"), (1, "a" * 16), (1, "a" * 16), (2, "secret: 0123456789abcdef " * 20000)],
        "doc_id long, text string",
    )
    docs = docs.union(odd).withColumn("spans", F.lit("clash")).withColumn("n_key", F.lit("clash")).withColumn("other", F.lit(2))
    rows = secrets.find_secrets(docs).collect()
    assert len(rows) == 1006
    for r in rows:
        base = plain(r["text"] or "")
        assert r["base_sha256"] == hashlib.sha256(secrets.listed(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in secrets.BASE] == [sum(s[1] == k for s in base) for k in secrets.BASE]
        assert r["other"] == 2 and (r["text"] is None) == (r["without_secrets"] is None)
        assert set(secrets.listed(base).split(",")) <= set(r["spans"].split(","))
        assert not r["without_secrets"] or not base or "[SECRET]" in r["without_secrets"]
    assert sum(r["n_assign"] for r in rows) > 10
    assert secrets.find_secrets(docs.limit(0)).count() == 0
