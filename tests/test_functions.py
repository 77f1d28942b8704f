"""Column functions against literal rows and the Python standard library."""

from __future__ import annotations

import hashlib
import random
from datetime import datetime
from urllib.parse import quote_plus, urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from presskiln.functions import content, dates, html, urls


def one(spark, column, **values):
    """Value of a column expression over one row of named texts."""
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("out")).first().out


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("https://Quay.Example.NET/harbour/", "https://quay.example.net/harbour"),
        ("https://quay.example.net/find?w=tide&n=2", "https://quay.example.net/find?w=tide&n=2"),
        ("https://h?x=1", "https://h/?x=1"),
        ("https://h/a?", "https://h/a"),
        ("https://h/a;p=1/b;q?x#f", "https://h/a;p=1/b?x"),
        ("//H.com/a//", "https://h.com/a"),
        ("/x", "https:///x"),
        ("example.com/p", "https:example.com/p"),
        ("", "https:///"),
        ("tel:123", "tel:123"),
        (" https://h/a\tb\n ", "https://h/ab"),
        ("https://[::1]:80/a/", "https://[::1]:80/a"),
        ("https://[bad/a", None),
    ],
)
def test_normalize_url(spark, raw, expected):
    assert one(spark, urls.normalize_url(F.col("u")), u=raw) == expected


@pytest.mark.parametrize(
    "base, href, expected",
    [
        ("https://quay.example.net", "#tides", None),
        ("https://quay.example.net", "javascript:show(3)", None),
        ("https://quay.example.net", "mailto:pier@quay.example.net", None),
        ("https://quay.example.net", "", None),
        ("https://quay.example.net", "tel:123", "tel:123"),
        ("https://news.sky.com/topic/harbours-9/4", "/story/ferry-late-77", "https://news.sky.com/story/ferry-late-77"),
        ("https://h/a/b/c?x=1", "../d/./e", "https://h/a/d/e"),
        ("https://h/a/b/c?x=1", "../../../../e", "https://h/e"),
        ("https://h/a/b/c?x=1", "?y=2", "https://h/a/b/c?y=2"),
        ("https://h/a/b/c?x=1", "//O.net/z/", "https://o.net/z"),
        ("https://h/a/b/c", "https:foo", "https://h/a/b/foo"),
    ],
)
def test_resolve_href(spark, base, href, expected):
    assert one(spark, urls.resolve_href(F.col("b"), F.col("h")), b=base, h=href) == expected


def test_generated_paths_resolve_as_the_standard_library_joins_them(spark):
    """Relative links of plain path pieces, against absolute bases: host, path and query."""
    dice = random.Random(7)
    bases = ["https://kiln.test/x/y?z=1", "http://kiln.test", "https://kiln.test:81/q/", "https://kiln.test/p.html"]
    pieces = ["a", "b.html", "..", ".", "c-d", "e%20f"]
    rows = [(dice.choice(bases), "/" * dice.randint(0, 1) + "/".join(dice.choice(pieces) for _ in range(dice.randint(1, 5)))) for _ in range(600)]
    df = spark.createDataFrame(rows, "b string, u string")
    for r in df.select("*", urls.resolve_href(F.col("b"), F.col("u")).alias("r")).collect():
        got, joined = urlsplit(r.r), urlsplit(urljoin(r.b, r.u))
        assert (got.scheme, got.netloc, got.query) == (joined.scheme, joined.netloc, joined.query), r
        assert got.path == (joined.path.rstrip("/") or "/"), r


def test_normal_urls_stay_as_they_are(spark):
    dice = random.Random(9)
    atoms = ["a", "B", "/", "?", "#", ":", "..", "x=1", "https://", "//Kiln.test", "é", "@", "%20", "&"]
    rows = [("".join(dice.choice(atoms) for _ in range(dice.randint(1, 6))),) for _ in range(1000)]
    once = spark.createDataFrame(rows, "u string").select(urls.normalize_url(F.concat(F.lit("https://kiln.test/"), "u")).alias("n"))
    assert once.where(~urls.normalize_url(F.col("n")).eqNullSafe(F.col("n"))).count() == 0


def test_hosts_paths_and_article_test(spark):
    df = spark.createDataFrame(
        [
            ("https://news.sky.com/story/ferry-late-77", True, True),
            ("https://news.sky.com/topic/harbours-9/4", False, True),
            ("https://quay.example.net/news/story", False, False),
            ("https://fakenews.sky.com/story/x", True, True),
            ("https://news.sky.com:443/story/x", False, False),
            ("https://News.Sky.com/a?b=/story/", False, True),
        ],
        "u string, article boolean, same boolean",
    )
    got = df.select("*", urls.is_article_url(F.col("u")).alias("a"), urls.is_same_domain(F.col("u"), "news.sky.com").alias("s"))
    for row in got.collect():
        assert (row.a, row.s) == (row.article, row.same), row
    assert one(spark, urls.url_path(F.col("u")), u="https://h/a;x/b;p//") == "/a;x/b;p"
    assert one(spark, urls.url_path(F.col("u")), u="https://h/") == ""


def test_search_urls(spark):
    terms = ["low tide", "a~b*c", "é & ü", "50% #1", "a+b/c?"]
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    for row in df.select("t", urls.build_search_url(F.col("t")).alias("u")).collect():
        assert row.u == f"https://news.google.com/search?q={quote_plus(row.t)}&hl=en-GB&gl=GB&ceid=GB:en"
    assert one(spark, urls.unwrap_href(F.col("h")), h="./articles/q7") == "https://news.google.com/articles/q7"
    assert one(spark, urls.unwrap_href(F.col("h")), h="/articles/abc") == "https:///articles/abc"


def test_title(spark):
    title = html.extract_title(F.col("h"))
    assert one(spark, title, h="<html><TITLE lang=x>  Ferry \n  is late </title>") == "Ferry is late"
    assert one(spark, title, h="<html></html>") is None
    assert one(spark, title, h="<title> </title><title>second</title>") is None
    assert one(spark, title, h="<title>A &amp; B C</title>") == "A &amp; B C"


LD = '<script id="x" type="application/ld+json">{}</script>'


PAGES = [
    ('<meta property="article:published_time" content="2024-03-15T10:30:00+00:00">', datetime(2024, 3, 15, 10, 30)),
    ('<META name="PubDate" x content=\'15 March 2024\'>', datetime(2024, 3, 15)),
    ('<meta name="publish-date" content="20240315">', datetime(2024, 3, 15)),
    ('<time class="a" datetime="2024-03-15T12:00:00+02:00">', datetime(2024, 3, 15, 10)),
    ('<meta property="article:published_time" content="soon"><time datetime="2021-05-06">', datetime(2021, 5, 6)),
    ('<time datetime="2021-05-06"><meta name="pubdate" content="2020-01-01">', datetime(2020, 1, 1)),
    ('<meta content="2024-01-01" name="pubdate">', None),
    (LD.format('{"datePublished": "2023-01-02T08:00:00Z"}'), datetime(2023, 1, 2, 8)),
    (LD.format('[1, {"a": 2}, {"datePublished": "", "dateCreated": "2023-01-02"}]'), datetime(2023, 1, 2)),
    (LD.format('{"datePublished": 20230102}'), None),
    (LD.format('{"datePublished": 0, "dateCreated": "2023-01-02"}'), datetime(2023, 1, 2)),
    (LD.format('[{"datePublished": "soon"}, {"datePublished": "2023-01-02"}]'), None),
    (LD.format("{broken"), None),
    (LD.format("{broken") + LD.format('{"datePublished": "2023-01-02"}'), None),
    ("<p>2024-01-01</p>", None),
]


def test_published_at(spark):
    df = spark.createDataFrame([(f"<html>\n{page}\n</html>", day) for page, day in PAGES], "h string, day timestamp")
    for row in df.withColumn("found", html.published_at(F.col("h"))).collect():
        assert row.found == row.day, row


TEXTS = [
    ("2024-03-15T10:30:00Z", datetime(2024, 3, 15, 10, 30)),
    ("Fri, 15 Mar 2024 10:30:00 GMT", datetime(2024, 3, 15, 10, 30)),
    ("Fri, 15 Mar 2024 10:30:00 +0100", datetime(2024, 3, 15, 9, 30)),
    ("March 15, 2024", datetime(2024, 3, 15)),
    ("Mar 15, 2024 5:30 PM", datetime(2024, 3, 15, 17, 30)),
    ("2024/3/5", datetime(2024, 3, 5)),
    ("3/15/2024", datetime(2024, 3, 15)),
    ("20240315T103000Z", datetime(2024, 3, 15, 10, 30)),
    ("15th March 2024", datetime(2024, 3, 15)),
    ("15 March 2024, 10:30", datetime(2024, 3, 15, 10, 30)),
    ("March 15, 2024 10:30", datetime(2024, 3, 15, 10, 30)),
    ("3/15/2024 10:30 AM", datetime(2024, 3, 15, 10, 30)),
    ("15 Mar 2024 10:30 AM", datetime(2024, 3, 15, 10, 30)),
    ("Mar. 15, 2024", datetime(2024, 3, 15)),
    ("Sept 5, 2024", datetime(2024, 9, 5)),
    ("Fri Mar 15 10:30:00 2024", datetime(2024, 3, 15, 10, 30)),
    ("2024/03/15 10:30:00 +0100", datetime(2024, 3, 15, 9, 30)),
    ("Fri Mar 15 2024 10:30:00 GMT+0100 (CET)", datetime(2024, 3, 15, 9, 30)),
    ("15-Mar-2024 22:30:01.25", datetime(2024, 3, 15, 22, 30, 1, 250000)),
    ("10.09.2003", datetime(2003, 10, 9)),
    ("15.03.2024", datetime(2024, 3, 15)),
    ("20240315103000", datetime(2024, 3, 15, 10, 30)),
    ("20240315T1030-0530", datetime(2024, 3, 15, 16, 0)),
    ("March 15, 2024 12:05 a.m. EST", datetime(2024, 3, 15, 0, 5)),
    ("5 pm on the 15th of March 2024", None),
    ("5 pm, 15th of March 2024", datetime(2024, 3, 15, 17)),
    ("15 March 2024 13:30 PM", None),
    ("31 February 2024", None),
    ("March 2024", None),
    ("15 March 2024 2025", None),
    ("15 March 2024 (updated)", None),
    ("2024/3/15 @ 10:30", None),
    ("1 2 2024 3", None),
    ("10:30", None),
    ("year 2024", None),
    ("", None),
]


def test_parse_date(spark):
    df = spark.createDataFrame(TEXTS, "t string, moment timestamp")
    for row in df.withColumn("found", dates.parse_date(F.col("t"))).collect():
        assert row.found == row.moment, row


def test_iso_text_round_trip(spark):
    moment = datetime(2024, 3, 15, 10, 30, 0, 120000)
    df = spark.createDataFrame([(moment,), (None,)], "t timestamp")
    rows = df.select("t", dates.iso_text(F.col("t")).alias("s")).withColumn("back", dates.parse_iso(F.col("s")))
    assert [(r.s, r.back) for r in rows.collect()] == [("2024-03-15T10:30:00.120000+00:00", moment), ("", None)]


def test_access_denied(spark):
    check = html.is_access_denied(html.extract_title(F.col("h")), F.col("h"))
    assert one(spark, check, h="<html><title>Access Denied</title></html>") is True
    assert one(spark, check, h="<html><title>Harbour news</title>" + "x" * 3000) is False
    assert one(spark, check, h="<p>ACCESS DENIED</p>" + "x" * 1970) is True
    assert one(spark, check, h="<p>access denied</p>" + "x" * 2000) is False


def test_anchors(spark):
    page = (
        "<!-- <a href='/no1'> --><script>var a='<a href=\"/no2\">';</script>"
        "<a class=x href=\"/it's?a=1&amp;b=2\">1</a><A\nHREF = '/two'>2</A><a data-href='/no3' href=''>3</a><abbr href='/no4'>"
    )
    df = spark.createDataFrame([(page,)], "h string").select(F.explode(html.anchors(F.col("h"))).alias("q"))
    got = [r.h for r in df.where("q <> ''").select(html.unquote_href(F.col("q")).alias("h")).collect()]
    assert got == ["/it's?a=1&b=2", "/two", ""]


def test_content(spark):
    assert one(spark, content.content_hash(F.col("h")), h="é") == hashlib.sha256("é".encode()).hexdigest()
    path = content.raw_path(F.lit(7), F.lit("2024-05-01").cast("date"), F.col("h"))
    assert one(spark, path, h="ab") == "raw/7/2024-05-01/ab.html"
