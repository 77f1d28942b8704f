"""Main text of written and given pages."""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from presskiln.llm import html_text
from presskiln.llm.html_text import Suffixes, blocks_of, extract, extract_with_repeats, kinds_of, main_texts, op8_main_text, packed, unpacked

LETTER = "<p>Read more of our best stories in the daily letter today</p>"


def _article(page):
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    parts = (" ".join(html.unescape(re.sub("<[a-z/][^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(p for p in parts if p)


def test_given_pages_and_odd_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = [(r["page_id"], r["url"], _article(r["html"])) for r in pages.collect()]
    odd = [(1, None, None), (None, "http://[x", ""), (1, "u", "<p>a"), (1, "u", "<p>a"), (2, "", "x" * 300000)]
    expected += [(i, u, {"<p>a": "a"}.get(t, t or "")) for i, u, t in odd]
    rows = pages.union(spark.createDataFrame(odd, "page_id long, url string, html string")).withColumn("text", F.lit(3)).repartition(4)
    found = [tuple(r) for r in extract(rows).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(found, key=key) == sorted(((*r, len(r[2])) for r in expected), key=key)
    assert extract(rows.limit(0)).count() == 0


def test_markup_that_is_not_text():
    page = (
        "<title>t</title><header>Site</header><nav>menu</nav><main><h2>A &amp; B</h2><p>one<br>two&nbsp;three <b>bold</b>text<p>four"
        "<script>var x = '</p>'</script><!-- <p>no</p> --><aside>more</aside><div class='cookie-notice'>we use</div><form><p>mail</form>"
        "<ul><li>l1<li>l2</ul><table><tr><td>c1<td>c2</table><section id=comments><p>nice!</section></main><p>after</p><footer>f</footer>"
    )
    assert main_texts([page]) == ["A & B\none two three boldtext\nfour\nl1\nl2\nc1\nc2"]
    assert blocks_of("<div>a<div>b</span>c</div>d") == [("a", False, False), ("b c".replace(" ", ""), False, False), ("d", False, False)]


def test_repeated_runs_go_where_no_element_says_what_is_text():
    pages = [f"<div>Text {k} stands here alone on page {k * 7}</div>{LETTER}" for k in range(5)]
    assert main_texts(pages) == [f"Text {k} stands here alone on page {k * 7}" for k in range(5)]
    assert main_texts(pages[:1]) == [f"Text 0 stands here alone on page 0\n{LETTER[3:-4]}"]
    articles = [f"<article>{LETTER}<p>{k}</p></article>" for k in range(3)]
    assert main_texts(articles) == [f"{LETTER[3:-4]}\n{k}" for k in range(3)]


def test_repeated_runs_are_found_in_the_whole_host(spark):
    """600 pages of one host without articles: each pair of pages shares a sentence, wherever they lie."""
    rows = []
    for k in range(600):
        shared = " ".join(f"pair{k % 300}w{j}" for j in range(9))
        own = " ".join(f"own{k}w{j}" for j in range(9))
        beside = f"<aside>{shared}</aside>" if k >= 590 else f"<div>{shared}</div>"
        rows.append((k, f"http://Host.example:80/{k}", f"<div>{own}</div>{beside}<div>few {k}</div>"))
    rows += [(1000, "http://other.example/", rows[0][2]), (1001, None, rows[1][2]), rows[2], (1002, "http://host.example/copy", rows[3][2])]
    own = [" ".join(f"own{k}w{j}" for j in range(9)) + f"\nfew {k}" for k in range(600)]
    lone = [main_texts([rows[k][2]])[0] for k in (0, 1)]
    assert all("pair" in t for t in lone)
    expected = sorted([(k, own[k]) for k in range(600)] + [(1000, lone[0]), (1001, lone[1]), (2, own[2]), (1002, own[3])])
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 40):
        found = extract(table.repartition(parts)).collect()
        assert sorted((r["page_id"], r["text"]) for r in found) == expected
        assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert main_texts([r[2] for r in rows[:600]]) == own


def _counted(rows):
    """page_id, text, words and repeated words of each row, by looking at all other pages of the host."""
    runs = {}
    for _, url, page in rows:
        for text, _ in kinds_of(page or ""):
            words = text.split()
            for k in range(len(words) - 5):
                runs.setdefault((html_text.host_of(url), *words[k : k + 6]), set()).add(page)
    out = []
    for page_id, url, page in rows:
        kept, n_words, n_repeated = [], 0, 0
        for text, kind in kinds_of(page or ""):
            words = text.split()
            at = {j for k in range(len(words) - 5) if len(runs[html_text.host_of(url), *words[k : k + 6]]) > 1 for j in range(k, k + 6)}
            if kind == html_text.TEXT or kind == html_text.UNSURE and 2 * len(at) <= len(words):
                kept.append(text)
                n_words, n_repeated = n_words + len(words), n_repeated + len(at)
        out.append((page_id, "\n".join(kept), n_words, n_repeated))
    return sorted(out, key=str)


def test_repeated_runs_are_found_in_articles(spark, tmp_path):
    """All pages have an article, so markup places every block: its text stays, and what of it other pages
    of the host hold too is found all the same."""
    shared = "one two three four five six seven eight"
    rows = [
        (1, "http://a.example/1", f"<article><p>{shared}<p>all of this is only here</article>"),
        (2, "http://a.example/2", f"<article><p>on page two</article><footer>zero {shared}</footer>"),
        (3, "http://b.example/3", f"<article><p>{shared}</article>"),
        (4, "http://a.example/4", "<article><p>four five six seven eight nine</article>"),
        (5, "http://c.example/5", f"<article><p>{shared}</article>"),
        (6, "http://c.example/6", f"<article><p>{shared}</article>"),
        (7, "http://c.example/7", f"<article><p>own words {shared}</article><nav>c</nav>"),
        (8, "http://d.example/8", f"<article><p>{shared} {shared}</article>"),
        (9, None, None),
    ]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = {r["page_id"]: r for r in op8_main_text(spark, str(tmp_path)).collect()}
    assert {k: (r["n_words"], r["n_repeated"]) for k, r in found.items()} == {
        1: (14, 8), 2: (3, 0), 3: (8, 0), 4: (6, 0), 5: (8, 8), 6: (8, 8), 7: (10, 8), 8: (16, 0), 9: (0, 0),
    }
    assert found[1]["text"] == f"{shared}\nall of this is only here" and found[9]["text"] == ""
    assert sorted((k, r["text"], r["n_words"], r["n_repeated"]) for k, r in found.items()) == _counted(rows)


def test_repeated_runs_against_all_pages_of_the_host(spark):
    """Articles, unplaced blocks, copies and repeated rows, over pieces of many and of few pages."""
    rng = random.Random(8)
    phrases = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.randrange(3, 14))) for _ in range(150)]
    rows = []
    for k in range(300):
        blocks = [" ".join(rng.choices(phrases, k=rng.randrange(1, 3)) + [f"w{k}x{j}" for j in range(rng.randrange(9))]) for _ in range(4)]
        name = rng.choice(("article", "div", "main"))
        rows.append((k, f"http://h{k % 3}.example/{k}", f"<{name}><p>{blocks[0]}<p>{blocks[1]}</{name}><div>{blocks[2]}</div><footer>{blocks[3]}</footer>"))
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(0, 300, 5)] + rows[:20] + [(2000, None, rows[0][2]), (2001, "http://h1.example/", rows[0][2]), (2002, "http://h0.example/", None)]
    expected = _counted(rows)
    assert sum(r[3] > 0 for r in expected) > 100 and any(r[3] < r[2] for r in expected)
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 30):
        found = extract_with_repeats(table.repartition(parts)).collect()
        assert sorted(((r["page_id"], r["text"], r["n_words"], r["n_repeated"]) for r in found), key=str) == expected
        assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_keys_of_two_pieces_are_on_several_pages(spark):
    """Weight 1 counts in each piece, weight 0 (copies alone) only asks; two keys that differ in one bit are two."""
    bits, keys = 6, [np.array(k, np.uint64) for k in ([5, 1 << 20, 9 << 30], [5, 1 << 21], [9 << 30])]
    asked = spark.createDataFrame([(0, p, 1 << bits if p < 2 else 0, bytearray(k.tobytes())) for p, k in enumerate(keys)], "bucket long, piece long, cell long, keys binary")
    answers = html_text._answers(asked, bits, lambda data: np.frombuffer(data, np.uint64)).collect()
    assert {r["piece"]: np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=len(keys[r["piece"]])).tolist() for r in answers} == {0: [1, 0, 0], 1: [1, 0], 2: [0]}


@pytest.mark.parametrize(("n", "bits"), [(0, 30), (1, 30), (7000, 30), (500, 9), (3000, 1)])
def test_packed_keys_come_back(n, bits):
    values = np.sort(np.random.default_rng(n).integers(0, 1 << bits, n, dtype=np.uint64))
    assert (unpacked(packed(values, bits)) == values).all()


def test_a_long_block_has_the_same_suffixes_in_parts(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("x" * rng.choice((1, 9, 60)) + str(rng.randrange(40)) for _ in range(n)).encode() for n in (300, 3, 80)]
    whole = Suffixes(texts, np.array([2, 1]), np.array([1, 1]), [])
    monkeypatch.setattr(html_text, "ENCODED_BYTES", 100)
    parts = Suffixes(texts, np.array([2, 1]), np.array([1, 1]), [])
    assert len(list(html_text._cut(texts[0]))) > 10
    assert whole.first.tolist() == parts.first.tolist() and whole.keys.tolist() == parts.keys.tolist()
    assert dict(zip(whole.at.tolist(), whole.entry.tolist(), strict=True)) == dict(zip(parts.at.tolist(), parts.entry.tolist(), strict=True))
