"""Main text of pages: markup says what is an article, a suffix array over each host what is boilerplate."""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Callable
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presskiln.llm.common import BATCH_BYTES, ENCODED_BYTES, SPACED, Words, filesystem, in_pieces, laid_out, mix, releasing, ship, sizes_of, written
from presskiln.operators.skew import join_splittable

# A repeated run has at least so many words.
RUN = 6
# What a block is: beside the text, text, or for the other pages of the host to tell.
BESIDE, TEXT, UNSURE = 0, 1, 2
# Pages that are looked at together: how many blocks each has, what each block is, the texts of all.
PIECE = "piece long, page_id array<long>, url array<string>, host array<long>, page array<long>, blocks array<int>, kinds binary, size int, texts binary"
# Pieces whose answers lie in one folder, and suffixes of a bucket, as powers of two.
TOGETHER, BUCKET = 4, 22
# Leading bits of a suffix by which it is looked for first, in all pages.
SHORT = 36

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "noembed", "noframes", "xmp"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt rtc s samp small span strike strong sub sup time tt u var wbr nobr".split()
)
ASIDE = frozenset("nav header footer aside form menu button select dialog fieldset datalist figure-nav head audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
# Words in a class or id that mark what is beside the text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay "
    "sidebar side widget menu navbar nav navigation breadcrumb breadcrumbs header footer masthead comment comments disqus reply replies discussion share sharing social "
    "related recommended newsletter subscribe subscription signup login pagination pager toolbar".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")


def _beside(name: str, attributes: str) -> bool:
    """Whether an element holds no main text, by its name, role, class or id."""
    if name in ASIDE:
        return True
    if name in ("html", "body", "article", "main") or not attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES:
            return True
        if key in ("class", "id") and any(w in MARKS for part in value.split() for w in _WORD.findall(part)):
            return True
    return False


def blocks_of(page: str) -> list[tuple[str, bool, bool]]:
    """Blocks of text in page order: text, whether in an article or main element, whether beside it.

    Tags may be unclosed or crossed: an end tag closes what is open inside its element, a block
    closes an open paragraph. Scripts, styles and comments are skipped up to their ends.
    """
    out: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, article, beside
    at = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            _, article, beside = stack[-1] if stack else ("", False, False)
            out.append((text, article, beside))

    def close(depth: int) -> None:
        if any(name not in INLINE for name, _, _ in stack[depth:]):
            flush()
        del stack[depth:]

    while m := _TOKEN.search(page, at):
        parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is not None:
                close(depth)
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            parts.append(" ")
        if name in VOID:
            if name == "hr":
                flush()
            continue
        _, article, beside = stack[-1] if stack else ("", False, False)
        if name not in INLINE:
            flush()
            for k in range(len(stack) - 1, -1, -1):  # what a new block closes by itself
                if stack[k][0] == "p" or stack[k][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    del stack[k:]
                    break
                if stack[k][0] not in INLINE:
                    break
            _, article, beside = stack[-1] if stack else ("", False, False)
        inner = beside or _beside(name, m[3])
        if inner and not beside and name in INLINE:
            inner = _beside("", m[3])
        stack.append((name, article or name in ("article", "main"), inner and not (article and name == "header")))
    parts.append(page[at:])
    flush()
    return out


def kinds_of(page: str) -> list[tuple[str, int]]:
    """Blocks of a page with what each is. Where a page has an article or main element, its blocks are
    the text; elsewhere all blocks are unsure that no element marks as beside the text."""
    blocks = blocks_of(page)
    has = any(article and not beside for _, article, beside in blocks)
    return [(text, BESIDE if beside or has and not article else TEXT if has else UNSURE) for text, article, beside in blocks]


def suffixes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The first RUN words, as a hash, of every suffix that has so many inside its text, and its place."""
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    at = np.flatnonzero(words.first[owner + 1] - np.arange(len(owner)) >= RUN)
    return words.grams(RUN)[at], at


def in_order(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes sorted by their first words: one entry for neighbours that share these, with the
    least and the greatest page of them."""
    turn = np.argsort(keys, kind="stable")
    keys, low, high = keys[turn], low[turn], high[turn]
    first = _begins(keys)
    if not len(first):
        return keys, low, high
    return keys[first], np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)


def covered(first: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """How many words of each text lie in runs that begin at ``hits``."""
    n = int(first[-1])
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, hits, 1)
    np.add.at(cover, np.minimum(hits + RUN, n), -1)
    total = np.concatenate(([0], np.cumsum(np.cumsum(cover[:n]) > 0)))
    return total[first[1:]] - total[first[:-1]]


def kept_blocks(kinds: np.ndarray, words: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Which blocks are text, by what markup says and by the words of each that other pages of the host
    hold too: where markup places a block it decides, elsewhere no more than half may be repeated."""
    return (kinds == TEXT) | (kinds == UNSURE) & (2 * repeated <= words)


def main_texts(pages: list[str]) -> list[str]:
    """Main text of each of some pages of one host, by the rule of ``extract``."""
    flat = [(k, *b) for k, page in enumerate(pages) for b in kinds_of(page)]
    words = Words([text.encode() for _, text, _ in flat], SPACED)
    keys, at = suffixes(words)
    names = np.unique(np.array(pages, object), return_inverse=True)[1] if pages else np.zeros(0, np.int64)
    block = np.searchsorted(words.first, at, "right") - 1
    page = names[np.array([k for k, _, _ in flat], np.int64)[block]]
    found, low, high = in_order(keys, page, page)
    repeated = covered(words.first, at[np.isin(keys, found[low != high])])
    kept = kept_blocks(np.array([kind for _, _, kind in flat], np.int64), np.diff(words.first), repeated)
    out: list[list[str]] = [[] for _ in pages]
    for (k, text, _), keep in zip(flat, kept.tolist(), strict=True):
        if keep:
            out[k].append(text)
    return ["\n".join(own) for own in out]


def host_of(url: str | None) -> str:
    try:
        return urlsplit(url or "").hostname or ""
    except ValueError:
        return ""


def _parsed(batches):
    """Pieces of rows of (page_id, url, html, page), about as large as a batch."""
    base, made = TaskContext.get().partitionId() << 36, 0
    for batch in batches:
        for begin, end in in_pieces(sizes_of(batch["html"]), BATCH_BYTES):
            ids, urls, pages, html_ = (batch[c].slice(begin, end - begin) for c in ("page_id", "url", "page", "html"))
            own = [kinds_of(text or "") for text in html_.to_pylist()]
            # White space in blocks is blanks only.
            data = "\n".join([text for blocks in own for text, _ in blocks]).encode()
            row = {
                "piece": base + made, "page_id": ids.to_pylist(), "url": urls.to_pylist(),
                "host": [_host_hash(url) for url in urls.to_pylist()], "page": pages.to_pylist(),
                "blocks": [len(blocks) for blocks in own], "kinds": bytes([kind for blocks in own for _, kind in blocks]),
                "size": len(data), "texts": pa.Codec("zstd", 6).compress(data, asbytes=True),
            }
            yield pa.RecordBatch.from_pylist([row], _PIECE)
            made += 1


def _host_hash(url: str | None) -> int:
    return int.from_bytes(hashlib.blake2b(host_of(url).encode(), digest_size=8).digest(), "little", signed=True)


_LONGS = pa.list_(pa.int64())
_PIECE = pa.schema(
    [
        ("piece", pa.int64()), ("page_id", _LONGS), ("url", pa.list_(pa.string())), ("host", _LONGS), ("page", _LONGS),
        ("blocks", pa.list_(pa.int32())), ("kinds", pa.binary()), ("size", pa.int32()), ("texts", pa.binary()),
    ]
)


class Beside:
    """Rows that a table laid out by ``part`` holds for a piece."""

    def __init__(self, folder: str):
        self.folder, self.part, self.rows = folder, None, {}

    def of(self, piece: int) -> list[dict]:
        if self.part != piece >> TOGETHER:
            self.part, self.rows = piece >> TOGETHER, defaultdict(list)
            store, path = filesystem(f"{self.folder}/part={self.part}")
            if store.get_file_info(path).type != pa.fs.FileType.NotFound:
                for row in pa.parquet.read_table(path, filesystem=store).to_pylist():
                    self.rows[row["piece"]].append(row)
        return self.rows.get(piece, [])


def _begins(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(np.ones(min(len(values), 1), bool), values[1:] != values[:-1]))


def _cut(text: bytes):
    """A text in parts of about ENCODED_BYTES; each but the first begins with the last RUN - 1 words of
    the one before."""
    begin, end = 0, text.find(b" ", ENCODED_BYTES)
    while end > 0:
        back = end
        for _ in range(RUN - 1):
            back = text.rfind(b" ", begin, max(back, begin))
        if back > begin:
            yield text[begin:end]
            begin = back + 1
            end = max(end, begin + ENCODED_BYTES)
        end = text.find(b" ", end + 1)
    yield text[begin:]


class Suffixes:
    """The suffixes of a piece, of which equal ones of a host are one entry: ``keys`` in order of
    ``weights`` and then sorted. The weight is the number of pages an entry is on, 2 for more; pages
    that are a copy of an earlier one do not count. ``at`` and ``entry`` are the place of each suffix
    and its entry, ``first`` is the first word of each block."""

    def __init__(self, texts: list[bytes], blocks: np.ndarray, hosts: np.ndarray, copies: list[int]):
        of = np.repeat(np.arange(len(blocks)), blocks)
        parts = [(k, part, RUN - 1 if j else 0) for k, text in enumerate(texts) for j, part in enumerate(_cut(text))]
        block, again = (np.array([p[c] for p in parts], np.int64) for c in (0, 2))
        keys, at, page, first, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0
        for begin, end in in_pieces([len(p[1]) for p in parts], ENCODED_BYTES):
            words = Words([p[1] for p in parts[begin:end]], SPACED)
            own, places = suffixes(words)
            part = np.searchsorted(words.first, places, "right") - 1
            start = n + words.first[:-1] - np.cumsum(again[begin:end])
            on = of[block[begin:end][part]]
            keys.append(_named(own, hosts[on]))
            at.append(places - words.first[part] + start[part])
            page.append(on)
            first.append(start[again[begin:end] == 0])
            n += len(words.hashes) - int(again[begin:end].sum())
        self.first, self.at = np.concatenate([*first, [n]]).astype(np.int64), np.concatenate(at)
        counts = np.ones(len(blocks), bool)
        counts[copies] = False
        self._sort(np.concatenate(keys), np.concatenate(page), counts)

    def _sort(self, keys: np.ndarray, page: np.ndarray, counts: np.ndarray) -> None:
        turn = np.argsort(keys, kind="stable")
        keys, page = keys[turn], page[turn]
        begin, weights = _begins(keys), np.zeros(0, np.int64)
        if len(begin):
            low = np.minimum.reduceat(np.where(counts[page], page, len(counts)), begin)
            high = np.maximum.reduceat(np.where(counts[page], page, -1), begin)
            weights = np.where(high < 0, 0, np.where(low == high, 1, 2))
        order = np.argsort(weights, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.keys, self.weights = keys[begin][order], weights[order]
        self.entry = np.empty(len(turn), np.int64)
        self.entry[turn] = np.repeat(rank, np.diff(np.append(begin, len(turn))))

    def cells(self, chosen: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Chosen entries by weight and bucket, the leading bits of the key: number of each such cell,
        where it begins among them (and their number)."""
        cell = (self.weights[chosen] << bits) + (self.keys[chosen] >> np.uint64(64 - bits)).astype(np.int64)
        begin = _begins(cell)
        return cell[begin], np.append(begin, len(cell))

    def answered(self, chosen: np.ndarray, bits: int, rows: list[dict]) -> np.ndarray:
        """Those of the chosen entries that the answers to their cells name."""
        cells, begin = self.cells(chosen, bits)
        rows = sorted(rows, key=lambda row: row["cell"])
        if [row["cell"] for row in rows] != cells.tolist():
            raise RuntimeError("answers are of another piece")
        named = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=n) for r, n in zip(rows, np.diff(begin).tolist(), strict=True)]
        return chosen[np.concatenate([np.zeros(0, np.uint8), *named]) == 1]


def _named(keys: np.ndarray, hosts: np.ndarray) -> np.ndarray:
    """Keys of suffixes that are told apart by host."""
    with np.errstate(over="ignore"):
        return mix(keys + hosts.astype(np.uint64))


def packed(values: np.ndarray, bits: int) -> bytes:
    """Sorted values below 2**bits: their last bytes as they are, before these one bit for each value
    and each step of the leading part."""
    n = len(values)
    last = min(range(1, 8), key=lambda k: k * n + (n + (1 << max(bits - 8 * k, 0))) / 8)
    low = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :last])
    marks = (values >> np.uint64(8 * last)).astype(np.int64) + np.arange(n)
    steps = np.zeros(int(marks[-1]) + 1 if n else 0, np.uint8)
    steps[marks] = 1
    return bytes([last]) + n.to_bytes(4, "little") + low.tobytes() + np.packbits(steps).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The values of ``packed``."""
    last, n = data[0], int.from_bytes(data[1:5], "little")
    low = np.zeros((n, 8), np.uint8)
    low[:, :last] = np.frombuffer(data, np.uint8, n * last, 5).reshape(n, last)
    marks = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=5 + n * last)))
    return (marks - np.arange(n)).astype(np.uint64) << np.uint64(8 * last) | low.view("<u8").reshape(n).astype(np.uint64)


def _opened(batches, copies: str):
    """Pieces with the texts of their blocks and their suffixes."""
    copied = Beside(copies)
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch[name][k].as_py() for name in batch.schema.names}
            data = pa.Codec("zstd").decompress(row["texts"], row["size"], asbytes=True)
            texts = data.split(b"\n") if row["kinds"] else []
            own = [r["at"] for r in copied.of(row["piece"])]
            yield row, texts, Suffixes(texts, np.array(row["blocks"], np.int64), np.array(row["host"], np.int64), own)


def _asked(pieces: DataFrame, copies: str, bits: int, before: str | None) -> DataFrame:
    """Cells of the entries of all pieces: at first all entries by their SHORT leading bits; then those
    the answers ``before`` name, by the whole key."""

    def run(batches):
        answers = Beside(before) if before else None
        for row, _, found in _opened(batches, copies):
            chosen = np.arange(len(found.keys))
            if answers:
                chosen = found.answered(chosen, bits, answers.of(row["piece"]))
            keys = found.keys[chosen]
            cells, begin = found.cells(chosen, bits)
            if answers:
                data = [keys[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
            else:
                keys = (keys >> np.uint64(64 - SHORT)) & np.uint64((1 << (SHORT - bits)) - 1)
                data = [packed(keys[a:b], SHORT - bits) for a, b in zip(begin[:-1], begin[1:], strict=True)]
            columns = [pa.array(cells & ((1 << bits) - 1), pa.int64()), pa.array([row["piece"]] * len(cells), pa.int64()), pa.array(cells, pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "piece", "cell", "keys"])

    return pieces.mapInArrow(releasing(run), "bucket long, piece long, cell long, keys binary")


def _answers(asked: DataFrame, bits: int, values: Callable[[bytes], np.ndarray]) -> DataFrame:
    """For each cell which of its entries are on several pages, one bit each. A page counts in one
    piece, so a key that two pieces have with weight 1 is on two pages."""

    def answer(table: pa.Table) -> pa.Table:
        keys = [values(data) for data in table["keys"].to_pylist()]
        weights = [cell >> bits for cell in table["cell"].to_pylist()]
        none = np.zeros(0, np.uint64)
        once = np.sort(np.concatenate([none, *(k for k, w in zip(keys, weights, strict=True) if w == 1)]))
        more = [k for k, w in zip(keys, weights, strict=True) if w == 2]
        found = np.unique(np.concatenate([once[1:][once[1:] == once[:-1]], *more]))
        out = []
        for k in keys:
            at = np.searchsorted(found, k)
            hit = np.zeros(len(k), bool)
            inside = at < len(found)
            hit[inside] = found[at[inside]] == k[inside]
            out.append(np.packbits(hit).tobytes())
        return pa.table({"piece": table["piece"], "cell": table["cell"], "bits": pa.array(out, pa.binary()), "part": pa.compute.shift_right(table["piece"], TOGETHER)})

    return asked.groupBy("bucket").applyInArrow(answer, "piece long, cell long, bits binary, part long")


def _copies(pieces: DataFrame) -> DataFrame:
    """Place of each page whose html an earlier page of the host has too."""
    pages = pieces.select("piece", F.posexplode(F.arrays_zip("host", "page")).alias("at", "_page")).select("piece", "at", "_page.host", "_page.page")
    pages = pages.withColumn("name", F.xxhash64("host", "page")).drop("host", "page")
    several = pages.groupBy("name").agg(F.min(F.struct("piece", "at")).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies = join_splittable(pages, several, "name", "inner").where(F.struct("piece", "at") != F.col("_first"))
    return copies.select("piece", "at", F.shiftright("piece", TOGETHER).alias("part"))


def extract_with_repeats(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_words, n_repeated of every row of (page_id, url, html).

    Where a page has an article or main element, its blocks are the text; elsewhere all blocks
    that no element marks as beside the text. Of the latter, blocks are dropped that consist for
    the larger part of runs of words found on other pages of the host too, and kept where they are
    unique. In articles a passage found in other articles is text like any other; ``n_repeated`` of
    the ``n_words`` words of a text lie in runs that other pages of the host hold too, anywhere.

    Pages are parsed once, into pieces that stay where they are. The suffixes of all blocks of all
    pages are sorted by host and first RUN words, in every piece and then over all: longer runs are
    chains of such entries. Each piece asks the tasks that hold a range of the suffixes which of its
    entries are on several pages: of all entries by their leading bits, then of what these name by
    the whole key. The answers, a bit for an entry, lie in a folder of the piece. So the result does
    not depend on partitions, and no text is shuffled. Pages with equal html are one page: copies keep
    their text. Null and empty html give an empty text; repeated rows stay; null urls are a host
    of their own.
    """
    ship(pages.sparkSession)
    numbered = pages.select("page_id", "url", "html", F.xxhash64("html").alias("page"))
    pieces = written(numbered.mapInArrow(releasing(_parsed), PIECE), "pieces")
    # A piece is taken to have a word for every eight bytes of html.
    bits = max(6, (pieces.count() * (BATCH_BYTES >> 3) >> BUCKET).bit_length())
    copies = laid_out(_copies(pieces), "copies", "part")
    likely = laid_out(_answers(_asked(pieces, copies, bits, None), bits, unpacked), "likely", "part")
    whole = lambda data: np.frombuffer(data, np.uint64)
    several = laid_out(_answers(_asked(pieces, copies, bits, likely), bits, whole), "several", "part")

    def decide(batches):
        first, then = Beside(likely), Beside(several)
        for row, texts, found in _opened(batches, copies):
            chosen = found.answered(np.arange(len(found.keys)), bits, first.of(row["piece"]))
            chosen = found.answered(chosen, bits, then.of(row["piece"]))
            hit = np.zeros(len(found.keys), bool)
            hit[chosen] = True
            words, repeated = np.diff(found.first), covered(found.first, found.at[hit[found.entry]])
            kept = kept_blocks(np.frombuffer(row["kinds"], np.uint8), words, repeated)
            of = np.repeat(np.arange(len(row["blocks"])), row["blocks"])
            own: list[list[bytes]] = [[] for _ in row["blocks"]]
            for block in np.flatnonzero(kept).tolist():
                own[of[block]].append(texts[block])
            main = [b"\n".join(parts).decode() for parts in own]
            n_words, n_repeated = (np.bincount(of, c * kept, len(own)).astype(np.int64) for c in (words, repeated))
            columns = [pa.array(row["page_id"], pa.int64()), pa.array(row["url"], pa.string()), pa.array(main, pa.string()), pa.array([len(t) for t in main], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words), pa.array(n_repeated)], ["page_id", "url", "text", "n_chars", "n_words", "n_repeated"])

    return pieces.mapInArrow(releasing(decide), "page_id long, url string, text string, n_chars long, n_words long, n_repeated long")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of (page_id, url, html), as ``extract_with_repeats``."""
    return extract_with_repeats(pages).select("page_id", "url", "text", "n_chars")


def op8_main_text(spark, sf_dir: str) -> DataFrame:
    return extract_with_repeats(spark.read.parquet(f"{sf_dir}/pages.parquet"))
