"""Phrases of two and three words that stick together, from stripes of next-word counters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presskiln.llm.common import frame_bytes, framed, in_pieces, mix, ship, written
from presskiln.operators.skew import join_splittable

LEAST, SHARE, TOP, SCALE = 10, 50, 2000, 1_000_000
# Fixed value: the language of texts without one.
UNKNOWN = "und"
# Bytes of text that are cut into words at a time, and entries of counters a task holds before it
# sends them on. Word numbers of a task have 21 bits, so that three of them fit a 64-bit integer.
PIECE_BYTES, HELD, BITS = 4 << 20, 1 << 21, 21
# Bytes of text whose counters one bucket takes in when tasks' counters are merged.
BUCKET_BYTES = 8 << 20
SALTS = 32

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(46 if b in _BREAKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIXED = np.uint64(0x9E3779B97F4A7C15)
# Arrays of a block: words (hash, count), their language, sizes and bytes; then heads of stripes
# with their number of entries, the entries' next words, counts and numbers of children, and the
# children's next words and counts.
_KINDS = ("u8", "u8", "u2", "u4", "u1", "u8", "u4", "u8", "u8", "u4", "u8", "u8")


class Numbers(dict):
    """Words to numbers in the order they come, from 1: a break stands in it as 0 from the start."""

    def __missing__(self, word):
        number = len(self)
        self[word] = number
        return number


def summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorter, starts, sums): rows sorted by the keys, the last one first; the sorted rows at which
    another key begins; and the sum of the counts of each key."""
    order = np.lexsort(keys)
    if not len(order):
        return order, order, counts
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    return order, starts, np.add.reduceat(counts[order], starts)


class Stripes:
    """Counters of one task: per language the words, and of each word and each two words the next."""

    def __init__(self):
        self.langs: dict[str, tuple] = {}
        self.held = 0

    def add(self, lang: str, texts: list[bytes]) -> None:
        """Count the words and runs of two and three words inside the pieces of the texts."""
        numbers, words, pairs, triples = self.langs.setdefault(lang, (Numbers({b".": 0}), [], [], []))
        found = b" . ".join(texts).translate(_TABLE).replace(b".", b" . ").split()
        ids = np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))
        words.append(np.unique(ids[ids > 0], return_counts=True))
        two = (ids[:-1] > 0) & (ids[1:] > 0)
        pair = ids[:-1] << BITS | ids[1:]
        pairs.append(np.unique(pair[two], return_counts=True))
        three = two[:-1] & (ids[2:] > 0)
        triples.append(np.unique((pair[:-1] << BITS | ids[2:])[three], return_counts=True))
        self.held += len(pairs[-1][0]) + len(triples[-1][0])

    def full(self) -> bool:
        return self.held > HELD or any(len(c[0]) >= 1 << BITS - 1 for c in self.langs.values())

    def blocks(self, buckets: int):
        """(bucket, block) of all that is held, which is given up."""
        langs, self.langs, self.held = self.langs, {}, 0
        for lang, (numbers, words, pairs, triples) in langs.items():
            names = [b"", *list(numbers)[1:]]
            seed = xxhash.xxh3_64_intdigest(lang.encode())
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in names), np.uint64, len(names))
            merged = []
            for kept in (words, pairs, triples):
                keys, counts = (np.concatenate(c) for c in zip(*kept, strict=True))
                order, starts, sums = summed([keys], counts)
                merged.append((keys[order][starts], sums))
            (word, n1), (pair, n2), (triple, n3) = merged
            mask = (1 << BITS) - 1
            # Keys are sorted, so the entries of a prefix stand together: they are its stripe.
            head, after = pair >> BITS, pair & mask
            entry = np.searchsorted(pair, triple >> BITS)
            with np.errstate(over="ignore"):
                home = (mix(hashes[head]) + mix(hashes[after] ^ _MIXED)) % np.uint64(buckets)
            word_home, child_home = mix(hashes[word]) % np.uint64(buckets), home[entry]
            places = [np.argsort(h, kind="stable") for h in (word_home, home, child_home)]
            cuts = [
                np.searchsorted(h[p], np.arange(buckets + 1, dtype=np.uint64))
                for h, p in zip((word_home, home, child_home), places, strict=True)
            ]
            children = np.bincount(entry, minlength=len(pair))
            for b in range(buckets):
                w, p, t = (place[cut[b] : cut[b + 1]] for place, cut in zip(places, cuts, strict=True))
                if not len(w) + len(p):
                    continue
                heads, sizes = np.unique(head[p], return_counts=True)
                texts = [names[k] for k in word[w]]
                yield b, zstandard.compress(
                    frame_bytes(
                        [
                            hashes[word[w]], n1[w].astype("u8"), np.frombuffer(lang.encode("utf-16-le"), "u2"),
                            np.array([len(x) for x in texts], "u4"), np.frombuffer(b"".join(texts), "u1"),
                            hashes[heads], sizes.astype("u4"), hashes[after[p]], n2[p].astype("u8"), children[p].astype("u4"),
                            hashes[triple[t] & mask], n3[t].astype("u8"),
                        ]
                    ),
                    1,
                )


def pieces(text: bytes):
    """The text in parts of about PIECE_BYTES; a part ends at a break, where no phrase is cut."""
    begin = 0
    while len(text) - begin > 2 * PIECE_BYTES:
        end = max(text.rfind(c, begin, begin + PIECE_BYTES) for c in (b".", b",", b"\n", b"!", b"?", b";", b":"))
        if end <= begin:
            later = [k for c in (b".", b",", b"\n", b"!", b"?", b";", b":") if (k := text.find(c, begin + PIECE_BYTES)) >= 0]
            if not later:
                break
            end = min(later)
        yield text[begin:end]
        begin = end
    yield text[begin:]


def count_stripes(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block): the counters of all texts, summed up inside each task first."""

    def run(batches):
        stripes = Stripes()

        def sent():
            for bucket, block in stripes.blocks(buckets):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([block], pa.binary())], ["bucket", "block"])

        for batch in batches:
            by_lang: dict[str, list[int]] = {}
            for k, lang in enumerate(batch["lang"].to_pylist()):
                by_lang.setdefault(lang, []).append(k)
            for lang, rows in by_lang.items():
                texts = batch["text"].take(pa.array(rows))
                sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
                for begin, end in in_pieces(sizes, PIECE_BYTES):
                    some = [x.encode() for x in texts[begin:end].to_pylist() if x]
                    parts = [part for text in some for part in pieces(text)]
                    for a, b in in_pieces(map(len, parts), PIECE_BYTES):
                        stripes.add(lang, parts[a:b])
                        if stripes.full():
                            yield from sent()
        yield from sent()

    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    return rows.mapInArrow(run, "bucket int, block binary")


MERGED = "kind int, lang string, word string, h1 long, h2 long, h3 long, f long, longer long"


def merged_rows(blocks: list[bytes], least: int) -> pa.RecordBatch:
    """One bucket's blocks, merged entry by entry: words (kind 1), extensions of words (2) and of
    two words (3) that occur ``least`` times; of an extension its most frequent own one (``longer``),
    and of each language all occurrences of this bucket's words (kind 0)."""
    parts = [framed(zstandard.decompress(b), _KINDS) for b in blocks]
    columns = {name: [] for name in ("kind", "lang", "word", "h1", "h2", "h3", "f", "longer")}

    def out(kind, n, **given):
        for name in columns:
            value = kind if name == "kind" else given.get(name)
            columns[name].append(value if isinstance(value, list) else value.tolist() if isinstance(value, np.ndarray) else [value] * n)

    langs = [p[2].tobytes().decode("utf-16-le") for p in parts]
    hashes, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order, starts, sums = summed([hashes], counts.astype(np.int64))
    often = np.flatnonzero(sums >= least)
    picked = order[starts[often]] if len(often) else often
    offsets = np.cumsum([0] + [len(p[0]) for p in parts])
    owner = np.searchsorted(offsets, picked, side="right") - 1
    ends = [np.cumsum(p[3], dtype=np.int64) for p in parts]
    words = []
    for k, o in zip(picked, owner, strict=True):
        at = k - offsets[o]
        end = ends[o][at]
        words.append(parts[o][4][end - parts[o][3][at] : end].tobytes().decode())
    out(1, len(words), lang=[langs[o] for o in owner], word=words, h1=hashes[picked].view(np.int64), f=sums[often])
    totals: dict[str, int] = {}
    for lang, p in zip(langs, parts, strict=True):
        totals[lang] = totals.get(lang, 0) + int(p[1].sum())
    out(0, len(totals), lang=list(totals), f=list(totals.values()))

    head = np.concatenate([np.repeat(p[5], p[6]) for p in parts])
    after, n2, children = (np.concatenate([p[k] for p in parts]) for k in (7, 8, 9))
    order, starts, f2 = summed([after, head], n2.astype(np.int64))
    merged = np.zeros(len(order), np.int64)  # the merged entry of each entry
    if len(order):
        marks = np.zeros(len(order), np.int64)
        marks[starts[1:]] = 1
        merged[order] = np.cumsum(marks)
    one, two = head[order[starts]] if len(order) else head, after[order[starts]] if len(order) else after
    child, n3 = (np.concatenate([p[k] for p in parts]) for k in (10, 11))
    entry = np.repeat(merged, children)
    order, starts, f3 = summed([child, entry], n3.astype(np.int64))
    entry, child = (entry[order[starts]], child[order[starts]]) if len(order) else (entry, child)
    often = f3 >= least
    longer = np.zeros(len(f2), np.int64)
    np.maximum.at(longer, entry[often], f3[often])
    entry, child, f3 = entry[often], child[often], f3[often]
    out(3, len(f3), h1=one[entry].view(np.int64), h2=two[entry].view(np.int64), h3=child.view(np.int64), f=f3)
    often = f2 >= least
    out(2, int(often.sum()), h1=one[often].view(np.int64), h2=two[often].view(np.int64), f=f2[often], longer=longer[often])
    kinds = {"kind": pa.int32(), "lang": pa.string(), "word": pa.string()}
    arrays = [pa.array([x for part in columns[name] for x in part], kinds.get(name, pa.int64())) for name in columns]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def merge_stripes(blocks: DataFrame, least: int) -> DataFrame:
    """Rows of ``merged_rows``; a task takes in the blocks of one bucket after another."""

    def run(batches):
        bucket, held = None, []
        for batch in batches:
            for b, block in zip(batch["bucket"].to_pylist(), batch["block"], strict=True):
                if b != bucket:
                    if held:
                        yield merged_rows(held, least)
                    bucket, held = b, []
                held.append(block.as_py())
        if held:
            yield merged_rows(held, least)

    return blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, MERGED)


def mine_phrases(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """The strongest phrases of two and three words of each language, with their counts.

    ``docs`` holds ``text`` and ``lang``; other columns are not looked at. Lower-cased (A-Z) texts
    are split into pieces at ``.,;:!?`` and line ends, those into words at blanks and tabs. A phrase
    is a candidate that occurs ``least`` times in pieces. Cut in two, l and r are the counts of its
    parts and a its own: its score is floor(10**6 * a * a / (l * r)) at the cut where that is least,
    of equal ones the first. Candidates inside a longer candidate of ``share`` percent of their
    count are dropped. Of each language the first ``top`` by score and count descending, then
    phrase, as (lang, rank, phrase, a, l, r, n, score); n counts all words of the language.

    Method: a word keys a counter of its next words, and each of those a counter of the words after
    the two: a stripe. A task sums up stripes over its texts; they are dealt out by word and next
    word, so a frequent word's stripe lies in slices all over the cluster, and merged entry by entry.
    Extensions, totals of prefixes and the most frequent extension of each phrase come from them.
    Words are told apart by 64-bit hashes (seeded by language); a phrase is the hashes of its words.

    A null language is ``und``; null and empty texts have no words; repeated rows count each time;
    an empty table gives no rows. A text of any length is counted whole, some megabytes at a time
    where it holds breaks. Memory follows the entries held by a task (HELD) and the text of a bucket
    (BUCKET_BYTES), and the distinct words after any one pair of words.
    """
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    found = written(merge_stripes(count_stripes(docs, buckets), least), "stripes")
    words = found.where("kind = 1").select("h1", "lang", "word", "f")
    pairs = found.where("kind = 2").select("h1", "h2", "f", "longer")
    triples = found.where("kind = 3").select("h1", "h2", "h3", "f")
    totals = found.where("kind = 0").groupBy("lang").agg(F.sum("f").alias("n"))

    first = words.select("h1", "lang", F.col("word").alias("w1"), F.col("f").alias("f1"))
    last = words.select(F.col("h1").alias("h2"), F.col("word").alias("w2"), F.col("f").alias("f2"))
    named = join_splittable(join_splittable(pairs, first, "h1", "inner"), last, "h2", "inner")
    named = written(named.withColumn("pair", F.struct("h1", "h2")), "pairs")

    front = named.select("pair", "lang", F.concat_ws(" ", "w1", "w2").alias("w12"), "f1", F.col("f").alias("f12"))
    back = named.select(F.col("pair").alias("rear"), F.col("f").alias("f23"))
    third = words.select(F.col("h1").alias("h3"), F.col("word").alias("w3"), F.col("f").alias("f3"))
    full = triples.withColumn("pair", F.struct("h1", "h2")).withColumn(
        "rear", F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2"))
    )
    full = join_splittable(join_splittable(full, front, "pair", "inner"), back, "rear", "inner")
    full = join_splittable(full, third, "h3", "inner")

    def cut(k, left, right):
        parts = f"cast({left} as decimal(38,0)) * {right}"
        return F.expr(f"struct(cast(f as decimal(38,0)) * f * {SCALE} div ({parts}) as score, {k} as k, {left} as l, {right} as r)")

    before = triples.groupBy(F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")).alias("pair")).agg(F.max("f").alias("behind"))
    two = join_splittable(named, before, "pair", "left").where(
        F.greatest("longer", F.coalesce("behind", F.lit(0))) * 100 < F.lit(share) * F.col("f")
    )
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), cut(1, "f1", "f2").alias("cut"))
    three = full.select(
        "lang", F.concat_ws(" ", "w12", "w3").alias("phrase"), F.col("f").alias("a"),
        F.array_min(F.array(cut(1, "f1", "f23"), cut(2, "f12", "f3"))).alias("cut"),
    )
    every = two.unionByName(three).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A language may hold most phrases: parts of it are cut to ``top`` first.
    salted = every.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "_salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return salted.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir: str) -> DataFrame:
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = rf"""WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
f AS (
  SELECT lang, p, count(*) AS f FROM (
    SELECT lang, list_slice(w, i, i + k - 1) AS p FROM places, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w))
  GROUP BY ALL),
c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= {LEAST}),
longer AS (
  SELECT lang, part, max(a) AS most FROM (SELECT lang, a, unnest([list_slice(p, 1, 2), list_slice(p, 2, 3)]) AS part FROM c WHERE len(p) = 3)
  GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.p, a, k, l.f AS l, r.f AS r, ({SCALE}::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, k)
  JOIN f r ON r.lang = c.lang AND r.p = list_slice(c.p, k + 1, len(c.p))),
least AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM cuts) WHERE place = 1),
ranked AS (
  SELECT least.*, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY least.lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM least LEFT JOIN longer ON longer.lang = least.lang AND longer.part = least.p WHERE coalesce(100 * most < {SHARE} * a, true)),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang)
SELECT ranked.lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= {TOP}"""
