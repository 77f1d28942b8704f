"""Benchmark decontamination by winnowing: shared fingerprints, extended to whole shared spans."""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presskiln.llm.common import (
    ENCODED_BYTES, KEPT, LETTERED, Words, filesystem, in_pieces, releasing, shared_folder, ship, sizes_of, texts_of, written,
)

# Words of a window that counts as a hit, words of a fingerprinted run, and runs of which the
# least is kept: a shared span of WINDOW words holds LEAST runs of GRAM words.
WINDOW, GRAM = 10, 5
LEAST = WINDOW - GRAM + 1
# Benchmark text of one index; a larger benchmark has several, read one at a time.
INDEX_BYTES = 32 << 20
_INDEXES: dict[str, Index] = KEPT["indexes"]


def fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of the rightmost least run in every window of WINDOW words of one text."""
    grams = words.grams(GRAM)
    n = len(grams) - LEAST + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least, place = grams[LEAST - 1 :].copy(), np.arange(n) + LEAST - 1
    for j in range(LEAST - 2, -1, -1):
        other = grams[j : j + n]
        less = other < least
        least[less] = other[less]
        place[less] -= place[less] - (np.flatnonzero(less) + j)
    inside = _text_of(words, np.arange(n)) == _text_of(words, np.arange(n) + WINDOW - 1)
    place = np.unique(place[inside])
    return grams[place], place


def _text_of(words: Words, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.first, places, "right") - 1


class Index:
    """Fingerprints of benchmark items and their words; items under WINDOW words as one run."""

    ARRAYS = ("ids", "hashes", "first", "gram", "gram_item", "gram_at", "short_n", "short", "short_item", "spans", "text")

    def __init__(self, **arrays: np.ndarray):
        for name in self.ARRAYS:
            setattr(self, name, arrays[name])

    @classmethod
    def of(cls, ids: list[str], texts: list[bytes]) -> Index:
        words = Words(texts, LETTERED)
        lengths = np.diff(words.first)
        value, place = fingerprints(words)
        item = _text_of(words, place)
        order = np.argsort(value, kind="stable")
        short = [(int(n), words.grams(int(n))[words.first[i]], i) for i, n in enumerate(lengths) if 0 < n < WINDOW]
        short.sort()
        spans = np.stack([words.starts, words.ends], 1) if len(words.starts) else np.zeros((0, 2), np.int64)
        return cls(
            ids=np.array(ids, "U"), hashes=words.hashes, first=words.first, gram=value[order], gram_item=item[order],
            gram_at=place[order], short_n=np.array([s[0] for s in short], np.int64),
            short=np.array([s[1] for s in short], np.uint64), short_item=np.array([s[2] for s in short], np.int64),
            spans=spans, text=np.frombuffer(words.data, np.uint8),
        )

    def save(self, uri: str) -> None:
        store, path = filesystem(uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        data = io.BytesIO()
        np.savez(data, **{name: getattr(self, name) for name in self.ARRAYS})
        with store.open_output_stream(path, compression=None) as out:
            out.write(data.getvalue())

    @classmethod
    def load(cls, uri: str, keep: bool) -> Index:
        if uri not in _INDEXES:
            store, path = filesystem(uri)
            with store.open_input_file(path) as file, np.load(io.BytesIO(file.read())) as arrays:
                index = cls(**{name: arrays[name] for name in cls.ARRAYS})
            if not keep:
                return index
            _INDEXES.clear()
            _INDEXES[uri] = index
        return _INDEXES[uri]

    def runs(self, words: Words) -> list[tuple[int, int, int]]:
        """(item, first word, end) of all shared spans of WINDOW words or more and of all whole
        shorter items, over all texts of ``words``."""
        out: list[tuple[int, int, int]] = []
        value, place = fingerprints(words)
        low = np.searchsorted(self.gram, value)
        hit = np.flatnonzero(low < len(self.gram))
        hit = hit[self.gram[low[hit]] == value[hit]]
        done: dict[tuple[int, int], int] = {}
        bounds = words.first
        for k, text in zip(hit.tolist(), _text_of(words, place[hit]).tolist(), strict=True):
            at, g = int(place[k]), int(low[k])
            begin, end = int(bounds[text]), int(bounds[text + 1])
            while g < len(self.gram) and self.gram[g] == value[k]:
                item, its = int(self.gram_item[g]), int(self.gram_at[g])
                g += 1
                if done.get((item, at - its), -1) > at:
                    continue  # inside a span that is extended already
                left = min(at - begin, its - int(self.first[item]))
                right = min(end - at, int(self.first[item + 1]) - its)
                same = words.hashes[at - left : at + right] == self.hashes[its - left : its + right]
                other = np.flatnonzero(~same)
                split = int(np.searchsorted(other, left))
                a = at - left + (int(other[split - 1]) + 1 if split else 0)
                b = at - left + (int(other[split]) if split < len(other) else left + right)
                done[item, at - its] = b
                if b - a >= WINDOW and self._equal(words, a, b, its - at):
                    out.append((item, a, b))
        for n in np.unique(self.short_n).tolist():
            own = self.short_n == n
            table, items = self.short[own], self.short_item[own]  # in order of the hash
            grams = words.grams(n)
            low = np.searchsorted(table, grams)
            hit = np.flatnonzero(low < len(table))
            hit = hit[table[low[hit]] == grams[hit]]
            hit = hit[_text_of(words, hit) == _text_of(words, hit + n - 1)]
            for at in hit.tolist():
                g = int(low[at])
                while g < len(table) and table[g] == grams[at]:
                    item = int(items[g])
                    if self._equal(words, at, at + n, int(self.first[item]) - at):
                        out.append((item, at, at + n))
                    g += 1
        return out

    def _equal(self, words: Words, a: int, b: int, shift: int) -> bool:
        """Whether the words are the same, letter by letter."""
        mine = words.data[words.starts[a] : words.ends[b - 1]].split()
        own = self.text[self.spans[a + shift, 0] : self.spans[b - 1 + shift, 1]].tobytes().split()
        return mine == own


def build_indexes(benchmark: DataFrame) -> list[str]:
    """Write the indexes of (item_id, text), built by tasks; give their places, one or more.

    Null item_ids are left out; null texts have no words. The number of indexes follows the size
    of the texts, so none has to fit a fixed benchmark.
    """
    spark = ship(benchmark.sparkSession)
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // INDEX_BYTES + 1
    folder = shared_folder(spark, "winnowing")

    def build(table: pa.Table) -> pa.Table:
        uri = f"{folder}/{table['block'][0].as_py()}.npz"
        Index.of(table["item_id"].to_pylist(), texts_of(table["text"])).save(uri)
        return pa.table({"uri": [uri]})

    spread = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    built = written(spread.groupBy("block").applyInArrow(build, "uri string"), "winnowing-list")
    return sorted(r["uri"] for r in built.collect())


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Columns of ``docs`` (with a ``text``) and n_words, n_hit, items, of every row.

    ``items`` are the ids, as text and in order, of benchmark items of which a window occurs;
    ``n_hit`` counts words inside an occurrence. Documents are read once and not shuffled. Null
    and empty texts have no words; repeated rows stay; an empty benchmark hits nothing. Columns
    of ``docs`` named like a result are replaced.
    """
    uris = build_indexes(benchmark)
    names = [c for c in docs.columns if c not in ("n_words", "n_hit", "items")]

    def find(batches):
        for batch in batches:
            columns: list[list] = [[], [], []]
            column = batch["text"]
            for begin, end in in_pieces(sizes_of(column), ENCODED_BYTES):
                words = Words(texts_of(column.slice(begin, end - begin)), LETTERED)
                marks = np.zeros(len(words.hashes), bool)
                items: list[set[str]] = [set() for _ in range(begin, end)]
                for uri in uris:
                    index = Index.load(uri, keep=len(uris) == 1)
                    runs = index.runs(words)
                    for (item, a, b), text in zip(runs, _text_of(words, np.array([r[1] for r in runs], np.int64)), strict=True):
                        marks[a:b] = True
                        items[text].add(str(index.ids[item]))
                hits = np.concatenate(([0], np.cumsum(marks)))[words.first]
                columns[0] += np.diff(words.first).tolist()
                columns[1] += np.diff(hits).tolist()
                columns[2] += [sorted(i) for i in items]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()))
            more = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch[n] for n in names] + more, [*names, "n_words", "n_hit", "items"])

    out = docs.select(*names)
    for name, kind in (("n_words", "long"), ("n_hit", "long"), ("items", "array<string>")):
        out = out.withColumn(name, F.lit(None).cast(kind))
    return docs.select(*names).mapInArrow(releasing(find, "indexes"), out.schema)


def digest(leaks: DataFrame) -> DataFrame:
    return leaks.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text"))
