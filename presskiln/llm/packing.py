"""Packing documents into training sequences with a fixed number of open windows per partition."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presskiln.llm.common import ENCODED_BYTES, in_pieces, releasing, ship, sizes_of, written
from presskiln.llm.tokens import WordEncoder, encoder

SEQUENCE = 4096
OPEN_WINDOWS = 64
# Leftover windows of so many partitions are merged together.
MERGED_PARTITIONS = 32
FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACED = PIECE + ", sequence_id long, offset long"


class Packer:
    """Places pieces of at most ``size`` tokens, with at most ``open_windows`` windows open.

    A piece goes where it leaves least room. If none has room and all windows are open, the
    fullest is given out. ``close`` gives out the rest.
    """

    def __init__(self, size: int = SEQUENCE, open_windows: int = OPEN_WINDOWS):
        self.size, self.most = size, open_windows
        self.room: list[tuple[int, int]] = []  # (free tokens, window), in order
        self.windows: dict[int, list[tuple]] = {}
        self.made = 0

    def add(self, piece: tuple, length: int) -> list[tuple] | None:
        """Place a piece; the pieces of a window that had to be given out, if any."""
        at, out = bisect_left(self.room, (length, -1)), None
        if at < len(self.room):
            free, window = self.room.pop(at)
        else:
            if len(self.room) >= self.most:
                out = self.windows.pop(self.room.pop(0)[1])
            free, window = self.size, self.made
            self.made += 1
            self.windows[window] = []
        self.windows[window].append(piece)
        if free == length:
            full = self.windows.pop(window)
            if out is None:
                return full
            self.windows[window] = full  # one at a time: it goes out as the fullest later
        insort(self.room, (free - length, window))
        return out

    def close(self) -> Iterator[list[tuple]]:
        for window in sorted(self.windows):
            yield self.windows[window]


def _rows(windows: Iterator[tuple[int, list[tuple]]]) -> Iterator[pa.RecordBatch]:
    """Batches of placed pieces from (sequence id, pieces)."""
    rows: list[tuple] = []
    for sequence, pieces in windows:
        offset = 0
        for piece in pieces:
            rows.append((*piece, sequence, offset))
            offset += piece[2]
        if len(rows) >= 2000:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    names = [*FIELDS, "sequence_id", "offset"]
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pieces_of(doc_id: int | None, ids: np.ndarray, keep_ids: bool, size: int = SEQUENCE) -> Iterator[tuple]:
    """A document's ids cut into pieces of at most ``size``."""
    for start in range(0, len(ids), size):
        part = ids[start : start + size]
        crc = zlib.crc32(part.astype("<u4").tobytes())
        yield doc_id, start, len(part), crc, len(ids), part.tobytes() if keep_ids else None


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, keep_ids: bool = True) -> DataFrame:
    """Pieces of all documents (doc_id, text), each with its sequence_id and offset.

    Tokens and windows are made in one pass over each input partition, without a shuffle. The
    windows still open at the end of a partition are merged with those of its neighbours by the
    same rule, again and again until one group is left; whole windows, at most OPEN_WINDOWS a
    partition, are all that moves. Each document longer than a sequence is cut at multiples of
    it; others stay whole. Null or empty texts hold just ``end_id``; repeated rows and doc_ids
    are packed as rows of their own; a null doc_id stays null. Sequence ids are unique, not
    dense: level and partition are in the high bits. An empty table gives no rows.
    """
    ship(docs.sparkSession)

    def first(batches):
        context = TaskContext.get()
        encode_all = encoder(WordEncoder, tokenizer).encode_all
        end = np.array([end_id], np.uint16).tobytes()
        packer = Packer()
        base = context.partitionId() << 36

        def full():
            made = 0
            for batch in batches:
                doc_ids = batch["doc_id"].to_pylist()
                for begin, stop in in_pieces(sizes_of(batch["text"]), 4 * ENCODED_BYTES):
                    texts = [t or "" for t in batch["text"].slice(begin, stop - begin).to_pylist()]
                    for doc_id, data in zip(doc_ids[begin:stop], encode_all(texts), strict=True):
                        for piece in pieces_of(doc_id, np.frombuffer(data + end, "<u2"), keep_ids):
                            if (window := packer.add(piece, piece[2])) is not None:
                                yield base + made, window
                                made += 1

        yield from _rows(full())
        yield from _rows((-1 - (base + k), w) for k, w in enumerate(packer.close()))

    placed = written(docs.select("doc_id", "text").mapInArrow(releasing(first, "encoders"), PLACED), "packed")
    done, left = placed.where("sequence_id >= 0"), placed.where("sequence_id < 0")
    partition = F.shiftright(-1 - F.col("sequence_id"), 36)
    last = left.agg(F.max(partition)).first()[0]
    groups, level = (0 if last is None else last) + 1, 1
    while True:
        groups = -(-groups // MERGED_PARTITIONS)
        merged = written(_merge(left.withColumn("_group", partition % groups), level, groups == 1), "packed")
        done = done.unionByName(merged.where("sequence_id >= 0"))
        if groups == 1:
            return done.select(*[c for c in done.columns if keep_ids or c != "ids"])
        left, level = merged.where("sequence_id < 0"), level + 1


def _merge(left: DataFrame, level: int, last: bool) -> DataFrame:
    """Pack the pieces of open windows again, by groups of up to MERGED_PARTITIONS partitions.

    Windows that are still open after the ``last`` level are given out as they are.
    """

    def merge(key, table):
        base = (level << 56) | (int(key[0].as_py()) << 36)
        rows = sorted(
            zip(*(table[n].to_pylist() for n in FIELDS), table["sequence_id"].to_pylist(), table["offset"].to_pylist(), strict=True),
            key=lambda r: (-r[2], -r[6], r[7]),
        )
        packer, windows = Packer(), []
        for row in rows:  # longest first: few windows are left half empty
            if (window := packer.add(row[:6], row[2])) is not None:
                windows.append((base + len(windows), window))
        n = len(windows)
        for k, window in enumerate(packer.close()):
            windows.append((base + n + k if last else -1 - (base + k), window))
        batches = list(_rows(iter(windows)))
        return pa.Table.from_batches(batches)

    return left.groupBy("_group").applyInArrow(merge, PLACED)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
