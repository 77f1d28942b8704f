"""Token ids in seekable files: independent zstandard frames with a seek table at the end.

Layout of a file (all integers little-endian):

* frames: each one whole zstandard frame with a content checksum, holding the 16-bit ids of some
  whole documents, one after another; a document never spans two frames;
* a skippable frame with the documents: zstandard-compressed columns of id, null flag of the id,
  frame number, offset in the frame and length, both in ids;
* a skippable frame with the seek table of the zstandard seekable format: compressed size, plain
  size and checksum of every frame, then their number, a flag byte and a magic number.

A reader takes the two tables from the end of the file, then reads and decompresses only the
frames of the documents it wants, and checks each against its checksum.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presskiln.llm.common import (
    ENCODED_BYTES, filesystem, frame_bytes, framed, in_pieces, reading_tasks, releasing, shared_folder, ship, sizes_of, written,
)
from presskiln.llm.tokens import ByteEncoder, encoder

# Magic numbers of the zstandard seekable format and of a skippable frame.
SEEK_FRAME, SEEK_FOOTER, TABLE_FRAME = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
FRAME_BYTES = 1 << 18
COLUMNS = ("<i8", "u1", "<u4", "<u8", "<u8")


class TokenWriter:
    """Writes one file; documents come in file order."""

    def __init__(self, out):
        self.out, self.pack = out, zstandard.ZstdCompressor(level=1, write_checksum=True)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int, int, int]] = []
        self.parts: list[bytes] = []
        self.filled = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.filled and self.filled + len(ids) > FRAME_BYTES:
            self._flush()
        self.docs.append((doc_id or 0, doc_id is None, len(self.frames), self.filled // 2, len(ids) // 2))
        self.parts.append(ids)
        self.filled += len(ids)

    def _flush(self) -> None:
        plain = b"".join(self.parts)
        data = self.pack.compress(plain)
        self.frames.append((len(data), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.out.write(data)
        self.parts, self.filled = [], 0

    def close(self) -> None:
        if self.parts:
            self._flush()
        columns = [np.array([d[k] for d in self.docs], kind) for k, kind in enumerate(COLUMNS)]
        table = self.pack.compress(frame_bytes(columns))
        self.out.write(struct.pack("<II", TABLE_FRAME, len(table)) + table)
        entries = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0x80, SEEK_FOOTER)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(entries) + len(footer)) + entries + footer)


class TokenReader:
    """Reads the tables of a file, then the frames that are asked for."""

    def __init__(self, file, size: int):
        self.file = file
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_FOOTER or flags != 0x80:
            raise ValueError("no seek table at the end of the file")
        begin = size - 9 - 12 * count - 8
        head = struct.unpack("<II", self._at(begin, 8))
        if head != (SEEK_FRAME, 12 * count + 9):
            raise ValueError("broken seek table")
        self.frames = np.frombuffer(self._at(begin + 8, 12 * count), "<u4").reshape(count, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.frames[:, 0], dtype=np.int64)))
        at = int(self.starts[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        if magic != TABLE_FRAME:
            raise ValueError("broken document table")
        unpacked = zstandard.ZstdDecompressor().decompress(self._at(at + 8, length))
        self.doc_ids, self.nulls, self.frame_of, self.offsets, self.lengths = framed(unpacked, COLUMNS)

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def frame(self, k: int) -> np.ndarray:
        packed, plain, checksum = (int(x) for x in self.frames[k])
        data = zstandard.ZstdDecompressor().decompress(self._at(int(self.starts[k]), packed), plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} does not match its checksum")
        return np.frombuffer(data, "<u2")

    def ids(self, places: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """(place, ids) of the documents at these places of the table, each frame read once."""
        last, data = -1, None
        for i in sorted(places, key=lambda i: (self.frame_of[i], i)):
            if self.frame_of[i] != last:
                last = int(self.frame_of[i])
                data = self.frame(last)
            yield i, data[int(self.offsets[i]) : int(self.offsets[i]) + int(self.lengths[i])]

    def find(self, doc_ids: Iterable[int]) -> dict[int, list[np.ndarray]]:
        """Ids of the documents with these doc_ids (several for a repeated doc_id)."""
        wanted = np.flatnonzero(np.isin(self.doc_ids, list(doc_ids)) & (self.nulls == 0))
        out: dict[int, list[np.ndarray]] = {}
        for i, ids in self.ids(wanted.tolist()):
            out.setdefault(int(self.doc_ids[i]), []).append(ids)
        return out


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0) -> DataFrame:
    """Write (doc_id, text) as token files in ascending doc_id order; give the list of files.

    Rows are range-partitioned by doc_id and the text's hash, so repeated ids do not pile up, and
    every partition streams into one file. Null and empty texts hold just ``end_id``; a null
    doc_id comes first; rows with one doc_id follow the hash of their text, equal rows are equal
    anyway. Returns one row a file: shard, path, bytes, n_docs, n_tokens. A retried task writes
    under another name, and only files of tasks that ended well are listed. An empty table gives
    files without documents or none.
    """
    spark = ship(docs.sparkSession)

    def write(batches):
        context = TaskContext.get()
        encode_all = encoder(ByteEncoder, tokenizer).encode_all
        end = np.array([end_id], np.uint16).tobytes()
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        path = f"{root}/{context.partitionId():06d}-{context.taskAttemptId()}.tok"
        with store.open_output_stream(path, compression=None) as out:
            writer = TokenWriter(out)
            for batch in batches:
                doc_ids = batch["doc_id"].to_pylist()
                for begin, stop in in_pieces(sizes_of(batch["text"]), 4 * ENCODED_BYTES):
                    texts = [t or "" for t in batch["text"].slice(begin, stop - begin).to_pylist()]
                    for doc_id, ids in zip(doc_ids[begin:stop], encode_all(texts), strict=True):
                        writer.add(doc_id, ids + end)
            writer.close()
            size = out.tell()
        tokens = sum(d[4] for d in writer.docs)
        row = (context.partitionId(), f"{folder}/{path.rpartition('/')[2]}", size, len(writer.docs), tokens)
        yield pa.RecordBatch.from_pylist([dict(zip(("shard", "path", "bytes", "n_docs", "n_tokens"), row, strict=True))])

    placed = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
        .repartitionByRange("doc_id", "_h")
        .sortWithinPartitions("doc_id", "_h")
        .select("doc_id", "text")
    )
    schema = "shard long, path string, bytes long, n_docs long, n_tokens long"
    return written(placed.mapInArrow(releasing(write, "encoders"), schema), "token-files")


def read_token_files(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document of the listed files: doc_id, start, n_tokens, ids_crc32, ids (16-bit binary).

    ``start`` counts the ids of all documents before it, over all files in shard order; the crc32 is that
    of the ids as little-endian unsigned 32-bit integers. Files are dealt out to as many tasks as
    their bytes call for; the running sum is over one row per file. Without ids, that column is left out.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("begin")
    listed = files.where("n_docs > 0").select("path", "bytes", begins)

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, path = filesystem(row["path"])
                with store.open_input_file(path) as file:
                    reader = TokenReader(file, row["bytes"])
                    starts = row["begin"] + np.concatenate(([0], np.cumsum(reader.lengths)))
                    rows: list[tuple] = []
                    for i, ids in reader.ids(range(len(reader.doc_ids))):
                        key = None if reader.nulls[i] else int(reader.doc_ids[i])
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        rows.append((key, int(starts[i]), len(ids), crc, ids.tobytes() if with_ids else None))
                        if len(rows) == 2000:
                            yield _batch(rows, with_ids)
                            rows = []
                    if rows:
                        yield _batch(rows, with_ids)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return listed.repartitionByRange(reading_tasks(listed, "bytes"), "path").mapInArrow(releasing(read), schema)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
    if with_ids:
        return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[4], pa.binary())], [*names, "ids"])
    return pa.RecordBatch.from_arrays(arrays, names)


def op1_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "tokens")
    files = write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_token_files(files, with_ids=False)
