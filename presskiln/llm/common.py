"""What the operators of this subpackage share: scratch tables, byte files, and word hashes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

PACKAGE = "presskiln"
# Bytes of text of which a task holds the result at a time, besides the batch it comes in.
ENCODED_BYTES = 1 << 20
# Bytes of files that one task reads.
READ_BYTES = 8 << 20
# What one Arrow batch of a table that is being written may hold: by default two of the 64 MB that
# Spark allows stand in an executor and in each of its workers, beside all that a task needs.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per context, so that tasks can import it."""
    context = spark.sparkContext
    if getattr(context, "_presskiln_shipped", False):
        return spark
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="presskiln-code-"), f"{PACKAGE}.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join(PACKAGE, os.path.relpath(path, root)))
    context.addPyFile(target)
    context._presskiln_shipped = True
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder, by name, below ``spark.checkpoint.dir`` (where unset, below the warehouse)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Arrow batches hold BATCH_BYTES or one row; the session's setting is put back."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a table in the shared folder and read from there: lineage ends."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with _small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def laid_out(df: DataFrame, name: str, by: str) -> str:
    """The rows, written to a table in the shared folder with one folder for each value of ``by``:
    its place."""
    path = shared_folder(df.sparkSession, name)
    with _small_batches(df.sparkSession):
        df.repartition(by).write.option("compression", "zstd").partitionBy(by).parquet(path)
    return path


def _trim():
    """The C library's call that gives freed memory back to the system, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda _: 0


# What a worker keeps from task to task, by the kind of task it is for.
KEPT: dict[str, dict] = {"encoders": {}, "finders": {}, "indexes": {}}


def _drop(keeps: str | None) -> None:
    """Clear what this worker keeps for other kinds of task. A function of the module: one that is
    pickled with its task would bring its own copy of ``KEPT`` along and clear that."""
    for kind, kept in KEPT.items():
        if kind != keeps:
            kept.clear()


def releasing(run, keeps: str | None = None):
    """``run``, a function for mapInArrow, that gives memory back when its task ends.

    Workers are used again for tasks of later stages. What those before kept for others than
    ``keeps``, and what the libraries below Python keep for themselves, would add up there, beside the
    memory the executor itself needs.
    """
    def released(batches):
        _drop(keeps)
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return released


def reading_tasks(listed: DataFrame, size: str) -> int:
    """Tasks that a table of pieces of files is to be read by, from the sum of their ``size`` in
    bytes: the rows themselves are tiny, so Spark would take all of them for one task's work."""
    return max(1, -(-(listed.agg({size: "sum"}).first()[0] or 0) // READ_BYTES))


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder or file named by a URI or a plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def sizes_of(column: pa.Array) -> list[int]:
    """Bytes of each value; null has none."""
    return pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()


def in_pieces(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges over rows of the given sizes, each of about ``most`` bytes, at least one row."""
    begin, total, at = 0, 0, 0
    for at, n in enumerate(sizes, 1):
        total += n
        if total >= most:
            yield begin, at
            begin, total = at, 0
    if begin < at:
        yield begin, at


# --- word hashes -------------------------------------------------------------------------

# Odd multipliers of 64-bit mixing.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
KEPT_POWERS = 2 * ENCODED_BYTES
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to n. Those of one piece of text are
    kept; for a longer text they are made anew and given up with it."""
    if len(_POWERS[0]) >= n:
        return _POWERS
    inverse, made = np.uint64(pow(int(_BASE), -1, 1 << 64)), []
    for base in (_BASE, inverse):
        values = np.full(max(n, KEPT_POWERS), base)
        values[0] = 1
        with np.errstate(over="ignore"):
            made.append(np.multiply.accumulate(values))
    if n <= KEPT_POWERS:
        _POWERS[:] = made
    return made


def table_of(letter) -> bytes:
    """A byte table that lower-cases A-Z and turns bytes that are no part of a word into blanks."""
    low = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    return bytes(b if letter(b) else 32 for b in low)


# Words between white space, and words of letters and digits (all of non-ASCII is a letter).
SPACED = table_of(lambda b: not (b == 32 or 9 <= b <= 13))
LETTERED = table_of(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)


class Words:
    """Words of some texts: ``hashes`` of all words in order, ``first`` word of each text (and
    the total at the end), ``starts`` and ``ends`` in the cleaned bytes ``data``."""

    def __init__(self, texts: list[bytes], table: bytes):
        self.data = (b" ".join(texts) + b" ").translate(table)
        codes = np.frombuffer(self.data, np.uint8)
        edge = np.diff((codes != 32).astype(np.int8), prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.first = np.searchsorted(self.starts, offsets)
        up, down = _powers(len(codes) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(_BYTE[codes] * up[: len(codes)], out=total[1:])
            self.hashes = mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all runs of k words, also of those that cross texts; fewer than k: none."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.full(n, np.uint64(k))
        with np.errstate(over="ignore"):
            for j in range(k):
                out = out * _BASE + self.hashes[j : j + n]
        return mix(out)


def frame_bytes(arrays: Iterable[np.ndarray]) -> bytes:
    """Arrays one after another, each behind its length, for one binary cell."""
    out = io.BytesIO()
    for a in arrays:
        out.write(np.int64(len(a)).tobytes())
        out.write(np.ascontiguousarray(a).tobytes())
    return out.getvalue()


def framed(data: bytes, kinds: Iterable[str]) -> list[np.ndarray]:
    """The arrays of ``frame_bytes``, of the given kinds."""
    out, at = [], 0
    for kind in kinds:
        n = int(np.frombuffer(data, np.int64, 1, at)[0])
        out.append(np.frombuffer(data, kind, n, at + 8))
        at += 8 + n * np.dtype(kind).itemsize
    return out
