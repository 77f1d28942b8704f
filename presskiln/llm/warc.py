"""WARC archives with an index beside them, and reads of selected records by byte range."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presskiln.llm.common import filesystem, reading_tasks, releasing, shared_folder, ship, written
from presskiln.operators.skew import join_splittable

# Ranges are read together where the gap is small, up to a length.
GAP, TOGETHER = 1 << 16, 8 << 20
# Fixed value: the profile of a record that revisits an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The tables hold no fetch time; records carry this one.
DATE = "1970-01-01T00:00:00Z"
ESCAPED, WRITTEN = re.compile(r"[\x00-\x20\x7f]|%(?=[01][0-9A-F]|20|25|7F)"), re.compile("%([01][0-9A-F]|20|25|7F)")
INDEX = "path string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str, str]:
    """One gzip member with a WARC record; its payload digest and type.

    A revisit keeps the HTTP header, with the payload's length, and leaves out the payload.
    """
    digest, kind = payload_digest(payload), "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:  # blanks and line ends cannot stand in a header
        head.append("WARC-Target-URI: " + ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    plain = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(plain, 2, mtime=0), digest, kind


def parsed(member: bytes) -> tuple:
    """A row of RECORD from one gzip member; a payload that does not match its digest is an error."""
    plain = zlib.decompress(member, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, body = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(body) != size or payload_digest(body) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    url = fields.get("WARC-Target-URI")
    number = lambda name: int(x) if (x := fields.get(name, "<urn:page:>")[10:-1]) else None
    return (
        number("WARC-Record-ID"), url and WRITTEN.sub(lambda m: chr(int(m[1], 16)), url), size, digest, kind, number("WARC-Refers-To"),
        body if kind == "response" else None,
    )


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, sha, refers_to) of pages whose payload is that of a smaller page_id.

    Only ids and hashes move. The pages of one payload may be a third of all: the least id is
    found with partial sums, and the join on the hash can be split.
    """
    keys = pages.select("page_id", "sha")
    first = keys.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return join_splittable(keys, first, "sha", "inner").where("page_id is null or page_id <> refers_to").where("refers_to is not null").distinct()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for every row of (page_id, url, html); give the index of the records.

    The payload is the html in UTF-8, null is empty. Of rows with equal payloads those with the
    least page_id are responses (several if that id is repeated), the others revisit it; null
    page_ids come last, and among null ids alone all are responses. An index row holds path, offset,
    length, url and digest; the index is written before anything is read. An empty table gives an
    empty index. Files of failed task attempts are never listed.
    """
    ship(pages.sparkSession)
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    known = revisits(own).select(F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("sha") == F.col("_sha"))
    marked = own.join(known, same, "left").select("page_id", "url", "html", "refers_to")

    def write(batches):
        context = TaskContext.get()
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        at, path = 0, f"{folder}/{name}"
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                rows = []
                html = batch["html"].cast(pa.binary())
                for page_id, url, payload, refers in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), html, batch["refers_to"].to_pylist(), strict=True):
                    member, digest, kind = record(page_id, url, payload.as_py(), refers)
                    out.write(member)
                    rows.append((path, at, len(member), page_id, url, digest, kind))
                    at += len(member)
                yield _batch(rows, _INDEX_KINDS)

    return written(marked.mapInArrow(releasing(write), INDEX), "warc-index")


_INDEX_KINDS = (("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string()))
_RECORD_KINDS = (
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
)


def _batch(rows: list[tuple], kinds) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])


def ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (path, offset, length) joined to (path, begin, end, members)."""
    path, begin, end, members = None, 0, 0, []
    for p, offset, length in rows:
        if members and (p != path or offset - end > GAP or offset + length - begin > TOGETHER):
            yield path, begin, end, members
            members = []
        if not members:
            path, begin = p, offset
        members.append((offset, length))
        end = offset + length
    if members:
        yield path, begin, end, members


def read_records(selected: DataFrame) -> DataFrame:
    """Records of the selected index rows, as RECORD; a revisit has no payload of its own.

    Index rows are sorted by place and spread by range, so that neighbours are read in one go, over
    as many tasks as their bytes call for.
    """

    def read(batches):
        def places():
            for batch in batches:
                yield from zip(batch["path"].to_pylist(), batch["offset"].to_pylist(), batch["length"].to_pylist(), strict=True)

        rows, held = [], 0
        for uri, begin, end, members in ranges(places()):
            store, path = filesystem(uri)
            with store.open_input_file(path) as file:
                data = file.read_at(end - begin, begin)
            for offset, length in members:
                rows.append(parsed(data[offset - begin : offset - begin + length]))
                held += rows[-1][2]
                if held > TOGETHER or len(rows) >= 5000:
                    yield _batch(rows, _RECORD_KINDS)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, _RECORD_KINDS)

    wanted = selected.select("path", "offset", "length")
    placed = wanted.repartitionByRange(reading_tasks(wanted, "length"), "path", "offset").sortWithinPartitions("path", "offset")
    return placed.mapInArrow(releasing(read), RECORD)


def op5_warc(spark, sf_dir: str) -> DataFrame:
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), shared_folder(spark, "warc"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
