"""Near duplicates among embeddings: int8 tile products with error bounds, then full precision."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presskiln.llm.common import frame_bytes, framed, ship, written
from presskiln.llm.components import components
from presskiln.operators.skew import join_splittable

TILE = 1024
THRESHOLD = 0.93
# Slack for rounding in the 32-bit product of scales, far above its error.
SLACK = 1e-5
CHUNK = 1 << 15


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes in -127..127, scale, and length of the error, of vectors taken to length one."""
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scale = np.abs(units).max(1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(units - codes * scale[:, None], axis=1) + 1e-9
    return codes, scale, error


def close_pairs(a, b, threshold: float, same: bool):
    """Index arrays (i, j) of pairs of two tiles with a cosine of the threshold or more.

    For unit vectors u, v with codes s*p, t*q and errors of length d, e, the cosine differs from
    s*t*(p.q) by at most d*(1+e) + e. Only pairs that this bound leaves possible are computed in
    double precision. Sums of products of codes are whole numbers below 2**24 up to 1,040
    components and so exact in 32-bit floats; longer vectors take 64-bit ones.
    """
    (va, pa_, sa, ea), (vb, pb, sb, eb) = a, b
    kind = np.float32 if va.shape[1] <= 1040 else np.float64
    near = pa_.astype(kind) @ pb.astype(kind).T
    near *= sa[:, None].astype(kind)
    near *= sb.astype(kind)
    near += (ea + SLACK).astype(kind)[:, None]
    near += (eb * (1 + ea.max())).astype(kind)
    i, j = np.nonzero(near >= threshold - SLACK)
    if same:
        i, j = i[i < j], j[i < j]
    la, lb = np.linalg.norm(va, axis=1), np.linalg.norm(vb, axis=1)
    found = [np.zeros(0, bool)]
    for k in range(0, len(i), CHUNK):
        x, y = i[k : k + CHUNK], j[k : k + CHUNK]
        found.append(np.einsum("ij,ij->i", va[x], vb[y]) / (la[x] * lb[y]) >= threshold)
    found = np.concatenate(found)
    return i[found], j[found]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Least node that each of n nodes reaches by the links."""
    least = np.arange(n)
    while len(i):
        before = least.copy()
        np.minimum.at(least, i, least[j])
        np.minimum.at(least, j, least[i])
        least = least[least]
        if (least == before).all():
            break
    return least


def _tile(table: pa.Table) -> pa.Table:
    vectors = np.stack([np.frombuffer(x, "<f4") for x in table["data"].to_pylist()]).astype(np.float64)
    codes, scale, error = quantised(vectors)
    blob = frame_bytes([table["cls"].to_numpy(), table["size"].to_numpy(), vectors.astype("<f4").ravel(), codes.ravel(), scale, error])
    return pa.table({"label": table["label"][:1], "tile": table["tile"][:1], "tiles": table["tiles"][:1], "blob": pa.array([blob], pa.binary())})


def _opened(blob: bytes):
    cls, size, vectors, codes, scale, error = framed(blob, ("<i8", "<i8", "<f4", "i1", "<f8", "<f8"))
    n = len(cls)
    return cls, size, (vectors.reshape(n, -1).astype(np.float64), codes.reshape(n, -1), scale, error)


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label).

    Vectors of one label and one length are compared; labels that are null, vectors that are
    null, empty or zero or hold null or non-finite components link with nothing. Equal vectors of a label are
    one class, so copies cost nothing. Classes are dealt to tiles of about TILE; every two tiles
    of a label meet in one task, which gives sums of links and a forest, never the links. All
    pairs of a label are looked at, as the exact result needs. Repeated vec_ids are rows of their
    own; null ids are never the least. An empty table gives no rows.
    """
    ship(vectors.sparkSession)

    def prepare(batches):
        for batch in batches:
            rows = []
            for value, label in zip(batch["embedding"].to_pylist(), batch["label"].to_pylist(), strict=True):
                ok = label is not None and bool(value) and None not in value
                x = np.array(value, "<f4") if ok else None
                if ok and np.isfinite(x).all() and x.any():
                    x += np.float32(0)  # one zero
                    rows.append((f"{label}:{len(x)}", x.tobytes(), hashlib.sha256(f"{label}:".encode() + x.tobytes()).digest()))
                else:
                    rows.append((None, None, None))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            kinds = (pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch["vec_id"]] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["vec_id", "label", "data", "key"])

    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), "label")
    rows = written(source.mapInArrow(prepare, "vec_id long, label string, data binary, key binary"), "vectors")
    valid = rows.where("key is not null")
    classes = valid.groupBy("key").agg(F.first("label").alias("label"), F.first("data").alias("data"), F.min("vec_id").alias("least"), F.count("*").alias("size"))
    classes = written(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")

    counts = classes.groupBy("label").agg(F.ceil(F.count("*") / TILE).cast("long").alias("tiles"))
    dealt = join_splittable(classes.select("label", "cls", "size", "data"), counts, "label", "inner")
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("cls"), "tiles"))
    tiles = written(dealt.groupBy("label", "tile").applyInArrow(_tile, "label string, tile long, tiles long, blob binary"), "vector-tiles")
    other = tiles.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    met = other.select("label", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "tile", "blob")

    def multiply(table: pa.Table) -> pa.Table:
        same = table["one"][0].as_py() == table["two"][0].as_py()
        blobs = [b for _, b in sorted(zip(table["tile"].to_pylist(), table["blob"].to_pylist(), strict=True))]
        if len(blobs) == 1 and not same:  # the other tile got no class
            return pa.table({"cls": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        cls, size, one = _opened(blobs[0])
        other_cls, other_size, two = (cls, size, one) if same else _opened(blobs[-1])
        i, j = close_pairs(one, two, threshold, same)
        if not same:
            j = j + len(cls)
            cls, size = np.concatenate([cls, other_cls]), np.concatenate([size, other_size])
        n = len(cls)
        links = np.bincount(i, size[j], n) + np.bincount(j, size[i], n)
        least = _forest(i, j, n)
        own, tied = np.flatnonzero(links), np.flatnonzero(least != np.arange(n))
        return pa.table({
            "cls": pa.array(np.concatenate([cls[own], cls[tied]]), pa.int64()),
            "other": pa.array([None] * len(own) + cls[least[tied]].tolist(), pa.int64()),
            "links": pa.array(np.concatenate([links[own], np.zeros(len(tied))]).astype(np.int64), pa.int64()),
        })

    found = written(met.groupBy("label", "one", "two").applyInArrow(multiply, "cls long, other long, links long"), "vector-links")
    roots = components(found.where("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    degrees = found.groupBy("cls").agg(F.sum("links").alias("links"))
    known = (
        classes.select("key", "cls", "least", "size")
        .join(degrees, "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("key", "least", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    )
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = join_splittable(known, least, "root", "inner").select("key", "n_links", "component_id")
    linked = join_splittable(valid.select("vec_id", "key"), known, "key", "inner").select("vec_id", "n_links", "component_id")
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
