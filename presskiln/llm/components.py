"""Connected components of links, spread over the cluster."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presskiln.llm.common import releasing, ship, written
from presskiln.operators.skew import join_splittable

FOREST = "hi long, lo long"


def _forest(batches):
    """Links of one partition as links from each node to the least node it reaches there."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
            parent.setdefault(min(a, b), min(a, b))
    rows = [(x, top(x)) for x in parent]
    rows = [r for r in rows if r[0] != r[1]]
    for k in range(0, len(rows), 100_000):
        hi, lo = zip(*rows[k : k + 100_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], ["hi", "lo"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for links (a, b): every node with a smaller one in its component, and the least.

    Each partition first shrinks its links to a forest. Then, round by round, every node points to
    its least neighbour, its other neighbours are linked to that one, and pointers are doubled,
    until all point at roots: the rounds follow the logarithm of the longest path. A node has at
    most one row per partition under ``hi``; joins on roots, where one may hold most rows, can be
    split. Every round is written to the shared folder.
    """
    ship(links.sparkSession)
    edges = written(links.select("a", "b").mapInArrow(releasing(_forest), FOREST), "forest")
    while True:
        parents = edges.groupBy("hi").agg(F.min("lo").alias("up"))
        side = edges.join(parents, "hi").where("lo <> up").select(F.col("lo").alias("hi"), F.col("up").alias("lo"), F.lit(True).alias("moved"))
        above = parents.select(F.col("hi").alias("up"), F.col("up").alias("top"))
        jump = join_splittable(parents, above, "up", "left").select("hi", F.coalesce("top", "up").alias("lo"), F.col("top").isNotNull().alias("moved"))
        edges = written(side.unionByName(jump), "forest")
        if edges.where("moved").isEmpty():
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        edges = edges.select("hi", "lo")
