"""A Merkle tree over the rows of a dataset: a root to publish, and for every row the proof to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presskiln.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Consecutive nodes that become one, and levels a window goes up at a time: a window covers
# ARITY ** HEIGHT rows, whatever the size of a group.
ARITY, HEIGHT = 2, 8
_PATH = "array<struct<before: string, after: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after another."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: of each field ``-`` if null, else its UTF-8 byte count, a colon, its text."""
    texts = [field.cast("string") for field in fields]
    return digest(
        *[
            F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
            for text in texts
        ]
    )


def positions(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with their place ``idx`` from 0 in their group and its size ``n``.

    Rows are range-sorted and written, so that a place cannot change; a group of any size spans
    many partitions. ``group`` holds no nulls. Rows equal in ``order`` stand in any order.
    """
    placed = written(
        rows.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "places",
    ).withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy(group, "_part").agg(F.count("*").alias("_size"), F.min("_at").alias("_first"))
    # At most one row per partition for any one group.
    parts = Window.partitionBy(group)
    earlier = parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        group, "_part", "_first",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"), F.sum("_size").over(parts).alias("n"),
    )
    return placed.join(starts, [group, "_part"]).select(
        *rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("idx"), "n"
    )


def climb(nodes: DataFrame, group: str, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """Nodes with the ``path`` of their siblings for ``height`` levels, and on the first node of
    every ``arity ** height`` the ``up`` they become.

    ``nodes`` holds (group, idx, n, digest) and more columns. A node of a level stands on the row of
    its first leaf, so that siblings are lag and lead at a fixed offset for each level; the slot of
    a node in its run and the length of the run tell which of them are there. Going up, the row of a
    first child hashes the parent; going down, its children take over the path of the parent. All of
    that is windows over one block of nodes: one shuffle. A level at which a group has one node left
    changes nothing.
    """
    block = Window.partitionBy(group, "_block").orderBy("idx")
    idx, n = F.col("idx"), F.col("n")

    def at(level):
        """(size of a subtree, slot in the run, rows that hold a node, whether nodes are joined)"""
        step = arity**level
        left = F.floor((n + (step - 1)) / step)
        slot = F.floor(idx / step) % arity
        run = F.least(F.lit(arity), left - F.floor(idx / (step * arity)) * arity)
        return step, slot, run, idx % step == 0, left > 1

    rows = nodes.withColumn("_block", F.floor(idx / arity**height)).withColumn("_node0", F.col("digest"))
    for level in range(height):
        step, slot, run, holds, joined = at(level)
        node, here = F.col(f"_node{level}"), holds & joined
        lags = [F.when(slot >= d, F.lag(node, d * step).over(block)) for d in range(arity - 1, 0, -1)]
        leads = [F.when(slot + d < run, F.lead(node, d * step).over(block)) for d in range(1, arity)]
        for name, found in (("before", lags), ("after", leads)):
            rows = rows.withColumn(f"_{name}{level}", F.when(here, F.concat(*[F.coalesce(x, F.lit("")) for x in found])))
        parent = F.when(joined, digest(node, F.col(f"_after{level}"))).otherwise(node)
        rows = rows.withColumn(f"_node{level + 1}", F.when(idx % (step * arity) == 0, parent))
    rows = rows.withColumn("path", F.array().cast(_PATH))
    for level in reversed(range(height)):
        step, slot, _, holds, joined = at(level)
        above = F.coalesce(*[F.when(slot == s, F.lag("path", s * step).over(block) if s else F.col("path")) for s in range(arity)])
        own = F.struct(F.col(f"_before{level}").alias("before"), F.col(f"_after{level}").alias("after"))
        path = F.when(joined, F.concat(F.array(own), above)).otherwise(above)
        rows = rows.withColumn("path", F.when(holds, path))
    return rows.select(*nodes.columns, "path", F.col(f"_node{height}").alias("up"))


def tree(nodes: DataFrame, group: str, arity: int = ARITY, height: int = HEIGHT) -> tuple[list[DataFrame], DataFrame]:
    """Tables of ``climb`` from the leaves on, and the one node (group, digest) left of each group.

    Each table is ``arity ** height`` times smaller than the one before.
    """
    levels, size = [], arity**height
    while True:
        levels.append(written(climb(nodes, group, arity, height), "level"))
        above = levels[-1].where(F.col("idx") % size == 0)
        nodes = above.select(
            group, F.floor(F.col("idx") / size).alias("idx"), F.floor((F.col("n") + (size - 1)) / size).alias("n"), F.col("up").alias("digest")
        )
        if nodes.where("n > 1").isEmpty():
            return levels, nodes.select(group, "digest")


def whole_paths(levels: list[DataFrame], group: str, tops: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """Rows of the first level with the path from their leaf on, then that of their group in
    ``tops`` (group, path and more columns, which are handed on)."""
    more = [c for c in tops.columns if c not in (group, "path")]
    above = tops.withColumnRenamed("path", "_above")
    # Groups meet their row at the highest level, where each has few nodes; from there on a node
    # meets those of its block.
    for level in reversed(levels):
        key = [group] if level is levels[-1] else [group, "_block"]
        rows = level.withColumn("_block", F.floor(F.col("idx") / arity**height)).join(above, key)
        rows = rows.select(*level.columns, *more, F.concat("path", "_above").alias("_full"))
        above = rows.select(group, F.col("idx").alias("_block"), F.col("_full").alias("_above"), *more)
    return rows.drop("path", "up").withColumnRenamed("_full", "path")


def folded(start: Column, path: Column) -> Column:
    """What a leaf becomes with the siblings of its path: the root, if nothing was changed."""
    return F.aggregate(path, start, lambda node, level: digest(level["before"], node, level["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), ""), 256)


def manifest(
    docs: DataFrame, claimed: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id",
    arity: int = ARITY, height: int = HEIGHT,
) -> DataFrame:
    """For every row its ``leaf``, ``subroot`` of its group and ``root``, the ``path`` of siblings
    from leaf to root with its digest ``proof_sha256``, and the check: ``folded_root`` is worked out
    from the row with the values of ``claimed`` in place of its own, and the path; ``verified`` says
    whether it is the root.

    Leaves of a group ascend by ``order``; every ``arity`` consecutive nodes, at the end of a group
    maybe fewer or one, become the digest of theirs, until one is left: the subroot. Subroots by
    group (null first, bytewise) likewise give the root.

    Nulls are fields of their own kind: a null group is a group, a null ``order`` comes first.
    Empty texts differ from null ones. Rows equal in ``order`` come by their digest, so repeated
    rows give one result. A group of one row is its own subroot. An empty table gives no rows.
    Texts of any length are hashed where they are read and go no further. Columns of ``docs`` other
    than ``fields`` are not looked at, whatever their names.
    """
    key = F.when(F.col(group).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    claimed = claimed or {}
    own, said = leaf([F.col(f) for f in fields]), leaf([claimed.get(f, F.col(f)) for f in fields])
    rows = docs.select(key.alias("_group"), F.col(order).alias("_order"), own.alias("digest"), said.alias("_said"))
    # What is claimed goes on only where it differs.
    rows = rows.withColumn("_said", F.when(F.col("_said") != F.col("digest"), F.col("_said")))
    levels, subroots = tree(positions(rows, "_group", ["_order", "digest"]), "_group", arity, height)
    # One tree over the subroots: the groups are its leaves.
    every = subroots.select(F.lit("").alias("_every"), "_group", "digest")
    top_levels, root = tree(positions(every, "_every", ["_group"]), "_every", arity, height)
    root = next((row["digest"] for row in root.collect()), None)  # one row, of 64 characters
    tops = whole_paths(top_levels, "_every", top_levels[-1].select("_every", F.array().cast(_PATH).alias("path")).distinct(), arity, height)
    tops = tops.select("_group", "path", F.col("digest").alias("subroot"))
    found = whole_paths(levels, "_group", tops, arity, height)
    return found.select(
        F.col("_order").alias(order),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        "path",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("_said", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return manifest(docs, claimed).drop("path")


# Fixed value: the polynomial of crc32, reflected.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(f) for f in FIELDS) + ")"


def _climb_sql(name: str, leaves: str) -> str:
    """Levels of the trees over a CTE (grp, idx, digest): (grp, level, nodes)."""
    return f"""{name} AS (
  SELECT grp, 0 AS level, list(digest ORDER BY idx) AS nodes FROM {leaves} GROUP BY grp
  UNION ALL
  SELECT grp, level + 1, list_transform(range(1, len(nodes) + 1, {ARITY}), lambda i: sha256(array_to_string(list_slice(nodes, i, i + {ARITY - 1}), '')))
  FROM {name} WHERE len(nodes) > 1)"""


def _path_sql(name: str, leaves: str, levels: str) -> str:
    """Siblings before and after of every node of a leaf's way up, as two lists."""
    return f"""{name} AS (
  SELECT grp, idx, list(before ORDER BY level) AS befores, list(after ORDER BY level) AS afters FROM (
    SELECT l.grp, l.idx, level,
      array_to_string(list_slice(nodes, place - place % {ARITY} + 1, place), '') AS before,
      array_to_string(list_slice(nodes, place + 2, place - place % {ARITY} + {ARITY}), '') AS after
    FROM (SELECT l.grp, l.idx, t.level, t.nodes, l.idx // ({ARITY} ** t.level)::BIGINT AS place
          FROM {leaves} l JOIN {levels} t ON t.grp = l.grp AND len(t.nodes) > 1) l)
  GROUP BY grp, idx)"""


ORACLE = f"""WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS grp, {_LEAF} AS digest, {_LEAF.replace(_FIELD.format('n_chars'), _FIELD.format('claimed'))} AS said
  FROM (SELECT *, n_chars + CASE WHEN {_CRC} % 7 = 0 THEN 1 ELSE 0 END AS claimed FROM documents)),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx FROM rows),
{_climb_sql('levels', 'leaves')},
subroots AS (
  SELECT grp AS own, '' AS grp, nodes[1] AS digest, row_number() OVER (ORDER BY grp) - 1 AS idx FROM levels WHERE len(nodes) = 1),
{_climb_sql('tops', 'subroots')},
{_path_sql('low', 'leaves', 'levels')},
{_path_sql('high', 'subroots', 'tops')},
found AS (
  SELECT doc_id, leaves.digest AS leaf, said, subroots.digest AS subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
    list_concat(coalesce(low.befores, []), coalesce(high.befores, [])) AS befores, list_concat(coalesce(low.afters, []), coalesce(high.afters, [])) AS afters
  FROM leaves LEFT JOIN low ON low.grp = leaves.grp AND low.idx = leaves.idx
  JOIN subroots ON subroots.own = leaves.grp LEFT JOIN high ON high.idx = subroots.idx),
checked AS (
  SELECT doc_id, leaf, subroot, root,
    sha256(array_to_string(list_transform(befores, lambda b, i: b || afters[i]), '')) AS proof_sha256,
    list_reduce(list_concat([said], list_transform(befores, lambda b, i: b || '|' || afters[i])),
      lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
  FROM found)
SELECT *, folded_root = root AS verified FROM checked"""
