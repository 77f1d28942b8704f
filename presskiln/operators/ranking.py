"""Ranks, dense ids and top-n that stay spread out when one group holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presskiln.session import cut_lineage

# Parts a group is cut into before its rows are placed.
SALTS = 32


def ranked(
    df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Rank from 1 over ``order`` within ``group``, without one task per group.

    Rows are range-sorted by group and order, so a large group spans many partitions. The
    position inside a partition plus the rows of the group in earlier partitions is the
    rank. ``order`` must be unique within a group. The sorted rows are checkpointed: a rank
    must not change if a lost executor makes Spark sort again.
    """
    group = list(group)
    placed = cut_lineage(
        df.repartitionByRange(*group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part", *group).agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first")
    )
    # One row per partition and group that meet: at most partitions + groups rows, and at
    # most one per partition for any one group.
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", *group, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    if not group:  # one row per partition: small whatever the data
        starts = F.broadcast(starts)
    return placed.join(starts, ["_part", *group]).select(
        *df.columns, (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name)
    )


def max_id(table: DataFrame, id_column: str) -> Column:
    """Highest id of a table as a scalar subquery; 0 for an empty table."""
    return table.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("top")).scalar()


def with_next_ids(
    new: DataFrame, order: Sequence[str], id_column: str, existing: DataFrame | None = None
) -> DataFrame:
    """Dense ids for ``new`` rows in ``order``, going on from the highest id of ``existing``."""
    rows = ranked(new, order, name="_rank")
    top = F.lit(0) if existing is None else max_id(existing, id_column)
    return rows.select(*new.columns, (F.col("_rank") + top).alias(id_column))


def cut_parts(df: DataFrame, group: Sequence[str], order: Sequence[str], bound: Column) -> DataFrame:
    """Rows that may be among the first of their group: the first ones of its salted parts."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    place = F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*order))
    return salted.withColumn("_place", place).where(F.col("_place") <= bound).select(*df.columns)


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int | str | None) -> DataFrame:
    """First ``n`` rows of every group, a number or a column that is equal within a group; all rows
    where it is missing or not positive.

    Salted parts of a group are cut to ``n`` rows first, of which Spark drops the rest before the
    shuffle; what is left is placed by a range sort, so no group has to fit a task.
    """
    if n is None or isinstance(n, int) and n <= 0:
        return df
    bound = F.col(n) if isinstance(n, str) else F.lit(n)
    cut = cut_parts(df.where(bound > 0), group, order, bound)
    first = ranked(cut, order, group, "_rank").where(F.col("_rank") <= bound).select(*df.columns)
    return first.unionByName(df.where(bound.isNull() | (bound <= 0))) if isinstance(n, str) else first
