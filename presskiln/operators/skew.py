"""Joins whose left side may hold most of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_splittable(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join on ``key`` in a form that adaptive execution can split, where ``left`` is skewed.

    Spark splits an oversized partition only if both sides come straight out of a shuffle. A
    right side that was grouped by ``key`` keeps that partitioning and would be joined as it
    is, behind its aggregate, and nothing could be split. Joining on the key and its hash
    asks for a partitioning the aggregate does not have: its few narrow rows are shuffled
    once more, and a key of any size is spread over many tasks. Small right sides are
    broadcast by Spark as always.
    """
    hashed = F.xxhash64(key)
    return (
        left.withColumn("_hash", hashed)
        .join(right.withColumn("_hash", hashed), [key, "_hash"], how)
        .drop("_hash")
    )
