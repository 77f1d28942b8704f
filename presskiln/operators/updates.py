"""Row updates and schema checks on whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from presskiln.session import cut_lineage

# Folder name and number of the parts a table is updated by.
BUCKET, KEY_BUCKETS = "key_bucket", 256


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows with exactly the columns of ``schema``, in its order; missing ones are NULL."""
    return rows.select(
        *[
            (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Table with ``rows`` behind it, projected to the columns of the table."""
    return table.unionByName(conform(rows, table.schema))


def update_rows(table: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Table whose rows with a match in ``updates`` take over its columns, NULLs included.

    ``updates`` holds one row per key.
    """
    changed = [c for c in updates.columns if c != key]
    packed = updates.select(key, F.struct(*changed).alias("_new"))
    joined = table.join(packed, key, "left")
    return joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in table.columns
        ]
    )


def duplicate_keys(table: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return table.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose foreign key has no parent row."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.join(keys, child_key, "left_anti")


def write_bucketed(table: DataFrame, path: str, key: str, buckets: int = KEY_BUCKETS) -> None:
    """Rows in folders by a hash of their key, so that an update finds them."""
    _by_bucket(table, key, buckets).write.partitionBy(BUCKET).parquet(path)


def read_bucketed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def update_bucketed(spark: SparkSession, path: str, schema: StructType, updates: DataFrame, key: str, buckets: int = KEY_BUCKETS) -> None:
    """``update_rows`` on a table of ``write_bucketed``: only folders that hold a key of
    ``updates`` are read and replaced, the others stay as they are.

    The new rows are checkpointed before a folder is replaced: they come from it. An update that
    dies half-way is run again with equal results.
    """
    touched = [r[0] for r in updates.select(_bucket(key, buckets)).distinct().collect()]  # at most ``buckets`` numbers
    whole = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    table = spark.read.schema(whole).parquet(path)
    rows = cut_lineage(update_rows(table.where(F.col(BUCKET).isin(touched)).drop(BUCKET), updates, key))
    _by_bucket(rows, key, buckets).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _by_bucket(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    # A bucket may span several files: its rows are dealt out again by the key.
    return rows.withColumn(BUCKET, _bucket(key, buckets)).repartition(BUCKET, F.pmod(F.hash(key), F.lit(8)))
