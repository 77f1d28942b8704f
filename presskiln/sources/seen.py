"""URLs that were stored before, kept between runs so that a run asks for its own only.

Two tables stand below a root. ``urls`` is bucketed by URL: looking some up shuffles those to its
buckets and nothing of the table. ``bits`` says which URLs can be in it at all: a Bloom filter cut
into parts of 32,768 bits, a row for each part that a batch set bits in; a URL that is new, as most
are, is settled by two bits and never looked for in the table.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presskiln.operators.skew import join_splittable

# Buckets of the table, fixed when it is made: as many as shuffle partitions of a session at least,
# or Spark shuffles it after all. Parts of the filter: 2**27 bits, 16 MB; with far more URLs than 10
# million more of them are looked up in vain.
BUCKETS, PARTS = 64, 4096
PART_BITS = 32_768
_HASHES = 2
_BITS = "part long, bits binary, batch string"


def _slots(url: Column) -> Column:
    """Numbers from 1 of the bits of a URL."""
    return F.array(*[F.pmod(F.xxhash64(url, F.lit(k)), F.lit(PARTS * PART_BITS)) + 1 for k in range(_HASHES)])


class SeenUrls:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.table = f"seen_{hashlib.sha1(self.root.encode()).hexdigest()}"
        # The files are the table; a session that does not know it yet is told its form.
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (url STRING, batch STRING) USING parquet "
            f"CLUSTERED BY (url) INTO {buckets} BUCKETS LOCATION '{self.root}/urls'"
        )

    def grow(self, urls: DataFrame, batch: str) -> None:
        """Add the URLs of a batch. A batch that died and is run again adds them again, to no harm."""
        new = urls.select("url").where(F.col("url").isNotNull() & (F.col("url") != "")).distinct()
        new = new.repartition(self.buckets, "url").withColumn("batch", F.lit(batch))
        new.write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        # From the table, so that a bit is set for whatever stands in it.
        slot = F.explode(_slots(F.col("url"))).alias("slot")
        bits = self.spark.table(self.table).where(F.col("batch") == batch).select(slot).groupBy(F.bitmap_bucket_number("slot").alias("part"))
        rows = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).withColumn("batch", F.lit(batch))
        rows.coalesce(8).write.mode("append").parquet(f"{self.root}/bits")

    def _bits(self) -> DataFrame:
        try:
            rows = self.spark.read.schema(_BITS).parquet(f"{self.root}/bits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], _BITS)
        return rows.groupBy("part").agg(F.bitmap_or_agg("bits").alias("bits"))

    def possible(self, urls: DataFrame) -> DataFrame:
        """URLs all of whose bits are set: every one in the table, and few others."""
        slots = urls.select("url").distinct().select("url", F.explode(_slots(F.col("url"))).alias("slot"))
        asked = slots.select(
            "url", F.bitmap_bucket_number("slot").alias("part"), F.bitmap_bit_position("slot").cast("int").alias("at")
        )
        octet = F.conv(F.hex(F.expr("substring(bits, at div 8 + 1, 1)")), 16, 10).cast("int")
        is_set = F.call_function("shiftright", octet, F.col("at") % 8).bitwiseAND(F.lit(1)) == 1
        found = join_splittable(asked, self._bits(), "part", "inner").where(is_set)
        return found.groupBy("url").agg(F.count("*").alias("set")).where(F.col("set") == _HASHES).select("url")

    def among(self, urls: DataFrame, batches: DataFrame) -> DataFrame:
        """Those of ``urls`` that one of ``batches`` (column ``batch``, one row for each) stored."""
        stored = self.spark.table(self.table).join(F.broadcast(batches.select("batch").distinct()), "batch", "left_semi")
        return self.possible(urls).join(stored, "url", "left_semi")
