"""The article tables as plain Parquet, written in batches that become visible at once.

Every write goes to ``<root>/<table>/batch=<label>/rev=<n>``; nothing that may be read is
ever overwritten. One small append to ``<root>/commits`` makes all writes of a batch visible
together, so a job that dies half-way leaves the tables as they were, and a batch that is
run again can see that it is already there.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presskiln.operators.updates import conform
from presskiln.schemas import TABLES
from presskiln.sources.seen import BUCKETS, SeenUrls

COMMITS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("rev", T.LongType()),
        T.StructField("replaces", T.BooleanType()),
        T.StructField("seq", T.LongType()),
    ]
)
_PLACE = T.StructType([T.StructField("batch", T.StringType()), T.StructField("rev", T.LongType())])


class ArticleStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.seen = SeenUrls(spark, f"{self.root}/seen", buckets)

    def seen_among(self, urls: DataFrame) -> DataFrame:
        """Those of ``urls`` that are stored."""
        return self.seen.among(urls, self.commits().where(F.col("table") == "articles"))

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        return self._read("commits", COMMITS)

    def is_committed(self, batch: str, table: str) -> bool:
        mine = (F.col("batch") == batch) & (F.col("table") == table)
        return not self.commits().where(mine).isEmpty()

    def read(self, table: str) -> DataFrame:
        """Committed rows: of every batch its last revision, from the last whole rewrite on."""
        mine = self.commits().where(F.col("table") == table)
        last = mine.groupBy("batch").agg(
            F.max("rev").alias("rev"), F.max("seq").alias("seq"), F.bool_or("replaces").alias("replaces")
        )
        rewrite = last.where("replaces").agg(F.max("seq")).scalar()
        visible = last.where(F.col("seq") >= F.coalesce(rewrite, F.lit(0))).select("batch", "rev")
        schema = TABLES[table]
        rows = self._read(table, T.StructType(schema.fields + _PLACE.fields))
        return rows.join(visible, ["batch", "rev"], "left_semi").select(*schema.names)

    def stage(
        self, table: str, rows: DataFrame, batch: str, rev: int = 0, by: Iterable[str] = (), whole: bool = False
    ) -> tuple:
        """Write rows of a batch; they stay invisible until the returned entry is committed.

        ``whole`` rows replace all that earlier batches hold.
        """
        writer = conform(rows, TABLES[table]).write.mode("overwrite")
        writer.partitionBy(*by).parquet(f"{self.root}/{table}/batch={batch}/rev={rev}")
        return table, batch, rev, whole

    def next_seq(self) -> int:
        return self.commits().agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).first()[0]

    def commit(self, *entries: tuple) -> None:
        """Make staged writes visible, all at once."""
        seq = self.next_seq()
        rows = self.spark.createDataFrame([(*entry, seq) for entry in entries], COMMITS)
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
