"""Table scans and the CSV form of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType, TimestampType

from presskiln.functions.dates import iso_text
from presskiln.schemas import REDIRECTS, REGISTRY, SNAPSHOTS, TABLES


def scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def addressed(pages: DataFrame) -> DataFrame:
    """Rows of Parquet files with the file and the row there each comes from, which lead back to
    a page's text once it is known which texts are needed. Both cost nothing to read."""
    return pages.select(
        "*", F.col("_metadata.file_path").alias("page_file"), F.col("_metadata.row_index").alias("page_row")
    )


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return addressed(scan(spark, path, SNAPSHOTS))


def read_redirects(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, REDIRECTS)


def read_registry(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Registry documents, one per file or, with ``lines``, one per line, each with its own
    settings; a missing list or an empty file gives no sources."""
    return spark.read.schema(REGISTRY).json(path, multiLine=not lines)


def csv_rows(rows: DataFrame) -> DataFrame:
    """Rows as the text of the CSV tables: ISO timestamps, lower-case booleans, '' for NULL."""
    def text(field):
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            return iso_text(column).alias(field.name)
        return F.coalesce(column.cast("string"), F.lit("")).alias(field.name)

    return rows.select(*[text(field) for field in rows.schema.fields])


def write_csv(rows: DataFrame, path: str) -> None:
    csv_rows(rows).write.csv(path, header=True, escape='"', emptyValue="", lineSep="\n")


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Typed rows of a CSV table; quoted line breaks and doubled quotes are understood."""
    schema = TABLES[table]
    texts = StructType()
    for field in schema.fields:
        texts.add(field.name, "string")
    rows = spark.read.schema(texts).csv(path, header=True, multiLine=True, escape='"', nullValue="")

    def typed(field):
        column = F.col(field.name)
        if isinstance(field.dataType, (TimestampType, BooleanType)):
            return column.try_cast(field.dataType).alias(field.name)
        return column.cast(field.dataType).alias(field.name)

    return rows.select(*[typed(field) for field in schema.fields])
