"""The document pipeline: stages that each take and give tables of documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presskiln.llm.common import written
from presskiln.llm.ngram_join import keep_one
from presskiln.llm.packing import pack
from presskiln.llm.pii import find_pii
from presskiln.llm.quality import score, train
from presskiln.llm.winnowing import find_leaks


NEEDED = ("doc_id", "text")


def _beside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns an operator does not need under names it does not use, and the way back:
    a document's own column named like a result keeps its values."""
    hidden = {name: name if name in NEEDED else f"own_{k}" for k, name in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{name}`").alias(other) for name, other in hidden.items()])
    return plain, lambda rows: rows.select(*[F.col(other).alias(name) for name, other in hidden.items()])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    It learns from the labelled ones among ``docs``; without any of both classes every document has
    the same score. Null and empty texts are scored by the bias alone; texts of any length are scored
    whole, one at a time where they are long; equal rows have equal scores, so all of them stay or go;
    an empty table gives none. All columns keep their values, whatever their names.
    """
    plain, back = _beside(docs)
    model = train(plain, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return back(score(plain, model).where("score >= 0.5"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least doc_id.

    Null, empty and blank texts are like nothing and stay. Of repeated rows one stays, as of other
    copies; a null doc_id comes after all others. Texts of any length are compared whole; an empty
    table gives none. All columns keep their values, whatever their names.
    """
    plain, back = _beside(docs)
    return back(keep_one(plain))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Null and empty texts hold none and stay; repeated rows stay or go together; texts of any length are
    looked at whole; an empty benchmark or table drops nothing. All columns keep their values,
    whatever their names.
    """
    plain, back = _beside(docs)
    leaks = find_leaks(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return back(leaks.where("n_hit = 0"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the names of its kinds.

    Null texts stay null, empty ones empty; texts of any length are looked at whole; repeated rows stay;
    an empty table gives none. ``n_chars`` follows the new text (of null texts it stays); all other
    columns keep their values, whatever their names.
    """
    plain, back = _beside(docs)
    found = back(find_pii(plain).withColumn("text", F.col("redacted")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))
    return found


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids (16-bit, little-endian).

    Null and empty texts have their end id only; repeated rows are packed each; texts of any length
    are cut into as many pieces as they need; an empty table gives none. Columns other than doc_id and
    text are not looked at.
    """
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Classifier, hashes of n-grams and tokens cannot be written in SQL: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
