"""Session settings the operators count on, and the one way lineage is cut."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. Skewed keys on the probing side of a
# join are split at run time by adaptive execution, also where that costs one more shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # This rule only saves work on empty inputs. On plans over empty tables it nests plans in
    # plans until Spark's own plan listing runs out of stack (seen with 4.1.2).
    "spark.sql.adaptive.optimizer.excludedRules": (
        "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    ),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; safe to call again and again."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names.

    Only a local session that names none gets one below its warehouse; on a cluster a missing
    folder is an error, because a machine-local one would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of the cluster."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder in the shared one that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written_to(df: DataFrame, name: str) -> str:
    """Path of a new table in the shared folder that holds the rows."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return path
