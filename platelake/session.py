"""Session settings the jobs assume, and the shared folder for cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def recommended_conf() -> dict[str, str]:
    """Settings for a cluster run; pass them to the session builder.

    ``arrow.maxBytesPerBatch`` bounds what one Python worker holds while it opens workbooks: the default row limit
    alone would put thousands of whole files into one batch.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.checkpoint.compress": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        "spark.ui.enabled": "false",
    }


def gone_at_exit(spark: SparkSession, path: str) -> None:
    """``path`` goes when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Only on a local master, where it is unset, the library makes one."""
    if spark.conf.get(CHECKPOINT_KEY, None) is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        spark.conf.set(CHECKPOINT_KEY, tempfile.mkdtemp(prefix="platelake-checkpoint-"))
        gone_at_exit(spark, spark.conf.get(CHECKPOINT_KEY))
    return spark.conf.get(CHECKPOINT_KEY)


def pin(df: DataFrame) -> DataFrame:
    """``df`` as written to the shared checkpoint folder, so that later passes all see the same rows in the same order."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def staged(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later passes read the columns and rows they need, in any order."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    gone_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
