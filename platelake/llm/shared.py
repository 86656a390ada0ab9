"""Tables in the folder that all executors share, and names that clash with no column."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.session import shared_dir


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is run inside go when it ends, not when the driver next collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, brief: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read from there: later passes do not compute it again, and losing an
    executor loses nothing. The files go when the application ends; with ``brief`` those of its shuffles go at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    with brief_shuffles(spark) if brief else nullcontext():
        df.write.option("compression", "zstd").parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """The files of ``stored`` tables that nothing reads any more go; those of other tables stay."""
    own = re.compile("/llm-[0-9a-f]{32}$")
    for df in tables:
        for path in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
            if own.search(path):
                jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
                jvm_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm_path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a variant that is no column of ``df`` (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")
