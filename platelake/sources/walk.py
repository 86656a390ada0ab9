"""Folders listed by tasks: a manifest of files as a table, so that no list of files is held by the driver.

Folders of one depth are rows; each task lists its own, and what is a folder among the results is the next depth. All names are
listed, also those starting with ``_`` or ``.``, which Spark's readers pass over. ``listing`` has the same for
stores that only Spark's readers reach.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from platelake.functions.identifiers import file_name_of, is_batch_folder
from platelake.session import staged
from platelake.sources import files, listing
from platelake.sources.archives import _batches

FOUND = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("is_folder", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
)
MANIFEST = ("path", "length", "modified")
LIST_TASKS = 10_000
#: A task opens files of about this many bytes, each counted with what opening it costs.
TASK_BYTES, OPEN_BYTES = 128 << 20, 512 << 10


def _listed(folders: DataFrame) -> DataFrame:
    """What is directly in each folder of ``path``. A folder that cannot be listed gives a row with ``error``."""
    # Sized by the number of folders: their names alone would be put into one task.
    n_folders = folders.count()
    arrow = to_arrow_schema(FOUND)

    def entries(paths: list[str]) -> Iterator[tuple]:
        for folder in paths:
            try:
                for name, length, modified, is_folder in files.list_folder(folder):
                    yield f"{folder.rstrip('/')}/{name}", length, modified, is_folder, None
            except Exception as problem:
                yield folder, None, None, True, f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(entries(batch.column(0).to_pylist()), arrow)

    return folders.select("path").repartition(max(1, min(n_folders, LIST_TASKS)), "path").mapInArrow(run, FOUND)


def walk(spark: SparkSession, base: str, enter: Sequence[Callable[[Column], Column]]) -> tuple[DataFrame, DataFrame]:
    """Files below ``base`` as ``path, length, modified, depth``, and folders that could not be listed as ``path, error``.

    ``enter`` has a test of folder names for each further depth; ``depth`` is 0 for files directly in ``base``.
    """
    folders = spark.createDataFrame([(listing.resolved(spark, base),)], "path string")
    levels = []
    for depth, test in enumerate([*enter, None]):
        found = staged(_listed(folders)).withColumn("depth", F.lit(depth))
        levels.append(found)
        if test is not None:
            inside = F.col("is_folder") & F.col("error").isNull() & test(file_name_of(F.col("path")))
            folders = found.filter(inside).select("path")
    every = reduce(DataFrame.union, levels)
    failed = every.filter(F.col("error").isNotNull()).select("path", "error")
    return every.filter(~F.col("is_folder")).select(*MANIFEST, "depth"), failed


def batch_workbooks(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Workbooks directly in the batch folders of ``base``: ``path, length, modified, batch, file_name, cell_line``; failed folders."""
    found, failed = walk(spark, base, [is_batch_folder])
    return listing.batch_files(found.filter("depth = 1").select(*MANIFEST)), failed


def plot_workbooks(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Workbooks in ``folder`` and its direct subfolders: ``path, length, modified, file_name, cell_line``; failed folders."""
    found, failed = walk(spark, folder, [listing.is_plain_folder])
    return listing.workbook_files(found.select(*MANIFEST), listing.resolved(spark, folder)), failed


def spread(manifest: DataFrame) -> DataFrame:
    """The rows dealt out so that each task opens files of about ``TASK_BYTES``. ``manifest`` is gone through twice."""
    cost = F.sum(F.col("length") + OPEN_BYTES)
    total = manifest.agg(F.coalesce(cost, F.lit(0))).first()[0]
    return manifest.repartition(max(1, -(-total // TASK_BYTES)))
