"""Workbook files as rows: ``path, length, batch / folder, file_name, cell_line`` without reading their bytes.

A listing is a scan of a folder and a function over its ``path`` column. ``binaryFile`` reads the content only when the
``content`` column is used, so a listing costs no file reads. Names are taken from ``path``, which keeps blanks as they are.
Spark's readers pass over files whose name starts with ``_`` or ``.``; ``walk`` lists them too.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.functions.identifiers import (
    cell_line_of,
    file_name_of,
    folder_of,
    is_batch_folder,
    is_workbook_name,
)


def literal_path(path: str) -> str:
    """``path`` with its glob characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _files(spark: SparkSession, pattern: str, name: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", name).load(pattern)


def batch_files(files: DataFrame) -> DataFrame:
    """Rows with a ``path`` to those that are workbooks of a batch folder, with ``batch, file_name, cell_line``."""
    named = files.withColumns({"batch": folder_of(F.col("path")), "file_name": file_name_of(F.col("path"))})
    name = F.col("file_name")
    wanted = is_batch_folder(F.col("batch")) & name.endswith(".xlsx") & ~name.startswith("~")
    return named.filter(wanted).withColumn("cell_line", cell_line_of(name))


def list_batches(spark: SparkSession, base: str) -> DataFrame:
    """Workbooks directly in the batch folders of ``base``: ``path, length, content, batch, file_name, cell_line``."""
    files = _files(spark, f"{literal_path(base.rstrip('/'))}/*cells/", "*.xlsx")
    return batch_files(files.select("path", "length", "content"))


def batch_catalog(workbooks: DataFrame) -> DataFrame:
    """Files per batch, in batch order."""
    return workbooks.groupBy("batch").agg(F.count("*").alias("n_files")).orderBy("batch")


def is_plain_folder(name: Column) -> Column:
    """Folders that hold workbooks to be shown."""
    return ~name.startswith("__") & ~name.startswith(".")


def workbook_files(files: DataFrame, base: str) -> DataFrame:
    """Rows with a ``path`` to the workbooks in ``base`` or a direct subfolder, with ``file_name, cell_line``.

    ``base`` is written as in ``path``. Subfolders starting ``__`` or ``.`` are left out.
    """
    root = base.rstrip("/") + "/"
    below = F.col("path").substr(F.lit(len(root) + 1), F.length("path"))
    folder = F.when(F.instr(below, "/") > 0, F.substring_index(below, "/", 1)).otherwise("")
    depth = F.length(below) - F.length(F.replace(below, F.lit("/"), F.lit("")))
    inside = F.col("path").startswith(root) & (depth <= 1) & is_plain_folder(folder)
    named = files.filter(inside).withColumn("file_name", file_name_of(F.col("path")))
    return named.filter(is_workbook_name(F.col("file_name"))).withColumn("cell_line", cell_line_of(F.col("file_name"), fallback=True))


def resolved(spark: SparkSession, folder: str) -> str:
    """``folder`` as Spark writes it in ``path``: absolute, with its scheme."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


def is_folder(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(place) and system.getFileStatus(place).isDirectory()


def list_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """Workbooks in ``folder`` and its direct subfolders: ``path, length, content, file_name, cell_line``.

    One glob covers both depths: it matches the files of the folder, and its subfolders, whose files are listed.
    """
    files = _files(spark, f"{literal_path(folder.rstrip('/'))}/*", "*_paste.xlsx")
    return workbook_files(files.select("path", "length", "content"), resolved(spark, folder))
