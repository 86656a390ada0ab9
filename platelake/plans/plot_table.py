"""Workbooks with embedded plots to the report table of cell lines × compounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.functions.markup import payload_text
from platelake.operators import assets, grid, sections
from platelake.session import staged
from platelake.sinks import summary, writers
from platelake.sources import archives, listing, tables, walk, workbooks


def _order(first: DataFrame) -> list[str]:
    """Compounds in plot order from the one workbook in ``first``."""
    cells = staged(workbooks.read_cells(first).withColumnRenamed("path", "workbook"))
    problem = cells.filter(F.col("error").isNotNull()).select("workbook", "error").first()
    if problem is not None:
        raise ValueError(f"{problem['workbook']}: {problem['error']}")
    order = sections.plot_order(sections.section_entries(cells))
    if not order:
        raise ValueError("the first workbook has no compound list")
    return order


def _first_path(named: DataFrame, source: str) -> str:
    path = sections.first_workbook(named).first()["path"]
    if path is None:
        raise ValueError(f"no workbooks in {source}")
    return path


def _from_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    listed, failed = walk.plot_workbooks(spark, folder)
    first = _first_path(listed.select("cell_line", "path"), folder)
    book = spark.createDataFrame([(first,)], "path string")  # only this one file is opened
    return walk.spread(listed), listed.select("path"), failed, _order(book)


def _from_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    members, failed = archives.archive_workbooks(spark.createDataFrame([(listing.resolved(spark, path),)], "path string"))
    at = archives.member_path()
    first = _first_path(members.select("cell_line", at.alias("path")), path)
    order = _order(archives.placed_workbooks(members.filter(at == first)))
    return archives.placed_workbooks(members), members.select(at.alias("path")), failed, order


def plot_table(
    spark: SparkSession,
    source: str,
    out: str,
    names: str | None = None,
    colors: str | None = None,
    pictures: DataFrame | None = None,
) -> list[str]:
    """Write ``report`` (text), ``grid``, ``images``, ``file_counts`` and ``rejected_files`` below ``out``; return the plot order.

    ``source`` is a folder, or an archive: a path ending in ``.zip`` that is no folder. ``names`` and ``colors`` are paths of JSON option files.
    ``pictures`` (``path, member, picture``) gives the drawn form of each image; without it the image's own
    bytes are embedded.
    """
    read = _from_archive if source.endswith(".zip") and not listing.is_folder(spark, source) else _from_folder
    found, listed, failed, order = read(spark, source)
    # Workbooks are opened once; all that follows starts from the images they gave.
    raw = workbooks.read_images(found, assets.PLACEHOLDER_BYTES, first=len(order))
    writers.write_table(raw, f"{out}/images")
    images = spark.read.schema(raw.schema).parquet(f"{out}/images")
    rejected = images.filter(F.col("error").isNotNull()).select("path", "error").unionByName(failed)
    rejected.write.mode("overwrite").json(f"{out}/rejected_files")

    writers.write_table(summary.file_counts(listed, images.filter(F.col("error").isNull()), "path"), f"{out}/file_counts")

    # The reader has numbered the images, so their bytes move only when they are gathered.
    ranked = images.filter(F.col("error").isNull() & (F.col("plot_no") <= len(order)))
    if pictures is not None:
        drawn = pictures.withColumnRenamed("picture", "content")
        ranked = ranked.drop("content").join(drawn, ["path", "member"], "left")
    kept = assets.usable(ranked, "content").withColumn("payload", payload_text(F.col("content")))
    writers.write_table(assets.cell_images(kept), f"{out}/cell_images")
    cells = spark.read.parquet(f"{out}/cell_images")
    display, shades = tables.read_options(spark, names), tables.read_options(spark, colors)
    writers.write_table(grid.plot_grid(cells, order, display, shades), f"{out}/grid")
    writers.write_report(grid.report_rows(cells, order, display, shades), f"{out}/report")
    return order
