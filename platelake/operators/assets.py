"""Embedded plot images: which ones count, and which compound each belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values, in bytes; an image must be larger.
PLACEHOLDER_BYTES = 3000
UNUSABLE_BYTES = 1000


def rank_assets(assets: DataFrame, n_plots: int, min_bytes: int = PLACEHOLDER_BYTES) -> DataFrame:
    """``path, cell_line, image_no, member, n_bytes, …`` to the first ``n_plots`` real plots of each workbook.

    The row limit is a literal, so Spark keeps only ``n_plots`` images per workbook and task before the shuffle: a
    workbook holding a large share of all images sends a few rows, and payloads that drop out never move.
    """
    order = Window.partitionBy("cell_line", "path").orderBy("image_no", "member")
    return (
        assets.filter(F.col("n_bytes") > min_bytes)
        .withColumn("plot_no", F.row_number().over(order))
        .filter(F.col("plot_no") <= n_plots)
    )


def usable(ranked: DataFrame, payload: str = "payload", min_bytes: int = UNUSABLE_BYTES) -> DataFrame:
    """Drop images whose picture is missing or too small. Done after ranking, so the others keep their numbers."""
    return ranked.filter(F.octet_length(F.col(payload)) > min_bytes)


def cell_images(pictures: DataFrame, payload: str = "payload") -> DataFrame:
    """``cell_line, path, images``: plot number -> payload, from the last workbook of each cell line.

    The last workbook is found by names alone; only its images are then gathered, at most one per compound.
    """
    last = pictures.groupBy("cell_line").agg(F.max("path").alias("path"))
    entry = F.struct(F.col("plot_no").cast("int").alias("plot_no"), F.col(payload).alias("payload"))
    return (
        pictures.join(last, ["cell_line", "path"], "left_semi")
        .groupBy("cell_line", "path")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("images"))
    )
