"""Cell line × compound grid and the report table drawn from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.functions.markup import (
    DEFAULT_COLOR,
    EMPTY_CELL,
    HEAD_END,
    PAGE_END,
    PAGE_START,
    TABLE_END,
    TABLE_START,
    caption,
    header_cell,
    image_cell,
    line_header,
)

HEADER, BODY, FOOTER = 0, 1, 2


def _columns(compounds: list[str]) -> Column:
    """The grid's columns as one short literal array of ``plot_no, compound, slots``.

    ``slots`` are the plot numbers of that compound, last first: a compound listed twice shows its last picture in
    both columns.
    """
    numbered = list(enumerate(compounds, start=1))
    return F.array(
        *[
            F.struct(
                F.lit(no).alias("plot_no"),
                F.lit(compound).alias("compound"),
                F.array(*[F.lit(n) for n, c in reversed(numbered) if c == compound]).alias("slots"),
            )
            for no, compound in numbered
        ]
    )


def _picture(images: Column, slots: Column) -> Column:
    found = F.filter(F.transform(slots, lambda n: F.try_element_at(images, n)), lambda p: p.isNotNull())
    return F.try_element_at(found, F.lit(1))


def _colored(images: DataFrame, colors: DataFrame | None) -> DataFrame:
    """``colors``: ``key, value`` option rows, or None."""
    if colors is None:
        return images.withColumn("color", F.lit(DEFAULT_COLOR))
    lookup = colors.select(F.col("key").alias("cell_line"), F.col("value").alias("color"))
    return images.join(lookup, "cell_line", "left").withColumn(
        "color", F.coalesce(F.col("color"), F.lit(DEFAULT_COLOR))
    )


def _order_table(images: DataFrame, compounds: list[str], names: DataFrame | None) -> DataFrame:
    """``plot_no, compound, display_name``; as many rows as the section had entries."""
    spark = images.sparkSession
    order = spark.createDataFrame(list(enumerate(compounds, start=1)), "plot_no int, compound string")
    if names is None:
        return order.withColumn("display_name", F.lit(""))
    lookup = names.select(F.col("key").alias("compound"), F.col("value").alias("display_name"))
    return order.join(lookup, "compound", "left").select(
        "plot_no", "compound", F.coalesce("display_name", F.lit("")).alias("display_name")
    )


def plot_grid(
    images: DataFrame, compounds: list[str], names: DataFrame | None = None, colors: DataFrame | None = None
) -> DataFrame:
    """Long grid: each cell line with each compound in plot order, ``payload`` NULL where there is no picture.

    The columns come as one short literal array, so the grid is an explode on each row and needs no join of pairs.
    """
    cells = _colored(images, colors).select(
        "cell_line", "path", "color", "images", F.explode(_columns(compounds)).alias("c")
    )
    cells = cells.select(
        "cell_line",
        F.col("c.plot_no").alias("plot_no"),
        F.col("c.compound").alias("compound"),
        "color",
        "path",
        _picture(F.col("images"), F.col("c.slots")).alias("payload"),
    )
    order = _order_table(images, compounds, names).select("plot_no", "display_name")
    return cells.join(order, "plot_no").select(
        "cell_line", "plot_no", "compound", "display_name", "color", "path", "payload"
    )


def report_rows(
    images: DataFrame, compounds: list[str], names: DataFrame | None = None, colors: DataFrame | None = None
) -> DataFrame:
    """``section, cell_line, line``: header, one table row per cell line, footer. Sort by the first two to write."""
    order = _order_table(images, compounds, names)
    title = F.struct("plot_no", header_cell(F.col("compound"), F.col("display_name")).alias("th"))
    header_cells = F.array_sort(F.collect_list(title))
    head = order.agg(
        F.concat(
            F.lit(PAGE_START + TABLE_START),
            F.array_join(F.transform(header_cells, lambda c: c["th"]), ""),
            F.lit(HEAD_END),
        ).alias("line")
    )
    pictures = F.transform(
        _columns(compounds),
        lambda c: F.coalesce(
            image_cell(_picture(F.col("images"), c["slots"]), c["compound"], F.col("cell_line")), F.lit(EMPTY_CELL)
        ),
    )
    body = _colored(images, colors).select(
        F.lit(BODY).alias("section"),
        "cell_line",
        F.concat(
            F.lit("<tr>"), line_header(F.col("cell_line"), F.col("color")), F.array_join(pictures, ""), F.lit("</tr>")
        ).alias("line"),
    )
    foot = images.agg(
        F.concat(F.lit(TABLE_END), caption(F.lit(len(compounds)), F.count("*")), F.lit(PAGE_END)).alias("line")
    )
    no_line = F.lit(None).cast("string")
    return (
        head.select(F.lit(HEADER).alias("section"), no_line.alias("cell_line"), "line")
        .unionByName(body)
        .unionByName(foot.select(F.lit(FOOTER).alias("section"), no_line.alias("cell_line"), "line"))
    )


def in_report_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("section", "cell_line")
