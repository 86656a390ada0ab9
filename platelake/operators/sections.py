"""Compound lists read from a marked section of a sheet column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.functions.identifiers import id_last, is_control, is_section_marker

# Fixed values.
SECTION_SHEETS = ("Analyzed Data", "Data analysis for IC50")
SECTION_COLUMN = 2


def choose_sheet(sheets: DataFrame, candidates: Sequence[str] = SECTION_SHEETS) -> DataFrame:
    """``workbook, sheet`` pairs to the first candidate each workbook holds; workbooks with none drop out."""
    names = F.array(*[F.lit(c) for c in candidates])
    priority = F.array_position(names, F.col("sheet"))
    return (
        sheets.filter(F.col("sheet").isin(*candidates))
        .groupBy("workbook")
        .agg(F.min(priority).alias("priority"))
        .select("workbook", F.element_at(names, F.col("priority").cast("int")).alias("sheet"))
    )


def section_cells(cells: DataFrame, last_row: int | None = None) -> DataFrame:
    """The column of a cell grid that a section scan looks at; ``last_row`` only where the caller wants a limit."""
    column = cells.filter(F.col("col") == SECTION_COLUMN)
    return column if last_row is None else column.filter(F.col("row") <= last_row)


def _is_empty(value: Column, value_type: Column) -> Column:
    return (
        value.isNull()
        | ((value_type == "s") & (value == ""))
        | ((value_type == "n") & (value.try_cast("double") == 0))
        | ((value_type == "b") & (value == "False"))
    )


def section_entries(cells: DataFrame) -> DataFrame:
    """``workbook, row, value, value_type`` of one column to ``workbook, plot_no, row, compound``.

    Entries are the texts below the first marker, up to the first empty row after an entry was taken. Markers, the
    control and texts without an id are passed over; numbers neither count nor stop. A row absent from ``cells`` is
    an empty row, so the section ends where row numbers leave a gap.

    Windows over one workbook's column, all with the same partitions and order: one shuffle and one sort.
    """
    # An error cell reads as its text, such as #N/A.
    text = F.when(F.col("value_type").isin("s", "e"), F.col("value"))
    compound = id_last(text)
    marker = is_section_marker(text)
    kept = F.coalesce(~marker & (compound != "") & ~is_control(compound), F.lit(False))
    filled = cells.filter(~_is_empty(F.col("value"), F.col("value_type"))).select(
        "workbook",
        F.col("row").cast("int").alias("row"),
        marker.alias("marker"),
        F.when(kept, compound).alias("compound"),
    )
    book = Window.partitionBy("workbook").orderBy("row")
    so_far = book.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.coalesce(F.max(F.when(F.col("marker"), F.col("row"))).over(so_far), F.lit(0)) > 0
    inside = filled.select("*", begun.alias("begun"), F.lag("row").over(book).alias("before"))
    inside = inside.filter(F.col("begun")).withColumn("taken", F.col("compound").isNotNull())
    n_taken = F.sum(F.col("taken").cast("int")).over(so_far)
    counted = inside.select("*", n_taken.alias("plot_no"), (F.col("row") - F.col("before") > 1).alias("gap"))
    # A gap ends the section if an entry was taken above it.
    ended = F.max((F.col("gap") & (F.col("plot_no") - F.col("taken").cast("int") > 0)).cast("int")).over(so_far)
    rows = counted.select("*", F.coalesce(ended, F.lit(0)).alias("ended")).filter((F.col("ended") == 0) & F.col("taken"))
    return rows.select("workbook", F.col("plot_no").cast("int").alias("plot_no"), "row", "compound")


def first_workbook(workbooks: DataFrame) -> DataFrame:
    """The one ``cell_line, path`` that comes first by cell line; its section sets the compound order."""
    return workbooks.agg(F.min(F.struct("cell_line", "path")).alias("f")).select("f.cell_line", "f.path")


def plot_order(entries: DataFrame) -> list[str]:
    """Compounds of one workbook's section in plot order; a sheet has at most 1,048,576 rows."""
    rows = entries.select("workbook", "plot_no", "compound").collect()
    if len({r["workbook"] for r in rows}) > 1:
        raise ValueError("plot_order takes the section of a single workbook")
    return [r["compound"] for r in sorted(rows, key=lambda r: r["plot_no"])]
