"""Writers. Tasks write side by side; nothing is gathered first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from platelake.operators import grid
from platelake.operators.ranking import spread_sort


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_batches(raw: DataFrame, path: str, whole: bool = False) -> dict[str, int]:
    """Raw rows as Parquet, one folder a batch; only batches that have rows are written, all others stay unless ``whole``.

    Returns the numbers of rows, of rows with an error, and of those that are new (``is_new``, which is not written): they are
    observed while the rows are written, not read again.
    """
    seen = Observation()
    new = F.col("is_new")
    counts = {"n_rows": F.count("*"), "n_unreadable": F.count("error"), "n_new_rows": F.count_if(new)}
    # Observed after the shuffle, as one without rows is left out of the plan with all that is below it.
    observed = raw.hint("rebalance", "batch").observe(seen, *[c.alias(n) for n, c in counts.items()]).drop("is_new")
    writer = observed.write.mode("overwrite").partitionBy("batch")
    writer.option("partitionOverwriteMode", "static" if whole else "dynamic").parquet(path)
    return seen.get


def write_readings(readings: DataFrame, path: str) -> None:
    """Long readings as Parquet, one folder per batch, so that a run over some batches reads only those.

    Rebalanced by batch: otherwise each task would add a file to each batch it has met. A batch with a large share of
    the rows is split over tasks at run time.
    """
    readings.hint("rebalance", "batch").write.mode("overwrite").partitionBy("batch").parquet(path)


def write_wide(consolidated: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The consolidated table in its order; ``fmt`` is ``parquet`` or ``csv`` (with a header line)."""
    writer = consolidated.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_sheet(lines: DataFrame, path: str) -> None:
    """The consolidated sheet with its two header rows as CSV text parts; the parts in name order are the sheet."""
    ordered = spread_sort(lines, "section", *[F.asc_nulls_last(c) for c in ("batch", "cell_line", "assay_cell_line")])
    ordered.select("line").write.mode("overwrite").text(path)


def write_report(rows: DataFrame, path: str) -> None:
    """The report table as text parts; the parts in name order are the document."""
    grid.in_report_order(rows).select("line").write.mode("overwrite").text(path)


def write_bars(bars: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Bars as they come: ranking has put them in order."""
    write_wide(bars, path, fmt)
