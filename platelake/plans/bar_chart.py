"""A gene/value sheet to chart-ready bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.functions.numbers import missing_to_null, number_of
from platelake.operators import bars
from platelake.sinks import writers
from platelake.sources import workbooks
from platelake.sources.listing import literal_path

# The two input columns by position, for sheets with other headers.
BY_POSITION = {"gene": 1, "value": 2}


def read_bars(spark: SparkSession, path: str, by_position: bool = False) -> DataFrame:
    book = spark.read.format("binaryFile").load(literal_path(path))
    rows = workbooks.read_sheet(book, BY_POSITION if by_position else workbooks.BAR_COLUMNS)
    problem = rows.filter(F.col("error").isNotNull()).select("error").first()
    if problem is not None:
        raise ValueError(f"{path}: {problem['error']}")
    return bar_values(rows)


def bar_values(rows: DataFrame) -> DataFrame:
    """``gene`` and ``value`` text to numbers as readings have them: no value and no number are NULL."""
    number = rows.select("gene", number_of(missing_to_null(F.col("value"))).alias("value"))
    return number.select("gene", F.when(~F.isnan("value"), F.col("value")).alias("value"))


def bar_chart(
    spark: SparkSession, path: str, out: str, axis: bars.AxisBreak = bars.TWO_PANEL_BREAK, by_position: bool = False
) -> DataFrame:
    """Write the bar table below ``out`` in rank order and return it."""
    writers.write_bars(bars.bar_table(read_bars(spark, path, by_position), axis), out)
    return spark.read.parquet(out)
