"""Chart-ready rows for bars on a broken value axis."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.functions import colors
from platelake.operators.ranking import global_rank


class AxisBreak(NamedTuple):
    """Two visible parts of the axis; ``high2`` None means no upper end, ``scale2`` shrinks the second part."""

    low1: float
    high1: float
    low2: float
    high2: float | None
    scale2: float = 1.0


# The two axis styles.
TWO_PANEL_BREAK = AxisBreak(0.0, 15.0, 55.0, 65.0)
OPEN_HALF_SCALE_BREAK = AxisBreak(0.0, 15.0, 55.0, None, 0.5)


def normalised(bars: DataFrame) -> DataFrame:
    """Add ``t``: the place of ``value`` between the smallest and largest value, 0 when they are equal.

    The range is one scalar subquery with partial aggregation; no window and no join.
    """
    span = bars.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high")).alias("span"))
    return (
        bars.withColumn("_span", span.scalar())
        .withColumn(
            "t",
            F.when(F.col("value").isNull(), F.lit(None).cast("double"))
            .when(F.col("_span.high") == F.col("_span.low"), F.lit(0.0))
            .otherwise((F.col("value") - F.col("_span.low")) / (F.col("_span.high") - F.col("_span.low"))),
        )
        .drop("_span")
    )


def on_axis(bars: DataFrame, axis: AxisBreak = TWO_PANEL_BREAK) -> DataFrame:
    """Add ``segment`` and the visible bar length on each part."""
    value = F.col("value")
    low1, high1, low2 = F.lit(axis.low1), F.lit(axis.high1), F.lit(axis.low2)
    beyond = F.lit(False) if axis.high2 is None else value > F.lit(axis.high2)
    segment = (
        F.when(value < low1, F.lit("below"))
        .when(value <= high1, F.lit("left"))
        .when(value < low2, F.lit("gap"))
        .when(beyond, F.lit("above"))
        .when(value.isNotNull(), F.lit("right"))
    )
    capped = value if axis.high2 is None else F.least(value, F.lit(axis.high2))

    def length(end, start, scale):
        return F.when(value.isNotNull(), (F.greatest(end, start) - start) * F.lit(scale))

    return (
        bars.withColumn("segment", segment)
        .withColumn("left_len", length(F.least(value, high1), low1, 1.0))
        .withColumn("right_len", length(capped, low2, axis.scale2))
    )


def _step(df: DataFrame, names: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    return df.withColumns(dict(zip(names, columns)))


def colored(bars: DataFrame) -> DataFrame:
    """Add the fill colour of each style: diverging map, Lab gradient, and the gradient in plain RGB.

    Built column by column: as one nested expression each channel would repeat all steps before it many times.
    """
    keep = bars.columns
    stepped = bars.withColumn("_at", colors.segment_of(F.col("t"), colors.gradient_stops()))
    stepped = _step(stepped, ("_r", "_g", "_b", "_l", "_a", "_s"), colors.gradient_rgb("t", "_at") + colors.gradient_lab("t", "_at"))
    stepped = _step(stepped, ("_fx", "_fy", "_fz"), colors.lab_axes("_l", "_a", "_s"))
    stepped = _step(stepped, ("_x", "_y", "_z"), colors.axes_to_xyz(("_fx", "_fy", "_fz")))
    stepped = _step(stepped, ("_x", "_y", "_z"), colors.xyz_to_linear(("_x", "_y", "_z")))
    stepped = _step(stepped, ("_x", "_y", "_z"), colors.linear_to_rgb(("_x", "_y", "_z")))
    return stepped.select(
        *keep,
        colors.diverging_color(F.col("t")).alias("diverging"),
        colors.rgb_hex([F.col(c) for c in ("_x", "_y", "_z")]).alias("gradient"),
        colors.rgb_hex([F.col(c) for c in ("_r", "_g", "_b")]).alias("gradient_rgb"),
    )


def ranked(bars: DataFrame) -> DataFrame:
    """Add ``rank``: position from the bottom of the chart, by value, missing values last, then gene."""
    return global_rank(bars, F.asc_nulls_last("value"), F.asc_nulls_last("gene"))


def one_per_gene(bars: DataFrame) -> DataFrame:
    """One row for each gene: its greatest value, as bars of one gene are drawn over each other."""
    return bars.groupBy("gene").agg(F.max("value").alias("value"))


def bar_table(bars: DataFrame, axis: AxisBreak = TWO_PANEL_BREAK) -> DataFrame:
    """``gene, value`` to ``rank, gene, value, t, segment, left_len, right_len, diverging, gradient, gradient_rgb``."""
    # Ranked before the rest: only gene, value and t pass through the sort.
    return colored(on_axis(ranked(normalised(one_per_gene(bars))), axis)).select(
        "rank", "gene", "value", "t", "segment", "left_len", "right_len", "diverging", "gradient", "gradient_rgb"
    )
