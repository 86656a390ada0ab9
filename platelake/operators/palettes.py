"""Colours from palettes that are tables: any number of palettes, with any number of stops.

A palette's stops cut its range into stretches. Each stretch is listed under the parts of the range that it touches, a palette having
as many equal parts as stops, and a value meets only the stretches of its own part: an equi-join on palette and part, after
which the bounds decide. No pair of value and stop is made beyond those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platelake.functions.colors import rgb_hex

CHANNELS = ("r", "g", "b")


def palette_ranges(stops: DataFrame) -> DataFrame:
    """``palette, first, last, n``: where each palette begins and ends, and its number of stops."""
    return stops.groupBy("palette").agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count("*").alias("n"))


def _part(t, first, last, n):
    """The part of the palette's range, from 0, that holds ``t``; the end belongs to the last one."""
    share = F.when(last > first, (t - first) / (last - first)).otherwise(F.lit(0.0))
    return F.least(F.floor(share * n), n - 1)


def stretches(stops: DataFrame, ranges: DataFrame) -> DataFrame:
    """``palette, part, is_first, t0, t1`` and both ends' channels: each stretch once for every part that it touches."""
    ordered = Window.partitionBy("palette").orderBy("t", *CHANNELS)
    after = [F.lead(c).over(ordered).alias(f"{c}1") for c in ("t", *CHANNELS)]
    before = [F.col(c).alias(f"{c}0") for c in ("t", *CHANNELS)]
    found = stops.select("palette", (F.row_number().over(ordered) == 1).alias("is_first"), *before, *after)
    # A palette of one stop has one stretch without length; else the last stop only ends one.
    ends = [F.coalesce(f"{c}1", f"{c}0").alias(f"{c}1") for c in ("t", *CHANNELS)]
    whole = found.filter(F.col("t1").isNotNull() | F.col("is_first")).select("palette", "is_first", *[f"{c}0" for c in ("t", *CHANNELS)], *ends)
    sized = whole.join(ranges.withColumnRenamed("palette", "of"), F.col("palette") == F.col("of"))
    at = [_part(F.col(c), F.col("first"), F.col("last"), F.col("n")) for c in ("t0", "t1")]
    return sized.withColumn("part", F.explode(F.sequence(*at))).drop("of", "first", "last", "n")


def palette_colored(values: DataFrame, stops: DataFrame, name: str = "color") -> DataFrame:
    """``values`` (with ``palette`` and ``t``) and the colour of each: on a straight line between the stops around it.

    Values before the first or beyond the last stop have that stop's colour. A value without ``t``, or of a palette
    without stops, has none. A stop belongs to the stretch below it.
    """
    ranges = palette_ranges(stops)
    listed = stretches(stops, ranges).withColumnsRenamed({"palette": "p", "part": "q"})
    sized = values.join(ranges.withColumnRenamed("palette", "of"), F.col("palette") == F.col("of"), "left")
    held = sized.withColumn("_t", F.greatest(F.least("t", "last"), "first")).withColumn("_t", F.when(F.col("t").isNotNull(), F.col("_t")))
    placed = held.withColumn("_part", _part(F.col("_t"), F.col("first"), F.col("last"), F.col("n")))
    inside = ((F.col("_t") > F.col("t0")) | (F.col("is_first") & (F.col("_t") == F.col("t0")))) & (F.col("_t") <= F.col("t1"))
    joined = placed.join(listed, (F.col("palette") == F.col("p")) & (F.col("_part") == F.col("q")) & inside, "left")
    share = F.when(F.col("t1") > F.col("t0"), (F.col("_t") - F.col("t0")) / (F.col("t1") - F.col("t0"))).otherwise(F.lit(0.0))
    channels = [F.col(f"{c}0") + share * (F.col(f"{c}1") - F.col(f"{c}0")) for c in CHANNELS]
    return joined.withColumns({f"_{c}": v for c, v in zip(CHANNELS, channels)}).select(*values.columns, rgb_hex([F.col(f"_{c}") for c in CHANNELS]).alias(name))
