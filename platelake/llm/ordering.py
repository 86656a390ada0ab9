"""Positions in a global order, without sending a table through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm.shared import stored, unused

#: Fixed value: ``monotonically_increasing_id`` has the partition above these bits and the row's place below.
PLACE_BITS = 33


def numbered(df: DataFrame, *order: Column, name: str, first: int = 1) -> DataFrame:
    """``df`` with its dense position in ``order`` as column ``name``; without ``order`` any dense numbering.

    Rows are sorted over ranges, each knows its place in its partition, and the rows are written once, so that both
    passes see the same places. Rows that tie are shared out by arrival, so no key has to lie in one task. One row per
    partition tells how many rows lie before it.
    """
    tie, at, part, before = (unused(df, c) for c in ("tie", "at", "part", "before"))
    if order:
        df = df.withColumn(tie, F.monotonically_increasing_id()).orderBy(*order, tie).drop(tie)
    placed = stored(df.withColumn(at, F.monotonically_increasing_id()))
    number = F.shiftrightunsigned(F.col(at), PLACE_BITS)
    sizes = placed.groupBy(number.alias(part)).agg(F.count("*").alias("n"))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # as many rows as the sort had tasks
    offsets = stored(sizes.select(part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before)))
    place = F.col(at).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    joined = placed.withColumn(part, number).join(offsets, part)
    return joined.withColumn(name, (F.col(before) + place + first).cast("long")).drop(part, at, before)
