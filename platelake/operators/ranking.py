"""Row numbers over a whole table without sending it through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.session import pin

# monotonically_increasing_id: partition number above these bits, row position below.
POSITION_BITS = 33


def spread_sort(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` sorted, with an arrival number as last key: rows that tie can lie in several partitions.

    Without it all copies of one key would go to a single task, however many there are.
    """
    return df.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*order, "_tie").drop("_tie")


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """1-based position of each row in the order given, ties in a fixed but arbitrary order.

    Rows are range-partitioned and sorted, so each row's position inside its partition comes with it; one row per
    partition is then enough to learn how many rows lie before each partition. The sorted rows are pinned first, as
    both passes must see the same partitions, also after an executor is lost.
    """
    placed = pin(spread_sort(df, *order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", POSITION_BITS)
    position = F.col("_at").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition: as many as the sort had tasks, whatever the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_before") + position + 1).cast("long"))
        .drop("_part", "_at", "_before")
    )
