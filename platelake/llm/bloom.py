"""Blocked Bloom filters as tables: 256 bits a block, eight bits of one block for each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm.shared import stored, unused

MAX_BLOCKS = 1 << 19
KEYS_PER_BLOCK = 16
WORDS = 4


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def masks(key: Column) -> list[Column]:
    """Two bits in each of the four words of a block."""
    h = F.xxhash64(key, F.lit("bits"))

    def bit(place: int) -> Column:
        at = F.shiftrightunsigned(h, 6 * place).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), at)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(WORDS)]


def blocks_for(keys: int) -> int:
    """About 16 bits for each key, ``MAX_BLOCKS`` blocks at most: a filter can be sent to every task."""
    needed = max(1, -(-keys // KEYS_PER_BLOCK))
    return min(MAX_BLOCKS, 1 << (needed - 1).bit_length())


def filter_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``bloom_block, w0 .. w3`` of the filter over a column."""
    rows = keys.select(block_of(F.col(key), blocks).alias("bloom_block"), *[m.alias(f"w{i}") for i, m in enumerate(masks(F.col(key)))])
    return rows.groupBy("bloom_block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def may_be_in(rows: DataFrame, key: Column, keys: DataFrame, name: str, into: str) -> DataFrame:
    """``rows`` with the boolean ``into``: false only where ``key`` is not in column ``name`` of ``keys`` (distinct, written)."""
    blocks = blocks_for(keys.count())
    # At most MAX_BLOCKS rows of five numbers.
    found = stored(filter_blocks(keys, name, blocks))
    fields = {f: unused(rows, f) for f in ("bloom_block", *(f"w{i}" for i in range(WORDS)))}
    bloom = found.select(*[F.col(f).alias(n) for f, n in fields.items()])
    probed = rows.withColumn(into, block_of(key, blocks)).join(F.broadcast(bloom), F.col(into) == F.col(fields["bloom_block"]), "left")
    all_set = key.isNotNull()
    for i, mask in enumerate(masks(key)):
        all_set = all_set & (F.col(fields[f"w{i}"]).bitwiseAND(mask) == mask)
    return probed.withColumn(into, F.coalesce(all_set, F.lit(False))).drop(*fields.values())


def matching(rows: DataFrame, key: Column, wanted: DataFrame, name: str) -> DataFrame:
    """``rows`` joined with ``wanted`` (written, distinct in ``name``) on ``key``; only likely rows are shuffled."""
    likely = unused(rows, "likely")
    return may_be_in(rows, key, wanted, name, likely).filter(F.col(likely)).drop(likely).join(wanted, key == F.col(name))
