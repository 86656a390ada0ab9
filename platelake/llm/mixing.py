"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: each source has a weight, by its place in code-point order; the words of all sources are shared by weight, no source gets more than
``MOST`` times its words, and what is above that is shared again by weight until nothing is. A source's complete epochs come
first: every document is taken ``floor(target / words)`` times. What is left of the target is a weighted sample without
replacement: a document's key is an exponential draw divided by its quality weight, keys are sorted within the source, and
documents are taken while the running sum of their words stays within the budget. Documents are taken whole, so one further document, that whose
size comes nearest to what is missing, closes the gap where that brings the source nearer to its target.

The quality weight of a text is the fourth power of its share of letters, so digits and marks make a text less likely to
be repeated. The draw is a digest of id and text, so reruns agree.

How it scales: texts are read once, for sizes; what is sorted are ids, keys and sizes, over ranges of (source, key), so a
source with a third of all rows lies in many tasks. Tasks carry running sums, and one row per task and source tells what lies before it.

Edge cases: a NULL or empty text has no words and is never taken; a NULL source is a source, the last; NULL ids and repeated
rows are documents of their own (equal rows share one draw and are taken one after the other); an empty table gives an empty result;
further columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm import spans
from platelake.llm.ordering import numbered
from platelake.llm.shared import col, stored

WEIGHTS = (5, 2, 1)
MOST = 3
DRAW_DIGITS = 13  # hexadecimal: 52 bits, which a double holds
SHARPNESS = 4

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]] = True
#: One byte of each character that is no white space: not the second and further bytes of a character.
VISIBLE = ~spans.SPACE
VISIBLE[0x80:0xC0] = False


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in spans.chunked(batches, "text"):
        texts = spans.texts_of(part.column("text"))
        size = spans.words(texts).counts()
        data = texts.data[: texts.size]
        letters, visible = (spans.per_text(kind[data], texts.offsets) for kind in (LETTER, VISIBLE))
        share = (letters + 1.0) / (visible + 1.0)
        columns = [part.column(c) for c in ("doc_id", "source", "draw")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(size), pa.array(share**SHARPNESS)], ["doc_id", "source", "draw", "size", "weight"])


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, key``: the words of every text and its sampling key, ``-ln(u) / weight``."""
    found = docs.select(col(key).cast("long").alias("doc_id"), col(source).cast("string").alias("source"), col(text).cast("string").alias("text"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    draw = F.conv(F.substring(F.md5(named), 1, DRAW_DIGITS), 16, 10).cast("long")
    rows = found.withColumn("draw", draw).mapInArrow(_measured, "doc_id long, source string, draw long, size long, weight double")
    uniform = (F.col("draw") + F.lit(0.5)) / F.lit(float(16**DRAW_DIGITS))
    return rows.select("doc_id", "source", "size", (-F.log(uniform) / F.col("weight")).alias("key"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size`` to ``source, source_size, target``; each round of sharing is one aggregate, of which sums are gathered."""
    place = numbered(sizes, F.asc_nulls_last("source"), name="place", first=0)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = stored(place.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("cap")))
    total, open_weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return table.select("source", "source_size", F.lit(0.0).alias("target"))
    rest, left = total, open_weight
    while True:
        share = F.col("weight") * F.lit(rest) / F.lit(left)
        is_full = F.col("cap") < share
        caps, held = table.filter(is_full).agg(F.coalesce(F.sum("cap"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if (total - caps, open_weight - held) == (rest, left):
            return table.select("source", "source_size", F.when(is_full, F.col("cap").cast("double")).otherwise(share).alias("target"))
        rest, left = total - caps, open_weight - held


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and the running sum of ``size`` within each source; the rows come sorted by source and key."""
    number, last, carried = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("source")
        code = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        size = batch.column("size").to_numpy()
        begin = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        total = np.cumsum(size)
        base = np.repeat((total - size)[begin], np.diff(np.append(begin, len(code))))
        found = total - base
        if last is not None and last == (column[0].as_py(),):
            found[: begin[1] if len(begin) > 1 else len(code)] += carried
        last, carried = (column[-1].as_py(),), int(found[-1])
        columns = [*batch.columns, pa.array(np.full(len(code), number, np.int32)), pa.array(found)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "running"])


def _joined(rows: DataFrame, table: DataFrame, *also: str) -> DataFrame:
    """``rows`` with the further columns of the row of ``table`` for their source (NULL equals NULL) and ``also``."""
    right = table.withColumnsRenamed({c: f"{c}_r" for c in ("source", *also)})
    same = F.col("source").eqNullSafe(F.col("source_r"))
    for c in also:
        same &= F.col(c) == F.col(f"{c}_r")
    return rows.join(right, same, "left").drop("source_r", *[f"{c}_r" for c in also])


def mixed(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """``doc_id, source, size, source_size, target, times, taken``: how often the mix has each document, and the words this gives."""
    # The arrival number only parts rows that are equal in all else.
    rows = stored(measured(docs, key, text, source).withColumn("nth", F.monotonically_increasing_id()))
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    aims = aims.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))

    in_order = rows.orderBy("source", "key", "doc_id", "nth")
    placed = stored(in_order.mapInArrow(_running, "doc_id long, source string, size long, key double, nth long, part int, running long"))
    ends = placed.groupBy("source", "part").agg(F.max("running").alias("whole"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    before = ends.select("source", "part", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("before"))
    parts = stored(_joined(before, aims))
    summed = _joined(placed, parts, "part").withColumn("upto", F.col("before") + F.col("running"))
    sampled = F.col("upto") <= F.col("budget")

    done = summed.groupBy("source").agg(F.first("budget").alias("budget"), F.max(F.when(sampled, F.col("upto"))).alias("done"))
    missing = stored(done.select("source", (F.col("budget") - F.coalesce("done", F.lit(0))).alias("missing")))
    off = F.abs(F.col("size") - F.col("missing"))
    nearer = _joined(summed.filter(~sampled), missing).filter(off < F.col("missing"))
    last = nearer.groupBy("source").agg(F.min(F.struct(off.alias("off"), "key", "doc_id", "nth")).alias("m"))
    closing = stored(last.select("source", F.col("m.nth").alias("closing")))

    closes = F.coalesce(F.col("closing") == F.col("nth"), F.lit(False))
    times = F.when(F.col("size") > 0, F.col("epochs") + (sampled | closes).cast("long")).otherwise(F.lit(0)).cast("long")
    found = _joined(summed, closing).withColumn("times", times)
    return found.select("doc_id", "source", "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken"))
