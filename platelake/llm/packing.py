"""Vector best-fit packing of token sequences.

Only documents longer than a sequence are cut. A sequence has three capacities: tokens, documents, and attention cost
(the sum of squared lengths). Pieces are placed by falling length; among the sequences whose residual capacities all admit a
piece, the rule picks the one with the least weighted residual norm after placing it (``norm``) or with the greatest weighted dot product of demand and
residual, per unit of residual (``dot``). No fitting sequence opens a new one.

Pieces are dealt evenly, not by key, into groups of about ``GROUP``, and every group is packed by itself in one task: a
group's last sequences are the only loss against packing all at once, below one in a thousand.

Edge cases: NULL and empty texts are one piece with the end id alone; equal rows are packed each; an empty table gives an
empty result; rows without an id keep NULL; further columns are not used. With an attention capacity of at most the square of the
tokens' a piece is cut to the length that it admits.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm import spans, tokens
from platelake.llm.shared import col, stored

GROUP = 20_000
#: A task encodes about so many bytes of text at once.
CHUNK_BYTES = 1 << 20


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most, and how much each residual weighs."""

    tokens: int = 4096
    documents: int = 1024
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    @property
    def longest(self) -> int:
        return max(1, min(self.tokens, math.isqrt(self.attention)))


def best_fit(lengths: np.ndarray, capacity: Capacity) -> np.ndarray:
    """The sequence of each piece; ``lengths`` fall."""
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weights = np.array(capacity.weights)
    where = np.empty(len(lengths), np.int64)
    smallest = float(lengths[-1]) if len(lengths) else 0.0
    # Residuals of the open sequences, in parts of the capacities; those that admit no further piece are dropped.
    left = np.empty((len(lengths), 3))
    name = np.empty(len(lengths), np.int64)
    opened = used = 0
    for i, n in enumerate(lengths.tolist()):
        need = np.array([n, 1, n * n]) / limits
        if n == capacity.tokens:
            where[i] = opened
            opened += 1
            continue
        rest = left[:used] - need
        fits = (rest >= -1e-12).all(1)
        if fits.any():
            if capacity.rule == "norm":
                cost = np.where(fits, (weights * rest * rest).sum(1), np.inf)
            else:
                residual = left[:used]
                cost = np.where(fits, -(weights * need * residual).sum(1) / np.maximum((residual * residual).sum(1), 1e-18), np.inf)
            b = int(cost.argmin())
        else:
            b, used = used, used + 1
            left[b], name[b] = 1.0, opened
            opened += 1
        left[b] -= need
        where[i] = name[b]
        if (left[b] * limits < np.array([smallest, 1, smallest * smallest]) - 1e-6).any():
            used -= 1
            left[b], name[b] = left[used], name[used]
    return where


def _pack_part(capacity: Capacity) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    tokens_most, documents, attention, weights, rule = capacity.tokens, capacity.documents, capacity.attention, capacity.weights, capacity.rule

    @spans.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        falling = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        order = pa.Table.from_batches(held).sort_by(falling)
        length = order.column("length").to_numpy()
        where = best_fit(length, Capacity(tokens_most, documents, attention, weights, rule))
        by = np.argsort(where, kind="stable")
        ends = np.cumsum(length[by])
        begin = np.concatenate([[0], np.flatnonzero(np.diff(where[by])) + 1])
        base = np.repeat((ends - length[by])[begin], np.diff(np.append(begin, len(by))))
        offset = np.empty(len(by), np.int64)
        offset[by] = ends - length[by] - base
        part = TaskContext.get().partitionId()
        out = order.append_column("sequence_id", pa.array((np.int64(part) << 32) + where)).append_column("offset", pa.array(offset))
        yield from out.combine_chunks().to_batches()

    return run


def pieces(docs: DataFrame, path: str, capacity: Capacity, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document, with the ids themselves if asked for."""
    longest = capacity.longest
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    @spans.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, offsets in tokens.encoded(spans.chunked(batches, "text", CHUNK_BYTES), "text", path):
            n = np.diff(offsets)
            cuts = -(-n // longest)
            owner = np.repeat(np.arange(len(n)), cuts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * longest
            length = np.minimum(n[owner] - start, longest)
            flat = ids.astype("<u4")
            begin = offsets[owner] + start
            crc = [zlib.crc32(flat[a : a + m]) for a, m in zip(begin.tolist(), length.tolist())]
            columns = [part.column("doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                at = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def packed(docs: DataFrame, path: str, capacity: Capacity | None = None, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its place there."""
    capacity = capacity or Capacity()
    held = stored(pieces(docs, path, capacity, key, text, with_ids))
    groups = max(1, -(-held.count() // GROUP))
    dealt = held.repartition(groups)
    return dealt.mapInArrow(_pack_part(capacity), dealt.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema)
