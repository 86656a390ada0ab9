"""Token files of fixed-width packed ids.

An image is one file: a header (magic, bits per id, numbers of documents, ids and blocks), the document ids, the offset of
each document among the ids, the byte offset of each block, and the blocks. A block holds up to ``BLOCK`` ids in groups of
64, each group in as many 64-bit little-endian words as an id has bits, so that lane ``j`` of every group lies at the same place and a
block is packed and unpacked by 64 vector operations. An id takes the bits that the vocabulary needs. ``ids_between``
reads any range from the blocks that it touches.

Documents lie in ascending order of their id. Images of about ``IMAGE_IDS`` ids are rows of a Parquet table, as only Spark's
writers reach every store; each knows its part and its place in it, and the table of part totals (one row for each part)
turns places into places in the whole.

Edge cases: NULL and empty texts hold the end id alone; rows without an id come first; rows of one id follow each other
in the order of a hash of their text; a text longer than an image gets a larger image; an empty table gives no image; an id that
needs more bits is an error; further columns are not used.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm import tokens
from platelake.llm.shared import col, stored

BLOCK = 1 << 16
IMAGE_IDS = 1 << 20
LANES = 64
MAGIC = b"BPI1"
HEADER = "<4sB3xQQQ"
IMAGES = "part int, seq int, start long, n_ids long, n_docs long, image binary"


def bits_for(vocabulary: int) -> int:
    """The least bits that hold the ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in groups of 64; the last group is filled up with zeros."""
    groups = -(-len(ids) // LANES)
    lanes = np.zeros((groups, LANES), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.T)
    words = np.zeros((bits, groups), np.uint64)
    for j in range(LANES):
        word, shift = divmod(j * bits, 64)
        words[word] |= lanes[j] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= lanes[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed groups."""
    words = np.ascontiguousarray(np.frombuffer(data, "<u8").reshape(-1, bits).T)
    lanes = np.empty((LANES, words.shape[1]), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(LANES):
        word, shift = divmod(j * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        lanes[j] = value & mask
    return lanes.T.reshape(-1)[:n]


def to_image(doc_ids: np.ndarray, offsets: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
    blocks = [pack(ids[a : a + BLOCK], bits) for a in range(0, len(ids), BLOCK)]
    ends = np.cumsum([0, *map(len, blocks)])
    head = struct.pack(HEADER, MAGIC, bits, len(doc_ids), len(ids), len(blocks))
    tables = (doc_ids.astype("<i8"), offsets.astype("<u8"), ends.astype("<u8"))
    return b"".join([head, *(t.tobytes() for t in tables), *blocks])


class Image:
    """Random access to an image."""

    def __init__(self, data: bytes) -> None:
        magic, self.bits, docs, self.n_ids, blocks = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not an image of packed ids")
        at = struct.calcsize(HEADER)
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.offsets = np.frombuffer(data, "<u8", docs + 1, at + 8 * docs).astype(np.int64)
        self.blocks = np.frombuffer(data, "<u8", blocks + 1, at + 16 * docs + 8).astype(np.int64)
        self.payload = memoryview(data)[at + 16 * docs + 16 + 8 * blocks :]

    def ids_between(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the image, from the blocks that hold them."""
        start, stop = max(start, 0), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        found = [
            unpack(self.payload[self.blocks[b] : self.blocks[b + 1]], self.bits, min(BLOCK, self.n_ids - b * BLOCK))
            for b in range(first, last + 1)
        ]
        return np.concatenate(found)[start - first * BLOCK : stop - first * BLOCK]


def written(docs: DataFrame, path: str, vocabulary: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The images of all documents, written to the shared folder and read back as a table of ``IMAGES``."""
    bits = bits_for(vocabulary)
    rows = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    # The hash parts the rows of one id, so that many of them lie in several tasks.
    in_order = ("doc_id", F.xxhash64("text"))
    ranged = rows.repartitionByRange(*in_order).sortWithinPartitions(*in_order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def image() -> pa.RecordBatch:
            doc_ids = np.concatenate([d for d, _, _ in held])
            ids = np.concatenate([i for _, i, _ in held])
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([n for _, _, n in held]))])
            row = [part, seq, start, len(ids), len(doc_ids), to_image(doc_ids, offsets, ids, bits)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for piece, ids, offsets in tokens.encoded(batches, "text", path):
            doc_ids = piece.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            held.append((doc_ids, ids, np.diff(offsets)))
            if sum(len(i) for _, i, _ in held) >= IMAGE_IDS:
                out = image()
                yield out
                seq, start, held = seq + 1, start + out.column("n_ids")[0].as_py(), []
        if held:
            yield image()

    types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["part", "seq", "start", "n_ids", "n_docs", "image"]
    return stored(ranged.mapInArrow(run, IMAGES))


#: Stands for a missing document id in an image.
NO_ID = -(1 << 63)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, data in zip(batch.column("base").to_pylist(), batch.column("image")):
            image = Image(data.as_py())
            ids = image.ids_between(0, image.n_ids).astype("<u4")
            at = image.offsets
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
            doc_ids = pa.array(image.doc_ids, mask=image.doc_ids == NO_ID)
            columns = [doc_ids, pa.array(base + at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(images: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the images alone."""
    totals = images.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row for each part, so the running total needs no more than one task.
    bases = stored(totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))
    placed = images.join(bases, "part").select((F.col("before") + F.col("start")).alias("base"), "image")
    return placed.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
