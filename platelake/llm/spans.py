"""Words, units, lines and n-grams of whole texts, found over a batch at a time.

Texts stay UTF-8 bytes in one buffer; a word is a start and a length in it. Spans are compared by 64-bit hashes: two
different words of one batch (some million) meet with a probability below 1e-6.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 4 << 20
LONG_SPAN = 512

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Byte classes for units: 0 space, 1 letter, 2 mark, 3 digit, 4 unclear (it stays joined to both neighbours).
UNIT_CLASS = np.full(256, 2, np.uint8)
UNIT_CLASS[SPACE] = 0
UNIT_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
UNIT_CLASS[0x30:0x3A] = 3
UNIT_CLASS[0x80:] = 4
UNIT_CLASS[[ord("'"), ord("<"), ord("|")]] = 4

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MASK = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], np.uint64)


@dataclass
class Texts:
    """UTF-8 bytes of several texts, eight zero bytes after the last, and the offsets of each."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return len(self.data) - 8

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Spans:
    """Spans in reading order; those of text i are ``first[i]:first[i + 1]``."""

    start: np.ndarray
    length: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def texts_of(column: pa.Array) -> Texts:
    """The texts of an Arrow column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return Texts(np.zeros(8, np.uint8), np.zeros(len(column) + 1, np.int64))
    raw = np.zeros(int(ends[-1] - ends[0]) + 8, np.uint8)
    raw[:-8] = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return Texts(raw, ends - ends[0])


def chunked(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text each; a longer text has a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def give_back() -> None:
    """Memory that this process has freed goes back to the system (Arrow's, and the C library's where it is asked to: glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which gives its memory back when a task ends: Spark keeps idle workers, whose freed memory would
    otherwise stay taken beside what later stages need."""
    @wraps(run)
    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return outer


def _runs(texts: Texts, inside: np.ndarray, start: np.ndarray | None = None) -> Spans:
    """Runs of ``inside`` bytes that end with their text; ``start`` marks further beginnings."""
    n = texts.size
    begins = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    before = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
        before[begins] = False
    first = inside & ~before
    if start is not None:
        first |= inside & start
    starts = np.flatnonzero(first)
    # A run ends where the next byte is outside, begins a text, or begins another run.
    after = np.ones(n + 1, bool)
    after[:n] = ~inside | first
    stops = np.flatnonzero(after)
    ends = stops[np.searchsorted(stops, starts, "right")]
    return Spans(starts, ends - starts, np.searchsorted(starts, texts.offsets))


def words(texts: Texts) -> Spans:
    """Runs of bytes other than ASCII white space."""
    return _runs(texts, ~SPACE[texts.data[: texts.size]])


def lines(texts: Texts) -> Spans:
    """Parts between line feeds, without empty ones."""
    return _runs(texts, texts.data[: texts.size] != 0x0A)


def units(texts: Texts) -> Spans:
    """Runs of letters, runs of marks and single digits; bytes of unclear class keep their neighbours joined.

    A boundary is only set where every reader of Unicode sees one, so a unit can be encoded without its surroundings.
    """
    data = texts.data[: texts.size]
    kind = UNIT_CLASS[data]
    lead = np.flatnonzero(data == 0xC3)  # two-byte Latin letters, but for the signs for times and division
    second = texts.data[lead + 1]
    lead = lead[(second != 0x97) & (second != 0xB7) & (second >= 0x80)]
    kind[lead] = 1
    kind[lead + 1] = 1
    start = np.zeros(len(data), bool)
    if len(data):
        left, right = kind[:-1], kind[1:]
        start[1:] = ((left != right) | (right == 3)) & (left != 4) & (right != 4)
    return _runs(texts, kind != 0, start)


def mix(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * _M2
    h = h ^ (h >> np.uint64(29))
    h = h * _M1
    return h ^ (h >> np.uint64(32))


def hashes(data: np.ndarray, spans: Spans, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span's bytes. ``data`` ends with eight spare bytes."""
    start, length = spans.start, spans.length
    loads = np.ndarray((len(data) - 7,), np.dtype("<u8"), data, strides=(1,))
    with np.errstate(over="ignore"):
        h = np.full(len(start), seed, np.uint64) ^ (length.astype(np.uint64) * _M2)
        rows: np.ndarray | slice = slice(None)
        short = length <= LONG_SPAN
        at, left = start, length
        step = 0
        while len(at):
            value = loads[at] & _MASK[np.minimum(left, 8)]
            part = (h[rows] ^ value) * _M1
            h[rows] = part ^ (part >> np.uint64(31))
            step += 8
            rows = np.flatnonzero(short & (length > step))
            at, left = start[rows] + step, length[rows] - step
        for i in np.flatnonzero(~short):
            h[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + length[i]].data, seed)
        return mix(h)


def ngrams(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` spans that lie in one text, the span each begins with, and the text of each."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=starts[1:])
    at = np.arange(starts[-1]) - starts[owner] + first[owner]
    with np.errstate(over="ignore"):
        g = np.zeros(len(at), np.uint64)
        for j in range(n):
            g = (g ^ h[at + j]) * _M1
            g ^= g >> np.uint64(31)
    return g, at, owner


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def lettered(texts: Texts) -> tuple[Spans, np.ndarray]:
    """Units that have a letter or a byte of unclear class, in small letters; which texts certainly have a letter."""
    texts.data = LOWER[texts.data]
    found = units(texts)
    kind = UNIT_CLASS[texts.data[: texts.size]]
    ends = np.stack([found.start, found.start + found.length], 1)
    unclear = np.concatenate([[0], np.cumsum((kind == 1) | (kind == 4))])
    keep = unclear[ends[:, 1]] > unclear[ends[:, 0]]
    first = np.concatenate([[0], np.cumsum(keep)])[found.first]
    sure = per_text(kind == 1, texts.offsets) > 0
    return Spans(found.start[keep], found.length[keep], first), sure


def distinct(texts: Texts, found: Spans) -> tuple[Spans, np.ndarray]:
    """One span of each different content, and for every span which of them it is."""
    _, first, inverse = np.unique(hashes(texts.data, found), return_index=True, return_inverse=True)
    return Spans(found.start[first], found.length[first], np.array([0, len(first)])), inverse
