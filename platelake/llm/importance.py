"""Importance resampling towards a target text collection, by hashed n-grams.

Words are runs of ASCII letters and digits (A-Z as a-z) and all characters beyond ASCII; features are the runs of one to three words,
joined by a space; a feature's bucket is the CRC-32 of its bytes modulo ``BUCKETS``. A bucket's gain compares its share in the target with
its share in the documents; a document's weight is the sum of the gains of its features, and Gumbel noise by a hash of its id
makes the draw of the highest scores a sample without replacement.

The texts of a batch are joined with a sentinel that no word can hold, and one regular expression pass splits them all
into words and gaps. The gaps' and words' lengths give each word's place, a binary search in the texts' offsets its text, and
n-grams that would cross two texts are masked before they are counted. Each distinct word's CRC is computed once; that of
an n-gram follows from its words' by arithmetic, as CRC-32 is linear.

How it scales: a task sends its counts of buckets, at most ``BUCKETS`` rows; gains are ``BUCKETS`` numbers, whatever the corpus.
Texts are read twice and never shuffled. Ranks come from a sort over ranges of ids and scores alone.

Edge cases: a NULL or empty text has no features and the weight 0; a very long text is split into words in blocks; a NULL id
draws its noise as the empty id and comes last among ties; repeated rows are documents of their own; without documents the result is empty; an
empty target has gains like any other; further columns are not used.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm import spans
from platelake.llm.ordering import numbered
from platelake.llm.shared import col, stored, unused

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
SHARE = 5  # of a hundred
SEED = 42

#: With a group, so that a split returns gaps and words in turn; texts are in small letters by then.
WORD = re.compile(rb"([0-9a-z\x80-\xff]+)")
NO_WORD = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
SENTINEL = b"\x00"
BLOCK_BYTES = 1 << 20
#: Distinct words that a task remembers before it starts anew.
REMEMBERED = 500_000

POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected
NEAR = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


class Shift:
    """CRCs of texts after some bytes are put behind them, as far as these bytes' number decides.

    For up to ``NEAR`` bytes there is a table of each number; longer distances are made of powers of two.
    """

    def __init__(self) -> None:
        byte = _byte_table()
        values = np.arange(256, dtype=np.uint32)
        tables = [np.stack([values << np.uint32(8 * j) for j in range(4)])]
        for _ in range(NEAR):
            last = tables[-1]
            tables.append((last >> np.uint32(8)) ^ byte[last & np.uint32(0xFF)])
        self.near = np.stack(tables).reshape(-1)
        self.doubled = [tables[NEAR]]

    @staticmethod
    def _apply(table: np.ndarray, base: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
        found = table[base + (crc & np.uint32(0xFF))]
        for j in (1, 2, 3):
            found ^= table[base + 256 * j + ((crc >> np.uint32(8 * j)) & np.uint32(0xFF))]
        return found

    def __call__(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        found = self._apply(self.near, (length % NEAR) * 1024, crc)
        far = length // NEAR
        level = 0
        while len(far) and (far >> level).any():
            if level == len(self.doubled):
                half = self.doubled[-1]
                self.doubled.append(self._apply(half.reshape(-1), 0, half))
            rows = np.flatnonzero((far >> level) & 1)
            found[rows] = self._apply(self.doubled[level].reshape(-1), 0, found[rows])
            level += 1
        return found


class Words(dict):
    """Distinct words to numbers, with their CRC alone, their CRC behind a space, and their length with that space."""

    def __init__(self) -> None:
        super().__init__()
        self.alone, self.behind, self.length = array("I"), array("I"), array("q")

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.alone.append(zlib.crc32(word))
        self.behind.append(zlib.crc32(b" " + word))
        self.length.append(len(word) + 1)
        return number


class Reader:
    """The features of batches of texts, remembering words between batches."""

    def __init__(self) -> None:
        self.shift, self.words = Shift(), Words()

    def _block(self, block: bytes) -> tuple[np.ndarray, ...]:
        """Place, CRC alone, CRC behind a space, and length with the space of each word."""
        pieces = WORD.split(block.lower())
        if len(self.words) > REMEMBERED:
            self.words = Words()
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        n = len(pieces) // 2
        number = np.fromiter(map(self.words.__getitem__, pieces[1::2]), np.int64, n)
        alone, behind, length = (np.frombuffer(a, t)[number] for a, t in ((self.words.alone, np.uint32), (self.words.behind, np.uint32), (self.words.length, np.int64)))
        return ends[0::2][:n], alone, behind, length

    def found(self, column: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """For each word its text, and for one to three words: where they begin in one text, and their bucket."""
        texts = [t or b"" for t in pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()]
        joined = SENTINEL.join(texts)
        offsets = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        kept, at = [], 0
        while at < len(joined):
            cut = NO_WORD.search(joined, min(at + BLOCK_BYTES, len(joined)))
            to = cut.end() if cut else len(joined)
            place, *rest = self._block(joined[at:to])
            kept.append((place + at, *rest))
            at = to
        if not kept:
            kept = [self._block(b"")]
        place, alone, behind, length = (np.concatenate(c) for c in zip(*kept))
        owner = np.searchsorted(offsets, place, "right")
        grams, crc = [(np.arange(len(owner)), alone % BUCKETS)], alone
        for n in range(1, LONGEST):
            crc = self.shift(crc[: len(crc) - 1], length[n:]) ^ behind[n:] if len(crc) > 1 else crc[:0]
            inside = np.flatnonzero(owner[: len(crc)] == owner[n : n + len(crc)])
            grams.append((inside, crc[inside] % BUCKETS))
        return owner, grams


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's features by bucket."""
    reader, total = Reader(), np.zeros(BUCKETS, np.int64)
    for part in spans.chunked(batches, "text"):
        for _, bucket in reader.found(part.column("text"))[1]:
            total += np.bincount(bucket, minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])


def bucket_counts(docs: DataFrame, text: str = "text") -> list[int]:
    """Features of all texts by bucket."""
    counted = docs.select(col(text).cast("string").alias("text")).mapInArrow(_counted, "bucket int, n long")
    counts = [0] * BUCKETS
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: list[int], target: list[int]) -> list[int]:
    """Each bucket's gain, in thousandths of a natural logarithm."""
    s_all, t_all = float(sum(source) + BUCKETS), float(sum(target) + BUCKETS)
    return [math.floor(1000.0 * math.log(((t + 1.0) * s_all) / ((s + 1.0) * t_all))) for s, t in zip(source, target)]


def scores(docs: DataFrame, gain: list[int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight``."""
    values = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for part in spans.chunked(batches, "text"):
            owner, grams = reader.found(part.column("text"))
            first = np.searchsorted(owner, np.arange(part.num_rows + 1))
            words = np.diff(first)
            features = sum(np.maximum(words - n, 0) for n in range(LONGEST))
            total = np.zeros(len(owner), np.int64)
            for begin, bucket in grams:
                total[begin] += values[bucket]
            columns = [part.column("doc_id"), pa.array(words), pa.array(features), pa.array(spans.per_text(total, first))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``: of the documents with ``min_words`` the ``share`` hundredths with the
    highest scores are ranked from 1; ``rank`` is NULL for those not drawn."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, text))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    # Written before it is sorted, as a sort reads its rows twice.
    found = stored(scores(docs, gain, key, text).withColumn("score", F.col("weight") + noise))
    may = F.col("n_words") >= min_words
    placed = numbered(found, may.desc(), F.desc("score"), F.asc_nulls_last("doc_id"), name="place")
    drawn = placed.filter(may).count() * share // 100
    rank = F.when(may & (F.col("place") <= drawn), F.col("place"))
    return placed.withColumn("rank", rank).drop("place")


def keep_drawn(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents that ``resampled`` drew, with all their columns. Rows of one id are drawn together."""
    name = unused(docs, "drawn_id")
    ids = stored(found.filter("rank is not null").select(F.col("doc_id").alias(name)).distinct())
    return docs.join(ids, col(key).cast("long") == col(name), "left_semi")
