"""How document filters interact: what each removes in every order they can be applied in.

The filters, by letter: A too few words, B too few different words, C too many capitals, D marks of markup, E a text that a smaller id
has too (in the whole table, removed or not). The words of all documents form a sparse document-term matrix: a task encodes the
words of a chunk of texts by a dictionary of its own; the chunks' dictionaries meet in parts by the words' hashes, each of which numbers its
different words; with the sizes of the parts before it these are dense numbers of all words, which replace the chunk's own. The matrix is kept as shards in compressed sparse rows (``indptr``,
``indices``, ``counts``); row sums decide A, the numbers of nonzero entries B. The other flags are counted in the same pass and attached.

With the failures of every document known, an order and a step decide what is kept, removed or redundant, so documents are counted by part,
failures and labels once, and these few counts are spread over the orders.

How it scales: chunks, shards and parts of the dictionary are bounded; what is shuffled by word is each chunk's dictionary, in blocks, not the
occurrences; a group of equal texts is counted per task before it meets its least id.

Edge cases: a NULL text is empty; a NULL language is the part ``''``; a NULL id never fails E and is no smaller id; repeated rows are
documents of their own, and as their ids are equal neither makes the other fail E; a document with several labels has each that
one of them has; without documents the result is empty; further columns are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm import spans
from platelake.llm.ordering import PLACE_BITS
from platelake.llm.shared import col, stored

LETTERS = "ABCDE"
MIN_WORDS, MIN_DIFFERENT, MAX_CAPITALS = 200, 50, 3  # words; hundredths; hundredths
MARKS = "#$%&*|"
#: Words, over all chunks, that one part of the dictionary is made from.
SLOT_WORDS = 1 << 20

CAPITAL = np.zeros(256, bool)
CAPITAL[0x41:0x5B] = True
MARK = np.zeros(256, bool)
MARK[[ord(c) for c in MARKS]] = True
#: One byte of each character.
POINT = np.ones(256, bool)
POINT[0x80:0xC0] = False

ABOUT = ("doc_id", "part", "digest", "capitals", "points", "marks")
ABOUT_SCHEMA = "doc_id array<long>, part array<string>, digest array<binary>, capitals array<long>, points array<long>, marks array<boolean>"


def _lists(columns: list[pa.Array], size: int) -> list[pa.Array]:
    """Whole columns, each as the one list of a row."""
    return [pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), c) for c in columns]


def _rows_of(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compressed sparse rows of the texts' word codes: ``indptr, indices, counts``."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    width = int(codes.max()) + 1 if len(codes) else 1
    cells, counts = np.unique(owner * width + codes, return_counts=True)
    indptr = np.searchsorted(cells, np.arange(len(first)) * width)
    return indptr, cells % width, counts


def _bytes(texts: spans.Texts, found: spans.Spans) -> tuple[bytes, bytes]:
    """The spans' bytes one after the other, and their lengths as little-endian 32-bit numbers."""
    ends = np.cumsum(found.length)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(found.start - (ends - found.length), found.length)
    return texts.data[at].tobytes(), found.length.astype("<i4").tobytes()


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, part, digest, text`` to one row a chunk: its documents, their word counts in the chunk's own codes, its words
    by hash, which is the order of the codes."""
    shard = TaskContext.get().partitionId() << PLACE_BITS
    for chunk in spans.chunked(batches, "text"):
        texts = spans.texts_of(chunk.column("text"))
        found = spans.words(texts)
        own, codes = spans.distinct(texts, found)
        data = texts.data[: texts.size]
        flags = [spans.per_text(kind[data], texts.offsets) for kind in (CAPITAL, POINT, MARK)]
        about = [chunk.column("doc_id"), chunk.column("part"), chunk.column("digest"), pa.array(flags[0]), pa.array(flags[1]), pa.array(flags[2] > 0)]
        sparse = [a.astype("<i4").tobytes() for a in _rows_of(codes, found.first)]
        blobs = [pa.array([b], pa.binary()) for b in (*sparse, *_bytes(texts, own))]
        columns = [pa.array([shard]), *_lists(about, chunk.num_rows), *blobs, pa.array([len(own.start)])]
        yield pa.RecordBatch.from_arrays(columns, ["shard", *ABOUT, "indptr", "codes", "counts", "words", "lengths", "n_words"])
        shard += 1


def _slicer(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``shard, words, lengths`` to a row for each part of the dictionary (the first ``bits`` of a word's hash) that the shard has words of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, words, lengths in zip(*(batch.column(c).to_pylist() for c in ("shard", "words", "lengths"))):
                length = np.frombuffer(lengths, "<i4").astype(np.int64)
                ends = np.cumsum(length)
                data = np.frombuffer(words + bytes(8), np.uint8)
                h = spans.hashes(data, spans.Spans(ends - length, length, np.array([0, len(length)])))
                slot = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
                begin = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
                to = np.append(begin[1:], len(slot))
                at = np.append(0, ends)
                parts = [words[at[i] : at[j]] for i, j in zip(begin, to)]
                sizes = [lengths[4 * i : 4 * j] for i, j in zip(begin, to)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot[begin]), pa.array([shard] * len(begin), pa.int64()), pa.array(parts, pa.binary()), pa.array(sizes, pa.binary())],
                    ["slot", "shard", "words", "lengths"],
                )

    return run


def _words(words: list[bytes], lengths: list[bytes]) -> pa.Array:
    offsets = np.append(0, np.cumsum(np.frombuffer(b"".join(lengths), "<i4").astype(np.int64)))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(words))])


NUMBERED = "slot long, shard long, numbers binary, words binary, lengths binary, n long"


def _numbered(table: pa.Table) -> pa.Table:
    """One part of the dictionary: its different words (a row without a shard), and for each shard the numbers of its words among them."""
    table = table.sort_by("shard")
    slot, lengths = table.column("slot")[0].as_py(), table.column("lengths").to_pylist()
    found = _words(table.column("words").to_pylist(), lengths).dictionary_encode()
    number = found.indices.to_numpy().astype("<i4").tobytes()
    ends = np.cumsum([len(n) for n in lengths])
    own = found.dictionary
    size = np.diff(np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1])
    spoken = b"".join(own.to_pylist())
    rows = [(slot, s, number[e - len(n) : e], None, None, None) for s, n, e in zip(table.column("shard").to_pylist(), lengths, ends)]
    rows.append((slot, None, None, spoken, size.astype("<i4").tobytes(), len(own)))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["slot", "shard", "numbers", "words", "lengths", "n"])


def _recoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces a shard's codes by the global numbers of its words; they rise within each row."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            pieces = sorted(row.column("pieces")[0].as_py() or [], key=lambda p: p["slot"])
            number = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(p["numbers"], "<i4") + np.int64(p["before"]) for p in pieces]])
            indptr, codes, counts = (np.frombuffer(row.column(c)[0].as_py(), "<i4") for c in ("indptr", "codes", "counts"))
            indices = number[codes]
            order = np.lexsort((indices, np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))))
            blobs = [pa.array([a[order].tobytes()], pa.binary()) for a in (indices.astype("<i8"), counts)]
            yield pa.RecordBatch.from_arrays([*(row.column(c) for c in ("shard", *ABOUT, "indptr")), *blobs], ["shard", *ABOUT, "indptr", "indices", "counts"])


def _spoken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words, lengths, before in zip(*(batch.column(c).to_pylist() for c in ("words", "lengths", "before"))):
            found = _words([words], [lengths])
            yield pa.RecordBatch.from_arrays([found.cast(pa.binary()), pa.array(np.arange(len(found)) + before)], ["word", "term"])


def matrix(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> tuple[DataFrame, DataFrame]:
    """The document-term matrix: shards ``shard, <documents>, indptr, indices, counts``, and the dictionary ``word, term``.

    ``indptr`` and ``counts`` are little-endian 32-bit, ``indices`` 64-bit numbers; ``term`` counts from 0.
    """
    body = F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
    rows = docs.select(col(key).cast("long").alias("doc_id"), F.coalesce(col(part).cast("string"), F.lit("")).alias("part"), body)
    schema = f"shard long, {ABOUT_SCHEMA}, indptr binary, codes binary, counts binary, words binary, lengths binary, n_words long"
    shards = stored(rows.select("doc_id", "part", F.unhex(F.md5("text")).alias("digest"), "text").mapInArrow(_sharded, schema))
    # The dictionary in parts by hash, so that each fits a task whatever the corpus.
    total = shards.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    sliced = shards.select("shard", "words", "lengths").mapInArrow(_slicer((total // SLOT_WORDS).bit_length()), "slot long, shard long, words binary, lengths binary")
    pieces = stored(sliced.groupBy("slot").applyInArrow(_numbered, NUMBERED))
    earlier = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part of the dictionary
    begins = stored(pieces.filter("shard is null").select("slot", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    placed = pieces.join(begins, "slot")
    numbers = placed.filter("shard is not null").groupBy("shard").agg(F.collect_list(F.struct("slot", "before", "numbers")).alias("pieces"))
    joined = shards.drop("words", "lengths", "n_words").join(numbers, "shard", "left")
    schema = f"shard long, {ABOUT_SCHEMA}, indptr binary, indices binary, counts binary"
    dictionary = placed.filter("shard is null").select("words", "lengths", "before").mapInArrow(_spoken, "word binary, term long")
    return stored(joined.mapInArrow(_recoded, schema)), dictionary


def _failing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards to ``doc_id, part, digest, fails``: the letters of A to D that each document fails."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            indptr, counts = (np.frombuffer(row.column(c)[0].as_py(), "<i4").astype(np.int64) for c in ("indptr", "counts"))
            n_words, n_different = spans.per_text(counts, indptr), np.diff(indptr)
            about = {c: row.column(c)[0].values for c in ABOUT}
            capitals, points = about["capitals"].to_numpy(), about["points"].to_numpy()
            failed = [
                n_words < MIN_WORDS,
                100 * n_different < MIN_DIFFERENT * n_words,
                100 * capitals > MAX_CAPITALS * points,
                about["marks"].to_numpy(zero_copy_only=False),
            ]
            fails = np.full(len(n_words), "", "U4")
            for letter, flag in zip(LETTERS, failed):
                fails = np.char.add(fails, np.where(flag, letter, ""))
            yield pa.RecordBatch.from_arrays([about["doc_id"], about["part"], about["digest"], pa.array(fails.tolist(), pa.string())], ["doc_id", "part", "digest", "fails"])


def failures(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part, fails, n, n_good, n_toxic``: documents by the filters they fail."""
    shards, _ = matrix(docs, key, text, part)
    marked = stored(shards.mapInArrow(_failing, "doc_id long, part string, digest binary, fails string"))
    label = labels.groupBy(F.col("doc_id").alias("labelled")).agg(F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    joined = marked.join(label, F.col("doc_id") == F.col("labelled"), "left")
    groups = ("digest", "part", "fails", "good", "toxic")
    flagged = joined.select("doc_id", "digest", "part", "fails", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    # A text's rows by id first, so that its least id has the number of its rows; then by label and part.
    by_id = flagged.groupBy(*groups, "doc_id").agg(F.count("*").alias("n"))
    lowest = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    unnamed = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(F.lit(0)))
    by_text = by_id.groupBy(*groups).agg(F.sum("n").alias("n"), lowest.alias("lowest"), unnamed.alias("unnamed"))
    least = F.min("lowest.doc_id").over(Window.partitionBy("digest"))  # at most a row for each part and label
    holds_least = F.col("lowest.doc_id") == least
    firsts = F.col("unnamed") + F.when(holds_least, F.col("lowest.n")).otherwise(F.lit(0))
    split = by_text.withColumn("firsts", firsts).select(*groups, F.explode(F.array(F.struct(F.lit("").alias("e"), F.col("firsts").alias("n")), F.struct(F.lit("E").alias("e"), (F.col("n") - F.col("firsts")).alias("n")))).alias("s"))
    n = F.col("s.n")
    counts = [F.sum(n).alias("n"), F.sum(F.when(F.col("good"), n).otherwise(F.lit(0))).alias("n_good"), F.sum(F.when(F.col("toxic"), n).otherwise(F.lit(0))).alias("n_toxic")]
    return split.groupBy("part", F.concat("fails", "s.e").alias("fails")).agg(*counts)


def interactions(found: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` from ``failures``."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    rows = found.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    before = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    failed = F.contains(F.col("fails"), letter)
    earlier = F.length(F.call_function("translate", before, F.col("fails"), F.lit(""))) < F.col("step") - 1
    here = failed & ~earlier

    def total(condition, value="n"):
        return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0))).cast("long")

    counts = {
        "kept": total(~failed & ~earlier),
        "removed": total(here),
        "redundant": total(failed & earlier),
        "unique_fails": total(F.col("fails") == letter),
        "good_lost": total(here, "n_good"),
        "toxic_lost": total(here, "n_toxic"),
    }
    by_step = rows.groupBy("part", "filter_order", "step").agg(*[c.alias(n) for n, c in counts.items()])
    in_all = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))  # one row an order
    return by_step.withColumn("shapley", F.sum("removed").over(in_all))


def audited(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """What each filter removes, by part, order and step; zeros are listed."""
    return interactions(failures(docs, labels, key, text, part))
