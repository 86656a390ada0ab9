"""Benchmark items inside documents, found by size-partitioned MinHash containment search. DataFrame functions only.

Containment is a share of the item, however long the document, so the item is sampled and the document looked through: an
item's sketch is the least hashes of its five-word shingles, and a document is a candidate if it holds enough of
them. An item of one to four words is one run of so many words, looked up whole. Items are partitioned by size: class ``c`` has
the items of 2^c to 2^(c+1) - 1 shingles. Each class has its own sketch size, which grows with the class, and from it the matches that
a document needs: an item that fits its sketch needs ``CONTAINED`` of it; of a larger one so many are needed that a document with a
containment of ``CONTAINED`` or more is missed with a probability below ``MISS``. A hash is looked up only in documents that are long
enough for the smallest class that has it. Candidates are verified by exact containment of the shingles themselves.

Documents are never shuffled by shingle: sketches are sent to them in blocks of at most ``BLOCK`` hashes, one pass over the
documents for each block, so a broadcast never grows with the benchmark. Only matches are shuffled. Runs of one to four words
are made only for the lengths that the benchmark has.

Edge cases: texts are compared in small letters, words lie between ASCII white space; an item without a word is found nowhere;
NULL texts hold no item; rows without an id are not searched; equal rows, and
rows of one id, give one pair; empty tables give an empty result; further columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm.shared import col, stored, unused

SHINGLE = 5
CONTAINED = 0.8
#: Sketch of an item of up to this many shingles: all of them; larger classes take ``STEP`` more each.
SKETCH, STEP = 16, 8
CLASSES = 32
MISS = 1e-6
BLOCK = 2_000_000

WHITE = " \t\n\x0b\x0c\r"


def needed_matches(size: int, sketch: int = SKETCH, contained: float = CONTAINED, miss: float = MISS) -> int:
    """Matches that a document needs for an item of ``size`` shingles."""
    if size <= sketch:
        return max(1, math.ceil(contained * size - 1e-9))
    # Sampling without replacement spreads less than this.
    below, found = 0.0, 1
    for k in range(sketch):
        below += math.comb(sketch, k) * contained**k * (1 - contained) ** (sketch - k)
        if below > miss:
            break
        found = k + 1
    return found


def sketch_size(size_class: int) -> int:
    """Hashes that an item of 2^``size_class`` shingles or more gives, if it has so many."""
    return SKETCH + STEP * max(0, size_class - SKETCH.bit_length() + 1)


def word_list(text: Column) -> Column:
    return F.split(F.btrim(F.lower(text), F.lit(WHITE)), r"[\x20\x09-\x0D]+")


def _windows(words: Column, of: Callable[[list[Column]], Column], length: int = SHINGLE) -> Column:
    """``of`` the words at each place where a run of ``length`` words begins."""
    places = F.sequence(F.lit(0), F.size(words) - length)
    return F.when(F.size(words) >= length, F.transform(places, lambda i: of([F.get(words, i + j) for j in range(length)])))


def _hashed(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def _joined(words: list[Column]) -> Column:
    return F.concat_ws(" ", *words)


def _of_item(words: Column, of: Callable[[list[Column]], Column]) -> Column:
    """The different shingles of an item; of a short one its only run."""
    grams = _windows(words, of)
    for length in range(1, SHINGLE):
        grams = F.when(F.size(words) == length, _windows(words, of, length)).otherwise(grams)
    return F.array_distinct(grams)


def _of_document(words: Column, of: Callable[[list[Column]], Column], short: list[int]) -> Column:
    """All shingles of a document, and its runs of the ``short`` lengths."""
    runs = [_windows(words, of, length) for length in (SHINGLE, *short)]
    return runs[0] if len(runs) == 1 else F.flatten(F.array_compact(F.array(*runs)))


def short_lengths(items: DataFrame) -> list[int]:
    """The lengths of one to four words that items have."""
    return sorted(r["length"] for r in items.select(F.size("words").alias("length")).filter(F.col("length") < SHINGLE).distinct().collect())


def item_sketches(items: DataFrame) -> DataFrame:
    """``item, n, size_class, need, hash``: the least hashes of each item with the matches that its size needs."""
    hashes = items.select("item", _of_item(F.col("words"), _hashed).alias("hashes")).filter("hashes is not null")
    n = F.size("hashes")
    sized = hashes.select("item", "hashes", n.alias("n"), (F.length(F.bin(n)) - 1).alias("size_class"))
    sizes = [sketch_size(c) for c in range(CLASSES)]
    # Needed matches by the size of a sketch that holds the whole item, and by class of one that is a sample.
    whole = F.array(*[F.lit(needed_matches(k, k)) for k in range(1, sizes[-1] + 1)])
    sampled = F.array(*[F.lit(needed_matches(k + 1, k)) for k in sizes])
    size = F.get(F.array(*map(F.lit, sizes)), F.col("size_class"))
    need = F.when(F.col("n") > size, F.get(sampled, F.col("size_class"))).otherwise(F.get(whole, F.col("n") - 1))
    # Spread again, so that the least are a sample.
    spread = F.transform("hashes", lambda h: F.struct(F.xxhash64(h, F.lit(1)).alias("order"), h.alias("hash")))
    least = F.slice(F.array_sort(spread), F.lit(1), size)
    return sized.select("item", "n", "size_class", need.alias("need"), F.explode(least).alias("s")).select("item", "n", "size_class", "need", "s.hash")


def candidates(docs: DataFrame, sketches: DataFrame, short: list[int]) -> DataFrame:
    """``doc_id, item`` of documents that hold enough of an item's sketch. ``docs``: ``doc_id, words``; ``short``: lengths of short items."""
    # A document with fewer shingles than CONTAINED of an item cannot hold it; a short item is a single run.
    room = F.greatest(F.col("n_words") - (SHINGLE - 1), F.lit(1))
    blocks = max(1, -(-sketches.count() // BLOCK))
    found = None
    for block in range(blocks):
        part = sketches if blocks == 1 else sketches.filter(F.pmod("hash", F.lit(blocks)) == block)
        keys = part.groupBy("hash").agg(F.min("size_class").alias("smallest"))
        grams = docs.select("doc_id", F.size("words").alias("n_words"), F.explode(_of_document(F.col("words"), _hashed, short)).alias("hash"))
        # At most BLOCK hashes.
        hits = grams.join(F.broadcast(keys), "hash").filter(room >= CONTAINED * F.pow(F.lit(2.0), "smallest")).drop("smallest")
        found = hits if found is None else found.union(hits)
    seen = found.groupBy("doc_id", "hash").agg(F.max("n_words").alias("n_words"))
    counted = seen.join(sketches, "hash").groupBy("doc_id", "item").agg(
        F.count("*").alias("matches"), F.max("need").alias("need"), F.max("n").alias("n"), F.max("n_words").alias("n_words")
    )
    return counted.filter((F.col("matches") >= F.col("need")) & (room >= CONTAINED * F.col("n"))).select("doc_id", "item")


def contained_items(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` of every item of which a document holds ``CONTAINED`` or more."""
    texts = benchmark.select("item_id", "text").filter((F.col("item_id").isNotNull()) & (F.btrim("text", F.lit(WHITE)) != "")).dropDuplicates()
    items = texts.select("item_id", F.xxhash64("item_id", "text").alias("item"), word_list(F.col("text")).alias("words"))
    sketches, short = stored(item_sketches(items)), short_lengths(items)
    rows = docs.select(col(key).alias("doc_id"), col(text).cast("string").alias("text")).filter("doc_id is not null and text is not null")
    worded = rows.select("doc_id", word_list(F.col("text")).alias("words"))
    pairs = stored(candidates(worded, sketches, short))
    grams_of_item = items.select("item", "item_id", _of_item(F.col("words"), _joined).alias("item_grams"))
    grams_of_doc = rows.join(pairs.select("doc_id").distinct(), "doc_id").select("doc_id", word_list(F.col("text")).alias("words"))
    grams_of_doc = grams_of_doc.select("doc_id", F.array_distinct(_of_document(F.col("words"), _joined, short)).alias("doc_grams"))
    joined = grams_of_doc.join(pairs, "doc_id").join(grams_of_item, "item")
    shared = joined.select("doc_id", "item_id", F.size(F.array_intersect("doc_grams", "item_grams")).alias("n_shared"), F.size("item_grams").alias("n_item"))
    best = shared.filter(F.col("n_shared") >= CONTAINED * F.col("n_item")).withColumn("containment", F.col("n_shared") / F.col("n_item"))
    most = best.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_shared", "n_item")).alias("m"))
    return most.select("doc_id", "item_id", F.col("m.n_shared").cast("long").alias("n_shared"), F.col("m.n_item").cast("long").alias("n_item"), "m.containment")


def keep_unseen(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = SHINGLE) -> DataFrame:
    """The documents that hold no benchmark item of ``least_words`` words or more; a shorter one may be any common word, which is no
    sign of a leak."""
    name = unused(docs, "leaked_id")
    telling = benchmark.filter(F.size(word_list(F.col("text"))) >= least_words)
    leaked = stored(contained_items(docs, telling, key, text).select(F.col("doc_id").alias(name)).distinct())
    return docs.join(leaked, col(key) == col(name), "left_anti")
