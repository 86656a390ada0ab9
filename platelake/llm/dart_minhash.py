"""Near-duplicate documents by DartMinHash signatures of weighted word shingles.

The elements of a text are its runs of five words (small ASCII letters; a shorter text is one run), weighted by how often
each occurs. Over every unit of weight of an element a Poisson stream of darts arrives, the same in every text: each dart
has a rank (its time of arrival), a weight coordinate within the unit, and a signature coordinate, all by hash. A text owns the darts
that lie within its weights; its signature keeps the earliest dart of each of ``COORDINATES`` coordinates. Two
signatures agree in a coordinate with a probability equal to the weighted Jaccard similarity. Only darts earlier than about
``ln k + 2`` expected ones per coordinate are thrown, so a text costs its words plus O(k log k) darts instead of k hashes a word;
where a coordinate stays empty the time is doubled.

Bands of ``ROWS`` coordinates join texts with an equal band. Equal texts are first reduced to one, so a group of copies
never meets itself. In every bucket the texts meet its ``HEADS`` heads, those that share the most buckets with others: of a group of near
copies that is their origin, which is like all of them when they are not like each other. Each text is verified with those heads whose signature
leaves a similarity above the limit possible, by the exact weighted Jaccard similarity. What is then left in a bucket of several classes is compared
across the classes within a join that only similar pairs leave, so no link between different texts is lost; rows stay in
proportion to the texts.

What is linked are different texts, numbered by their least id and digest, so neither repeated nor missing ids lose a document or a link.
A class is named by its least id; if several classes have that same least id, all but the first are named by negative numbers, as
are classes without any id.

Edge cases: a NULL text is alone in its class, named by its id; texts without a word are equal if their bytes are; equal rows come
back as often as they are; an empty table gives an empty result; further columns are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm import bloom, spans
from platelake.llm.ordering import numbered
from platelake.llm.shared import col, stored, unused

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS
#: Signatures of a similar pair agree in fewer coordinates than this with a probability below 1e-5.
MIN_AGREE = 58
HEADS = 2
#: A task works on about so many bytes of text at once: a byte of text needs some tens of bytes while its darts are thrown.
CHUNK_BYTES = 1 << 20

_G1, _G2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shingles(texts: spans.Texts, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text in text order, and the offsets of the texts among them."""
    texts.data = spans.LOWER[texts.data]
    found = spans.words(texts)
    h = spans.hashes(texts.data, found)
    grams, _, owner = spans.ngrams(h, found.first, n)
    counts = found.counts()
    for size in range(1, n):  # short texts, by their number of words
        short = np.flatnonzero(counts == size)
        if len(short):
            value = np.full(len(short), size, np.uint64)
            with np.errstate(over="ignore"):
                for j in range(size):
                    value = spans.mix(value ^ h[found.first[short] + j])
            grams, owner = np.concatenate([grams, value]), np.concatenate([owner, short])
    order = np.argsort(owner, kind="stable")
    return grams[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))


def occurrences(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One number for each unit of weight: the element and how often it was met before in its text. Sorted by text."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((grams, owner))
    g, o = grams[order], owner[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
    begin = np.flatnonzero(new)
    rank = np.arange(len(g)) - np.repeat(begin, np.diff(np.append(begin, len(g))))
    with np.errstate(over="ignore"):
        return spans.mix(g + rank.astype(np.uint64) * _G1)


def signatures(cells: np.ndarray, offsets: np.ndarray, share: np.ndarray | None = None, k: int = COORDINATES) -> np.ndarray:
    """The earliest dart of each coordinate for each text; ``cells`` are its units of weight.

    ``share`` is how much of each unit belongs to the text (1 if not given): darts beyond it are not the text's.
    """
    n = len(offsets) - 1
    weight = np.diff(offsets).astype(float)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    best_rank = np.full(n * k, np.inf)
    best = np.zeros(n * k, np.uint64)
    until = np.where(weight > 0, (np.log(k) + 2) * k / np.maximum(weight, 1), 0.0)
    # State of each unit's stream: the number of darts so far and the time of the last.
    live = np.arange(len(cells))
    time, number = np.zeros(len(cells)), np.zeros(len(cells), np.uint64)
    waiting = weight > 0
    with np.errstate(over="ignore"):
        while waiting.any():
            active = live[waiting[owner[live]]]
            limit = until[owner]
            while len(active):
                number[active] += np.uint64(1)
                dart = spans.mix(cells[active] + number[active] * _G2)
                gap = -np.log(((dart >> np.uint64(11)).astype(float) + 0.5) / 2.0**53)
                arrival = time[active] + gap
                early = arrival <= limit[active]
                # A stream that has passed the limit stops before its next dart, to be thrown again if the time grows.
                number[active[~early]] -= np.uint64(1)
                active, dart, arrival = active[early], dart[early], arrival[early]
                time[active] = arrival
                second = spans.mix(dart ^ _G1)
                slot = owner[active] * k + (second % np.uint64(k)).astype(np.int64)
                mine = np.ones(len(active), bool)
                if share is not None:
                    mine = (spans.mix(second) >> np.uint64(11)).astype(float) / 2.0**53 < share[active]
                better = np.flatnonzero(mine & (arrival < best_rank[slot]))
                # The last write wins: put the earliest last.
                better = better[np.argsort(-arrival[better], kind="stable")]
                best_rank[slot[better]] = arrival[better]
                best[slot[better]] = dart[better]
            waiting &= np.isinf(best_rank.reshape(n, k)).any(1)
            until = np.where(waiting, until * 2, until)
            if share is not None and waiting.any() and until.max() > 1e9:
                break
    return best.reshape(n, k)


@spans.frugal
def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, digest, text`` to ``doc_id, digest, weight, signature, bands``; without a word the last three are NULL."""
    for part in spans.chunked(batches, "text", CHUNK_BYTES):
        grams, offsets = shingles(spans.texts_of(part.column("text")))
        found = signatures(occurrences(grams, offsets), offsets)
        has = np.diff(offsets) > 0
        keys = found.reshape(len(has), BANDS, ROWS)
        band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(has), BANDS)).copy()
        with np.errstate(over="ignore"):
            for j in range(ROWS):
                band = spans.mix(band ^ keys[:, :, j])
        short = (found & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
        columns = [part.column("doc_id"), part.column("digest"), pa.array(np.diff(offsets), mask=~has)]
        for values in (short, band.view(np.int64)):
            at = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
            columns.append(pa.ListArray.from_arrays(at, pa.array(values.reshape(-1)), mask=pa.array(~has)))
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "weight", "signature", "bands"])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts given their units of weight."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1)


@spans.frugal
def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for part in spans.chunked([whole], "text_a", CHUNK_BYTES):
            units = []
            for name in ("text_a", "text_b"):
                grams, offsets = shingles(spans.texts_of(part.column(name)))
                cells = occurrences(grams, offsets)
                units.append([cells[i:j] for i, j in zip(offsets[:-1], offsets[1:])])
            keep = [similarity(a, b) >= SIMILAR for a, b in zip(*units)]
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose texts have a weighted Jaccard similarity of ``SIMILAR`` or more. Only the texts of ``a`` are
    shuffled with the pairs, so a text that is ``b`` of many pairs travels once."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_similar, "a long, b long")


def classes(links: DataFrame) -> DataFrame:
    """``node, least``: the connected components of ``a, b`` links, named by their least node, which is not listed.

    Large-star and small-star steps in turn; each step's links are written once, and what runs is a constant number of
    rows per link.
    """
    def step(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not larger:
            both = both.filter("v < u")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u")
        if larger:
            moved = joined.filter("v > u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        else:
            moved = joined.select(F.col("v").alias("x"), F.col("m").alias("y")).union(least.select(F.col("u").alias("x"), F.col("m").alias("y")))
        return moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while True:
        # Stars: every node that is not a least one has one link, and no node is both.
        ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("is_b")).union(edges.select("a", F.lit(0)))
        sides = ends.groupBy("node").agg(F.sum("is_b").alias("n"), F.min("is_b").alias("least"))
        if sides.filter("n > 1 or n = 1 and least = 0").isEmpty():
            return edges.select(F.col("b").alias("node"), F.col("a").alias("least"))
        edges = stored(step(step(edges, True), False))


def class_of(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """``a, b`` with the class of each, ``ca`` and ``cb``."""
    a = found.select(F.col("node").alias("a"), F.col("least").alias("class_a"))
    b = found.select(F.col("node").alias("b"), F.col("least").alias("class_b"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.select("a", "b", F.coalesce("class_a", "a").alias("ca"), F.coalesce("class_b", "b").alias("cb"))


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after further links: components of the classes that these join."""
    joined = class_of(links, found).filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    moved = classes(joined)
    to = moved.select(F.col("node").alias("old"), F.col("least").alias("new"))
    renamed = found.join(to, F.col("least") == F.col("old"), "left").select("node", F.coalesce("new", "least").alias("least"))
    return stored(renamed.union(moved))


def agreeing(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs whose signatures leave a similarity of ``SIMILAR`` possible, with the number of coordinates that agree."""
    a = signed.select(F.col("rep").alias("a"), F.col("signature").alias("sa"), F.col("weight").alias("wa"))
    b = signed.select(F.col("rep").alias("b"), F.col("signature").alias("sb"), F.col("weight").alias("wb"))
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    sizes = F.least("wa", "wb") >= SIMILAR * F.greatest("wa", "wb")
    joined = pairs.join(a, "a").join(b, "b").filter(sizes).select("a", "b", same.alias("agree"))
    return joined.filter(F.col("agree") >= MIN_AGREE)


def shared_buckets(signed: DataFrame) -> DataFrame:
    """``rep, band, key, n`` of the buckets with several texts."""
    rows = signed.select("rep", F.posexplode("bands").alias("band", "key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return rows.join(sizes, "key").select("rep", "band", "key", "n")


def with_heads(members: DataFrame) -> DataFrame:
    """``a, b``: each text of a bucket and the bucket's heads, the texts that meet the most others."""
    degree = members.groupBy("rep").agg(F.sum(F.col("n") - 1).alias("degree"))
    order = Window.partitionBy("key").orderBy(F.desc("degree"), F.xxhash64("rep"))
    ranked = members.join(degree, "rep").select("key", "rep", "degree", F.row_number().over(order).alias("place"))
    heads = ranked.filter(F.col("place") <= HEADS).select("key", F.col("rep").alias("head"))
    pairs = members.select("key", "rep").join(heads, "key").filter("rep <> head")
    return pairs.select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()


@spans.frugal
def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``rep, text`` to the units of weight of each text, in 32 bits."""
    for part in spans.chunked(batches, "text", CHUNK_BYTES):
        grams, offsets = shingles(spans.texts_of(part.column("text")))
        cells = (occurrences(grams, offsets) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
        yield pa.RecordBatch.from_arrays([part.column("rep"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(cells))], ["rep", "units"])


def across(members: DataFrame, found: DataFrame, signed: DataFrame, texts_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``a, b``: texts of different classes in one bucket that are similar by their units of weight.

    Only similar pairs leave the join, each from the first bucket that both are in. Of the two sides' conditions the cheap ones
    come first.
    """
    named = members.join(found, F.col("rep") == F.col("node"), "left").select("key", "band", "rep", F.coalesce("least", "rep").alias("class"))
    several = named.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo < hi").select("key")
    open_members = stored(named.join(several, "key").select("key", "band", "rep", "class"))
    units = texts_of(open_members.select("rep").distinct()).mapInArrow(_units, "rep long, units array<int>")
    about = stored(units.join(signed.select("rep", "weight", "bands"), "rep"))
    earlier = F.slice("bands", 1, F.col("band")).alias("earlier")
    side = open_members.join(about, "rep").select("key", "rep", "class", "weight", earlier, "units")
    x, y = side.toDF("key", "a", "ca", "wa", "ea", "ua"), side.toDF("key_b", "b", "cb", "wb", "eb", "ub")
    # No two bands have keys in common, so the pair is new if none of the earlier keys is shared.
    first = ~F.arrays_overlap("ea", "eb")
    sizes = F.least("wa", "wb") >= SIMILAR * F.greatest("wa", "wb")
    # One more than counted, as two units may look alike in 32 bits; what leaves is verified.
    both = F.size(F.array_intersect("ua", "ub")) + 1
    similar = both * (1 + SIMILAR) >= SIMILAR * (F.col("wa") + F.col("wb"))
    return x.join(y, (F.col("key") == F.col("key_b")) & (F.col("ca") < F.col("cb")) & sizes & first & similar).select("a", "b")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct()


def near_classes(signed: DataFrame, texts_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``node, least`` for the near-duplicates among different texts.

    ``signed`` holds ``rep, weight, signature, bands``; ``texts_of`` gives ``rep, text`` for a table of reps.
    """
    members = stored(shared_buckets(signed))
    tried = stored(agreeing(with_heads(members), signed).select("a", "b"))
    found = stored(classes(stored(verified(tried, texts_of(_nodes(tried))))))
    rest = stored(across(members, found, signed, texts_of))
    if rest.isEmpty():
        return found
    return merged(found, stored(verified(rest, texts_of(_nodes(rest)))))


def _nodes_of(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows as ``doc_id, digest``, the different texts as ``rep, digest, lo`` (their number, by least id, and that id), and the
    classes among these as ``node, least``."""
    # Equal texts share a 128-bit digest.
    rows = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text")).withColumn("digest", F.unhex(F.md5("text")))
    schema = "doc_id long, digest binary, weight long, signature array<smallint>, bands array<long>"
    marked = stored(rows.select("doc_id", "digest", "text").mapInArrow(_signed, schema))
    least = marked.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("lo"))
    texts = stored(numbered(least, F.asc_nulls_last("lo"), F.asc("digest"), name="rep").select("rep", "digest", "lo"))
    own = texts.select("rep", "lo", F.col("digest").alias("of_rep"))
    signed = marked.filter("bands is not null").join(own, (F.col("digest") == F.col("of_rep")) & F.col("doc_id").eqNullSafe(F.col("lo")))
    signed = stored(signed.dropDuplicates(["rep"]).select("rep", "digest", "lo", "weight", "signature", "bands"))
    place = F.xxhash64("digest", "doc_id")

    def texts_of(reps: DataFrame) -> DataFrame:
        wanted = reps.join(signed.select("rep", F.col("digest").alias("of_rep"), "lo"), "rep")
        wanted = stored(wanted.withColumn("place", F.xxhash64("of_rep", "lo")))
        # Only texts that a Bloom filter lets through are shuffled: of copies those under the least id.
        likely = bloom.may_be_in(rows, place, wanted, "place", "likely").filter("likely")
        found = likely.join(wanted, (F.col("digest") == F.col("of_rep")) & F.col("doc_id").eqNullSafe(F.col("lo"))).select("rep", "text")
        return stored(found.dropDuplicates(["rep"]))

    return marked.select("doc_id", "digest"), texts, near_classes(signed, texts_of)


def duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, class_id``: documents of one class are linked by equal or similar texts."""
    rows, texts, found = _nodes_of(docs, key, text)
    heads = texts.join(found, F.col("rep") == F.col("node"), "left_anti")
    # Of classes with one least id the first is named by it.
    firsts = heads.filter("lo is not null").groupBy(F.col("lo").alias("id")).agg(F.min("rep").alias("first"))
    names = heads.join(firsts, F.col("rep") == F.col("first"), "left").select(F.col("rep").alias("head"), F.coalesce("id", -F.col("rep")).alias("class_id"))
    placed = texts.join(found, F.col("rep") == F.col("node"), "left").select(F.col("digest").alias("of_class"), F.coalesce("least", "rep").alias("class_node"))
    named = placed.join(names, F.col("class_node") == F.col("head")).select("of_class", "class_id")
    return rows.join(named, F.col("digest") == F.col("of_class"), "left").select("doc_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class: that with the least id, of several texts under it that with the least digest, of equal rows one.

    Rows without a text are one for each id; those with neither id nor text all stay.
    """
    _, texts, found = _nodes_of(docs, key, text)
    kept_id, kept_digest, digest = (unused(docs, c) for c in ("kept_id", "kept_digest", "text_digest"))
    heads = texts.join(found, F.col("rep") == F.col("node"), "left_anti")
    heads = stored(heads.select(F.col("lo").alias(kept_id), F.col("digest").alias(kept_digest)))
    named = docs.withColumn(digest, F.unhex(F.md5(col(text).cast("string"))))
    same = (col(digest) == col(kept_digest)) & col(key).cast("long").eqNullSafe(col(kept_id))
    kept = named.join(heads, same).dropDuplicates([kept_id, kept_digest]).select(*map(col, docs.columns))
    blank = docs.filter(col(text).isNull())
    blank = blank.filter(col(key).isNotNull()).dropDuplicates([key]).union(blank.filter(col(key).isNull()))
    return kept.union(blank)
