"""Bigram counts of a corpus over all its words, and losses of documents by joining their bigrams with the counts.

Tokens are the units of a text in small letters, known by a 64-bit hash; a bigram's key is made of the hashes of its two tokens. Every token
and every bigram is counted by ordinary aggregates, so the tables grow with the data and none of them is held by the driver or by a task.
A limit on the vocabulary (``VOCABULARY``) is only for models that ask for one; tokens beyond it are unknown.

Counts of a task leave it as packed arrays, one for each shard of the bigrams' keys, and a shard's are summed at once; no single row is shuffled for them.

Scoring starts from the loss that tasks know without an entry, and adds what the bigram's entry says. At most ``WORD_HEAD`` of the most
frequent tokens and ``HEAD`` of the most frequent bigrams are sent to every task and settled there. All other bigrams go, as packed arrays of
one chunk of documents each, to the shard that has their entries, packed likewise. What a shard answers
for a chunk is one row again. A token that is not sent is unknown to a task; a bigram with such a token gets an entry by
joins with the table of tokens if it is known all the same. Shards are sized by the entries beyond the head, and repeated under as many salts as the bytes of the scored documents
need. What is known of a chunk without the shards is a group of its own.
Losses are whole multiples of 2^-20, so that sums do not depend on the order in which they arrive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm import bloom, spans
from platelake.llm.shared import brief_shuffles, dropped, stored

VOCABULARY: int | None = None
UNKNOWN, EDGE = 0, 1
HEAD, WORD_HEAD = 1 << 19, 1 << 19
SHARD_ROWS, TASK_BYTES = 1_000_000, 48_000_000
#: Bytes of text whose counts are one shard's, bytes of text that are scored at a time, and entries that a task packs at a time.
COUNT_BYTES, SCORE_BYTES, PACK_ROWS = 8_000_000, 1 << 20, 1_000_000
UNIT = 1 << 20
FLUSH = 1_500_000

#: Keys of totals among the counts; those of bigrams are not negative.
ALL_TOKENS, UNKNOWN_TOKENS = -1, -2
_POSITIVE = (1 << 63) - 1

Counted = tuple[np.ndarray, ...]


@dataclass
class Words:
    """The words of a model: ``rows`` has them all, ``listed`` their sorted hashes if their number is limited."""

    rows: DataFrame
    listed: np.ndarray | None

    def __len__(self) -> int:
        return self.rows.count() if self.listed is None else len(self.listed)


def pair_key(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    v, w = before.view(np.uint64), now.view(np.uint64)
    return ((v ^ (w << np.uint64(1) | w >> np.uint64(63))) & np.uint64(_POSITIVE)).view(np.int64)


def merged(held: list[Counted], names: Sequence[str]) -> Counted:
    """Sums of the columns ``n..`` by the first, over several lists; other columns follow from the key."""
    keys, *others = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    if not len(first):
        return keys, *others
    own = [np.add.reduceat(c[order].astype(np.int64), first) if name.startswith("n") else c[order[first]] for name, c in zip(names[1:], others)]
    return keys[first], *own


def _summed(found: Iterator[Counted], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a task, combined before they leave it."""
    held: list[Counted] = []
    size = 0
    for part in found:
        held.append(part)
        size += len(part[0])
        if size > FLUSH:
            held = [merged(held, names)]
            size = len(held[0][0])
            if size > FLUSH // 2:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], names)
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged(held, names)], names)


def _units(texts: spans.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    texts.data = spans.LOWER[texts.data]
    found = spans.units(texts)
    own, inverse = np.unique(spans.hashes(texts.data, found), return_inverse=True)
    return own.view(np.int64), inverse, found.first


def vocabulary(texts: DataFrame) -> Words:
    """The words of column ``text``; only the most frequent if ``VOCABULARY`` limits them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts() -> Iterator[Counted]:
            for part in spans.chunked(batches, "text"):
                own, inverse, _ = _units(spans.texts_of(part.column("text")))
                yield own, np.bincount(inverse, minlength=len(own))

        return _summed(counts(), ("key", "n"))

    rows = texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    if VOCABULARY is None:
        return Words(rows, None)
    top = rows.orderBy(F.desc("n"), "key").limit(VOCABULARY).select("key").toArrow()
    return Words(rows, np.sort(top.column("key").to_numpy()))


def token_pairs(texts: spans.Texts, listed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the texts, the places of the previous and present one among them everywhere, the end of a text included, and
    the offsets of the texts."""
    own, inverse, first = _units(texts)
    tokens = np.concatenate([[EDGE], own if listed is None else np.where(np.isin(own, listed), own, UNKNOWN)])
    places = inverse + 1
    return tokens, np.insert(places, first[:-1], 0), np.insert(places, first[1:], 0), first + np.arange(len(first))


def text_bytes(texts: DataFrame) -> int:
    return texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def _narrow(values: np.ndarray) -> bytes:
    """Numbers in the fewest bytes that hold the greatest of them."""
    low, high = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return values.astype(kind).tobytes()


def _wide(packed: pa.ChunkedArray | pa.Array, lengths: Sequence[int]) -> np.ndarray:
    """Numbers of several ``_narrow`` values of known lengths."""
    found = [np.frombuffer(x.as_py(), f"<i{len(x.as_py()) // n}").astype(np.int64) for x, n in zip(packed, lengths) if n]
    return np.concatenate([np.zeros(0, np.int64), *found])


def _packed(shards: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each shard: ``shard, rows`` and the numbers of its rows, in their order."""
    order = np.argsort(shards, kind="stable")
    own, begin = np.unique(shards[order], return_index=True)
    cells = [pa.array([_narrow(c) for c in np.split(x[order], begin[1:])] if len(own) else [], pa.binary()) for x in columns.values()]
    sizes = np.diff(np.append(begin, len(shards)))
    return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(sizes.astype(np.int64)), *cells], ["shard", "rows", *columns])


def packed_schema(names: Sequence[str]) -> str:
    return "shard int, rows long" + "".join(f", {c} binary" for c in names)


def bigram_rows(
    texts: DataFrame, words: Words | None = None, chosen: Callable[[np.ndarray], np.ndarray] | None = None, marked: str | None = None, shards: int | None = None
) -> DataFrame:
    """``v, w, n``: counts of the bigrams of column ``text``, combined by task, those of the totals with a NULL ``w``; only of bigrams with
    a ``chosen`` token, or all. ``n_marked`` counts them over the rows where the boolean ``marked`` is true. With ``shards`` packed, one row for
    each shard of the keys; the totals are the rows of shard -1, with their key as ``v``."""
    listed = None if words is None else words.listed
    fields = ("v", "w", "n_marked", "n")
    kept = fields if marked else ("v", "w", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts() -> Iterator[Counted]:
            for part in spans.chunked(batches, "text"):
                tokens, before, now, offsets = token_pairs(spans.texts_of(part.column("text")), listed)
                codes = before * len(tokens) + now
                if chosen is not None:
                    wanted = chosen(tokens)
                    codes = codes[wanted[before] | wanted[now]]
                pairs, n = np.unique(codes, return_counts=True)
                v, w = tokens[pairs // len(tokens)], tokens[pairs % len(tokens)]
                unknown = tokens[now] == UNKNOWN
                n = np.concatenate([[len(now), int(unknown.sum())], n])
                n_marked = np.zeros(len(n), np.int64)
                if marked is not None:
                    there = np.repeat(part.column(marked).to_numpy(zero_copy_only=False).astype(bool), np.diff(offsets))
                    at, times = np.unique(codes[there], return_counts=True)
                    n_marked[np.searchsorted(pairs, at) + 2] = times
                    n_marked[:2] = there.sum(), (unknown & there).sum()
                none = np.zeros(2, np.int64)
                keys = np.concatenate([[ALL_TOKENS, UNKNOWN_TOKENS], pair_key(v, w)])
                yield keys, np.concatenate([none, v]), np.concatenate([none, w]), n_marked, n

        for rows in _summed(counts(), ("key", "v", "w", "n_marked", "n")):
            total = rows.column("key").to_numpy() < 0
            if shards is not None:
                keys, v, *others = (c.to_numpy() for c in rows.columns)
                shard = np.where(total, -1, _shard(keys, shards))
                yield _packed(shard, dict(zip(fields, (np.where(total, keys, v), *others)))).select(["shard", "rows", *kept])
                continue
            v = np.where(total, rows.column("key").to_numpy(), rows.column("v").to_numpy())
            w = pa.array(rows.column("w").to_numpy(), mask=total)
            # In the order of ``v``, whose repeats then take hardly any bytes in the shuffle.
            yield pa.RecordBatch.from_arrays([pa.array(v), w, rows.column("n_marked"), rows.column("n")], ["v", "w", "n_marked", "n"]).take(pa.array(np.argsort(v)))

    rows = texts.select("text", *([marked] if marked else []))
    if shards is not None:
        return rows.mapInArrow(run, packed_schema(kept))
    found = rows.mapInArrow(run, "v long, w long, n_marked long, n long")
    return found if marked else found.drop("n_marked")


def _key() -> Column:
    """As ``pair_key``, over columns ``v`` and ``w``."""
    turned = F.shiftleft("w", 1).bitwiseOR(F.shiftrightunsigned("w", 63))
    return F.when(F.col("w").isNull(), F.col("v")).otherwise(F.col("v").bitwiseXOR(turned).bitwiseAND(F.lit(_POSITIVE))).alias("key")


def grouped(rows: DataFrame) -> DataFrame:
    """``key, v, w`` and the sums of the counts of packed ``rows``, in the order of ``v`` within a shard."""
    names = [c for c in rows.columns if c not in ("shard", "rows", "v", "w")]

    def run(shard: pa.Table) -> pa.Table:
        lengths = shard.column("rows").to_pylist()
        v, w, *n = (_wide(shard.column(c), lengths) for c in ("v", "w", *names))
        total = shard.column("shard")[0].as_py() < 0
        keys, v, w, *n = merged([(v if total else pair_key(v, w), v, w, *n)], ("key", "v", "w", *(f"n_{c}" for c in names)))
        order = np.argsort(v, kind="stable")
        cells = [pa.array(c[order]) for c in (keys, v, w, *n)]
        if total:
            cells[2] = pa.nulls(len(v), pa.int64())
        return pa.Table.from_arrays(cells, ["key", "v", "w", *names])

    return rows.groupBy("shard").applyInArrow(run, "key long, v long, w long" + "".join(f", {c} long" for c in names))


def count_shards(size: int) -> int:
    return max(1, -(-size // COUNT_BYTES))


def bigram_counts(texts: DataFrame, words: Words | None = None, size: int | None = None) -> DataFrame:
    """``key, v, w, n``: counts of all bigrams, and the totals, over column ``text`` of at most ``size`` bytes (if not given, they are summed)."""
    return grouped(bigram_rows(texts, words, shards=count_shards(text_bytes(texts) if size is None else size)))


def stored_counts(counts: DataFrame) -> DataFrame:
    """``counts`` written in the order of their bigrams and without the key, which follows from them: a third of the bytes."""
    written = stored(counts.drop("key").sortWithinPartitions("v"), brief=True)
    return written.select(_key(), *written.columns)


def known_pairs(counts: DataFrame) -> DataFrame:
    """The bigrams of two known tokens."""
    return counts.filter(F.col("w").isNotNull() & (F.col("v") != UNKNOWN) & (F.col("w") != UNKNOWN))


def with_ids(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``doc_id, text`` of the documents in ``ids``; only those that a Bloom filter lets through are shuffled."""
    wanted = stored(ids.select(F.col(name).alias("wanted_id")).filter("wanted_id is not null").distinct())
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return bloom.matching(texts, F.col("doc_id"), wanted, "wanted_id").select("doc_id", "text")


def with_mark(docs: DataFrame, ids: DataFrame, name: str, mark: str) -> DataFrame:
    """``text`` and the boolean ``mark`` of every document: whether it is in ``ids``; only likely ones are shuffled."""
    wanted = stored(ids.select(F.col(name).alias("wanted_id")).filter("wanted_id is not null").distinct())
    texts = bloom.may_be_in(docs.select("doc_id", F.col("text").cast("string").alias("text")), F.col("doc_id"), wanted, "wanted_id", mark)
    likely = texts.filter(F.col(mark)).drop(mark).join(wanted, F.col("doc_id") == F.col("wanted_id"), "left")
    return texts.filter(~F.col(mark)).select("text", mark).union(likely.select("text", F.col("wanted_id").isNotNull().alias(mark)))


#: Numbers of the previous and of the present tokens, which of either are known, counts by model -> losses in nats by each model.
Losses = Callable[[dict[str, np.ndarray], dict[str, np.ndarray], np.ndarray, np.ndarray, Sequence[np.ndarray]], list[np.ndarray]]


@dataclass
class Model:
    """``tokens``: one row ``token, weight`` and numbers ``names`` of each known token; ``plain``: the counts of a bigram without an entry."""

    tokens: DataFrame
    names: Sequence[str]
    losses: Losses
    plain: Sequence[int]


class Sorted:
    """Sorted distinct keys and where each value of their leading bits begins, so that a hash is found in a step or two; made when first asked."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys, self.begin, self.shift = keys, None, 0

    @staticmethod
    def _leading(keys: np.ndarray, shift: int) -> np.ndarray:
        return ((keys.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(shift)).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys, and which are there."""
        held = self.keys
        if not len(held):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        if self.begin is None:
            bits = len(held).bit_length() + 1
            self.shift = 64 - bits
            counts = np.bincount(self._leading(held, self.shift), minlength=1 << bits)
            self.begin = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32 if len(held) < 1 << 31 else np.int64)
            self.even = counts.max() <= 64
        if not self.even:
            at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
            return at, held[at] == keys
        at = np.minimum(self.begin[self._leading(keys, self.shift)], len(held) - 1).astype(np.int64)
        found = held[at]
        left = np.flatnonzero(found < keys)
        while len(left):
            left = left[at[left] + 1 < len(held)]
            at[left] += 1
            found[left] = held[at[left]]
            left = left[found[left] < keys[left]]
        return at, found == keys


def _exact(losses: list[np.ndarray]) -> list[np.ndarray]:
    return [np.rint(loss * UNIT).astype(np.int64) for loss in losses]


def _numbers(tokens: np.ndarray, held: Sorted, numbers: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The numbers of tokens, zero where they are not held, and which are."""
    at, has = held.look_up(tokens)
    return {c: np.where(has, x[at], 0.0) if len(x) else np.zeros(len(tokens)) for c, x in numbers.items()}, has


def _cut(ranks: DataFrame, most: int) -> tuple[int, int]:
    """Of ``rank, n`` the least rank that at most ``most`` rows are above (-1 if all rows are no more), and the number of the other rows."""
    above = 0
    sums = sorted(((r["rank"], r["n"]) for r in ranks.groupBy("rank").agg(F.sum("n").alias("n")).collect()), reverse=True)
    for i, (rank, n) in enumerate(sums):
        if above + n > most:
            return rank, sum(n for _, n in sums[i:])
        above += n
    return -1, 0


#: Most bits of a filter of hashes, and bits for each hash as long as there are fewer.
FILTER_BITS, HASH_BITS = 1 << 26, 16


def _filter_words(hashes: DataFrame, name: str, n_hashes: int) -> np.ndarray:
    """A Bloom filter of a column of hashes as 64-bit words, two bits for each hash; of ``FILTER_BITS`` at most."""
    bits = min(FILTER_BITS, max(64, 1 << (n_hashes * HASH_BITS - 1).bit_length()))
    places = F.explode(F.array(*[F.shiftrightunsigned(name, at).bitwiseAND(F.lit(bits - 1)) for at in (0, 32)]))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    with brief_shuffles(hashes.sparkSession):
        rows = hashes.select(places.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(mask).alias("mask"))
        found = rows.toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return words


def _may_be_in(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    hit = np.ones(len(hashes), bool)
    for at in (0, 32):
        place = hashes.view(np.uint64) >> np.uint64(at) & np.uint64(len(words) * 64 - 1)
        hit &= (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return hit


def scored(docs: DataFrame, words: Words | None, counts: DataFrame, columns: Sequence[str], model: Model, covered: bool = False, size: int | None = None, slices: int = 1, spent: Sequence[DataFrame] = ()) -> DataFrame:
    """``doc_id, lang, n_tokens`` and the loss by each model, in 2^-20 nats, of every row of ``doc_id, lang, text``.

    ``counts``: ``key, v, w`` and a count for each model, in the order of ``columns``; the last ranks the bigrams.
    ``covered``: the last counts all bigrams of these documents. ``size``: bytes of their texts, if known. The places of one of ``slices``
    parts of many documents are on disk at a time, and the ``spent`` written tables are removed before.
    """
    spark = docs.sparkSession
    listed = None if words is None else words.listed
    names = [f"loss{m}" for m in range(len(columns))]
    losses, plain, numbers = model.losses, [float(x) for x in model.plain], list(model.names)
    weight_cut, n_unsent = _cut(model.tokens.select(F.col("weight").alias("rank"), F.lit(1).alias("n")), WORD_HEAD)
    held = model.tokens.filter(F.col("weight") > weight_cut).toArrow().sort_by("token")
    unsent = model.tokens.filter(F.col("weight") <= weight_cut)
    # Which of the other tokens may be known; all, where the counts cover the documents.
    likely = None if covered or not n_unsent else _filter_words(unsent, "token", n_unsent)
    of_words = spark.sparkContext.broadcast((Sorted(held.column("token").to_numpy()), {c: held.column(c).to_numpy().astype(np.float64) for c in numbers}, likely))

    def may_be_unsent(tokens: np.ndarray, has: np.ndarray | None = None) -> np.ndarray:
        tokens_sent, _, words_of = of_words.value
        if not n_unsent:
            return np.zeros(len(tokens), bool)
        rare = ~(tokens_sent.look_up(tokens)[1] if has is None else has)
        return rare if words_of is None else rare & _may_be_in(tokens, words_of)

    def extra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            (v, has_v), (w, has_w) = (_numbers(part.column(t).to_numpy(), *of_words.value[:2]) for t in "vw")
            n = [part.column(c).to_numpy().astype(np.float64) for c in columns]
            differs = has_v & has_w & np.any([c != x for c, x in zip(n, plain)], axis=0)
            v, w = ({c: x[differs] for c, x in t.items()} for t in (v, w))
            n, sure = [c[differs] for c in n], np.ones(int(differs.sum()), bool)
            with_counts, without = _exact(losses(v, w, sure, sure, n)), _exact(losses(v, w, sure, sure, [np.full(len(sure), x) for x in plain]))
            kept = [part.column(c).filter(pa.array(differs)) for c in ("key", columns[-1])]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(a - b) for a, b in zip(with_counts, without))], ["key", "rank", *names])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            v, w = (may_be_unsent(part.column(t).to_numpy()) for t in "vw")
            part = pa.RecordBatch.from_arrays([*part.columns, pa.array(v), pa.array(w)], [*part.schema.names, "v_unsent", "w_unsent"])
            yield part.filter(pa.array(v | w))

    def unsent_extra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sent, full, has, known = [], [], [], []
            for t in "vw":
                own, own_has = _numbers(part.column(t).to_numpy(), *of_words.value[:2])
                joined = part.column(f"{t}_known").to_numpy() > 0
                sent.append(own)
                full.append({c: np.where(joined, part.column(f"{t}_{c}").to_numpy().astype(np.float64), x) for c, x in own.items()})
                has.append(own_has)
                known.append(own_has | joined)
            n = [part.column(c).to_numpy().astype(np.float64) for c in columns]
            found = [a - b for a, b in zip(_exact(losses(*full, *known, n)), _exact(losses(*sent, *has, [np.full(part.num_rows, x) for x in plain])))]
            rows = pa.RecordBatch.from_arrays([part.column("key"), part.column("rank"), *map(pa.array, found)], ["key", "rank", *names])
            yield rows.filter(pa.array(np.any([x != 0 for x in found], axis=0)))

    pairs = counts.filter(F.col("w").isNotNull()).select("key", "v", "w", *columns)
    differing = reduce(or_, [F.col(c) != x for c, x in zip(columns, model.plain)])
    entry_schema = "key long, rank long" + "".join(f", {c} long" for c in names)

    def own_rows(within: Column) -> DataFrame:
        return pairs.withColumn("rank", F.col(columns[-1])).filter(differing & within).select(*pairs.columns)

    def entries(within: Column) -> DataFrame:
        own = own_rows(within).mapInArrow(extra, entry_schema)
        return own if unsent_entries is None else own.union(unsent_entries.filter(within))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def piece() -> pa.RecordBatch:
            key, *found = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("key", *names))
            return _packed(_shard(key, shards), {"key": key} | dict(zip(names, found)))

        for part in batches:
            held.append(part)
            if sum(x.num_rows for x in held) >= PACK_ROWS:
                yield piece()
                held = []
        if held:
            yield piece()

    unsent_entries = None
    if n_unsent:
        rows = pairs.select("v", "w", F.col(columns[-1]).alias("rank"), *columns)
        row_schema = "v long, w long, rank long" + "".join(f", {c} long" for c in columns) + ", v_unsent boolean, w_unsent boolean"
        if not covered:
            asked = bigram_rows(docs, words, may_be_unsent).filter("w is not null")
            asked = asked.select("v", "w", F.col("n").alias("rank"), *[F.lit(0).cast("long").alias(c) for c in columns])
            own = rows.withColumn("rank", F.lit(0).cast("long")).mapInArrow(marked, row_schema).drop("v_unsent", "w_unsent")
            rows = asked.union(own).groupBy("v", "w").agg(*[F.sum(c).alias(c) for c in ("rank", *columns)]).filter("rank > 0")
        rows = stored(rows.mapInArrow(marked, row_schema), brief=True)

        def numbers_of(t: str, of: str) -> DataFrame:
            return unsent.select(F.col("token").alias(t), F.lit(1).alias(f"{of}_known"), *[F.col(c).alias(f"{of}_{c}") for c in numbers])

        # A bigram with one such token goes to it, in one join; only one with two of them takes two.
        both = F.col("v_unsent") & F.col("w_unsent")
        joined = ["known", *numbers]
        at_one = rows.filter(~both).withColumn("token", F.when(F.col("v_unsent"), F.col("v")).otherwise(F.col("w"))).join(numbers_of("token", "one"), "token")
        sides = [F.when(F.col(f"{t}_unsent"), F.col(f"one_{c}")).alias(f"{t}_{c}") for t in "vw" for c in joined]
        at_two = rows.filter(both).join(numbers_of("v", "v"), "v", "left").join(numbers_of("w", "w"), "w", "left")
        fields = [_key(), "v", "w", "rank", *columns]
        found = at_one.select(*fields, *sides).union(at_two.select(*fields, *[f"{t}_{c}" for t in "vw" for c in joined])).fillna(0)
        unsent_entries = stored(found.mapInArrow(unsent_extra, entry_schema), brief=True)
    ranks = pairs.filter(differing).select(F.col(columns[-1]).alias("rank"), F.lit(1).alias("n"))
    if unsent_entries is not None:
        ranks = ranks.union(unsent_entries.select("rank", F.lit(1).alias("n")))
    cut, rest = _cut(ranks, HEAD)
    top = entries(F.col("rank") > cut).toArrow().sort_by("key")
    # Where the counts are those of other documents, most of the bigrams without an entry need not travel.
    in_tail = None
    if rest and not covered:
        keys = pairs.withColumn("rank", F.col(columns[-1])).filter(differing & (F.col("rank") <= cut)).select("key")
        if unsent_entries is not None:
            keys = keys.union(unsent_entries.filter(F.col("rank") <= cut).select("key"))
        in_tail = _filter_words(keys, "key", rest)
    sent = spark.sparkContext.broadcast((listed, Sorted(top.column("key").to_numpy()), [top.column(c).to_numpy() for c in names], in_tail))
    # Shards follow the entries beyond the head, salts the documents that are scored.
    size = text_bytes(docs) if size is None else size
    shards = max(1, -(-rest // SHARD_ROWS))
    salts = max(1, -(-size // (shards * TASK_BYTES)))
    slices = slices if size > TASK_BYTES else 1
    piece_schema = packed_schema(("key", *names))
    tail = own_rows(F.col("rank") <= cut).mapInArrow(lambda batches: pieces(extra(batches)), piece_schema)
    if unsent_entries is not None:
        tail = tail.union(unsent_entries.filter(F.col("rank") <= cut).mapInArrow(pieces, piece_schema))
    tail = stored(tail, brief=True)
    dropped(*spent, *([] if unsent_entries is None else [rows, unsent_entries]))
    kinds = {"doc_id": pa.int64(), "lang": pa.string(), "n_tokens": pa.int64()} | {c: pa.int64() for c in names}
    answered = "chunk long, row array<long>, doc_id array<long>, lang array<string>, n_tokens array<long>" + "".join(f", {c} array<long>" for c in names)
    asked = "shard int, salt long, size array<long>, keys binary, " + answered

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words, known_keys, known_losses, likely_keys = sent.value
        part_id = TaskContext.get().partitionId()
        fields = ["shard", "salt", "size", "keys", "chunk", "row", *kinds]
        for chunk, part in enumerate(spans.chunked(batches, "text", SCORE_BYTES), part_id << 32):
            tokens, before, now, offsets = token_pairs(spans.texts_of(part.column("text")), known_words)
            keys = pair_key(tokens[before], tokens[now])
            own_numbers, has = _numbers(tokens, *of_words.value[:2])
            v, w = ({c: x[at] for c, x in own_numbers.items()} for at in (before, now))
            start = _exact(losses(v, w, has[before], has[now], [np.full(len(keys), x) for x in plain]))
            # Other bigrams have no entry: their loss is the same with any counts.
            rare = may_be_unsent(tokens, has)
            open_to = has[before] & has[now] | rare[before] | rare[now]
            at, settled = known_keys.look_up(keys)
            settled &= open_to
            own = [spans.per_text(x + (np.where(settled, c[at], 0) if len(c) else 0), offsets) for x, c in zip(start, known_losses)]
            info = [part.column("doc_id"), part.column("lang"), np.diff(offsets), *own]
            # No shard takes part in this group of one chunk.
            cells = [pa.array([-1], pa.int32()), pa.array([chunk], pa.int64()), _one_list(None, pa.int64()), pa.nulls(1, pa.binary()), pa.array([chunk], pa.int64())]
            cells += [_one_list(None, pa.int64()), *(_one_list(v, t) for v, t in zip(info, kinds.values()))]
            yield pa.RecordBatch.from_arrays(cells, fields)
            open_at = np.flatnonzero(open_to & ~settled) if rest else np.zeros(0, np.int64)
            if likely_keys is not None:
                open_at = open_at[_may_be_in(keys[open_at], likely_keys)]
            shard = _shard(keys[open_at], shards)
            order = np.argsort(shard, kind="stable")  # documents stay in order within a shard
            found, begin = np.unique(shard[order], return_index=True)
            for s, mine in zip(found, np.split(open_at[order], begin[1:])):
                size = np.bincount(np.searchsorted(offsets, mine, "right") - 1, minlength=part.num_rows)
                cells = [pa.array([s], pa.int32()), pa.array([((chunk >> 32) + chunk) % salts], pa.int64()), _one_list(size[size > 0], pa.int64())]
                cells += [pa.array([keys[mine].astype("<i8").tobytes()], pa.binary()), pa.array([chunk], pa.int64()), _one_list(np.flatnonzero(size), pa.int64())]
                yield pa.RecordBatch.from_arrays([*cells, *(_one_list(None, t) for t in kinds.values())], fields)

    answer_names = ["chunk", "row", *kinds]

    def answer(requests: pa.Table, shard: pa.Table) -> pa.Table:
        lengths = shard.column("rows").to_pylist()
        own, *has = (_wide(shard.column(c), lengths) for c in ("key", *names))
        order = np.argsort(own)
        held, has = Sorted(own[order]), [c[order] for c in has]
        tables = [requests.filter(requests.column("keys").is_null()).select(answer_names)]
        for request in requests.filter(requests.column("keys").is_valid()).to_batches(max_chunksize=1):
            at, hit = held.look_up(np.frombuffer(request.column("keys")[0].as_py(), "<i8"))
            offsets = np.concatenate([[0], np.cumsum(request.column("size")[0].values.to_numpy())])
            sums = [spans.per_text(np.where(hit, c[at], 0) if len(c) else np.zeros(len(at), np.int64), offsets) for c in has]
            cells = [*(request.column(c) for c in answer_names[:5]), *(_one_list(x, pa.int64()) for x in sums)]
            tables.append(pa.Table.from_arrays(cells, answer_names))
        return pa.concat_tables(x.cast(tables[0].schema) for x in tables)

    def whole(chunk: pa.Table) -> pa.Table:
        own = chunk.filter(chunk.column("row").is_null()).combine_chunks()
        info = [own.column(c).chunk(0).values if c == "lang" else own.column(c).chunk(0).flatten() for c in kinds]
        sums = [x.to_numpy().copy() for x in info[3:]]
        for part in chunk.filter(chunk.column("row").is_valid()).to_batches(max_chunksize=1):
            at = part.column("row")[0].values.to_numpy()
            for total, c in zip(sums, names):
                total[at] += part.column(c)[0].values.to_numpy()
        return pa.Table.from_arrays([own.column("doc_id").chunk(0).values, own.column("lang").chunk(0).values, info[2], *map(pa.array, sums)], list(kinds))

    salted = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    shards_of = tail.select("shard", salted.alias("salt"), "rows", "key", *names)

    def settled_part(part: DataFrame) -> DataFrame:
        asks = part.select("doc_id", "lang", "text").mapInArrow(ask, asked)
        answers = asks.groupBy("shard", "salt").cogroup(shards_of.groupBy("shard", "salt")).applyInArrow(answer, answered)
        return answers.groupBy("chunk").applyInArrow(whole, ", ".join(f"{f} {'string' if f == 'lang' else 'long'}" for f in kinds))

    if slices == 1:
        return settled_part(docs)
    part_of = F.pmod(F.xxhash64("doc_id"), F.lit(slices))
    found = reduce(DataFrame.union, [stored(settled_part(docs.filter(part_of == i)), brief=True) for i in range(slices)])
    dropped(tail)
    return found


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys >> 20) % shards


def _one_list(values: object, kind: pa.DataType) -> pa.Array:
    if values is None:
        return pa.nulls(1, pa.list_(kind))
    flat = values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def totals(counts: DataFrame, column: str = "n") -> tuple[int, int]:
    """Tokens and unknown tokens."""
    found = {r["key"]: r[column] or 0 for r in counts.filter("key < 0").select("key", column).collect()}
    return found.get(ALL_TOKENS, 0), found.get(UNKNOWN_TOKENS, 0)
