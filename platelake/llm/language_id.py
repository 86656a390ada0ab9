"""Language identification by averaged hashed subword embeddings with a linear softmax.

The subwords of a word are its byte n-grams with both ends marked; each falls into one of ``BUCKETS`` rows of an embedding
table. A text is the average of its subwords' rows, a linear layer and a softmax give the languages. Both layers are trained
in numpy by stochastic gradient descent on a bounded sample of every language (``SAMPLE`` documents in all, at most ``PER_LANG`` of a
language, at least one): exactly those with the least hashes of id and text among all training rows. On a part of the sample that training does not see, a
temperature makes the probabilities honest, and the limit below which a text is rejected is their low quantile.
Everything is linear up to the softmax, so a text is scored as the sum over its words, each distinct word of a
batch being looked up once; whole texts are read whatever their length.

Edge cases: NULL texts and texts without a letter get ``und``, score 0, and are rejected; rows without a language are not
learned from; repeated rows are learned from once and scored each; without any training row every text is ``und``; an empty
table gives an empty result; columns of the input are kept, new ones must have unused names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platelake.llm import spans
from platelake.llm.shared import col, stored, unused

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
DIMENSIONS = 16
SAMPLE, PER_LANG = 2000, 500
EPOCHS, BATCH, RATE = 30, 16, 4.0
REJECT_QUANTILE, REJECT_MOST = 0.001, 0.4
UNKNOWN = "und"
SEED = 7
#: Bits of a hash that are counted before the least hashes are chosen.
TOP_BITS = 16
#: A task works on about so many bytes of text at once: a byte of text needs some hundred bytes while its words are scored.
CHUNK_BYTES = 1 << 20


@dataclass
class LanguageModel:
    """``table`` times ``layer`` has one row of language scores for each bucket; for few languages ``table`` is that by itself."""

    langs: list[str]
    table: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def subwords(data: np.ndarray, found: spans.Spans) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram of the given spans, and the span that each belongs to."""
    size = found.length + 2
    ends = np.cumsum(size)
    begin = ends - size
    marked = np.full(int(ends[-1]) + 8 if len(ends) else 8, 0x20, np.uint8)
    owner = np.repeat(np.arange(len(size)), found.length)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(found.length) - found.length, found.length)
    marked[begin[owner] + 1 + inner] = data[found.start[owner] + inner]
    loads = np.ndarray((len(marked) - 7,), np.dtype("<u8"), marked, strides=(1,))
    buckets, owners = [], []
    for n in GRAMS:
        counts = np.maximum(size - n + 1, 0)
        own = np.repeat(np.arange(len(size)), counts)
        at = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[own]
        gram = (loads[at] & np.uint64((1 << 8 * n) - 1)) | np.uint64(n << 56)
        with np.errstate(over="ignore"):
            buckets.append((spans.mix(gram) >> np.uint64(17)).astype(np.int64) % BUCKETS)
        owners.append(own)
    return np.concatenate(buckets), np.concatenate(owners)


def _has_letter(part: pa.RecordBatch, column: str, sure: np.ndarray) -> np.ndarray:
    has = sure.copy()
    texts = part.column(column)
    for i in np.flatnonzero(~sure):
        text = texts[int(i)].as_py()
        has[i] = text is not None and any(c.isalpha() for c in text)
    return has


@spans.frugal
def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, held, text`` rows to their bucket counts."""
    for part in spans.chunked(batches, "text", CHUNK_BYTES):
        texts = spans.texts_of(part.column("text"))
        found, _ = spans.lettered(texts)
        words, inverse = spans.distinct(texts, found)
        bucket, owner = subwords(texts.data, words)
        counts = np.bincount(owner, minlength=len(words.start))
        begin = np.cumsum(counts) - counts
        order = np.argsort(owner, kind="stable")
        bucket = bucket[order]
        ids, weights = [], []
        for i in range(part.num_rows):
            own, times = np.unique(inverse[found.first[i] : found.first[i + 1]], return_counts=True)
            rows = np.repeat(np.arange(len(own)), counts[own])
            at = np.arange(len(rows)) - np.repeat(np.cumsum(counts[own]) - counts[own], counts[own]) + begin[own][rows]
            total = np.bincount(bucket[at], weights=times[rows], minlength=1)
            used = np.flatnonzero(total)
            ids.append(used.astype("<u2").tobytes())
            weights.append(total[used].astype("<f4").tobytes())
        yield pa.RecordBatch.from_pydict({"lang": part.column("lang"), "held": part.column("held"), "ids": ids, "weights": weights})


def train(langs: list[str], labels: np.ndarray, held: np.ndarray, ids: list[np.ndarray], weights: list[np.ndarray]) -> LanguageModel:
    """Fit both layers on the rows not ``held``, then temperature and limit on those that are."""
    rng = np.random.default_rng(SEED)
    k = len(langs)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIMENSIONS, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    shares = [w / max(w.sum(), 1) for w in weights]
    rows = np.flatnonzero(~held)
    steps = max(1, EPOCHS * -(-len(rows) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(rows), max(1, -(-len(rows) // BATCH))):
            hidden = np.stack([shares[i] @ embedding[ids[i]] for i in part]) if len(part) else np.zeros((0, DIMENSIONS))
            scores = hidden @ layer + bias
            p = np.exp(scores - scores.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), labels[part]] -= 1
            rate = RATE * (1 - step / steps)
            back = p @ layer.T
            # One step each: the gradient of an averaged row is divided by its share's norm, or long texts would hardly move it.
            for i, g in zip(part, back):
                embedding[ids[i]] -= rate / len(part) * np.outer(shares[i] / max(np.linalg.norm(shares[i]), 1e-9), g)
            layer -= rate / len(part) * hidden.T @ p
            bias -= rate / len(part) * 0.1 * p.sum(0)
            step += 1
    table = embedding
    if k <= DIMENSIONS:
        table, layer = (embedding @ layer).astype(np.float32), np.eye(k, dtype=np.float32)
    model = LanguageModel(langs, table, layer, bias, 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else rows
    scores = np.stack([shares[i] @ table[ids[i]] @ layer + bias for i in check]) if len(check) else np.zeros((0, k))
    if len(check):
        def loss(t: float) -> float:
            return float(-np.log(np.maximum(softmax(scores / t)[np.arange(len(check)), labels[check]], 1e-12)).mean())

        model.temperature = min(np.geomspace(0.2, 5, 41), key=loss)
        best = softmax(scores / model.temperature).max(1)
        model.reject_below = float(min(REJECT_MOST, np.quantile(best, REJECT_QUANTILE, method="lower")))
    return model


def softmax(scores: np.ndarray) -> np.ndarray:
    if not scores.size:
        return scores
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """A model from the rows with a text and a language."""
    labelled = rows.select(col(key).alias("key"), col(lang).cast("string").alias("lang"), col(text).cast("string").alias("text"))
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    n_langs = labelled.select("lang").distinct().count()
    if not n_langs:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    each = max(1, min(PER_LANG, SAMPLE // n_langs))
    # Id and text together, so that rows without an id, or of one id, are chosen among like others.
    hashed = labelled.withColumn("place", F.xxhash64("key", "text")).withColumn("tie", F.xxhash64("text", F.lit("tie")))
    different = hashed.select("lang", "place", "tie").distinct().withColumn("top", F.shiftright("place", 64 - TOP_BITS))
    # What the least hashes of a language have in front decides which rows can be among them, so few rows of it meet.
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("top"))
    tops = different.groupBy("lang", "top").agg(F.count("*").alias("n")).withColumn("upto", upto)
    cuts = stored(tops.groupBy("lang").agg(F.coalesce(F.min(F.when(F.col("upto") >= each, F.col("top"))), F.max("top")).alias("cut")))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("place", "tie"))
    near = different.join(cuts, "lang").filter(F.col("top") <= F.col("cut")).select("lang", "place", "tie")
    least = near.withColumn("nth", order).filter(F.col("nth") <= each).drop("nth")
    chosen = F.broadcast(stored(least))  # at most ``each`` rows of a language
    sample = hashed.join(chosen, ["lang", "place", "tie"]).select("lang", "place", "tie", "text").distinct()
    # Equal texts are on one side.
    held = (F.pmod(F.xxhash64("tie", F.lit("held")), F.lit(5)) == 0).alias("held")
    found = sample.select("lang", held, "text").mapInArrow(bags, "lang string, held boolean, ids binary, weights binary").toArrow()
    found = found.sort_by([("lang", "ascending"), ("ids", "ascending"), ("weights", "ascending")])
    names = found.column("lang").to_pylist()
    langs = sorted(set(names))
    return train(
        langs,
        np.array([langs.index(x) for x in names], np.int64),
        np.array(found.column("held").to_pylist(), bool),
        [np.frombuffer(x, "<u2").astype(np.int64) for x in found.column("ids").to_pylist()],
        [np.frombuffer(x, "<f4") for x in found.column("weights").to_pylist()],
    )


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` with the likeliest language, its probability and whether it is too uncertain."""
    # A tuple, as workers need not know the class.
    held = docs.sparkSession.sparkContext.broadcast((model.langs, model.table, model.layer, model.bias, model.temperature, model.reject_below))
    # Functions over Arrow batches take no names with dots; the text goes in once.
    kept = [f"c{i}" for i in range(len(docs.columns))]
    source = docs.select(*[col(c).alias("whole_text" if c == text else n) for c, n in zip(docs.columns, kept)])

    @spans.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table, layer, bias, temperature, reject_below = held.value
        pool = pa.default_memory_pool()
        for part in spans.chunked(batches, "whole_text", CHUNK_BYTES):
            texts = spans.texts_of(part.column("whole_text"))
            found, sure = spans.lettered(texts)
            words, inverse = spans.distinct(texts, found)
            bucket, owner = subwords(texts.data, words)
            grams = np.bincount(owner, minlength=len(words.start))
            n = spans.per_text(grams[inverse], found.first)
            sums = np.zeros((len(texts), table.shape[1]))
            for j in range(table.shape[1]):
                of_word = np.bincount(owner, weights=table[bucket, j], minlength=len(words.start))
                total = np.concatenate([[0.0], np.cumsum(of_word[inverse])])[found.first]
                sums[:, j] = np.diff(total) / np.maximum(n, 1)
            scores = sums @ layer + bias
            has = _has_letter(part, "whole_text", sure) & bool(langs)
            p = softmax(scores / temperature)
            best = p.argmax(1) if langs else np.zeros(len(texts), int)
            score = np.where(has, p.max(1) if langs else 0.0, 0.0)
            chosen = [langs[b] if h else UNKNOWN for b, h in zip(best, has)]
            rejected = ~has | (score < reject_below)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(chosen, pa.string()), pa.array(score), pa.array(rejected)], [*kept, *names])
            pool.release_unused()

    fields = [T.StructField(n, f.dataType) for n, f in zip(kept, docs.schema.fields)]
    added = [T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()))]
    return source.mapInArrow(run, T.StructType([*fields, *added])).toDF(*docs.columns, *names)


def languages(docs: DataFrame) -> DataFrame:
    """Every document's language, learned from the documents outside the held-out fold."""
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")  # a row without an id is not held out
    model = fit(docs.filter(F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(True))))
    rows = predict(docs.select("doc_id", held, "text"), model)
    return rows.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents whose language is certain enough."""
    model = fit(docs)
    names = tuple(unused(docs, n) for n in ("lang_pred", "lang_score", "lang_rejected"))
    return predict(docs, model, names=names).filter(~col(names[2])).select(*map(col, docs.columns))
