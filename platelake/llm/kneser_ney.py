"""Quality by the perplexity of an interpolated modified Kneser-Ney model of trusted text.

Bigrams are discounted by three amounts for counts of one, two and more, estimated from the counts of counts, and
interpolated with the continuation distribution (in how many contexts a token was met), itself discounted so and interpolated with the uniform one.
Unknown tokens have a probability of their own. One trusted document in ``HELD_PART``, by a hash of its id, is held out of
training; a language's limit is the ``QUANTILE`` of the held documents' perplexities times ``MARGIN``. Languages with
fewer than ``MIN_HELD`` of them take the limit of all.

Counts of logarithms of perplexity in hundredths are a sketch that adds up over any parts of the data; quantiles are read from it.

Edge cases: NULL and empty texts have one token, the end; rows without a language are a language of their own; equal rows are counted
and scored each; without held documents nothing is rejected; an empty table gives an empty result; rows without an id are scored and never
trusted; further columns, whatever their names, are not used.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm import ngrams
from platelake.llm.shared import stored

HELD_PART = 10
QUANTILE, MARGIN, MIN_HELD = 0.995, 1.1, 100
#: Parts of many documents, of which one has its open places on disk at a time.
SLICES = 3


def discounts(of_counts: np.ndarray) -> np.ndarray:
    """Discounts by count (0, 1, 2, 3 and more) from how many n-grams have counts of one to four."""
    n1, n2, n3, n4 = (float(x) for x in of_counts)
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    third = 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2
    found = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, third]
    return np.clip(found, 0.0, [0.0, 1.0, 2.0, 3.0])


def model_tables(counts: DataFrame, known: int | None = None) -> tuple[DataFrame, np.ndarray, float]:
    """By token total, interpolation weight and continuation probability; discounts, chance of an unknown token. ``known`` tokens can follow
    (all that were met, if not given)."""
    pairs = ngrams.known_pairs(counts).filter("n > 0")
    few = {r["n"]: r["count"] for r in pairs.filter("n <= 4").groupBy("n").count().collect()}
    cut = discounts(np.array([few.get(k, 0) for k in (1, 2, 3, 4)]))
    kinds = [F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long")), F.sum((F.col("n") > 2).cast("long"))]
    back = sum((float(c) * k for c, k in zip(cut[1:], kinds)), F.lit(0.0)) / F.sum("n")
    after = pairs.groupBy(F.col("v").alias("token")).agg(F.sum("n").alias("total"), back.alias("back"))
    # A token that only follows unknown ones is known all the same.
    met = counts.filter(F.col("w").isNotNull() & (F.col("w") != ngrams.UNKNOWN)).groupBy(F.col("w").alias("token"))
    times = met.agg(F.sum((F.col("v") != ngrams.UNKNOWN).cast("long")).alias("contexts"), F.sum("n").alias("weight"))
    tokens = stored(after.join(times, "token", "full").fillna(0), brief=True)
    of_contexts = [F.sum((F.col("contexts") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    r = tokens.agg(F.count("*").alias("met"), F.sum("contexts").alias("every"), F.sum((F.col("contexts") > 2).cast("long")).alias("more"), *of_contexts).first()
    known, every = known or max(r["met"], 1), r["every"] or 0
    if every:
        low_cut = discounts(np.array([r[f"n{k}"] for k in (1, 2, 3, 4)]))
        spare = float(low_cut[1] * r["n1"] + low_cut[2] * r["n2"] + low_cut[3] * r["more"])
        less = F.element_at(F.array(*[F.lit(float(x)) for x in low_cut]), F.least(F.col("contexts"), F.lit(3)).cast("int") + 1)
        low = F.greatest(F.col("contexts") - less, F.lit(0.0)) / every + spare / every / known
    else:
        low = F.lit(1 / known)
    n, unknown = ngrams.totals(counts)
    return tokens.select("token", "weight", "total", "back", low.alias("low")), cut, (unknown + 1) / (n + 2)


def pair_losses(tables: tuple[DataFrame, np.ndarray, float]) -> ngrams.Model:
    tokens, cut, unknown = tables

    def losses(before: dict, now: dict, known_before: np.ndarray, known_now: np.ndarray, counts: Sequence[np.ndarray]) -> list[np.ndarray]:
        n, of, low = counts[0], before["total"], now["low"]
        with np.errstate(divide="ignore", invalid="ignore"):
            high = np.maximum(n - cut[np.minimum(n, 3).astype(int)], 0) / of + before["back"] * low
        p = np.where((of > 0) & known_before, high, low)
        return [-np.log(np.where(known_now, (1 - unknown) * p, unknown))]

    return ngrams.Model(tokens, ("total", "back", "low"), losses, (0,))


def limits(sketch: DataFrame, quantile: float = QUANTILE, min_held: int = MIN_HELD) -> DataFrame:
    """``of_lang, limit`` in hundredths of the logarithm of perplexity, from ``lang, value, n``; a language with too few takes all."""
    def at(rows: DataFrame, keys: list[str]) -> DataFrame:
        group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        running = rows.select(*keys, "value", F.sum("n").over(group.orderBy("value")).alias("upto"), F.sum("n").over(group).alias("rows"))
        return running.groupBy(*keys).agg(F.min(F.when(F.col("upto") >= F.ceil(quantile * F.col("rows")), F.col("value"))).alias("limit"), F.max("rows").alias("rows"))

    own = at(sketch, ["lang"])
    # Perplexities have some hundreds of different hundredths of a logarithm.
    every = at(sketch.groupBy("value").agg(F.sum("n").alias("n")), []).first()["limit"]
    return own.select(F.col("lang").alias("of_lang"), F.when(F.col("rows") >= min_held, F.col("limit")).otherwise(F.lit(every)).alias("limit"))


def perplexities(docs: DataFrame, trusted: DataFrame, name: str = "doc_id") -> DataFrame:
    """``doc_id, lang, n_tokens, perplexity, max_perplexity, trusted, kept`` of every document."""
    texts = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    ids = trusted.select(F.col(name).alias("trusted_id")).filter("trusted_id is not null").distinct()
    held = F.pmod(F.xxhash64("trusted_id"), F.lit(HELD_PART)) == 0
    learned = ngrams.with_ids(docs, ids.filter(~held), "trusted_id")
    words = None if ngrams.VOCABULARY is None else ngrams.vocabulary(learned)
    size = ngrams.text_bytes(texts)
    counts = ngrams.stored_counts(ngrams.bigram_counts(learned, words, size))
    model = pair_losses(model_tables(counts))
    found = ngrams.scored(texts, words, counts, ("n",), model, size=size, slices=SLICES, spent=[counts, model.tokens])
    marked = found.join(ids.select(F.col("trusted_id"), held.alias("held")), F.col("doc_id") == F.col("trusted_id"), "left")
    log = F.col("loss0") / (ngrams.UNIT * F.col("n_tokens"))
    rows = stored(marked.select("doc_id", "lang", "n_tokens", log.alias("log"), F.col("held").isNotNull().alias("trusted"), F.coalesce("held", F.lit(False)).alias("held")), brief=True)
    sketch = rows.filter("held").groupBy("lang", F.ceil(F.col("log") * 100).alias("value")).agg(F.count("*").alias("n"))
    found_limits = limits(sketch)
    joined = rows.join(found_limits, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    most = F.exp(F.col("limit") / 100) * MARGIN
    perplexity = F.exp("log")
    kept = F.coalesce(perplexity <= most, F.lit(True))
    return joined.select("doc_id", "lang", "n_tokens", perplexity.alias("perplexity"), most.alias("max_perplexity"), "trusted", kept.alias("kept"))
