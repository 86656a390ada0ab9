"""Cross-entropy difference of a target and a background model.

Both are interpolated bigram models with Witten-Bell weights over all words of the corpus, counted in the same way; the target over
documents of the wanted kind, the background over all. A document's score is the mean over its tokens (the end included) of the target's
loss less the background's: below zero, the text is more like the target than the corpus is. Counts cover all documents,
and the bigrams of all documents are joined with them.

Edge cases: NULL and empty texts have one token, the end; a target without documents knows no bigram; equal rows
are counted and scored each; a target id that no document has is without effect; an empty table gives an empty result; rows without an id belong to
the background only, and are scored; further columns, whatever their names, are not used.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm import ngrams
from platelake.llm.shared import stored

MODELS = ("target", "background")


def _model(counts: DataFrame) -> ngrams.Model:
    """What the losses of both models need beside the bigram's count, by token: how often and by how many others it is followed, how often met."""
    seen = ngrams.known_pairs(counts)
    names = [f"{m}_{c}" for m in MODELS for c in ("after", "kinds", "times")]
    followed = [c for m in MODELS for c in (F.sum(m).alias(f"{m}_after"), F.sum((F.col(m) > 0).cast("long")).alias(f"{m}_kinds"))]
    after = seen.groupBy(F.col("v").alias("token")).agg(*followed)
    # A token that only follows unknown ones is known all the same.
    met = counts.filter(F.col("w").isNotNull() & (F.col("w") != ngrams.UNKNOWN)).groupBy(F.col("w").alias("token"))
    times = met.agg(*[F.sum(F.when(F.col("v") != ngrams.UNKNOWN, F.col(m)).otherwise(0)).alias(f"{m}_times") for m in MODELS])
    tokens = stored(after.join(times, "token", "full").fillna(0).select("token", F.col("background_times").alias("weight"), *names), brief=True)
    sums = tokens.agg(F.count("*").alias("known"), *[F.coalesce(F.sum(f"{m}_times"), F.lit(0)).alias(m) for m in MODELS]).first()
    every = {m: sums[m] + sums["known"] for m in MODELS}
    chance = {m: (unknown + 1) / (n + 2) for m in MODELS for n, unknown in [ngrams.totals(counts, m)]}

    def losses(before: dict, now: dict, known_before: np.ndarray, known_now: np.ndarray, counts: Sequence[np.ndarray]) -> list[np.ndarray]:
        out = []
        for m, n in zip(MODELS, counts):
            kinds, one = before[f"{m}_kinds"], (now[f"{m}_times"] + 1) / max(every[m], 1)
            total = before[f"{m}_after"] + kinds
            with np.errstate(divide="ignore", invalid="ignore"):
                both = np.where(total > 0, (n + kinds * one) / total, one)
            p = np.where(known_now, (1 - chance[m]) * np.where(known_before, both, one), chance[m])
            out.append(-np.log(p))
        return out

    # All bigrams are in the background, so one without an entry was met once and not in the target.
    return ngrams.Model(tokens, names, losses, (0, 1))


def scores(docs: DataFrame, target_ids: DataFrame, name: str = "doc_id") -> DataFrame:
    """``doc_id, lang, n_tokens, target_loss, background_loss, score`` of every document (losses are means in nats)."""
    texts = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    words = None if ngrams.VOCABULARY is None else ngrams.vocabulary(texts)
    size = ngrams.text_bytes(texts)
    marked = ngrams.bigram_rows(ngrams.with_mark(docs, target_ids, name, "wanted"), words, marked="wanted", shards=ngrams.count_shards(size))
    counts = ngrams.stored_counts(ngrams.grouped(marked.withColumnsRenamed({"n_marked": "target", "n": "background"})))
    model = _model(counts)
    found = ngrams.scored(texts, words, counts, MODELS, model, covered=True, size=size, spent=[counts, model.tokens])
    mean = [(F.col(f"loss{i}") / (ngrams.UNIT * F.col("n_tokens"))).alias(f"{m}_loss") for i, m in enumerate(MODELS)]
    difference = ((F.col("loss0") - F.col("loss1")) / (ngrams.UNIT * F.col("n_tokens"))).alias("score")
    return found.select("doc_id", "lang", "n_tokens", *mean, difference)
