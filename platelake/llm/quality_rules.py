"""Quality rules whose limits come from mergeable quantile sketches per language and source.

A sketch counts documents by the value of a feature, of which it keeps the ``BITS`` leading bits: values below 1,024 are exact,
larger ones to one part in 512, and there are at most 512 counters more for each doubling, whatever the data. Counters
of sources add up to those of their language, and these to those of the corpus. There are no fixed cutoffs:

- features of ``FENCED`` (shares of characters, length of words): above the upper quartile by more than ``SPREAD`` times the distance of
  the quartiles, for which a thousandth stands where they are equal;
- features of ``TAIL`` (repeated lines and words, which most clean texts lack): above the quantile ``HIGH_PARTS``, so that at
  most one document in 200 of a group fails by each.

Limits are those of the (language, source) group if that has ``MIN_ROWS`` documents, else of the language, else of the corpus;
a corpus of fewer tells nothing, so only the base rules hold there.

Edge cases: a NULL text has no words and fails the base rules; NULL languages and sources are groups of their own; equal
rows count each; an empty table gives an empty result; columns of the input are kept, new ones get unused names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platelake.llm import spans
from platelake.llm.shared import col, stored, unused

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_ROWS = 200
SPREAD = 5
HIGH_PARTS = (199, 200)
BITS = 10
#: A task measures about so many bytes of text at once.
CHUNK_BYTES = 1 << 20

#: Features are quotients in thousandths.
FENCED = ("symbols", "marks", "capitals", "word_length")
TAIL = ("dup_lines", "repeats")
FEATURES = FENCED + TAIL

METRICS = ("n_words", "word_chars", "n_symbols", "n_marks", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_MARK = np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8))
_CAPITAL = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
_RATIOS = {
    "symbols": ("n_symbols", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "word_length": ("word_chars", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}


def _repeated(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is found twice or more in its text, and whether it was found there before."""
    with np.errstate(over="ignore"):
        own = spans.mix(keys + owner.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    same = np.zeros(len(own) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    often, again = np.empty(len(own), bool), np.empty(len(own), bool)
    often[order] = same[:-1] | same[1:]
    again[order] = same[:-1]
    return often, again


def measure_texts(texts: spans.Texts) -> dict[str, np.ndarray]:
    """The counts of ``METRICS`` for each text."""
    data, n = texts.data[: texts.size], len(texts)
    found = spans.words(texts)
    inside = ~spans.SPACE[data]
    h = spans.hashes(texts.data, found)
    grams, at, owner = spans.ngrams(h, found.first, 5)
    often, _ = _repeated(grams, owner)
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[often], 1)
    np.add.at(cover, at[often] + 5, -1)
    rows = spans.lines(texts)
    has_word = np.searchsorted(found.start, rows.start) < np.searchsorted(found.start, rows.start + rows.length)
    line_owner = rows.owner()[has_word]
    kept = spans.Spans(rows.start[has_word], rows.length[has_word], rows.first)
    _, again = _repeated(spans.hashes(texts.data, kept, seed=1), line_owner)
    return {
        "n_words": found.counts(),
        "word_chars": spans.per_text(inside & ((data & 0xC0) != 0x80), texts.offsets),
        "n_symbols": spans.per_text(_SYMBOL[data], texts.offsets),
        "n_marks": spans.per_text(_MARK[data], texts.offsets),
        "n_capitals": spans.per_text(_CAPITAL[data], texts.offsets),
        "n_lines": np.bincount(line_owner, minlength=n),
        "n_dup_lines": np.bincount(line_owner[again], minlength=n),
        "n_repeat_words": spans.per_text(np.cumsum(cover[:-1]) > 0, found.first),
    }


def measured(docs: DataFrame, into: str, text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the struct ``into`` of the counts of each whole text."""
    kept = list(docs.columns if keep is None else keep)
    counts = T.StructType([T.StructField(m, T.LongType()) for m in METRICS])
    # Functions over Arrow batches take no names with dots; the text goes in once.
    names = [f"c{i}" for i in range(len(kept))]
    others = [col(c).alias(n) for c, n in zip(kept, names) if c != text]
    rows = docs.select(*others, col(text).alias("whole_text"))

    @spans.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in spans.chunked(batches, "whole_text", CHUNK_BYTES):
            found = measure_texts(spans.texts_of(part.column("whole_text")))
            arrays = [pa.array(found[m].astype(np.int64)) for m in METRICS]
            columns = [part.column("whole_text" if c == text else n) for c, n in zip(kept, names)]
            yield pa.RecordBatch.from_arrays([*columns, pa.StructArray.from_arrays(arrays, METRICS)], [*names, "counts"])

    fields = [T.StructField(n, docs.schema[c].dataType) for c, n in zip(kept, names)]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("counts", counts)])).toDF(*kept, into)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def feature(m: Column, name: str) -> Column:
    part, whole = _RATIOS[name]
    return F.when(m[whole] > 0, F.floor(1000 * m[part] / m[whole])).otherwise(F.lit(0)).cast("long")


def bucket(value: Column) -> Column:
    """The counter of a value that is not negative: its ``BITS`` leading bits, the others zero."""
    step = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))).cast("long")
    return value - value % step


def sketches(rows: DataFrame, metrics: str, lang: str = "lang", source: str = "source") -> DataFrame:
    """Counters of all features over the documents that pass the base rules: ``lang, source, feature, value, n``."""
    m = col(metrics)
    values = F.array(*[F.struct(F.lit(f).alias("feature"), bucket(feature(m, f)).alias("value")) for f in FEATURES])
    passed = rows.filter(~base_failed(m)).select(col(lang).alias("lang"), col(source).alias("source"), F.explode(values).alias("v"))
    return passed.groupBy("lang", "source", "v.feature", "v.value").agg(F.count("*").alias("n"))


def _quantiles(counters: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles and the high quantile of each feature from merged counters, whose number is bounded."""
    merged = counters.groupBy(*keys, "feature", "value").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "feature")
    running = merged.select(
        *keys,
        "feature",
        "value",
        F.sum("n").over(group.orderBy("value")).alias("upto"),
        F.sum("n").over(group).alias("rows"),
    )

    def least(part: int, whole: int) -> Column:
        return F.min(F.when(whole * F.col("upto") >= part * F.col("rows"), F.col("value")))

    return running.groupBy(*keys, "feature").agg(
        F.struct(least(1, 4).alias("low"), least(3, 4).alias("high"), least(*HIGH_PARTS).alias("top")).alias("q"), F.max("rows").alias("rows")
    )


def limits(counters: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row for each (language, source): the limit of every feature, from the smallest group that is large enough."""
    own = _quantiles(counters, ["lang", "source"])
    of_lang = _quantiles(counters, ["lang"]).select(F.col("lang").alias("l"), F.col("feature").alias("f"), F.struct("q", "rows").alias("by_lang"))
    of_all = _quantiles(counters, []).select(F.col("feature").alias("g"), F.when(F.col("rows") >= min_rows, F.col("q")).alias("by_all"))
    joined = own.join(of_lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("feature") == F.col("f"))).join(of_all, F.col("feature") == F.col("g"))
    chosen = F.when(F.col("rows") >= min_rows, F.col("q")).when(F.col("by_lang.rows") >= min_rows, F.col("by_lang.q")).otherwise(F.col("by_all"))
    low, high, top = (F.col("c")[x] for x in ("low", "high", "top"))
    limit = F.when(F.col("feature").isin(*TAIL), top).otherwise(high + SPREAD * F.greatest(high - low, F.lit(1)))
    found = joined.select("lang", "source", "feature", chosen.alias("c")).select("lang", "source", "feature", limit.alias("limit"))
    return found.groupBy("lang", "source").agg(*[F.max(F.when(F.col("feature") == f, F.col("limit"))).alias(f"{f}_limit") for f in FEATURES])


def judged(rows: DataFrame, metrics: str, found: DataFrame, verdict: str, lang: str = "lang", source: str = "source") -> DataFrame:
    """``rows`` with the boolean ``verdict``: the base rules hold and no feature is above its group's limit."""
    names = {f: unused(rows, f"{f}_limit") for f in FEATURES}
    group_lang, group_source = unused(rows, "group_lang"), unused(rows, "group_source")
    right = found.select(
        F.col("lang").alias(group_lang), F.col("source").alias(group_source), *[F.col(f"{f}_limit").alias(names[f]) for f in FEATURES]
    )
    m = col(metrics)
    within = F.lit(True)
    for f, name in names.items():
        within = within & F.coalesce(bucket(feature(m, f)) <= F.col(name), F.lit(True))
    joined = rows.join(right, col(lang).eqNullSafe(F.col(group_lang)) & col(source).eqNullSafe(F.col(group_source)), "left")
    return joined.withColumn(verdict, ~base_failed(m) & within).drop(group_lang, group_source, *names.values())


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass. Texts are measured twice, once for the sketches and once beside the rows that leave, which
    costs less than writing or shuffling them."""
    metrics = unused(docs, "quality")
    counters = sketches(measured(docs, metrics, text, tuple(dict.fromkeys((lang, source)))), metrics, lang, source)
    found = stored(limits(stored(counters)))
    verdict = unused(docs, "verdict")
    rows = measured(docs, metrics, text)
    return judged(rows, metrics, found, verdict, lang, source).filter(col(verdict)).select(*map(col, docs.columns))


def quality_report(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document: ``doc_id``, the counts, ``base_failed`` and ``kept``."""
    rows = stored(measured(docs, "quality", keep=("doc_id", "lang", "source")))
    found = stored(limits(stored(sketches(rows, "quality"))))
    return judged(rows, "quality", found, "kept").select(
        "doc_id", "lang", "source", "quality.*", base_failed(F.col("quality")).alias("base_failed"), "kept"
    )
