import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import documents, edge_docs, no_docs

from platelake.llm import cross_entropy, kneser_ney, ngrams

UNIT = re.compile(r"[a-z]+|[0-9]|[^\sa-z0-9]+")


def tokens(text):
    return UNIT.findall((text or "").lower())


def pairs(text, known):
    ids = ["<edge>", *[t if t in known else None for t in tokens(text)], "<edge>"]
    return list(zip(ids[:-1], ids[1:]))


TEXTS = [
    (1, "en", "the cat sat on the mat . the cat ran"),
    (2, "en", "the dog sat on the cat . a dog ran home"),
    (3, "en", "the cat sat , the dog sat , a cat ran"),
    (4, "de", "die katze sass auf der matte . die katze lief"),
    (5, "en", "never seen words stand here"),
    (6, "en", ""),
    (7, None, None),
    (8, "en", "the cat sat on the mat . the cat ran"),
]


def corpus(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, lang string, text string")


@pytest.fixture(params=["head", "shards"])
def small_head(request, monkeypatch):
    """Both ways of settling a bigram."""
    if request.param == "shards":
        monkeypatch.setattr(ngrams, "HEAD", 3)
        monkeypatch.setattr(ngrams, "SHARD_ROWS", 5)


def test_cross_entropy_by_brute_force(spark, small_head):
    known = {t for _, _, x in TEXTS for t in tokens(x)}
    counts = [Counter(), Counter()]
    for i, _, x in TEXTS:
        found = pairs(x, known)
        counts[1].update(found)
        if i in (1, 3):
            counts[0].update(found)

    def loss(c, text):
        total = sum(c.values())
        times, after, kinds = Counter(), Counter(), Counter()
        for (v, w), n in c.items():
            times[w] += n
            after[v] += n
            kinds[v] += 1
        chance = 1 / (total + 2)
        out = 0.0
        for v, w in pairs(text, known):
            one = (times[w] + 1) / (total + len(known) + 1)
            p = (c[v, w] + kinds[v] * one) / (after[v] + kinds[v]) if after[v] else one
            out -= math.log((1 - chance) * p)
        return out / len(pairs(text, known))

    ids = spark.createDataFrame([(1,), (3,), (99,), (None,)], "doc_id long")
    found = {r["doc_id"]: r for r in cross_entropy.scores(corpus(spark), ids).collect()}
    assert len(found) == len(TEXTS)
    for i, _, x in TEXTS:
        target, background = (loss(c, x) for c in counts)
        assert found[i]["n_tokens"] == len(tokens(x)) + 1
        assert found[i]["target_loss"] == pytest.approx(target, abs=1e-5)
        assert found[i]["background_loss"] == pytest.approx(background, abs=1e-5)
        assert found[i]["score"] == pytest.approx(target - background, abs=1e-5)


def plain_discounts(counts):
    n = [sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)]
    return kneser_ney.discounts(np.array(n))


def test_kneser_ney_by_brute_force(spark, small_head):
    learned = [x for i, _, x in TEXTS if i != 5]
    known = {t for x in learned for t in tokens(x)}
    counts = Counter(p for x in learned for p in pairs(x, known))
    cut = plain_discounts(counts.values())
    contexts = Counter(w for _, w in counts)
    low_cut = plain_discounts(contexts.values())
    every = sum(contexts.values())
    size = len(known) + 1
    spare = sum(low_cut[min(c, 3)] for c in contexts.values()) / every
    low = {w: max(contexts[w] - low_cut[min(contexts[w], 3)], 0) / every + spare / size for w in known | {"<edge>"}}
    assert sum(low.values()) == pytest.approx(1)
    chance = 1 / (sum(counts.values()) + 2)

    def probability(v, w):
        if w is None:
            return chance
        of = sum(n for (a, _), n in counts.items() if a == v)
        if v is None or not of:
            return (1 - chance) * low[w]
        back = sum(cut[min(n, 3)] for (a, _), n in counts.items() if a == v) / of
        n = counts[v, w]
        return (1 - chance) * (max(n - cut[min(n, 3)], 0) / of + back * low[w])

    for v in [*known, "<edge>", None]:
        assert sum(probability(v, w) for w in [*known, "<edge>", None]) == pytest.approx(1)

    rows = spark.createDataFrame([(x,) for x in learned], "text string")
    words = ngrams.vocabulary(rows)
    table = ngrams.bigram_counts(rows, words)
    found = ngrams.scored(corpus(spark), words, table, ("n",), kneser_ney.pair_losses(kneser_ney.model_tables(table, len(words) + 1)))
    got = {r["doc_id"]: r["loss0"] / ngrams.UNIT for r in found.collect()}
    for i, _, x in TEXTS:
        assert got[i] == pytest.approx(-sum(math.log(probability(*p)) for p in pairs(x, known)), abs=1e-4)


def test_small_vocabulary_leaves_unknown_tokens(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "VOCABULARY", 4)
    words = ngrams.vocabulary(corpus(spark))
    assert len(words) == 4
    counts = {r["key"]: r["n"] for r in ngrams.bigram_counts(corpus(spark), words).collect()}
    every = sum(len(tokens(x)) + 1 for _, _, x in TEXTS)
    top = {w for w, _ in sorted(Counter(t for _, _, x in TEXTS for t in tokens(x)).items(), key=lambda p: -p[1])[:4]}
    assert counts[ngrams.ALL_TOKENS] == every
    assert counts[ngrams.UNKNOWN_TOKENS] <= every - 8 - sum(1 for _, _, x in TEXTS for t in tokens(x) if t in top) + 3


def test_discounts():
    assert kneser_ney.discounts(np.array([100, 50, 30, 20])).tolist() == pytest.approx([0, 0.5, 2 - 1.5 * 30 / 50, 3 - 2 * 20 / 30])
    assert kneser_ney.discounts(np.array([3, 0, 0, 0])).tolist() == [0, 0.5, 0.5, 0.5]


def test_limits_by_language(spark):
    rows = [("en", v, 1) for v in range(1, 201)] + [("de", 500, 5)]
    found = {r["of_lang"]: r["limit"] for r in kneser_ney.limits(spark.createDataFrame(rows, "lang string, value long, n long"), 0.9, 100).collect()}
    assert found == {"en": 180, "de": 185}


def test_perplexity_tells_junk(spark):
    docs = documents(spark)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = kneser_ney.perplexities(docs, labels.filter("quality = 1").select("doc_id")).join(labels, "doc_id").toPandas()
    assert found[found.quality == 1].kept.mean() > 0.99
    assert found[found.quality == 0].perplexity.median() > 2 * found[found.quality == 1].perplexity.median()


@pytest.mark.parametrize("operator", [cross_entropy.scores, kneser_ney.perplexities])
def test_edge_rows(spark, operator):
    docs = edge_docs(spark)
    ids = spark.createDataFrame([(1,), (5,), (9,)], "doc_id long")
    found = operator(docs, ids).toPandas()
    assert len(found) == docs.count() if operator is cross_entropy.scores else found.doc_id.notna().sum() == docs.count() - 1
    assert operator(no_docs(spark), ids).count() == 0
    assert operator(docs, ids.limit(0)).count() == docs.count()


@pytest.mark.parametrize("operator", [cross_entropy.scores, kneser_ney.perplexities])
def test_rows_without_an_id_and_clashing_columns(spark, operator):
    rows = [(1, "one two three four", "en"), (2, "one two five", "en"), (None, "one two six", "en"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = spark.createDataFrame([(1,), (None,)], "doc_id long")
    clashing = docs.selectExpr("*", "1 as key", "2 as v", "3 as w", "4 as n", "5 as wanted", "6 as loss0", "7 as trusted_id", "8 as `a.b`")
    found = [sorted(map(repr, operator(d, ids).collect())) for d in (docs, clashing)]
    assert found[0] == found[1] and len(found[0]) == 4
    if operator is kneser_ney.perplexities:
        assert {(r["doc_id"], r["trusted"]) for r in operator(docs, ids).collect()} == {(1, True), (2, False), (None, False)}


def test_rare_words_are_counted_and_told_apart(spark, monkeypatch):
    """More different words than any list held: all are counted, and one rare word more or less changes a document's loss."""
    monkeypatch.setattr(ngrams, "HEAD", 1000)
    monkeypatch.setattr(ngrams, "SHARD_ROWS", 10_000)
    name = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(40_000)]
    rows = [(i, "en", " ".join(name[100 * i : 100 * i + 100])) for i in range(400)]
    rows += [(400, "en", f"{name[39_999]} {name[0]}"), (401, "en", f"{name[39_998]} {name[39_999]}")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    counts = ngrams.bigram_counts(docs, ngrams.vocabulary(docs))
    assert ngrams.totals(counts) == (40_000 + 400 + 4 + 2, 0)
    assert counts.filter("key >= 0").count() == 400 * 101 + 4
    target = spark.createDataFrame([(399,)], "doc_id long")
    found = {r["doc_id"]: r["score"] for r in cross_entropy.scores(docs, target).collect()}
    assert found[399] < found[401] < found[400] < found[0]


def test_groups_follow_the_scored_documents(spark, monkeypatch):
    """Few trusted texts, many documents: the places beyond the head are dealt over salts, and no shard takes the documents' own data."""
    monkeypatch.setattr(ngrams, "HEAD", 3)
    monkeypatch.setattr(ngrams, "TASK_BYTES", 1000)
    docs = spark.range(600).selectExpr("id as doc_id", "'en' as lang", "concat('word', char(97 + id % 20), ' and then ', char(97 + id % 7)) as text").repartition(6)
    groups = []
    real = ngrams.F.sequence

    def sequence(first, last, *step):
        groups.append(spark.range(1).select(last).first()[0] + 1)
        return real(first, last, *step)

    monkeypatch.setattr(ngrams.F, "sequence", sequence)
    found = kneser_ney.perplexities(docs, spark.createDataFrame([(1,), (2,)], "doc_id long"))
    assert found.count() == 600
    assert max(groups) >= 9


def test_words_beyond_the_head(spark, monkeypatch):
    """Losses are the same where a token's numbers are sent to tasks and where they are joined."""
    def found():
        ids = spark.createDataFrame([(1,), (3,)], "doc_id long")
        return [sorted(map(tuple, operator(corpus(spark), ids).drop("lang", "max_perplexity", "kept").collect())) for operator in (cross_entropy.scores, kneser_ney.perplexities)]

    expected = found()
    monkeypatch.setattr(ngrams, "WORD_HEAD", 3)
    monkeypatch.setattr(ngrams, "HEAD", 2)
    monkeypatch.setattr(ngrams, "SHARD_ROWS", 5)
    assert found() == expected


def test_rare_words_take_no_second_count(spark, monkeypatch):
    """The background has all bigrams of the scored documents, so those of rare words are taken from it."""
    calls = []
    real = ngrams.bigram_rows

    def bigram_rows(*args, **named):
        calls.append(args)
        return real(*args, **named)

    monkeypatch.setattr(ngrams, "bigram_rows", bigram_rows)
    monkeypatch.setattr(ngrams, "WORD_HEAD", 3)
    assert cross_entropy.scores(corpus(spark), spark.createDataFrame([(1,), (3,)], "doc_id long")).count() == len(TEXTS)
    assert len(calls) == 1


def test_counts_are_written_in_order_without_keys_and_shuffles_go(spark):
    rows = spark.range(3000).selectExpr("concat_ws(' ', 'the', char(97 + id % 20), char(97 + id % 23), 'end') as text").repartition(5)
    counts = ngrams.bigram_counts(rows)
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {n for n in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in n}

    before = shuffles()
    found = ngrams.stored_counts(counts)
    assert shuffles() <= before
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, counts.collect()), key=repr)
    for path in found.inputFiles():
        held = spark.read.parquet(path)
        assert held.columns == ["v", "w", "n"]
        own = [r["v"] for r in held.collect()]
        assert own == sorted(own)


def test_filter_of_hashes_misses_none(spark):
    hashes = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 3000)
    words = ngrams._filter_words(spark.createDataFrame([(int(h),) for h in hashes[:1000]], "token long"), "token", 1000)
    hit = ngrams._may_be_in(hashes, words)
    assert hit[:1000].all() and hit[1000:].mean() < 0.1


def test_packed_counts_are_those_of_single_rows(spark):
    rows = spark.range(3000).selectExpr("concat_ws(' ', 'the', char(97 + id % 20), char(97 + id % 23), 'end') as text", "id % 3 = 0 as good").repartition(5)
    packed = ngrams.bigram_rows(rows, marked="good", shards=4)
    assert packed.count() <= 5 * (4 + 1)
    single = ngrams.bigram_rows(rows, marked="good").groupBy("v", "w").agg({"n_marked": "sum", "n": "sum"}).select("v", "w", "sum(n_marked)", "sum(n)")
    found = ngrams.grouped(packed)
    assert found.columns == ["key", "v", "w", "n_marked", "n"]
    assert sorted(map(tuple, found.drop("key").collect()), key=repr) == sorted(map(tuple, single.collect()), key=repr)
    assert ngrams.totals(found) == (3000 * 5, 0) and found.filter("key >= 0 and w is null").count() == 0


def test_large_counts_and_numbers_are_packed_whole():
    for values in ([], [0], [127, -128], [128], [40_000, 1], [1 << 33, -5], [(1 << 63) - 1, -(1 << 63)]):
        held = pa.array([ngrams._narrow(np.array(values, np.int64)), ngrams._narrow(np.array([7], np.int64))])
        assert ngrams._wide(held, [len(values), 1]).tolist() == [*values, 7]


@pytest.mark.parametrize("low, high, n", [(-(1 << 63), (1 << 63) - 1, 5000), (0, (1 << 63) - 1, 5000), (0, 100_000, 5000), (-5, 5, 4), (0, 9, 0)])
def test_places_of_sorted_keys(low, high, n):
    rng = np.random.default_rng(n)
    held = np.unique(rng.integers(low, high, n))
    asked = np.concatenate([held, rng.integers(low, high, 3000), [-(1 << 63), (1 << 63) - 1, 0, 1, -1]])
    at, has = ngrams.Sorted(held).look_up(asked)
    assert has.tolist() == np.isin(asked, held).tolist()
    assert (held[at[has]] == asked[has]).all()


def test_entries_and_answers_are_packed_and_parts_take_turns(spark, monkeypatch):
    """Neither an entry nor a document with a shard is a row, a part of the documents is settled before the next, and spent tables go."""
    rows = [(i if i % 10 else None, "en", f"a{chr(97 + i % 26)} b{chr(97 + i % 23)} c{chr(97 + i % 19)} end") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    ids = docs.filter("doc_id % 2 = 1").select("doc_id").distinct()

    def found(operator):
        return sorted(map(tuple, operator(docs, ids).drop("max_perplexity", "kept").collect()), key=repr)

    operators = (cross_entropy.scores, kneser_ney.perplexities)
    expected = [found(operator) for operator in operators]
    monkeypatch.setattr(ngrams, "HEAD", 3)
    monkeypatch.setattr(ngrams, "SHARD_ROWS", 100)
    monkeypatch.setattr(ngrams, "TASK_BYTES", 2000)
    written, gone = [], []
    real, drop = ngrams.stored, ngrams.dropped

    def stored(df, *args, **named):
        written.append(real(df, *args, **named))
        return written[-1]

    def dropped(*tables):
        gone.extend(path for df in tables for path in df.inputFiles())
        drop(*tables)

    monkeypatch.setattr(ngrams, "stored", stored)
    monkeypatch.setattr(ngrams, "dropped", dropped)
    assert [found(operator) for operator in operators] == expected
    packed = [df for df in written if "shard" in df.columns]
    assert len(packed) == 2
    assert sum("n_tokens" in df.columns for df in written) == kneser_ney.SLICES
    assert packed[0].agg({"rows": "sum"}).first()[0] > 5 * packed[0].count() > 0
    files = spark._jvm.org.apache.hadoop.fs.Path
    assert gone and not any(files(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(files(p)) for p in gone)
