import random
import re
from collections import Counter

import pyarrow as pa
from cases import SF_DIR, edge_docs, no_docs, same_as_sql
from pyspark.sql import functions as F

from platelake.llm import oracle, queries, spans
from platelake.llm import quality_rules as rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts_by_brute_force():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab \n\t#|!é,\x0b") for _ in range(rnd.choice([0, 2, 40, 600]))) for _ in range(300)] + [None, "x y z " * 50]
    found = rules.measure_texts(spans.texts_of(pa.array(texts)))
    got = list(zip(*(found[m].tolist() for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [plain(t) for t in texts]


def test_query_like_sql(spark):
    same_as_sql(spark, queries.op1_quality_rules, oracle.QUALITY_RULES, SF_DIR)


def test_limits_merge_up_to_larger_groups(spark):
    counters = spark.createDataFrame(
        [("en", "big", f, v, n) for f in rules.FEATURES for v, n in ((0, 50), (10, 50))]
        + [("en", "small", f, 500, 1) for f in rules.FEATURES]
        + [(None, None, f, 700, 1) for f in rules.FEATURES],
        "lang string, source string, feature string, value long, n long",
    )
    found = {(r["lang"], r["source"]): (r["symbols_limit"], r["repeats_limit"]) for r in rules.limits(counters, min_rows=100).collect()}
    # The large group has its own quantiles, the small one its language's, the rest those of everything.
    assert found[("en", "big")] == (10 + 5 * 10, 10)
    assert found[("en", "small")] == (10 + 5 * 10, 500)
    assert found[(None, None)] == (10 + 5 * 10, 700)
    alone = {(r["lang"], r["source"]): (r["symbols_limit"], r["repeats_limit"]) for r in rules.limits(counters, min_rows=1).collect()}
    assert alone[("en", "small")] == (500 + 5, 500) and alone[(None, None)] == (700 + 5, 700)


def test_the_high_quantile_leaves_one_in_two_hundred(spark):
    rows = [("en", "s", "dup_lines", v, 1) for v in range(1, 1001)]
    counters = spark.createDataFrame(rows, "lang string, source string, feature string, value long, n long")
    assert rules.limits(counters).first()["dup_lines_limit"] == 995


def test_counters_of_any_value(spark):
    values = [0, 1, 1023, 1024, 1025, 2047, 123_456, (1 << 40) + 12_345, (1 << 62) + 5]
    found = [r["b"] for r in spark.createDataFrame([(v,) for v in values], "v long").select(rules.bucket(F.col("v")).alias("b")).collect()]
    assert found == [v >> max(v.bit_length() - 10, 0) << max(v.bit_length() - 10, 0) for v in values]
    assert found[:3] == [0, 1, 1023] and all(v - b <= v / 512 for v, b in zip(values, found))


def test_each_feature_rejects_alone_and_limits_follow_the_group(spark):
    """Two sources, one of them full of symbols and capitals; in each a text that only one feature rejects."""
    rnd = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    plain_line = lambda: " ".join(word(rnd.randint(3, 8)) for _ in range(12))
    rich_line = lambda: " ".join(("#" if rnd.random() < 0.3 else "") + word(rnd.randint(3, 8)).capitalize() for _ in range(12))
    body = {"plain": lambda: "\n".join(plain_line() for _ in range(10)), "rich": lambda: "\n".join(rich_line() for _ in range(10))}
    rows = [(i, body[s](), "en", s) for i, s in enumerate(["plain", "rich"] * 300)]
    five = " ".join(word(5) for _ in range(5))
    half = [plain_line() for _ in range(5)]
    planted = {
        "symbols": body["plain"]() + "".join(f" {word(4)}#" for _ in range(12)),
        "marks": body["plain"]() + " what! what? no! yes! oh! why? so! then! now! who? here! there!",
        "capitals": body["plain"]().upper(),
        "word_length": " ".join(word(30) for _ in range(80)),
        "dup_lines": "\n".join("\n".join([x[:9]] * 2) for x in half) + "\n" + " ".join(plain_line() for _ in range(20)),
        "repeats": " ".join([five, plain_line(), five, *(plain_line() for _ in range(9))]),
    }
    rows += [(1000 + i, t, "en", "plain") for i, t in enumerate(planted.values())]
    rows += [(2000, planted["symbols"], "en", "rich"), (2001, body["rich"](), "en", "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = rules.measured(docs, "m")
    found = rules.limits(rules.sketches(measured, "m"))
    limit = {r["source"]: r.asDict() for r in found.collect()}
    for i, f in enumerate(planted):
        m = measured.filter(F.col("doc_id") == 1000 + i)
        values = m.select(rules.base_failed(F.col("m")).alias("base"), *[rules.bucket(rules.feature(F.col("m"), g)).alias(g) for g in rules.FEATURES]).first()
        assert not values["base"] and [g for g in rules.FEATURES if values[g] > limit["plain"][f"{g}_limit"]] == [f]
    kept = {r["doc_id"] for r in rules.quality_report(docs).filter("kept").collect()}
    assert not kept & set(range(1000, 1006)) and 2000 in kept and 2001 not in kept
    assert len(kept & set(range(600))) > 590
    assert limit["rich"]["symbols_limit"] > limit["plain"]["symbols_limit"] and limit["rich"]["capitals_limit"] > limit["plain"]["capitals_limit"]


def test_edge_rows(spark):
    docs = edge_docs(spark)
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [1, 1, 5, 6, 9]
    report = rules.quality_report(docs)
    assert report.count() == docs.count()
    assert {r["doc_id"] for r in report.filter("base_failed").collect()} == {2, 3, 4, 7, 8, None}
    assert rules.keep_good(no_docs(spark)).count() == rules.quality_report(no_docs(spark)).count() == 0
