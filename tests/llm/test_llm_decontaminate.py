import math

from cases import LONG, SF_DIR, WORDS, edge_docs, no_docs, same_as_sql
from conftest import plan_of
from pyspark.sql import functions as F

from platelake.llm import decontaminate as leaks
from platelake.llm import oracle, queries


def grams(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(docs, items):
    found = {}
    for d, text in docs:
        for i, item in items:
            k = min(5, len((item or "").split()))
            own = grams(item, k) if k else set()
            if d is not None and own and len(own & grams(text, k)) >= 0.8 * len(own):
                found[(d, i)] = (len(own & grams(text, k)), len(own))
    return found


def test_query_like_sql(spark):
    same_as_sql(spark, queries.op3_decontamination, oracle.DECONTAMINATION, SF_DIR)


def test_needed_matches():
    assert [leaks.needed_matches(n) for n in (1, 4, 5, 10, 16)] == [1, 4, 4, 8, 13]
    assert [leaks.sketch_size(c) for c in (0, 4, 5, 8)] == [16, 16, 24, 48]
    for size_class in (4, 5, 8, 20):
        k = leaks.sketch_size(size_class)
        need = leaks.needed_matches(k + 1, k)
        missed = sum(math.comb(k, m) * 0.8**m * 0.2 ** (k - m) for m in range(need))
        assert 1 < need < 0.8 * k and missed <= leaks.MISS


def test_sketches_by_size_class(spark):
    """Each class has its own sketch size and threshold; an item below the sketch size is taken whole."""
    sizes = [1, 4, 15, 16, 17, 31, 33, 63, 300, 5000]
    rows = [(n, " ".join(f"w{n}x{i}" for i in range(n + 4))) for n in sizes]
    items = spark.createDataFrame(rows, "item long, text string").select("item", leaks.word_list(F.col("text")).alias("words"))
    found = leaks.item_sketches(items).groupBy("item").agg(F.count("*").alias("k"), F.first("size_class").alias("c"), F.first("need").alias("need"), F.first("n").alias("n"))
    for r in found.collect():
        size = leaks.sketch_size(r["item"].bit_length() - 1)
        assert (r["n"], r["c"], r["k"]) == (r["item"], r["item"].bit_length() - 1, min(r["item"], size))
        assert r["need"] == leaks.needed_matches(r["item"], size)


def test_short_items(spark):
    """Items of one to four words are found as a run wherever it stands, and do not remove documents unless asked."""
    items = [(1, "Tree"), (2, "two words"), (3, "a run of"), (4, "four words in order"), (5, " \t "), (6, "not there")]
    docs = [(1, "tree"), (2, "the two  words"), (3, "here a run\nof three"), (4, "say FOUR words in order now and then"), (5, "words two"), (6, ""), (7, "four words out of order"), (8, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_item"]) for r in leaks.contained_items(table, benchmark).collect()}
    assert found == brute(docs, items) == {(1, 1): (1, 1), (2, 2): (1, 1), (3, 3): (1, 1), (4, 4): (1, 1)}
    assert leaks.keep_unseen(table, benchmark).count() == 8
    assert {r["doc_id"] for r in leaks.keep_unseen(table, benchmark, least_words=4).collect()} == {1, 2, 3, 5, 6, 7, 8}


def items_and_docs():
    long_item = " ".join(f"w{i}" for i in range(500, 900))
    changed = long_item.split()
    for i in range(0, 60, 20):
        changed[i * 5] = "other"
    items = [(1, WORDS), (2, long_item), (3, "too few words here"), (4, None), (5, WORDS.upper()), (5, "five words are just enough")]
    docs = [(10, LONG), (11, "before " + " ".join(changed) + " after"), (12, WORDS.title()), (13, WORDS[: len(WORDS) // 2]), (14, "x five words are just enough y"), (None, WORDS), (15, None), (15, ""), (12, WORDS)]
    return items, docs


def test_by_brute_force(spark, monkeypatch):
    items, docs = items_and_docs()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    expected = brute(docs, items)
    assert (10, 2) in expected and (11, 2) in expected and (14, 5) in expected and (13, 1) not in expected
    for block in (leaks.BLOCK, 7):  # in one pass, and in several
        monkeypatch.setattr(leaks, "BLOCK", block)
        found = {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_item"]) for r in leaks.contained_items(table, benchmark).collect()}
        assert found == expected


def test_no_python_and_no_shuffle_of_shingles(spark):
    items, docs = items_and_docs()
    items = spark.createDataFrame(items, "item_id long, text string").select("item_id", leaks.word_list(F.col("text")).alias("words"))
    sketches = leaks.item_sketches(items.withColumnRenamed("item_id", "item"))
    table = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", leaks.word_list(F.col("text")).alias("words"))
    plan = plan_of(leaks.candidates(table, sketches, [2]))
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def test_edge_rows(spark):
    docs = edge_docs(spark)
    benchmark = spark.createDataFrame([(1, "seven small birds watch from an old oak tree")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in leaks.contained_items(docs, benchmark).collect()) == [1, 6, 9]
    kept = leaks.keep_unseen(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "4", "5", "7", "8", "None"]
    none = benchmark.limit(0)
    assert leaks.keep_unseen(docs, none).count() == docs.count()
    assert leaks.contained_items(no_docs(spark), benchmark).count() == leaks.keep_unseen(no_docs(spark), benchmark).count() == 0
