import numpy as np
import pyarrow as pa
import pytest
from cases import edge_docs, no_docs

from platelake.llm import queries, spans, toxicity


def test_held_out_quality(spark):
    found = queries.op9_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    assert len(found) == 10_000 and found.score.between(0, 1).all()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = found.merge(labels, on="doc_id").query("held_out")
    right = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert right / held.predicted.sum() > 0.95 and right / held.toxic.sum() > 0.85


def test_terms_of_a_word():
    texts = spans.texts_of(pa.array(["moron fool!"]))
    found, _ = spans.lettered(texts)
    terms, owner = toxicity.packed_terms(texts.data, found)
    got = {(toxicity.term_text(int(t)), int(o)) for t, o in zip(terms, owner)}
    assert got == {((b"mor", False), 0), ((b"moro", False), 0), ((b"moron", True), 0), ((b"foo", False), 1), ((b"fool", True), 1)}


def test_counts_and_frequent_terms():
    mor = int.from_bytes(b"mor", "little") | 3 << 56
    terms = np.array([mor, mor | int(toxicity.OFTEN)], np.uint64)
    seen, n_words = toxicity.look(spans.texts_of(pa.array(["moron more moral", "mor", "moron " + "x " * 2000, None])), np.sort(terms))
    assert n_words.tolist() == [3, 1, 2001, 0]
    assert seen.tolist() == [[3, 3], [0, 0], [1, 0], [0, 0]]


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    good = np.where(rng.random(4000) < 0.95, truth, ~truth)
    weak = np.where(rng.random(4000) < 0.7, truth, ~truth)
    cast = np.column_stack([np.where(v, 1, -1) for v in (good, weak, weak)])
    given = np.where(rng.random(4000) < 0.9, truth, ~truth).astype(int)
    posterior, accuracy, left = toxicity.label_model(cast, given)
    assert ((posterior > 0.5) == truth).mean() > 0.95
    assert accuracy[0] > accuracy[1] and left[1, 2] > 0.9 > abs(left[0, 1])


def test_voters_that_the_classes_explain_are_not_copies():
    given = np.array([1] * 60 + [0] * 540)
    right = np.where(given == 1, 1, -1)
    cast = np.column_stack([right, right, np.where(given == 1, 1, 0), *[np.zeros(600, int)] * 60, np.full(600, -1)])
    posterior, accuracy, left = toxicity.label_model(cast, given)
    assert posterior[:60].min() > 0.95 and posterior[60:].max() < 0.05 and accuracy[0] > 0.95


def test_linear_fit():
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=2000), np.ones(2000)])
    w = toxicity.linear_fit(x, 1 / (1 + np.exp(-(2 * x[:, 0] - 1))))
    assert w == pytest.approx([2, -1], abs=0.05)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (9, 1, None), (6, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert found.count() == docs.count() and found.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.toxicity(no_docs(spark), labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_toxic_words_beyond_any_list_count(spark):
    """Rare toxic words behind many common ones, and more families than voters: a text with any of them scores above every clean one."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    common = ["c" + "".join(rng.choice(letters, 6)) for _ in range(300)]
    bad = [f"{a}{b}zz" for a in "qwxyz" for b in letters[:20]]
    say = lambda n, *more: " ".join([*rng.choice(common, n), *more])
    rows = [(i, say(40, *(bad[(i + 17 * k) % 100] for k in range(6))), 1) for i in range(100)] + [(i, say(40), 0) for i in range(100, 2000)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    asked = [(i, say(40, *(bad[(i + 13 * k) % 100] for k in range(6)))) for i in range(100)] + [(i, say(40)) for i in range(100, 200)]
    found = toxicity.score(spark.createDataFrame(asked, "doc_id long, text string"), model).toPandas().set_index("doc_id").score
    assert found[found.index < 100].min() > found[found.index >= 100].max()
    assert found[found.index < 100].min() > toxicity.TOXIC_FROM


def test_rows_without_an_id_are_not_held_out(spark):
    labels = spark.createDataFrame([(1, 1), (6, 0)], "doc_id long, toxic int")
    found = toxicity.toxicity(edge_docs(spark), labels).collect()
    assert [r["held_out"] for r in found if r["doc_id"] is None] == [False] and all(r["held_out"] is not None for r in found)


def test_whole_words_of_any_length(spark):
    """A word of one or two letters, and long words that differ only behind byte 7, are told apart."""
    texts = spans.texts_of(pa.array(["a zq considerate considerable"]))
    found, _ = spans.lettered(texts)
    terms, owner = toxicity.packed_terms(texts.data, found)
    head = toxicity.heads(texts.data, found, terms, owner)
    whole = {int(o): toxicity.term_text(int(t), int(h))[0] for t, o, h in zip(terms, owner, head) if int(t) >> 63}
    assert whole[0] == b"a" and whole[1] == b"zq" and whole[2][:7] == whole[3][:7] == b"conside" and whole[2] != whole[3]
    rng = np.random.default_rng(4)
    say = lambda *more: " ".join([*(f"c{w}" for w in rng.integers(0, 200, 30)), *more])
    for bad, fine in (("zq", "qz"), ("considerhate", "considerable")):
        rows = [(i, say(bad), 1) for i in range(60)] + [(i, say(fine), 0) for i in range(60, 600)]
        table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        assert len(toxicity.lexicon(table).terms) == 1
        model = toxicity.fit(table)
        asked = spark.createDataFrame([(1, say(bad)), (2, say(fine)), (3, say())], "doc_id long, text string")
        got = {r["doc_id"]: r["score"] for r in toxicity.score(asked, model).collect()}
        assert got[1] >= toxicity.TOXIC_FROM > max(got[2], got[3])


def test_families_of_long_words():
    """A long word belongs to the family of a beginning that passed before it; two long words without one are families of their own."""
    texts = spans.texts_of(pa.array(["considerhate considerable"]))
    found, _ = spans.lettered(texts)
    terms, owner = toxicity.packed_terms(texts.data, found)
    head = toxicity.heads(texts.data, found, terms, owner)
    hashed = head > 0
    alone = toxicity.arranged(terms[hashed], np.array([9.0, 8.0]), head[hashed])
    assert alone.counted.tolist() == [True, True]
    begin = np.array([int.from_bytes(b"con", "little") | 3 << 56], np.uint64)
    joined = toxicity.arranged(np.concatenate([begin, terms[hashed]]), np.array([10.0, 9.0, 8.0]), np.append(np.zeros(1, np.uint64), head[hashed]))
    assert joined.counted.sum() == 1
