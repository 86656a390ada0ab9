import numpy as np
import pyarrow as pa
from cases import documents, edge_docs, no_docs
from pyspark.sql import functions as F

from platelake.llm import language_id, spans


def test_held_out_accuracy(spark):
    docs = documents(spark)
    found = language_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found.held_out]
    assert len(found) == docs.count() and 0.15 < len(held) / len(found) < 0.35
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_kept_documents(spark):
    docs = documents(spark)
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns
    assert kept.count() > 0.98 * docs.count()


def test_edge_rows(spark):
    docs = edge_docs(spark)
    model = language_id.fit(docs)
    assert model.langs == ["de", "en", "fr"]
    found = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.predict(docs, model).filter(F.col("lang_pred") == "und").collect()}
    assert found == {(2, "und", 0.0), (3, "und", 0.0), (4, "und", 0.0), (7, "und", 0.0)}
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns and not {2, 3, 4, 7} & {r["doc_id"] for r in kept.collect()}


def test_nothing_to_learn(spark):
    assert language_id.languages(no_docs(spark)).count() == 0
    unlabelled = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.languages(unlabelled).collect()} == {"und"}


def test_one_language_and_softmax():
    assert np.allclose(language_id.softmax(np.array([[1.0, 1.0], [800.0, 0.0]])), [[0.5, 0.5], [1.0, 0.0]])
    one = language_id.train(["en"], np.zeros(3, int), np.zeros(3, bool), [np.array([1, 2])] * 3, [np.ones(2, "f4")] * 3)
    assert one.langs == ["en"] and one.reject_below <= 0.5


def test_sample_is_bounded_whatever_the_ids(spark, monkeypatch):
    """Rows without an id, or all of one id, neither flood the sample nor fall on one side of the split."""
    taken = {}

    def train(langs, labels, held, ids, weights):
        taken.update(langs=langs, labels=labels, held=held)
        return real(langs, labels, held, ids, weights)

    real = language_id.train
    monkeypatch.setattr(language_id, "train", train)
    monkeypatch.setattr(language_id, "EPOCHS", 1)
    monkeypatch.setattr(language_id, "SAMPLE", 200)
    docs = spark.range(6000).selectExpr(
        "case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end as doc_id",
        "concat('text number ', conv(id, 10, 26), ' of ', cast(id as string)) as text",
        "case when id % 2 = 0 then 'aa' else 'bb' end as lang",
    )
    language_id.fit(docs)
    assert taken["langs"] == ["aa", "bb"] and np.bincount(taken["labels"]).tolist() == [100, 100]
    assert 0.1 < taken["held"].mean() < 0.3


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "EPOCHS", 2)
    docs = spark.range(900).selectExpr("id as doc_id", "concat('word', cast(id % 300 as string)) as text", "concat('l', cast(id % 300 as string)) as lang")
    model = language_id.fit(docs)
    assert len(model.langs) == 300
    assert language_id.predict(docs, model).count() == 900


def test_rows_without_an_id_are_not_held_out(spark):
    found = language_id.languages(edge_docs(spark)).collect()
    assert [r["held_out"] for r in found if r["doc_id"] is None] == [False]
    assert all(r["held_out"] is not None for r in found)


def test_the_least_hashes_are_chosen_from_few_rows(spark, monkeypatch):
    """The cut by the front of the hash keeps exactly the rows that a full sort would choose."""
    kept = {}

    def train(langs, labels, held, ids, weights):
        kept["n"] = sorted(int(i.sum()) for i in ids)
        return real(langs, labels, held, ids, weights)

    real = language_id.train
    monkeypatch.setattr(language_id, "train", train)
    monkeypatch.setattr(language_id, "EPOCHS", 1)
    monkeypatch.setattr(language_id, "SAMPLE", 60)
    docs = documents(spark).unionByName(documents(spark))
    found = []
    for bits in (1, 8, 16):
        monkeypatch.setattr(language_id, "TOP_BITS", bits)
        language_id.fit(docs)
        found.append(kept["n"])
    assert found[0] == found[1] == found[2] and len(found[0]) == 60


def test_scores_by_plain_python(spark):
    """Whole texts scored gram by gram, without words, batches or hashing of words."""
    docs = documents(spark).filter("doc_id % 25 = 0").union(edge_docs(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    model = language_id.fit(documents(spark))

    def plain(text):
        texts = spans.texts_of(pa.array([text]))
        found, _ = spans.lettered(texts)
        total, n = np.zeros(model.table.shape[1]), 0
        for start, length in zip(found.start, found.length):
            word = b" " + texts.data[start : start + length].tobytes() + b" "
            for size in language_id.GRAMS:
                for i in range(len(word) - size + 1):
                    gram = int.from_bytes(word[i : i + size], "little") | size << 56
                    bucket = int(spans.mix(np.array([gram], np.uint64))[0] >> np.uint64(17)) % language_id.BUCKETS
                    total += model.table[bucket]
                    n += 1
        return language_id.softmax(((total / max(n, 1)) @ model.layer + model.bias)[None] / model.temperature)[0]

    for r in language_id.predict(docs, model).filter("length(text) < 3000").collect():
        if r["lang_pred"] == "und":
            assert r["score"] == 0
        else:
            p = plain(r["text"])
            assert r["lang_pred"] == model.langs[p.argmax()] and abs(p.max() - r["score"]) < 1e-4
