import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents, edge_docs, no_docs
from tokenizers import Tokenizer

from platelake.llm import bit_packing as bits
from platelake.llm import packing, queries, spans, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(texts):
    found = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, 1], "<u4") for e in found]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    rnd = random.Random(2)
    lengths = np.array(sorted((rnd.randint(1, 100) for _ in range(3000)), reverse=True))
    for documents_most, attention in ((1000, 10_000), (3, 10_000), (1000, 2_500)):
        capacity = packing.Capacity(100, documents_most, attention, rule=rule)
        own = np.minimum(lengths, capacity.longest)
        where = packing.best_fit(own, capacity)
        for limit, weight in ((100, own), (documents_most, np.ones(len(own))), (attention, own * own)):
            assert np.bincount(where, weights=weight).max() <= limit
        least = max(own.sum() / 100, len(own) / documents_most, (own * own).sum() / attention)
        assert where.max() + 1 <= 1.35 * least + 1 if documents_most == 1000 else where.max() + 1 <= 2 * least


def test_best_fit_prefers_the_fullest_sequence():
    capacity = packing.Capacity(10, 10, 100)
    where = packing.best_fit(np.array([7, 6, 3]), capacity)
    assert where.tolist() == [0, 1, 0]
    assert packing.best_fit(np.array([], int), capacity).tolist() == []


def checked(rows, texts, longest=4096):
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    for doc_id, ids in texts:
        own = sorted(by_id[doc_id], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own] == [
            (k, s, min(longest, len(ids) - s), zlib.crc32(ids[s : s + longest])) for k, s in enumerate(range(0, len(ids), longest))
        ]
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= longest
    return len(sequences)


def test_query_by_brute_force(spark):
    rows = documents(spark).select("doc_id", "text").collect()
    ids = plain_ids([r["text"] for r in rows])
    n = checked(queries.op5_best_fit_packing(spark, "/root/testdata/sf0.01").collect(), [(r["doc_id"], i) for r, i in zip(rows, ids)])
    assert n <= 1.02 * -(-sum(map(len, ids)) // 4096) + 1


def test_groups_and_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 100)
    docs = documents(spark).limit(300)
    rows = packing.packed(docs, PATH, packing.Capacity(512, 50, 512 * 512), with_ids=True).collect()
    texts = docs.collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4")) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in rows)
    assert len({r["sequence_id"] >> 32 for r in rows}) > 3
    assert sum(r["length"] for r in rows) == sum(map(len, plain_ids([r["text"] for r in texts])))


def test_packing_edge_rows(spark):
    docs = edge_docs(spark)
    rows = packing.packed(docs, PATH).collect()
    assert sorted(r["length"] for r in rows if r["doc_id"] in (2, 3, 4)) == [1, 1, 1]
    assert len([r for r in rows if r["doc_id"] == 1]) == 2 and any(r["doc_id"] is None for r in rows)
    assert len([r for r in rows if r["doc_id"] == 5]) > 10
    assert packing.packed(no_docs(spark), PATH).count() == 0


@pytest.mark.parametrize("width", [1, 2, 7, 16, 17, 31, 32])
def test_pack_round_trip(width):
    rnd = np.random.default_rng(width)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rnd.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        packed = bits.pack(ids, width)
        assert len(packed) == -(-n // 64) * 8 * width
        assert np.array_equal(bits.unpack(packed, width, n), ids)


def test_bits_for():
    assert [bits.bits_for(v) for v in (1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_image_random_access(monkeypatch):
    monkeypatch.setattr(bits, "BLOCK", 256)
    rnd = np.random.default_rng(1)
    ids = rnd.integers(0, 49_408, 5000).astype(np.uint32)
    image = bits.Image(bits.to_image(np.array([5, 9]), np.array([0, 2000, 5000]), ids, 16))
    assert image.doc_ids.tolist() == [5, 9] and image.offsets.tolist() == [0, 2000, 5000]
    for a, b in ((0, 5000), (255, 257), (256, 512), (4999, 9000), (10, 10), (0, 1)):
        assert np.array_equal(image.ids_between(a, b), ids[a:b])
    with pytest.raises(ValueError, match="bits"):
        bits.to_image(np.array([1]), np.array([0, 1]), np.array([70_000]), 16)
    with pytest.raises(ValueError, match="image"):
        bits.Image(b"x" * 64)


def test_written_and_read_like_the_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(bits, "IMAGE_IDS", 20_000)
    monkeypatch.setattr(spans.chunked, "__defaults__", (1 << 16,))
    docs = documents(spark)
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    ids = plain_ids([r["text"] for r in rows])
    images = bits.written(docs, PATH, queries.VOCABULARY)
    assert images.count() > 8
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in bits.read_documents(images).collect()}
    start = 0
    for r, i in zip(rows, ids):
        assert found[r["doc_id"]] == (start, len(i), zlib.crc32(i))
        start += len(i)


def test_bit_packing_edge_rows(spark):
    docs = edge_docs(spark)
    found = bits.read_documents(bits.written(docs, PATH, queries.VOCABULARY)).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert [r["n_tokens"] for r in found if r["doc_id"] in (2, 3, 4)] == [1, 1, 1]
    ends = [r["start"] + r["n_tokens"] for r in found]
    assert [r["start"] for r in found] == [0, *ends[:-1]]
    assert bits.read_documents(bits.written(no_docs(spark), PATH, queries.VOCABULARY)).count() == 0


def test_binding_capacities_over_a_whole_table(spark):
    """Documents and attention limit sequences of a run, and no sequence exceeds either."""
    docs = documents(spark)
    tight = packing.Capacity(4096, 8, 1024 * 1024)
    found = packing.packed(docs, queries.TOKENIZER, tight).toPandas()
    assert set(found.doc_id) == {r["doc_id"] for r in docs.select("doc_id").collect()}
    each = found.assign(square=found.length ** 2).groupby("sequence_id").agg(tokens=("length", "sum"), documents=("length", "size"), attention=("square", "sum"))
    assert (each.tokens <= 4096).all() and (each.documents <= 8).all() and (each.attention <= 1024 * 1024).all()
    assert (each.documents == 8).any() and (each.attention > 1000 * 1000).any()
    loose = packing.packed(docs, queries.TOKENIZER).toPandas()
    assert each.shape[0] > loose.sequence_id.nunique()


def test_rows_of_one_id_lie_in_several_tasks(spark):
    docs = spark.range(4000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "concat('text number ', id) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        images = bits.written(docs, PATH, queries.VOCABULARY)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = {r["part"] for r in images.collect() if 7 in bits.Image(bytes(r["image"])).doc_ids}
    assert len(parts) >= 2
    found = bits.read_documents(images).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted(r["doc_id"] for r in found) and len(found) == 4000


def test_units_in_blocks_like_units_alone(monkeypatch):
    texts = ["it's a don't <|endoftext|> x|y 3.14 --- ***", "日本語 テキスト é è ñandú Ünïcode ÀÉ", "a" * 3000, "٣٤ ½ ² ﬁ İstanbul", "\u0301x \u200b y\u200dz 🙂👍🏽", "“quoted” – dash… £5 10€"]
    expected = [i.tobytes() for i in plain_ids(texts * 3)]
    for size in (1, 2, 7, 512):
        monkeypatch.setattr(tokens, "BLOCK", size)
        ids, offsets = tokens.UnitEncoder(PATH).encode_column(pa.array(texts * 3))
        assert [ids[a:b].astype("<u4").tobytes() for a, b in zip(offsets[:-1], offsets[1:])] == expected
