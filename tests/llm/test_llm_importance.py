import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import LONG, SF_DIR, edge_docs, no_docs

from platelake.llm import importance, queries


def features(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w.encode() for w in re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)]
    return len(words), [zlib.crc32(b" ".join(words[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, benchmark):
    """The contract in plain Python."""
    found = [(i, *features(t)) for i, t in docs]
    s = Counter(b for _, _, bs in found for b in bs)
    t = Counter(b for text in benchmark for b in features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for i, n, buckets in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        rows.append([i, n, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    may = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for r in rows:
        r.append(None)
    for rank, r in enumerate(may[: 5 * len(may) // 100], start=1):
        r[5] = rank
    return sorted(map(tuple, rows), key=repr)


def test_query_by_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    benchmark = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = sorted(map(tuple, queries.op12_importance(spark, SF_DIR).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert found == brute(docs, benchmark)
    assert sum(r[5] is not None for r in found) > 10


def test_crc_of_joined_words():
    shift = importance.Shift()
    rnd = random.Random(3)
    for length in [0, 1, 63, 64, 65, 1000, 70_000, 1 << 20]:
        head, tail = rnd.randbytes(rnd.randrange(1, 9)), rnd.randbytes(length)
        found = shift(np.array([zlib.crc32(head)], np.uint32), np.array([length])) ^ np.uint32(zlib.crc32(tail))
        assert int(found[0]) == zlib.crc32(head + tail)


def test_features_over_blocks_and_texts(monkeypatch):
    monkeypatch.setattr(importance, "BLOCK_BYTES", 64)
    monkeypatch.setattr(importance, "REMEMBERED", 40)
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("abZ19 \n|é,世\x00") for _ in range(rnd.choice([0, 2, 40, 900]))) for _ in range(80)]
    texts += [None, "x" * 500 + " y " + "z" * 70_000, "a b", "", "Ünicode"]
    reader = importance.Reader()
    for column in (pa.array(texts), pa.array(texts).slice(3, 50), pa.array(["", None])):
        owner, grams = reader.found(column)
        for i, text in enumerate(column.to_pylist()):
            n, expected = features(text)
            assert (owner == i).sum() == n
            assert sorted(b for begin, bucket in grams for b in bucket[owner[begin] == i]) == sorted(expected)


def test_edge_rows(spark):
    docs, target = edge_docs(spark), spark.createDataFrame([("the quick brown fox",), (None,)], "text string")
    found = importance.resampled(docs, target, share=50)
    rows = sorted((tuple(r)[:5] for r in found.collect()), key=repr)
    expected = brute([(r["doc_id"], r["text"]) for r in docs.collect()], ["the quick brown fox", None])
    assert rows == [r[:5] for r in expected]
    # Of five texts with 20 words half are drawn; equal rows are drawn one by one.
    ranked = {r["rank"]: r["doc_id"] for r in found.filter("rank is not null").collect()}
    assert sorted(ranked) == [1, 2] and 5 not in ranked.values()
    kept = importance.keep_drawn(docs, found)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(ranked.values())
    assert importance.resampled(no_docs(spark), target).count() == 0
    assert importance.resampled(docs, target.limit(0)).count() == docs.count()
    long = found.filter("doc_id = 5").first()
    assert long["n_features"] == 3 * len(LONG.split()) - 3


def test_ties_go_to_the_smaller_id(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.range(40).selectExpr("id % 20 as doc_id", f"'{text}' as text")
    found = importance.resampled(docs, docs.limit(1), share=50).orderBy("rank").filter("rank is not null").collect()
    assert [r["rank"] for r in found] == list(range(1, 21))
    assert [(-r["score"], r["doc_id"]) for r in found] == sorted((-r["score"], r["doc_id"]) for r in found)
