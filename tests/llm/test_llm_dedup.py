import ctypes
import os
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import LONG, WORDS, documents, edge_docs, no_docs

from platelake.llm import dart_minhash as dart
from platelake.llm import spans


def components(n, links):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return [top(i) for i in range(n)]


def brute_classes(texts):
    """Least place of each text's class by comparing all pairs that share a shingle."""
    grams, offsets = dart.shingles(spans.texts_of(pa.array(texts)))
    cells = dart.occurrences(grams, offsets)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    where = defaultdict(list)
    for c, o in zip(cells.tolist(), owner.tolist()):
        where[c].append(o)
    shared = Counter((m[i], m[j]) for m in where.values() for i in range(len(m)) for j in range(i + 1, len(m)))
    size = np.diff(offsets)
    return components(len(texts), [p for p, k in shared.items() if k >= dart.SIMILAR * (size[p[0]] + size[p[1]] - k)])


def test_classes_by_brute_force(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    expected = brute_classes([r["text"] for r in rows])
    found = {r["doc_id"]: r["class_id"] for r in dart.duplicate_classes(docs).collect()}
    assert found == {r["doc_id"]: rows[c]["doc_id"] for r, c in zip(rows, expected)}
    assert len(set(found.values())) < len(found)


def test_signatures_estimate_weighted_similarity():
    words = [f"w{i}" for i in range(400)]
    base = " ".join(words)
    texts = [base, " ".join(words[:360] + [f"x{i}" for i in range(40)]), base + " " + " ".join(words[:200]), "unlike " + " ".join(f"y{i}" for i in range(100))]
    grams, offsets = dart.shingles(spans.texts_of(pa.array(texts)))
    cells = dart.occurrences(grams, offsets)
    signed = dart.signatures(cells, offsets, k=1024)
    parts = [cells[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    for j in range(1, 4):
        assert abs((signed[0] == signed[j]).mean() - dart.similarity(parts[0], parts[j])) < 0.06
    assert np.array_equal(signed, dart.signatures(cells, offsets, k=1024))


def test_parts_of_units():
    cells = dart.occurrences(np.arange(500, dtype=np.uint64), np.array([0, 500]))
    both = np.concatenate([cells, cells])
    share = np.concatenate([np.ones(500), np.full(500, 0.5)])
    signed = dart.signatures(both, np.array([0, 500, 1000]), share, k=2048)
    assert abs((signed[0] == signed[1]).mean() - 0.5) < 0.05


def test_tiny_texts_have_full_signatures():
    grams, offsets = dart.shingles(spans.texts_of(pa.array(["one", "One", "two words", "", None])))
    signed = dart.signatures(dart.occurrences(grams, offsets), offsets)
    assert np.array_equal(signed[0], signed[1]) and (signed[2] != signed[0]).all()
    assert (signed[:3] != 0).all() and not signed[3:].any()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (103, 101)], "a long, b long")
    found = {r["node"]: r["least"] for r in dart.classes(links).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {101: 100, 103: 100}


def test_chain_of_near_copies_and_a_large_group(spark):
    rnd = np.random.default_rng(3)
    words = [f"v{i}" for i in range(300)]
    rows = []
    for k in range(6):  # each like the next, the ends unlike
        rows.append((k, " ".join(words[k * 14 : k * 14 + 200])))
    origin = [f"z{i}" for i in range(150)]
    for k in range(300):
        copy = list(origin)
        copy[rnd.integers(150)] = f"n{k}"
        rows.append((100 + k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_classes([t for _, t in rows])
    found = {r["doc_id"]: r["class_id"] for r in dart.duplicate_classes(docs).collect()}
    assert found == {i: rows[c][0] for (i, _), c in zip(rows, expected)}


def test_edge_rows(spark):
    docs = edge_docs(spark)
    found = [(r["doc_id"], r["class_id"]) for r in dart.duplicate_classes(docs).collect()]
    assert len(found) == docs.count()
    named = dict(found)
    # Two more words of twenty-one leave the similarity above the limit; a NULL text and one that has no word stay alone.
    assert named[6] == named[1] == named[9] == 1
    assert named[2] == 2 and named[3] == 3 and named[4] == 4 and named[5] == 5
    kept = dart.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.select("doc_id").collect()) == [(False, i) for i in (1, 2, 3, 4, 5, 7, 8)] + [(True, 0)]
    assert dart.duplicate_classes(no_docs(spark)).count() == dart.keep_first(no_docs(spark)).count() == 0
    assert len(LONG) > 100_000 and WORDS


def grouped(found):
    groups = defaultdict(list)
    for r in found:
        groups[r["class_id"]].append(r["doc_id"])
    return sorted(sorted(g, key=repr) for g in groups.values())


def unlike_texts(n):
    return [" ".join(f"t{k}w{i}" for i in range(100)) for k in range(n)]


def test_repeated_ids_lose_no_document_and_no_link(spark):
    a, b, c = unlike_texts(3)
    rows = [(1, a), (1, b), (1, c), (2, a + " more"), (3, b + " more"), (4, c + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert grouped(dart.duplicate_classes(docs).collect()) == [[1, 2], [1, 3], [1, 4]]
    kept = {(r["doc_id"], r["text"]) for r in dart.keep_first(docs).collect()}
    assert kept == {(1, a), (1, b), (1, c)}


def test_near_copies_without_an_id_are_linked(spark):
    a, b = unlike_texts(2)
    rows = [(7, a), (None, a + " more"), (None, b), (None, b + " more"), (None, b), (None, None), (None, None), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = dart.duplicate_classes(docs).collect()
    assert [r["class_id"] for r in found if r["doc_id"] == 7] == [7]
    ids = Counter(r["class_id"] for r in found if r["doc_id"] is None)
    assert ids[7] == 1 and ids[None] == 2 and len(ids) == 3 and min(i for i in ids if i is not None) < 0
    kept = [(r["doc_id"], r["text"]) for r in dart.keep_first(docs).collect()]
    assert len(kept) == 5 and Counter(kept)[(None, None)] == 2 and (7, a) in kept and (8, None) in kept
    assert sum(i is None and t is not None for i, t in kept) == 1


def test_planted_copies_above_the_limit_are_all_found(spark):
    """Exact recall over copies with few changed words, whose similarity is 0.8 or more."""
    rnd = np.random.default_rng(11)
    rows = []
    for k, text in enumerate(unlike_texts(60)):
        words = [f"{w}x{i}" for i, w in enumerate(text.split() * 3)]
        rows.append((2 * k, " ".join(words)))
        for at in rnd.choice(300, rnd.integers(1, 6), replace=False):
            words[at] = f"changed{k}"
        rows.append((2 * k + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_classes([t for _, t in rows])
    found = {r["doc_id"]: r["class_id"] for r in dart.duplicate_classes(docs).collect()}
    assert found == {i: c for (i, _), c in zip(rows, expected)}
    linked = sum(expected[2 * k] == expected[2 * k + 1] for k in range(60))
    assert linked >= 54


def word_rows(n, words=300, seed=5):
    """``n`` texts of random words, about eight bytes each."""
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1_000_000, words).tolist()) for _ in range(n)]
    return pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "digest": [str(i).encode() for i in range(n)], "text": texts})


def test_texts_are_signed_a_megabyte_at_a_time():
    rows = word_rows(2000)
    found = list(dart._signed(iter([rows])))
    assert len(found) >= rows.column("text").nbytes >> 20 >= 4
    whole = pa.Table.from_batches(found)
    some = pa.Table.from_batches(list(dart._signed(iter([rows.slice(700, 50)]))))
    assert whole.column("doc_id").to_pylist() == list(range(2000))
    assert whole.slice(700, 50).equals(some)


IDLE = """
import ctypes
from platelake.llm import dart_minhash
from test_llm_dedup import word_rows

def taken():
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith("RssAnon")) / 1024

for _ in dart_minhash._signed(iter([word_rows(4000)])):
    pass
idle = taken()
ctypes.CDLL(None).malloc_trim(0)
print(idle - taken())
"""


@pytest.mark.skipif(not sys.platform.startswith("linux") or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="measured by /proc and glibc")
def test_an_idle_worker_holds_no_freed_memory():
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.pathsep.join([here, os.path.dirname(os.path.dirname(here))])
    out = subprocess.run([sys.executable, "-c", IDLE], env=os.environ | {"PYTHONPATH": path}, capture_output=True, text=True, check=True)
    assert float(out.stdout) < 10
