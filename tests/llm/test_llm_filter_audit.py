import re
from collections import Counter
from itertools import permutations

import numpy as np
from cases import SF_DIR, documents, edge_docs, no_docs, same_as_sql

from platelake.llm import filter_audit, oracle, queries


def test_query_like_sql(spark):
    same_as_sql(spark, queries.op13_filter_audit, oracle.FILTER_AUDIT, SF_DIR)


def plain(rows, labels):
    """The contract, document by document and order by order. ``labels`` maps ids to (quality, toxic)."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    judged = []
    for i, text, lang in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and i > least[t],
        }
        judged.append((lang or "", "".join(k for k, v in fails.items() if v), *labels.get(i, (0, 0))))
    out, shapley = {}, Counter()
    for part in {j[0] for j in judged}:
        for order in map("".join, permutations("ABCDE")):
            left, gone = [j for j in judged if j[0] == part], []
            for step, f in enumerate(order, start=1):
                out_now = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                alone = sum(j[1] == f for j in judged if j[0] == part)
                out[part, order, step] = (len(left), len(out_now), sum(f in j[1] for j in gone), alone, sum(j[2] for j in out_now), sum(j[3] for j in out_now))
                gone += out_now
                shapley[part, f] += len(out_now)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def rows_of(found):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in found.collect()}


def test_edge_rows_by_brute_force(spark):
    docs = edge_docs(spark)
    more = docs.selectExpr("doc_id + 3 as doc_id", "concat(text, ' # ABC') as text", "lang", "source", "n_chars", "quality", "`a.b`")
    twice = docs.union(more).union(docs.selectExpr("cast(null as long)", "text", "'xx'", "source", "n_chars", "quality", "`a.b`"))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (6, 1, None), (9, None, 1), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    found = rows_of(filter_audit.audited(twice, labels))
    expected = plain([(r["doc_id"], r["text"], r["lang"]) for r in twice.collect()], {1: (1, 1), 6: (1, 0), 9: (0, 1)})
    assert found == expected
    assert len(found) == 600 * len({k[0] for k in found})
    assert filter_audit.audited(no_docs(spark), labels).count() == 0
    assert rows_of(filter_audit.audited(twice, labels.limit(0))).keys() == expected.keys()


def test_matrix_holds_every_word(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SLOT_WORDS", 3000)
    shards, dictionary = filter_audit.matrix(documents(spark).repartition(5))
    words = {r["term"]: bytes(r["word"]).decode() for r in dictionary.collect()}
    assert sorted(words) == list(range(len(words))) and len(set(words.values())) == len(words)
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    seen = 0
    for r in shards.collect():
        indptr, counts, indices = (np.frombuffer(r[c], t) for c, t in (("indptr", "<i4"), ("counts", "<i4"), ("indices", "<i8")))
        for k, i in enumerate(r["doc_id"]):
            row = slice(indptr[k], indptr[k + 1])
            assert (np.diff(indices[row]) > 0).all()
            assert {words[t]: n for t, n in zip(indices[row], counts[row])} == Counter(re.findall(r"[^\x20\x09-\x0D]+", texts[i]))
            seen += 1
    assert seen == len(texts)


def test_hot_text_and_language(spark):
    # One text of all rows but a few, in two languages, under ids that repeat.
    docs = spark.range(4000).selectExpr("id div 2 as doc_id", "if(id % 100 = 99, concat('other ', id), 'Same TEXT') as text", "if(id % 4 = 0, 'de', null) as lang")
    labels = spark.range(0, 2000, 3).selectExpr("id as doc_id", "1 as quality", "cast(id % 2 as int) as toxic")
    found = rows_of(filter_audit.audited(docs, labels))
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    assert found == plain(rows, {i: (1, i % 2) for i in range(0, 2000, 3)})
