import corpus_pipeline
from cases import documents, edge_docs, no_docs

import __spark_entry__ as driver

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = set(driver.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_dedup", "decontamination", "packing"]


def test_stages_narrow_down(spark):
    docs = documents(spark, SMALL)
    columns, before = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL))
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after <= before and after
        if name != "packing":
            assert docs.columns == columns
        else:
            assert after == before
        before = after


def test_stages_take_odd_and_no_rows(spark):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (edge_docs(spark), no_docs(spark)):
            found = stage(spark, docs, SMALL)
            assert found.count() <= docs.count() + 100
            if name != "packing":
                assert found.columns == docs.columns
