import pytest
from cases import SF_DIR, same_as_sql

from platelake.llm import bloom, oracle, queries, url_filter


def test_query_like_sql(spark):
    same_as_sql(spark, queries.op7_url_filter, oracle.URL_FILTER, SF_DIR)


URLS = {
    "http://Example.COM/en/x": ("example.com", "/en/x", "example.com/en/", "block"),
    "https://www.example.com/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
    "http://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://a.com": ("a.com", "", None, "allow"),
    "http://a.com?x=/": ("a.com", "", None, "allow"),
    "http://notcom/": ("notcom", "/", None, "allow"),
    "http://x.net/fr/1": ("x.net", "/fr/1", "net/fr/", "block"),
    "http://x.net/de/1": ("x.net", "/de/1", None, "block"),
    "http://x.net/de/1/?ref=y": ("x.net", "/de/1/", None, "block"),
    "http://x.net/de/2": ("x.net", "/de/2", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "a://b://c/d": ("b:", "//c/d", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


@pytest.mark.parametrize("blocks", [None, 1])
def test_rules_and_list(spark, monkeypatch, blocks):
    if blocks:  # a filter that is far too small lets URLs through, and the list still decides
        monkeypatch.setattr(bloom, "blocks_for", lambda n: blocks)
    listed = [("x.net/de/1",), ("a.com/other",), (None,), ("",)] + [(f"h{i}.org/{i}",) for i in range(300)]
    pages = spark.createDataFrame([(i, u, "html") for i, u in enumerate(URLS)] + [(0, "http://Example.COM/en/x", "again")], "page_id long, url string, rule string")
    found = url_filter.judged(pages, spark.createDataFrame(listed, "url string"), queries.RULES).collect()
    expected = dict(enumerate(URLS.values()))
    assert len(found) == len(URLS) + 1
    assert all((r["host"], r["path"], r["rule"], r["verdict"]) == expected[r["page_id"]] for r in found)


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a")], "page_id long, url string")
    nothing = spark.createDataFrame([], "url string")
    assert [r["verdict"] for r in url_filter.judged(pages, nothing, ()).collect()] == ["allow"]
    assert url_filter.judged(pages.limit(0), nothing, queries.RULES).count() == 0


def test_very_long_urls_are_judged_whole(spark):
    """Texts that differ only at their end, behind 100,000 characters."""
    url = "http://x.org/" + "a" * 100_000
    pages = spark.createDataFrame([(1, url + "b"), (2, url + "c"), (3, "http://www.example.com/en/" + "d" * 100_000)], "page_id long, url string")
    listed = spark.createDataFrame([("x.org/" + "a" * 100_000 + "b",)], "url string")
    found = {r["page_id"]: (len(r["path"]), r["rule"], r["verdict"]) for r in url_filter.judged(pages, listed, queries.RULES).collect()}
    assert found == {1: (100_002, None, "block"), 2: (100_002, None, "allow"), 3: (100_004, "www.example.com/en/", "allow")}


def test_filter_has_no_false_negatives_and_a_largest_size(spark):
    keys = spark.range(2000).withColumnRenamed("id", "k")
    rows = spark.range(4000)
    found = bloom.may_be_in(rows, rows["id"], keys, "k", "likely").filter("likely").toPandas()
    assert set(range(2000)) <= set(found.id) and len(found) < 2100
    assert bloom.blocks_for(10**12) == bloom.MAX_BLOCKS and bloom.blocks_for(0) == 1


def test_canonical(spark):
    urls = ["http://www.a.org:80/x/?b=2&utm_source=q&a=1#f", "HTTPS://A.org/x?a=1&b=2", "http://a.org", "x"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    found = [r[0] for r in rows.orderBy("i").select(url_filter.canonical(rows["u"])).collect()]
    assert found == ["a.org/x?a=1&b=2", "a.org/x?a=1&b=2", "a.org", ""]
