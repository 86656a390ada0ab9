"""Every registered query against its SQL counterpart, and the driver contract."""

import os

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as driver
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF_DIR}/{name}'")
    return connection


def sorted_rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(map(repr, zip(*columns)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = sorted_rows(driver.queries()[name](spark, SF_DIR).toArrow())
    expected = sorted_rows(duck.sql(driver.oracle_sql()[name]).to_arrow_table())
    assert found[0] == expected[0]
    assert found[1] == expected[1]
    assert found[1]


def test_sorted_results(spark):
    queries = driver.queries()
    done = [(r["batch"], r["cell_line"] is None, r["cell_line"] or "") for r in queries["consolidated"](spark, SF_DIR).collect()]
    assert done == sorted(done)
    assert [r["batch"] for r in queries["batch_catalog"](spark, SF_DIR).collect()] == sorted(r["batch"] for r in queries["batch_catalog"](spark, SF_DIR).collect())
    ranks = [r["rank"] for r in queries["bar_ranked"](spark, SF_DIR).collect()]
    assert ranks == list(range(1, len(ranks) + 1))
    sections = [r["section"] for r in queries["plot_report"](spark, SF_DIR).collect()]
    assert sections == [0] + [1] * (len(sections) - 2) + [2]


def test_entry(spark):
    assert rows(driver.entry(spark))
