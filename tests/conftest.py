import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from platelake.session import recommended_conf  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    for key, value in recommended_conf().items():
        builder = builder.config(key, value)
    session = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted as text where no order is given."""
    found = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return found if order else sorted(found, key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
