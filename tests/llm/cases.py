"""Rows that every operator must take, and the tables of the smallest scales."""

import os

import duckdb
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.01"

WORDS = "the quick brown fox jumps over the lazy dog while seven small birds watch from an old oak tree near water"
LONG = " ".join(f"w{i}" for i in range(30_000))

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("quality", T.StringType()),
        T.StructField("a.b", T.IntegerType()),
    ]
)

#: doc_id, text, lang, source: nulls in every column, empty and very long texts, ties and repeated rows.
ROWS = [
    (1, WORDS, "en", "s1"),
    (1, WORDS, "en", "s1"),
    (2, None, "en", "s1"),
    (3, "", None, "s2"),
    (4, " \n\t ", "en", None),
    (5, LONG, None, None),
    (6, WORDS, "de", "s1"),
    (None, "ein kleiner Text ohne Nummer", "de", "s3"),
    (7, "12345 --- 678", "en", "s1"),
    (8, "été à la plage", "fr", "s1"),
    (9, WORDS + " again", "en", "s2"),
]


def edge_docs(spark):
    rows = [(i, t, lang, src, None if t is None else len(t), "taken", 1) for i, t, lang, src in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def same_as_sql(spark, query, sql, sf_dir=SF_DIR):
    duck = duckdb.connect()
    for name in os.listdir(sf_dir):
        duck.execute(f"create view {name.removesuffix('.parquet')} as select * from '{sf_dir}/{name}'")
    found, expected = query(spark, sf_dir).toArrow(), duck.sql(sql).to_arrow_table()
    names = sorted(found.column_names)
    assert names == sorted(expected.column_names)
    a, b = (sorted(map(repr, zip(*[t.column(n).to_pylist() for n in names]))) for t in (found, expected))
    assert a == b and a
