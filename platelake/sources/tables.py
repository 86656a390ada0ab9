"""Metadata, compound list and option files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platelake.functions.numbers import missing_to_null
from platelake.operators.metadata import GENE_MARKERS, INFO_COLUMNS
from platelake.sources.listing import literal_path

OPTION_TYPE = "map<string,string>"
OPTION_SCHEMA = "key string, value string"

METADATA_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in INFO_COLUMNS] + [T.StructField(c, T.DoubleType()) for c in GENE_MARKERS]
)


def plain_metadata(found: DataFrame, schema: T.StructType = METADATA_SCHEMA) -> DataFrame:
    """The columns of ``schema`` that ``found`` has, with their types; texts for a missing value and NaN are NULL.

    A marker that the file lacks is no column of the result.
    """
    columns = []
    for f in schema:
        if f.name in found.columns:
            value = F.col(f.name)
            if isinstance(found.schema[f.name].dataType, T.StringType):
                value = missing_to_null(value)
            value = value.try_cast(f.dataType)
            columns.append((F.when(~F.isnan(value), value) if isinstance(f.dataType, T.DoubleType) else value).alias(f.name))
    return found.select(*columns)


def read_metadata(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Cell-line metadata with its declared types, without the markers that the file lacks."""
    if fmt == "csv":
        found = spark.read.option("header", True).csv(path)
    elif fmt == "parquet":
        found = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    missing = [c for c in INFO_COLUMNS if c not in found.columns]
    if missing:
        raise ValueError(f"metadata lacks {missing}")
    return plain_metadata(found)


def options_of(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """Flat JSON objects in ``column`` to one ``key, value`` row per key, next to the columns to keep.

    Of equal keys the last one counts. Text that is no JSON object is an error.
    """
    # Entries as they stand in the text: a map would have to drop one of two equal keys.
    entries = F.map_entries(F.from_json(F.col(column), OPTION_TYPE, {"mode": "FAILFAST"}))

    def is_last(entry, at):
        later = F.slice(F.col("_entries"), at + 2, F.size("_entries"))
        return ~F.exists(later, lambda other: other["key"] == entry["key"])

    parsed = df.select(*keep, entries.alias("_entries"))
    return parsed.select(*keep, F.inline(F.filter("_entries", is_last)))


def read_options(spark: SparkSession, path: str | None) -> DataFrame:
    """An option file as ``key, value`` rows; no path, or a file that is not there, gives no rows."""
    if path is not None:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return options_of(spark.read.text(literal_path(path), wholetext=True), "value")
    return spark.createDataFrame([], OPTION_SCHEMA)
