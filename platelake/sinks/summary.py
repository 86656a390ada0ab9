"""Header bands and run counts of the consolidated table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.operators.readings import COUNTS, METRICS, has_value, wide_names

BANDS = ("Metadata", "Gene", "IC50", "Max%Inhib")  # fixed values
BAND_SCHEMA = "ordinal int, column_name string, label string, band string, start_col int, end_col int"


class HeaderColumn(NamedTuple):
    """One output column: its name, its label, and the band over it with the band's first and last column."""

    ordinal: int
    column_name: str
    label: str
    band: str
    start_col: int
    end_col: int


def header_columns(
    compounds: Sequence[str],
    info: Sequence[str],
    markers: Sequence[str],
    keys: Sequence[str] = ("CellLine", "Batch"),
) -> list[HeaderColumn]:
    """The two header rows, column by column. A band without columns does not appear."""
    ic50_names, inhib_names = wide_names(list(compounds))
    groups = [("", keys, keys), (BANDS[0], info, info), (BANDS[1], markers, markers)]
    groups += [(BANDS[2], ic50_names, compounds), (BANDS[3], inhib_names, compounds)]
    columns, start = [], 1
    for band, names, labels in groups:
        end = start + len(names) - 1
        columns += [HeaderColumn(start + i, n, text, band, start, end) for i, (n, text) in enumerate(zip(names, labels))]
        start = end + 1
    return columns


def header_bands(spark: SparkSession, columns: Sequence[HeaderColumn]) -> DataFrame:
    """The header as a table; column names are metadata, held to the column limit of the wide table."""
    return spark.createDataFrame(list(columns), BAND_SCHEMA)


def header_table(spark: SparkSession, labels: DataFrame, info: Sequence[str], markers: Sequence[str], keys: Sequence[str] = ("CellLine", "Batch")) -> DataFrame:
    """The same header from a table of compounds (see ``readings.compound_labels``), whatever their number."""
    fixed = header_columns([], info, markers, keys)
    counted = labels.withColumn("n", labels.agg(F.count("*")).scalar())
    rows = header_bands(spark, fixed)
    for place, (band, ending) in enumerate(zip(BANDS[2:], ("_IC50", "_INHIB"))):
        start = F.lit(len(fixed) + 1) + place * F.col("n")
        rows = rows.union(
            counted.select(
                (start + F.col("ordinal") - 1).cast("int"),
                F.concat("label", F.lit(ending)),
                "compound",
                F.lit(band),
                start.cast("int"),
                (start + F.col("n") - 1).cast("int"),
            )
        )
    return rows


def csv_cell(text: Column) -> Column:
    """A CSV cell, in quotes where it has to be; missing values are blank."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(text.rlike('[",\\r\\n]'), quoted).otherwise(text), F.lit(""))


def _header_line(header: DataFrame, section: int, text: Column) -> DataFrame:
    """One line of the sheet from all rows of the header."""
    cells = F.sort_array(F.collect_list(F.struct("ordinal", csv_cell(text).alias("text"))))
    return header.agg(F.array_join(F.transform(cells, lambda c: c["text"]), ",").alias("line")).select(F.lit(section).alias("section"), "line")


def sheet_lines(joined: DataFrame, header: DataFrame, first: Sequence[str], key: str = "CellLine", batch: str = "Batch") -> DataFrame:
    """``section, batch, cell_line, assay_cell_line, line``: CSV lines with both header rows, then the data.

    ``joined`` has the texts of ``readings.dense_readings`` beside the metadata; ``header`` is the table of columns, ``first`` names
    those before the compounds. Header and lines are made from tables, so there is no limit to the number of compounds.
    """
    none = F.lit(None).cast("string")
    top = _header_line(header, 0, F.when(F.col("ordinal") == F.col("start_col"), F.col("band")).otherwise(F.lit("")))
    top = top.union(_header_line(header, 1, F.col("label")))
    top = top.select("section", none.alias("batch"), none.alias("cell_line"), none.alias("assay_cell_line"), "line")
    cells = [csv_cell(F.col("`" + c.replace("`", "``") + "`").cast("string")) for c in first]
    cells += [F.array_join(F.transform(F.col(m), csv_cell), ",") for m in METRICS]
    body = joined.select(
        F.lit(2).alias("section"),
        F.col(batch).alias("batch"),
        F.col(key).alias("cell_line"),
        "assay_cell_line",
        F.concat_ws(",", *cells).alias("line"),
    )
    return top.unionByName(body)


def run_summary(counted: DataFrame, joined: DataFrame, n_columns: int | DataFrame, key: str = "cell_line") -> DataFrame:
    """One row of counts: input batches, cell lines, readings and texts; output rows, matched rows, compounds.

    ``counted`` holds the counts per cell line, batch and compound that were made with the first readings; ``joined`` is
    one row per output row; ``n_columns`` the number of output columns, or the table of them.
    """
    columns = F.lit(n_columns) if isinstance(n_columns, int) else n_columns.agg(F.count("*").cast("int")).scalar()
    per_line = counted.groupBy("batch", "cell_line").agg(*[F.sum(c).alias(c) for c in COUNTS])
    sums = [F.sum(c).alias(c) for c in COUNTS]
    counts = per_line.agg(*sums, F.count_distinct("batch").alias("n_batches"), F.count("*").alias("n_cell_lines"))
    compounds = counted.filter(F.col("compound").isNotNull() & has_value("ic50")).select("compound").distinct()
    out = joined.agg(F.count("*").alias("n_rows"), F.count(key).alias("n_matched_rows"))
    one = [counts, compounds.agg(F.count("*").alias("n_compounds")), out]
    structs = [df.select(F.struct(*df.columns).alias("s")).scalar().alias(f"s{i}") for i, df in enumerate(one)]
    row = counted.sparkSession.range(1).select(*structs)
    return row.select(*[f"s{i}.*" for i in range(len(one))], columns.alias("n_columns"))


def file_counts(files: DataFrame, rows: DataFrame, *keys: str) -> DataFrame:
    """``keys…, n_files, n_rows``: how many rows each file gave, 0 where none, and how many files its group has.

    The last of ``keys`` names a file within the others.
    """
    group = list(keys[:-1])
    found = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    listed = files.select(*keys).distinct()
    if group:
        totals = listed.groupBy(*group).agg(F.count("*").alias("n_files"))
        listed = listed.join(totals, group)
    else:
        listed = listed.withColumn("n_files", listed.agg(F.count("*")).scalar())
    return listed.join(found, list(keys), "left").select(*keys, "n_files", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
