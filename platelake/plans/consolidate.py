"""Batch folders of workbooks to the consolidated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.functions.numbers import missing_to_null
from platelake.operators import metadata, readings
from platelake.operators.ranking import global_rank
from platelake.session import staged
from platelake.sinks import pages, summary, writers
from platelake.sources import listing, tables, walk, workbooks

KEY, BATCH = "CellLine", "Batch"


def read_compound_map(spark: SparkSession, path: str) -> DataFrame:
    """Compound list workbook as ``ta_id, compound_name, row_no``."""
    book = spark.read.format("binaryFile").load(listing.literal_path(path))
    rows = workbooks.read_sheet(book, workbooks.COMPOUND_COLUMNS)
    problems = rows.filter(F.col("error").isNotNull()).select("error").first()
    if problems is not None:
        raise ValueError(f"{path}: {problems['error']}")
    name = missing_to_null(F.col("compound_name")).alias("compound_name")
    return rows.select("ta_id", name, F.col("row").alias("row_no"))


RAW_KEEP = ("path", "batch", "file_name")


def ingest(spark: SparkSession, base: str, out: str, again: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """List the workbooks into ``out/files`` and parse them into ``out/raw``, one folder a batch; later steps read these tables.

    After an earlier run below ``out`` only workbooks that are new or have another length or time are opened, and only
    their batches are written; ``again`` opens all. ``out/ingest_report`` has the counts, which come with the writing. Returns the
    manifest with its numbers in path order, the rows of its workbooks (with ``error`` set where one cannot be read), and folders
    that could not be listed.
    """
    listed, failed = walk.batch_workbooks(spark, base)
    # Files are numbered in path order, so the reading order is a number from the start.
    numbered = staged(global_rank(listed, F.asc("path"), name="file_no"))
    known = None
    if not again and listing.is_folder(spark, f"{out}/files") and listing.is_folder(spark, f"{out}/raw"):
        known = spark.read.schema(numbered.schema).parquet(f"{out}/files")
    opened = numbered if known is None else staged(numbered.join(known, list(walk.MANIFEST), "left_anti"))
    found = workbooks.read_summaries(walk.spread(opened.select(*RAW_KEEP, "length")), keep=RAW_KEEP)
    schema = found.schema
    if known is not None:
        # The batches that have a new workbook, with what is still right of them.
        touched = opened.select("batch").distinct()
        before = spark.read.schema(schema).parquet(f"{out}/raw")
        same = numbered.join(opened, "path", "left_anti").select("path")
        kept = before.join(touched, "batch", "left_semi").join(same, "path", "left_semi")
        counts = writers.write_batches(staged(found.withColumn("is_new", F.lit(True)).unionByName(kept.withColumn("is_new", F.lit(False)))), f"{out}/raw")
    else:
        counts = writers.write_batches(found.withColumn("is_new", F.lit(True)), f"{out}/raw", whole=True)
    report = numbered.agg(F.count("*").alias("n_listed")).withColumn("n_opened", opened.agg(F.count("*")).scalar())
    writers.write_table(report.withColumns({n: F.lit(v).cast("long") for n, v in counts.items()}), f"{out}/ingest_report")
    writers.write_table(numbered, f"{out}/files")
    files = spark.read.schema(numbered.schema).parquet(f"{out}/files")
    # Workbooks that are gone since are in no manifest.
    raw = spark.read.schema(schema).parquet(f"{out}/raw").join(files.select("path", "file_no"), "path")
    return files, raw, failed


def _with_names(dense: DataFrame, labels: DataFrame) -> DataFrame:
    """``dense`` with a column for each compound and metric."""
    found = labels.orderBy("ordinal").collect()
    names = [f"{r['label']}_IC50" for r in found], [f"{r['label']}_INHIB" for r in found]
    return readings.named_columns(dense, [(r["compound"], r["ordinal"]) for r in found], names)


def consolidate(
    spark: SparkSession,
    base: str,
    compound_list: str,
    metadata_path: str,
    out: str,
    markers: Sequence[str] = metadata.DEFAULT_MARKERS,
    metadata_format: str = "parquet",
    table_format: str = "parquet",
    named: bool = True,
    again: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Write all results below ``out``; return the consolidated table and the markers that were left out.

    Tables: ``files, raw, ingest_report, readings, first_readings, file_counts, rejected_files, rejected_values, compounds, consolidated,
    header_bands, sheet, sheet_pages, sheet_index, cells_per_batch, run_summary``. ``consolidated`` has the arrays ``ic50`` and ``max_inhib`` with a place for each
    of ``compounds``, whatever their number. What is returned shows them as named columns; for more compounds than a plan should have
    columns, ``named=False`` returns the arrays. As CSV the table always has named columns.
    A further run with the same ``out`` opens only workbooks that have changed (see ``ingest``), unless ``again`` is set.
    """
    files, raw, failed = ingest(spark, base, out, again)
    rejected = raw.filter(F.col("error").isNotNull()).select("batch", "path", "error")
    rejected.unionByName(failed, allowMissingColumns=True).write.mode("overwrite").json(f"{out}/rejected_files")
    writers.write_table(summary.file_counts(files.select("batch", "path"), raw.filter(F.col("error").isNull()), "batch", "path"), f"{out}/file_counts")
    # Files in path order, then rows in sheet order.
    in_order = raw.filter(F.col("error").isNull()).withColumn("ord", readings.reading_order(F.col("file_no"), F.col("row")))
    mapped = readings.map_compounds(readings.clean_readings(in_order), read_compound_map(spark, compound_list))
    writers.write_readings(mapped, f"{out}/readings")
    mapped = spark.read.schema(mapped.schema).parquet(f"{out}/readings")
    readings.rejected_values(mapped).drop("ord").write.mode("overwrite").parquet(f"{out}/rejected_values")

    found = tables.read_metadata(spark, metadata_path, metadata_format)
    known, unknown = metadata.known_markers(markers, present=found.columns)
    panel = metadata.marker_panel(found, metadata.INFO_COLUMNS, known)
    # Written once: it names the columns of the pivot, fills them, and holds the counts of the summary.
    writers.write_table(readings.counted_readings(mapped), f"{out}/first_readings")
    counted = spark.read.parquet(f"{out}/first_readings")
    first = counted.filter(F.col("compound").isNotNull())
    # The compounds' places; from here on they are a table, and so is everything that lists them.
    dictionary = readings.compound_dictionary(first)
    if dictionary.isEmpty():
        raise ValueError("no compound has an IC50 value")
    writers.write_table(readings.compound_labels(dictionary), f"{out}/compounds")
    labels = spark.read.parquet(f"{out}/compounds")
    info = [c for c in metadata.INFO_COLUMNS if c != KEY]
    writers.write_table(summary.header_table(spark, labels, info, known, (KEY, BATCH)), f"{out}/header_bands")
    header = spark.read.parquet(f"{out}/header_bands")

    dense = metadata.join_metadata(readings.dense_readings(first, dictionary), panel, key=KEY, batch=BATCH)
    if table_format != "parquet":  # such files hold no arrays
        dense = _with_names(dense, labels)
    writers.write_wide(metadata.in_report_order(dense, KEY, BATCH), f"{out}/consolidated", table_format)
    done = spark.read.schema(dense.schema).format(table_format).option("header", True).load(f"{out}/consolidated")

    cells = metadata.join_metadata(readings.dense_readings(first, dictionary, texts=True), panel, key=KEY, batch=BATCH)
    sheet = summary.sheet_lines(cells, header, [KEY, BATCH, *info, *known], KEY, BATCH)
    # Pages of the sheet's lines, with an index, for readers of a part of it; the sheet itself is written from them.
    order = [F.asc_nulls_last(c) for c in ("section", "batch", "cell_line", "assay_cell_line")]
    writers.write_table(pages.paged(sheet, *order), f"{out}/sheet_pages")
    lines_of = spark.read.parquet(f"{out}/sheet_pages")
    writers.write_table(pages.page_index(lines_of, ("section", "batch", "cell_line", "assay_cell_line")), f"{out}/sheet_index")
    writers.write_sheet(lines_of.drop("row_no", "page_no"), f"{out}/sheet")
    lines = done.select(KEY, BATCH)
    writers.write_table(metadata.cells_per_batch(lines, KEY, BATCH), f"{out}/cells_per_batch")
    writers.write_table(summary.run_summary(counted, lines, header, KEY), f"{out}/run_summary")
    return (_with_names(done, labels) if named and table_format == "parquet" else done), unknown
