"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platelake.functions.identifiers import image_number, is_batch_folder, picture_name
from platelake.functions.markup import payload_text
from platelake.operators import assets as plots
from platelake.operators import bars as bar_ops
from platelake.operators import grid, metadata, palettes, readings, sections
from platelake.operators.ranking import global_rank
from platelake.plans.bar_chart import bar_values as values_of
from platelake.plans.consolidate import ingest
from platelake.session import staged
from platelake.sinks import pages, summary, writers
from platelake.sources import archives, listing, tables, walk, workbooks
from workload import adapters, fixtures

BAR_AXIS = bar_ops.AxisBreak(0.0, 2000.0, 6000.0, 8000.0)
OUTPUT_KEYS = ("cell_line", "batch")


def batch_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.view(spark, sf_dir, adapters.BATCH_FILES).filter(is_batch_folder(F.col("batch")))
    files = raw.groupBy("batch", "file_name").agg(F.count("*").alias("n_rows"))
    return files.groupBy("batch").agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows")).orderBy("batch")


def batch_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.batch_files(adapters.view(spark, sf_dir, adapters.BATCH_PATHS))


def workbook_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.workbook_files(adapters.view(spark, sf_dir, adapters.BOOK_PATHS), adapters.BOOK_BASE)


def file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, found = (adapters.view(spark, sf_dir, text) for text in (adapters.FILE_LIST, adapters.FILE_ROWS))
    return summary.file_counts(files, found, "batch", "file_name")


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.clean_readings(adapters.assay_raw(spark, sf_dir))


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.map_compounds(_clean(spark, sf_dir), adapters.compound_map(spark, sf_dir))


def clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).drop("ord")


def rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.rejected_values(_clean(spark, sf_dir)).drop("ord")


def compound_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.latest_names(adapters.compound_map(spark, sf_dir))


def mapped_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir).drop("ord")


def first_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.first_readings(_mapped(spark, sf_dir))


def _wide(first: DataFrame) -> DataFrame:
    """Written first: its compounds are needed before the pivot can be planned, and parsing twice costs more."""
    known = staged(first)
    return readings.wide_readings(known, readings.compound_columns(known))


def wide_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(first_readings(spark, sf_dir))


def metadata_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata with missing-value texts and without one of the markers that the schema names."""
    text, number = T.StringType(), T.DoubleType()
    named = (("ModelID", text), ("CellLine", text), ("OncotreeLineage", text), ("TACSTD2", number), ("MET", number), ("EGFR", number))
    schema = T.StructType([T.StructField(n, t) for n, t in named])
    return tables.plain_metadata(adapters.view(spark, sf_dir, adapters.META_TEXT), schema)


def marker_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    markers, _ = metadata.known_markers(adapters.REQUESTED_MARKERS, adapters.AVAILABLE_MARKERS)
    return metadata.marker_panel(adapters.cell_meta(spark, sf_dir), ("cell_line", *adapters.INFO), markers)


def _consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _wide(first_readings(spark, sf_dir))
    return metadata.join_metadata(wide, marker_panel(spark, sf_dir), info=("cell_line", *adapters.INFO))


def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.in_report_order(_consolidated(spark, sf_dir))


def _matched(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.join_metadata(lines, marker_panel(spark, sf_dir), info=("cell_line", *adapters.INFO))


def cells_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.cells_per_batch(_matched(readings.measured_lines(_mapped(spark, sf_dir)), spark, sf_dir))


def _header(spark: SparkSession, dictionary: DataFrame) -> DataFrame:
    markers, _ = metadata.known_markers(adapters.REQUESTED_MARKERS, adapters.AVAILABLE_MARKERS)
    return summary.header_table(spark, readings.compound_labels(dictionary), adapters.INFO, markers, OUTPUT_KEYS)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows are read and parsed once: the counts come with the first readings."""
    counted = staged(readings.counted_readings(_mapped(spark, sf_dir)))
    first = counted.filter(F.col("compound").isNotNull())
    lines = first.filter(readings.has_any_value()).select("cell_line", "batch").distinct()
    header = _header(spark, readings.compound_dictionary(first))
    return summary.run_summary(counted, _matched(lines, spark, sf_dir), header)


def header_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header from the compounds as a table."""
    names = readings.measured_compounds(_mapped(spark, sf_dir))
    return _header(spark, staged(global_rank(names, F.asc("compound"), name="ordinal")))


def sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = staged(first_readings(spark, sf_dir))
    dictionary = readings.compound_dictionary(first)
    joined = _matched(readings.dense_readings(first, dictionary, texts=True), spark, sf_dir)
    markers, _ = metadata.known_markers(adapters.REQUESTED_MARKERS, adapters.AVAILABLE_MARKERS)
    before = [*OUTPUT_KEYS, *adapters.INFO, *markers]
    return summary.sheet_lines(joined, _header(spark, dictionary), before, "cell_line", "batch")


def sheet_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of the sheet's pages of ten lines."""
    order = [F.asc_nulls_last(c) for c in ("section", "batch", "cell_line", "assay_cell_line", "line")]
    found = pages.paged(sheet_lines(spark, sf_dir), *order, page_rows=10)
    return pages.page_index(found, ("section", "batch", "cell_line", "assay_cell_line"))


def image_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as images, of which two ids share each picture."""
    html = adapters.table(spark, sf_dir, "pages").select(F.col("page_id"), F.encode(F.concat(F.col("url"), F.lit(" "), "html"), "UTF-8").alias("content"))
    twice = html.select((F.col("page_id") * 2).alias("image_no"), "content").union(html.select(F.col("page_id") * 2 + 1, "content"))
    refs, store = pages.stored_once(twice)
    least = refs.groupBy("digest").agg(F.min("image_no").alias("first_image"))
    return store.join(least, "digest").select("digest", "first_image", "n_uses", F.octet_length("content").alias("n_bytes"))


def compound_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compounds' places, and their labels where every third one differs from another in case only."""
    first = first_readings(spark, sf_dir)
    twice = F.when(F.col("compound").endswith("3"), F.array("compound", F.lower("compound"))).otherwise(F.array("compound"))
    return readings.compound_labels(readings.compound_dictionary(first.withColumn("compound", F.explode(twice))))


def dense_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of the arrays as a row."""
    first = staged(first_readings(spark, sf_dir))
    dense = readings.dense_readings(first, readings.compound_dictionary(first))
    places = F.posexplode(F.arrays_zip("ic50", "max_inhib")).alias("at", "v")
    return dense.select("cell_line", "batch", places).select("cell_line", "batch", (F.col("at") + 1).alias("ordinal"), "v.ic50", "v.max_inhib")


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = adapters.section_grid(spark, sf_dir).filter(F.col("sheet").isin(*sections.SECTION_SHEETS))
    return sections.section_entries(sections.section_cells(cells))


def section_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir)


def sheet_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.choose_sheet(adapters.view(spark, sf_dir, adapters.SHEETS))


def first_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.first_workbook(adapters.assets(spark, sf_dir).select("cell_line", "path"))


def plot_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plots.rank_assets(adapters.assets(spark, sf_dir), len(_plot_order(spark, sf_dir))).select(
        "path",
        "cell_line",
        "image_no",
        "plot_no",
        "n_bytes",
        picture_name(F.col("member")).alias("picture"),
        payload_text(F.col("content")).alias("payload"),
    )


def _plot_order(spark: SparkSession, sf_dir: str) -> list[str]:
    """Compounds of the first grid workbook that has an accepted sheet."""
    cells = adapters.section_grid(spark, sf_dir).filter(F.col("sheet").isin(*sections.SECTION_SHEETS))
    files = cells.select(F.col("workbook").alias("cell_line"), F.col("workbook").alias("path"))
    first = sections.first_workbook(files).first()["path"]
    chosen = cells.filter(F.col("workbook") == first)
    return sections.plot_order(sections.section_entries(sections.section_cells(chosen)))


def _pictures(spark: SparkSession, sf_dir: str, n_plots: int) -> DataFrame:
    """Ranked images with their picture. Ranked by names; the pictures are fetched afterwards."""
    found = adapters.assets(spark, sf_dir)
    ranked = plots.rank_assets(found.drop("content"), n_plots)
    pictures = ranked.join(found.select("path", "image_no", "content"), ["path", "image_no"])
    kept = plots.usable(pictures, payload="content")
    return plots.cell_images(kept.withColumn("payload", payload_text(F.col("content"))))


def _display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events")
    return events.select(F.col("event_type").alias("key"), F.concat(F.lit("A&"), F.upper("event_type")).alias("value")).distinct()


def _cell_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapters.assets(spark, sf_dir).select(F.col("cell_line").alias("key")).distinct()
    return lines.withColumn("value", F.when(F.col("key").startswith("t"), F.lit("#90EE90")).otherwise(F.lit("#ADD8E6")))


def plot_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = _plot_order(spark, sf_dir)
    return grid.plot_grid(
        _pictures(spark, sf_dir, len(order)), order, _display_names(spark, sf_dir), _cell_colors(spark, sf_dir)
    )


def plot_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = _plot_order(spark, sf_dir)
    # Written first, as the caption counts the lines that the body shows.
    images = staged(_pictures(spark, sf_dir, len(order)))
    rows = grid.report_rows(images, order, _display_names(spark, sf_dir), _cell_colors(spark, sf_dir))
    return grid.in_report_order(rows)


def json_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.options_of(adapters.table(spark, sf_dir, "events"), "props", "event_id")


def option_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with a key listed twice: the last one counts."""
    return tables.options_of(adapters.view(spark, sf_dir, adapters.OPTION_TEXT), "options", "event_id")


def bar_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values_of(adapters.view(spark, sf_dir, adapters.BAR_TEXT))


def bar_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_ops.on_axis(bar_ops.normalised(adapters.bars(spark, sf_dir)), BAR_AXIS)


def bar_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_ops.colored(bar_ops.normalised(adapters.bars(spark, sf_dir)))


def palette_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars coloured by the palette of their region; the palettes are a table."""
    values = bar_ops.normalised(adapters.view(spark, sf_dir, adapters.PALETTE_VALUES))
    stops = adapters.view(spark, sf_dir, adapters.PALETTE_STOPS)
    return palettes.palette_colored(values, stops).select("gene", "palette", "value", "t", "color")


def bar_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_ops.bar_table(adapters.bars(spark, sf_dir), BAR_AXIS)


def workbook_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as Summary sheets of workbooks, read back into the plain table's columns."""
    items = adapters.table(spark, sf_dir, "lineitem")
    types = {f.name: f.dataType for f in items.schema}
    cells = {
        c: fixtures.text_cell(F.col(c)) if t.typeName() == "string" else fixtures.number_cell(F.col(c))
        for c, t in types.items()
    }
    books = fixtures.to_workbooks(items, cells, workbooks.SUMMARY_SHEET, workbooks.SUMMARY_HEADER_ROW)
    rows = workbooks.read_sheet(books, {c: c for c in types}, workbooks.SUMMARY_SHEET, workbooks.SUMMARY_HEADER_ROW)
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()], "error")


def archive_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as members of zip files, read back by the workbook name rule; every fifth lies where it must be skipped."""
    pages = adapters.table(spark, sf_dir, "pages")
    zips = fixtures.to_archives(pages, _page_members(), F.encode("html", "UTF-8"), ("", "c/"))
    found = archives.workbook_members(archives.read_members(zips, r"_paste\.xlsx$", ["path"]))
    return found.select(
        "cell_line", "file_name", "n_bytes", F.decode("content", "UTF-8").alias("html"), "error"
    )


def cell_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sheet cells, text and numbers, read back cell by cell."""
    events = adapters.table(spark, sf_dir, "events")
    kind, number = F.col("event_type"), F.col("event_id") / 4
    cells = {"kind": fixtures.text_cell(kind), "number": fixtures.number_cell(number), "props": fixtures.text_cell(F.col("props"))}
    books = fixtures.to_workbooks(events, cells, sections.SECTION_SHEETS[1], 1)
    found = workbooks.read_cells(books, columns=(1, 2)).filter(F.col("row") > 1)
    return found.select("sheet", "col", "value", "value_type", "error")


def image_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as embedded images, read back above the size of a placeholder."""
    pages = adapters.table(spark, sf_dir, "pages")
    name = F.concat(F.lit("image"), F.col("page_id").cast("string"), F.lit(".emf"))
    books = fixtures.to_archives(pages, name, F.encode("html", "UTF-8"), ("xl/media/",))
    found = workbooks.read_images(books, plots.PLACEHOLDER_BYTES, keep=("path",))
    return found.select(
        image_number(F.col("member")).alias("image_no"), "n_bytes", F.decode("content", "UTF-8").alias("html"), "error"
    )


def _page_members() -> Column:
    return F.concat(
        F.when(F.col("page_id") % 5 == 0, F.lit("__MACOSX/")).otherwise(F.lit("a/b/")),
        F.lit("20260122_P"),
        F.col("page_id").cast("string"),
        F.when(F.col("page_id") % 7 == 0, F.lit("_Summary_paste.xlsx")).otherwise(F.lit("_7TA_144H_paste.xlsx")),
    )


def _page_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directories of real zip files that hold the pages, packed in four ways."""
    methods = (archives.STORED, archives.DEFLATED, archives.BZIP2, archives.LZMA)
    pages = adapters.table(spark, sf_dir, "pages")
    base = fixtures.shared_folder(spark, "files")
    paths = staged(fixtures.to_archives(pages, _page_members(), F.encode("html", "UTF-8"), ("", "c/", "c/d/"), methods, base))
    members, _ = archives.archive_workbooks(paths)
    return members


def archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages from zip files on disk, by their directories and places."""
    found = archives.open_members(_page_archives(spark, sf_dir))
    return found.select("cell_line", "file_name", "n_bytes", F.decode("content", "UTF-8").alias("html"), "error")


def archive_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same members in chunks of 1,000 bytes."""
    found = archives.member_chunks(_page_archives(spark, sf_dir), 1000)
    return found.select("file_name", "chunk_no", F.hex("content").alias("content"), "error")


def folder_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files in folders of several kinds, listed by tasks; names with ``_`` and ``.`` in front are files like others."""
    named = adapters.view(spark, sf_dir, adapters.FOLDER_FILES).select("path", F.encode("body", "UTF-8").alias("content"))
    base, paths = fixtures.to_files(named)
    found, failed = walk.batch_workbooks(spark, base)
    batches = found.select("batch", "file_name", "cell_line", "length", F.lit("batch").alias("kind"))
    plots, _ = walk.plot_workbooks(spark, base)
    plain = plots.select(F.lit(None).alias("batch"), "file_name", "cell_line", "length", F.lit("plot").alias("kind"))
    return batches.union(plain)


def first_sheet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the first sheet of workbooks on disk, opened by path."""
    suppliers = adapters.table(spark, sf_dir, "supplier")
    cells = {"TAA": fixtures.text_cell(F.col("s_name")), "IAA/Receptor": fixtures.number_cell(F.col("s_acctbal"))}
    _, paths = fixtures.to_files(fixtures.to_workbooks(suppliers, cells, "Any name", 1, before=()))
    found = workbooks.read_sheet(paths, workbooks.BAR_COLUMNS)
    return values_of(found).join(found.select("gene", "error"), "gene").select("gene", "value", "error")


def incremental_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as workbooks on disk in two steps: the second run opens only what the second step wrote."""
    base, out = fixtures.shared_folder(spark, "screens"), fixtures.shared_folder(spark, "ingested")
    columns = {**workbooks.SUMMARY_COLUMNS}
    for step in (0, 1):
        suppliers = adapters.table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") % 2 == step)
        values = {"compound_raw": fixtures.text_cell(F.col("s_name")), "max_inhib_raw": fixtures.number_cell(F.col("s_nationkey")), "ic50_raw": fixtures.number_cell(F.col("s_suppkey"))}
        cells = {columns[c]: v for c, v in values.items()}
        books = fixtures.to_workbooks(suppliers, cells, workbooks.SUMMARY_SHEET, workbooks.SUMMARY_HEADER_ROW)
        # Later batches for the later step; every batch has one folder.
        folder = F.concat(F.lit(f"{step} "), F.substring_index("path", "/", 1), F.lit(" cells/"))
        fixtures.to_files(books.select(F.concat(folder, F.substring_index("path", "/", -1)).alias("path"), "content"), base)
        _, raw, _ = ingest(spark, base, out)
    report = spark.read.parquet(f"{out}/ingest_report").first()
    return raw.select("compound_raw", "max_inhib_raw", "ic50_raw", "error", F.lit(report["n_new_rows"]).alias("n_new_rows"))


def bars_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bar table as written and read back."""
    path = fixtures.shared_folder(spark, "bars")
    table = bar_ops.bar_table(adapters.bars(spark, sf_dir), BAR_AXIS)
    writers.write_bars(table, path)
    return spark.read.schema(table.schema).parquet(path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        batch_catalog,
        batch_listing,
        workbook_listing,
        file_counts,
        clean_readings,
        rejected_values,
        compound_names,
        mapped_readings,
        first_readings,
        wide_readings,
        metadata_source,
        marker_panel,
        consolidated,
        cells_per_batch,
        run_summary,
        header_bands,
        sheet_lines,
        section_entries,
        sheet_choice,
        first_workbook,
        plot_assets,
        plot_grid,
        plot_report,
        json_options,
        option_lookup,
        bar_values,
        bar_axis,
        bar_colors,
        bar_ranked,
        palette_colors,
        workbook_ingest,
        archive_ingest,
        cell_ingest,
        image_ingest,
        archive_files,
        archive_chunks,
        folder_walk,
        first_sheet_files,
        bars_written,
        incremental_raw,
        sheet_pages,
        image_store,
        compound_places,
        dense_readings,
    )
}
