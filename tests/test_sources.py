import io
import json
import os
import zipfile

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from platelake.plans.bar_chart import bar_chart, bar_values
from platelake.plans.consolidate import consolidate
from platelake.plans.plot_table import plot_table
from platelake.sinks import pages
from platelake.sources import archives, listing, tables, workbooks
from workload import fixtures
from workload.fixtures import workbook_bytes


def cell(ref, value, kind=None):
    if value is None:
        return f'<c r="{ref}"/>'
    if kind is None:
        kind = "n" if isinstance(value, (int, float)) else "inlineStr"
    if kind == "inlineStr":
        return f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'
    return f'<c r="{ref}" t="{kind}"><v>{value}</v></c>'


def sheet(table, first_row=1, first_column="A"):
    """Rows of values as row XML."""
    out = ""
    for r, values in enumerate(table, first_row):
        cells = "".join(cell(f"{chr(ord(first_column) + i)}{r}", v) for i, v in enumerate(values) if v is not None)
        out += f'<row r="{r}">{cells}</row>'
    return out


def summary_book(*readings, sections=None, images=None):
    header = ["Compound ID", "Note", "Max % Inhibition", "Corrected Abs IC50 nM"]
    sheets = {"Summary": sheet([["Report title"], header, *[[c, "x", m, i] for c, i, m in readings]])}
    if sections is not None:
        sheets["Analyzed Data"] = sheet([[s] for s in sections], first_column="B")
    return workbook_bytes(sheets, {f"xl/media/{n}": b for n, b in (images or {}).items()})


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(content)


def books(spark, *contents):
    return spark.createDataFrame([(f"w{i}", bytearray(c)) for i, c in enumerate(contents)], "path string, content binary")


def test_batches(spark, tmp_path):
    base = str(tmp_path)
    for name in ("1st_10 cells/d_L1_x_paste.xlsx", "1st_10 cells/~$d_L1_x_paste.xlsx", "1st_10 cells/a.csv", "b_cells/d_L2.xlsx", "b_cells/deep/d_L3.xlsx", "cells2/d_L4.xlsx"):
        put(f"{base}/{name}", b"x")
    found = listing.list_batches(spark, base)
    assert rows(found.select("batch", "file_name", "cell_line")) == [("1st_10 cells", "d_L1_x_paste.xlsx", "L1"), ("b_cells", "d_L2.xlsx", "L2.xlsx")]
    assert rows(listing.batch_catalog(found), "batch") == [("1st_10 cells", 1), ("b_cells", 1)]


def test_listing_takes_folders_as_they_are_named(spark, tmp_path, monkeypatch):
    base = f"{tmp_path}/b[2] 50% {{x}}"
    for name in ("1 cells/d_L1_paste.xlsx", "d_L2_paste.xlsx", "screens/d_L3_paste.xlsx", "__screens/d_L4_paste.xlsx"):
        put(f"{base}/{name}", b"x")
    assert [r[0] for r in rows(listing.list_batches(spark, base).select("cell_line"))] == ["L1"]
    assert [r[0] for r in rows(listing.list_workbooks(spark, base).select("cell_line"))] == ["L1", "L2", "L3"]
    put(f"{tmp_path}/screens/__screens/d_L5_paste.xlsx", b"x")
    put(f"{tmp_path}/screens/d_L6_paste.xlsx", b"x")
    assert [r[0] for r in rows(listing.list_workbooks(spark, f"{tmp_path}/screens").select("cell_line"))] == ["L6"]


def test_workbook_listing(spark, tmp_path):
    base = f"{tmp_path}/__in"
    for name in (
        "d_L1_paste.xlsx", "~d_L2_paste.xlsx", "d_L3_Summary_paste.xlsx", "d_L4.xlsx", "s/d_L5_paste.xlsx",
        "s/t/d_L6_paste.xlsx", "__MACOSX/d_L7_paste.xlsx", ".h/d_L8_paste.xlsx", "_ok/d_L9_paste.xlsx",
    ):
        put(f"{base}/{name}", b"x")
    assert [r[0] for r in rows(listing.list_workbooks(spark, base + "/").select("cell_line"))] == ["L1", "L5", "L9"]


def test_listing_reads_no_content(spark, tmp_path):
    put(f"{tmp_path}/a cells/d_L_paste.xlsx", b"x")
    plan = plan_of(listing.list_batches(spark, str(tmp_path)).select("path", "cell_line"))
    assert "ReadSchema: struct<path:string>" in plan


def test_sheet_by_header(spark):
    good = summary_book(("p_a", ">300", 99.984), ("p_b", "n.d.", 5), ("p_c", None, 2.50), ("p_d", 1e-05, None))
    df = workbooks.read_summaries(books(spark, good), keep=("path",))
    assert rows(df, "row") == [
        ("w0", 3, "p_a", "99.984", ">300", None), ("w0", 4, "p_b", "5", "n.d.", None),
        ("w0", 5, "p_c", "2.5", None, None), ("w0", 6, "p_d", None, "1e-05", None),
    ]


def test_unreadable_workbooks_become_rows(spark):
    no_sheet = workbook_bytes({"Other": ""})
    no_column = workbook_bytes({"Summary": sheet([["t"], ["Compound ID", "Note"]])})
    empty = workbook_bytes({"Summary": ""})
    df = workbooks.read_summaries(books(spark, b"junk", no_sheet, no_column, empty, summary_book(("p_a", 1, 2))), keep=("path",))
    found = {r["path"]: r["error"] for r in df.collect()}
    assert found["w4"] is None and "BadZipFile" in found["w0"] and "no sheet" in found["w1"]
    assert "Max % Inhibition" in found["w2"] and "no column" in found["w3"]


def test_cell_kinds(spark):
    strings = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>one</t></si><si><r><t>t</t></r><r><t>wo</t></r><rPh><t>no</t></rPh></si></sst>'
    row = (
        '<row r="2">' + cell("B2", 1, "s") + cell("C2", 1, "b") + cell("D2", "#N/A", "e") + cell("E2", "f", "str")
        + cell("F2", "5.0", "n") + cell("G2", "4.6999999E-2", "n") + cell("AB2", 0, "s") + cell("H2", None) + "</row>"
    )
    book = workbook_bytes({"S": row + '<row><c t="inlineStr"><is><t>x</t></is></c></row>'}, {"xl/sharedStrings.xml": strings.encode()})
    found = workbooks.read_cells(books(spark, book), ["S"], columns=None, last_row=None)
    assert rows(found.select("row", "col", "value", "value_type"), "row", "col") == [
        (2, 2, "two", "s"), (2, 3, "True", "b"), (2, 4, "#N/A", "e"), (2, 5, "f", "s"), (2, 6, "5", "n"),
        (2, 7, "0.046999999", "n"), (2, 28, "one", "s"), (3, 1, "x", "s"),
    ]


def test_section_cells_of_the_first_known_sheet(spark):
    both = workbook_bytes({"Data analysis for IC50": sheet([["old"]], 1, "B"), "Analyzed Data": sheet([["new", "c"]] * 60, 1, "B")})
    found = workbooks.read_cells(books(spark, both, workbook_bytes({"x": ""})))
    assert found.select("path", "sheet", "col", "value").distinct().collect() == [("w0", "Analyzed Data", 2, "new")]
    assert found.count() == 60
    assert workbooks.read_cells(books(spark, both), last_row=7).count() == 7


def test_columns_by_position(spark):
    book = workbook_bytes({"First": sheet([["Gene", "Whatever"], ["g1", 3], ["g2", 4.5]]), "Second": ""})
    found = workbooks.read_sheet(books(spark, book), {"gene": 1, "value": 2})
    assert rows(found.select("gene", "value"), "row") == [("g1", "3"), ("g2", "4.5")]


def test_images(spark):
    images = {f"image{n}.emf": bytes(size) for n, size in ((10, 4000), (2, 3500), (1, 3000), (3, 5000))}
    book = books(spark, summary_book(images={**images, "image4.png": bytes(9000)}))
    every = workbooks.read_images(book, 3000, keep=("path",))
    assert [r[0] for r in rows(every.select("member"))] == ["xl/media/image10.emf", "xl/media/image2.emf", "xl/media/image3.emf"]
    some = workbooks.read_images(book, 3000, first=2, keep=("path",))
    assert rows(some.select("member", "n_bytes", "plot_no")) == [("xl/media/image2.emf", 3500, 1), ("xl/media/image3.emf", 5000, 2)]


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return out.getvalue()


def test_archive_members_in_chunks(spark, tmp_path, monkeypatch):
    names = {f"a/b{i % 3}/d_L{i:02d}_paste.xlsx": os.urandom(100 + i) for i in range(40)}
    skipped = {"__MACOSX/a/d_X_paste.xlsx": b"x", "a/~d_X_paste.xlsx": b"x", "a/d_X_Summary_paste.xlsx": b"x", "a/note.txt": b"x"}
    put(f"{tmp_path}/my data/a%20b [1].zip", zipped({**names, **skipped}))
    put(f"{tmp_path}/my data/bad.zip", b"no archive")
    monkeypatch.setattr(archives, "CHUNK_BYTES", 1000)
    files = spark.read.format("binaryFile").load(f"{tmp_path}/my data/*.zip")
    members, failed = archives.archive_workbooks(files)
    assert members.select("chunk").distinct().count() > 4
    assert [r["path"].endswith("bad.zip") and len(r["error"]) > 0 for r in failed.collect()] == [True]
    opened = archives.read_archive_workbooks(members)
    assert {r["path"].split(".zip/")[1]: bytes(r["content"]) for r in opened.collect()} == names
    # One archive is shared out over tasks, however short its directory is.
    assert opened.select(F.spark_partition_id()).distinct().count() > 2


def test_options(spark, tmp_path):
    put(f"{tmp_path}/names.json", json.dumps({"TA145": "ADC-001", "TA 146": "ADC-002"}, indent=4).encode())
    assert rows(tables.read_options(spark, f"{tmp_path}/names.json")) == [("TA 146", "ADC-002"), ("TA145", "ADC-001")]
    assert tables.read_options(spark, None).count() == 0
    assert tables.read_options(spark, f"{tmp_path}/absent.json").count() == 0
    put(f"{tmp_path}/twice.json", b'{"A": "1", "B": "2", "A": "3"}')
    assert rows(tables.read_options(spark, f"{tmp_path}/twice.json")) == [("A", "3"), ("B", "2")]
    put(f"{tmp_path}/broken.json", b'{"A": "1", ')
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        tables.read_options(spark, f"{tmp_path}/broken.json").collect()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_metadata_without_values(spark, tmp_path, fmt):
    names = [*META[:7], "TACSTD2", "EGFR"]
    df = spark.createDataFrame([tuple("NA" if i == 2 else f"v{i}" for i in range(7)) + ("NaN", "2.5")], ", ".join(f"{n} string" for n in names))
    df.write.format(fmt).option("header", True).save(f"{tmp_path}/m")
    found = tables.read_metadata(spark, f"{tmp_path}/m", fmt)
    assert found.columns == names and found.first().asDict()["OncotreeLineage"] is None
    assert found.select("TACSTD2", "EGFR").first() == (None, 2.5)


META = ["ModelID", "CellLine", "OncotreeLineage", "OncotreePrimaryDisease", "OncotreeSubtype", "OncotreeCode", "in_BioMetas", "TACSTD2", "CEACAM5"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_consolidate_folders(spark, tmp_path, fmt):
    base, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(f"{base}/1st_10 cells/20260122_BXPC3_6TA_144H_paste.xlsx", summary_book(("BxPC3_TA1", 0.474, 99.984), ("BxPC3_Staurosporine", ">300", 1)))
    put(f"{base}/1st_10 cells/20260101_BXPC3_6TA_144H_paste.xlsx", summary_book(("BxPC3_TA1", None, 7), ("BxPC3_TA2", "n.d.", 8)))
    put(f"{base}/2nd cells/20260122_zz_6TA_144H_paste.xlsx", summary_book(("zz_TA1", 5, None), ("zz_TA3", None, 6)))
    put(f"{base}/2nd cells/20260122_bad_6TA_144H_paste.xlsx", b"junk")
    put(f"{base}/list.xlsx", workbook_bytes({"S": sheet([["TA_ID", "Compound"], ["TA1", "old"], ["TA1", "Drug"]])}))
    meta = spark.createDataFrame([("ACH-1", "BxPC3", "Pancreas", "d", "s", "c", "Yes", 9.567, None)], ", ".join(f"{c} {'double' if i > 6 else 'string'}" for i, c in enumerate(META)))
    meta.write.format(fmt).option("header", True).save(f"{tmp_path}/meta")
    done, unknown = consolidate(spark, base, f"{base}/list.xlsx", f"{tmp_path}/meta", out, ["TACSTD2", "NOPE", "CEACAM5", "MET"], metadata_format=fmt, table_format=fmt)
    assert unknown == ["NOPE", "MET"]
    assert done.columns == [
        "CellLine", "Batch", "ModelID", *META[2:], "Drug_IC50", "Staurosporine_IC50", "TA2_IC50",
        "Drug_INHIB", "Staurosporine_INHIB", "TA2_INHIB", "assay_cell_line",
    ]
    # Within a cell line the file that comes first by path gives the first value that is there.
    assert rows(done, "Batch") == [
        ("BxPC3", "1st_10 cells", "ACH-1", "Pancreas", "d", "s", "c", "Yes", 9.57, None, 0.47, 300.0, None, 7.0, 1.0, 8.0, "BXPC3"),
        (None, "2nd cells", None, None, None, None, None, None, None, None, 5.0, None, None, None, None, None, "zz"),
    ]
    assert rows(spark.read.parquet(f"{out}/cells_per_batch")) == [("1st_10 cells", 1), ("2nd cells", 0)]
    assert rows(spark.read.parquet(f"{out}/rejected_values").select("compound", "value")) == [("TA2", "n.d.")]
    assert "bad" in spark.read.json(f"{out}/rejected_files").first()["path"]
    assert spark.read.parquet(f"{out}/run_summary").first()["n_compounds"] == 3
    counted = spark.read.parquet(f"{out}/file_counts").select("batch", "n_files", "n_rows")
    assert rows(counted) == [("1st_10 cells", 2, 2), ("1st_10 cells", 2, 2), ("2nd cells", 2, 0), ("2nd cells", 2, 2)]
    parts = sorted(p for p in os.listdir(f"{out}/sheet") if p.endswith(".txt"))
    assert "".join(open(f"{out}/sheet/{p}").read() for p in parts).splitlines() == [
        ",,Metadata,,,,,,Gene,,IC50,,,Max%Inhib,,",
        "CellLine,Batch,ModelID,OncotreeLineage,OncotreePrimaryDisease,OncotreeSubtype,OncotreeCode,in_BioMetas,"
        "TACSTD2,CEACAM5,Drug,Staurosporine,TA2,Drug,Staurosporine,TA2",
        "BxPC3,1st_10 cells,ACH-1,Pancreas,d,s,c,Yes,9.57,,0.47,300.0,n.d.,7.0,1.0,8.0",
        ",2nd cells,,,,,,,,,5.0,,,,,",
    ]
    table, index = spark.read.parquet(f"{out}/sheet_pages"), spark.read.parquet(f"{out}/sheet_index")
    assert rows(index.select("page_no", "first_row", "n_rows", "last_assay_cell_line")) == [(1, 1, 4, "zz")]
    text = "".join(open(f"{out}/sheet/{p}").read() for p in parts)
    assert "".join(r["line"] + "\n" for r in pages.page(table, 1).collect()) == text
    assert index.first()["n_bytes"] == len(text.encode())
    bands = spark.read.parquet(f"{out}/header_bands")
    assert [r[0] for r in rows(bands.select("column_name"), "ordinal")] == done.columns[:-1]


SECTION = ["x", "XLFit Chart", "L_TA1", "L_Staurosporine", "L_TA2", None, "L_TA3"]


def picture_book(*sizes):
    return summary_book(sections=SECTION, images={f"image{i}.emf": bytes([i]) * size for i, size in enumerate(sizes, 1)})


def check_plot_table(spark, source, tmp_path):
    put(f"{tmp_path}/names.json", b'{"TA1": "ADC-1"}')
    put(f"{tmp_path}/colors.json", b'{"L2": "#90EE90"}')
    order = plot_table(spark, source, f"{tmp_path}/out", f"{tmp_path}/names.json", f"{tmp_path}/colors.json")
    assert order == ["TA1", "TA2"]
    cells = spark.read.parquet(f"{tmp_path}/out/grid")
    first = cells.withColumn("byte", F.hex(F.substring(F.unbase64("payload"), 1, 1)))
    assert rows(first.select("cell_line", "compound", "display_name", "color", "byte"), "cell_line", "plot_no") == [
        ("L1", "TA1", "ADC-1", "#FFFFFF", "02"), ("L1", "TA2", "", "#FFFFFF", "03"),
        ("L2", "TA1", "ADC-1", "#90EE90", "01"), ("L2", "TA2", "", "#90EE90", None),
    ]
    parts = sorted(p for p in os.listdir(f"{tmp_path}/out/report") if p.endswith(".txt"))
    text = "".join(open(f"{tmp_path}/out/report/{p}").read() for p in parts)
    assert text.startswith("<!DOCTYPE html>") and text.rstrip().endswith("</html>") and text.count("<tr>") == 3 and "Compounds: 2; cell lines: 2" in text


def test_plot_table_of_a_folder(spark, tmp_path):
    put(f"{tmp_path}/in/sub [1]/d_L1_paste.xlsx", picture_book(100, 4000, 4000, 4000))
    put(f"{tmp_path}/in/d_L2_paste.xlsx", picture_book(4000))
    put(f"{tmp_path}/in/d_L3_paste.xlsx", picture_book(10))
    check_plot_table(spark, f"{tmp_path}/in", tmp_path)


def test_plot_table_of_an_archive(spark, tmp_path):
    members = {"a/b/d_L1_paste.xlsx": picture_book(100, 4000, 4000, 4000), "d_L2_paste.xlsx": picture_book(4000), "__MACOSX/d_L0_paste.xlsx": b"x"}
    put(f"{tmp_path}/my screens/in.zip", zipped(members))
    check_plot_table(spark, f"{tmp_path}/my screens/in.zip", tmp_path)
    counted = spark.read.parquet(f"{tmp_path}/out/file_counts").select("n_files", "n_rows")
    assert rows(counted) == [(2, 1), (2, 2)]


def test_plot_table_names_the_error_of_the_first_workbook(spark, tmp_path):
    put(f"{tmp_path}/in/d_L1_paste.xlsx", b"junk")
    with pytest.raises(ValueError, match="d_L1_paste.xlsx: BadZipFile"):
        plot_table(spark, f"{tmp_path}/in", f"{tmp_path}/out")


def test_bar_values_without_a_number(spark):
    df = spark.createDataFrame([("a", "nan"), ("b", "1.0d"), ("c", " 2.5 "), ("d", "")], "gene string, value string")
    assert rows(bar_values(df)) == [("a", None), ("b", None), ("c", 2.5), ("d", None)]


def test_plot_table_reports_unreadable_workbooks_and_takes_drawn_pictures(spark, tmp_path):
    put(f"{tmp_path}/in/d_L1_paste.xlsx", picture_book(4000, 4000))
    put(f"{tmp_path}/in/d_L9_paste.xlsx", b"junk")
    members = [("xl/media/image1.emf", b"a" * 500), ("xl/media/image2.emf", b"b" * 2000)]
    drawn = [(f"file:{tmp_path}/in/d_L1_paste.xlsx", m, bytearray(b)) for m, b in members]
    pictures = spark.createDataFrame(drawn, "path string, member string, picture binary")
    plot_table(spark, f"{tmp_path}/in", f"{tmp_path}/out", pictures=pictures)
    rejected = spark.read.json(f"{tmp_path}/out/rejected_files").collect()
    assert [r["path"].endswith("d_L9_paste.xlsx") for r in rejected] == [True]
    cells = spark.read.parquet(f"{tmp_path}/out/grid").select("compound", F.unbase64("payload").cast("string"))
    assert rows(cells) == [("TA1", None), ("TA2", "b" * 2000)]


def test_plot_table_needs_workbooks(spark, tmp_path):
    put(f"{tmp_path}/in/note_paste.xlsx.txt", b"x")
    put(f"{tmp_path}/in/~x_paste.xlsx", b"x")
    with pytest.raises(ValueError):
        plot_table(spark, f"{tmp_path}/in", f"{tmp_path}/out")


def test_bar_chart(spark, tmp_path):
    put(f"{tmp_path}/in.xlsx", workbook_bytes({"S": sheet([["TAA", "IAA/Receptor"], ["g1", 60], ["g2", 1.5], ["g3", None]])}))
    done = bar_chart(spark, f"{tmp_path}/in.xlsx", f"{tmp_path}/out")
    assert rows(done.select("rank", "gene", "segment"), "rank") == [(1, "g2", "left"), (2, "g1", "right"), (3, "g3", None)]
    by_place = bar_chart(spark, f"{tmp_path}/in.xlsx", f"{tmp_path}/out2", by_position=True)
    assert rows(by_place.select("gene", "value"), "rank") == [("g2", 1.5), ("g1", 60.0), ("g3", None)]


TABLES = ("files", "raw", "readings", "first_readings", "file_counts", "rejected_values", "compounds", "consolidated", "header_bands", "cells_per_batch", "run_summary")


def test_a_second_run_opens_what_has_changed(spark, tmp_path):
    """New, changed, removed and unreadable workbooks: all tables are those of a run from scratch."""
    base, out = f"{tmp_path}/in", f"{tmp_path}/out"
    name = "20260122_{}_6TA_144H_paste.xlsx".format
    put(f"{base}/list.xlsx", workbook_bytes({"S": sheet([["TA_ID", "Compound"], ["TA1", "Drug"]])}))
    for i in range(6):
        put(f"{base}/{i % 3} cells/{name(f'L{i}')}", summary_book((f"p_TA{i}", i + 0.5, i), ("p_TA1", None, i)))
    put(f"{base}/2 cells/{name('bad')}", b"junk")
    spark.createDataFrame([("ACH-1", "L1", "a", "b", "c", "d", "Yes", 9.567, None)], ", ".join(f"{c} {'double' if i > 6 else 'string'}" for i, c in enumerate(META))).write.parquet(f"{tmp_path}/meta")

    def run(out, **more):
        done, _ = consolidate(spark, base, f"{base}/list.xlsx", f"{tmp_path}/meta", out, **more)
        return done, spark.read.parquet(f"{out}/ingest_report").first().asDict()

    _, report = run(out)
    assert report == {"n_listed": 7, "n_opened": 7, "n_rows": 13, "n_unreadable": 1, "n_new_rows": 13}
    _, report = run(out)
    assert report == {"n_listed": 7, "n_opened": 0, "n_rows": 0, "n_unreadable": 0, "n_new_rows": 0}
    untouched = {p: os.stat(f"{out}/raw/batch=2 cells/{p}").st_mtime_ns for p in os.listdir(f"{out}/raw/batch=2 cells")}
    put(f"{base}/0 cells/{name('A0')}", summary_book(("p_TA9", 1, 2)))
    put(f"{base}/1 cells/{name('L1')}", summary_book(("p_TA7", "n.d.", 3), ("p_TA8", 4, 4)))
    os.remove(f"{base}/1 cells/{name('L4')}")
    put(f"{base}/3 cells/{name('L9')}", summary_book(("p_TA2", 8, 8)))
    done, report = run(out, named=False)
    assert report["n_listed"] == 8 and report["n_opened"] == 3 and report["n_new_rows"] == 4
    assert untouched == {p: os.stat(f"{out}/raw/batch=2 cells/{p}").st_mtime_ns for p in os.listdir(f"{out}/raw/batch=2 cells")}
    assert dict(done.dtypes)["ic50"] == "array<double>"
    run(f"{tmp_path}/fresh")
    for table in TABLES:
        if table == "raw":  # rows of removed workbooks stay in batches that were not written, but are in no manifest
            continue
        again, fresh = (spark.read.parquet(f"{o}/{table}") for o in (out, f"{tmp_path}/fresh"))
        assert rows(again.select(sorted(again.columns))) == rows(fresh.select(sorted(fresh.columns))), table
    assert rows(spark.read.json(f"{out}/rejected_files")) == rows(spark.read.json(f"{tmp_path}/fresh/rejected_files"))
    _, report = run(out, again=True)
    assert report["n_opened"] == 8


def test_pages_and_their_index(spark):
    df = spark.range(2503).selectExpr("concat('L', lpad(id, 4, '0')) as cell_line", "concat('line ', id, if(id % 5 = 0, ' é', '')) as line").repartition(7)
    found = pages.paged(df, F.asc("cell_line"), page_rows=100).cache()
    index = rows(pages.page_index(found, ["cell_line"]), "page_no")
    assert len(index) == 26 and index[-1][1:3] == (2501, 3)
    assert [(i[4], i[5]) for i in index[:2]] == [("L0000", "L0099"), ("L0100", "L0199")]
    lines = [r["line"] for r in pages.page(found, 2).collect()]
    assert lines == [f"line {i}" + (" é" if i % 5 == 0 else "") for i in range(100, 200)]
    assert index[1][3] == sum(len(x.encode()) + 1 for x in lines)
    assert pages.page_index(pages.paged(df.limit(0), F.asc("cell_line")), ["cell_line"]).count() == 0


def test_equal_images_are_stored_once(spark):
    df = spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b"a")), (3, bytearray(b"b")), (4, None)], "image_no int, content binary")
    refs, store = pages.stored_once(df)
    assert refs.columns == ["image_no", "digest"] and refs.count() == 4
    assert rows(store.select(F.col("content").cast("string"), "n_uses")) == [("a", 2), ("b", 1)]
    assert rows(refs.join(store, "digest").select("image_no", F.col("content").cast("string"))) == [(1, "a"), (2, "a"), (3, "b")]


def test_archives_are_written_by_the_task_that_makes_them(spark, tmp_path):
    """Only addresses leave the task: one step in Python, no bytes in its rows, the same files as by way of rows."""
    df = spark.range(2500).selectExpr("concat('m', id, '.txt') as m", "encode(repeat(cast(id as string), 50), 'UTF-8') as c")
    methods = (archives.STORED, archives.DEFLATED, archives.BZIP2, archives.LZMA)
    placed = fixtures.to_archives(df, F.col("m"), F.col("c"), ("", "a/"), methods, f"file:{tmp_path}/own")
    assert placed.columns == ["path"]
    assert plan_of(placed).count("MapInArrow") == 1
    _, paths = fixtures.to_files(fixtures.to_archives(df, F.col("m"), F.col("c"), ("", "a/"), methods), f"file:{tmp_path}/rows")

    def members(found):
        out = {}
        for r in found.collect():
            with zipfile.ZipFile(r["path"].removeprefix("file:")) as archive:
                out |= {i.filename.rpartition("/")[2]: archive.read(i) for i in archive.infolist()}
        return out

    found = members(placed)
    assert len(found) == 2500 and found == members(paths)
