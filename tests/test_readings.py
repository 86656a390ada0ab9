import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from platelake.operators import metadata, readings
from platelake.sinks import summary

RAW = "batch string, file_name string, compound_raw string, ic50_raw string, max_inhib_raw string, ord long"


def raw(spark, *values):
    full = [("b1 cells", f"d_{line}_x_paste.xlsx", f"p_{c}", i, m, o) for line, c, i, m, o in values]
    return readings.clean_readings(spark.createDataFrame(full, RAW))


def test_first_value_per_metric(spark):
    df = raw(spark, ("L", "c", "3", "5", 3), ("L", "c", None, "1", 1), ("L", "c", "2", "NA", 2))
    assert rows(readings.first_readings(df).drop(*readings.KEYS)) == [(2.0, None, 1.0, None)]


def test_first_value_does_not_depend_on_partitions(spark):
    df = raw(spark, *[("L", f"c{i % 7}", str(i) if i % 3 else None, str(i * 2), i) for i in range(500)])
    expected = rows(readings.first_readings(df))
    for parts in (1, 3, 16):
        assert rows(readings.first_readings(df.repartition(parts))) == expected


def test_text_can_win(spark):
    df = raw(spark, ("L", "c", "n.d.", None, 1), ("L", "c", "3", "x", 2), ("L", "d", "4", "5", 1), ("L", "d", "n.d.", "6", 2))
    found = readings.first_readings(df)
    picked = rows(found.select("compound", "ic50", "ic50_text", "max_inhib", "max_inhib_text"))
    assert picked == [("c", None, "n.d.", None, "x"), ("d", 4.0, None, 5.0, None)]
    assert rows(readings.rejected_values(df).select("compound", "metric", "value", "ord")) == [
        ("c", "ic50", "n.d.", 1), ("c", "max_inhib", "x", 2), ("d", "ic50", "n.d.", 2),
    ]


def test_censored_flag(spark):
    df = raw(spark, ("L", "c", "> 300", ">9", 1), ("L", "c", "300", None, 2), ("L", "c", None, None, 3))
    assert [r[0] for r in df.orderBy("ord").select("ic50_censored").collect()] == [True, False, False]


def test_wide_drops_as_a_pivot_does(spark):
    df = raw(
        spark,
        ("L1", "both", "1", "2", 1),
        ("L1", "only_ic50", "3", None, 2),
        ("L2", "only_inhib", None, "4", 3),
        ("L3", "both", None, None, 4),
    )
    first = readings.first_readings(df)
    compounds = readings.compound_columns(first)
    assert compounds == ["both", "only_ic50"]
    wide = readings.wide_readings(first, compounds)
    assert wide.columns == ["cell_line", "batch", "both_IC50", "only_ic50_IC50", "both_INHIB", "only_ic50_INHIB"]
    assert rows(wide, "cell_line") == [("L1", "b1 cells", 1.0, 3.0, 2.0, None), ("L2", "b1 cells", None, None, None, None)]


def test_pivot_takes_one_shuffle(spark):
    first = spark.createDataFrame(
        [("L", "b", "c", 1.0, None, 2.0, None)],
        "cell_line string, batch string, compound string, ic50 double, ic50_text string, max_inhib double, max_inhib_text string",
    )
    wide = readings.wide_readings(first, ["c", "d"])
    assert plan_of(wide).count("Exchange") == 1
    assert rows(wide) == [("L", "b", 1.0, None, 2.0, None)]


def test_compounds_that_differ_in_case_or_hold_dots(spark):
    df = raw(spark, ("L", "a.b", "1", "2", 1), ("L", "A.b", "3", "4", 2), ("L", "x`y", "5", "6", 3))
    first = readings.first_readings(df)
    wide = readings.wide_readings(first, readings.compound_columns(first))
    assert wide.columns[2:5] == ["A.b_IC50", "a.b_2_IC50", "x`y_IC50"]
    assert rows(wide) == [("L", "b1 cells", 3.0, 1.0, 5.0, 4.0, 2.0, 6.0)]


def test_compound_map(spark):
    df = raw(spark, ("L", "T1", "1", "1", 1), ("L", "T2", "2", "2", 2), ("L", "T3", "3", "3", 3), ("L", "t1", "4", "4", 4))
    mapping = spark.createDataFrame(
        [("T1", "old", 1), ("T1", "new", 2), ("T2", "gone", 3), ("T2", None, 4)],
        "ta_id string, compound_name string, row_no int",
    )
    mapped = readings.map_compounds(df, mapping)
    assert [r[0] for r in mapped.orderBy("ord").select("compound").collect()] == ["new", None, "T3", "t1"]
    first = readings.first_readings(mapped)
    assert readings.compound_columns(first) == ["T3", "new", "t1"]
    assert [r[0] for r in rows(first.select("compound"))] == ["T3", "new", "t1"]


def test_long_map_joins_the_same_without_broadcast(spark):
    df = raw(spark, *[("L", f"T{i}", str(i), "1", i) for i in range(50)])
    mapping = spark.range(40).selectExpr("concat('T', id) as ta_id", "concat('N', id) as compound_name", "id as row_no")
    expected = rows(readings.map_compounds(df, mapping))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = readings.map_compounds(df, mapping)
        assert "SortMergeJoin" in plan_of(beyond)
        assert rows(beyond) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sheet_of(spark, first):
    dictionary = readings.compound_dictionary(first)
    header = summary.header_table(spark, readings.compound_labels(dictionary), [], [], ("cell_line", "batch"))
    cells = readings.dense_readings(first, dictionary, texts=True).withColumn("assay_cell_line", F.col("cell_line"))
    lines = summary.sheet_lines(cells, header, ("cell_line", "batch"), "cell_line", "batch")
    return [r["line"] for r in lines.orderBy("section").collect()]


def test_ten_thousand_compounds_are_all_written(spark):
    n = 10_001
    first = spark.range(n).selectExpr(
        "'L' as cell_line", "'b' as batch", "concat('c', lpad(id, 5, '0')) as compound", "cast(id as double) as ic50",
        "cast(null as string) as ic50_text", "cast(null as double) as max_inhib", "if(id = 7, 'n.d.', null) as max_inhib_text",
    )
    dense = readings.dense_readings(first, readings.compound_dictionary(first)).first()
    assert dense["ic50"] == [float(i) for i in range(n)] and dense["max_inhib"] == [None] * n
    lines = sheet_of(spark, first)
    assert lines[1].split(",")[2 : 2 + n] == [f"c{i:05d}" for i in range(n)]
    body = lines[2].split(",")
    assert body[2 : 2 + n] == [f"{float(i)}" for i in range(n)] and body[2 + n + 7] == "n.d." and len(body) == 2 + 2 * n


def test_dense_rows_leave_places_free(spark):
    df = raw(spark, ("L1", "b", "1", "2", 1), ("L1", "d", "3", None, 2), ("L2", "only_inhib", None, "4", 3), ("L3", "c", None, None, 4), ("L4", "c", "9", "8", 5))
    first = readings.first_readings(df)
    dictionary = readings.compound_dictionary(first)
    assert rows(dictionary, "ordinal") == [("b", 1), ("c", 2), ("d", 3)]
    dense = readings.dense_readings(first, dictionary)
    assert rows(dense.drop("batch"), "cell_line") == [("L1", [1.0, None, 3.0], [2.0, None, None]), ("L2", [None] * 3, [None] * 3), ("L4", [None, 9.0, None], [None, 8.0, None])]
    named = readings.named_columns(dense.withColumn("last", F.lit(1)), [("d", 3), ("b", 1)])
    assert named.columns == ["cell_line", "batch", "d_IC50", "b_IC50", "d_INHIB", "b_INHIB", "last"]
    assert rows(named.drop("batch"), "cell_line")[0] == ("L1", 3.0, 1.0, None, 2.0, 1)
    # The table is planned without the names, and all compounds of a pivot are the same numbers.
    wide = readings.wide_readings(first, readings.compound_columns(first))
    assert rows(readings.named_columns(dense, [("b", 1), ("c", 2), ("d", 3)])) == rows(wide)


def test_labels_are_those_of_the_column_names(spark):
    names = sorted(["A", "A_3", "a", "b", "B", "a_2", "é", "É", "x.y"])
    dictionary = spark.createDataFrame([(c, i) for i, c in enumerate(names, 1)], "compound string, ordinal long")
    found = readings.compound_labels(dictionary).orderBy("ordinal").collect()
    assert [f"{r['label']}_IC50" for r in found] == readings.wide_names(names)[0]
    assert len({r["label"].lower() for r in found}) == len(names)


def test_names_are_free_whatever_they_end_in():
    assert readings.wide_names(["A", "A_3", "a"])[0] == ["A_IC50", "A_3_IC50", "a_3_3_IC50"]


def test_texts_stay_in_the_sheet(spark):
    df = raw(spark, ("L", "c", "n.d.", 'a "b", c', 1), ("L", "d", "4", None, 2))
    first = readings.first_readings(df)
    assert sheet_of(spark, first) == [",,IC50,,Max%Inhib,", "cell_line,batch,c,d,c,d", 'L,b1 cells,n.d.,4.0,"a ""b"", c",']


def test_compounds_and_lines_straight_from_readings(spark):
    df = raw(spark, ("L1", "c", "1", None, 1), ("L1", "d", None, "2", 2), ("L2", "d", None, None, 3), ("L3", "e", "n.d.", None, 4))
    assert [r[0] for r in rows(readings.measured_compounds(df))] == readings.compound_columns(readings.first_readings(df)) == ["c", "e"]
    assert [r[0] for r in rows(readings.measured_lines(df))] == ["L1", "L3"]


def test_file_counts(spark):
    files = spark.createDataFrame([("b", "f1"), ("b", "f2"), ("c", "f1")], "batch string, path string")
    found = spark.createDataFrame([("b", "f1"), ("b", "f1")], "batch string, path string")
    assert rows(summary.file_counts(files, found, "batch", "path")) == [("b", "f1", 2, 2), ("b", "f2", 2, 0), ("c", "f1", 1, 0)]
    assert rows(summary.file_counts(files.select("path").distinct(), found, "path")) == [("f1", 2, 2), ("f2", 2, 0)]


def test_hot_key_is_combined_before_the_shuffle(spark):
    plan = plan_of(readings.first_readings(raw(spark, ("L", "c", "1", "1", 1))))
    # All rows meet in a hash table of numbers; only what is left of them, a row for each text of a key, is sorted.
    assert plan.count("partial_min_by") == 4 and plan.count("Exchange") == 2
    over_rows = plan[plan.rindex("Exchange") :]
    assert "HashAggregate" in over_rows and "SortAggregate" not in over_rows


def test_hot_key_of_different_texts(spark):
    values = [("L", "hot", f"text {i}", None, 5000 - i) for i in range(4000)] + [("L", "c", "1", "x", 1), ("L", "c", "y", "2", 0)]
    first = readings.counted_readings(raw(spark, *values).repartition(6))
    assert rows(first) == [
        ("L", "b1 cells", "c", None, "y", 2.0, None, 2, 1, 1, 0),
        ("L", "b1 cells", "hot", None, "text 3999", None, None, 4000, 4000, 0, 0),
    ]


def test_reading_order(spark):
    df = spark.createDataFrame([(2, 5), (1, 1 << 20), (2, 3)], "f long, r int")
    found = df.orderBy(readings.reading_order(F.col("f"), F.col("r"))).collect()
    assert [tuple(r) for r in found] == [(1, 1 << 20), (2, 3), (2, 5)]
    with pytest.raises(Exception, match="beyond the reading order"):
        df.select(readings.reading_order(F.col("f"), F.lit(1 << 21))).collect()


PANEL = "cell_line string, model_id string, gene double"


def test_metadata_join(spark):
    wide = spark.createDataFrame([("BxPC3", "b2", 1.0), ("zz", "b1", 2.0), ("dup", "b1", 3.0)], "cell_line string, batch string, c_IC50 double")
    meta = spark.createDataFrame([("BXPC3", "M1", 2.675), ("Dup", "M2", None), ("DUP", "M3", 0.125), (None, "M4", 1.0)], PANEL)
    panel = metadata.marker_panel(meta, ("cell_line", "model_id"), ["gene"])
    joined = metadata.join_metadata(wide, panel, info=("cell_line", "model_id"))
    assert joined.columns == ["cell_line", "batch", "model_id", "gene", "c_IC50", "assay_cell_line"]
    assert [tuple(r) for r in metadata.in_report_order(joined).collect()] == [
        ("DUP", "b1", "M3", 0.12, 3.0, "dup"),
        ("Dup", "b1", "M2", None, 3.0, "dup"),
        (None, "b1", None, None, 2.0, "zz"),
        ("BXPC3", "b2", "M1", 2.67, 1.0, "BxPC3"),
    ]
    assert rows(metadata.cells_per_batch(joined)) == [("b1", 2), ("b2", 1)]


def test_markers():
    known, unknown = metadata.known_markers(["TACSTD2", "NOPE", "NADA", "EGFR"])
    assert (known, unknown) == (["TACSTD2", "EGFR"], ["NOPE", "NADA"])
    assert metadata.known_markers(["TACSTD2", "EGFR"], present=["CellLine", "EGFR"]) == (["EGFR"], ["TACSTD2"])
    assert len(metadata.GENE_MARKERS) == 31


def test_header_bands(spark):
    bands = summary.header_bands(spark, summary.header_columns(["c1", "c2"], ["ModelID", "Code"], ["G1"]))
    assert rows(bands, "ordinal") == [
        (1, "CellLine", "CellLine", "", 1, 2), (2, "Batch", "Batch", "", 1, 2),
        (3, "ModelID", "ModelID", "Metadata", 3, 4), (4, "Code", "Code", "Metadata", 3, 4),
        (5, "G1", "G1", "Gene", 5, 5),
        (6, "c1_IC50", "c1", "IC50", 6, 7), (7, "c2_IC50", "c2", "IC50", 6, 7),
        (8, "c1_INHIB", "c1", "Max%Inhib", 8, 9), (9, "c2_INHIB", "c2", "Max%Inhib", 8, 9),
    ]
    labels = spark.createDataFrame([("c1", 1, "c1"), ("c2", 2, "c2")], "compound string, ordinal long, label string")
    assert rows(summary.header_table(spark, labels, ["ModelID", "Code"], ["G1"])) == rows(bands)
    no_genes = summary.header_columns(["c1"], ["ModelID"], [])
    assert [c.band for c in no_genes] == ["", "", "Metadata", "IC50", "Max%Inhib"]


def test_run_summary(spark):
    df = raw(spark, ("L1", "c", "> 1", "n.d.", 1), ("L2", "c", "x", "2", 2), ("L1", "d", None, "3", 3))
    first = readings.first_readings(df)
    lines = first.filter(readings.has_any_value()).select("cell_line", "batch").distinct()
    panel = spark.createDataFrame([("l1", "M", 1.0)], PANEL)
    joined = metadata.join_metadata(lines, panel, info=("cell_line", "model_id"))
    assert summary.run_summary(readings.counted_readings(df), joined, 6).first().asDict() == {
        "n_readings": 3, "n_ic50_texts": 1, "n_max_inhib_texts": 1, "n_censored": 1, "n_batches": 1, "n_cell_lines": 2,
        "n_compounds": 1, "n_rows": 2, "n_matched_rows": 1, "n_columns": 6,
    }


def test_one_group_with_most_rows(spark):
    """Two thirds of all rows in one key, spread over tasks: same result as a plain loop, one row per key and task."""
    values = [("L", "hot", None if i % 5 == 0 else f"{i}.125", None if i % 7 else str(i), 100_000 - i) for i in range(6000)]
    values += [(f"L{i % 50}", f"c{i % 11}", str(i), "n.d." if i % 13 == 0 else str(i), i) for i in range(3000)]
    df = raw(spark, *values).repartition(8)
    first = readings.first_readings(df)
    expected = {}
    for line, compound, ic50, inhib, order in sorted(values, key=lambda v: v[4]):
        held = expected.setdefault((line, compound), [None, None])
        held[0] = held[0] or ic50
        held[1] = held[1] or inhib
    found = {
        (r["cell_line"], r["compound"]): [r["ic50"], r["max_inhib"] if r["max_inhib_text"] is None else r["max_inhib_text"]]
        for r in first.collect()
    }
    assert found == {
        k: [round(float(i), 2) if i else None, m if m in (None, "n.d.") else float(m)] for k, (i, m) in expected.items()
    }
