import math
import random
import re

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from platelake.functions import markup
from platelake.operators import assets, bars, grid, palettes, ranking, sections

CELL = "workbook string, row int, value string, value_type string"


def entries(spark, *cells):
    df = spark.createDataFrame([("w", *c) for c in cells], CELL)
    return [tuple(r) for r in sections.section_entries(df).orderBy("plot_no").select("plot_no", "row", "compound").collect()]


def test_section_by_hand(spark):
    found = entries(
        spark,
        (1, None, None), (2, "XLFit Chart", "s"), (3, None, None), (4, "A_x", "s"), (5, "A_Staurosporine", "s"),
        (6, "XLFit Chart", "s"), (7, "5", "n"), (8, "A_y", "s"), (9, None, None), (10, "A_z", "s"),
    )
    assert found == [(1, 4, "x"), (2, 8, "y")]


def test_section_edges(spark):
    assert entries(spark, (1, "A_x", "s"), (2, "B_y", "s")) == []
    # A row that is not there is empty; zero and false count as empty; blank text and other numbers do not.
    assert entries(spark, (1, "XLFit Chart", "s"), (2, "A_x", "s"), (4, "A_y", "s")) == [(1, 2, "x")]
    for empty in (("0", "n"), ("0.0", "n"), ("", "s"), ("False", "b")):
        assert entries(spark, (1, "XLFit Chart", "s"), (2, "A_x", "s"), (3, *empty), (4, "A_y", "s")) == [(1, 2, "x")]
    error = entries(spark, (1, "XLFit Chart", "s"), (2, "A_x", "s"), (3, "#N/A", "e"), (4, "A_y", "s"))
    assert [e[2] for e in error] == ["x", "#N/A", "y"]
    for filled in (("  ", "s"), ("7", "n"), ("True", "b"), ("A_", "s"), ("control stauro", "s")):
        found = entries(spark, (1, "XLFit Chart", "s"), (2, "A_x", "s"), (3, *filled), (4, "A_y", "s"))
        assert found == [(1, 2, "x"), (2, 4, "y")]
    # However far down it lies.
    late = entries(spark, (48, "XLFit Chart", "s"), (49, "A_x", "s"), (50, "A_y", "s"), (70_000, "A_z", "s"))
    assert late == [(1, 49, "x"), (2, 50, "y")]
    far = entries(spark, (90_000, "XLFit Chart", "s"), (90_001, "A_x", "s"))
    assert far == [(1, 90_001, "x")]


# Kinds of cells, each with a letter: marker, entry, blank, and what neither counts nor ends the section.
KINDS = {
    "M": [("XLFit Chart", "s"), ("my Chart of XLFit", "s")],
    "E": [("A_x", "s"), ("A_y", "s"), (" B_z ", "s")],
    ".": [(None, None), ("0", "n"), ("", "s"), ("False", "b")],
    "o": [("A_Stauro", "s"), ("3", "n"), (" ", "s"), ("True", "b")],
}


def test_section_as_a_pattern(spark):
    """The section is what follows the first marker up to the first blank after an entry; the entries in it count."""
    draw = random.Random(3)
    books, expected = {}, {}
    for i in range(150):
        letters = "".join(draw.choices("MEo.", [1, 10, 4, 2])[0] for _ in range(draw.randrange(1, 120)))
        books[f"w{i}"] = [draw.choice(KINDS[k]) for k in letters]
        section = re.search(r"M((?:[^E]*)(?:[^.]*))", letters)
        if section and "E" in section[1]:
            at = [section.start(1) + m.start() for m in re.finditer("E", section[1])]
            expected[f"w{i}"] = [(n, p + 1, books[f"w{i}"][p][0].strip()[-1]) for n, p in enumerate(at, 1)]
    df = spark.createDataFrame([(w, r, *c) for w, cells in books.items() for r, c in enumerate(cells, 1)], CELL)
    found = {}
    for w, *entry in sections.section_entries(df).orderBy("workbook", "plot_no").collect():
        found.setdefault(w, []).append(tuple(entry))
    assert found == expected and len(expected) > 50


def test_sheet_choice(spark):
    df = spark.createDataFrame(
        [(1, "Data analysis for IC50"), (1, "Analyzed Data"), (2, "x"), (2, "Data analysis for IC50"), (3, "y")],
        "workbook int, sheet string",
    )
    assert rows(sections.choose_sheet(df)) == [(1, "Analyzed Data"), (2, "Data analysis for IC50")]


def test_first_workbook(spark):
    df = spark.createDataFrame([("B", "1"), ("A", "z"), ("A", "y")], "cell_line string, path string")
    assert rows(sections.first_workbook(df)) == [("A", "y")]


ASSET = "path string, cell_line string, image_no long, member string, n_bytes long, payload string"


def asset(path, line, number, n_bytes=4000, payload="p" * 1001):
    return path, line, number, f"image{number}.emf", n_bytes, payload


def test_images_by_number(spark):
    df = spark.createDataFrame([asset("a", "L", 10), asset("a", "L", 2), asset("a", "L", 1, 100), asset("a", "L", 3, 3000)], ASSET)
    assert rows(assets.rank_assets(df, 1).select("image_no", "plot_no")) == [(2, 1)]
    assert rows(assets.rank_assets(df, 9).select("image_no", "plot_no")) == [(10, 2), (2, 1)]


def shuffled_columns(df):
    """What each Exchange of the plan is given."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)


def test_image_limit_applies_before_the_shuffle(spark):
    df = spark.createDataFrame([asset("a", "L", 1)], ASSET)
    assert plan_of(assets.rank_assets(df, 7)).count("WindowGroupLimit") == 2


def test_payloads_move_only_when_they_are_gathered(spark):
    numbered = spark.createDataFrame([("a", "L", 1, "p" * 1001)], "path string, cell_line string, plot_no int, payload string")
    given = shuffled_columns(assets.cell_images(assets.usable(numbered)))
    with_payload = [g for g in given if "payload" in g or "images" in g or "collect" in g]
    assert given and len(with_payload) <= 1


def test_lost_picture_does_not_move_the_others(spark):
    df = spark.createDataFrame([asset("a", "L", 1, payload="short"), asset("a", "L", 2, payload="x" * 1001)], ASSET)
    images = assets.cell_images(assets.usable(assets.rank_assets(df, 2)))
    cells = grid.plot_grid(images, ["c1", "c2"])
    assert rows(cells.select("plot_no", "compound", "payload"), "plot_no") == [(1, "c1", None), (2, "c2", "x" * 1001)]


def test_last_workbook_with_pictures_wins(spark):
    good, bad = "x" * 1001, "y"
    df = spark.createDataFrame(
        [asset("a", "L", 1, payload=good), asset("b", "L", 1, payload="z" * 1001), asset("c", "L", 1, payload=bad), asset("a", "M", 1, payload=bad)],
        ASSET,
    )
    images = assets.cell_images(assets.usable(assets.rank_assets(df, 2)))
    assert rows(images.select("cell_line", "path", F.map_keys("images"))) == [("L", "b", [1])]


def images(spark, **lines):
    full = [(line, "w", found) for line, found in lines.items()]
    return spark.createDataFrame(full, "cell_line string, path string, images map<int,string>")


OPTION = "key string, value string"


def test_grid_and_report(spark):
    cells = images(spark, B={1: "P1"}, A={2: "P2", 1: "P0"})
    names = spark.createDataFrame([("c1", "Drug <1>"), ("other", "x")], OPTION)
    shades = spark.createDataFrame([("A", "#90EE90")], OPTION)
    found = grid.plot_grid(cells, ["c1", "c2"], names, shades)
    assert rows(found.drop("path"), "cell_line", "plot_no") == [
        ("A", 1, "c1", "Drug <1>", "#90EE90", "P0"), ("A", 2, "c2", "", "#90EE90", "P2"),
        ("B", 1, "c1", "Drug <1>", "#FFFFFF", "P1"), ("B", 2, "c2", "", "#FFFFFF", None),
    ]
    lines = [r["line"] for r in grid.in_report_order(grid.report_rows(cells, ["c1", "c2"], names, shades)).collect()]
    assert lines[0].startswith("<!DOCTYPE html>") and "<h1>" in lines[0] and "img{width:240px" in lines[0]
    assert lines[0].endswith(
        '<th scope="col">Cell line</th><th scope="col">c1<small>Drug &lt;1&gt;</small></th><th scope="col">c2</th></tr></thead><tbody>'
    )
    data = "data:application/octet-stream;base64,"
    assert lines[1] == (
        '<tr><th scope="row" style="background:#90EE90">A</th>'
        f'<td><img src="{data}P0" alt="Plot of c1 in A"></td><td><img src="{data}P2" alt="Plot of c2 in A"></td></tr>'
    )
    assert lines[2].endswith('alt="Plot of c1 in B"></td><td></td></tr>')
    assert lines[3] == "</tbody></table><p>Compounds: 2; cell lines: 2. Plots show percent inhibition.</p></body></html>"
    assert len(lines) == 4


def test_media_types(spark):
    heads = {b"\x89PNG\r\n\x1a\n....": "image/png", b"\xff\xd8\xff\xe0..": "image/jpeg", b"GIF89a": "image/gif",
             b"<svg xmlns": "image/svg+xml", b"\x01\x00\x00\x00l\x00\x00\x00": "image/emf", b"other": "application/octet-stream"}
    df = spark.createDataFrame([(bytearray(h), k) for h, k in heads.items()], "head binary, kind string")
    found = df.select(markup.media_type(markup.payload_text(F.col("head"))), "kind").collect()
    assert all(got == kind for got, kind in found)


def test_compound_listed_twice_shows_its_last_picture(spark):
    cells = images(spark, A={1: "P1", 2: "P2", 3: "P3"}, B={1: "Q1"})
    found = grid.plot_grid(cells, ["x", "y", "x"])
    assert rows(found.select("cell_line", "plot_no", "payload"), "cell_line", "plot_no") == [
        ("A", 1, "P3"), ("A", 2, "P2"), ("A", 3, "P3"), ("B", 1, "Q1"), ("B", 2, None), ("B", 3, "Q1"),
    ]


def test_grid_joins_no_pairs(spark):
    plan = plan_of(grid.plot_grid(images(spark, A={1: "P"}), ["x", "y"]))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def bar_frame(spark, *values):
    return spark.createDataFrame([(f"g{i}", v) for i, v in enumerate(values)], "gene string, value double")


def test_axis(spark):
    df = bar_frame(spark, 10.0, 30.0, 60.0, 70.0, -1.0, 15.0, 55.0, 65.0, None)
    found = rows(bars.on_axis(df).select("segment", "left_len", "right_len", "gene"), "gene")
    assert [f[:3] for f in found] == [
        ("left", 10.0, 0.0), ("gap", 15.0, 0.0), ("right", 15.0, 5.0), ("above", 15.0, 10.0), ("below", 0.0, 0.0),
        ("left", 15.0, 0.0), ("right", 15.0, 0.0), ("right", 15.0, 10.0), (None, None, None),
    ]
    half = rows(bars.on_axis(df, bars.OPEN_HALF_SCALE_BREAK).select("segment", "right_len", "gene"), "gene")
    assert half[3][:2] == ("right", 7.5) and half[2][:2] == ("right", 2.5)


def test_normalised(spark):
    assert [r[0] for r in rows(bars.normalised(bar_frame(spark, 1.0, 3.0, 2.0, None)).select("t", "gene"), "gene")] == [0.0, 1.0, 0.5, None]
    assert [r[0] for r in rows(bars.normalised(bar_frame(spark, 4.0, 4.0)).select("t"))] == [0.0, 0.0]


def test_bar_table(spark):
    table = bars.bar_table(bar_frame(spark, 60.0, 1.0, None, 12.0))
    found = rows(table.select("rank", "gene", "diverging", "gradient", "gradient_rgb"), "rank")
    assert [f[:2] for f in found] == [(1, "g1"), (2, "g3"), (3, "g0"), (4, "g2")]
    assert found[0][2:] == ("#3B4CC0",) * 3 and found[2][2:] == ("#B40426",) * 3 and found[3][2:] == (None,) * 3


def test_rank_over_many_partitions_and_a_hot_value(spark):
    values = [5.0] * 400 + [float(i % 97) for i in range(800)]
    df = spark.createDataFrame([(f"g{i:05d}", v) for i, v in enumerate(values)], "gene string, value double").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rows(ranking.global_rank(df, F.asc("value"), F.asc("gene")), "rank")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = sorted((v, f"g{i:05d}") for i, v in enumerate(values))
    assert [(v, g, r) for g, v, r in found] == [(v, g, i) for i, (v, g) in enumerate(expected, 1)]


def test_copies_of_one_key_are_ranked_by_several_tasks(spark):
    df = spark.range(20_000).selectExpr("'g' as gene", "if(id % 10 = 0, 1.0D, 2.0D) as value").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = ranking.global_rank(df, F.asc("value"), F.asc("gene")).withColumn("task", F.spark_partition_id())
        summary = found.groupBy("value").agg(F.min("rank"), F.max("rank"), F.count_distinct("rank"), F.count_distinct("task"))
        low, high = rows(summary, "value")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert low[:4] == (1.0, 1, 2000, 2000) and high[:4] == (2.0, 2001, 20_000, 18_000)
    assert high[4] > 3


def test_plot_order_takes_one_workbook(spark):
    df = spark.range(60).selectExpr("'w' as workbook", "cast(60 - id as int) as plot_no", "concat('c', id) as compound")
    assert sections.plot_order(df) == [f"c{i}" for i in range(59, -1, -1)]
    with pytest.raises(ValueError):
        sections.plot_order(df.union(df.withColumn("workbook", F.lit("v"))))


def test_one_bar_for_each_gene(spark):
    df = spark.createDataFrame([("g", 3.0), ("g", 7.0), ("h", None), ("h", 1.0), ("i", None)], "gene string, value double")
    assert rows(bars.bar_table(df).select("rank", "gene", "value"), "rank") == [(1, "h", 1.0), (2, "g", 7.0), (3, "i", None)]


def test_one_workbook_with_most_images(spark):
    values = [asset("hot", "H", n, payload=f"{n:05d}" * 201) for n in range(1, 3001)]
    values += [asset(f"w{i % 40}", f"L{i % 40}", i, payload=f"{i:05d}" * 201) for i in range(1000)]
    df = spark.createDataFrame(values, ASSET).repartition(8)
    found = assets.cell_images(assets.usable(assets.rank_assets(df, 5)))
    got = {r["cell_line"]: [r["images"][i][:5] for i in sorted(r["images"])] for r in found.collect()}
    assert got["H"] == [f"{n:05d}" for n in range(1, 6)]
    assert got == {"H": got["H"], **{f"L{i}": [f"{n:05d}" for n in range(i, 1000, 40)[:5]] for i in range(40)}}


def test_palettes_of_any_length(spark):
    """Stretches by a plain loop: many stops, one stop, values outside, on stops and missing ones, a hot palette."""
    rnd = random.Random(8)
    made = {"many": sorted(rnd.random() for _ in range(300)), "two": [0.25, 0.75], "one": [0.5], "even": [0.0, 0.5, 0.5, 1.0]}
    stops = [(p, t, rnd.randrange(256) * 1.0, i % 256 * 1.0, 7.0) for p, ts in made.items() for i, t in enumerate(ts)]
    values = [(p, t) for p in [*made, "none"] for t in [None, -1.0, 0.0, 0.25, 0.5, 0.6, 0.75, 1.0, 2.0]] + [("many", rnd.random()) for _ in range(3000)]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "id int, palette string, t double")
    table = spark.createDataFrame(stops, "palette string, t double, r double, g double, b double")
    found = palettes.palette_colored(df, table)
    plan = plan_of(found)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan

    def plain(palette, t):
        own = sorted(s[1:] for s in stops if s[0] == palette)
        if t is None or not own:
            return None
        t = min(max(t, own[0][0]), own[-1][0])
        for low, high in zip(own, own[1:]):
            if t <= high[0] and (t > low[0] or (low is own[0] and t == low[0])):
                share = (t - low[0]) / (high[0] - low[0]) if high[0] > low[0] else 0.0
                return "#" + "".join(f"{math.floor(a + share * (b - a) + 0.5):02X}" for a, b in zip(low[1:], high[1:]))
        return "#" + "".join(f"{math.floor(c + 0.5):02X}" for c in own[0][1:])

    assert {r["id"]: r["color"] for r in found.collect()} == {i: plain(*v) for i, v in enumerate(values)}
    assert found.count() == len(values)
