import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from platelake.functions import colors, identifiers, markup, numbers
from platelake.operators import bars


def apply(spark, values, *columns, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_ids(spark):
    values = ["BxPC3_TA145", "BxPC3_TA_145", "Staurosporine", None, "_x", "a_"]
    assert apply(spark, values, identifiers.id_tail(F.col("v"))) == ["TA145", "TA_145", "", "", "x", ""]
    values = ["BxPC3_TA145", " BxPC3_TA_145\t", "Staurosporine", None, "  ", "a_"]
    assert apply(spark, values, identifiers.id_last(F.col("v"))) == ["TA145", "145", "Staurosporine", None, "", ""]


def test_cell_lines(spark):
    names = ["20260122_BXPC3_6TA_144H_paste.xlsx", "plain.xlsx"]
    v = F.col("v")
    found = apply(spark, names, identifiers.cell_line_of(v), identifiers.cell_line_of(v, fallback=True))
    assert found == [("BXPC3", "BXPC3"), (None, "plain")]


def test_workbook_names(spark):
    names = ["a_paste.xlsx", "~a_paste.xlsx", "a_Summary_paste.xlsx", "a.xlsx", "a_paste.xlsx.bak"]
    assert apply(spark, names, identifiers.is_workbook_name(F.col("v"))) == [True, False, False, False, False]


def test_markers_and_control(spark):
    v = F.col("v")
    values = ["XLFit Chart", "Chart of XLFit", "xlfit chart", "XLFit", None, "STAUROsporine", ""]
    assert apply(spark, values, identifiers.is_section_marker(v)) == [True, True, False, False, False, False, False]
    assert apply(spark, values, identifiers.is_control(v)) == [False] * 5 + [True, False]


def test_image_numbers(spark):
    values = ["xl/media/image10.emf", "image2.emf", "picture.emf", "image99999999999999999999.emf"]
    assert apply(spark, values, identifiers.image_number(F.col("v"))) == [10, 2, 0, 0]
    assert apply(spark, ["image7.png"], identifiers.image_number(F.col("v"), "png")) == [7]
    assert apply(spark, ["image7.emf"], identifiers.picture_name(F.col("v"))) == ["image7.png"]


def python_reading(text):
    """The rule in plain Python: drop '>', read as float, round; None for text and for not-a-number."""
    try:
        number = round(float(text.replace(">", "").strip()), 2)
    except ValueError:
        return None
    return None if math.isnan(number) else number + 0.0


def spark_reading(spark, values):
    number = numbers.number_of(F.col("v"))
    return apply(spark, values, F.when(~F.isnan(number), numbers.round2(number)))


def test_readings_by_hand(spark):
    cases = {
        ">300": 300.0, "> 300": 300.0, " 7 ": 7.0, "1e3": 1000.0, "n.d.": None, "1.0d": None, "1_000": 1000.0,
        "1__0": None, "_1": None, "1_": None, "inf": math.inf, "-Infinity": -math.inf, ">nan": None, "5>0": 50.0,
        "": None, ".": None, "+.5": 0.5, "2.675": 2.67, "0.125": 0.12, "0.375": 0.38, "1.005": 1.0, "99.985": 99.98,
        "-0.001": 0.0, "1e300": 1e300, "1e999": math.inf, "9007199254740993": 9007199254740992.0, "1 0": None,
    }
    assert spark_reading(spark, list(cases)) == list(cases.values())
    assert spark_reading(spark, list(cases)) == [python_reading(t) for t in cases]


def test_readings_like_python(spark):
    draw = random.Random(7)
    values = []
    for _ in range(4000):
        number = draw.choice([draw.uniform(-1000, 1000), draw.randrange(-10**6, 10**6) / 1000, draw.expovariate(1e-6)])
        values.append(draw.choice(["", ">", "> ", " "]) + draw.choice([repr(number), f"{number:.3f}", f"{number:.4e}"]))
    assert spark_reading(spark, values) == [python_reading(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.+-eE_> infa", max_size=8), min_size=20, max_size=60))
def test_any_text_reads_like_python(spark, values):
    assert spark_reading(spark, values) == [python_reading(v) for v in values]


def test_missing_texts(spark):
    values = ["NA", "nan", "#N/A", "", "n.d.", None, "0"]
    assert apply(spark, values, numbers.missing_to_null(F.col("v"))) == [None] * 4 + ["n.d.", None, "0"]


def test_payload_is_one_line(spark):
    import base64

    df = spark.createDataFrame([(bytes(range(256)) * 3,)], "v binary")
    assert df.select(markup.payload_text(F.col("v"))).first()[0] == base64.b64encode(bytes(range(256)) * 3).decode()


def test_escaping(spark):
    assert apply(spark, ['<a & "b">'], markup.escape(F.col("v"))) == ["&lt;a &amp; &quot;b&quot;&gt;"]


def test_gradient_stops(spark):
    stops = [s[0] for s in colors.gradient_stops()]
    assert stops == [0.0, 9 / 59, 19 / 59, 29 / 59, 39 / 59, 1.0]
    df = spark.createDataFrame([(t,) for t in [*stops, None]], "t double")
    found = bars.colored(df).collect()
    assert [(r["gradient"], r["gradient_rgb"]) for r in found] == [(c, c) for c in colors.GRADIENT_COLORS] + [(None, None)]


def test_gradient_between_stops(spark):
    between = [(a[0] + b[0]) / 2 for a, b in zip(colors.gradient_stops(), colors.gradient_stops()[1:])]
    found = bars.colored(spark.createDataFrame([(t,) for t in between], "t double")).collect()
    for i, row in enumerate(found):
        low, high = (colors.hex_to_rgb(c) for c in colors.GRADIENT_COLORS[i : i + 2])
        plain = [(a + b) / 2 for a, b in zip(low, high)]
        assert all(abs(a - b) <= 0.5 for a, b in zip(colors.hex_to_rgb(row["gradient_rgb"]), plain))
        lab = [(a + b) / 2 for a, b in zip(colors._rgb_to_lab(low), colors._rgb_to_lab(high))]
        assert all(abs(a - b) <= 0.51 for a, b in zip(colors.hex_to_rgb(row["gradient"]), colors._lab_to_rgb(lab)))


def test_diverging_map(spark):
    table = colors.diverging_table()
    assert len(table) == 256 and table[0] == "#3B4CC0" and table[255] == "#B40426"
    grey = [int(table[128][i : i + 2], 16) for i in (1, 3, 5)]
    assert max(grey) - min(grey) <= 4
    df = spark.createDataFrame([(t,) for t in (0.0, 0.5, 0.999, 1.0, None)], "t double")
    found = [r[0] for r in df.select(colors.diverging_color(F.col("t"))).collect()]
    assert found == [table[0], table[128], table[255], table[255], None]
