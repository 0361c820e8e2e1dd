"""Published edge strings, and number formatting against the language's own."""

import random

import pytest
from pyspark.sql import functions as F

from specloom.functions import numbers, text


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


@pytest.mark.parametrize("value, unit, mode, expected", [
    ("0-10 km/h", "km/h", "range_max", 10.0),
    ("3.1 m", "mm", "range_max", 3100.0),
    ("2,751 mm", "mm", "range_max", 2751.0),
    ("995/1025 mm", "mm", "first", 995.0),
    ("995/1025 mm", "mm", "second", 1025.0),
    ("995/1025 mm", "mm", "range_max", 995.0),
    ("42", "hp", "second", None),
    ("13-27 kWh", "kWh", "range_max", 27.0),
    ("10 to 12 h", "h", "range_max", 12.0),
    ("see table", "mm", "range_max", None),
    (None, "mm", "first", None),
    ("-5 kg", "kg", "first", 5.0),
    ("６．５ km/h", "km/h", "first", 6.0),
    ("1 km m2", "mm", "first", 1000.0),
])
def test_parse_measure(spark, value, unit, mode, expected):
    assert apply(spark, [value], lambda c: numbers.parse_measure(c, unit, mode)) == [expected]


@pytest.mark.parametrize("value, unit, expected", [
    ("1,190", "kg", 1190.0), ("1,190 kg", "kg", 1190.0), ("6,063 lbs.", "lbs", 6063.0), (".56 cu. yd.", "cu. yd.", 0.56),
    ("-4.5", None, -4.5), (" 12 ", None, 12.0), ("12 KG", "kg", 12.0),
    ("0-10 km/h", "km/h", None), ("0-10", "km/h", None), ("885\nExt 521", "mm", None), ("32.6**", None, None),
    ("53 Nm @ 2400 rpm", "Nm", None), ("see table", None, None), ("2 h 50 min", "h", None), ("5d", None, None),
    ("Infinity", None, None), ("NaN", None, None), ("1,19", "kg", None), ("1234,567", "kg", None), ("12 lb", "kg", None),
    ("", None, None), (None, "kg", None), ("1e5", None, None),
])
def test_strict_number(spark, value, unit, expected):
    unit_col = F.lit(unit).cast("string")
    assert apply(spark, [value], lambda c: numbers.strict_number(c, unit_col)) == [expected]


@pytest.mark.parametrize("value, unit, expected", [
    ("54.8 (0.898)", "in3 (L)", (0.898, "L")), ("14.9 kW (20 hp)", None, (14.9, "kW")),
    ("54.8", "in3 (L)", (None, None)), ("54.8 (0.898)", "L", (None, None)), ("a (b)", "x (y)", (None, None)),
])
def test_dual_notation(spark, value, unit, expected):
    unit_col = F.lit(unit).cast("string")
    assert tuple(apply(spark, [value], lambda c: numbers.dual_notation(c, unit_col))[0]) == expected


def test_to_us(spark):
    assert apply(spark, [1400.0], lambda c: numbers.display_value(c, "length", "us", "mm"), "double") == ["55.1"]
    assert apply(spark, [350.0], lambda c: numbers.display_value(c, "weight", "us", "kg"), "double") == ["771.6"]


@pytest.mark.parametrize("value, family, expected", [
    ("0-10 km/h", "speed", "0-6.2 mph"), ("3.1 m", "length", "122 in"), ("995/1025 MM", "length", "39.2/40.4 in"),
    ("1,500 kg", "weight", "3306.9 lb"), ("42", "length", "42"), ("", "speed", "-"), ("-", "speed", "-"),
    (None, None, "-"), ("20 hp", None, "20 hp"), ("18 MPa / 5", "pressure", "2610.7 PSI / 725.2"),
])
def test_rewrite_units(spark, value, family, expected):
    assert apply(spark, [value], lambda c: numbers.rewrite_units(c, family)) == [expected]


def as_python(v: float) -> str:
    r = round(v, 1)
    return str(int(r)) if float(r).is_integer() else f"{r:.1f}"


def test_one_decimal_rounds_like_exact_arithmetic(spark):
    rng = random.Random(7)
    values = [k / 20 for k in range(-400, 400)] + [rng.uniform(-1e5, 1e5) for _ in range(2000)]
    values += [round(rng.uniform(0, 1000), 2) for _ in range(2000)] + [1e12 + 0.25, 123456789.15, 9e15]
    shown = apply(spark, values, lambda c: numbers.display_number(c, "in"), "double")
    assert shown == [as_python(v) for v in values]


def test_double_text(spark):
    rng = random.Random(3)
    values = [0.1, 2.0, 1e-5, 1.5e-4, 1234567.25, 12345678.125, 123456789012.5, 1e15, 1e22, 3.3e-10, -0.25, 1e7 + 0.5]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 14) for _ in range(500)]
    expected = [str(int(v)) if v.is_integer() else repr(v) for v in values]
    assert apply(spark, values, text.double_text, "double") == expected


@pytest.mark.parametrize("fn, value, expected", [
    (text.clean_text, " a　\t b\x1cc ", "a b c"), (text.clean_text, None, ""),
    (text.clean_identifier, "X12 (TR)", "X12_TR"), (text.clean_identifier, "  a//b.-c ", "a_b_c"),
    (text.clean_identifier, "--", "col"), (text.clean_identifier, "仕様 項目", "仕様_項目"),
    (text.slug, "North / Field!", "north-field"), (text.spaced_slug, "North Field", "north-field"),
    (text.sheet_file_name, "仕様/値 (1)", "仕様_値__1"), (text.sheet_file_name, "//", "sheet"),
])
def test_text(spark, fn, value, expected):
    assert apply(spark, [value], fn) == [expected]


def test_product_key(spark):
    fn = lambda c: text.product_key(F.lit("ACME"), c)
    assert apply(spark, ["X200 HD+ TELE"], fn) == ["acme:x200_hdplus_tele"]


def test_relative_path(spark):
    fn = lambda c: text.relative_path(c, "/data/raw")
    assert apply(spark, ["file:///data/raw/a/b.csv", "/else/c.csv"], fn) == ["a/b.csv", "/else/c.csv"]


def test_series_number(spark):
    fn = lambda c: text.series_number(c, 9999)
    assert apply(spark, ["e500 series", "Small", None], fn) == [500, 9999, 9999]


@pytest.mark.parametrize("value, unit, expected", [
    ("885 (33.5)", "mm (in)", (885.0, "mm")), ("33.5 (885)", "in (mm)", (885.0, "mm")),
    ("20 hp (14.9 kW)", None, (14.9, "kW")), ("14.9 kW (20 hp)", None, (14.9, "kW")),
])
def test_dual_notation_takes_the_metric_side(spark, value, unit, expected):
    unit_col = F.lit(unit).cast("string")
    assert tuple(apply(spark, [value], lambda c: numbers.dual_notation(c, unit_col))[0]) == expected
