"""Column expressions that read and convert numbers written in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from specloom.dictionaries import US_FAMILIES, WHOLE_NUMBER_UNITS
from specloom.functions.text import clean_text, double_text, whole_text, without_spaces

# Metric units as they are looked up.
METRIC_UNITS = (
    "mm", "cm", "m", "km", "km/h", "m/s", "m2", "m3", "m³", "cm3", "cc", "l", "liter", "litre", "l/min", "lpm", "g", "kg",
    "t", "kn", "n", "nm", "n·m", "w", "kw", "kwh", "pa", "kpa", "mpa", "bar", "°c", "c",
)

# What counts as a number, and as a metre.
NUMBER = r"\d+(?:\.\d+)?"
GROUPED_NUMBER = r"\d+(?:,\d{3})*(?:\.\d+)?"
LONE_M = r"(^|[^a-z])m($|[^a-z])"

_PLAIN = r"[+-]?(?:(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?|\.\d+)"
_BARE = r"\A[+-]?(?:\d+(?:\.\d+)?|\.\d+)\z"
_GAP = r"[\s\x85\xa0 -  　]*"
# Text and expected unit, joined by a NUL: a number, then nothing or that unit
# in any letter case, with or without a closing period.
_WITH_UNIT = rf"(?i)\A{_GAP}((?>{_PLAIN})){_GAP}(?:\x00.*|(\S.*?)\.?{_GAP}\x00\2\.?)\z"


def _ascii_digits(col: Column) -> Column:
    return F.translate(col, "０１２３４５６７８９", "0123456789")


def _as_number(digits: Column) -> Column:
    """Text already known to be a number; '' and NULL give NULL."""
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("double")


def unit_key(col: Column) -> Column:
    """A unit as it is looked up: lower case, no blanks, no closing period."""
    return F.rtrim(without_spaces(F.lower(col)), F.lit("."))


def is_metric(unit: Column) -> Column:
    return unit_key(unit).isin(*METRIC_UNITS)


def strict_number(text: Column, unit: Column | None = None) -> Column:
    """The number a clean text states, else NULL.

    Accepts thousands commas and a trailing unit when it is the unit expected.
    Ranges, several numbers, remarks and markers give NULL.  Bare numbers,
    which are most cells, are settled without the long pattern.
    """
    expected = F.lit("") if unit is None else F.coalesce(unit, F.lit(""))
    joined = F.concat(text, F.lit("\x00"), expected)
    # No match is NULL here; an empty text would make the cast throw and catch.
    matched = F.get(F.regexp_extract_all(joined, F.lit(_WITH_UNIT), F.lit(1)), F.lit(0))
    return F.when(text.rlike(_BARE), text.try_cast("double")).otherwise(_as_number(matched))


def dual_notation(text: Column, unit: Column) -> Column:
    """``struct(value, unit)`` of the metric side of a twofold notation.

    ``54.8 (0.898)`` under unit ``in3 (L)`` and ``20 hp (14.9 kW)`` state it in
    brackets, ``885 (33.5)`` under ``mm (in)`` and ``14.9 kW (20 hp)`` before
    them.  If neither unit is known as metric, the brackets win under a twofold
    unit, and the first side in a text with its own units.  Any other text
    gives a NULL value.
    """
    pair = rf"\A\s*({_PLAIN})\s*\(\s*({_PLAIN})\s*\)\s*\z"
    units = r"\A\s*([^()]+?)\s*\(\s*([^()]+?)\s*\)\s*\z"
    inline = rf"\A\s*((?>{_PLAIN}))\s*([^\d\s().,][^()\r\n]*?)\s*\(\s*((?>{_PLAIN}))\s*([^()\r\n]+?)\s*\)\s*\z"

    def read(cell: Column) -> Column:
        text, unit = cell["text"], cell["unit"]
        first_unit, bracket_unit = (F.regexp_extract(F.coalesce(unit, F.lit("")), units, i) for i in (1, 2))
        bracketed = text.rlike(pair) & (bracket_unit != "")
        inlined = text.rlike(inline)
        outer = bracketed & is_metric(first_unit) & ~is_metric(bracket_unit)
        own, inner = F.regexp_extract(text, inline, 2), F.regexp_extract(text, inline, 4)
        inside = inlined & is_metric(inner) & ~is_metric(own)

        def number(pattern: str, group: int) -> Column:
            return _as_number(F.regexp_extract(text, pattern, group))

        return F.struct(
            F.when(outer, number(pair, 1)).when(bracketed, number(pair, 2))
            .when(inside, number(inline, 3)).when(inlined, number(inline, 1)).alias("value"),
            F.when(outer, first_unit).when(bracketed, bracket_unit)
            .when(inside, inner).when(inlined, own).alias("unit"),
        )

    # In a lambda, as few cells need it: see ``double_text``.
    cells = F.array(F.struct(text.alias("text"), unit.cast("string").alias("unit")))
    return F.get(F.transform(cells, read), F.lit(0))


def measure_text(text: Column) -> Column:
    """A free text as its measures are read: clean, ASCII digits, no commas."""
    return F.replace(_ascii_digits(clean_text(text)), F.lit(","), F.lit(""))


def numbers_in(body: Column) -> Column:
    """All unsigned numbers in a text, in order, as written."""
    return F.regexp_extract_all(body, F.lit(NUMBER), F.lit(0))


def pick_measure(body: Column, found: Column, mode: str) -> Column:
    """The number that ``mode`` asks for, of those ``found`` in ``body``."""
    if mode == "first":
        picked = F.get(found, F.lit(0))
    elif mode == "second":
        picked = F.get(found, F.lit(1))
    elif mode == "range_max":
        ranged = body.contains("-") | body.contains("–") | body.contains("to")
        picked = F.get(found, F.when(ranged, F.size(found) - 1).otherwise(0))
    else:
        raise ValueError(f"unknown extraction mode: {mode}")
    return picked.try_cast("double")


def in_millimetres(body: Column, value: Column) -> Column:
    """Millimetres, of metres when the text has a lone ``m``."""
    return F.when(F.lower(body).rlike(LONE_M), value * 1000).otherwise(value)


def parse_measure(text: Column, unit: str, mode: str = "range_max") -> Column:
    """The measure a free text states, read leniently; unsigned, NULL if none.

    ``first`` and ``second`` take that number, ``range_max`` the last number
    when the text looks like a range and has several, else the first.  A lone
    ``m`` makes millimetres of metres.
    """
    body = measure_text(text)
    value = pick_measure(body, numbers_in(body), mode)
    return in_millimetres(body, value) if unit == "mm" else value


def to_us(value: Column, family: str | None) -> Column:
    """A metric value in the US unit of its family; no family, no change."""
    if family is None:
        return value
    _, _, how, factor = US_FAMILIES[family]
    return value / F.lit(factor) if how == "divide" else value * F.lit(factor)


def _one_decimal(value: Column) -> Column:
    """``value`` to one decimal, ties to even, decided exactly.

    The product with ten may round up to a tie that the value itself does not
    reach; its rounding error, found by splitting the value in two halves that
    multiply without loss, settles those cases.
    """
    product = value * 10
    scaled = value * F.lit(134217729.0)
    high = scaled - (scaled - value)
    error = (high * 10 - product) + (value - high) * 10
    below = F.floor(product).cast("double")
    tie = (product - below) == 0.5
    tenths = (
        F.when(tie & (error > 0), below + 1).when(tie & (error < 0), below).otherwise(F.rint(product))
    )
    # From 2**53 on a double has no fraction to round.
    return F.when(F.abs(value) < 9007199254740992.0, tenths / 10).otherwise(value)


def display_number(value: Column, unit: str) -> Column:
    """Whole number for whole-number units, else one decimal without ``.0``."""
    if unit in WHOLE_NUMBER_UNITS:
        return whole_text(F.rint(value))
    # As lambdas, to keep generated code small: see ``double_text``.
    rounded = F.transform(F.array(value), _one_decimal)
    return F.get(F.transform(rounded, double_text), F.lit(0))


def display_value(value: Column, family: str | None, system: str, unit: str) -> Column:
    """A metric value as shown in ``system``; ``unit`` is its metric unit."""
    if system == "metric" or family is None:
        return display_number(value, unit)
    return display_number(to_us(value, family), US_FAMILIES[family][1])


def rewrite_units(text: Column, family: str | None) -> Column:
    """Free text with its metric numbers and unit names turned into US ones."""
    body = clean_text(text)
    fallback = F.when(body == "", F.lit("-")).otherwise(body)
    if family is None:
        return fallback
    metric_unit = US_FAMILIES[family][0]
    us_unit = US_FAMILIES[family][1]

    def with_numbers(scale: float) -> Column:
        digits = _ascii_digits(body)
        gaps = F.split(digits, GROUPED_NUMBER, -1)
        found = F.regexp_extract_all(digits, F.lit(GROUPED_NUMBER), F.lit(0))
        values = F.transform(found, lambda n: to_us(_as_number(n) * F.lit(scale), family))
        numbers = F.transform(values, lambda v: display_number(v, us_unit))
        return F.array_join(
            F.zip_with(gaps, numbers, lambda gap, number: F.concat(gap, F.coalesce(number, F.lit("")))), ""
        )

    renamed = F.regexp_replace(with_numbers(1.0), f"(?i){metric_unit}", us_unit)
    if family == "length":
        metres = F.regexp_replace(with_numbers(1000.0), r"(?i)" + LONE_M, f"$1{us_unit}$2")
        renamed = (
            F.when(F.lower(body).contains("mm"), renamed)
            .when(F.lower(body).rlike(LONE_M), metres)
            .otherwise(body)
        )
    return F.when((body == "") | (body == "-"), F.lit("-")).otherwise(renamed)
