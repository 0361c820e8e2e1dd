"""Column expressions on text.  All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as a Unicode-aware text tool sees it: the White_Space property plus
# the four ASCII separator controls.
SPACE = r"(?U)[\s\x1c-\x1f]"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def clean_text(col: Column) -> Column:
    """NULL becomes '', runs of any whitespace become one blank, ends are trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(col.cast("string"), F.lit("")), SPACE + "+", " "))


def strip(col: Column) -> Column:
    """Trim any whitespace, not just blanks."""
    return F.btrim(col, F.lit(SPACES))


def without_spaces(col: Column) -> Column:
    """Drop all whitespace."""
    return F.translate(col, SPACES, "")


def is_blank(col: Column) -> Column:
    """NULL or nothing but whitespace."""
    return F.coalesce(~col.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(True))


def clean_identifier(col: Column) -> Column:
    """A column or table name; separators become ``_``, letters of any script stay.

    Compatibility forms are folded before this, on the distinct names only
    (``operators.header.clean_names``).
    """
    joined = F.regexp_replace(strip(col), r"(?U)[\s\x1c-\x1f/\\()\[\]{}:;,.\-_]+", "_")
    trimmed = F.regexp_replace(joined, r"^_|_\z", "")
    return F.when(trimmed == "", F.lit("col")).otherwise(trimmed)


def slug(col: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 become one ``-``."""
    dashed = F.regexp_replace(F.lower(col), r"[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, r"^-|-\z", "")


def spaced_slug(col: Column) -> Column:
    """The short form: lower case, each blank becomes ``-``."""
    return F.replace(F.lower(col), F.lit(" "), F.lit("-"))


def product_key(company: Column, model: Column) -> Column:
    """``company:model`` in lower case; ``+`` is spelled out, other runs become ``_``."""

    def part(col: Column) -> Column:
        spelled = F.replace(F.lower(col), F.lit("+"), F.lit("plus"))
        return F.regexp_replace(F.regexp_replace(spelled, r"[^a-z0-9]+", "_"), r"^_|_\z", "")

    return F.concat(part(company), F.lit(":"), part(model))


def sheet_file_name(col: Column) -> Column:
    """A sheet name made safe for a folder name."""
    name = F.regexp_replace(F.regexp_replace(col, r"(?U)[^\p{Alnum}_\-]", "_"), r"^_+|_+\z", "")
    return F.when(name == "", F.lit("sheet")).otherwise(name)


def relative_path(col: Column, root: str) -> Column:
    """Path below ``root``, or the whole path when it lies elsewhere."""
    plain = F.regexp_replace(col, r"^file:(//)?", "")
    prefix = root.rstrip("/") + "/"
    inside = F.substring(plain, F.lit(len(prefix) + 1), F.length(plain))
    return F.when(plain.startswith(prefix), inside).otherwise(plain)


def whole_text(col: Column) -> Column:
    """Text of a double that is a whole number."""
    return F.coalesce(col.try_cast("bigint").cast("string"), col.try_cast("decimal(38,0)").cast("string"))


def double_text(col: Column) -> Column:
    """Shortest decimal text of a double; whole numbers print without a point.

    The JVM switches to an exponent outside 1e-3..1e7, the data model only
    outside 1e-4..1e16.  The steps for those rare values sit in a lambda:
    inlined they would swell the generated code of every caller past what the
    JVM compiles.
    """

    def reshaped(shortest: Column) -> Column:
        size = F.abs(shortest.try_cast("double"))
        plain = F.regexp_replace(shortest.try_cast("decimal(38,20)").cast("string"), r"\.?0+\z", "")
        exponent = F.regexp_replace(shortest, r"(\.0)?E(-?)(\d)\z", "$1E$20$3")
        exponent = F.regexp_replace(exponent, r"(\.0)?E(-?)(\d+)\z", "e$2$3")
        exponent = F.regexp_replace(exponent, r"e(\d)", "e+$1")
        return (
            F.when(shortest == "NaN", F.lit("nan"))
            .when(shortest == "Infinity", F.lit("inf"))
            .when(shortest == "-Infinity", F.lit("-inf"))
            .when((size >= 1e15) & (F.rint(size) == size) & (size < 1e38), whole_text(shortest.try_cast("double")))
            .when((size >= 1e-4) & (size < 1e16), plain)
            .otherwise(exponent)
        )

    rare = F.get(F.transform(F.array(col.cast("string")), reshaped), F.lit(0))
    return (
        F.when((F.rint(col) == col) & (F.abs(col) < 1e15), col.try_cast("bigint").cast("string"))
        .when(F.abs(col).between(1e-3, 9999999.0), col.cast("string"))
        .when(col.isNotNull(), rare)
    )


def timestamp_text(col: Column) -> Column:
    """ISO text of a timestamp; the fraction shows only when there is one."""
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(col, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def to_text(col: Column, kind: str) -> Column:
    """Canonical text of a cell of Spark type ``kind``."""
    if kind in ("double", "float"):
        return double_text(col.cast("double"))
    if kind.startswith("timestamp"):
        return timestamp_text(col)
    if kind == "date":
        return F.date_format(col, "yyyy-MM-dd")
    if kind == "boolean":
        return F.initcap(col.cast("string"))
    return col.cast("string")


def series_number(col: Column, default: int) -> Column:
    """First whole number in a name, for natural ordering."""
    digits = F.get(F.regexp_extract_all(col, F.lit(r"\d+"), F.lit(0)), F.lit(0))
    return F.coalesce(digits.try_cast("bigint"), F.lit(default).cast("bigint"))


def rank_of(col: Column, order: Sequence[str], default: int) -> Column:
    """Position of a name in a given order, 0 first; ``default`` for other names."""
    at = F.array_position(F.array(*[F.lit(name) for name in order]), col) - 1
    return F.when(at >= 0, at).otherwise(F.lit(default)).cast("int")
