"""Values in canonical units, with a status, notes and issues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.dictionaries import ACCEPTED_STATUSES, MIN_CONFIDENCE, dictionary
from specloom.functions.text import SPACES
from specloom.functions.numbers import dual_notation, strict_number, unit_key

PARSE_FAILED = "numeric_parse_failed"
NO_RULE = "unit_no_rule"
LOW_CONFIDENCE = "low_confidence"
UNMAPPED_ITEM = "unmapped_item"

NORMALIZED = [
    "product_id", "company", "product_name", "canonical_item", "normalized_value_numeric",
    "normalized_value_text", "normalized_unit", "original_value", "original_unit", "value_type",
    "value_status", "confidence", "source_table", "source_column", "source_row_id", "unit_system",
    "source_rank", "notes",
]


_NO_VALUE = r"(?i)\A[\s\xa0　]*(?:|n/?a|[-–—])[\s\xa0　]*\z"
_OPTION = r"(?i)\A[\s\xa0　]*opt(?:ion(?:al)?|\.)?[\s\xa0　]*\z"


def value_status(text: Column) -> Column:
    """``present`` unless the cell says there is no value, or that it is an option."""
    return (
        F.when(text.isNull() | text.rlike(_NO_VALUE), F.lit("not_available"))
        .when(text.rlike(_OPTION), F.lit("optional"))
        .otherwise(F.lit("present"))
    )


def unit_text(unit: str) -> str:
    """A rule's unit in the form of ``unit_key``."""
    return unit.lower().translate(dict.fromkeys(map(ord, SPACES))).rstrip(".")


def with_factor(
    obs: DataFrame, conversions: Sequence[tuple[str, str, float]], unit: str = "raw_unit"
) -> DataFrame:
    """Add ``factor`` from the unit to the canonical unit; NULL without a rule."""
    rules = dictionary(
        obs.sparkSession, conversions, "_from string, _to string, factor double", keys=["_from", "_to"],
        forms={"_from": (unit_text, unit_key)},
    )
    keyed = obs.withColumn("_unit", unit_key(F.col(unit)))
    return keyed.join(
        rules, (F.col("_unit") == F.col("_from")) & (F.col("canonical_unit") == F.col("_to")), "left"
    ).drop("_unit", "_from", "_to")


def convert_units(obs: DataFrame, conversions: Sequence[tuple[str, str, float]], value: str) -> DataFrame:
    """Add ``converted``: the value in the canonical unit to four places."""
    return with_factor(obs, conversions).withColumn("converted", F.round(F.col(value) * F.col("factor"), 4))


def annotate(mapped: DataFrame, conversions: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Normalise every observation in one pass, unmapped ones included.

    ``mapped`` carries the mapping and the canonical attributes.  A number in
    twofold notation brings its own unit.  A unit without a rule, or a text
    that is not one clean number, keeps the text and says so in the notes.
    """
    text, unit = F.col("raw_value_text"), F.col("raw_unit")
    plain = F.coalesce("raw_value_numeric", strict_number(text, unit))
    read = (
        mapped.withColumn("_plain", plain)
        .withColumn("_dual", F.when(F.col("_plain").isNull() & text.contains("("), dual_notation(text, unit)))
        .withColumn("_number", F.coalesce("_plain", "_dual.value"))
        .withColumn("_number_unit", F.coalesce("_dual.unit", "raw_unit"))
        .withColumn("value_status", value_status(text))
    )
    ruled = with_factor(read, conversions, "_number_unit")
    accepted = F.col("value_status").isin(*ACCEPTED_STATUSES)
    numeric = accepted & (F.col("value_type") == "numeric")
    no_rule = (
        numeric
        & F.col("_number_unit").isNotNull()
        & F.col("canonical_unit").isNotNull()
        & F.col("factor").isNull()
    )
    flagged = ruled.withColumns({
        "_no_rule": F.coalesce(no_rule, F.lit(False)),
        "_failed": F.coalesce(numeric & ~no_rule & F.col("_number").isNull(), F.lit(False)),
    })
    is_text = F.col("_no_rule") | F.col("_failed") | (F.col("value_type") == "text")
    tag = F.when(
        F.col("_no_rule"),
        F.concat(F.lit(f"[{NO_RULE}] "), unit_key(F.col("_number_unit")), F.lit(" → "), F.col("canonical_unit")),
    ).when(F.col("_failed"), F.lit(f"[{PARSE_FAILED}]"))
    return flagged.withColumns({
        "normalized_value_numeric": F.when(
            numeric & ~F.col("_no_rule"), F.round(F.col("_number") * F.coalesce("factor", F.lit(1.0)), 4)
        ),
        "normalized_value_text": F.when(accepted & is_text, text),
        "normalized_unit": F.when(F.col("value_type") == "numeric", F.col("canonical_unit")),
        "original_value": text,
        "original_unit": unit,
        "notes": F.nullif(F.concat_ws("; ", "mapping_notes", "raw_notes", tag), F.lit("")),
    }).drop("_plain", "_dual", "_number", "_number_unit", "factor")


def normalized_specs(annotated: DataFrame) -> DataFrame:
    """The mapped observations with their values; the id comes from the provenance."""
    key = F.xxhash64("source_table", "source_row_id", "source_column", "canonical_item", "unit_system")
    return annotated.filter(F.col("canonical_item").isNotNull()).select(
        key.alias("normalized_id"), *NORMALIZED
    )


def issues(annotated: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """All issues of all observations; one observation may have several."""

    def issue(when: Column, kind: str, detail: Column) -> Column:
        return F.when(when, F.struct(
            F.lit(kind).alias("issue_type"), F.lit("review").alias("severity"),
            detail.cast("string").alias("detail"), F.lit("open").alias("status"),
        ))

    missing = F.col("canonical_item").isNull()
    low = ~missing & (F.col("confidence") < min_confidence)
    found = F.array_compact(F.array(
        issue(missing, UNMAPPED_ITEM, F.lit(None)),
        issue(F.col("_failed"), PARSE_FAILED, F.col("notes")),
        issue(low, LOW_CONFIDENCE, F.col("mapping_notes")),
        issue(F.col("_no_rule"), NO_RULE, F.col("notes")),
    ))
    return annotated.select(
        "company", "product_id", "source_table", "source_row_id", "raw_item_name",
        F.col("raw_value_text").alias("raw_value"), F.inline(found),
    )
