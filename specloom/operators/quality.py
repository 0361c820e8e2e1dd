"""Quality reports over observations, normalised values and issues.

Every report is an aggregation that merges rows before it moves them.  Lists
in a cell hold distinct source or company names; they are as long as the
catalogue of sources, not as the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.dictionaries import MAX_REPORT_PRIORITY, MIN_CONFIDENCE, dictionary
from specloom.functions.text import double_text
from specloom.operators.normalize import NO_RULE, PARSE_FAILED, with_factor
from specloom.session import cut_lineage

LIST_SEPARATOR = " | "
KEY = ["product_id", "canonical_item"]

# Fixed values of the reports.
CONFLICT = "競合"
UNDECIDED_VALUE = "未確定"
RECORDED = "scope_excluded として記録済み"
UNDECIDED = "未判断"


def _listed(col: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(col)), LIST_SEPARATOR)


def stated_value() -> Column:
    """A normalised value as text, whichever kind it is."""
    return F.coalesce(double_text(F.col("normalized_value_numeric")), F.col("normalized_value_text"))


def conflicts(normalized: DataFrame) -> DataFrame:
    """Products and items with more than one distinct value.

    Equal statements of a source are counted first, so a product with very
    many records is spread over its distinct statements; only those are written
    as text, and Spark counts the distinct texts of a key in two steps.  On a
    table bucketed by product nothing is shuffled.
    """
    number = F.col("normalized_value_numeric")
    text = F.when(number.isNull(), F.col("normalized_value_text"))
    statements = (
        normalized.select(*KEY, "source_table", number.alias("_number"), text.alias("_text"))
        .groupBy(*KEY, "_number", "_text", "source_table")
        .agg(F.count("*").alias("_n"))
    )
    # a number and a text may read alike
    stated = statements.withColumn("_value", F.coalesce(double_text(F.col("_number")), F.col("_text")))
    return (
        stated.groupBy(*KEY)
        .agg(
            F.sum("_n").alias("n_rows"),
            F.count_distinct("_value").alias("n_distinct_values"),
            F.min("_number").alias("min_value"),
            F.max("_number").alias("max_value"),
            _listed("source_table").alias("sources"),
        )
        .filter(F.col("n_distinct_values") > 1)
    )


def flag_conflicts(normalized: DataFrame, stored: bool = False) -> DataFrame:
    """Every record with its conflict status; no value is changed.

    The records are kept as a table, unless they are ``stored`` already, so that they
    are made once.  The status comes from one small row per product and item.  The join back
    is one that adaptive execution may broadcast or split, as the status side
    has unique keys.
    """
    if not stored:
        normalized = cut_lineage(normalized)
    valued = normalized.withColumn("_value", stated_value())
    status = valued.groupBy(*KEY).agg(F.min("_value").alias("_least"), F.max("_value").alias("_most"))
    flag = F.when(F.col("_least").isNull(), UNDECIDED_VALUE).when(F.col("_least") < F.col("_most"), CONFLICT)
    status = status.select(*[F.col(k).alias(f"_{k}") for k in KEY], flag.alias("conflict_status"))
    same = F.lit(True)
    for k in KEY:  # a NULL product is a key like any other
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return normalized.join(status, same, "left").drop(*[f"_{k}" for k in KEY])


def missing_rate(
    best: DataFrame,
    products_in_scope: DataFrame,
    canonical: Sequence[tuple[str, str, str | None, str, int]],
    max_priority: int = MAX_REPORT_PRIORITY,
) -> DataFrame:
    """Share of the products in scope without a best record, per item.

    Text records count; the best records are unique per product and item, so
    counting rows counts products.
    """
    items = dictionary(
        best.sparkSession,
        [(item, category, priority) for item, category, _, _, priority in canonical if priority <= max_priority],
        "canonical_item string, category string, priority int",
        keys=["canonical_item"],
    )
    counted = (
        best.join(products_in_scope.select("product_id"), "product_id", "left_semi")
        .groupBy("canonical_item")
        .agg(F.count("*").alias("n"))
    )
    total = products_in_scope.agg(F.count("*")).scalar()
    return (
        items.join(counted, "canonical_item", "left")
        .withColumn("n_products_with_value", F.coalesce("n", F.lit(0)))
        .withColumn("n_products_total", total)
        .withColumn("missing_rate", F.round(1 - F.try_divide("n_products_with_value", "n_products_total"), 2))
        .drop("n")
    )


def skewed_items(normalized: DataFrame, max_companies: int = 2) -> DataFrame:
    """Items that only a few companies state."""
    pairs = cut_lineage(normalized.select("canonical_item", "company", "product_id").distinct())
    few = (
        pairs.groupBy("canonical_item")
        .agg(F.count_distinct("company").alias("n_companies"), F.count_distinct("product_id").alias("n_products"))
        .filter(F.col("n_companies") <= max_companies)
        .withColumnRenamed("canonical_item", "_item")
    )
    # at most ``max_companies`` names are listed for an item
    named = pairs.select("canonical_item", "company").join(few, F.col("canonical_item").eqNullSafe(F.col("_item")))
    return named.groupBy("canonical_item", "n_companies", "n_products").agg(_listed("company").alias("companies"))


def low_confidence(mapped: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Uncertain mappings by company and raw item, with the number of rows."""
    weak = mapped.filter(F.col("canonical_item").isNotNull() & (F.col("confidence") < min_confidence))
    return weak.groupBy(
        "company", "raw_item_name", "canonical_item", "mapping_method", "confidence",
        F.col("mapping_notes").alias("notes"),
    ).agg(F.count("*").alias("n_products"))


def parse_failures(normalized: DataFrame) -> DataFrame:
    """Records kept as text because their number or unit could not be read."""
    notes = F.col("notes")
    return normalized.filter(notes.contains(f"[{PARSE_FAILED}]") | notes.contains(f"[{NO_RULE}]")).select(
        "company", "product_id", "canonical_item", "original_value", "original_unit", "source_table", "notes"
    )


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issues by type: how many, and whose."""
    return issues.groupBy("issue_type", "severity").agg(
        F.count("*").alias("n"), _listed("company").alias("companies")
    )


def unit_mismatches(mapped: DataFrame, conversions: Sequence[tuple[str, str, float]] | DataFrame) -> DataFrame:
    """Mapped numeric rows whose unit has no rule to the canonical unit, by the rules that convert it."""
    units = mapped.filter(
        (F.col("value_type") == "numeric") & F.col("raw_unit").isNotNull() & F.col("canonical_unit").isNotNull()
    )
    return with_factor(units, conversions).filter(F.col("factor").isNull()).select(
        "company", "product_id", "canonical_item", F.col("raw_unit").alias("original_unit"), "canonical_unit",
        F.col("raw_value_text").alias("original_value"), "source_table",
    )


def unmapped_items(mapped: DataFrame, order: Sequence[str]) -> DataFrame:
    """Unknown items by company: rows, and the table and value of the first one."""
    first = F.struct(*order)
    return (
        mapped.filter(F.col("canonical_item").isNull())
        .groupBy("company", "raw_item_name")
        .agg(
            F.count("*").alias("n_products"),
            F.min_by(F.struct("source_table", "raw_value_text"), first).alias("_sample"),
        )
        .select(
            "company", "raw_item_name", "n_products",
            F.col("_sample.source_table").alias("sample_table"),
            F.col("_sample.raw_value_text").alias("sample_value"),
        )
    )


def uncovered_sources(imports: DataFrame, obs: DataFrame, issues: DataFrame) -> DataFrame:
    """Imported tables without an observation, and whether that was decided."""
    recorded = (
        issues.filter(F.col("issue_type") == "scope_excluded")
        .select(F.col("source_table").alias("table_name"), F.lit(RECORDED).alias("_status"))
        .distinct()
    )
    observed = obs.select(F.col("source_table").alias("table_name")).distinct()
    return (
        imports.join(observed, "table_name", "left_anti")
        .join(recorded, "table_name", "left")
        .withColumn("scope_status", F.coalesce("_status", F.lit(UNDECIDED)))
        .drop("_status")
    )


def orphans(obs: DataFrame, source_rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Observations whose source row does not exist."""
    return obs.join(source_rows.select(*key), list(key), "left_anti")


def key_violations(df: DataFrame, key: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Rows per broken rule: repeated keys, and NULL in required columns.

    Rows are counted per key with their NULLs, then summed, in one scan.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(required)]
    per_key = df.groupBy(*key).agg(F.count("*").alias("_n"), *nulls)
    sums = per_key.agg(
        F.coalesce(F.count_if(F.col("_n") > 1), F.lit(0)).alias("_repeated"),
        *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(required))],
    )
    checks = [F.struct(F.lit("unique").alias("rule"), F.lit(", ".join(key)).alias("columns"),
                       F.col("_repeated").alias("n_violations"))]
    checks += [
        F.struct(F.lit("not null").alias("rule"), F.lit(c).alias("columns"), F.col(f"_null_{i}").alias("n_violations"))
        for i, c in enumerate(required)
    ]
    return sums.select(F.inline(F.array(*checks)))
