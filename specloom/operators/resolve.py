"""The best record per product and item, and the comparison tables made of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.dictionaries import ACCEPTED_STATUSES, CORE_ITEMS, FULL_ITEMS, UNIT_SYSTEM_ORDER
from specloom.functions.text import rank_of
from specloom.operators.ordering import first_per_group

CORE_PRODUCT_COLUMNS = [
    "product_id", "company", "product_name", "model_code", "market_segment", "power_type",
    "telescopic", "sales_status",
]
FULL_PRODUCT_COLUMNS = [
    "product_id", "company", "product_name", "model_code", "series", "market_segment", "power_type",
    "telescopic", "sales_status",
]


def preference(ids: Sequence[str]) -> list[Column]:
    """Order of records of one product and item, best first; ``ids`` settle ties."""
    system = rank_of(F.col("unit_system"), UNIT_SYSTEM_ORDER, len(UNIT_SYSTEM_ORDER))
    return [
        F.col("confidence").desc_nulls_last(),
        F.col("source_rank").asc_nulls_last(),
        F.coalesce(system, F.lit(len(UNIT_SYSTEM_ORDER))).asc(),
        *[F.col(i).asc_nulls_last() for i in ids],
    ]


def best_record(
    normalized: DataFrame,
    ids: Sequence[str] = ("normalized_id",),
    accepted: Sequence[str] = ACCEPTED_STATUSES,
) -> DataFrame:
    """The preferred record per (product, item) among the accepted ones.

    A record kept as text may win over a number; the comparison then shows no
    number, as the better source gives none.
    """
    usable = normalized.filter(F.col("value_status").isin(*accepted))
    return first_per_group(usable, ["product_id", "canonical_item"], preference(ids))


def best_record_of_rows(
    rows: DataFrame,
    kind: Sequence[str],
    spread: Callable[[DataFrame], DataFrame],
    row_ids: Sequence[str],
    ids: Sequence[str] = ("normalized_id",),
    accepted: Sequence[str] = ACCEPTED_STATUSES,
) -> DataFrame:
    """``best_record`` of the records that ``spread`` makes of wide rows, found without moving the records.

    A row's records share all that ``preference`` looks at but the last of ``ids``, and rows of the same
    ``kind`` give records of the same items.  So of a product's rows of one kind only the preferred one can
    hold a best record.  Rows are narrower than their records, and those that remain, one a product and
    kind, are brought together by product before they are spread; grouping by product then moves nothing.
    The number of partitions is given: merged by the size of rows, they would be too large for the records.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    usable = rows.filter(F.col("value_status").isin(*accepted))
    kept = first_per_group(usable, ["product_id", *kind], preference(row_ids))
    return best_record(spread(kept.repartition(parts, "product_id")), ids, accepted)


def pivot_items(
    products: DataFrame, best: DataFrame, items: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """One row per product with a column per item; products without values stay.

    The items are given, so no job has to look for them, and the records are
    reduced to one row per product before they meet the products.
    """
    def cell(item: str, column: str, kind: str) -> Column:
        value = F.col("normalized_value_text" if kind == "text" else "normalized_value_numeric")
        return F.max(F.when(F.col("canonical_item") == item, value)).alias(column)

    wanted = best.filter(F.col("canonical_item").isin(*[item for item, _, _ in items]))
    rows = wanted.groupBy("product_id").agg(*[cell(*i) for i in items])
    return products.join(rows, "product_id", "left")


def comparison_core(products: DataFrame, best: DataFrame) -> DataFrame:
    """The core comparison: numbers only."""
    return pivot_items(products, best, [(item, column, "numeric") for item, column in CORE_ITEMS])


def comparison_full(products: DataFrame, best: DataFrame) -> DataFrame:
    """The full comparison: numbers and texts."""
    return pivot_items(products, best, FULL_ITEMS)


# The comparison people mean when they name none.
comparison = comparison_core
