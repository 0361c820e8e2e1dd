"""Raw layouts to long observations, and the product dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.dictionaries import UNIT_SUFFIXES, dictionary
from specloom.functions.text import is_blank, to_text

# Columns of an observation: name, type, value when the layout has none.
OBSERVATION = [
    ("company", "string", None),
    ("product_id", "string", None),
    ("product_name", "string", None),
    ("source_table", "string", None),
    ("source_sheet", "string", None),
    ("source_row_id", "bigint", None),
    ("source_column", "string", None),
    ("raw_category", "string", None),
    ("raw_item_name", "string", None),
    ("raw_value_text", "string", None),
    ("raw_value_numeric", "double", None),
    ("raw_unit", "string", None),
    ("unit_system", "string", "unspecified"),
    ("source_rank", "int", 1),
    ("raw_notes", "string", None),
]


def observations(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Observation rows from column expressions; what is not named takes its default."""
    unknown = set(columns) - {name for name, _, _ in OBSERVATION}
    if unknown:
        raise ValueError(f"not observation columns: {sorted(unknown)}")

    def filled(name: str, kind: str, default: object) -> Column:
        value = columns.get(name)
        if value is None:
            return F.lit(default).cast(kind)
        value = value.cast(kind)
        return value if default is None else F.coalesce(value, F.lit(default).cast(kind))

    return df.select(*[filled(*spec).alias(spec[0]) for spec in OBSERVATION])


def melt_long(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """A table that already has one row per observation."""
    return observations(df, columns)


def suffix_unit(name: str, suffixes: Mapping[str, str] = UNIT_SUFFIXES) -> str | None:
    """The unit a wide column's name ends in; the longest suffix counts."""
    ending = max((s for s in suffixes if name.endswith(s)), key=len, default=None)
    return suffixes[ending] if ending else None


def melt_wide(
    df: DataFrame,
    keys: Mapping[str, Column],
    cols: Sequence[str],
    suffixes: Mapping[str, str] = UNIT_SUFFIXES,
    source_rank: int = 2,
) -> DataFrame:
    """One row per product, one column per item; NULL cells give no observation."""
    kinds = dict(df.dtypes)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("item"),
            to_text(F.col(c), kinds[c]).alias("text"),
            (F.col(c) if kinds[c] in numeric else F.lit(None)).cast("double").alias("number"),
            F.lit(suffix_unit(c, suffixes)).cast("string").alias("unit"),
        )
        for c in cols
    ])
    long = df.select(*[c.alias(f"_{k}") for k, c in keys.items()], F.inline(cells))
    return observations(long.filter(F.col("text").isNotNull()), {
        **{k: F.col(f"_{k}") for k in keys},
        "source_column": F.col("item"),
        "raw_item_name": F.col("item"),
        "raw_value_text": F.col("text"),
        "raw_value_numeric": F.col("number"),
        "raw_unit": F.col("unit"),
        "source_rank": F.lit(source_rank),
    })


def melt_matrix(
    df: DataFrame, keys: Mapping[str, Column], products: Mapping[str, str]
) -> DataFrame:
    """Item rows by product columns; ``products`` maps a column to its product id."""
    kinds = dict(df.dtypes)
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(p).alias("product"), to_text(F.col(c), kinds[c]).alias("text"))
        for c, p in products.items()
    ])
    long = df.select(*[c.alias(f"_{k}") for k, c in keys.items()], F.inline(cells))
    return observations(long.filter(~is_blank(F.col("text"))), {
        **{k: F.col(f"_{k}") for k in keys},
        "product_id": F.col("product"),
        "source_column": F.col("column"),
        "raw_value_text": F.col("text"),
    })


def melt_groups(
    df: DataFrame,
    keys: Mapping[str, Column],
    groups: Sequence[tuple[Mapping[str, str], str, str | None]],
) -> DataFrame:
    """Groups of (value column, unit column) that share a row.

    Each group names the observation fields it stands for, such as the
    product and the unit system, then its value column and unit column.
    """
    labels = sorted({name for fields, _, _ in groups for name in fields})
    kinds = dict(df.dtypes)
    cells = F.array(*[
        F.struct(
            *[F.lit(fields.get(name)).cast("string").alias(name) for name in labels],
            F.lit(value).alias("column"),
            to_text(F.col(value), kinds[value]).alias("text"),
            (F.col(unit) if unit else F.lit(None)).cast("string").alias("unit"),
        )
        for fields, value, unit in groups
    ])
    long = df.select(*[c.alias(f"_{k}") for k, c in keys.items()], F.inline(cells))
    return observations(long.filter(~is_blank(F.col("text"))), {
        "source_column": F.col("column"),
        **{k: F.col(f"_{k}") for k in keys},
        **{name: F.col(name) for name in labels},
        "raw_value_text": F.col("text"),
        "raw_unit": F.col("unit"),
    })


def melt_dual_unit(
    df: DataFrame, keys: Mapping[str, Column], us: tuple[str, str], metric: tuple[str, str]
) -> DataFrame:
    """Rows that state a value in both unit systems: up to two observations each."""
    return melt_groups(
        df, keys, [({"unit_system": "us"}, *us), ({"unit_system": "metric"}, *metric)]
    )


def union_observations(parts: Sequence[DataFrame]) -> DataFrame:
    """All layouts together, each observation with an id made of its provenance.

    The id is a hash: stable between runs and without an order to agree on, but
    not proof against collision among very many rows.  Join on the provenance
    columns themselves.
    """
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    key = ["source_table", "source_row_id", "source_column", "raw_item_name", "unit_system"]
    return union.withColumn("raw_spec_id", F.xxhash64(*key))


def with_source_rank(obs: DataFrame, ranks: Sequence[tuple[str, int]]) -> DataFrame:
    """Rank of an observation's table, 1 for tables without one."""
    rules = dictionary(obs.sparkSession, ranks, "source_table string, _rank int", keys=["source_table"])
    return (
        obs.drop("source_rank")
        .join(rules, "source_table", "left")
        .withColumn("source_rank", F.coalesce("_rank", F.lit(1)))
        .drop("_rank")
    )


def build_products(
    rows: DataFrame, key: Sequence[str], columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per product: each column from the best source that knows it.

    An aggregation, so that sources of one product are reduced before they
    are brought together.
    """
    # NULL comes last, in every column of the order
    best = F.struct(*[x for i, c in enumerate(order) for x in (F.isnull(c).alias(f"n{i}"), F.col(c).alias(f"c{i}"))])
    return rows.groupBy(*key).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), best)).alias(c) for c in columns]
    ).withColumn("confidence", F.lit(1.0))


def in_scope(obs: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Observations of the tables that are in scope."""
    tables = dictionary(obs.sparkSession, [(t,) for t in excluded], "source_table string", keys=["source_table"])
    return obs.join(tables, "source_table", "left_anti")


def scope_issues(tables: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """One issue per table that is left out."""
    rules = dictionary(tables.sparkSession, [(t,) for t in excluded], "source_table string")
    return tables.select("source_table").join(rules, "source_table", "left_semi").distinct().select(
        F.lit("scope_excluded").alias("issue_type"),
        F.lit("info").alias("severity"),
        "source_table",
        F.lit("open").alias("status"),
    )
