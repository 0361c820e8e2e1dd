"""What tables hold: counts, column groups, roles, samples, summaries, pages of rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.dictionaries import COLUMN_ROLES, NO_ROLE, ROLE_ORDER, dictionary
from specloom.functions.text import to_text
from specloom.operators.ordering import first_per_group, with_position

MAX_PAGE = 500


def table_counts(tables: Mapping[str, DataFrame], origins: Mapping[str, str]) -> DataFrame:
    """Rows per table and where it came from, as one job.  Reads no columns."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(origins.get(name, "")).alias("raw_path")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _signatures(columns: DataFrame) -> DataFrame:
    """One row per table; the list is as long as the table is wide."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "column_name")))
    joined = F.array_join(F.transform(ordered, lambda c: c["column_name"]), ", ")
    return columns.groupBy("table_name").agg(joined.alias("columns"))


def signature_groups(columns: DataFrame) -> DataFrame:
    """Tables with the same ordered columns: how many, and the first by name.

    ``columns`` has ``table_name, column_name, position``, without the
    provenance columns.
    """
    return _signatures(columns).groupBy("columns").agg(
        F.count("*").alias("n_tables"), F.min("table_name").alias("representative")
    )


def signature_members(columns: DataFrame) -> DataFrame:
    """The members of each group as rows, since a group has no bound on its size."""
    tables = _signatures(columns)
    first = tables.groupBy("columns").agg(F.min("table_name").alias("representative"))
    return tables.join(first, "columns").select("representative", "table_name")


def role_candidates(
    columns: DataFrame, roles: Sequence[tuple[str, str]] = COLUMN_ROLES
) -> DataFrame:
    """Columns by the role their name marks, as ``role=a/b; role=c``."""
    rules = dictionary(columns.sparkSession, roles, "role string, column_name string")
    found = (
        columns.join(rules, "column_name", "left")
        .groupBy("table_name")
        .agg(F.array_sort(F.collect_list(F.when(
            F.col("role").isNotNull(), F.struct("position", "column_name", "role")
        ))).alias("_found"))
    )

    def one(role: str) -> Column:
        names = F.transform(F.filter("_found", lambda c: c["role"] == role), lambda c: c["column_name"])
        return F.when(F.size(names) > 0, F.concat(F.lit(f"{role}="), F.array_join(names, "/")))

    text = F.concat_ws("; ", *[one(role) for role in ROLE_ORDER])
    return found.select(
        "table_name", F.when(text == "", F.lit(NO_ROLE)).otherwise(text).alias("roles")
    )


def sample_rows(
    df: DataFrame, table: str, order: Sequence[Column], cols: Sequence[str], n: int = 3, width: int = 40
) -> DataFrame:
    """The first ``n`` rows of each table as one line, each cell cut to ``width``."""
    kinds = dict(df.dtypes)
    cells = [
        F.coalesce(F.substring(to_text(F.col(c), kinds[c]), 1, width), F.lit("")) for c in cols
    ]
    picked = first_per_group(df, [table], order, n, "sample_no")
    return picked.select(
        table, F.col("sample_no").cast("bigint").alias("sample_no"), F.concat_ws(" | ", *cells).alias("sample")
    )


def summarize(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, distinct values, least, greatest, mean; one scan.

    Values are counted first, which merges repeats before the shuffle and
    makes the distinct count exact without one copy of the table per column.
    """
    whole = {"tinyint", "smallint", "int", "bigint"}
    numeric = {*whole, "float", "double"}

    def cell(name: str, kind: str) -> Column:
        number = F.col(name).cast("double") if kind in numeric else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            to_text(F.col(name), kind).alias("value"),
            number.alias("number"),
            (F.col(name).cast("bigint") if kind in whole else F.lit(None).cast("bigint")).alias("whole"),
        )

    cells = df.select(F.inline(F.array(*[cell(n, k) for n, k in df.dtypes])))
    values = cells.groupBy("column_name", "column_type", "value").agg(
        F.count("*").alias("n"), F.max("number").alias("number"), F.max("whole").alias("whole")
    )

    def extreme(pick: Callable[[str], Column]) -> Column:
        # whole numbers stay whole: a double would lose digits beyond 2^53
        return (
            F.when(F.col("column_type").isin(*whole), pick("whole").cast("string"))
            .when(F.col("column_type").isin(*numeric), pick("number").cast("string"))
            .otherwise(pick("value"))
        )

    least, most = extreme(F.min), extreme(F.max)
    return values.groupBy("column_name", "column_type").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
        least.alias("min_value"),
        most.alias("max_value"),
        F.round(F.sum(F.col("number") * F.col("n")) / F.sum(F.when(F.col("number").isNotNull(), F.col("n"))), 4)
        .alias("mean_value"),
    )


#: Registers of a sketch as a power of two; up to an eighth as many values it counts exactly.
SKETCH_LG_K = 16


def summarize_sketch(df: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """``summarize`` in one pass with mergeable sketches: the distinct count is an estimate.

    Each column is one set of partial aggregates, so a task sends one row,
    whatever the table holds; the row is turned into one per column at the end.
    The standard error is about ``1.04 / sqrt(2 ** lg_k)``, 0.4 % by default.
    """
    kinds = df.dtypes
    whole, numeric = {"tinyint", "smallint", "int", "bigint"}, {"tinyint", "smallint", "int", "bigint", "float", "double"}
    parts = [F.count("*").alias("_rows")]
    for i, (name, kind) in enumerate(kinds):
        value = F.col(name)
        text = value.cast("bigint") if kind in whole else to_text(value, kind)
        compared = value.cast("double") if kind in ("float", "double") else text
        parts += [
            F.count(value).alias(f"_n{i}"), F.hll_sketch_agg(text, lg_k).alias(f"_s{i}"),
            F.min(compared).cast("string").alias(f"_a{i}"), F.max(compared).cast("string").alias(f"_z{i}"),
            (F.avg(value.cast("double")) if kind in numeric else F.max(F.lit(None).cast("double"))).alias(f"_m{i}"),
        ]
    columns = [
        F.struct(
            F.lit(name).alias("column_name"), F.lit(kind).alias("column_type"), F.col("_rows").alias("n_rows"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("n_null"),
            F.coalesce(F.hll_sketch_estimate(f"_s{i}"), F.lit(0)).alias("n_distinct"),
            F.col(f"_a{i}").alias("min_value"), F.col(f"_z{i}").alias("max_value"), F.round(f"_m{i}", 4).alias("mean_value"),
        )
        for i, (name, kind) in enumerate(kinds)
    ]
    return df.agg(*parts).select(F.inline(F.array(*columns)))


def page(df: DataFrame, order: Sequence[Column], limit: int = 100, offset: int = 0) -> DataFrame:
    """One page of a table in a given order, each row with the table's row count."""
    limit = max(0, min(limit, MAX_PAGE))
    offset = max(0, offset)
    total = df.agg(F.count("*")).scalar()
    # each task keeps its first offset + limit rows; far pages, which Spark sorts, are as rare as they are deep
    return df.orderBy(*order).offset(offset).limit(limit).withColumn("total_rows", total)


def head_with_flag(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows and whether there are more; fetches one row extra."""
    fetched = df.orderBy(*order).limit(n + 1)
    # At most n + 1 rows reach these windows.
    together = Window.partitionBy(F.lit(0))
    return (
        fetched.withColumn("truncated", F.count("*").over(together) > n)
        .withColumn("_at", F.row_number().over(together.orderBy(*order)))
        .filter(F.col("_at") <= n)
        .drop("_at")
    )


def search(df: DataFrame, term: str) -> DataFrame:
    """Rows in which some cell contains ``term``, in any letter case."""
    cells = F.array(*[F.col(c).cast("string") for c in df.columns])
    wanted = F.lit(term.lower())
    return df.filter(F.exists(cells, lambda c: F.coalesce(F.lower(c).contains(wanted), F.lit(False))))


def null_last(col: str, descending: bool = False, locale: str | None = None) -> Column:
    """Sort order with NULL last in both directions; text by ``locale`` if named."""
    key = F.col(col) if locale is None else F.collate(F.col(col), locale)
    return key.desc_nulls_last() if descending else key.asc_nulls_last()


def sorted_positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Every row with its place in the sorted table."""
    return with_position(df, [], order, name)
