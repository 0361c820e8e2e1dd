"""From a grid of cells to named, typed columns.

A grid has one row per cell: ``raw_path, sheet_name, row_no, col_no, value``.
Windows here run over one row, or one header, of one sheet.  Their size is the
width of a sheet, not its length.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from specloom.functions.text import clean_identifier, is_blank, strip
from specloom.session import cut_lineage
from specloom.sources.sheets import cells_of, filled_rows

SHEET = ("raw_path", "sheet_name")


@F.pandas_udf(StringType())
def _fold_width(names: pd.Series) -> pd.Series:
    return names.map(lambda name: unicodedata.normalize("NFKC", name), na_action="ignore")


def build_header(grid: DataFrame, header_rows: int = 1, placed: bool = False) -> DataFrame:
    """``(raw_path, sheet_name, col_no, header)`` from the first rows of each sheet.

    In every header row but the last a blank takes the last value to its left;
    the parts of a column are joined with ``_``.  Columns without a part are
    dropped.  ``placed`` says that the rows of a sheet are together already.
    """
    cell = F.when(~is_blank(F.col("value")), F.col("value"))
    head = grid.filter(F.col("row_no") <= header_rows).withColumn("value", cell)
    if header_rows == 1:
        return head.filter(F.col("value").isNotNull()).select(
            *SHEET, "col_no", strip(F.col("value")).alias("header")
        )
    # A header is as long as its sheet is wide, so a sheet's header may meet in
    # one place; the grouping, the window and the numbering of names share it.
    if not placed:
        head = head.repartition(*SHEET)
    # One row a column, with its cells side by side; a short row has no cell there, which is not a blank one.
    above = range(1, header_rows + 1)
    columns = head.groupBy(*SHEET, "col_no").agg(*[
        F.max(F.when(F.col("row_no") == r, F.struct("value"))).alias(f"_cell_{r}") for r in above
    ])
    to_left = Window.partitionBy(*SHEET).orderBy("col_no")

    def part(row: int) -> Column:
        value = F.col(f"_cell_{row}")["value"]
        if row < header_rows:
            value = F.when(F.col(f"_cell_{row}").isNotNull(), F.last(value, ignorenulls=True).over(to_left))
        return strip(value)

    return columns.select(*SHEET, "col_no", F.concat_ws("_", *[part(r) for r in above]).alias("header")).filter(
        F.col("header") != ""
    )


def clean_names(headers: DataFrame, name: str = "header") -> DataFrame:
    """Add ``column_name``: the header as an identifier.

    Compatibility folding has no built-in function; it runs on the distinct
    names with a non-ASCII character only.  The headers, a small part of the
    grid, are kept as a table, so that this does not read the grid twice, and so
    are the folded names: as their size is known, the headers need not be
    shuffled by name, of which there may be very few.
    """
    headers = cut_lineage(headers)
    foreign = headers.filter(F.col(name).rlike(r"[^\x00-\x7F]")).select(name).distinct()
    folded = cut_lineage(foreign.withColumn("_folded", _fold_width(F.col(name))))
    return headers.join(folded, name, "left").withColumn(
        "column_name", clean_identifier(F.coalesce("_folded", F.col(name)))
    ).drop("_folded")


def unique_names(headers: DataFrame, name: str = "column_name") -> DataFrame:
    """Number repeated names of a sheet from the second on: ``n``, ``n_2``, ``n_3``."""
    seen = F.row_number().over(Window.partitionBy(*SHEET, name).orderBy("col_no"))
    return headers.withColumn("_seen", seen).withColumn(
        name,
        F.when(F.col("_seen") > 1, F.concat_ws("_", F.col(name), F.col("_seen"))).otherwise(
            F.col(name)
        ),
    ).drop("_seen")


def drop_blank_rows(cells: DataFrame) -> DataFrame:
    """Drop rows whose cells are all blank; the others keep their numbers."""
    row = Window.partitionBy(*SHEET, "row_no")
    return (
        cells.withColumn("_filled", F.max(~is_blank(F.col("value"))).over(row))
        .filter("_filled")
        .drop("_filled")
    )


def cell_class(value: Column) -> Column:
    """What one text cell can be read as: bool, int, double or text.

    A whole number is an int only if it reads back as it was written; codes
    with leading zeros and numbers beyond 64 bits are text, never a double.
    """
    same = F.coalesce(value.try_cast("bigint").cast("string") == value, F.lit(False))
    return (
        F.when(value.rlike(r"(?i)\A(?:true|false)\z"), F.lit("bool"))
        .when(same, F.lit("int"))
        .when(value.rlike(r"\A[+-]?\d+\z"), F.lit("text"))
        .when(value.rlike(r"\A[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\z"), F.lit("double"))
        .otherwise(F.lit("text"))
    )


def infer_types(cells: DataFrame, column: str = "column_name") -> DataFrame:
    """``(raw_path, sheet_name, column, data_type)`` from the non-null cells.

    One aggregation for all columns.  A column without values is text, and so
    is one of mixed kinds, to keep the original.
    """
    return _column_types(cells, column)


def _column_types(cells: DataFrame, column: str) -> DataFrame:
    kind = cell_class(F.col("value"))
    filled = F.col("value").isNotNull()
    counted = cells.groupBy(*SHEET, column).agg(
        F.count_if(filled).alias("_n"),
        F.count_if(filled & (kind == "bool")).alias("_bool"),
        F.count_if(filled & (kind == "int")).alias("_int"),
        F.count_if(filled & kind.isin("int", "double")).alias("_number"),
    )
    data_type = (
        F.when(F.col("_n") == 0, F.lit("VARCHAR"))
        .when(F.col("_bool") == F.col("_n"), F.lit("BOOLEAN"))
        .when(F.col("_int") == F.col("_n"), F.lit("BIGINT"))
        .when(F.col("_number") == F.col("_n"), F.lit("DOUBLE"))
        .otherwise(F.lit("VARCHAR"))
    )
    return counted.select(*SHEET, column, data_type.alias("data_type"))


def named_cells(grid: DataFrame, header_rows: int = 1) -> DataFrame:
    """All steps on a grid of cells: header, names, data cells of named columns without blank rows.

    Readers that have whole rows use ``import_rows``, which tests rows before it spreads them.
    """
    headers = cut_lineage(unique_names(clean_names(build_header(grid, header_rows))).drop("header"))
    data = grid.filter(F.col("row_no") > header_rows)
    named = data.join(headers, [*SHEET, "col_no"])
    return drop_blank_rows(named)


def import_rows(rows: DataFrame, header_rows: int = 1) -> DataFrame:
    """The whole import of packed rows: header, names, blank rows out, types, typed values.

    Only header rows are spread into cells before their names are known.  Names
    and types of a sheet, as long as it is wide, are kept as a table: as its
    size is known, Spark sends it to the rows, and these are neither shuffled
    nor sorted for it.  Once a row is spread, its cells do not move any more.
    """
    rows = cut_lineage(rows)
    top = cells_of(rows.filter(F.col("row_no") <= header_rows))
    names = cut_lineage(unique_names(clean_names(build_header(top, header_rows))).drop("header"))
    data = filled_rows(rows.filter(F.col("row_no") > header_rows))
    kinds = _column_types(cells_of(data), "col_no")
    columns = cut_lineage(
        names.join(kinds, [*SHEET, "col_no"], "left").groupBy(*[F.col(c).alias(f"_{c}") for c in SHEET]).agg(
            F.sort_array(F.collect_list(F.struct(
                "col_no", "column_name", F.coalesce("data_type", F.lit("VARCHAR")).alias("data_type")
            ))).alias("_columns")
        )
    )
    same = F.lit(True)
    for c in SHEET:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    spread = data.join(columns, same).select(*SHEET, "row_no", "cells", F.inline("_columns"))
    cells = spread.filter(F.col("col_no") <= F.size("cells")).withColumn("value", F.element_at("cells", F.col("col_no")))
    return _typed(cells).select(
        *SHEET, "row_no", "col_no", "column_name", "data_type", "text_value", "integer_value", "number_value", "truth_value"
    )


def _typed(cells: DataFrame) -> DataFrame:
    """``value`` as text and in its column's type; no cast can fail, as a type is one that all values have."""
    kind, value = F.col("data_type"), F.col("value")
    return cells.withColumns({
        "text_value": value,
        "integer_value": F.when(kind == "BIGINT", value.try_cast("bigint")),
        "number_value": F.when(kind.isin("BIGINT", "DOUBLE"), value.try_cast("double")),
        "truth_value": F.when(kind == "BOOLEAN", F.lower(value) == "true"),
    }).drop("value")


def typed_cells(cells: DataFrame, column: str = "column_name") -> DataFrame:
    """The cells with their column's type and their value in it: text, whole number, number or truth value.

    ``text_value`` always has the original; of the other three the one of the
    type is filled.  No cast can fail: a column has a type only if all its
    values have it.  The types, one row a column, are kept as a table, so that
    Spark can send them to the cells.
    """
    names = [*SHEET, column]
    types = cut_lineage(infer_types(cells, column).select(*[F.col(c).alias(f"_{c}") for c in names], "data_type"))
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return _typed(cells.join(types, same).drop(*[f"_{c}" for c in names]))


def rows_manifest(rows: DataFrame, names: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """``import_manifest`` of packed data rows and the sheets' names: rows are counted where they lie, in one pass."""
    ordered = F.array_sort(F.collect_list(F.struct("col_no", "column_name")))
    columns = names.groupBy(*SHEET).agg(F.array_join(F.transform(ordered, lambda n: n["column_name"]), ", ").alias("columns"))
    counts = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in SHEET]).agg(F.count("*").alias("_n"))
    same = F.lit(True)
    for c in SHEET:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    manifest = columns.join(counts, same, "left").select(*SHEET, "columns", F.coalesce("_n", F.lit(0)).alias("row_count"))
    return manifest.withColumn("loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)


def import_manifest(cells: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Per sheet: its columns in order, joined with ``', '``, its rows, the load time."""
    names = F.array_sort(F.collect_list(F.struct("col_no", "column_name")))
    columns = cells.select(*SHEET, "col_no", "column_name").distinct().groupBy(*SHEET).agg(
        F.array_join(F.transform(names, lambda n: n["column_name"]), ", ").alias("columns")
    )
    # rows are counted apart, so that no row carries the names along
    counts = cells.select(*[F.col(c).alias(f"_{c}") for c in SHEET], "row_no").distinct().groupBy(
        *[f"_{c}" for c in SHEET]
    ).agg(F.count("row_no").alias("row_count"))
    same = F.lit(True)
    for c in SHEET:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    manifest = columns.join(counts, same).select(*SHEET, "columns", "row_count")
    return manifest.withColumn("loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)
