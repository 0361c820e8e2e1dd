"""Sheet-like sources as a grid of cells, and sheets written back."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specloom.functions.text import is_blank, relative_path, sheet_file_name, to_text
from specloom.operators.ordering import with_position
from specloom.session import cut_lineage

GRID = "raw_path string, sheet_name string, row_no bigint, col_no int, value string"
#: A grid with one row for each row of a sheet.
ROWS = "raw_path string, sheet_name string, row_no bigint, cells array<string>"
_BATCH_CELLS = 50_000


def _packed(path: str, sheet: str, rows: Iterator[tuple[int, list[str]]]) -> Iterator[pd.DataFrame]:
    """The rows in batches; an empty field is NULL and a field may have any length."""
    csv.field_size_limit(sys.maxsize)
    batch: list[tuple] = []
    cells = 0
    for row_no, fields in rows:
        batch.append((path, sheet, row_no, [f or None for f in fields]))
        cells += len(fields)
        if cells >= _BATCH_CELLS:
            yield pd.DataFrame(batch, columns=["raw_path", "sheet_name", "row_no", "cells"])
            batch, cells = [], 0
    if batch:
        yield pd.DataFrame(batch, columns=["raw_path", "sheet_name", "row_no", "cells"])


def cells_of(rows: DataFrame) -> DataFrame:
    """Packed rows as a grid of cells."""
    return rows.select("raw_path", "sheet_name", "row_no", F.posexplode("cells").alias("_pos", "value")).select(
        "raw_path", "sheet_name", "row_no", (F.col("_pos") + 1).alias("col_no"), "value"
    )


def filled_rows(rows: DataFrame) -> DataFrame:
    """Packed rows with a cell that is not blank; the others keep their numbers.  Nothing moves."""
    return rows.filter(F.exists("cells", lambda c: ~is_blank(c)))


def sheet_of_path(path: Column) -> Column:
    """A file's name without its ending."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def read_rows(
    spark: SparkSession, paths: str | Sequence[str], root: str = "", delimiter: str = ",",
    sheet: Callable[[Column], Column] = sheet_of_path,
) -> DataFrame:
    """The rows of many delimited sheet files, one file a sheet, which ``sheet`` names by the path.

    Files are read side by side; a field may hold line breaks, so a file is
    split by one task, which needs its bytes several times over.  A file is one cell of Spark's
    reader, which ends at 2 GB; use ``read_line_grid`` for long files.
    """
    files = spark.read.format("binaryFile").load(paths).select(
        relative_path(F.col("path"), root).alias("raw_path"), sheet(F.col("path")).alias("sheet_name"), "content",
    )

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, sheet, content in batch.itertuples(index=False):
                text = io.StringIO(bytes(content).decode("utf-8-sig"), newline="")
                yield from _packed(path, sheet, enumerate(csv.reader(text, delimiter=delimiter), start=1))

    return files.mapInPandas(split, ROWS)


def read_grid(
    spark: SparkSession, paths: str | Sequence[str], root: str = "", delimiter: str = ","
) -> DataFrame:
    """The cells of many delimited sheet files; see ``read_rows``."""
    return cells_of(read_rows(spark, paths, root, delimiter))


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, line_no, line)`` of text files read in splits.

    A split knows where its block starts but not how many lines lie before it.
    Ids rise by one inside a block, so one row per block, its first id and its
    count, gives every line its number without moving the lines.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    blocks = cut_lineage(
        lines.groupBy("path", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_lines"))
    )
    before = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "path", "_block", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_offset")
    )
    number = F.col("_offset") + F.col("_id") - F.col("_first") + 1
    return lines.join(offsets, ["path", "_block"]).select("path", number.alias("line_no"), "line")


def read_line_grid(
    spark: SparkSession, paths: str | Sequence[str], root: str = "", delimiter: str = ",", skip_blank: bool = False
) -> DataFrame:
    """The cells of long delimited files without line breaks inside fields.

    ``skip_blank`` leaves out lines whose fields are all blank before they become cells.
    """
    lines = numbered_lines(spark, paths).select(
        relative_path(F.col("path"), root).alias("raw_path"),
        sheet_of_path(F.col("path")).alias("sheet_name"),
        F.col("line_no").alias("row_no"),
        F.regexp_replace("line", "^﻿", "").alias("line"),
    )

    def fields(line: str) -> list[str]:
        # Each line by itself: a stray quote must not take in the next one.
        return next(csv.reader([line], delimiter=delimiter), [])

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (path, sheet), part in batch.groupby(["raw_path", "sheet_name"], sort=False):
                numbered = ((no, fields(line)) for no, line in zip(part["row_no"], part["line"]))
                if skip_blank:
                    numbered = ((no, row) for no, row in numbered if any(f.strip() for f in row))
                yield from _packed(path, sheet, numbered)

    return cells_of(lines.mapInPandas(split, ROWS))


def with_row_numbers(
    df: DataFrame, sheet: Sequence[str], order: Sequence[Column], header_rows: int = 1
) -> DataFrame:
    """Stamp each row with its source row number, counted from after the header."""
    return with_position(df, sheet, order, "row_no").withColumn(
        "row_no", F.col("row_no") + F.lit(header_rows)
    )


def file_row_numbers(df: DataFrame, header_rows: int = 1) -> DataFrame:
    """Rows read from Parquet files with ``raw_path`` and ``row_no``, their place in the files in the order of paths.

    The reader knows each row's place in its file.  One row a file, its count,
    which comes from the metadata, gives the rows before it; nothing is sorted.
    """
    placed = df.select("*", F.col("_metadata.file_path").alias("raw_path"), F.col("_metadata.row_index").alias("_index"))
    files = df.groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_path", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_index") + 1 + header_rows
    return placed.join(offsets, F.col("raw_path") == F.col("_path")).withColumn("row_no", number).drop(
        "_index", "_path", "_before"
    )


def to_rows(
    df: DataFrame,
    sheet: Column,
    order: Sequence[Column],
    cols: Sequence[str],
    raw_path: Column,
    header_rows: int = 1,
) -> DataFrame:
    """A table as packed rows; row numbers count from after the header.

    Rows are numbered over range slices, so a sheet may hold any share of them.
    """
    kinds = dict(df.dtypes)
    numbered = with_row_numbers(df.withColumn("sheet_name", sheet), ["sheet_name"], order, header_rows)
    cells = F.array(*[to_text(F.col(c), kinds[c]) for c in cols])
    return numbered.select(raw_path.alias("raw_path"), "sheet_name", "row_no", cells.alias("cells"))


def to_grid(
    df: DataFrame,
    sheet: Column,
    order: Sequence[Column],
    cols: Sequence[str],
    raw_path: Column,
    header_rows: int = 1,
    skip_blank: bool = False,
) -> DataFrame:
    """A table as data cells: ``to_rows``, spread.

    ``skip_blank`` leaves out rows whose cells are all blank while they are still
    whole rows.
    """
    rows = to_rows(df, sheet, order, cols, raw_path, header_rows)
    return cells_of(filled_rows(rows) if skip_blank else rows)


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """A report file: header row, possibly a byte-order mark, quoted line breaks."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return df.toDF(*[name.lstrip("﻿") for name in df.columns])


def write_sheets_csv(
    df: DataFrame, path: str, sheet: str, only: str | None = None, overwrite: bool = False
) -> None:
    """One folder of CSV parts per sheet; NULL is an empty field.

    Refuses an existing target unless ``overwrite``; naming a sheet that does
    not exist is an error, and so are two sheets whose folders would be one.
    """
    chosen = df
    if only is not None:
        chosen = df.filter(F.col(sheet) == only)
        if chosen.isEmpty():
            raise ValueError(f"no such sheet: {only}")
    names = chosen.select(F.col(sheet).alias("sheet")).distinct()
    clash = names.groupBy(sheet_file_name(F.col("sheet")).alias("folder")).count().filter("count > 1").first()
    if clash is not None:
        raise ValueError(f"several sheets would be written to {clash.folder}")
    (
        chosen.withColumn(sheet, sheet_file_name(F.col(sheet)))
        .write.partitionBy(sheet)
        .mode("overwrite" if overwrite else "errorifexists")
        .csv(path, header=True, nullValue="", emptyValue="")
    )


def replace_source(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """``existing`` with all rows of the sources in ``new`` replaced by ``new``.

    Sources match by equality of their key, so a source never takes another
    one with it whose name merely starts the same.
    """
    sources = new.select(key).distinct()
    return existing.join(sources, key, "left_anti").unionByName(new)


def overwrite_sources(new: DataFrame, path: str, key: str) -> None:
    """Re-import on storage: only the partitions of the sources in ``new`` change."""
    (
        new.write.partitionBy(key)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def to_json_rows(df: DataFrame, fields: Sequence[str], values: Sequence[str], name: str) -> DataFrame:
    """One JSON object per row: the fields, and the values as a nested map by column name."""
    nested = F.create_map(*chain.from_iterable((F.lit(v), F.col(v)) for v in values))
    return df.select(F.to_json(F.struct(*fields, nested.alias("metricValues"))).alias(name))
