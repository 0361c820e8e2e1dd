"""Exact positions and running totals that no single task has to hold.

A window over an unbounded group sorts that whole group in one task.  Here the
rows are range-partitioned on (group, order) instead, so a large group spreads
over many slices; the slices' totals, one row each, are summed up first and
every slice then numbers its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.session import cut_lineage


def sorted_slices(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Sorted range slices, written once so that all passes see the same ones.

    ``_at`` rises by one from row to row inside a slice.  Rows that are equal in
    ``order`` are told apart by a hash of the row, so very many of them still
    spread over slices, and come in the same order each time.
    """
    content = [name for name, kind in df.dtypes if "map<" not in kind]
    key = [*[F.col(g).asc() for g in group], *order, F.xxhash64(*content).asc()]
    ranged = df.repartitionByRange(*key).sortWithinPartitions(*key)
    return cut_lineage(
        ranged.withColumn("_slice", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    )


_sliced = sorted_slices


def _with_offsets(sliced: DataFrame, group: Sequence[str], total: Column) -> DataFrame:
    """Add ``_offset``, the ``total`` of the group's earlier slices, and ``_first``, where its rows start.

    There is one row per slice of a group, even of the largest.  These are kept
    as a table: as its size is known when the join is planned, Spark broadcasts
    it when it is small, and the rows are not shuffled once more for it.
    """
    parts = sliced.groupBy(*group, "_slice").agg(total.alias("_total"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group or [F.lit(0)]).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = cut_lineage(parts.select(
        *[F.col(g).alias(f"_o_{g}") for g in group],
        F.col("_slice").alias("_o_slice"),
        "_first",
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
    ))
    same = F.col("_slice") == F.col("_o_slice")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    return sliced.join(offsets, same, "left").drop("_o_slice", *[f"_o_{g}" for g in group])


def with_running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    weight: Column,
    name: str,
) -> DataFrame:
    """Add the total of ``weight`` up to and including each row of its group.

    ``order`` must be total within the group.  ``group`` may be empty: the
    total then runs over the whole table.
    """
    sliced = sorted_slices(df.withColumn("_weight", weight), group, order)
    placed = _with_offsets(sliced, group, F.sum("_weight"))
    inside = Window.partitionBy(*group, "_slice").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return placed.withColumn(name, F.sum("_weight").over(inside) + F.col("_offset")).drop(
        "_weight", "_slice", "_at", "_first", "_offset"
    )


def with_position(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """Add the exact 1-based position of each row in its group, as a long.

    Inside a slice the rows are already in order, so one range shuffle is all
    the rows go through.
    """
    return numbered(sorted_slices(df, group, order), group, name)


def numbered(sliced: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """``with_position`` of rows that are ``sorted_slices`` already; ``group`` may be found in them afterwards.

    The rows of a group must follow each other in the order of the slices.
    """
    placed = _with_offsets(sliced, group, F.count("*"))
    return placed.withColumn(name, F.col("_offset") + F.col("_at") - F.col("_first") + 1).drop(
        "_slice", "_at", "_first", "_offset"
    )


def first_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int = 1, name: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each group.

    Kept in the ``row_number() <= n`` form: Spark then drops all but ``n`` rows
    of a group in each map task, before the shuffle, so a large group shrinks
    before it meets in one place.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    kept = ranked.filter(F.col("_rank") <= n)
    return kept.withColumnRenamed("_rank", name) if name else kept.drop("_rank")
