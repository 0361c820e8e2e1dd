"""Connected components of a table of links, without gathering any component.

Alternates two steps (large star and small star) until nothing changes.  Each is
an aggregate to the smallest neighbour, which Spark combines before it shuffles,
and a join back, whose large keys adaptive execution splits; a component of any
size is only ever a number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _towards_least(pairs: DataFrame, keep_own: bool) -> DataFrame:
    """Link the neighbours ``v`` of each ``u`` to the least of them and ``u``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = pairs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if keep_own:
        linked = linked.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return linked.filter("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node of the links ``a``, ``b``.

    Nodes without a link to another node have no row.  Nulls link nothing.
    """
    edges = cut_lineage(
        links.select("a", "b").filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while (state := _state(edges)) != before:
        before = state
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # large star: greater neighbours of u to the least of u and its neighbours
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # small star: lesser neighbours of u, and u, to the least of them
        edges = cut_lineage(_towards_least(large.select(F.col("a").alias("u"), F.col("b").alias("v")), True))
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
