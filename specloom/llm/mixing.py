"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in an order drawn by a hash of doc_id, are cut into
blocks of ``BLOCK`` characters.  A source of weight w may place its block j
(from 0) no earlier than slot floor(j / w), its release, and must place it
before slot ceil((j + 1) / w), its deadline.  Taking the released block of the
earliest deadline in every slot meets all of them, so at any point of the
mixture each source is less than one block away from its share.

A source that runs out leaves the schedule, and the others go on with their
weights renormalised: releases and deadlines are those of a flow in which every
source has its share of each slot until its blocks are used up.  Weights are not
rounded to a period, so nothing adds up as the mixture grows.  Every block
has a slot, and a small source costs only its own slots.

The driver holds one small row per source; slots are worked out by tasks of
``STEP`` slots and joined with every document's block.  Places within a source
come from range slices, so a source with a third of all rows is spread like any
other.

A ``whole`` selection, that of the query and of the pipeline, is all that has a slot.  Otherwise the
selection ends where the first source runs out, and all of it has the target weights.

Defined results: a null source is a source of its own; a null text is one of no
characters; documents with a null id come first in their source; rows with
equal ids are selected together; a source that is not among the given weights
has no slots and is not selected; a source of no characters has no slots, and
its documents are selected; further columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.operators.ordering import with_running_total
from specloom.session import cut_lineage

#: Characters of a block; slots over which ``shares`` rounds (more if there are many sources).
BLOCK = 20_000
PERIOD = 1000
#: Parts in which weights are counted, so fine that 100 million slots are off by less than a tenth of a block.
PARTS = 2**32
#: Slots worked out by one task.
STEP = 65_536
#: Default weights: the size of a source to this power, which lifts small sources.
TEMPER = 0.8
#: Sources, one small row each, up to which the ends of their selections are broadcast.
BROADCAST_SOURCES = 100_000


def source_key(source: Column) -> Column:
    """The source as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _order() -> list[Column]:
    return [F.xxhash64("doc_id").asc(), F.col("doc_id").asc_nulls_first()]


def shares(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Slots of each source in a period: the largest remainders, at least one each."""
    if not weights:
        return {}
    if min(weights.values()) <= 0:
        raise ValueError("weights must be above zero")
    period = max(period, 4 * len(weights))
    total = sum(weights.values())
    free = period - len(weights)
    exact = {s: max(0.0, w / total * period - 1) for s, w in weights.items()}
    scale = free / sum(exact.values()) if sum(exact.values()) else 0.0
    whole = {s: 1 + int(x * scale) for s, x in exact.items()}
    rest = sorted(weights, key=lambda s: (-(exact[s] * scale - int(exact[s] * scale)), s))
    for s in rest[: period - sum(whole.values())]:
        whole[s] += 1
    return whole


def windows(units: np.ndarray, ends: np.ndarray, source: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Releases and deadlines of the blocks ``first`` to ``last - 1`` of a source.

    ``units`` are whole weights.  At the time u every source s has placed
    ``min(ends[s], units[s] * u)``; their sum is the slot reached.
    """
    out = np.argsort(ends / units, kind="stable")
    times = (ends / units)[out]
    gone = np.concatenate([[0], np.cumsum(ends[out])])
    left = units.sum() - np.concatenate([[0], np.cumsum(units[out])])
    j = np.arange(first, last + 1)
    at = np.searchsorted(times, j / units[source], side="left")
    release = gone[at] + left[at] * j // units[source]
    deadline = gone[at] - (-left[at] * j // units[source])
    return release[:-1], deadline[1:]


def run_slots(units: np.ndarray, ends: np.ndarray, done: np.ndarray, begin: int, end: int) -> np.ndarray:
    """source, block, release, deadline and slot of the slots ``begin`` to ``end - 1``, one row each.

    Earliest deadline first among released blocks.  ``done`` has the blocks each
    source has placed before ``begin``, and after the call those before ``end``.
    """
    waiting: list[tuple[int, int]] = []
    ready: list[tuple[int, int]] = []
    spans = {}
    total = int(units.sum())
    for s in np.flatnonzero(done < ends).tolist():
        # as many blocks as the source can place here, even if it is the only one left
        spans[s] = (int(done[s]), 0, None, None)
        waiting.append((0, s))

    def window(s: int, j: int) -> tuple[int, int]:
        first, last, releases, deadlines = spans[s]
        if not first <= j < last:
            last = min(int(ends[s]), j + max(16, int((end - begin) * int(units[s]) // total)))
            releases, deadlines = (x.tolist() for x in windows(units, ends, s, j, last))
            spans[s] = first, last, releases, deadlines = (j, last, releases, deadlines)
        return releases[j - first], deadlines[j - first]

    waiting = [(window(s, int(done[s]))[0], s) for _, s in waiting]
    heapq.heapify(waiting)
    found = np.empty((end - begin, 5), np.int64)
    for t in range(begin, end):
        while waiting and (waiting[0][0] <= t or not ready):
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (window(s, int(done[s]))[1], s))
        deadline, s = heapq.heappop(ready)
        j = int(done[s])
        found[t - begin] = s, j, window(s, j)[0], deadline, t
        done[s] += 1
        if j + 1 < ends[s]:
            heapq.heappush(waiting, (max(t + 1, window(s, j + 1)[0]), s))
    return found


def period_schedule(slots: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """source, block, release, deadline and slot of a run in which every source has as many blocks as slots."""
    names = sorted(slots)
    units = np.array([slots[s] for s in names], np.int64)
    plan = run_slots(units, units, np.zeros(len(names), np.int64), 0, int(units.sum()))
    return [(names[s], *x) for s, *x in plan.tolist()]


def whole_weights(weights: Mapping[str, float]) -> dict[str, int]:
    """Weights as whole parts of ``PARTS``: products with numbers of blocks stay exact in 64 bits."""
    if weights and min(weights.values()) <= 0:
        raise ValueError("weights must be above zero")
    total = sum(weights.values())
    return {s: max(1, round(w / total * PARTS)) for s, w in weights.items()}


def slot_table(spark: SparkSession, names: list[str], units: np.ndarray, ends: np.ndarray) -> DataFrame:
    """source, block, release, deadline, slot of every block.

    The driver goes through the slots once and keeps what is placed at every
    ``STEP``-th; tasks work the slots out again from there.
    """
    done, states = np.zeros(len(names), np.int64), []
    total, step = int(ends.sum()), max(STEP, 4 * len(names))
    for begin in range(0, total, step):
        states.append((begin, done.tolist()))
        if begin + step < total:
            run_slots(units, ends, done, begin, begin + step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, placed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                plan = run_slots(units, ends, np.array(placed, np.int64), begin, min(total, begin + step))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[s] for s in plan[:, 0]], pa.string()), *[pa.array(plan[:, i].copy()) for i in range(1, 5)]],
                    ["source", "block", "release", "deadline", "slot"],
                )

    given = spark.createDataFrame(states, "begin long, placed array<long>").repartition(max(1, len(states)), "begin")
    return given.mapInArrow(run, "source string, block long, release long, deadline long, slot long")


def source_sizes(docs: DataFrame) -> dict[str, int]:
    """Characters of each source; one row per source."""
    sized = docs.groupBy(source_key(F.col("source")).alias("source")).agg(
        F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("size")
    )
    return {r.source: r.size for r in sized.collect()}


def tempered(sizes: Mapping[str, int], power: float = TEMPER) -> dict[str, float]:
    return {s: float(max(1, n)) ** power for s, n in sizes.items()}


def schedule(
    docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, sizes: Mapping[str, int] | None = None,
    whole: bool = False,
) -> DataFrame:
    """doc_id, source, block, release, deadline, slot and selected of every document.

    ``weights`` has a weight for each ``source_key``; by default sizes are
    tempered.  ``sizes`` are those of ``source_sizes``, if known already.
    ``whole`` selects all that has a slot, instead of what comes before the first
    source runs out.
    """
    sizes = source_sizes(docs) if sizes is None else sizes
    given = tempered(sizes) if weights is None else weights
    chosen = whole_weights({s: w for s, w in given.items() if sizes.get(s)})
    names = sorted(chosen)
    units = np.array([chosen[s] for s in names], np.int64)
    ends = np.array([-(-sizes[s] // block) for s in names], np.int64)
    # the slot reached when the first source has run out
    least = int(np.argmin(ends / units)) if names else 0
    horizon = int(ends[least]) * int(units.sum()) // int(units[least]) if names else 0
    rows = docs.select(
        "doc_id", source_key(F.col("source")).alias("source"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("size")
    )
    placed = with_running_total(rows, ["source"], _order(), F.col("size"), "until")
    spark = docs.sparkSession
    last = spark.createDataFrame(
        [(s, max(0, -(-sizes.get(s, 0) // block) - 1)) for s in given], "source string, last long"
    )
    # texts of no characters after the end of the last block belong to it
    number = F.floor((F.col("until") - F.col("size")) / F.lit(block)).cast("long")
    blocks = placed.select("doc_id", "source", number.alias("block")).join(last, "source", "left").select(
        "doc_id", "source", F.coalesce(F.least("block", "last"), "block").alias("block"), F.col("last").isNotNull().alias("given")
    )
    found = blocks.join(slot_table(spark, names, units, ends), ["source", "block"], "left")
    # what has no characters takes no slot and costs none; rows of one id are never parted
    free = F.col("given") & F.col("slot").isNull()
    chosen_rows = F.col("given") if whole else free | F.coalesce(F.col("slot") < horizon, F.lit(False))
    return found.select("doc_id", "source", "block", "release", "deadline", "slot", chosen_rows.alias("selected"))


def interleaved(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """All documents of the sources that have a weight, all columns, in the order of the mixture.

    The rows come in range slices of the slots, each slice sorted, so written files follow
    the mixture from the first to the last; within a block documents keep their source's order.
    What has no characters stands before all others.  Places are worked out for keys
    (id and hash of the text) alone and joined with the texts; rows of one key stand together.
    """
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"))
    found = schedule(docs.select(key.alias("doc_id"), "source", "text"), weights, block, whole=True).filter("selected")
    places = cut_lineage(found.groupBy("doc_id", "source").agg(F.min("slot").alias("_mix_slot"))).select(
        F.col("doc_id.id").alias("_mix_id"), F.col("doc_id.text_hash").alias("_mix_hash"),
        F.col("source").alias("_mix_source"), "_mix_slot", F.xxhash64("doc_id").alias("_mix_order"),
    )
    same = (
        docs["doc_id"].eqNullSafe(F.col("_mix_id")) & (F.xxhash64(docs["text"]) == F.col("_mix_hash"))
        & (source_key(docs["source"]) == F.col("_mix_source"))
    )
    order = [F.col("_mix_slot").asc_nulls_first(), *[F.col(c).asc() for c in ("_mix_order", "_mix_id", "_mix_hash")]]
    placed = docs.join(places, same).repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select(*[docs[c] for c in docs.columns])


def mixed(
    docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, whole: bool = False
) -> DataFrame:
    """The selected documents, all columns.

    A source's selection is a start of its order, so each source's last selected
    place says it all: texts are read and filtered, never shuffled.  A ``whole``
    selection is all documents of the sources that have a weight.
    """
    if whole:
        if weights is None:
            return docs
        named = docs.sparkSession.createDataFrame([(s,) for s in weights], "_mix_source string")
        own = docs.withColumn("_mix_source", source_key(F.col("source")))
        return own.join(F.broadcast(named), "_mix_source", "left_semi").select(*[f"`{c}`" for c in docs.columns])
    sizes = source_sizes(docs)
    key = F.struct(F.xxhash64("doc_id").alias("h"), F.col("doc_id").isNotNull().alias("n"), F.col("doc_id").alias("d"))
    last = schedule(docs, weights, block, sizes).filter("selected").groupBy(F.col("source").alias("_mix_source")).agg(
        F.max(key).alias("_mix_last")
    )
    if len(sizes) <= BROADCAST_SOURCES:
        last = F.broadcast(last)
    own = docs.withColumn("_mix_key", key).withColumn("_mix_source", source_key(F.col("source")))
    return own.join(last, "_mix_source").filter("_mix_key <= _mix_last").select(*[f"`{c}`" for c in docs.columns])
