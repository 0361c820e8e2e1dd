from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from helpers import SCHEMA, empty, odd, prose

from specloom.llm import mixing


def docs_of(spark, sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, prose(i, 20 + i * 7 % 60), "en", source, 1, "x", 1, 1))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 0.7, "b": 0.11, "c": 0.1, "d": 0.09}])
def test_schedule_keeps_every_window_and_deviates_less_than_a_block(weights):
    slots = mixing.shares(weights, 97)
    period = sum(slots.values())
    assert period == max(97, 4 * len(weights)) and min(slots.values()) >= 1
    plan = mixing.period_schedule(slots)
    assert [x[-1] for x in plan] == list(range(period))
    done = dict.fromkeys(slots, 0)
    for s, j, release, deadline, t in plan:
        assert j == done[s] and release <= t < deadline
        done[s] += 1
        for other, n in slots.items():
            assert abs(done[other] - n * (t + 1) / period) < 1
    assert done == slots


def test_documents_follow_the_schedule(spark):
    docs = docs_of(spark, {"a": 120, "b": 60, "c": 30})
    found = mixing.schedule(docs, {"=a": 0.5, "=b": 0.3, "=c": 0.2}, block=500).collect()
    assert len(found) == 210 and all(r.release <= r.slot < r.deadline for r in found)
    text = {r.doc_id: len(r.text) for r in docs.collect()}
    owner = {}
    for source in "abc":
        rows = sorted((r for r in found if r.source == f"={source}"), key=lambda r: r.slot)
        # blocks are runs of the source's own order, 500 characters each
        per_block = {}
        for r in rows:
            per_block[r.block] = per_block.get(r.block, 0) + text[r.doc_id]
            assert owner.setdefault(r.slot, source) == source
        total = 0
        for b in sorted(per_block):
            assert total < (b + 1) * 500
            total += per_block[b]
        assert total == sum(text[r.doc_id] for r in rows)
    end = max(r.slot for r in found if r.selected) + 1
    for source, weight in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        used = len({r.slot for r in found if r.selected and r.source == f"={source}"})
        assert abs(used - weight * end) <= 2  # a block, and one in which no document begins
    assert {r.selected for r in found if r.slot > end} <= {False}


def test_mixed_rows_are_the_selected_ones_with_all_columns(spark):
    docs = docs_of(spark, {"a": 100, "b": 40, None: 20})
    kept = mixing.mixed(docs, block=300)
    assert kept.columns == docs.columns
    selected = mixing.schedule(docs, block=300).filter("selected")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in selected.collect())
    assert 0 < kept.count() < 160


def test_odd_rows_and_empty_table(spark):
    found = mixing.schedule(odd(spark))
    assert found.count() == odd(spark).count() and {r.source for r in found.collect()} == {"=a", "null"}
    assert mixing.mixed(odd(spark), block=50).columns == odd(spark).columns
    assert mixing.schedule(empty(spark)).collect() == [] and mixing.mixed(empty(spark)).collect() == []
    unknown = mixing.schedule(odd(spark), {"=other": 1.0, "=a": 1.0})
    assert not unknown.filter("source = 'null' and (selected or slot is not null)").count()
    with pytest.raises(ValueError):
        mixing.shares({"a": 0.0})


def test_a_tiny_or_empty_source_costs_only_its_own_slots(spark):
    docs = docs_of(spark, {"a": 200, "b": 60, "c": 50, "tiny": 1})
    docs = docs.unionByName(spark.createDataFrame([(900, "", "en", "none", 0, "x", 1, 1), (901, None, "en", "none", 0, "x", 1, 1)], SCHEMA))
    found = mixing.schedule(docs, block=300, whole=True).collect()
    assert len(found) == 313 and all(r.selected for r in found)
    assert {r.doc_id for r in found if r.slot is None} == {900, 901}
    placed = [r for r in found if r.slot is not None]
    assert all(r.release <= r.slot < r.deadline for r in placed)
    assert len({(r.source, r.block) for r in placed}) == len({r.slot for r in placed})
    assert mixing.mixed(docs, block=300, whole=True).count() == 313
    assert mixing.mixed(docs, {"=a": 1.0, "=tiny": 1.0}, 300, whole=True).count() == 201
    # one without characters does not end the selection of equal shares, either
    assert mixing.mixed(docs.filter("source <> 'tiny'"), block=300).count() > 250


def test_tasks_go_on_where_the_one_before_ended(spark, monkeypatch):
    units, ends = np.array([500, 300, 199, 1]), np.array([900, 40, 300, 3])
    whole = mixing.run_slots(units, ends, np.zeros(4, np.int64), 0, 1243)
    monkeypatch.setattr(mixing, "STEP", 100)
    parts = mixing.slot_table(spark, list("abcd"), units, ends).orderBy("slot").collect()
    assert [tuple(r) for r in parts] == [("abcd"[s], *x) for s, *x in whole.tolist()]
    assert all(r.release <= r.slot < r.deadline for r in parts)


def test_deviation_from_the_true_weights_stays_under_a_block_over_many_periods():
    weights = {"hot": 0.24217} | {f"s{i:02}": (1 - 0.24218) / 19 for i in range(19)} | {"tiny": 1e-5}
    parts = mixing.whole_weights(weights)
    names, slots = sorted(parts), 200 * mixing.PERIOD
    units = np.array([parts[s] for s in names])
    ends = np.array([int(weights[s] * slots * 2) for s in names])
    plan = mixing.run_slots(units, ends, np.zeros(len(names), np.int64), 0, slots)
    for i, s in enumerate(names):
        done = np.cumsum(plan[:, 0] == i)
        assert abs(done - weights[s] * np.arange(1, slots + 1)).max() < 1.001
        own = plan[plan[:, 0] == i]
        assert list(own[:, 1]) == list(range(len(own))) and all(own[:, 2] <= own[:, 4]) and all(own[:, 4] < own[:, 3])
    assert (plan[:, 0] == names.index("tiny")).sum() == 2


def fluid_slots(sizes, weights, block):
    """Slot of each (source, block): earliest deadline first, one slot after the other, in exact fractions."""
    ends = {s: -(-n // block) for s, n in sizes.items() if n and s in weights}
    active, level, at, spans = set(ends), dict.fromkeys(ends, Fraction(0)), Fraction(0), {s: [] for s in ends}
    while active:
        total = sum(weights[s] for s in active)
        pace = {s: Fraction(weights[s], total) for s in active}
        length = min((ends[s] - level[s]) / pace[s] for s in active)
        for s in active:
            spans[s].append((level[s], level[s] + pace[s] * length, at, pace[s]))
            level[s] += pace[s] * length
        at += length
        active = {s for s in active if level[s] < ends[s]}

    def reached(s, blocks):
        for low, high, begin, pace in spans[s]:
            if low <= blocks <= high:
                return begin + (blocks - low) / pace

    left = {s: [(reached(s, j).__floor__(), -(-reached(s, j + 1)).__floor__(), j) for j in range(n)] for s, n in ends.items()}
    slots, t = {}, 0
    while any(left.values()):
        open_ = [(q[0][1], s) for s, q in left.items() if q and q[0][0] <= t]
        s = min(open_)[1] if open_ else min((q[0][0], s) for s, q in left.items() if q)[1]
        slots[s, left[s].pop(0)[2]] = t
        t += 1
    return slots


def brute_force_order(docs, block):
    """ids in the order of the mixture, and the slot of each."""
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"))
    rows = docs.select(
        "doc_id", mixing.source_key(F.col("source")).alias("source"), F.coalesce(F.length("text"), F.lit(0)).alias("size"),
        F.xxhash64(key).alias("hash"),
    ).collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    weights = mixing.whole_weights({s: float(n) ** 0.8 for s, n in sizes.items() if n})
    slots = fluid_slots(sizes, weights, block)
    until, placed = {}, []
    for r in sorted(rows, key=lambda r: r.hash):
        start = until.get(r.source, 0)
        until[r.source] = start + r.size
        last = max(0, -(-sizes[r.source] // block) - 1)
        placed.append((slots.get((r.source, min(start // block, last)), -1), r.hash, r.doc_id))
    return [(doc_id, slot) for slot, _, doc_id in sorted(placed)]


def in_files(spark, path):
    """Rows of written files, in the order of the files."""
    number = F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).cast("int")
    return spark.read.parquet(path).select("*", number.alias("n"), F.col("_metadata.row_index").alias("i")).orderBy("n", "i").collect()


@pytest.mark.parametrize("block", [100, 300, 5000])
def test_schedule_and_order_against_brute_force(spark, tmp_path, block):
    docs = docs_of(spark, {"a": 90, "b": 30, None: 12, "tiny": 1}).repartition(7)
    expected = brute_force_order(docs, block)
    mixing.interleaved(docs, block=block).write.parquet(str(tmp_path / "out"))
    rows = in_files(spark, str(tmp_path / "out"))
    assert [r.doc_id for r in rows] == [i for i, _ in expected]
    assert sorted(tuple(r)[:8] for r in rows) == sorted(map(tuple, docs.collect()))


def test_interleaved_odd_rows_and_empty_table(spark):
    found = mixing.interleaved(odd(spark), block=50)
    assert found.columns == odd(spark).columns and sorted(map(repr, found.collect())) == sorted(map(repr, odd(spark).collect()))
    assert mixing.interleaved(empty(spark)).collect() == []
    assert mixing.interleaved(docs_of(spark, {"a": 3, "b": 3}), {"=a": 1.0}).count() == 3


def test_a_source_of_one_document_costs_no_other_one(spark):
    docs = docs_of(spark, {"hot": 300, "b": 40, "c": 40, "tiny": 1})
    assert mixing.interleaved(docs, block=200).count() == docs.count()
