import hashlib
import re
import zlib
from collections import Counter

import pytest
from helpers import SCHEMA, empty, odd, prose, same_rows
from pyspark.sql import functions as F

from specloom.llm import manifest
from specloom.oracle import differences


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """Root and, for each node, its (left, right) siblings level by level."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 16, len(nodes))) for i in range(0, len(nodes), 16)]
        for run in runs:
            for k in run:
                for i in owners[k]:
                    paths[i].append(([nodes[j] for j in run if j < k], [nodes[j] for j in run if j > k]))
        owners = [[i for k in run for i in owners[k]] for run in runs]
        nodes = [h("".join(nodes[k] for k in run)) for run in runs]
    return nodes[0], paths


def brute_force(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.source, []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        made[name] = (ordered, *tree([leaf(r, r.text) for r in ordered]))
    root, over = tree([made[name][1] for name in names])
    out = []
    for place, name in enumerate(names):
        ordered, subroot, paths = made[name]
        for row, path in zip(ordered, paths):
            path = path + over[place]
            at = leaf(row, row.text)
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0 and row.text is not None:
                at = leaf(row, re.sub("[A-Z]", lambda m: m.group().lower(), row.text))
            for left, right in path:
                at = h("".join(left) + at + "".join(right))
            proof = h("".join(x for left, right in path for x in left + right))
            out.append((row.doc_id, leaf(row, row.text), subroot, root, proof, at, at == root))
    return out


def check(docs):
    assert same_rows(manifest.manifest(docs).collect()) == same_rows(brute_force(docs.collect()))


def test_odd_rows(spark):
    check(odd(spark))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17}, {"a": 257, None: 1, "": 2, "é": 33, "z": 16}, {f"s{i:03}": 1 for i in range(18)}])
def test_shapes_of_trees(spark, sizes):
    rows = [
        (i, "Some Text" if i % 3 else None, "en" if i % 2 else None, source, i, "", 0, 0)
        for i, source in enumerate(s for s, n in sizes.items() for _ in range(n))
    ]
    check(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5))


def test_tampering_shows_unless_nothing_changes(spark):
    rows = [(i, "all lower" if i % 2 else "Not All", "en", "a", i, "", 0, 0) for i in range(300)]
    found = manifest.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in found:
        hit = zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.verified == (not hit or r.doc_id % 2 == 1)
    assert {r.verified for r in found} == {True, False}


def test_one_id_in_a_third_of_the_rows_and_repeated_rows(spark):
    rows = [(7 if i % 3 == 0 else i, f"T{i % 50}", "en", "hot", 1, "", 0, 0) for i in range(900)]
    check(spark.createDataFrame(rows, SCHEMA))


def test_own_choice_of_tampered_rows(spark):
    docs = spark.createDataFrame([(i, "T", "en", "a", 1, "", 0, 0) for i in range(40)], SCHEMA)
    found = manifest.manifest(docs, F.col("doc_id") == 3).collect()
    assert Counter(r.verified for r in found) == {True: 39, False: 1}


def test_against_sql(spark):
    import duckdb

    docs = spark.createDataFrame(
        [(i, prose(i, 9).title(), "en", None if i % 40 == 0 else f"s{i % 3}", i, "", 0, 0) for i in range(1000)], SCHEMA
    )
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "int64"}))
    assert differences(manifest.manifest(docs), con, manifest.oracle(4, 2)) == []


def test_empty_table(spark):
    assert manifest.manifest(empty(spark)).collect() == []
