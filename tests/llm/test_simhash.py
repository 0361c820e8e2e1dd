import re

import numpy as np
import pytest
import xxhash
from helpers import empty, odd, prose, same_rows

from specloom.llm import simhash
from specloom.llm.components import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text, shingle=4):
    words = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=4):
    """Least reachable doc_id of each row, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            k = find(i)
            least[k] = min(doc_id, least.get(k, doc_id))
    return [least.get(find(i)) for i in range(len(prints))]


def brute_force(rows, shingle=4, distance=4):
    prints = [(doc_id, fingerprint(text, shingle)) for doc_id, text in rows]
    return [(d, f"{f:016x}", c) for (d, f), c in zip(prints, components(prints, distance))]


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    assert same_rows(simhash.near_copies(odd(spark)).collect()) == same_rows(brute_force(rows))


def test_empty_table(spark):
    found = simhash.near_copies(empty(spark))
    assert found.columns == ["doc_id", "fingerprint", "component_id"] and found.collect() == []


def changed(seed, n):
    words = prose(seed, 300).split()
    for k in range(n % 7):
        words[(n * 37 + k * 11) % 300] = f"x{n}_{k}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near(spark):
    rows = [(i, changed(5, i)) for i in range(150)] + [(1000 + i, prose(100 + i, 60)) for i in range(150)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_near_copies_against_all_pairs(near):
    rows, docs = near
    assert same_rows(simhash.near_copies(docs).collect()) == same_rows(brute_force(rows))


@pytest.mark.parametrize("shingle, distance", [(5, 8), (1, 2), (3, 12)])
def test_other_shingles_and_distances(near, shingle, distance):
    rows, docs = near
    found = simhash.near_copies(docs, shingle, distance).collect()
    assert same_rows(found) == same_rows(brute_force(rows, shingle, distance))


def test_links_of_a_cell_either_way():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = np.unique(base[rng.integers(0, 40, 700)] ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64)))
    none = np.zeros_like(prints)
    left, right = simhash.forest(prints, none, 4)
    assert simhash.few_links(prints, none, 4) is None or len(prints) > 1
    sparse = np.unique(np.concatenate([base, base ^ np.uint64(3)]))
    a, b = simhash.few_links(sparse, np.zeros_like(sparse), 4)
    assert {frozenset((int(sparse[i]), int(sparse[j]))) for i, j in zip(a, b)} == {
        frozenset((int(x), int(x) ^ 3)) for x in base}
    assert len(left) == len(right) < len(prints)


@pytest.mark.parametrize("groups, cell_rows", [(6, 4096), (7, 20), (9, 40)])
def test_links_do_not_depend_on_grids_or_chunks(spark, near, groups, cell_rows):
    rows, _ = near
    prints = sorted({fingerprint(t) for _, t in rows})
    signed = [(p - (1 << 64) if p >> 63 else p) for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fingerprint long"), groups, cell_rows)
    found = {r.node: r.root for r in connected_components(links).collect()}
    classes = components(list(zip(range(len(prints)), prints)))
    mine = {}
    for s, c in zip(signed, classes):
        mine.setdefault(c, set()).add(s)
    theirs = {}
    for s in signed:
        theirs.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, None)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {i: 1 for i in range(1, 41)} | {100: 100} | {i: 100 for i in range(101, 160)}
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
