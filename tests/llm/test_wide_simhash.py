import math
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, empty, odd, prose, same_rows

from specloom.llm import ragged, wide_simhash


def plain_fingerprint(text):
    """256 bits by a loop over shingles and bits; the hash of a shingle is the operator's own."""
    data = (text or "").encode()
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in data)
    words = lower.translate(bytes.maketrans(b"\t\n\v\f\r", b"     ")).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    size = min(5, len(words))
    value = 0
    hashes = []
    for i in range(len(words) - size + 1):
        whole = b" ".join(words[i : i + size])
        array, offsets = np.frombuffer(whole, np.uint8), np.array([0, len(whole)])
        starts, ends, _ = ragged.find_words(array, offsets, wide_simhash.WORDS)
        sums = ragged.prefix_sums(ragged.run_hashes(ragged.prefix_sums(array), starts, ends))
        hashes.append(int(ragged.run_hashes(sums, np.array([0]), np.array([size]))[0]))
    for part in range(wide_simhash.PARTS):
        salt = part * 0x9E3779B97F4A7C15 % 2**64
        mixed = [int(x) for x in ragged.mix(np.array([h ^ salt for h in hashes], np.uint64))]
        for bit in range(64):
            if 2 * sum(h >> bit & 1 for h in mixed) > len(mixed):
                value |= 1 << (64 * part + bit)
    return value


def brute_force(rows, most=wide_simhash.DISTANCE):
    """doc_id, fingerprint and component of every row, from all pairs."""
    prints = [plain_fingerprint(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, prints[i].to_bytes(32, "little").hex(), least.get(root(i))) for i, (doc_id, _) in enumerate(rows)]


def edited(text, share, draw):
    words = text.split()
    for i in draw.sample(range(len(words)), max(1, round(share * len(words)))):
        words[i] = f"x{draw.randrange(10**6)}"
    return " ".join(words)


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", 1, 1) for i, t in enumerate(texts)], SCHEMA)


def compare(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert same_rows(wide_simhash.near_texts(docs).collect()) == same_rows(brute_force(rows))


def test_odd_rows_and_empty_table(spark):
    compare(spark, odd(spark))
    assert wide_simhash.near_texts(empty(spark)).count() == 0


def test_edited_copies_against_all_pairs(spark):
    draw = random.Random(3)
    texts = [prose(i, 120) for i in range(30)]
    texts += [edited(texts[i % 10], 0.01 * (i % 3), draw) for i in range(60)] + texts[:5]
    compare(spark, table(spark, texts))


def test_one_large_group_in_chunks(spark):
    """A group far beyond a cell's rows stays one component, and never leaves as all its pairs."""
    draw, text = random.Random(4), prose(5, 300)
    texts = [edited(text, 0.004, draw) for _ in range(600)] + [prose(i, 200) for i in range(6, 12)]
    prints = wide_simhash.fingerprints(table(spark, texts)).select("fingerprint").distinct()
    found = wide_simhash.fingerprint_links(prints, cell_rows=100)
    assert found.distinct().count() < 600 * 600 / 8
    roots = wide_simhash.connected_components(found)
    assert roots.select("root").distinct().count() == 1 and roots.count() >= prints.count() - 6


@pytest.mark.parametrize("rows", [100, 250_000, 15_000_000, 50_000_000_000])
def test_pairs_meet_at_every_size(rows):
    """Recall of the grids on pairs whose Jaccard is 0.8 or more, as if there were so many texts."""
    draw, texts, copies = random.Random(6), [], []
    for i in range(300):
        text = prose(i, 150 + i)
        copy = edited(text, draw.choice([0.005, 0.01, 0.015, 0.02]), draw)
        sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (text.split(), copy.split())]
        if len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1]):
            texts.append(text), copies.append(copy)
    assert len(texts) > 150
    a, b = (
        np.concatenate([wide_simhash.fingerprints_of(d, o) for _, d, o in ragged.text_slices(pa.array(t))])
        for t in (texts, copies)
    )
    differ = wide_simhash.unary_counts(a) ^ wide_simhash.unary_counts(b)
    meet = np.zeros(len(a), bool)
    for mask in wide_simhash.grid_masks(*wide_simhash.grids_for(rows)):
        meet |= ~(differ & mask).any(axis=1)
    assert (meet & (wide_simhash.distance(a, b) <= wide_simhash.DISTANCE)).mean() >= 0.9


def test_unrelated_texts_do_not_link():
    texts = [prose(i, 100) for i in range(300)]
    (_, data, offsets), = ragged.text_slices(pa.array(texts))
    prints = wide_simhash.fingerprints_of(data, offsets)
    apart = wide_simhash.distance(prints[:, None], prints[None])[np.triu_indices(300, 1)]
    assert apart.min() > 2 * wide_simhash.DISTANCE - 10


def test_masks_use_every_segment_alike():
    for segments, grids in [(2, 16), (9, 52), (22, 900)]:
        masks = wide_simhash.grid_masks(segments, grids)
        assert (np.bitwise_count(masks).sum(axis=1) == 2 * segments).all()
        used = [int((masks[:, s // 32] >> np.uint64(2 * (s % 32)) & np.uint64(3) == 3).sum()) for s in range(128)]
        assert max(used) - min(used) <= 2


def flipped(value, bits, draw):
    for bit in draw.sample(range(256), bits):
        value ^= 1 << bit
    return value


@pytest.mark.parametrize("chunk_least", [wide_simhash.CHUNK_LEAST, 40])
def test_no_pair_within_the_distance_is_missed(spark, monkeypatch, chunk_least):
    """Pairs exactly at the distance, and one bit beyond, when grids meet almost none of them."""
    monkeypatch.setattr(wide_simhash, "grids_for", lambda rows: (22, 1))
    monkeypatch.setattr(wide_simhash, "CHUNK_LEAST", chunk_least)
    draw = random.Random(8)
    first = [draw.getrandbits(256) for _ in range(300)]
    second = [flipped(v, wide_simhash.DISTANCE + i % 2, draw) for i, v in enumerate(first)]
    rows = [(bytearray(v.to_bytes(32, "little")),) for v in first + second]
    distinct = spark.createDataFrame(rows, "fingerprint binary")
    roots = {bytes(r.fingerprint): bytes(r.root) for r in wide_simhash.roots_of(distinct).collect()}
    assert len(roots) == 600
    for i, (x, y) in enumerate(zip(first, second)):
        assert (roots[x.to_bytes(32, "little")] == roots[y.to_bytes(32, "little")]) == (i % 2 == 0)
    assert len(set(roots.values())) == 450


def uneven_rows():
    """Fingerprints with labels: scattered ones, pairs about the distance, and large groups near each other."""
    draw = random.Random(9)
    first = [draw.getrandbits(256) for _ in range(150)]
    values = first + [flipped(v, draw.randrange(44, 53), draw) for v in first]
    values += [flipped(first[0], draw.randrange(20), draw) for _ in range(120)] + [first[1]] * 20
    values += [flipped(flipped(first[0], 60, draw), draw.randrange(6), draw) for _ in range(60)]
    labels = [*range(300), *[300] * 120, *[301, 302] * 10, *[303 + i % 5 for i in range(60)]]
    order = draw.sample(range(len(values)), len(values))
    prints = np.frombuffer(b"".join(values[i].to_bytes(32, "little") for i in order), np.uint64).reshape(-1, 4)
    return prints, np.array([labels[i] for i in order])


@pytest.mark.parametrize(("most", "pairs"), [(48, wide_simhash.PAIRS), (48, 50), (30, 50), (0, 50)])
def test_blocks_find_what_all_pairs_find(monkeypatch, most, pairs):
    blocks = wide_simhash.blocks_for(400_000, 400_000, most)
    assert sum(radius + 1 for _, _, radius in blocks) == most + 1
    monkeypatch.setattr(wide_simhash, "PAIRS", pairs)
    monkeypatch.setattr(wide_simhash, "PROBES", 100)
    monkeypatch.setattr(wide_simhash, "PAIR_NS", 1e6)  # whatever the work is, blocks are not given up
    prints, labels = uneven_rows()
    x, y = (prints[:230], labels[:230]), (prints[230:], labels[230:])
    for other, same in ((x, True), (y, False)):
        expected = wide_simhash._roots_met(x, other, same, most)
        found = wide_simhash._roots_met_in_blocks(x, other, same, most, blocks)
        assert {tuple(sorted(m)) for m in found} == {tuple(sorted(m)) for m in expected} != set()


def test_blocks_are_given_up_for_uneven_rows():
    """Rows that meet in blocks again and again are left to the comparison of all pairs."""
    prints = np.zeros((3000, 4), np.uint64)
    prints[:, 0] = np.arange(3000)
    blocks = wide_simhash.blocks_for(400_000, 400_000, 48)
    x = prints, np.arange(3000)
    assert wide_simhash._roots_met_in_blocks(x, x, True, 48, blocks) is None


def test_work_of_the_exact_search_grows_less_than_with_all_pairs():
    """Pairs that meet in blocks, and values looked up, as shares of all pairs: few, and fewer of more rows."""
    shares = []
    for rows in (30_000, 330_000, wide_simhash.CHUNK_MOST):
        blocks = wide_simhash.blocks_for(rows, rows, wide_simhash.DISTANCE)
        balls = [(bits, sum(math.comb(bits, k) for k in range(radius + 1))) for _, bits, radius in blocks]
        shares.append(sum(ball / 2**bits + ball / rows for bits, ball in balls))
    assert blocks and shares[0] < 0.35 and shares[1] < 0.1 and shares[2] < shares[1] < shares[0]


def test_no_pair_is_missed_where_blocks_are_used(spark, monkeypatch):
    monkeypatch.setattr(wide_simhash, "CHUNK_LEAST", 1 << 20)  # one chunk
    assert wide_simhash.blocks_for(30_000, 30_000, wide_simhash.DISTANCE)
    draw = random.Random(10)
    first = [draw.getrandbits(256) for _ in range(15_000)]
    second = [flipped(v, wide_simhash.DISTANCE + i % 2, draw) for i, v in enumerate(first)]
    rows = [(bytearray(v.to_bytes(32, "little")),) for v in first + second]
    rooted = spark.createDataFrame(rows, "fingerprint binary").selectExpr("fingerprint", "fingerprint as root")
    found = {frozenset((bytes(r.a), bytes(r.b))) for r in wide_simhash.missed_links(rooted).collect()}
    pairs = zip(first[::2], second[::2])
    assert found == {frozenset((x.to_bytes(32, "little"), y.to_bytes(32, "little"))) for x, y in pairs}
