"""Near-copies of a Jaccard similarity of about 0.8 or more, by fingerprints of 256 bits.

A fingerprint has four SimHashes of 64 bits, from four mixes of each shingle's
hash: a bit is one if set for over half the shingles.  Texts link if at most
``DISTANCE`` bits differ.  Two texts of Jaccard 0.8 differ in about 14 % of the
bits (measured), so many bits tell them better from unrelated ones (half of the bits) than
few: the spread of the share falls with the root of their number.

The fingerprint is cut into 128 segments of two bits and mapped to the bit count
of each, kept in unary (0, 01, 11), so that the Manhattan distance of two such
vectors, which never exceeds the Hamming distance, is a number of differing bits.
The range join runs over grids.  Each grid is spanned by a few segments, with
cells one count wide, and two texts meet where these counts agree.  Within a cell
pairs pass the Manhattan bound and then the exact distance.  A cell never leaves
more than ``DENSE`` links a row: then only a spanning forest of its links goes out.

The more texts, the more segments a grid has, so that cells stay small, and the
more grids there are, so that a pair whose bits differ with ``FLIP`` still meets
with probability ``RECALL``; closer pairs meet almost surely.  Segments of a grid
are drawn by a fixed generator: the same table always gives the same links.

Grids miss some pairs, so all pairs of texts that they leave unconnected are looked
through as well, chunk by chunk (``missed_links``): no link within ``DISTANCE`` is lost.  The
fingerprint is cut into 12 to 16 blocks, each with a radius of 2 to 4 bits, such that two
fingerprints within the distance differ in no more than its radius in one block at least (pigeonhole
principle).  So only rows meet that do, found by changing a block's bits in all these ways:
some hundredths of all pairs, and fewer the larger the chunks.  Few rows, or rows that meet
too often since they are unevenly spread, are compared pair by pair.
Cells beyond ``CELL_ROWS`` are cut into chunks, each pair of chunks a group of its own.

Exact copies share a fingerprint and are one row from the start.

Defined results: a null text has no words and fingerprint zero, as has a text of
white space only, and these are linked like any others; a text of fewer words than
a shingle is one shingle; repeated rows keep their row; a null doc_id keeps its row
and never names a component (a component of null ids only has a null id); an empty
table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.llm import ragged
from specloom.llm.components import connected_components
from specloom.llm.simhash import WORDS, _majority
from specloom.session import cut_lineage

SHINGLE = 5
PARTS = 4
SEGMENTS = 32 * PARTS
#: Bits in which near-copies differ at most, of ``64 * PARTS``.
DISTANCE = 48
#: Share of differing bits at which two texts still meet in a grid with probability ``RECALL``.
FLIP, RECALL = 0.155, 0.95
#: Rows of a cell if fingerprints are evenly spread, and rows compared in one go.
CELL_MEAN, CELL_ROWS = 128, 4096
#: Rows up to which cells are compared many at a time; links a row before only a forest goes out.
SMALL, DENSE = 256, 2
#: The fewest grids.
LEAST_GRIDS = 16
#: Chunks of the exact search of all pairs: so many, if they have the least rows, and more beyond the most rows.
CHUNKS, CHUNK_LEAST, CHUNK_MOST = 8, 2048, 1 << 19
#: Rows compared with each other in one go.
TILE_ROWS, TILE_COLUMNS = 32, 8192
#: The most bits of a block, and rows looked up and pairs compared in one go.
BLOCK_BITS, PROBES, PAIRS = 24, 1 << 16, 1 << 18
#: Nanoseconds, about, of a pair where all are compared, of a value looked up, of a pair that meets, and of a row in a block.
PAIR_NS, PROBE_NS, CANDIDATE_NS, ROW_NS = 2.4, 3.0, 35.0, 250.0
#: Bits that the count of a two-bit segment tells.
SEGMENT_BITS = 1.415

_ODD = np.uint64(0x5555555555555555)


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of a slice of texts, one row of ``PARTS`` longs each."""
    data = ragged.fold(data)
    starts, ends, bounds = ragged.find_words(data, offsets, WORDS)
    words = np.diff(bounds)
    shingles = np.where(words > 0, np.maximum(1, words - shingle + 1), 0)
    first = np.repeat(bounds[:-1], shingles) + ragged.runs(shingles)
    last = np.minimum(first + shingle, np.repeat(bounds[1:], shingles))
    sums = ragged.prefix_sums(ragged.run_hashes(ragged.prefix_sums(data), starts, ends))
    hashes = ragged.run_hashes(sums, first, last)
    until = np.concatenate([[0], np.cumsum(shingles)])
    parts = [_majority(ragged.mix(hashes ^ np.uint64(i * 0x9E3779B97F4A7C15 % 2**64)), until) for i in range(PARTS)]
    return np.ascontiguousarray(np.stack(parts, axis=1))


def _binary(prints: np.ndarray) -> pa.Array:
    width = 8 * PARTS
    offsets = pa.py_buffer(np.arange(0, width * len(prints) + 1, width, dtype=np.int32))
    return pa.Array.from_buffers(pa.binary(), len(prints), [None, offsets, pa.py_buffer(np.ascontiguousarray(prints))])


def _longs(column: pa.Array) -> np.ndarray:
    """Fingerprints of a column that has no nulls."""
    whole = column.cast(pa.binary())
    begin = np.frombuffer(whole.buffers()[1], np.int32, 1, 4 * whole.offset)[0] if len(whole) else 0
    if not len(whole):
        return np.zeros((0, PARTS), np.uint64)
    return np.frombuffer(whole.buffers()[2], np.uint64, PARTS * len(whole), int(begin)).reshape(-1, PARTS)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint of every whole text, as binary."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in ragged.text_slices(batch.column("text")):
                prints = fingerprints_of(data, offsets, shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, len(prints)), _binary(prints)], ["doc_id", "fingerprint"]
                )

    return ragged.map_in_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, fingerprint binary")


# ---- links


def unary_counts(prints: np.ndarray) -> np.ndarray:
    """Bit counts of the two-bit segments, each in unary."""
    high = prints >> np.uint64(1)
    return ((prints | high) & _ODD) | ((prints & high & _ODD) << np.uint64(1))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def grids_for(rows: int) -> tuple[int, int]:
    """Segments of a grid and number of grids for so many fingerprints."""
    segments = max(2, round(math.log2(max(2, rows / CELL_MEAN)) / SEGMENT_BITS))
    same = (1 - FLIP) ** 2 + FLIP**2 / 2  # a segment's count: no bit differs, or 01 has become 10
    return segments, max(LEAST_GRIDS, math.ceil(math.log(1 - RECALL) / math.log(1 - same**segments)))


def grid_masks(segments: int, grids: int) -> np.ndarray:
    """For each grid, the bits of the segments that span it; segments are used up before any is used again."""
    draw, masks, left = np.random.default_rng(42), np.zeros((grids, PARTS), np.uint64), np.zeros(0, np.int64)
    for mask in masks:
        chosen, left = left[:segments], left[segments:]
        if len(chosen) < segments:
            others = np.setdiff1d(np.arange(SEGMENTS), chosen)
            fresh = np.concatenate([draw.permutation(others), draw.permutation(chosen)])
            need = segments - len(chosen)
            chosen, left = np.concatenate([chosen, fresh[:need]]), fresh[need:]
        for s in chosen.tolist():
            mask[s // 32] |= np.uint64(3 << 2 * (s % 32))
    return masks


def _cells(masks: np.ndarray):
    """Each fingerprint once a grid, with the hash of its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 2048):
                column = batch.column(0).slice(row, 2048)
                counts = unary_counts(_longs(column))
                for g, mask in enumerate(masks):
                    cell = np.full(len(counts), g + 1, np.uint64)
                    for part in range(PARTS):
                        cell = ragged.mix(cell ^ ragged.mix((counts[:, part] & mask[part]) + np.uint64(part + 1)))
                    yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), column], ["cell", "fingerprint"])

    return run


def _near(prints: np.ndarray, counts: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Which pairs of rows are within the distance: the bound first, then exactly."""
    near = np.flatnonzero(distance(counts[a], counts[b]) <= most)
    return near[distance(prints[a[near]], prints[b[near]]) <= most]


def forest(prints: np.ndarray, counts: np.ndarray, most: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs within the distance connect, at most one less than rows."""
    rest = np.arange(len(prints))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = _near(prints, counts, rest, np.full(len(rest), at), most)
            if len(near):
                found = rest[near]
                left.append(np.full(len(found), at))
                right.append(found)
                queue.extend(found.tolist())
                rest = np.delete(rest, near)
    return np.concatenate(left), np.concatenate(right)


def cell_links(prints: np.ndarray, cuts: np.ndarray, most: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links within the cells that begin at ``cuts`` (and end at the next; the last entry is the end)."""
    counts = unary_counts(prints)
    sizes = np.diff(cuts)
    small = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    a, b, cell = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(1, int(sizes[small].max(initial=1))):  # row i with row i + k
        many = small[sizes[small] > k]
        first = np.repeat(cuts[many], sizes[many] - k) + ragged.runs(sizes[many] - k)
        near = _near(prints, counts, first, first + k, most)
        a.append(first[near]), b.append(first[near] + k)
        cell.append(np.repeat(many, sizes[many] - k)[near])
    first, second, own = np.concatenate(a), np.concatenate(b), np.concatenate(cell)
    dense = np.bincount(own, minlength=len(sizes)) > DENSE * sizes
    a, b = [first[~dense[own]]], [second[~dense[own]]]
    for i in np.flatnonzero(dense | (sizes > SMALL)):
        x, y = forest(prints[cuts[i] : cuts[i + 1]], counts[cuts[i] : cuts[i + 1]], most)
        a.append(x + cuts[i]), b.append(y + cuts[i])
    return np.concatenate(a), np.concatenate(b)


def _links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Links of every cell; rows come in order of (cell, pair of chunks), and a cell may span batches."""

    def found(prints: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        x, y = cell_links(prints, cuts, most)
        return pa.RecordBatch.from_arrays([_binary(prints[x]), _binary(prints[y])], ["a", "b"])

    held: tuple[np.ndarray, ...] | None = None
    for batch in batches:
        now = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), _longs(batch.column(2)))
        now = now if held is None else tuple(np.concatenate(x) for x in zip(held, now))
        changed = np.flatnonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])) + 1
        if len(changed):
            stop = int(changed[-1])
            yield found(now[2][:stop], np.concatenate([[0], changed]))
            now = tuple(x[stop:] for x in now)
        held = now
    if held is not None and len(held[0]):
        yield found(held[2], np.array([0, len(held[0])]))


def fingerprint_links(prints: DataFrame, most: int = DISTANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fingerprint``) within the distance.

    They connect, through others or not, all pairs that meet in a grid.
    """
    masks = grid_masks(*grids_for(prints.count()))
    cells = ragged.map_in_arrow(prints.select("fingerprint"), _cells(masks), "cell long, fingerprint binary")
    # cells of many rows, at most one for every cell_rows rows
    large = cells.groupBy("cell").count().filter(F.col("count") > cell_rows)
    large = large.select("cell", F.ceil(F.col("count") * 2 / cell_rows).cast("int").alias("chunks"))
    placed = cells.join(large, "cell", "left")
    chunk = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.least(chunk, other) * F.col("chunks") + F.greatest(chunk, other),
    )
    placed = placed.select(
        "cell", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("pair"), "fingerprint"
    )
    ordered = placed.repartition("cell", "pair").sortWithinPartitions("cell", "pair")
    return ragged.map_in_arrow(ordered, lambda batches: _links(batches, most), "a binary, b binary")


def _roots_met(x: tuple, y: tuple, same: bool, most: int) -> set[tuple[int, int]]:
    """Pairs of labels with rows within the distance; ``x`` and ``y`` are (fingerprints, labels), maybe the same ones."""
    met: set[tuple[int, int]] = set()
    (a, own), (b, other) = x, y
    half = PARTS // 2
    buffers = [np.empty(TILE_ROWS * TILE_COLUMNS, kind) for kind in (np.uint64, np.uint8, np.uint8)]
    columns = [np.ascontiguousarray(b[:, part]) for part in range(PARTS)]
    for top in range(0, len(a), TILE_ROWS):
        rows, mine = a[top : top + TILE_ROWS], own[top : top + TILE_ROWS]
        for left in range(top if same else 0, len(b), TILE_COLUMNS):
            stop = left + TILE_COLUMNS
            shape = (len(rows), len(columns[0][left:stop]))
            bits, ones, apart = (buffer[: shape[0] * shape[1]].reshape(shape) for buffer in buffers)
            apart[:] = 0
            for part in range(half):  # at most 128 bits
                np.bitwise_xor(rows[:, part, None], columns[part][left:stop], out=bits)
                np.bitwise_count(bits, out=ones)
                apart += ones
            at = np.flatnonzero(apart.ravel() <= most)
            if not len(at):
                continue
            i, j = np.divmod(at, apart.shape[1])
            j += left
            differ = np.flatnonzero(mine[i] != other[j])
            i, j = i[differ], j[differ]
            near = np.flatnonzero(distance(rows[i], b[j]) <= most)
            if len(near):
                met.update(map(tuple, np.unique(np.stack([mine[i[near]], other[j[near]]], axis=1), axis=0).tolist()))
    return met


def blocks_for(a: int, b: int, most: int) -> list[tuple[int, int, int]]:
    """First bit, bits and radius of blocks of a fingerprint; none if comparing ``a`` with ``b`` rows pair by pair is cheaper.

    The radii and one more for each block add up to ``most + 1``, so two fingerprints within ``most`` bits
    differ in no more than its radius in at least one block.
    """
    least, chosen, whole = PAIR_NS * a * b, [], 64 * PARTS
    for count in range(-(-whole // BLOCK_BITS), 33):
        edges = [whole * i // count for i in range(count + 1)]
        bits = [y - x for x, y in zip(edges, edges[1:])]
        radius, cost = [-1] * count, 0.0
        for _ in range(most + 1):
            steps = [
                math.comb(n, r + 1) * a * (PROBE_NS + CANDIDATE_NS * b / 2**n) + (r < 0) * (ROW_NS * (a + b) + 2.0**n)
                for n, r in zip(bits, radius)
            ]
            i = int(np.argmin(steps))
            cost += steps[i]
            radius[i] += 1
        if cost < least:
            least, chosen = cost, [block for block in zip(edges, bits, radius) if block[2] >= 0]
    return chosen


def _changes(bits: int, radius: int) -> dict[int, list[int]]:
    """All ways to change at most so many bits, by the highest bit changed; -1: no bit is."""
    ways: dict[int, list[int]] = {-1: [0]}
    for k in range(1, radius + 1):
        for chosen in itertools.combinations(range(bits), k):
            ways.setdefault(chosen[-1], []).append(sum(1 << bit for bit in chosen))
    return ways


class _Block:
    """Rows in the order of (a block's value, label); rows with the same of both are one group."""

    def __init__(self, prints: np.ndarray, labels: np.ndarray, start: int, bits: int):
        word, shift = divmod(start, 64)
        value = prints[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value |= prints[:, word + 1] << np.uint64(64 - shift)
        key = (value & np.uint64((1 << bits) - 1)) << np.uint64(32) | labels.astype(np.uint64)
        order = np.argsort(key)
        self.key, self.prints = key[order], prints[order]
        #: the half of the fingerprint that the block does not begin in
        half = PARTS // 2 if word < PARTS // 2 else 0
        self.words = [np.ascontiguousarray(self.prints[:, part]) for part in range(half, half + PARTS // 2)]
        self.labels = self.key.astype(np.uint32)
        self.first = np.flatnonzero(np.concatenate([[True], self.key[1:] != self.key[:-1]]))
        self.counts = np.diff(np.append(self.first, len(self.key)))
        self.single = len(self.first) == len(self.key)
        self.values = (self.key[self.first] >> np.uint64(32)).astype(np.int64)
        #: whether the next group has the same value
        self.goes_on = np.append(self.values[1:] == self.values[:-1], False)

    def meet(
        self, i: np.ndarray, to: np.ndarray, first: np.ndarray, held: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Each group ``i`` with every group of the value ``to``, of which there is one at least."""
        j = first[to]
        found = [(i, j)]
        more = np.flatnonzero(self.goes_on[j])
        while len(more) and len(found) < 4:
            i, to, j = i[more], to[more], j[more] + 1
            found.append((i, j))
            more = np.flatnonzero(self.goes_on[j])
        if len(more):
            many = first[to[more]] + held[to[more]] - j[more] - 1
            found.append((np.repeat(i[more], many), np.repeat(j[more] + 1, many) + ragged.runs(many)))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _pairs_of(a: _Block, b: _Block, i: np.ndarray, j: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
    """The pairs of rows of pairs of groups, some at a time."""
    if a.single and b.single:
        yield i, j
        return
    ends = np.cumsum(sizes)
    for begin in range(0, int(ends[-1]), PAIRS):
        flat = np.arange(begin, min(begin + PAIRS, int(ends[-1])))
        at = np.searchsorted(ends, flat, "right")
        row, column = np.divmod(flat - (ends - sizes)[at], b.counts[j[at]])
        yield a.first[i[at]] + row, b.first[j[at]] + column


def _roots_met_in_blocks(
    x: tuple, y: tuple, same: bool, most: int, blocks: list[tuple[int, int, int]]
) -> set[tuple[int, int]] | None:
    """As ``_roots_met``, comparing only rows that differ in no more than its radius in a block.

    None once so many rows meet in blocks (fingerprints that are unevenly spread) that comparing all is cheaper.
    """
    met: set[tuple[int, int]] = set()
    left = PAIR_NS * len(x[0]) * len(y[0]) / CANDIDATE_NS
    for start, bits, radius in blocks:
        a = _Block(*x, start, bits)
        b = a if same else _Block(*y, start, bits)
        held = np.bincount(b.values, minlength=1 << bits)
        known, first = held > 0, np.cumsum(held) - held
        for top, ways in _changes(bits, radius).items():
            # of two groups of one table, only that with a zero at the highest bit changed looks for the other
            own = np.flatnonzero(a.values >> top & 1 == 0) if same and top >= 0 else None
            values = a.values if own is None else a.values[own]
            for change, begin in itertools.product(ways, range(0, len(values), PROBES)):
                to = values[begin : begin + PROBES] ^ change
                hit = np.flatnonzero(known[to])
                i, j = b.meet(begin + hit if own is None else own[begin + hit], to[hit], first, held)
                if same and top < 0:
                    later = np.flatnonzero(i < j)
                    i, j = i[later], j[later]
                sizes = None
                if not (a.single and b.single):
                    differ = np.flatnonzero(a.labels[a.first[i]] != b.labels[b.first[j]])
                    i, j = i[differ], j[differ]
                    sizes = a.counts[i] * b.counts[j]
                left -= len(i) if sizes is None else int(sizes.sum())
                if left < 0:
                    return None
                if not len(i):
                    continue
                for i, j in _pairs_of(a, b, i, j, sizes):
                    apart = sum(np.bitwise_count(p.take(i) ^ q.take(j)) for p, q in zip(a.words, b.words))
                    near = np.flatnonzero(apart <= most)
                    i, j = i[near], j[near]
                    near = np.flatnonzero(a.labels[i] != b.labels[j])
                    near = near[distance(a.prints[i[near]], b.prints[j[near]]) <= most]
                    met.update(zip(a.labels[i[near]].tolist(), b.labels[j[near]].tolist()))
    return met


def _missed(batches: Iterator[pa.RecordBatch], chunks: int, most: int) -> Iterator[pa.RecordBatch]:
    """Roots that are linked, of every pair of chunks; rows come in order of the pair."""

    def found(pair: int, chunk: np.ndarray, prints: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
        whole, labels = np.unique(roots.view(f"V{8 * PARTS}").ravel(), return_inverse=True)
        first, second = divmod(pair, chunks)
        sides = [(np.ascontiguousarray(prints[chunk == c]), labels[chunk == c]) for c in (first, second)]
        same = first == second
        blocks = blocks_for(*(len(side[0]) for side in sides), most)
        met = _roots_met_in_blocks(*sides, same, most, blocks) if blocks else None
        met = sorted(_roots_met(*sides, same, most) if met is None else met)
        named = whole.view(np.uint64).reshape(-1, PARTS)
        x, y = (np.array([m[k] for m in met], np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([_binary(named[x]), _binary(named[y])], ["a", "b"])

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        columns = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), _longs(batch.column(2)), _longs(batch.column(3)))
        cuts = [0, *(np.flatnonzero(np.diff(columns[0])) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if start == stop:
                continue
            if held and held[-1][0][-1] != columns[0][start]:
                pair, *rest = (np.concatenate(c) for c in zip(*held))
                yield found(int(pair[0]), *rest)
                held = []
            held.append(tuple(c[start:stop] for c in columns))
    if held:
        pair, *rest = (np.concatenate(c) for c in zip(*held))
        yield found(int(pair[0]), *rest)


def missed_links(rooted: DataFrame, most: int = DISTANCE) -> DataFrame:
    """Links ``a``, ``b`` between the roots of all ``fingerprint`` within the distance that have different ``root``.

    All pairs that may be within it are compared, which is what makes the result exact: two chunks of
    rows at a time, in a task's bounded memory; each row goes to as many tasks as there are chunks.
    Of partitions there are more than pairs of chunks, so that few of them get several.
    """
    rows = rooted.count()
    chunks = max(1, min(CHUNKS, -(-rows // CHUNK_LEAST)), -(-rows // CHUNK_MOST))
    chunk = F.pmod(F.xxhash64("fingerprint"), F.lit(chunks)).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.lit(chunks - 1)), lambda other: F.least(chunk, other) * chunks + F.greatest(chunk, other)
    )
    placed = rooted.select(F.explode(pairs).alias("pair"), chunk.alias("chunk"), "fingerprint", "root")
    ordered = placed.repartition(2 * chunks * (chunks + 1), "pair").sortWithinPartitions("pair")
    return ragged.map_in_arrow(ordered, lambda batches: _missed(batches, chunks, most), "a binary, b binary")


def roots_of(distinct: DataFrame, most: int = DISTANCE) -> DataFrame:
    """The distinct fingerprints of a table with ``root``, the same for all that are connected within the distance."""
    met = connected_components(fingerprint_links(distinct, most)).withColumnRenamed("node", "fingerprint")
    rooted = cut_lineage(
        distinct.join(met, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    )
    whole = connected_components(missed_links(rooted, most)).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return rooted.join(whole, F.col("root") == F.col("_node"), "left").withColumn(
        "root", F.coalesce("_root", "root")
    ).drop("_node", "_root")


def near_texts(docs: DataFrame, shingle: int = SHINGLE, most: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (64 hex digits) and component_id (the least doc_id reached over links) of every document."""
    prints = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    rooted = cut_lineage(roots_of(distinct, most))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select(
        "doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id"
    )
