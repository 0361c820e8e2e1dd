"""SimHash near-copies: links at a small Hamming distance, found through bit counts of segments.

Shingle size and distance are parameters; what follows is said for 4 bits.  A fingerprint is cut into 32 segments of two bits and mapped to the bit count of
each.  The Manhattan distance of two such vectors never exceeds the Hamming
distance, so it serves as a lower bound.  Counts are kept in unary (0, 01, 11),
which makes the Manhattan distance the number of differing bits of two longs.

The range join runs over grids: the segments form ``g`` groups, and each choice
of ``g - 4`` groups spans a grid with cells one count wide.  Two vectors at most
4 apart differ in at most 4 groups, so they share a cell in at least one grid.
Within a cell, pairs pass the Manhattan bound, then the exact Hamming distance;
what leaves a cell is a spanning forest of its links, never all pairs.  ``g``
grows with the number of fingerprints so that cells stay small; the result does
not depend on it.  Cells beyond ``CELL_ROWS`` (many near-copies of one text) are
cut into chunks, and every pair of chunks is a task's work of its own.

Exact copies share a fingerprint and are one row from the start.

Defined results: a null text has no words and fingerprint zero, as has a text of
white space only, and these are linked like any others; repeated rows keep their
row; a null doc_id keeps its row and never names a component (a component of
null ids only has a null id); further columns are not looked at.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.llm import ragged
from specloom.llm.components import connected_components
from specloom.session import cut_lineage

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Fingerprints of a cell compared in one go.
CELL_ROWS = 4096
#: Rows a cell may have on average if fingerprints are evenly spread; each further bit of distance doubles it, since
#: the number of grids grows with the distance.
CELL_MEAN = 64
#: Links a cell's rows may have each before only a spanning forest is looked for.
DENSE = 4

WORDS = ragged.word_table(ragged.WORD_BREAKS)
_EIGHT = np.uint64(0x0101010101010101)


def _majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per run of hashes, the bits set in over half of them; zero for an empty run."""
    counts = np.diff(bounds)
    result = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return result
    # sums of eight bits at a time in the bytes of a long, over at most 255 hashes
    pieces = -(-counts[full] // 255)
    begin = np.repeat(bounds[full], pieces) + ragged.runs(pieces) * 255
    first_piece = np.cumsum(pieces) - pieces
    for bit in range(8):
        part = np.add.reduceat((hashes >> np.uint64(bit)) & _EIGHT, begin)
        sums = np.add.reduceat(part.view(np.uint8).reshape(-1, 8), first_piece, axis=0, dtype=np.int64)
        over = (2 * sums > counts[full][:, None]).astype(np.uint8)
        result[full] |= np.ascontiguousarray(over).view(np.uint64).ravel() << np.uint64(bit)
    return result


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of a slice of texts over shingles of so many words."""
    data = ragged.fold(data)
    starts, ends, bounds = ragged.find_words(data, offsets, WORDS)
    if not len(starts):
        return np.zeros(len(offsets) - 1, np.uint64)
    # the words of the whole slice, one space between neighbours
    lengths = ends - starts
    to = np.cumsum(lengths + 1) - lengths - 1
    joined = np.full(int(to[-1] + lengths[-1]), 0x20, np.uint8)
    spread = ragged.runs(lengths)
    joined[np.repeat(to, lengths) + spread] = data[np.repeat(starts, lengths) + spread]
    text, until = joined.tobytes(), to + lengths
    words = np.diff(bounds)
    shingles = np.where(words > 0, np.maximum(1, words - shingle + 1), 0)
    first = np.repeat(bounds[:-1], shingles) + ragged.runs(shingles)
    last = np.minimum(first + shingle, np.repeat(bounds[1:], shingles)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[a:b], SEED) for a, b in zip(to[first].tolist(), until[last].tolist())), np.uint64, len(first)
    )
    return _majority(hashes, np.concatenate([[0], np.cumsum(shingles)]))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint of every whole text as a long (its 64 bits)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in ragged.text_slices(batch.column("text")):
                prints = fingerprints_of(data, offsets, shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, len(prints)), pa.array(prints.view(np.int64))],
                    ["doc_id", "fingerprint"],
                )

    return ragged.map_in_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, fingerprint long")


# ---- links


def _unary_counts(f: Column) -> Column:
    """Bit counts of the two-bit segments, each in unary."""
    odd = F.lit(0x5555555555555555)
    high = F.shiftrightunsigned(f, 1)
    return f.bitwiseOR(high).bitwiseAND(odd).bitwiseOR(F.shiftleft(f.bitwiseAND(high).bitwiseAND(odd), 1))


def grid_masks(groups: int, distance: int = DISTANCE) -> list[int]:
    """For each grid, the bits of the segments that span it, as signed longs."""
    parts = np.array_split(np.arange(32), groups)
    bits = [sum(3 << 2 * int(s) for s in part) for part in parts]
    masks = [sum(chosen) for chosen in itertools.combinations(bits, groups - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def groups_for(rows: int, distance: int = DISTANCE) -> int:
    """The fewest groups that keep cells small: a segment's count tells about 1.415 bits."""
    mean = CELL_MEAN * 2 ** (distance - DISTANCE)
    for groups in range(distance + 2, distance + 13):
        if rows / 2 ** (1.415 * 32 * (groups - distance) / groups) <= mean:
            return groups
    return distance + 13


def _near(a: np.ndarray, ca: np.ndarray, b: int, cb: int, distance: int) -> np.ndarray:
    """Which of many fingerprints are within the distance of one: the bound first, then exactly."""
    near = np.flatnonzero(np.bitwise_count(ca ^ cb) <= distance)
    return near[np.bitwise_count(a[near] ^ b) <= distance]


def few_links(prints: np.ndarray, counts: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray] | None:
    """All links of a cell, some rows with all later ones at a time; None once they are more than ``DENSE`` a row."""
    left, right, found = [], [], 0
    for i in range(0, len(prints), 256):
        x, y = np.nonzero(np.bitwise_count(counts[i : i + 256, None] ^ counts[None, i:]) <= distance)
        later = x < y
        x, y = x[later] + i, y[later] + i
        near = np.bitwise_count(prints[x] ^ prints[y]) <= distance
        left.append(x[near]), right.append(y[near])
        found += len(left[-1])
        if found > DENSE * len(prints):
            return None
    return np.concatenate(left), np.concatenate(right)


def forest(prints: np.ndarray, counts: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs within the distance connect, at most one less than rows.

    Visits each component from one member on; a member is compared only with
    those not yet reached, which in a dense cell are soon few.
    """
    rest = np.arange(len(prints))
    left, right = [], []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = _near(prints[rest], counts[rest], prints[at], counts[at], distance)
            if len(near):
                found = rest[near]
                left.append(np.full(len(found), at))
                right.append(found)
                queue.extend(found.tolist())
                rest = np.delete(rest, near)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _cell_links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links of every cell; rows come in order of cell (grid, cell, chunk pair)."""
    held: list[tuple[np.ndarray, ...]] = []

    def links(columns: list[np.ndarray], cuts: np.ndarray) -> pa.RecordBatch:
        prints, counts = columns[-1].view(np.uint64), columns[-2].view(np.uint64)
        a, b = [], []
        sizes = np.diff(cuts)
        # cells of two are most of all: one comparison for all of them
        two = cuts[:-1][sizes == 2]
        near = two[np.bitwise_count(counts[two] ^ counts[two + 1]) <= distance]
        near = near[np.bitwise_count(prints[near] ^ prints[near + 1]) <= distance]
        a.append(near), b.append(near + 1)
        # those of up to 32: row i with row i + k, for every k
        small = (sizes > 2) & (sizes <= 32)
        begin, size = cuts[:-1][small], sizes[small]
        for k in range(1, int(size.max(initial=1))):
            many = size > k
            first = np.repeat(begin[many], size[many] - k) + ragged.runs(size[many] - k)
            near = first[np.bitwise_count(counts[first] ^ counts[first + k]) <= distance]
            near = near[np.bitwise_count(prints[near] ^ prints[near + k]) <= distance]
            a.append(near), b.append(near + k)
        for i in np.flatnonzero(sizes > 32):
            cell = prints[cuts[i] : cuts[i + 1]], counts[cuts[i] : cuts[i + 1]], distance
            x, y = few_links(*cell) or forest(*cell)
            a.append(x + cuts[i]), b.append(y + cuts[i])
        first, second = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[-1][first]), pa.array(columns[-1][second])], ["a", "b"]
        )

    def cut(columns: list[np.ndarray]) -> np.ndarray:
        n = len(columns[0])
        changed = np.zeros(n, bool)
        for c in columns[:-2]:
            changed[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(changed)

    for batch in batches:
        held.append(tuple(c.to_numpy() for c in batch.columns))
        columns = [np.concatenate(c) for c in zip(*held)]
        inner = cut(columns)
        if len(inner):  # the last cell may go on in the next batch
            stop = int(inner[-1])
            yield links([c[:stop] for c in columns], np.concatenate([[0], inner]))
            held = [tuple(c[stop:] for c in columns)]
        else:
            held = [tuple(columns)]
    if held and len(held[0][0]):
        columns = list(held[0])
        yield links(columns, np.array([0, len(columns[0])]))


def fingerprint_links(
    prints: DataFrame, groups: int | None = None, cell_rows: int = CELL_ROWS, distance: int = DISTANCE
) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints within the distance, through others or not.

    ``prints`` has distinct values in the column ``fingerprint``.
    """
    groups = groups or groups_for(prints.count(), distance)
    counts = _unary_counts(F.col("fingerprint"))
    cells = prints.select("fingerprint", counts.alias("counts")).select(
        "fingerprint", "counts",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("grid"), F.col("counts").bitwiseAND(F.lit(m)).alias("cell"))
            for i, m in enumerate(grid_masks(groups, distance))
        ])).alias("at"),
    ).select("at.grid", "at.cell", "counts", "fingerprint")
    # cells of many rows, at most one for every cell_rows rows
    large = cells.groupBy("grid", "cell").count().filter(F.col("count") > cell_rows)
    large = large.select("grid", "cell", F.ceil(F.col("count") * 2 / cell_rows).cast("int").alias("chunks"))
    placed = cells.join(large, ["grid", "cell"], "left")
    chunk = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.least(chunk, other) * F.col("chunks") + F.greatest(chunk, other),
    )
    placed = placed.withColumn(
        "pair", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(pairs))
    )
    keys = ["grid", "cell", "pair"]
    ordered = placed.select(*keys, "counts", "fingerprint").repartition(*keys).sortWithinPartitions(*keys)
    return ragged.map_in_arrow(ordered, lambda batches: _cell_links(batches, distance), "a long, b long")


def near_copies(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document.

    component_id is the least doc_id of all documents reached over links between
    fingerprints of ``shingle`` words at most ``distance`` bits apart.
    """
    prints = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = connected_components(fingerprint_links(distinct.select("fingerprint"), distance=distance))
    rooted = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
