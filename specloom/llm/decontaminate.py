"""Benchmark decontamination by a prefix-filtered set join on word shingles.

Every window of ``WINDOW`` consecutive words of a benchmark item (a shorter item
is one window) is a set of shingles of ``SHINGLE`` words.  A document contains a
window only if it contains all of its shingles, so it is enough to look for a
window by one of them, its prefix.  The shingles are ordered by how often they
occur in all documents, and the rarest one is the prefix.  Where it occurs in a
document, its place in the window gives the only possible start; the window must
lie within the document (length and positional bounds) and is then compared
word by word.

Nothing of the benchmark is gathered.  The tasks that read documents get a bitmap
of hashed shingles, of at most ``2 ** MOST_BITS`` bits whatever the benchmark's
size, and hand on only those shingles that it may hold, with the words around them.
Counts, the choice of prefixes, and the join of shingles with windows are
Spark's, as is the comparison of words; a shingle that is frequent in spite of being
its window's rarest is split like any skewed key.  What is found depends on the
text alone and is joined with the documents by its digest.

Defined results: words are runs of letters, digits and characters beyond ASCII,
A-Z in lower case; a null or wordless document has 0 words and is clean; an item
that is null or has no words has no windows; items that share a window are all
reported; an item given twice is reported once, one without an id makes hits but
is not named; an empty benchmark leaves all
documents clean; repeated documents each get their row; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.llm import ragged
from specloom.session import cut_lineage

WINDOW = 10
SHINGLE = 5
#: The bitmap has 16 bits for each shingle in it, within these powers of two: 8 kB to 16 MB.
LEAST_BITS, MOST_BITS = 16, 27

WORDS = ragged.word_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


class _Words:
    """Words of a slice of texts, with hashes of any run of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = ragged.fold(data)
        self.starts, self.ends, self.bounds = ragged.find_words(self.data, offsets, WORDS)
        hashes = ragged.run_hashes(ragged.prefix_sums(self.data), self.starts, self.ends)
        self.sums = ragged.prefix_sums(hashes)
        #: for each word, where its text's words end
        self.last = np.repeat(self.bounds[1:], np.diff(self.bounds))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of all runs of ``size`` words inside a text, and their hashes."""
        at = np.flatnonzero(np.arange(len(self.last)) + size <= self.last)
        return at, ragged.run_hashes(self.sums, at, at + size)

    def text(self, start: int, size: int) -> bytes:
        raw = self.data.data
        return b" ".join(
            bytes(raw[s:e]) for s, e in zip(self.starts[start : start + size], self.ends[start : start + size])
        )


class _Lookup:
    """Finds which of many hashes are among a sorted few."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(known >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` and in ``known`` of all that are in both."""
        at = np.flatnonzero(self.seen[(hashes >> np.uint64(44)).astype(np.int64)])
        where = np.searchsorted(self.known, hashes[at])
        same = where < len(self.known)
        same[same] = self.known[where[same]] == hashes[at][same]
        return at[same], where[same]


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64), pa.int64())


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id (text), and each window of the item: n (words), words, tokens (shingle hashes in order)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for row, data, offsets in ragged.text_slices(batch.column("text")):
                words = _Words(data, offsets)
                out: dict[str, list] = {"item_id": [], "n": [], "words": [], "tokens": []}
                for i in range(len(offsets) - 1):
                    first, last = int(words.bounds[i]), int(words.bounds[i + 1])
                    n = min(window, last - first)
                    size = min(SHINGLE, n)
                    for start in range(first, last - n + 1) if n else ():
                        at = np.arange(start, start + n - size + 1)
                        out["item_id"].append(ids[row + i])
                        out["n"].append(n)
                        out["words"].append(words.text(start, n).decode())
                        out["tokens"].append(ragged.run_hashes(words.sums, at, at + size).view(np.int64).tolist())
                yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([
        ("item_id", pa.string()), ("n", pa.int32()), ("words", pa.string()), ("tokens", pa.list_(pa.int64())),
    ])
    rows = items.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    return ragged.map_in_arrow(rows, cut, "item_id string, n int, words string, tokens array<long>")


def _bitmap(tokens: DataFrame, bits: int) -> np.ndarray:
    """Which leading ``bits`` bits of a hash occur in the column ``token``: at most ``2 ** (bits - 6)`` longs."""
    slot = F.shiftrightunsigned("token", 64 - bits)
    table = tokens.select(
        F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(token, {64 - bits}) & 63 as int))").alias("bit")
    ).groupBy("at").agg(F.expr("bit_or(bit)").alias("set")).toArrow()
    longs = np.zeros(1 << (bits - 6), np.uint64)
    longs[table.column("at").to_numpy()] = table.column("set").to_numpy().view(np.uint64)
    return longs


def bits_for(tokens: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (16 * tokens).bit_length()))


def _held(longs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that the bitmap may hold."""
    slot = hashes >> np.uint64(64 - (len(longs).bit_length() + 5))
    return np.flatnonzero(longs[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1))


def token_counts(docs: DataFrame, bitmap, sizes: list[int]) -> DataFrame:
    """size, token, n: how often shingles that the bitmap may hold occur in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in ragged.text_slices(batch.column("text")):
                words = _Words(data, offsets)
                for size in sizes:
                    _, hashes = words.shingles(size)
                    token, n = np.unique(hashes[_held(bitmap.value, hashes)], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(token), size, np.int32)), _signed(token), pa.array(n.astype(np.int64))],
                        ["size", "token", "n"],
                    )

    counted = ragged.map_in_arrow(docs.select("text"), count, "size int, token long, n long")
    return counted.groupBy("size", "token").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """words, n, size, token, offset: each distinct window with its rarest shingle, ties by hash."""
    tokens = windows.select("words", "n", "size", F.posexplode("tokens").alias("offset", "token"))
    rank = F.struct(
        F.coalesce(counts["n"], F.lit(0)).alias("count"), tokens["token"].alias("token"), tokens["offset"].alias("offset")
    )
    same = (tokens["token"] == counts["token"]) & (tokens["size"] == counts["size"])
    ranked = tokens.join(counts, same, "left").select("words", tokens["n"], tokens["size"], rank.alias("rank"))
    return ranked.groupBy("words", "n", "size").agg(F.min("rank").alias("rank")).select(
        "words", "n", "size", "rank.token", "rank.offset"
    )


def candidates(keyed: DataFrame, bitmap, sizes: list[int], window: int) -> DataFrame:
    """_key, at, size, token, lead, around: shingles the bitmap may hold, at which word, and the words around.

    ``around`` has as many words on both sides as a window that holds the shingle
    may have, ``lead`` of them before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in ragged.text_slices(batch.column("text")):
                words = _Words(data, offsets)
                keys = batch.column("_key").slice(row, len(offsets) - 1)
                for size in sizes:
                    places, hashes = words.shingles(size)
                    hit = _held(bitmap.value, hashes)
                    for some in np.array_split(hit, -(-len(hit) // 4096)) if len(hit) else ():
                        at = places[some]
                        own = np.searchsorted(words.bounds, at, "right") - 1
                        begin = np.maximum(at - (window - size), words.bounds[own])
                        end = np.minimum(at + window, words.bounds[own + 1])
                        around = [words.text(b, e - b).decode() for b, e in zip(begin.tolist(), end.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [
                                keys.take(pa.array(own)), pa.array((at - words.bounds[own]).astype(np.int32)),
                                pa.array(np.full(len(at), size, np.int32)), _signed(hashes[some]),
                                pa.array((at - begin).astype(np.int32)), pa.array(around, pa.string()),
                            ],
                            ["_key", "at", "size", "token", "lead", "around"],
                        )

    return ragged.map_in_arrow(keyed, run, "_key string, at int, size int, token long, lead int, around string")


def word_counts(keyed: DataFrame) -> DataFrame:
    """The column ``both`` and n_words."""
    kind = keyed.schema["both"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in ragged.text_slices(batch.column("text")):
                _, _, bounds = ragged.find_words(ragged.fold(data), offsets, WORDS)
                keys = batch.column("both").slice(row, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(bounds), pa.int64())], ["both", "n_words"])

    return ragged.map_in_arrow(keyed, run, f"both {kind}, n_words long")


def find_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, bits: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """_key, at, n, words of every place where a window stands in a text; and words, item_id of the windows.

    ``_key`` is the text's SHA-256, so repeated texts are one.
    ``bits`` sets the size of the bitmaps (from 6 on), which changes no result.
    """
    context = docs.sparkSession.sparkContext
    every = cut_lineage(item_windows(items, window))
    size = F.least("n", F.lit(SHINGLE)).alias("size")
    windows = every.dropDuplicates(["words"]).select("words", "n", size, "tokens")
    named = every.filter(F.col("item_id").isNotNull()).select("words", "item_id").distinct()
    tokens = cut_lineage(windows.select("size", F.explode("tokens").alias("token")).distinct())
    sizes = sorted(r.size_ for r in tokens.select(F.col("size").alias("size_")).distinct().collect())
    texts = docs.select("text").filter(F.col("text").isNotNull())

    # how often the benchmark's shingles occur in all documents
    wide = context.broadcast(_bitmap(tokens, bits or bits_for(tokens.count())))
    counts = token_counts(texts, wide, sizes).join(tokens, ["size", "token"], "left_semi")
    chosen = cut_lineage(prefixes(windows, counts))

    # places where a window's prefix stands, within bounds, then its words
    narrow = context.broadcast(_bitmap(chosen, bits or bits_for(chosen.count())))
    near = candidates(texts.select(F.sha2("text", 256).alias("_key"), "text"), narrow, sizes, window)
    start = F.col("lead") - F.col("offset")
    text = F.array_join(F.slice(F.split("around", " "), F.greatest(start, F.lit(0)) + 1, F.col("n")), " ")
    found = near.join(chosen, ["size", "token"]).filter((start >= 0) & (text == F.col("words"))).select(
        "_key", (F.col("at") - F.col("offset")).alias("at"), "n", "words"
    )
    return cut_lineage(found.distinct()), named


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, bits: int | None = None) -> DataFrame:
    """All columns of ``docs`` that are named below, one row per document.

    doc_id, n_words, n_hit (words inside any window found), items (ids, sorted as
    text), n_items, items_sha256 (of the ids joined by commas), contaminated.
    """
    hits, named = find_hits(docs, items, window, bits)
    spans = hits.groupBy("_key").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    names = hits.select("_key", "words").distinct().join(named, "words").groupBy("_key").agg(
        F.collect_set("item_id").alias("items")
    )
    # a table of its own, so that its size is known when it meets the documents
    once = cut_lineage(spans.join(names, "_key", "left"))
    keyed = docs.select(F.struct("doc_id", F.sha2("text", 256).alias("_key")).alias("both"), "text")
    counted = word_counts(keyed).select("both.*", "n_words")
    return _summary(counted.join(once, "_key", "left"))


def without_contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, bits: int | None = None
) -> DataFrame:
    """The documents in whose text no window stands, all columns; a null text is clean.

    Only the digests of contaminated texts meet the documents, which are not shuffled
    as long as Spark's own bound for broadcasts holds that table.
    """
    hits, _ = find_hits(docs, items, window, bits)
    keys = cut_lineage(hits.select("_key").distinct())
    return docs.join(keys, F.sha2(docs["text"], 256) == keys["_key"], "left_anti")


def _summary(found: DataFrame) -> DataFrame:
    items = F.sort_array(F.coalesce(F.col("items"), F.array().cast("array<string>")))
    spans = F.sort_array(F.coalesce(F.col("spans"), F.expr("cast(array() as array<struct<at:int,n:int>>)")))
    # covered words: each span adds what lies beyond the furthest end so far
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(
        spans, start,
        lambda acc, s: F.struct(
            (acc.hit + F.greatest(F.lit(0), s["at"] + s["n"] - F.greatest(acc.end, s["at"]))).cast("long").alias("hit"),
            F.greatest(acc.end, s["at"] + s["n"]).cast("long").alias("end"),
        ),
        lambda acc: acc.hit,
    )
    return found.select("doc_id", "n_words", covered.alias("n_hit"), items.alias("items")).select(
        "doc_id", "n_words", "n_hit", "items", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def sha256_of(items: list[str]) -> str:
    """The digest of a list of ids, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def oracle(window: int = WINDOW) -> str:
    """The digest columns in DuckDB's SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH d AS (SELECT doc_id, {words} AS words FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {words} AS words FROM benchmark),
cut AS (
  SELECT item_id, words, least({window}, len(words)) AS n FROM i WHERE len(words) > 0),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(words[p:p + n - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS p FROM cut)),
places AS (
  SELECT doc_id, n, p, array_to_string(words[p:p + n - 1], ' ') AS k
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(words) >= n)),
hits AS (SELECT doc_id, p, places.n, item_id FROM places JOIN win USING (k)),
covered AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS spot FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
