"""Whole columns of text as one byte buffer with offsets, and hashes of their words.

All functions work on numpy arrays of one slice of a batch; a slice holds whole
texts, so memory is bounded by ``SLICE_BYTES`` or the one longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text worked on at a time.
SLICE_BYTES = 2 << 20
#: What Spark sends to a Python worker at a time: so many bytes, or one row.
BATCH_BYTES = "4m"
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

WORD_BREAKS = bytes([0x20, *range(0x09, 0x0E)])


def map_in_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, so that long texts do not make large ones.

    Spark's bound (64 MB, and as much again for copies on either side) is lowered
    in the session unless the user has set one.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_CONF, None) in (None, "64MB", str(64 << 20), f"{64 << 20}b"):
        conf.set(_BATCH_CONF, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of runs of whole texts; a null is an empty text."""
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    if len(texts) == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
        yield row, whole[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def word_table(breaks: bytes) -> np.ndarray:
    """Which bytes belong to words, when ``breaks`` do not."""
    table = np.ones(256, bool)
    table[list(breaks)] = False
    return table


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    return _FOLD[data]


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of words before it (one more at the end)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside[1:] & (~inside[:-1] | edge)
    finishes = inside[:-1] & (~inside[1:] | edge)
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes)
    return starts, ends, np.searchsorted(starts, offsets)


def _grow(size: int) -> None:
    global _powers, _inverses
    if len(_powers) < size:
        with np.errstate(over="ignore"):
            for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                globals()[name] = np.cumprod(table, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which the hash of every run of ``values`` follows; see ``run_hashes``."""
    _grow(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers[: len(values)], out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs [start, end): equal runs give equal hashes, wherever they stand."""
    with np.errstate(over="ignore"):
        h = (sums[ends] - sums[starts]) * _inverses[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given lengths, one after the other."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before, counts)


def repeated_texts(values: list[str | None], times: np.ndarray) -> pa.Array:
    return pa.array(values, pa.string()).take(pa.array(np.repeat(np.arange(len(values)), times)))
