"""Periodic runs: stretches of words that repeat with a period, found by minimizers of several scales.

A run is a stretch of consecutive words in which words one period apart are
equal, ``EXPONENT`` periods and ``LEAST_LENGTH`` words long at least, that no
neighbouring word extends; its period is the smallest one.

Periods up to ``SHORT`` are found by a direct scan of each lag.  Scale s covers
periods over ``2 ** (s - 1)`` up to ``2 ** s``.  There, grams of ``2 ** s``
words are hashed, and each window of ``2 ** (s - 1)`` grams selects its least.
Inside a run the windows repeat with the period, so what they select does, and
a gram as long as the period occurs nowhere in between: consecutive equal
minimizers are one period apart.  Such pairs are seeds; seeds of one lag that
meet are merged, and the merged stretch is compared word by word and extended
at both ends.  So hashes only propose, and what is found is exact.

The work of a text is in proportion to its words times the number of scales,
its memory to its words.  Python works on Arrow batches, since runs need each
text's words in order; nothing is shuffled, a text is one row.

Defined results: a null or empty text has no words and no runs; repeated rows
keep their row; a null doc_id stays null (and is not edited); ties are settled
as ``digests`` says; further columns are not looked at; very long texts are
searched whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from specloom.llm import ragged

EXPONENT, LEAST_LENGTH = 4, 6
#: Longest period that is looked for at each lag; a power of two.
SHORT = 8

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
RUNS_SCHEMA = "doc_id long, collapsed string, runs array<struct<start:long,length:long,period:long>>"
_WORDS = ragged.word_table(ragged.WORD_BREAKS)


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True."""
    edges = np.diff(np.concatenate(([False], equal, [False])).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _short_runs(ids: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """Runs of periods up to ``SHORT`` as rows of text, start, end, period."""
    found = []
    for lag in range(1, min(SHORT, len(ids) - 1) + 1):
        # no stretch goes from text to text: a text's last words have no partner
        begins, ends = _stretches((ids[lag:] == ids[:-lag]) & (text[lag:] == text[:-lag]))
        ends = ends + lag
        keep = ends - begins >= max(LEAST_LENGTH, EXPONENT * lag)
        begins, ends = begins[keep], ends[keep]
        found.append(np.stack([text[begins], begins, ends, np.full(len(begins), lag)], axis=1))
    return found


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ragged.mix(left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) + np.uint64(0x632BE59BD9B4E019))


def _seeds(grams: np.ndarray, scale: int, text: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of minimizers of a scale and the distance to the next equal one, if that fits the scale.

    ``last`` holds, for each word, the end of its text.
    """
    size, window = 1 << scale, 1 << (scale - 1)
    at = np.arange(len(grams))
    step = 1
    while step < window:
        left, right = at[:-step], at[step:]
        at = np.where(grams[left] <= grams[right], left, right)
        step *= 2
    inside = np.arange(len(at)) + window - 1 + size <= last[: len(at)]
    chosen = np.unique(at[inside])
    order = np.lexsort((chosen, grams[chosen], text[chosen]))
    ordered = chosen[order]
    here, there = ordered[:-1], ordered[1:]
    lag = there - here
    fits = (grams[here] == grams[there]) & (text[here] == text[there]) & (lag > window) & (lag <= size)
    return here[fits], lag[fits]


def _merged(at: np.ndarray, lag: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions [lo, hi) of the stretches [at, at + size) of each lag that meet."""
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    new = np.ones(len(at), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (at[1:] > at[:-1] + size)
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(at)) - 1
    return at[firsts], at[lasts] + size, lag[firsts]


def _extended(ids, lo, hi, lag, begin, end, margin) -> list[np.ndarray]:
    """Exact stretches of equal words at each lag that meet [lo, hi), as rows of candidate, from, to.

    ``margin`` words on both sides are enough for runs of the scale; what still reaches further is looked at again.
    """
    found = []
    left, right = np.maximum(lo - margin, begin), np.minimum(hi + margin, end - lag)
    todo = np.arange(len(lo))
    while len(todo):
        sizes = right[todo] - left[todo]
        whose = np.repeat(todo, sizes)
        at = left[whose] + ragged.runs(sizes)
        equal = ids[at] == ids[at + lag[whose]]
        # one False after each candidate keeps their stretches apart
        stops = np.cumsum(sizes)
        begins, ends = _stretches(np.insert(equal, stops, False))
        owner = np.searchsorted(stops + np.arange(len(stops)), begins, "right")
        which = todo[owner]
        offset = left[which] - (stops - sizes)[owner] - owner
        begins, ends = begins + offset, ends + offset
        meets = (begins < hi[which]) & (ends > lo[which])
        which, begins, ends = which[meets], begins[meets], ends[meets]
        further = ((begins == left[which]) & (begins > begin[which])) | (
            (ends == right[which]) & (ends < (end - lag)[which])
        )
        again = np.unique(which[further])
        done = ~np.isin(which, again)
        found.append(np.stack([which[done], begins[done], ends[done]], axis=1))
        margin *= 2
        left[again] = np.maximum(left[again] - margin, begin[again])
        right[again] = np.minimum(right[again] + margin, (end - lag)[again])
        todo = again
    return found


def _long_runs(ids: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Runs of periods over ``SHORT``, as ``_short_runs`` gives them."""
    found = []
    numbers = np.arange(len(counts))
    origin = np.cumsum(counts) - counts
    scale, size = 0, 1
    grams = ragged.mix(ids.astype(np.uint64) + np.uint64(1))
    while len(ids):
        scale, size = scale + 1, size * 2
        # texts too short for this scale's periods leave the arrays
        enough = counts >= EXPONENT * (size // 2 + 1)
        if not enough.all():
            keep = np.repeat(enough, counts)
            ids, grams = ids[keep], grams[keep]
            numbers, origin, counts = numbers[enough], origin[enough], counts[enough]
        if len(ids) < size:
            break
        half = size // 2
        # past its text's end a gram reads on into the next text, or past the last word; no window uses those
        grams = _mixed(grams, np.append(grams[half:], np.zeros(min(half, len(grams)), np.uint64)))
        if size <= SHORT:
            continue
        ends = np.cumsum(counts)
        text = np.repeat(np.arange(len(counts)), counts)
        at, lag = _seeds(grams, scale, text, ends[text])
        if not len(at):
            continue
        lo, hi, lag = _merged(at, lag, size)
        likely = hi - lo + 2 * half + lag >= EXPONENT * lag
        lo, hi, lag = lo[likely], hi[likely], lag[likely]
        whose = text[lo]
        for part in _extended(ids, lo, hi, lag, (ends - counts)[whose], ends[whose], half):
            candidate, begins, stops = part.T
            stops = stops + lag[candidate]
            keep = stops - begins >= EXPONENT * lag[candidate]
            candidate, begins, stops = candidate[keep], begins[keep], stops[keep]
            owner = whose[candidate]
            shift = origin[owner] - (ends - counts)[owner]
            found.append(np.stack([numbers[owner], begins + shift, stops + shift, lag[candidate]], axis=1))
    return found


def find_runs(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All runs of texts whose words, as numbers, stand one text after the other.

    Rows of text, start, end (in all words together) and period, by text, start and period.
    """
    text = np.repeat(np.arange(len(counts)), counts)
    rows = np.concatenate([np.zeros((0, 4), np.int64), *_short_runs(ids, text), *_long_runs(ids, counts)])
    # a run is found at multiples of its period too: the same stretch with a larger period goes
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = np.zeros(len(rows), bool)
    same[1:] = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)
    rows = rows[~same]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word; equal words, and no others, have equal ones."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    packed = data[np.cumsum(inside[:-1]).astype(bool)]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(packed))]
    )
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _edited(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place of a text that is made periodic; None if it is left alone."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> list[memoryview]:
    """Each text's words joined by one space."""
    sizes = ends - starts + 1
    inner = ragged.runs(sizes)
    at = np.repeat(starts, sizes) + inner
    np.minimum(at, len(data) - 1, out=at)
    joined = data[at] if len(data) else np.zeros(0, np.uint8)
    joined[np.cumsum(sizes) - 1] = 0x20
    stops = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
    view = memoryview(np.ascontiguousarray(joined))
    return [view[b : max(b, e - 1)] for b, e in zip(stops[:-1], stops[1:])]


def _searched(doc_ids: list[int | None], data, offsets, edit: bool):
    """Runs of the texts of one slice, relative to their text, the first row of each text's, and the collapsed texts."""
    starts, ends, before = ragged.find_words(data, offsets, _WORDS)
    counts = np.diff(before)
    if edit:
        for row, doc_id in enumerate(doc_ids):
            places = _edited(doc_id, int(counts[row]))
            if places is not None:
                part = slice(before[row], before[row + 1])
                starts[part], ends[part] = starts[part][places], ends[part][places]
    ids = _packed_ids(data, starts, ends) if edit else _word_ids(data, starts, ends)
    rows = find_runs(ids, counts)
    # a word goes if any run has it after its first period
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, rows[:, 1] + rows[:, 3], 1)
    np.add.at(cover, rows[:, 2], -1)
    kept = np.cumsum(cover[:-1]) == 0
    text = np.repeat(np.arange(len(counts)), counts)
    left = np.bincount(text[kept], minlength=len(counts))
    collapsed = _collapsed(data, starts[kept], ends[kept], left)
    rows[:, 1:3] -= before[rows[:, 0]][:, None]
    return rows, np.searchsorted(rows[:, 0], np.arange(len(counts) + 1)), collapsed


def _packed_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``_word_ids`` where a word may stand at several places."""
    order, back = np.unique(starts, return_inverse=True)
    stops = np.zeros(len(data) + 1, np.int64)
    stops[starts] = ends
    return _word_ids(data, order, stops[order])[back]


def _per_slice(batches: Iterator[pa.RecordBatch], edit: bool):
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        for row, data, offsets in ragged.text_slices(batch.column("text")):
            part = doc_ids[row : row + len(offsets) - 1]
            yield part, *_searched(part, data, offsets, edit)


def digests(docs: DataFrame, edit: bool = True) -> DataFrame:
    """Per document: number of runs, the longest one (ties: least start, then period), digests of all and of the rest.

    With ``edit``, one text in ten is made periodic first, as its id tells.
    """
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, rows, first, collapsed in _per_slice(batches, edit):
            out = []
            for i, doc_id in enumerate(doc_ids):
                told = hashlib.sha256(collapsed[i]).hexdigest()
                mine = [(int(s), int(e - s), int(q)) for _, s, e, q in rows[first[i] : first[i + 1]]]
                if not mine:
                    out.append((doc_id, 0, None, None, None, None, empty, told))
                    continue
                start, length, period = min(mine, key=lambda r: (-r[1], r[0], r[2]))
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in mine)
                out.append((
                    doc_id, len(mine), start, length, period, 1000 * length // period,
                    hashlib.sha256(listed.encode()).hexdigest(), told,
                ))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return ragged.map_in_arrow(docs.selectExpr("cast(doc_id as long) AS doc_id", "text"), run, SCHEMA)


def collapse(docs: DataFrame) -> DataFrame:
    """doc_id, the text without the repetitions of its runs (words joined by one space), and all runs."""
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, rows, first, collapsed in _per_slice(batches, False):
            listed = [
                [{"start": s, "length": e - s, "period": q} for _, s, e, q in rows[first[i] : first[i + 1]].tolist()]
                for i in range(len(doc_ids))
            ]
            texts = [bytes(c).decode() for c in collapsed]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(texts, pa.string()), pa.array(listed, pa.list_(struct))],
                ["doc_id", "collapsed", "runs"],
            )

    return ragged.map_in_arrow(docs.selectExpr("cast(doc_id as long) AS doc_id", "text"), run, RUNS_SCHEMA)
