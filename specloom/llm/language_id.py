"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are code points: letters and the marks on them in lower case, all else
is space.  Counts of n-grams per language are summed up by Spark, the matrix of log
probabilities (one column per language) goes to all tasks, and numpy adds up the
rows of each text's n-grams and the languages' log shares of all labelled texts.

Each language is learned from ``LEARN_TEXTS`` distinct texts of its own, about, so a
language of few texts is learned from all of them however many others there are.
Any number of languages is learned: the matrix has ``CELLS`` cells at most, so beyond
``CELLS`` / ``BUCKETS`` languages n-grams share fewer buckets.

Defined results: a null text or a text without a letter is ``und`` with score 0;
a table without a single labelled text makes every text ``und``; ties go to the
language that sorts first; repeated rows each get their own row, but are learned
from once; very long texts are scored whole, one at a time; further columns of the
input are not looked at.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.llm import ragged

#: Rows of the matrix, as long as it has no more cells; n-gram lengths in characters; smoothing of counts.
BUCKETS = 1 << 16
CELLS = 1 << 24
ORDERS = (1, 2, 3, 4)
SMOOTHING = 0.5
#: Distinct labelled texts to learn from per language, about: more are thinned out by a hash of the text.
LEARN_TEXTS = 5_000
UNKNOWN = "und"


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


@functools.cache
def _letters() -> np.ndarray:
    """Every code point's lower case if it is a letter or a mark on one, else a space."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(len(table)):
        char = chr(code)
        if char.isalpha() or unicodedata.category(char).startswith("M"):
            table[code] = ord(char.lower()[0])
    return table


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The folded code points of UTF-8 texts and their offsets; bytes that are no UTF-8 give some code point."""
    if not len(data) or data.max() < 128:
        return _letters()[data], offsets
    at = np.flatnonzero((data & 0xC0) != 0x80)
    ahead = np.zeros((4, len(at)), np.uint32)
    for i in range(4):
        inside = at + i < len(data)
        ahead[i, inside] = data[at[inside] + i]
    a, (b, c, d) = ahead[0], ahead[1:] & np.uint32(0x3F)
    code = np.select(
        [a < 0x80, a < 0xE0, a < 0xF0],
        [a, (a & 0x1F) << 6 | b, (a & 0x0F) << 12 | b << 6 | c], (a & 0x07) << 18 | b << 12 | c << 6 | d,
    )
    return _letters()[np.minimum(code, 0x10FFFF)], np.searchsorted(at, offsets)


def _features(letters: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """For each n-gram length, the bucket at each character; beyond the text's end stand zeros."""
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(letters))
    code = np.zeros(len(letters), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        ahead = np.zeros(len(letters), np.uint32)
        ahead[: max(0, len(letters) - n + 1)] = letters[n - 1 :]
        code = code * np.uint32(0x01000193) + np.where(left >= n, ahead, np.uint32(0))
        if n in ORDERS:
            h = code * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            yield ((h ^ (h >> np.uint32(16))) & np.uint32(buckets - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        for row, data, offsets in ragged.text_slices(batch.column("text")):
            letters, offsets = characters(data, offsets)
            shift = np.repeat(codes[row : row + len(offsets) - 1].astype(np.int64) * buckets, np.diff(offsets))
            sums = np.zeros(len(names) * buckets, np.int64)
            for places in _features(letters, offsets, buckets):
                sums += np.bincount(shift + places, minlength=len(sums))
            for lang, own in zip(names, sums.reshape(-1, buckets)):
                counts[lang] = counts.get(lang, 0) + own
    for lang, sums in counts.items():
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(sums[used], pa.int64())],
            ["lang", "bucket", "n"],
        )


def chosen(labelled: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Distinct rows (text, lang) to learn from, and the number of labelled texts of each language."""
    rows = labelled.select("text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row per language; the estimate of distinct texts only sets the rate of the sample
    found = rows.groupBy("lang").agg(
        F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("texts")
    ).collect()
    rates = [(r.lang, int(min(1.0, LEARN_TEXTS / max(1, r.texts)) * (1 << 30))) for r in found]
    table = F.broadcast(labelled.sparkSession.createDataFrame(rates, "lang string, _rate long"))
    drawn = rows.join(table, "lang").filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.col("_rate"))
    return drawn.select("text", "lang").distinct(), {r.lang: r.n for r in found}


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log probabilities of n-grams and of languages, from the columns ``text`` and ``lang``."""
    rows, texts = chosen(labelled)
    buckets = BUCKETS
    while buckets > 1 and buckets * len(texts) > CELLS:
        buckets //= 2
    counts = ragged.map_in_arrow(
        rows, lambda batches: _count(batches, buckets), "lang string, bucket long, n long"
    ).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # at most CELLS rows, whatever the input
    table = counts.toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    sums = np.full((buckets, max(1, len(langs))), SMOOTHING)
    prior = np.zeros(max(1, len(langs)))
    if langs:
        prior = np.log(np.array([texts[x] + 1 for x in langs]) / (sum(texts[x] for x in langs) + len(langs)))
        places = {lang: i for i, lang in enumerate(langs)}
        columns = np.array([places[x] for x in table.column("lang").to_pylist()])
        np.add.at(sums, (table.column("bucket").to_numpy(), columns), table.column("n").to_numpy())
    return langs, np.log(sums / sums.sum(axis=0)).astype(np.float32), prior


def identify(docs: DataFrame, langs: list[str], matrix: np.ndarray, prior: np.ndarray) -> DataFrame:
    """doc_id, lang_pred and score (the winner's share of the posterior) of every whole text.

    The posterior is taken per n-gram length unit: the log odds are divided by
    the number of lengths, since n-grams of all lengths repeat the same characters.
    """
    model = docs.sparkSession.sparkContext.broadcast(matrix)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.ascontiguousarray(model.value)
        names = pa.array([*langs, UNKNOWN], pa.string())
        for batch in batches:
            n = batch.num_rows
            total = np.zeros((n, weights.shape[1]))
            for row, data, offsets in ragged.text_slices(batch.column("text")):
                letters, offsets = characters(data, offsets)
                full = np.flatnonzero(np.diff(offsets))
                if not len(full):
                    continue
                for buckets in _features(letters, offsets, len(weights)):
                    for lang in range(weights.shape[1]):
                        total[row + full, lang] += np.add.reduceat(
                            weights[:, lang][buckets], offsets[full], dtype=np.float64
                        )
            total = total / len(ORDERS) + prior
            share = np.exp(total - total.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            letter = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            known = letter & bool(langs)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    names.take(pa.array(np.where(known, best, len(langs)))),
                    pa.array(np.where(known, share[np.arange(n), best], 0.0), pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    kind = dict(docs.dtypes)["doc_id"]
    return ragged.map_in_arrow(rows, score, f"doc_id {kind}, lang_pred string, score double")
