"""Toxicity by non-negative positive-unlabelled learning.

Learns from confirmed toxic texts and from unlabelled ones, which hold toxic
texts too, in the share ``prior``.  The risk of a linear classifier is
prior * R+(toxic) + max(0, R-(unlabelled) - prior * R-(toxic)); where the second
term would fall below zero, the step goes the other way, so that a flexible
classifier does not overfit.  Several classifiers are trained in numpy on
different parts of the sample, and their scores are averaged.

A text's features are its distinct words, and whether one, two or more distinct
words have the same beginning (so inflected forms share evidence).  Weights are not negative: words are evidence for
toxicity, or none, and a long harmless text does not hide a toxic passage.

The sample is bounded (about ``LEARN_TOXIC`` and ``LEARN_UNLABELLED`` ids, chosen by a
hash, and one text of each, so that neither copies nor an id with very many texts
make it larger); counting its features is Spark's work, the driver gets the
vocabulary (``VOCABULARY`` at most) and the sample's few features in it.  Every
text is scored whole.

Defined results: a null or empty text has the score of a text without evidence;
without a single toxic example every score is ``prior`` (0 if unknown); repeated
rows keep their row; of an id with several texts the one with the least hash is
learned from; a null doc_id is scored and never
learned from; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.llm import ragged
from specloom.llm.decontaminate import WORDS, _Lookup
from specloom.session import cut_lineage

LEARN_TOXIC = 6_000
LEARN_UNLABELLED = 18_000
VOCABULARY = 100_000
#: Toxic texts of the sample in which a feature must occur.
LEAST_TEXTS = 3
PREFIXES = (4, 5, 6, 7, 8)
LEVELS = 3
MEMBERS = 4
STEPS = 250
RATE = 0.1
PENALTY = 2e-4


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Roots of all words of a slice, the text each belongs to, and the word's hash; repeats included.

    A word's roots are the word itself and those of its beginnings that are shorter.
    """
    data = ragged.fold(data)
    starts, ends, bounds = ragged.find_words(data, offsets, WORDS)
    sums = ragged.prefix_sums(data)
    own = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    words = ragged.run_hashes(sums, starts, ends)
    roots, texts, of = [words], [own], [words]
    for n in PREFIXES:
        longer = ends - starts > n
        roots.append(ragged.run_hashes(sums, starts[longer], starts[longer] + n) ^ np.uint64(0x5851F42D4C957F2D))
        texts.append(own[longer])
        of.append(words[longer])
    return np.concatenate(roots), np.concatenate(texts), np.concatenate(of)


def _levels(roots: np.ndarray, texts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, root and level: a text has level k of a root if at least k + 1 distinct words of it have that root."""
    order = np.lexsort((words, roots, texts))
    t, r, w = texts[order], roots[order], words[order]
    same = np.zeros(len(t), bool)
    same[1:] = (t[1:] == t[:-1]) & (r[1:] == r[:-1])
    fresh = ~same
    fresh[1:] |= w[1:] != w[:-1]
    t, r, same = t[fresh], r[fresh], same[fresh]
    begin = np.flatnonzero(~same)
    count = np.minimum(np.diff(np.append(begin, len(t))), LEVELS)
    return np.repeat(t[begin], count), np.repeat(r[begin], count), ragged.runs(count)


@dataclass
class Model:
    roots: np.ndarray  # sorted hashes
    weights: np.ndarray  # LEVELS rows per root, one column per member
    bias: np.ndarray
    prior: float

    def scores(self, texts: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        """Mean probability of ``n`` texts, from distinct pairs of text and row of the weights."""
        z = np.stack([np.bincount(texts, self.weights[features, m], n) for m in range(len(self.bias))], 1)
        return (1 / (1 + np.exp(-(z + self.bias)))).mean(axis=1)


def _found(lookup: _Lookup, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of text and row of the weights, of all roots that are known."""
    values, own, words = _features(data, offsets)
    at, where = lookup.find(values)
    texts, roots, level = _levels(where, own[at], words[at])
    return texts, roots * LEVELS + level


def fit(texts: np.ndarray, features: np.ndarray, toxic: np.ndarray, size: int, prior: float, seed: int = 0) -> tuple[
    np.ndarray, float
]:
    """Weights and bias of one classifier.  ``toxic`` says which texts are confirmed; the others are unlabelled."""
    n = len(toxic)
    rng = np.random.default_rng(seed)
    chosen = rng.random(n) < 0.8
    share = {True: max(1, int((toxic & chosen).sum())), False: max(1, int((~toxic & chosen).sum()))}
    positive = np.where(toxic & chosen, 1 / share[True], 0.0)
    unlabelled = np.where(~toxic & chosen, 1 / share[False], 0.0)
    w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(texts, w[features], n) + b
        p = 1 / (1 + np.exp(-z))
        soft = np.logaddexp(0, z)
        negative = float(unlabelled @ soft - prior * (positive @ soft))
        pull = unlabelled * p - prior * positive * p
        g = -prior * positive * (1 - p) + pull if negative >= 0 else -pull
        grad = np.append(np.bincount(features, g[texts], size) + PENALTY, g.sum())
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w = np.maximum(0, w - move[:-1])
        b -= float(move[-1])
    return w, b


def _drawn(share: float, *columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from texts (doc_id, text) and labels (doc_id, toxic) that may be learned from."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null")
    shares = known.filter("toxic is not null").agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    prior = min(0.5, float(shares or 0.0))
    bias = np.log(prior / (1 - prior)) if prior else -np.inf
    none = Model(np.zeros(0, np.uint64), np.zeros((0, 1)), np.array([bias]), prior)
    if prior == 0:
        return none
    texts = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    toxic_ids = known.filter("toxic = 1").select("doc_id").distinct()
    toxic_ids = toxic_ids.filter(_drawn(LEARN_TOXIC / max(1, toxic_ids.count()), "doc_id"))
    # an estimate, which only sets the rate of the sample
    ids = texts.agg(F.approx_count_distinct("doc_id", 0.02)).first()[0]
    # salted apart from the choice of toxic texts
    drawn = _drawn(LEARN_UNLABELLED / max(1, ids), "doc_id", F.lit("unlabelled"))
    # about LEARN_TOXIC ids at most, so they go to the texts and not the other way round
    flagged = F.broadcast(toxic_ids.withColumn("_toxic", F.lit(True)))
    marked = texts.join(flagged, "doc_id", "left").select(
        "doc_id", "text", F.col("_toxic").isNotNull().alias("toxic"), drawn.alias("drawn")
    ).filter("toxic or drawn").groupBy("doc_id", "toxic", "drawn").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    # a text that is both is an example twice, as the estimator asks for
    sample = cut_lineage(marked.select("text", F.explode(
        F.filter(F.array(F.when(F.col("toxic"), True), F.when(F.col("drawn"), False)), lambda x: x.isNotNull())
    ).alias("toxic")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for row, data, offsets in ragged.text_slices(batch.column("text"), 8 << 20):
                own, roots, level = _levels(*_features(data, offsets))
                distinct, place = np.unique(roots, return_inverse=True)
                feature, n = place * LEVELS + level, len(distinct) * LEVELS
                is_toxic = marks[row + own]
                toxic = np.bincount(feature, is_toxic, n).astype(np.int64)
                other = np.bincount(feature, ~is_toxic, n).astype(np.int64)
                seen = np.flatnonzero(toxic + other)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(distinct.view(np.int64)[seen // LEVELS]), pa.array((seen % LEVELS).astype(np.int32)),
                        pa.array(toxic[seen]), pa.array(other[seen]),
                    ],
                    ["f", "level", "toxic", "other"],
                )

    counted = ragged.map_in_arrow(sample, count, "f long, level int, toxic long, other long")
    sums = counted.groupBy("f", "level").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(True):
        return none
    # a weight that may not be negative only serves features more frequent in toxic texts
    lift = (F.col("toxic") / sizes[True]) / ((F.col("other") + 1) / max(1, sizes.get(False, 0)))
    vocabulary = sums.filter((F.col("toxic") >= LEAST_TEXTS) & (lift > 1.5)).orderBy(
        F.desc(lift), F.desc("toxic"), "f", "level"
    ).limit(VOCABULARY).select("f", "level").toArrow()
    if not vocabulary.num_rows:
        return none
    hashes, place = np.unique(vocabulary.column("f").to_numpy().view(np.uint64), return_inverse=True)
    allowed = np.zeros(len(hashes) * LEVELS, bool)
    allowed[place * LEVELS + vocabulary.column("level").to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(hashes)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(shared.value)
        for batch in batches:
            for row, data, offsets in ragged.text_slices(batch.column("text")):
                found = [[] for _ in range(len(offsets) - 1)]
                own, feature = _found(lookup, data, offsets)
                for t, f in zip(own.tolist(), feature.tolist()):
                    if allowed[f]:
                        found[t].append(f)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic").slice(row, len(found)), pa.array(found, pa.list_(pa.int32()))], ["toxic", "fs"]
                )

    # at most the sample's rows; sorted, so that training sees the same order each time
    rows = ragged.map_in_arrow(sample, pick, "toxic boolean, fs array<int>").toArrow()
    examples = sorted(zip(rows.column("toxic").to_pylist(), rows.column("fs").to_pylist()))
    toxic = np.array([mark for mark, _ in examples], bool)
    own = np.repeat(np.arange(len(toxic)), [len(fs) for _, fs in examples])
    features = np.array([f for _, fs in examples for f in fs], np.int64)
    members = [fit(own, features, toxic, len(allowed), prior, seed) for seed in range(MEMBERS)]
    weights, bias = np.stack([w for w, _ in members], 1), np.array([b for _, b in members])
    used = weights.reshape(len(hashes), -1).any(axis=1)
    return Model(hashes[used], weights[np.repeat(used, LEVELS)], bias, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted (1 from 0.5 on) of every whole text."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_model = shared.value
        lookup = _Lookup(own_model.roots)
        for batch in batches:
            for row, data, offsets in ragged.text_slices(batch.column("text")):
                n = len(offsets) - 1
                scores = own_model.scores(*_found(lookup, data, offsets), n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, n), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    return ragged.map_in_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double, predicted int")
