import zlib

import numpy as np
from helpers import SCHEMA, empty, odd, prose

from specloom.llm import toxicity
from specloom.llm.queries import QUERIES


def corpus(spark):
    """Two bad words and a bad beginning, one or more in every toxic text."""
    rows, labels = [], []
    for i in range(600):
        words = prose(i, 60).split()
        toxic = i % 8 == 0
        if toxic:
            words[i % 50] = ["nasty", "awful", f"vilex{i % 9}"][i // 8 % 3]
            words[i % 50 + 5] = f"vilex{i % 7}"
        rows.append((i, " ".join(words), "en", "s", 1, "x", 1, 1))
        if i % 3 == 0:
            labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_from_few_labels(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs.filter("doc_id < 450"), labels.filter("doc_id < 450"))
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [r for i, r in found.items() if i >= 450]
    assert sum(r.predicted == (r.doc_id % 8 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)


def test_scores_against_a_plain_version(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels)
    seen = {int(h): i for i, h in enumerate(model.roots)}
    rows = docs.limit(40).collect()
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for row in rows:
        raw = np.frombuffer(row.text.encode(), np.uint8)
        roots, _, words = toxicity._features(raw, np.array([0, len(raw)]))
        of = {}
        for root, word in zip(roots.tolist(), words.tolist()):
            if root in seen:
                of.setdefault(root, set()).add(word)
        z = np.zeros(len(model.bias)) + model.bias
        for root, distinct in of.items():
            at = seen[root] * toxicity.LEVELS
            z += model.weights[at : at + min(len(distinct), toxicity.LEVELS)].sum(axis=0)
        assert abs(found[row.doc_id] - (1 / (1 + np.exp(-z))).mean()) < 1e-9


def test_risk_stays_above_zero():
    """Texts 0-9 are confirmed and share feature 0; of the unlabelled 10-99 a tenth have it."""
    toxic = np.arange(100) < 10
    texts = np.array([*range(10), *range(10, 19), *range(20, 100)])
    features = np.array([0] * 19 + [1] * 80)
    w, b = toxicity.fit(texts, features, toxic, 2, 0.1)
    assert w[0] + b > 0 > b and w[1] == 0


def test_odd_rows_and_empty_tables(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels)
    found = toxicity.score(odd(spark), model)
    assert found.count() == odd(spark).count()
    plain = {r.score for r in found.collect() if r.doc_id in (1, 2, 3)}
    assert len(plain) == 1 and plain.pop() < 0.5
    assert toxicity.score(empty(spark), model).collect() == []
    none = toxicity.train(docs, labels.filter("toxic = 0"))
    assert {r.predicted for r in toxicity.score(odd(spark), none).collect()} == {0}
    assert {r.predicted for r in toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()} == {0}
    odd_labels = spark.createDataFrame([(None, 1, 1), (0, 1, 1), (0, 1, 1), (1, None, None)], labels.schema)
    assert toxicity.score(docs, toxicity.train(docs, odd_labels)).count() == 600


def test_without_examples_the_score_is_the_prior(spark):
    docs, labels = corpus(spark)
    none = toxicity.score(docs, toxicity.train(docs, labels.filter("toxic = 0"))).collect()
    assert {r.score for r in none} == {0.0}
    away = labels.selectExpr("CASE WHEN toxic = 1 THEN doc_id + 100000 ELSE doc_id END doc_id", "quality", "toxic")
    share = labels.filter("toxic = 1").count() / labels.count()
    found = toxicity.score(docs, toxicity.train(docs, away)).collect()
    assert all(abs(r.score - share) < 1e-9 for r in found)


def test_the_sample_is_bounded_when_an_id_or_a_text_has_a_third_of_the_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    docs, labels = corpus(spark)
    monkeypatch.setattr(toxicity, "LEARN_TOXIC", 50)
    monkeypatch.setattr(toxicity, "LEARN_UNLABELLED", 400)
    more = spark.range(40_000).select(F.lit(0).alias("doc_id"), F.concat(F.lit("nasty words of "), "id").alias("text"))
    same = spark.range(40_000).select(F.lit(24).alias("doc_id"), F.lit("awful words").alias("text"))
    sizes, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda texts, features, toxic, *a: sizes.append(len(toxic)) or fit(texts, features, toxic, *a))
    rows = docs.select("doc_id", "text").union(more).union(same)
    found = toxicity.score(rows, toxicity.train(rows, labels))
    assert found.count() == 80_600 and len(sizes) == toxicity.MEMBERS and 300 <= max(sizes) <= 550
    rest = {r.doc_id: r.predicted for r in found.filter("doc_id not in (0, 24)").collect()}
    assert sum(p == (i % 8 == 0) for i, p in rest.items()) >= 0.9 * len(rest)


def test_query_learns_nothing_from_held_out_labels(spark, tmp_path):
    docs, labels = corpus(spark)
    found = []
    for name, changed in (("a", labels), ("b", labels.selectExpr(
        "doc_id", "quality", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END toxic"
    ))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        changed.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        rows = QUERIES["op2_toxicity"](spark, f"{tmp_path}/{name}").collect()
        found.append(sorted((r.doc_id, r.held_out, r.predicted) for r in rows))
    assert found[0] == found[1]
    assert all(held == (zlib.crc32(str(i).encode()) % 5 == 0) for i, held, _ in found[0])
