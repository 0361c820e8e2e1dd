import math
from collections import Counter

import numpy as np
from helpers import empty, odd

from specloom.llm import language_id

TEXTS = {
    "en": "the man and the dog went out to the park with that old friend of theirs",
    "fr": "le chien et les amis sont allés dans la forêt avec une très vieille dame",
    "de": "der hund und die freunde sind mit einer alten frau in den wald gegangen für",
}


def training(spark):
    rows = [(w, lang) for lang, text in TEXTS.items() for w in (text, " ".join(reversed(text.split())))]
    return spark.createDataFrame([*rows, (None, "en"), ("unknown words", None), ("", "xx")], "text string, lang string")


def buckets(text):
    raw = "".join(c.lower() if c.isalpha() else " " for c in text)
    for n in language_id.ORDERS:
        for i in range(len(raw)):
            code = 0
            for c in raw[i : i + n].ljust(n, "\0"):
                code = (code * 0x01000193 + ord(c)) & 0xFFFFFFFF
            h = (code * 0x9E3779B1 + (n * 0x85EBCA6B & 0xFFFFFFFF)) & 0xFFFFFFFF
            h = (h ^ h >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
            yield (h ^ h >> 16) & language_id.BUCKETS - 1


def test_scores_against_a_plain_version(spark):
    langs, matrix, prior = language_id.train(training(spark))
    assert np.allclose(np.exp(prior), 1 / 3)
    assert langs == ["de", "en", "fr"]  # a language without a single n-gram is not learned
    counts = {lang: Counter() for lang in langs}
    for row in training(spark).collect():
        if row.lang in counts and row.text:
            counts[row.lang].update(buckets(row.text))
    size = {lang: sum(c.values()) + language_id.SMOOTHING * language_id.BUCKETS for lang, c in counts.items()}
    for row in language_id.identify(odd(spark), langs, matrix, prior).join(odd(spark).select("doc_id", "text"), "doc_id").collect():
        text = row.text or ""
        if row.doc_id == 7 or len(text) > 1000:
            continue
        if not any(c.isalpha() for c in text):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        sums = [
            sum(math.log((counts[lang][b] + language_id.SMOOTHING) / size[lang]) for b in buckets(text)) for lang in langs
        ]
        share = np.exp((np.array(sums) - max(sums)) / len(language_id.ORDERS) + prior)
        assert row.lang_pred == langs[int(share.argmax())]
        assert abs(row.score - share.max() / share.sum()) < 1e-3


def test_every_row_is_kept_and_case_does_not_matter(spark):
    model = language_id.train(training(spark))
    assert language_id.identify(odd(spark), *model).count() == odd(spark).count()
    rows = spark.createDataFrame([(1, TEXTS["fr"].upper()), (2, TEXTS["de"])], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(rows, *model).collect()} == {1: "fr", 2: "de"}


def test_nothing_to_learn_and_nothing_to_score(spark):
    model = language_id.train(empty(spark))
    assert {r.lang_pred for r in language_id.identify(odd(spark), *model).collect()} == {"und"}
    assert language_id.identify(empty(spark), *language_id.train(training(spark))).collect() == []


def test_characters_against_a_plain_version():
    texts = ["", "Straße — ÉTÉ, 漢字!", "\U00010400\U0001F600 हिन्दी", "a" * 50, "É"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    found, ends = language_id.characters(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert ends.tolist() == np.cumsum([0, *map(len, texts)]).tolist()
    import unicodedata

    want = "".join(c.lower() if c.isalpha() or unicodedata.category(c)[0] == "M" else " " for t in texts for c in t)
    assert "".join(map(chr, found)) == want
    language_id.characters(np.frombuffer(bytes(range(256)), np.uint8), np.array([0, 200, 256]))


def test_small_languages_are_learned_beside_large_ones(spark, monkeypatch):
    """Each language has its own bound; a text in a third of the rows counts once and does not take the others' place."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(language_id, "LEARN_TEXTS", 200)
    large = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("the same words again")).otherwise(F.concat(F.lit("the old man "), "id")).alias("text"),
        F.lit("en").alias("lang"),
    )
    small = spark.createDataFrame([(f"der alte mann {'x' * i}", "de") for i in range(20)], "text string, lang string")
    rows, texts = language_id.chosen(large.union(small))
    found = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert texts == {"en": 60_000, "de": 20} and found["de"] == 20 and 120 <= found["en"] <= 300
    langs, matrix, prior = language_id.train(large.union(small))
    assert langs == ["de", "en"] and prior[0] < prior[1]
    asked = spark.createDataFrame([(1, "der alte mann geht"), (2, "the old man went")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(asked, langs, matrix, prior).collect()} == {1: "de", 2: "en"}


def test_any_number_of_languages(spark):
    rows = [(f"{chr(0x4E00 + i) * 3} {chr(0x5E00 + i)}", f"l{i:03}") for i in range(300)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    langs, matrix, prior = language_id.train(labelled)
    assert len(langs) == 300 and matrix.size <= language_id.CELLS
    asked = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    found = language_id.identify(asked, langs, matrix, prior).collect()
    assert all(r.lang_pred == f"l{r.doc_id:03}" for r in found)


def test_held_out_accuracy(spark):
    from specloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = QUERIES["op8_language_id"](spark, sf_dir).filter("held_out").collect()
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held) > 0
