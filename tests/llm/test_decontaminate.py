import re

import pytest
from helpers import SCHEMA, empty, odd, prose, same_rows

from specloom.llm import decontaminate

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def brute_force(docs, items):
    windows = {}
    for item_id, text in items:
        found = words(text)
        n = min(10, len(found))
        for i in range(len(found) - n + 1 if n else 0):
            windows.setdefault(tuple(found[i : i + n]), set()).update([] if item_id is None else [str(item_id)])
    out = []
    for doc_id, text in docs:
        own, hit, ids = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[tuple(own[i : i + n])]
        out.append((doc_id, len(own), len(hit), len(ids), decontaminate.sha256_of(list(ids)), bool(hit)))
    return out


def compare(spark, docs, items, **settings):
    found = decontaminate.find_contamination(
        docs, spark.createDataFrame(items, "item_id long, text string"), **settings
    ).drop("items")
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert same_rows(found.collect()) == same_rows(brute_force(rows, items))


ITEMS = [
    (1, prose(2, 30)), (2, prose(2, 80).split(" ", 20)[-1]), (3, "one"), (4, "Lost, ID!"), (4, "lost id"), (5, None),
    (6, "..."), (None, "les mots"), (12, prose(50, 12)), (100, prose(50, 12)),
]


@pytest.mark.parametrize("bits", [None, 6])
def test_odd_rows(spark, bits):
    compare(spark, odd(spark), ITEMS, bits=bits)


@pytest.mark.parametrize("bits", [None, 8])
def test_passages_overlapping_and_repeated(spark, bits):
    item = prose(70, 40, 30).split()
    texts = [
        " ".join(item), " ".join(item[3:13]), " ".join(item[3:12]), " - ".join(item[5:20] + ["x"] + item[5:20]).upper(),
        prose(71, 200, 30), " ".join(item[:9] + ["y"] + item[10:]), " ".join(item[-10:]),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 1, 1) for i, t in enumerate(texts)], SCHEMA)
    compare(spark, docs, [(1, " ".join(item)), (2, " ".join(item[10:25])), (3, prose(72, 40, 30))], bits=bits)


def test_empty_tables(spark):
    compare(spark, odd(spark), [])
    compare(spark, empty(spark), ITEMS)
