import hashlib
import re
import time

import pytest
from helpers import SCHEMA, empty, odd, prose, same_rows

from specloom.llm import personal_data as pd

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in found.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def base_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items() for m in re.finditer(pattern, text or "") if passes(kind, m.group())
    ]


def brute_force(doc_id, text):
    spans = base_spans(text)
    listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    return (doc_id, *[sum(k == kind for k, _, _ in spans) for kind in PATTERNS], hashlib.sha256(listed.encode()).hexdigest())


BASE = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
EDGES = [
    "a@b.c@d.e", "a@b.c_x@d.e f", "a@b.c.@d.e", "@b.c", "a@b", "a@b.c-", "%@-.-", "é x@y.zz é", "1.2.3.4.5.6.7.8", "256.1.1.1",
    "0255.1.1.1", "1.2.3", "1.2.3.4.", "99.1.2.3.4", "4111111111111111", "4111 1111-1111 1111", "4111  1111 1111 1111",
    "4111111111111111 4111111111111111", "41111111111111110000", "0000000000000000", "+1 (499) 555-6503", "+12345678)", "+1234567",
    "+1+12345678", "+1234567890123456", "+1 2 3 4 5 6 7 8 and +1.2.3.4.5.6.7.8", "x@1.2.3.4", "1.2.3.4@5.6.7.8", "\U0001f600 a@b.cc \U0001f600",
]


def table(spark, texts):
    return spark.createDataFrame([(50 + i, t, "", "", 0, "", 0, 0) for i, t in enumerate(texts)], SCHEMA)


def test_base_spans_against_brute_force(spark):
    docs = odd(spark).union(table(spark, [*EDGES, " ".join(EDGES), "\n".join(EDGES) * 30]))
    found = pd.digests(pd.find_spans(docs)).select(*BASE).collect()
    assert same_rows(found) == same_rows(brute_force(r.doc_id, r.text) for r in docs.collect())


def test_random_texts(spark):
    import random

    rng = random.Random(5)
    texts = ["".join(rng.choice("a@.1+- 9(é_") for _ in range(rng.randrange(200))) for _ in range(400)]
    docs = table(spark, texts)
    found = pd.digests(pd.find_spans(docs)).select(*BASE).collect()
    assert same_rows(found) == same_rows(brute_force(r.doc_id, r.text) for r in docs.collect())


@pytest.mark.parametrize("text, counts", [
    ("a" * 300_000, [0, 0, 0, 0]), ("1" * 300_000, [0, 0, 0, 0]), ("1 " * 150_000, [0, 0, 0, 0]),
    ("a@" + "b." * 150_000, [1, 0, 0, 0]), ("1." * 150_000, [0, 37_500, 0, 0]), ("+1" * 150_000, [0, 0, 0, 0]),
    ("+" + "1 (" * 100_000, [0, 0, 0, 0]), ("4111111111111111, " * 20_000, [0, 0, 20_000, 0]),
    ("a@b.cc " * 30_000, [30_000, 0, 0, 0]), ("AB12" * 70_000, [0, 0, 0, 0]), ("DE89 " * 60_000, [0, 0, 0, 0]),
])
def test_long_texts_take_time_in_proportion(spark, text, counts):
    begin = time.time()
    found = pd.digests(pd.find_spans(table(spark, [text]))).first()
    assert [found.n_email, found.n_ip, found.n_card, found.n_phone] == counts
    assert time.time() - begin < 20


ADDED = {
    "pay to DE89 3704 0044 0532 0130 00 now": [("iban", "DE89 3704 0044 0532 0130 00", 0.8)],
    "IBAN: GB82WEST12345698765432.": [("iban", "GB82WEST12345698765432", 1.0)],
    "DE88 3704 0044 0532 0130 00": [], "XDE89370400440532013000": [],
    "call 555-123-4567 today": [("phone", "555-123-4567", 0.7)], "order 555-123-4567 today": [],
    "phone +1 (499) 555-6503": [],
    "SSN 123-45-6789": [("ssn", "123-45-6789", 0.7)], "SSN 000-45-6789, ssn 923-45-6789": [],
    "amex card 378282246310005": [("card", "378282246310005", 0.7)],
    "number 378282246310005": [], "card 378282246310006": [],
}


def test_checksums_and_context_decide_on_added_spans(spark):
    rows = pd.find_spans(table(spark, list(ADDED))).orderBy("doc_id").collect()
    for row, (text, expected) in zip(rows, ADDED.items()):
        assert [(s.kind, text[s.start : s.end], s.score) for s in row.spans if not s.base] == expected


def test_base_spans_stay_whatever_their_score(spark):
    text = "x 4111111111111111 " + prose(1, 30) + " card 4111111111111111"
    spans = pd.find_spans(table(spark, [text])).collect()[0].spans
    assert [(s.kind, s.score) for s in spans] == [("card", 0.8), ("card", 1.0)]
    strict = tuple(r for r in pd.RULES if r.kind == "iban")
    assert pd.find_spans(table(spark, [text]), strict).collect()[0].spans == []


def test_no_python_and_no_shuffle(spark):
    plan = pd.digests(pd.find_spans(odd(spark)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_empty_table(spark):
    assert pd.digests(pd.find_spans(empty(spark))).collect() == []
