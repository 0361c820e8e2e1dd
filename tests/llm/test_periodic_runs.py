import hashlib
import random
import re
import zlib

import numpy as np
from helpers import SCHEMA, empty, odd, prose, same_rows

from specloom.llm import periodic_runs as pr

EMPTY = hashlib.sha256(b"").hexdigest()


def runs_of(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        k = 0
        while k < len(words) - q:
            j = k
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > k and j + q - k >= max(6, 4 * q):
                found.setdefault((k, j + q - k), q)
            k = max(j, k + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_force(doc_id, text, edit=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if edit and doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_of(words)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    return (
        doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def random_text(rng):
    words = []
    for _ in range(rng.randrange(6)):
        letters = rng.choice([2, 3, 40])
        if rng.random() < 0.4:
            words += [f"v{rng.randrange(letters)}" for _ in range(rng.randrange(60))]
        else:
            period = [f"é{rng.randrange(letters)}" for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 31, 32, 33, 64, 65, 90]))]
            words += (period * 7)[: int(len(period) * rng.uniform(2, 7))]
    return "".join(w + rng.choice([" ", "\n", " \t "]) for w in words)


def table(spark, texts):
    return spark.createDataFrame([(100 + i, t, "", "", 0, "", 0, 0) for i, t in enumerate(texts)], SCHEMA)


def test_digests_against_brute_force(spark):
    rng = random.Random(3)
    # the long prose of the odd rows is left to the test of long texts
    docs = odd(spark).filter("doc_id is null or doc_id != 6").union(
        table(spark, [*[random_text(rng) for _ in range(400)], *[prose(i, i) for i in range(1, 200)]])
    )
    found = pr.digests(docs).collect()
    expected = [brute_force(r.doc_id, r.text) for r in docs.collect()]
    assert same_rows(found) == same_rows(expected)
    assert sum(e[1] > 0 for e in expected) > 100


def test_collapse_keeps_the_first_period(spark):
    rng = random.Random(4)
    docs = table(spark, ["a b " * 9 + "c", "x " * 6, "x " * 5, None, *[random_text(rng) for _ in range(50)]])
    for row, source in zip(pr.collapse(docs).orderBy("doc_id").collect(), docs.orderBy("doc_id").collect()):
        told = brute_force(source.doc_id, source.text, edit=False)
        assert hashlib.sha256(row.collapsed.encode()).hexdigest() == told[-1]
        assert len(row.runs) == told[1]
    first = pr.collapse(docs).orderBy("doc_id").first()
    assert (first.collapsed, [tuple(r) for r in first.runs]) == ("a b c", [(0, 18, 2)])


def test_runs_of_all_periods_and_places():
    for period in [*range(1, 40), 63, 64, 65, 127, 128, 129, 255, 257, 700]:
        for extra in (0, 1, period - 1):
            length = max(6, 4 * period + extra)
            body = [i % period for i in range(length)]
            words = np.array([-1, -2, -3, *body, -4, -5, *body[: 4 * period - 1]][: 5 + length], np.int64)
            assert pr.find_runs(words, np.array([len(words)])).tolist() == [[0, 3, 3 + length, period]]


def test_hard_words():
    fibonacci, last = [0, 1], [0]
    while len(fibonacci) < 100_000:
        last, fibonacci = fibonacci, fibonacci + last
    assert len(pr.find_runs(np.array(fibonacci), np.array([len(fibonacci)]))) == 0
    thue_morse = [bin(i).count("1") % 2 for i in range(1 << 12)] * 8
    assert pr.find_runs(np.array(thue_morse), np.array([len(thue_morse)])).tolist() == [[0, 0, len(thue_morse), 4096]]
    once = np.zeros(200_000, np.int64)
    assert pr.find_runs(once, np.array([len(once)])).tolist() == [[0, 0, len(once), 1]]


def test_long_text(spark):
    text = prose(1, 60_000, 5000) + " z " + "one two three " * 50_000
    found = pr.digests(table(spark, [text]), edit=False).first()
    assert (found.n_runs, found.start, found.length, found.period, found.exponent_milli) == (1, 60_001, 150_000, 3, 50_000_000)


def test_empty_table(spark):
    assert pr.digests(empty(spark)).collect() == [] and pr.collapse(empty(spark)).collect() == []
