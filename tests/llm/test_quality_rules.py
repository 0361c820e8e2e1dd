import re
from collections import Counter

from helpers import SCHEMA, empty, odd, prose, same_rows

from specloom.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(doc_id, text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {p for i, w in enumerate(windows) if times[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        doc_id, len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(repeated), len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )


BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_against_brute_force(spark):
    texts = ["a b c a b c a", "x y z\nx y z\n\n \nx y z", "aa aa aa aa", "# * $ % & | < >", prose(3, 90, 8), prose(4, 300, 20)]
    docs = odd(spark).union(spark.createDataFrame([(50 + i, t, "", "", 0, "", 0, 0) for i, t in enumerate(texts)], SCHEMA))
    found = rules.judge(docs).select(*BASE).collect()
    assert same_rows(found) == same_rows(brute_force(r.doc_id, r.text) for r in docs.collect())


def test_thresholds_decide_beyond_the_base(spark):
    good = "The man and the dog went to the park and they saw of it all that is there for them to see in a day. "
    rows = [
        (1, good + prose(1, 60)), (2, prose(1, 90)), (3, " ".join(f"{w}###" for w in (good + prose(1, 60)).split())),
        (4, None), (5, "\n".join(f"the line of text {i} and more to read..." for i in range(30))),
    ]
    found = {r.doc_id: r.kept for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: True, 2: False, 3: False, 4: False, 5: False}
    loose = rules.judge(spark.createDataFrame(rows, "doc_id long, text string"), thresholds=())
    assert {r.doc_id for r in loose.filter("kept").collect()} == {1, 2, 3}


def test_no_python_and_no_shuffle(spark):
    plan = rules.judge(odd(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_empty_table(spark):
    assert rules.judge(empty(spark)).collect() == []
