import hashlib

import pytest
from helpers import SCHEMA, empty, odd

from specloom.llm import licenses
from specloom.oracle import connect, differences

MIT = dict(reversed(licenses.KNOWN_TEXTS))["MIT"]
BSD = next(t for name, t in licenses.KNOWN_TEXTS if name == "BSD-3-Clause")


def ids(spark, texts, known=None):
    docs = spark.createDataFrame([(i, t, "", "", 0, "", 0, 0) for i, t in enumerate(texts)], SCHEMA)
    return [r.license_id for r in licenses.scan(docs, known).orderBy("doc_id").collect()]


def test_variants_of_one_text_are_the_same_licence(spark):
    variants = [
        MIT, MIT.upper(), "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + MIT, "# " + MIT.replace("\n", "\n# "),
        "© 1999 Ünal\n(c) 2001 X\n" + MIT.replace('"', "“"), BSD.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "),
        MIT.replace("sublicense", "sub-licence"),
    ]
    assert ids(spark, variants) == ["MIT"] * 5 + ["BSD-3-Clause", "MIT"]


def test_other_texts_are_none(spark):
    assert ids(spark, [MIT + " And more.", MIT[:-200], "MIT", None, "", "...", "Copyright (c) 2020 X"]) == [None] * 7


def test_own_table_of_known_digests(spark):
    text = spark.createDataFrame([("the words",), ("",), (None,)], "t string").select(licenses.digest("t").alias("digest"))
    known = text.selectExpr("digest", "'own' AS license_id").union(text.selectExpr("digest", "'also' AS license_id"))
    assert ids(spark, ["The, Words!", "the word", ""], known) == ["also", None, None]
    assert ids(spark, [MIT], known.limit(0)) == [None]


def test_odd_rows_and_empty_table(spark):
    found = licenses.scan(odd(spark)).collect()
    assert len(found) == odd(spark).count()
    assert {r.digest for r in found if r.doc_id in (1, 2, 3)} == {hashlib.sha256(b"").hexdigest()}
    assert licenses.scan(empty(spark)).collect() == []


def test_sql_agrees_on_odd_rows(spark, tmp_path):
    docs = odd(spark).union(spark.createDataFrame([(90, MIT, "", "", 0, "", 0, 0), (91, "© 2020 x\nhello", "", "", 0, "", 0, 0)], SCHEMA))
    con = connect("/root/testdata/sf0.001")
    con.register("odd", docs.toArrow())
    con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM odd")
    assert differences(licenses.scan(docs), con, licenses.oracle()) == []


@pytest.mark.parametrize("word", ["Python", "Arrow", "Pandas"])
def test_built_in_functions_only(spark, word):
    assert word not in licenses.scan(odd(spark))._jdf.queryExecution().executedPlan().toString()
