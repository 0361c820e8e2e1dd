"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is a built-in function; nothing is shuffled, and a row needs memory
for its own words only.  ``THRESHOLDS`` says which measure must lie between
which bounds; a text is kept if it passes the base rule and all of them.

Words are runs of characters other than the six ASCII white spaces.  Windows of
three words are compared by 64-bit hashes within one text.

Defined results: a null text is like an empty one: no words, all counts 0, fails
the base rule, is not kept; repeated rows keep their row; a null doc_id stays
null; further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Frequent words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "a", "in", "that", "have", "with", "is", "it", "for", "on", "was", "as", "by",
    "le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui", "est", "pour", "dans", "pas", "sur",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "ein", "eine", "nicht", "auf", "dem", "im", "ist",
    "el", "los", "las", "del", "y", "se", "por", "con", "una", "para", "su", "al", "no", "lo",
)

#: measure, least, most (None: unbounded)
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("words", 50, 1_000_000),
    ("mean_word_length", 2, 12),
    ("symbols_per_word", None, 0.25),
    ("stop_word_share", 0.02, None),
    ("duplicate_line_share", None, 0.5),
    ("bullet_line_share", None, 0.9),
    ("ellipsis_line_share", None, 0.3),
)

_SHARES = {
    "words": ("n_words", None),
    "mean_word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "stop_word_share": ("n_stop_words", "n_words"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
    "bullet_line_share": ("n_bullet_lines", "n_lines"),
    "ellipsis_line_share": ("n_ellipsis_lines", "n_lines"),
}


def compile_thresholds(thresholds=THRESHOLDS) -> str:
    """The table as one SQL condition on the counts; shares are compared without dividing."""
    terms = []
    for measure, least, most in thresholds:
        part, whole = _SHARES[measure]
        for sign, bound in ((">=", least), ("<=", most)):
            if bound is not None:
                terms.append(f"{part} * 1000 {sign} {round(bound * 1000)}" + (f" * {whole}" if whole else ""))
    return "(" + " AND ".join(terms) + ")" if terms else "true"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more, given the hash at each word but the last two."""

    def covered(ordered: Column) -> Column:
        at = F.transform(
            ordered,
            lambda x, i: F.when(
                F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
                x["i"],
            ),
        )
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            F.sort_array(F.filter(at, lambda x: x.isNotNull())), start,
            lambda acc, i: F.struct(
                (acc["n"] + i + 3 - F.greatest(i, acc["end"])).alias("n"), (i + 3).alias("end")
            ),
            lambda acc: acc["n"],
        )

    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(ordered, covered)).otherwise(0)


def quality_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts the rules are made of, for every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.select("doc_id", text.alias("text"), words.alias("words"), lines.alias("lines"))
    hashed = cut.select(
        "doc_id", "text", "words", "lines",
        F.when(
            F.size("words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - 3),
                lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
            ),
        ).otherwise(F.array().cast("array<long>")).alias("windows"),
    )
    long = lambda c: c.cast("long")
    return hashed.select(
        "doc_id",
        long(F.size("words")).alias("n_words"),
        long(F.length(F.regexp_replace("text", SPACE, ""))).alias("word_chars"),
        long(F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        long(_repeated_words(F.col("windows"))).alias("n_repeat_words"),
        long(F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS)))).alias("n_stop_words"),
        long(F.size("lines")).alias("n_lines"),
        long(F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•][\x20\x09]")))).alias("n_bullet_lines"),
        long(F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))).alias("n_ellipsis_lines"),
    )


BASE_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"


def judge(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """The counts, ``base_failed`` and ``kept`` of every document."""
    counts = quality_counts(docs)
    return counts.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn(
        "kept", F.expr(f"NOT {BASE_FAILED} AND {compile_thresholds(thresholds)}")
    )


def oracle(thresholds=THRESHOLDS) -> str:
    """The same in DuckDB's SQL."""
    space = r"[\x20\x09-\x0D]+"
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    line = r"[^\x20\x09-\x0D]"
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{space}'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{line}')) AS lines FROM t),
win AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
    length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(cov.n, 0) AS n_repeat_words,
    CAST(len(list_filter(words, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words,
    len(lines) AS n_lines,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•][\x20\x09]'))) AS BIGINT) AS n_bullet_lines,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS BIGINT) AS n_ellipsis_lines
  FROM w LEFT JOIN cov USING (doc_id))
SELECT *, {BASE_FAILED} AS base_failed, NOT {BASE_FAILED} AND {compile_thresholds(thresholds)} AS kept FROM c
"""
