"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

The rules' own verdicts are the labels: urls that a rule judges train the trees,
and every other url gets the trees' verdict.  Features are built-in functions of
the url: lengths, depth, share of digits, entropy of its characters, numbers of
parameters and hyphens, and how often labelled urls of the same host suffix are
blocked.  Training reads ``LEARN_URLS`` distinct labelled urls at most, about, chosen by
a hash of the url; statistics of suffixes come from all rows, but those of a
url's own rows are left out where the trees learn from it.

Defined results: a null url, or one without "://", has an empty host and path,
which no rule fits; if rules judge nothing every other url is allowed, and if
they give one verdict only, every other url gets that one; repeated rows keep
their row and are learned from once; very long urls are read whole; further
columns are not looked at.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.session import cut_lineage

#: verdict, host, start of the path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
LEARN_URLS = 20_000
TREES = 10
DEPTH = 4
#: Urls as which a suffix's prior counts.
SMOOTHING = 20.0

FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "n_parameters",
    "n_hyphens", "longest_segment", "suffix_rate", "suffix_seen",
)


def host_of(url: Column) -> Column:
    """From the first "://" up to "/", "?", "#" or the end; A-Z in lower case."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(host: str, path: str) -> Column:
    own = (F.col("host") == host) | F.col("host").endswith(f".{host}")
    return own & F.col("path").startswith(path)


def _first_rule(rules, value) -> Column:
    """``value`` of the longest rule that fits; earlier ones win between rules of one length."""
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        found = F.when(_fits(rule[1], rule[2]), F.lit(value(rule))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits a character of the text has, by the frequencies in it."""
    n = F.length(text).cast("double")

    def term(c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -p * F.log2(p)

    distinct = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    terms = F.transform(F.array_sort(distinct), term)
    return F.when(n > 0, F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruling (the verdict of the longest rule that fits, or null)."""
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.select(
        "page_id", "url", "host", "path",
        _first_rule(rules, lambda r: r[1] + r[2]).alias("rule"), _first_rule(rules, lambda r: r[0]).alias("ruling"),
    )


def lexical(rows: DataFrame) -> DataFrame:
    """The features of ``ruled`` rows, but for those of the suffix."""
    url = F.coalesce(F.col("url"), F.lit(""))
    length = F.length(url).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    return rows.select(
        "page_id", "url", "host", "path", "rule", "ruling",
        F.element_at(F.split("host", r"\."), -1).alias("suffix"),
        length.alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        F.size(segments).cast("double").alias("depth"),
        F.size(F.split("host", r"\.")).cast("double").alias("labels"),
        F.when(length > 0, F.length(F.regexp_replace(url, "[^0-9]", "")) / length).otherwise(0.0).alias("digit_ratio"),
        _entropy(url).alias("entropy"),
        F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double").alias("n_parameters"),
        (F.length(url) - F.length(F.replace(url, F.lit("-"), F.lit("")))).cast("double").alias("n_hyphens"),
        F.coalesce(F.array_max(F.transform(segments, F.length)), F.lit(0)).cast("double").alias("longest_segment"),
    )


def learned(known: DataFrame, urls: int) -> DataFrame:
    """Distinct judged urls to learn from, all columns, with the number of rows each has; ``urls`` is about how many there are."""
    share = int(min(1.0, LEARN_URLS / max(1, urls)) * (1 << 30))
    drawn = known.filter(F.col("ruling").isNotNull() & (F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < share))
    rest = [c for c in known.columns if c != "url"]
    return drawn.groupBy("url").agg(*(F.any_value(c).alias(c) for c in rest), F.count("*").alias("_rows"))


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score (null where a rule decides) of every page."""
    rows = lexical(ruled(pages, rules))
    label = (F.col("ruling") == "block").cast("double")
    judged = rows.filter(F.col("ruling").isNotNull())
    # the estimate of distinct urls only sets the rate of the sample
    totals = {r.ruling: r for r in judged.groupBy("ruling").agg(
        F.count("*").alias("n"), F.approx_count_distinct("url", 0.02).alias("urls")
    ).collect()}
    n, blocked = sum(r.n for r in totals.values()), totals["block"].n if "block" in totals else 0
    if n == 0 or blocked in (0, n):
        verdict = "block" if n and blocked == n else "allow"
        return rows.select(
            "page_id", "host", "path", "rule", F.coalesce("ruling", F.lit(verdict)).alias("verdict"),
            F.when(F.col("ruling").isNull(), F.lit(float(verdict == "block"))).alias("block_score"),
        )
    prior = blocked / n
    suffixes = judged.groupBy("suffix").agg(
        F.sum(label).alias("_blocked"), F.count("*").cast("double").alias("_seen")
    )
    known = rows.join(suffixes, "suffix", "left").fillna({"_blocked": 0.0, "_seen": 0.0})
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")

    def vectors(of: DataFrame, blocked: Column, seen: Column) -> DataFrame:
        return assemble.transform(of.withColumns({
            "suffix_rate": (blocked + prior * SMOOTHING) / (seen + SMOOTHING), "suffix_seen": (seen > 0).cast("double"),
        }))

    learn = learned(known, sum(r.urls for r in totals.values()))
    own = F.col("_rows").cast("double")
    learn = vectors(learn, F.col("_blocked") - own * label, F.col("_seen") - own)
    # trees read their rows many times: a written table, of a bounded number of rows
    learn = cut_lineage(learn.select("features", label.alias("label")))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7, cacheNodeIds=False)
    scored = trees.fit(learn).transform(vectors(known, F.col("_blocked"), F.col("_seen")))
    score = vector_to_array("probability")[1]
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruling", F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("ruling").isNull(), score).alias("block_score"),
    )
