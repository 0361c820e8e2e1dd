"""Raw item names to canonical items.

Names repeat from sheet to sheet, so pattern rules are tried on the distinct keys
(item, company, category, unit), and what they say is joined back by equality.
Rules may be a list or a frame of any length.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.dictionaries import dictionary
from specloom.session import cut_lineage

EXACT_CONFIDENCE = 1.0
SYNONYM_CONFIDENCE = 0.9
UNMAPPED = "unmapped"

#: What a pattern rule looks at.
KEYS = ["raw_item_name", "company", "raw_category", "raw_unit"]
#: Rules that a key meets at a time.
RULE_BLOCK = 500


class Pattern(NamedTuple):
    """A mapping rule; an absent expression matches anything."""

    pattern_id: int
    item_regex: str
    company_regex: str | None
    category_regex: str | None
    unit_regex: str | None
    canonical_item: str
    mapping_method: str
    confidence: float
    notes: str | None = None


def _mapping(item: Column, method: Column, confidence: Column, notes: Column) -> Column:
    return F.struct(
        item.cast("string").alias("canonical_item"),
        method.cast("string").alias("mapping_method"),
        confidence.cast("double").alias("confidence"),
        notes.cast("string").alias("mapping_notes"),
    )


def rule_table(spark: SparkSession, rules: Sequence[Pattern] | DataFrame) -> DataFrame:
    """Pattern rules, a list or a frame with the columns of ``Pattern``, as a frame with one rule a number.

    Two rules of one number are refused in a list; of a frame's the least counts.
    """
    fields = [f"{f} {'int' if f == 'pattern_id' else 'double' if f == 'confidence' else 'string'}" for f in Pattern._fields]
    return dictionary(spark, rules, ", ".join(fields), keys=["pattern_id"])


#: An expression that is a plain text from end to end; ``$`` also matches before a last line break.
_PLAIN = r"\A\^([^\\.\[\](){}*+?^$|\n\r\x{85}\x{2028}\x{2029}]*)\$\z"
_LAST_BREAK = r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])\z"


def _looked_up(rules: DataFrame) -> DataFrame:
    """Rules with their ``_shape``, a bit for each expression that is a plain text, and these texts.

    Of rules with the same four expressions only the least can win, so only that stays.
    """
    regexes = ["item_regex", "company_regex", "category_regex", "unit_regex"]
    rest = [f for f in Pattern._fields if f not in regexes]
    least = rules.groupBy(*regexes).agg(F.min(F.struct(*rest)).alias("_rest")).select(*regexes, "_rest.*")
    plain = [F.coalesce(F.regexp_like(F.col(r), F.lit(_PLAIN)), F.lit(False)) for r in regexes]
    return least.select(
        *Pattern._fields,
        reduce(lambda x, y: x + y, [F.when(is_plain, 1 << i).otherwise(0) for i, is_plain in enumerate(plain)]).alias("_shape"),
        *[
            F.when(is_plain, F.lower(F.regexp_extract(r, _PLAIN, 1))).otherwise("").alias(f"_text{i}")
            for i, (r, is_plain) in enumerate(zip(regexes, plain))
        ],
    )


def _rule_hits(obs: DataFrame, rules: Sequence[Pattern] | DataFrame) -> DataFrame:
    """Distinct keys with the lowest-numbered rule that looks at the unit, and the lowest-numbered other one.

    Expressions are tried once for each distinct key and rule, however many
    rows have the key.  Rules whose expressions are plain texts meet by equality only the keys
    that have these texts, letter case aside; whether they fit is still for the expressions to say.
    Rules of the same texts, or without any, come in blocks of about ``RULE_BLOCK``, so that a key
    meets any number of them without a product of the two tables.
    """
    spark = obs.sparkSession
    table = _looked_up(rule_table(spark, rules))
    if isinstance(rules, DataFrame):
        table = cut_lineage(table)
    texts = [f"_text{i}" for i in range(len(KEYS))]
    # at most one row for each of 16 shapes
    most = table.groupBy("_shape", *texts).count().groupBy("_shape").agg(F.max("count").alias("n")).collect()
    blocks = {r["_shape"]: -(-r["n"] // RULE_BLOCK) for r in most} or {0: 1}
    n_blocks = F.element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]), F.col("_shape"))
    grouped = table.groupBy(
        "_shape", *texts, F.pmod(F.xxhash64("pattern_id"), n_blocks).cast("int").alias("_block")
    ).agg(F.collect_list(F.struct(*Pattern._fields)).alias("_rules"))
    tries = F.array(*[F.struct(F.lit(s).alias("_shape"), F.lit(n).alias("n")) for s, n in sorted(blocks.items())])
    tried = obs.select(*KEYS).distinct().select(*KEYS, F.inline(tries)).select(
        *KEYS, "_shape", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("_block")
    )
    keys = tried.select(*KEYS, "_shape", "_block", *[
        F.when(F.col("_shape").bitwiseAND(1 << i) != 0, F.lower(F.regexp_replace(F.col(k), _LAST_BREAK, ""))).otherwise("")
        .alias(f"_text{i}")
        for i, k in enumerate(KEYS)
    ])

    def fits(column: str, regex: Column) -> Column:
        # a rule without an expression takes anything, one with an expression no NULL
        return F.when(regex.isNull(), True).otherwise(
            F.coalesce(F.regexp_like(F.col(column), F.concat(F.lit("(?i)"), regex)), F.lit(False))
        )

    def least(hits: str, by_unit: bool) -> Column:
        chosen = F.filter(hits, lambda r: r["unit_regex"].isNotNull() == by_unit)
        return F.array_min(F.transform(chosen, lambda r: F.struct(
            r["pattern_id"], *[f.alias(n) for f, n in zip(
                (r["canonical_item"], r["mapping_method"], r["confidence"], r["notes"]),
                ("canonical_item", "mapping_method", "confidence", "mapping_notes"),
            )],
        )))

    met = keys.join(grouped, ["_shape", "_block", *texts]).select(*KEYS, F.filter("_rules", lambda r: (
        fits("raw_item_name", r["item_regex"]) & fits("company", r["company_regex"])
        & fits("raw_category", r["category_regex"]) & fits("raw_unit", r["unit_regex"])
    )).alias("_hits"))
    return met.filter(F.size("_hits") > 0).groupBy(*KEYS).agg(
        F.min(least("_hits", True)).alias("_by_unit"), F.min(least("_hits", False)).alias("_by_name")
    )


def _with_rules(obs: DataFrame, rules: Sequence[Pattern] | DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """``_by_unit`` and ``_by_name`` of every observation; NULL where no rule fits.

    What the rules say of the keys is kept as a table.  So its size is known when the join is planned: as
    long as it is below Spark's threshold, it is sent around, and the observations stay where they are.
    """
    hits = cut_lineage(_rule_hits(obs if keys is None else keys, rules)).select(*[F.col(k).alias(f"_{k}") for k in KEYS], "_by_unit", "_by_name")
    same = F.lit(True)
    for k in KEYS:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return obs.join(hits, same, "left").drop(*[f"_{k}" for k in KEYS])


def _with_synonym(obs: DataFrame, synonyms: Sequence[tuple[str, str, str]]) -> DataFrame:
    rules = dictionary(
        obs.sparkSession, synonyms, "_key string, _item string, _match string", keys=["_key"],
        forms={"_key": (lambda v: v.strip(" ").lower(), lambda c: F.lower(F.trim(c)))},
    )
    confidence = F.when(F.col("_match") == "exact", EXACT_CONFIDENCE).otherwise(SYNONYM_CONFIDENCE)
    hit = F.when(
        F.col("_item").isNotNull(), _mapping(F.col("_item"), F.col("_match"), confidence, F.lit(None))
    )
    return (
        obs.withColumn("_name", F.lower(F.trim("raw_item_name")))
        .join(rules, F.col("_name") == F.col("_key"), "left")
        .withColumn("_synonym", hit)
        .drop("_name", "_key", "_item", "_match")
    )


def _unpack(df: DataFrame, mapping: Column) -> DataFrame:
    return (
        df.withColumn("_mapping", mapping)
        .withColumns({
            "canonical_item": F.col("_mapping.canonical_item"),
            "mapping_method": F.coalesce("_mapping.mapping_method", F.lit(UNMAPPED)),
            "confidence": F.coalesce("_mapping.confidence", F.lit(0.0)),
            "mapping_notes": F.col("_mapping.mapping_notes"),
        })
        .drop("_mapping", "_synonym", "_by_unit", "_by_name")
    )


def map_synonyms(obs: DataFrame, synonyms: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Mapping by the trimmed, lower-case item name alone."""
    return _unpack(_with_synonym(obs, synonyms), F.col("_synonym"))


def map_patterns(obs: DataFrame, rules: Sequence[Pattern] | DataFrame) -> DataFrame:
    """Mapping by the pattern rules alone."""
    # NULL counts as greater than any rule here
    return _unpack(_with_rules(obs, rules), F.least("_by_unit", "_by_name"))


def resolve_mapping(
    obs: DataFrame,
    synonyms: Sequence[tuple[str, str, str]],
    rules: Sequence[Pattern] | DataFrame,
    keys: DataFrame | None = None,
) -> DataFrame:
    """One mapping per observation.

    ``keys`` may name a frame with the columns ``KEYS`` that holds all keys of the observations,
    and maybe more, where it is cheaper to make than they are.

    A rule that looks at the unit knows more than a name, so it comes first,
    then the synonyms, then the other rules.
    """
    ruled = _with_synonym(_with_rules(obs, rules, keys), synonyms)
    return _unpack(ruled, F.coalesce(_bare("_by_unit"), F.col("_synonym"), _bare("_by_name")))


def _bare(hit: str) -> Column:
    """A rule's mapping without the rule's number, as synonyms give it."""
    h = F.col(hit)
    return F.when(h.isNotNull(), _mapping(h["canonical_item"], h["mapping_method"], h["confidence"], h["mapping_notes"]))


def with_canonical(
    obs: DataFrame, canonical: Sequence[tuple[str, str, str | None, str, int]]
) -> DataFrame:
    """Category, unit, value type and priority of the canonical item."""
    items = dictionary(
        obs.sparkSession,
        canonical,
        "canonical_item string, category string, canonical_unit string, value_type string, priority int",
        keys=["canonical_item"],
    )
    return obs.join(items, "canonical_item", "left")


def unmapped(obs: DataFrame) -> DataFrame:
    """Observations no rule knows."""
    return obs.filter(F.col("canonical_item").isNull())


def method_counts(obs: DataFrame) -> DataFrame:
    return obs.groupBy("mapping_method").agg(F.count("*").alias("n"))
