"""Queries that map raw item names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.dictionaries import sql_values
from specloom.operators import mapping
from specloom.operators.mapping import Pattern
from specloom.plans import observations as obs
from specloom.plans.registry import query, table

TYPE_SYNONYMS = [
    ("economy", "overall_length", "exact"),
    ("promo", "overall_width", "synonym"),
    ("large", "overall_height", "synonym"),
    ("small", "wheelbase", "exact"),
]
PART_RULES = [
    Pattern(30, r"bolt$", None, None, None, "breakout_force", "inferred", 0.8),
    Pattern(10, r"^(red|blue)\b", r"^brand#1", None, None, "lift_height", "inferred", 0.75),
    Pattern(20, r"ring|gear", None, r"^(promo|small)$", r"^1\d$", "lift_capacity", "unit_based", 0.9, "two-digit size"),
]


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("company"), F.col("p_type").alias("raw_category"),
        F.col("p_name").alias("raw_item_name"), F.col("p_size").cast("string").alias("raw_unit"),
    )


MAPPING = ["canonical_item", "mapping_method", "confidence"]


@query("map_synonyms", f"""
    WITH synonyms(key, item, match) AS (VALUES {sql_values(TYPE_SYNONYMS)})
    SELECT p_partkey, item AS canonical_item, coalesce(match, 'unmapped') AS mapping_method,
           CAST(CASE match WHEN 'exact' THEN 1.0 WHEN 'synonym' THEN 0.9 ELSE 0.0 END AS DOUBLE) AS confidence
    FROM part LEFT JOIN synonyms ON key = lower(trim(p_type))
""")
def map_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("raw_item_name")
    )
    return mapping.map_synonyms(items, TYPE_SYNONYMS).select("p_partkey", *MAPPING)


@query("map_patterns", f"""
    WITH rules(pattern_id, item_regex, company_regex, category_regex, unit_regex, item, method, confidence, notes) AS (
        VALUES {sql_values(PART_RULES)})
    SELECT p_partkey, item AS canonical_item, coalesce(method, 'unmapped') AS mapping_method,
           CAST(coalesce(confidence, 0.0) AS DOUBLE) AS confidence, notes AS mapping_notes
    FROM part LEFT JOIN rules ON regexp_matches(lower(p_name), item_regex)
         AND (company_regex IS NULL OR regexp_matches(lower(p_brand), company_regex))
         AND (category_regex IS NULL OR regexp_matches(lower(p_type), category_regex))
         AND (unit_regex IS NULL OR regexp_matches(CAST(p_size AS VARCHAR), unit_regex))
    QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY pattern_id) = 1
""")
def map_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_patterns(part_items(spark, sf_dir), PART_RULES).select("p_partkey", *MAPPING, "mapping_notes")


@query("map_patterns_frame", f"""
    WITH rules AS (
        SELECT p_partkey AS pattern_id, '^' || p_name || '$' AS item_regex,
               CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS company_regex,
               CASE WHEN p_partkey % 5 = 0 THEN '^' || p_size || '$' END AS unit_regex,
               'item_' || p_type AS item, 1.0::DOUBLE / p_partkey AS confidence
        FROM part WHERE p_partkey % 4 = 1)
    SELECT p_partkey, item AS canonical_item, CASE WHEN item IS NULL THEN 'unmapped' ELSE 'regex' END AS mapping_method,
           coalesce(confidence, 0.0) AS confidence
    FROM part LEFT JOIN rules ON lower(p_name) = lower(item_regex[2:-2]) AND (company_regex IS NULL OR company_regex = p_brand)
         AND (unit_regex IS NULL OR regexp_matches(CAST(p_size AS VARCHAR), unit_regex))
    QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY pattern_id) = 1
""")
def map_patterns_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the parts as rules: a rule table that grows with the data."""
    parts = table(spark, sf_dir, "part")
    key, empty = F.col("p_partkey"), F.lit(None).cast("string")
    rules = parts.filter(key % 4 == 1).select(
        key.cast("int").alias("pattern_id"), F.concat(F.lit("^"), "p_name", F.lit("$")).alias("item_regex"),
        F.when(key % 3 == 0, F.concat(F.lit("^"), "p_brand", F.lit("$"))).alias("company_regex"), empty.alias("category_regex"),
        F.when(key % 5 == 0, F.concat(F.lit("^"), "p_size", F.lit("$"))).alias("unit_regex"),
        F.concat(F.lit("item_"), "p_type").alias("canonical_item"), F.lit("regex").alias("mapping_method"),
        (F.lit(1.0) / key).alias("confidence"), empty.alias("notes"),
    )
    return mapping.map_patterns(part_items(spark, sf_dir), rules).select("p_partkey", *MAPPING)


@query("map_all", obs.with_mapped("""
    SELECT product_id, source_table, source_row_id, raw_item_name, canonical_item, mapping_method, confidence,
           mapping_notes FROM mapped
"""))
def map_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs.mapped_observations(spark, sf_dir).select(
        "product_id", "source_table", "source_row_id", "raw_item_name", *MAPPING, "mapping_notes"
    )


@query("mapping_method_counts", obs.with_mapped("SELECT mapping_method, count(*) AS n FROM mapped GROUP BY 1"))
def mapping_method_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.method_counts(obs.mapped_observations(spark, sf_dir))


@query("unmapped_rows", obs.with_mapped("""
    SELECT company, product_id, source_table, source_row_id, raw_item_name, raw_value_text
    FROM mapped WHERE canonical_item IS NULL
"""))
def unmapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.unmapped(obs.mapped_observations(spark, sf_dir)).select(
        "company", "product_id", "source_table", "source_row_id", "raw_item_name", "raw_value_text"
    )
