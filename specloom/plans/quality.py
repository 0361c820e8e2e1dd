"""Quality reports on the derived observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.operators import normalize, quality, resolve
from specloom.plans import observations as obs
from specloom.plans.ingest import double_sql
from specloom.plans.normalizing import ISSUES_CTE
from specloom.plans.registry import query, table

VALUE_SQL = f"coalesce({double_sql('normalized_value_numeric')}, normalized_value_text)"
IDS = ("source_row_id", "source_table", "source_column", "original_value")


@query("conflicts", obs.with_norm(f"""
    SELECT product_id, canonical_item, count(*) AS n_rows, count(DISTINCT {VALUE_SQL}) AS n_distinct_values,
           min(normalized_value_numeric) AS min_value, max(normalized_value_numeric) AS max_value,
           array_to_string(list_sort(list(DISTINCT source_table)), ' | ') AS sources
    FROM norm GROUP BY product_id, canonical_item HAVING n_distinct_values > 1
"""))
def conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.conflicts(obs.shared_normalized(spark, sf_dir))


@query("conflict_flag", obs.with_norm(f"""
    , status AS (SELECT product_id, canonical_item, count(DISTINCT {VALUE_SQL}) AS n FROM norm GROUP BY ALL)
    SELECT product_id, canonical_item, source_table, source_row_id,
           CASE WHEN n = 0 THEN '未確定' WHEN n > 1 THEN '競合' END AS conflict_status
    FROM norm JOIN status USING (product_id, canonical_item)
"""))
def conflict_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flag_conflicts(obs.shared_normalized(spark, sf_dir), stored=True).select(
        "product_id", "canonical_item", "source_table", "source_row_id", "conflict_status"
    )


BEST_CTE = """, best AS (
    SELECT * FROM norm WHERE value_status IN ('present', 'optional')
    QUALIFY row_number() OVER (PARTITION BY product_id, canonical_item ORDER BY confidence DESC, source_rank,
        CASE unit_system WHEN 'metric' THEN 1 WHEN 'us' THEN 2 ELSE 3 END,
        source_row_id, source_table, source_column, original_value) = 1)"""


@query("missing_rate", obs.with_norm(BEST_CTE + """,
    scope AS (SELECT 'part:' || p_partkey AS product_id FROM part WHERE p_type <> 'PROMO')
    SELECT c.canonical_item, c.category, c.priority, count(s.product_id) AS n_products_with_value,
           (SELECT count(*) FROM scope) AS n_products_total,
           round(1 - count(s.product_id) / (SELECT count(*) FROM scope), 2) AS missing_rate
    FROM canonical c LEFT JOIN best b ON b.canonical_item = c.canonical_item
    LEFT JOIN scope s ON s.product_id = b.product_id
    WHERE c.priority <= 2 GROUP BY c.canonical_item, c.category, c.priority
"""))
def missing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = resolve.best_record(obs.shared_normalized(spark, sf_dir), ids=IDS)
    scope = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO").select(
        F.concat(F.lit("part:"), F.col("p_partkey")).alias("product_id")
    )
    return quality.missing_rate(best, scope, obs.CANONICAL)


SPEC_ITEMS = [(item, item, kind) for item, _, _, kind, _ in obs.CANONICAL]


@query("best_specs", obs.with_norm(BEST_CTE + """
    SELECT product_id, canonical_item, normalized_value_numeric, normalized_value_text, confidence, source_table, source_row_id
    FROM best
"""))
def best_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best records of the shared table, bucket by bucket."""
    return resolve.best_record(obs.shared_normalized(spark, sf_dir), ids=IDS).select(
        "product_id", "canonical_item", "normalized_value_numeric", "normalized_value_text", "confidence", "source_table",
        "source_row_id",
    )


_SPEC_CELLS = ", ".join(
    f"max(normalized_value_{kind}) FILTER (WHERE canonical_item = '{item}') AS {item}" for item, _, kind in SPEC_ITEMS
)


@query("comparison_specs", obs.with_norm(BEST_CTE + f"""
    SELECT p_name AS product_name, cells.* FROM (SELECT product_id, {_SPEC_CELLS} FROM best GROUP BY product_id) AS cells
    JOIN part ON product_id = 'part:' || p_partkey
    UNION ALL BY NAME
    SELECT p_name AS product_name, 'part:' || p_partkey AS product_id FROM part
    WHERE 'part:' || p_partkey NOT IN (SELECT product_id FROM best)
"""))
def comparison_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison of the shared table's best records: one row a product."""
    products = table(spark, sf_dir, "part").select(
        F.concat(F.lit("part:"), F.col("p_partkey")).alias("product_id"), F.col("p_name").alias("product_name")
    )
    best = resolve.best_record(obs.shared_normalized(spark, sf_dir), ids=IDS)
    return resolve.pivot_items(products, best, SPEC_ITEMS)


@query("skewed_items", obs.with_norm("""
    SELECT canonical_item, count(DISTINCT company) AS n_companies, count(DISTINCT product_id) AS n_products,
           array_to_string(list_sort(list(DISTINCT company)), ' | ') AS companies
    FROM norm GROUP BY canonical_item HAVING n_companies <= 11
"""))
def skewed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.skewed_items(obs.shared_normalized(spark, sf_dir), max_companies=11)


@query("low_confidence", obs.with_mapped("""
    SELECT company, raw_item_name, canonical_item, mapping_method, confidence, mapping_notes AS notes,
           count(*) AS n_products
    FROM mapped WHERE canonical_item IS NOT NULL AND confidence < 0.7 GROUP BY ALL
"""))
def low_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.low_confidence(obs.mapped_observations(spark, sf_dir))


@query("parse_failures", obs.with_norm("""
    SELECT company, product_id, canonical_item, original_value, original_unit, source_table, notes
    FROM norm WHERE failed OR no_rule
"""))
def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.parse_failures(obs.shared_normalized(spark, sf_dir))


@query("issue_summary", obs.with_norm(ISSUES_CTE + """
    SELECT issue_type, 'review' AS severity, count(*) AS n,
           array_to_string(list_sort(list(DISTINCT company)), ' | ') AS companies
    FROM issues GROUP BY issue_type
"""))
def issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.issue_summary(normalize.issues(obs.annotated(spark, sf_dir)))


@query("unit_mismatch", obs.with_norm("""
    SELECT company, product_id, canonical_item, original_unit, canonical_unit, original_value, source_table
    FROM norm WHERE value_type = 'numeric' AND raw_unit IS NOT NULL AND canonical_unit IS NOT NULL AND factor IS NULL
"""))
def unit_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unit_mismatches(obs.mapped_observations(spark, sf_dir), obs.CONVERSIONS)


@query("unit_mismatch_forms", """
    SELECT 'c' AS company, l_partkey AS product_id, 'weight' AS canonical_item, 'stone' AS original_unit,
           'kg' AS canonical_unit, CAST(l_linenumber AS VARCHAR) AS original_value, 's' || l_suppkey AS source_table
    FROM lineitem WHERE l_returnflag = 'R'
""")
def unit_mismatch_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and rules written in several ways; the rules are a frame."""
    flag = F.col("l_returnflag")
    mapped = table(spark, sf_dir, "lineitem").select(
        F.lit("c").alias("company"), F.col("l_partkey").alias("product_id"), F.lit("weight").alias("canonical_item"),
        F.when(flag == "A", " Lb.").when(flag == "N", "K G").otherwise("stone").alias("raw_unit"),
        F.lit("kg").alias("canonical_unit"), F.lit("numeric").alias("value_type"),
        F.col("l_linenumber").cast("string").alias("raw_value_text"), F.concat(F.lit("s"), "l_suppkey").alias("source_table"),
    )
    rules = spark.createDataFrame([("LB", "kg", 0.45359237), ("KG.", "kg", 1.0), ("t", "kg", 1000.0)], "a string, b string, c double")
    return quality.unit_mismatches(mapped, rules)


@query("unmapped_items", obs.with_mapped("""
    SELECT company, raw_item_name, count(*) AS n_products,
           first(source_table ORDER BY source_row_id, source_table, product_id, raw_value_text) AS sample_table,
           first(raw_value_text ORDER BY source_row_id, source_table, product_id, raw_value_text) AS sample_value
    FROM mapped WHERE canonical_item IS NULL GROUP BY company, raw_item_name
"""))
def unmapped_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unmapped_items(
        obs.shared_annotated(spark, sf_dir), ["source_row_id", "source_table", "product_id", "raw_value_text"]
    )


@query("uncovered", """
    SELECT 'customer_' || c_custkey AS table_name, c_mktsegment AS sheet_name,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'scope_excluded として記録済み' ELSE '未判断' END AS scope_status
    FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
""")
def uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("customer_"), F.col("c_custkey"))
    customers = table(spark, sf_dir, "customer")
    imports = customers.select(name.alias("table_name"), F.col("c_mktsegment").alias("sheet_name"))
    issues = customers.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.lit("scope_excluded").alias("issue_type"), name.alias("source_table")
    )
    observed = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 400000).select(
        F.concat(F.lit("customer_"), F.col("o_custkey")).alias("source_table")
    )
    return quality.uncovered_sources(imports, observed, issues)


@query("orphans", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
""")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    return quality.orphans(rows, orders, ["l_orderkey"])


@query("key_checks", """
    SELECT 'unique' AS rule, 'l_orderkey, l_linenumber' AS columns, (SELECT count(*) FROM (
               SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS n_violations
    UNION ALL SELECT 'not null', 'l_partkey', (SELECT count(*) FROM lineitem WHERE l_partkey IS NULL)
    UNION ALL SELECT 'not null', 'rated_price', (SELECT count(*) FROM lineitem WHERE l_discount >= 0.09)
""")
def key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_discount") < 0.09, F.col("l_extendedprice")).alias("rated_price"),
    )
    return quality.key_violations(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "rated_price"])
