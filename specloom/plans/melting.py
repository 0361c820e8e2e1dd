"""Layout queries: long, wide, matrix, paired columns, two unit systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions.text import double_text
from specloom.functions.text import product_key as product_key_of
from specloom.operators import melt
from specloom.plans.ingest import double_sql
from specloom.plans.registry import query, table

EVENTS_SQL = f"""
    SELECT event_type AS company, 'user:' || user_id AS product_id, 'events' AS source_table,
           event_id AS source_row_id, 'value' AS source_column, event_type AS raw_item_name,
           {double_sql('value')} AS raw_value_text, value AS raw_value_numeric, NULL::VARCHAR AS raw_unit,
           'unspecified' AS unit_system, 1 AS source_rank, props AS raw_notes
    FROM events
"""
EVENT_COLUMNS = ["company", "product_id", "source_table", "source_row_id", "source_column", "raw_item_name",
                 "raw_value_text", "raw_value_numeric", "raw_unit", "unit_system", "source_rank", "raw_notes"]


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return melt.melt_long(table(spark, sf_dir, "events"), {
        "company": F.col("event_type"),
        "product_id": F.concat(F.lit("user:"), F.col("user_id")),
        "source_table": F.lit("events"),
        "source_row_id": F.col("event_id"),
        "source_column": F.lit("value"),
        "raw_item_name": F.col("event_type"),
        "raw_value_text": double_text(F.col("value")),
        "raw_value_numeric": F.col("value"),
        "raw_notes": F.col("props"),
    })


@query("melt_long_events", EVENTS_SQL)
def melt_long_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_observations(spark, sf_dir).select(*EVENT_COLUMNS)


WIDE = {"l_quantity": "quantity_kg", "l_extendedprice": "price_mm", "l_discount": "discount_kgf", "l_tax": "tax_kmh"}
WIDE_UNITS = {"quantity_kg": "kg", "price_mm": "mm", "discount_kgf": "kgf", "tax_kmh": "km/h"}


@query("melt_wide_lineitem", " UNION ALL ".join(
    f"SELECT 'part:' || l_partkey AS product_id, 'supplier_' || l_suppkey AS source_table, "
    f"l_orderkey * 10 + l_linenumber AS source_row_id, '{name}' AS source_column, "
    f"{double_sql(source)} AS raw_value_text, {source} AS raw_value_numeric, "
    f"'{WIDE_UNITS[name]}' AS raw_unit, 2 AS source_rank FROM lineitem"
    for source, name in WIDE.items()
))
def melt_wide_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", *WIDE)
    lines = measured.withColumnsRenamed(WIDE)
    keys = {
        "product_id": F.concat(F.lit("part:"), F.col("l_partkey")),
        "source_table": F.concat(F.lit("supplier_"), F.col("l_suppkey")),
        "source_row_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
    }
    return melt.melt_wide(lines, keys, list(WIDE.values())).select(
        *keys, "source_column", "raw_value_text", "raw_value_numeric", "raw_unit", "source_rank"
    )


STATUSES = ["O", "F", "P"]


def order_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and priorities down, order states across; cells without orders are empty."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey", "o_orderpriority").agg(*[
        F.round(F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))), 2).alias(s) for s in STATUSES
    ])


MATRIX_SQL = f"""
    SELECT 'state:' || o_orderstatus AS product_id, o_custkey AS source_row_id, o_orderstatus AS source_column,
           o_orderpriority AS raw_item_name, {double_sql('total')} AS raw_value_text
    FROM (SELECT o_custkey, o_orderpriority, o_orderstatus, round(sum(o_totalprice), 2) AS total
          FROM orders GROUP BY ALL)
"""


@query("melt_matrix", MATRIX_SQL)
def melt_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"source_row_id": F.col("o_custkey"), "raw_item_name": F.col("o_orderpriority")}
    products = {s: f"state:{s}" for s in STATUSES}
    return melt.melt_matrix(order_matrix(spark, sf_dir), keys, products).select(
        "product_id", "source_row_id", "source_column", "raw_item_name", "raw_value_text"
    )


GROUPS = [("quantity", "us", "l_quantity", "l_returnflag"), ("price", "metric", "l_extendedprice", "l_linestatus"),
          ("discount", "us", "l_discount", "l_returnflag")]


@query("melt_groups_lineitem", " UNION ALL ".join(
    f"SELECT '{label}' AS product_id, '{system}' AS unit_system, l_orderkey * 10 + l_linenumber AS source_row_id, "
    f"'{value}' AS source_column, {double_sql(value)} AS raw_value_text, {unit} AS raw_unit FROM lineitem"
    for label, system, value, unit in GROUPS
))
def melt_groups_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = [({"product_id": label, "unit_system": system}, value, unit) for label, system, value, unit in GROUPS]
    keys = {"source_row_id": F.col("l_orderkey") * 10 + F.col("l_linenumber")}
    return melt.melt_groups(table(spark, sf_dir, "lineitem"), keys, groups).select(
        "product_id", "unit_system", "source_row_id", "source_column", "raw_value_text", "raw_unit"
    )


DUAL_SQL = f"""
    SELECT 'part:' || p_partkey AS product_id, 'us' AS unit_system, {double_sql('CAST(p_size AS DOUBLE)')}
           AS raw_value_text, 'in' AS raw_unit FROM part WHERE p_type <> 'PROMO'
    UNION ALL
    SELECT 'part:' || p_partkey, 'metric', {double_sql('(p_size * 25.4::DOUBLE)')}, 'mm' FROM part
"""


def dual_unit_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand",
        F.when(F.col("p_type") != "PROMO", F.col("p_size").cast("double")).alias("us_value"),
        F.lit("in").alias("us_unit"),
        (F.col("p_size") * F.lit(25.4)).alias("metric_value"),
        F.lit("mm").alias("metric_unit"),
    )
    keys = {
        "company": F.col("p_brand"),
        "product_id": F.concat(F.lit("part:"), F.col("p_partkey")),
        "source_table": F.lit("part"),
        "source_row_id": F.col("p_partkey"),
        "raw_item_name": F.lit("size"),
    }
    return melt.melt_dual_unit(parts, keys, ("us_value", "us_unit"), ("metric_value", "metric_unit"))


@query("melt_dual_unit_part", DUAL_SQL)
def melt_dual_unit_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_unit_observations(spark, sf_dir).select("product_id", "unit_system", "raw_value_text", "raw_unit")


@query("union_obs", f"""
    SELECT source_table, source_row_id, unit_system, raw_item_name, raw_value_text, raw_unit FROM ({EVENTS_SQL})
    UNION ALL
    SELECT 'part', CAST(substring(product_id, 6) AS BIGINT), unit_system, 'size', raw_value_text, raw_unit
    FROM ({DUAL_SQL})
    UNION ALL
    SELECT 'orders', source_row_id, 'unspecified', raw_item_name, raw_value_text, NULL FROM ({MATRIX_SQL})
""")
def union_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = melt.melt_matrix(
        order_matrix(spark, sf_dir),
        {"source_table": F.lit("orders"), "source_row_id": F.col("o_custkey"), "raw_item_name": F.col("o_orderpriority")},
        {s: f"state:{s}" for s in STATUSES},
    )
    union = melt.union_observations(
        [event_observations(spark, sf_dir), dual_unit_observations(spark, sf_dir), matrix]
    )
    return union.select("source_table", "source_row_id", "unit_system", "raw_item_name", "raw_value_text", "raw_unit")


@query("product_key", r"""
    SELECT p_partkey, lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '_', 'g')) || ':' ||
           trim(regexp_replace(replace(lower(p_name || ' HD+ (' || p_type || ')'), '+', 'plus'),
                '[^a-z0-9]+', '_', 'g'), '_') AS product_id
    FROM part
""")
def product_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = F.concat("p_name", F.lit(" HD+ ("), "p_type", F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", product_key_of(F.col("p_brand"), model).alias("product_id"))


def _first_sql(name: str) -> str:
    order = "source_rank, l_suppkey, l_orderkey, l_linenumber"
    return f"first({name} ORDER BY {order}) FILTER (WHERE {name} IS NOT NULL) AS {name}"


@query("product_dim", f"""
    SELECT l_partkey, {_first_sql('series')}, {_first_sql('segment')}, {_first_sql('list_price')},
           1.0::DOUBLE AS confidence
    FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS source_rank,
                 CASE WHEN l_tax > 0.04 THEN l_returnflag || l_linestatus END AS series,
                 CASE WHEN l_discount < 0.03 THEN l_linestatus END AS segment,
                 CASE WHEN l_quantity > 25 THEN l_extendedprice END AS list_price FROM lineitem)
    GROUP BY l_partkey
""")
def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    sources = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber",
        F.when(flag == "A", 1).when(flag == "N", 2).otherwise(3).alias("source_rank"),
        F.when(F.col("l_tax") > 0.04, F.concat("l_returnflag", "l_linestatus")).alias("series"),
        F.when(F.col("l_discount") < 0.03, F.col("l_linestatus")).alias("segment"),
        F.when(F.col("l_quantity") > 25, F.col("l_extendedprice")).alias("list_price"),
    )
    return melt.build_products(
        sources, ["l_partkey"], ["series", "segment", "list_price"],
        ["source_rank", "l_suppkey", "l_orderkey", "l_linenumber"],
    )


EXCLUDED = ["Brand#3", "Brand#14", "Brand#22"]


def brand_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("source_table"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


@query("scope_split", """
    SELECT p_brand AS source_table, l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand NOT IN ('Brand#3', 'Brand#14', 'Brand#22')
""")
def scope_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return melt.in_scope(brand_lines(spark, sf_dir), EXCLUDED).drop("p_partkey")


SCOPE_ISSUES_SQL = """
    SELECT DISTINCT 'scope_excluded' AS issue_type, 'info' AS severity, p_brand AS source_table, 'open' AS status
    FROM part WHERE p_brand IN ('Brand#3', 'Brand#14', 'Brand#22')
"""


@query("scope_issues", SCOPE_ISSUES_SQL)
def scope_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = table(spark, sf_dir, "part").select(F.col("p_brand").alias("source_table"))
    return melt.scope_issues(tables, EXCLUDED)


@query("source_rank", """
    SELECT p_brand AS source_table, CAST(CASE p_brand WHEN 'Brand#1' THEN 2 WHEN 'Brand#5' THEN 3 ELSE 1 END AS INTEGER)
           AS source_rank, count(*) AS n
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
""")
def source_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = brand_lines(spark, sf_dir).withColumn("source_rank", F.lit(None).cast("int"))
    ranked = melt.with_source_rank(obs, [("Brand#1", 2), ("Brand#5", 3)])
    return ranked.groupBy("source_table", "source_rank").agg(F.count("*").alias("n"))
