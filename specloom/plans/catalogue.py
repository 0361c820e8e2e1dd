"""Catalogue, profile and browse queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.operators import catalogue
from specloom.plans.registry import TABLES, query, table
from specloom.sources.tables import register_views


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, 'tables/{t}' AS raw_path FROM {t}" for t in TABLES
))
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.table_counts(
        {t: table(spark, sf_dir, t) for t in TABLES}, {t: f"tables/{t}" for t in TABLES}
    )


# Each order is a table whose columns are its line numbers, so at most seven.
NAME_OF = [("A", "O", "型式"), ("A", "F", "メーカー名"), ("N", "O", "項目"), ("N", "F", "仕様項目"),
           ("R", "O", "仕様値"), ("R", "F", "備考")]


def order_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_returnflag").alias("flag"), F.min("l_linestatus").alias("status")
    )
    name = F.lit(None).cast("string")
    for flag, status, label in NAME_OF:
        name = F.when((F.col("flag") == flag) & (F.col("status") == status), label).otherwise(name)
    return lines.select(
        F.concat(F.lit("order_"), F.col("l_orderkey")).alias("table_name"),
        name.alias("column_name"),
        F.col("l_linenumber").alias("position"),
    )


ORDER_COLUMNS_SQL = """
    SELECT 'order_' || l_orderkey AS table_name, l_linenumber AS position, CASE min(l_returnflag) || min(l_linestatus)
        %s END AS column_name
    FROM lineitem GROUP BY l_orderkey, l_linenumber
""" % " ".join(f"WHEN '{f}{s}' THEN '{label}'" for f, s, label in NAME_OF)
SIGNATURES_SQL = f"""
    SELECT table_name, string_agg(column_name, ', ' ORDER BY position) AS columns
    FROM ({ORDER_COLUMNS_SQL}) GROUP BY table_name
"""


@query("signature_groups", f"""
    SELECT columns, count(*) AS n_tables, min(table_name) AS representative
    FROM ({SIGNATURES_SQL}) GROUP BY columns
""")
def signature_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.signature_groups(order_columns(spark, sf_dir))


@query("signature_members", f"""
    SELECT min(table_name) OVER (PARTITION BY columns) AS representative, table_name FROM ({SIGNATURES_SQL})
""")
def signature_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.signature_members(order_columns(spark, sf_dir))


def _role_sql(role: str, names: list[str]) -> str:
    quoted = ", ".join(f"'{n}'" for n in names)
    return (
        f"'{role}=' || (string_agg(column_name, '/' ORDER BY position) FILTER (WHERE column_name IN ({quoted})))"
    )


@query("column_roles", f"""
    SELECT table_name, CASE WHEN roles = '' THEN '(該当なし)' ELSE roles END AS roles
    FROM (SELECT table_name, concat_ws('; ', {_role_sql('company', ['メーカー名'])}, {_role_sql('model', ['型式'])},
                 {_role_sql('item', ['項目', '仕様項目'])}, {_role_sql('value', ['仕様値'])}) AS roles
          FROM ({ORDER_COLUMNS_SQL}) GROUP BY table_name)
""")
def column_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.role_candidates(order_columns(spark, sf_dir))


@query("sample_rows", """
    SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS sample_no,
           concat_ws(' | ', substring(CAST(doc_id AS VARCHAR), 1, 40), substring(lang, 1, 40),
                     substring(text, 1, 40), substring(CAST(n_chars AS VARCHAR), 1, 40)) AS sample
    FROM documents QUALIFY sample_no <= 3
""")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.sample_rows(
        table(spark, sf_dir, "documents"), "source", [F.col("doc_id").asc()], ["doc_id", "lang", "text", "n_chars"]
    )


PART_TYPES = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
              "p_size": "int", "p_retailprice": "double"}


def _summary_sql(name: str, kind: str) -> str:
    if kind == "string":
        stats = f"min({name}) AS min_value, max({name}) AS max_value, NULL::DOUBLE AS mean_value"
    elif kind in ("int", "bigint"):
        stats = (f"CAST(min({name}) AS VARCHAR) AS min_value, CAST(max({name}) AS VARCHAR) AS max_value, "
                 f"round(avg({name}), 4) AS mean_value")
    else:
        stats = (f"CAST(min({name})::DOUBLE AS VARCHAR) AS min_value, CAST(max({name})::DOUBLE AS VARCHAR) AS max_value, "
                 f"round(avg({name}), 4) AS mean_value")
    return (f"SELECT '{name}' AS column_name, '{kind}' AS column_type, count(*) AS n_rows, "
            f"count(*) - count({name}) AS n_null, count(DISTINCT {name}) AS n_distinct, {stats} FROM part")


@query("summarize_part", " UNION ALL ".join(_summary_sql(n, k) for n, k in PART_TYPES.items()))
def summarize_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.summarize(table(spark, sf_dir, "part"))


@query("summarize_sketch", " UNION ALL ".join(_summary_sql(n, k) for n, k in PART_TYPES.items()))
def summarize_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one pass; its distinct counts are exact up to an eighth of the sketch's registers, 8192 here."""
    return catalogue.summarize_sketch(table(spark, sf_dir, "part"))


@query("page_orders", """
    SELECT o_orderkey, o_custkey, o_totalprice, (SELECT count(*) FROM orders) AS total_rows
    FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100 OFFSET 200
""")
def page_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    order = [catalogue.null_last("o_totalprice", descending=True), F.col("o_orderkey").asc()]
    return catalogue.page(orders, order, limit=100, offset=200)


@query("head_flag", """
    SELECT c_custkey, c_name, c_acctbal, (SELECT count(*) > 100 FROM customer) AS truncated
    FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 100
""")
def head_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    order = [catalogue.null_last("c_acctbal", descending=True), F.col("c_custkey").asc()]
    return catalogue.head_with_flag(customers, order, 100)


@query("search_customer", """
    SELECT * FROM customer WHERE contains(lower(CAST(c_custkey AS VARCHAR)), 'building')
       OR contains(lower(c_name), 'building') OR contains(lower(CAST(c_nationkey AS VARCHAR)), 'building')
       OR contains(lower(CAST(c_acctbal AS VARCHAR)), 'building') OR contains(lower(c_mktsegment), 'building')
""")
def search_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.search(table(spark, sf_dir, "customer"), "Building")


@query("sort_nulls", """
    SELECT c_custkey, balance, row_number() OVER (ORDER BY balance DESC NULLS LAST, c_custkey) AS position
    FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer)
""")
def sort_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    )
    order = [catalogue.null_last("balance", descending=True), F.col("c_custkey").asc()]
    return catalogue.sorted_positions(customers, order)


VIEW_SQL = """
    WITH spending AS (
        SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spent
        FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY o_custkey)
    SELECT n_name, c_mktsegment, count(*) AS n_customers, sum(n_orders) AS n_orders,
           round(sum(spent), 2) AS spent
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN spending ON o_custkey = c_custkey
    GROUP BY n_name, c_mktsegment
"""


@query("view_sql", VIEW_SQL.replace("sum(n_orders) AS n_orders", "CAST(sum(n_orders) AS BIGINT) AS n_orders"))
def view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A free SELECT over the tables registered as views."""
    register_views({name: table(spark, sf_dir, name) for name in ("customer", "nation", "orders")})
    return spark.sql(VIEW_SQL)
