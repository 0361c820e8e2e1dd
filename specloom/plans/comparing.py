"""Comparison queries over parts and lines as models of brands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.dictionaries import METRICS, US_FAMILIES
from specloom.functions import numbers, text
from specloom.operators import compare
from specloom.plans.ingest import double_sql
from specloom.plans.registry import query, table

BRANDS = ["Brand#7", "Brand#12", "Brand#3", "Brand#25", "Brand#1"]


@query("clean_text_docs", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def clean_text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", text.clean_text(F.col("text")).alias("text"))


_NUMBERS_SQL = r"regexp_extract_all(body, '\d+(?:\.\d+)?')"
_RANGED_SQL = "(contains(body, '-') OR contains(body, '–') OR contains(body, 'to'))"


@query("parse_measure", rf"""
    SELECT source, id, CAST(numbers[1] AS DOUBLE) * metres AS first_value, CAST(numbers[2] AS DOUBLE) * metres AS second_value,
           CAST(CASE WHEN {_RANGED_SQL} AND len(numbers) > 1 THEN numbers[-1] ELSE numbers[1] END AS DOUBLE) * metres
               AS range_max
    FROM (SELECT *, {_NUMBERS_SQL} AS numbers,
                 CASE WHEN regexp_matches(lower(body), '(^|[^a-z])m($|[^a-z])') THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END
                     AS metres
          FROM (SELECT source, id, replace(trim(regexp_replace(text, '\s+', ' ', 'g')), ',', '') AS body FROM (
              SELECT 'document' AS source, doc_id AS id, text FROM documents
              UNION ALL SELECT 'part', p_partkey, p_name || ' ' || p_size || '-' || (p_size + 9) || ' m' FROM part)))
""")
def parse_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("source"), F.col("doc_id").alias("id"), "text")
    parts = table(spark, sf_dir, "part").select(
        F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
        F.concat("p_name", F.lit(" "), "p_size", F.lit("-"), F.col("p_size") + 9, F.lit(" m")).alias("text"),
    )
    texts = docs.unionByName(parts)
    return texts.select(
        "source", "id",
        numbers.parse_measure(F.col("text"), "mm", "first").alias("first_value"),
        numbers.parse_measure(F.col("text"), "mm", "second").alias("second_value"),
        numbers.parse_measure(F.col("text"), "mm", "range_max").alias("range_max"),
    )


FAMILY_COLUMNS = [("length", "l_extendedprice"), ("weight", "l_quantity"), ("speed", "l_quantity"),
                  ("flow", "l_extendedprice"), ("pressure", "l_tax"), ("force", "l_discount"), ("torque", "l_quantity")]


def _us_sql(value: str, family: str) -> str:
    _, _, how, factor = US_FAMILIES[family]
    return f"({value} {'/' if how == 'divide' else '*'} {factor}::DOUBLE)"


def _shown_sql(value: str) -> str:
    return f"regexp_replace(printf('%.1f', {value}), '\\.0$', '')"


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("to_us", f"SELECT {', '.join(LINE_KEY)}, " + ", ".join(
    f"round({_us_sql(column, family)}, 6) AS {family}" for family, column in FAMILY_COLUMNS) + " FROM lineitem")
def to_us(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, *[
        F.round(numbers.to_us(F.col(column), family), 6).alias(family) for family, column in FAMILY_COLUMNS
    ])


@query("display_value", f"""
    SELECT {', '.join(LINE_KEY)}, CAST(CAST(round_even(l_extendedprice, 0) AS BIGINT) AS VARCHAR) AS metric_mm,
           {_shown_sql(_us_sql('l_extendedprice', 'length'))} AS inches,
           {_shown_sql(_us_sql('l_quantity', 'weight'))} AS pounds,
           {_shown_sql('(l_tax * 2.5)')} AS litres, {_shown_sql(_us_sql('(l_tax * 100)', 'speed'))} AS mph
    FROM lineitem
""")
def display_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, quantity, tax = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_tax")
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        numbers.display_value(price, "length", "metric", "mm").alias("metric_mm"),
        numbers.display_value(price, "length", "us", "mm").alias("inches"),
        numbers.display_value(quantity, "weight", "us", "kg").alias("pounds"),
        numbers.display_value(tax * 2.5, "flow", "metric", "L/min").alias("litres"),
        numbers.display_value(tax * 100, "speed", "us", "km/h").alias("mph"),
    )


# Parts as models, their texts in the many ways data sheets write measures:
# column, text in SQL, and below the number each metric must find in it.
MODEL_TEXTS = {
    "horsepower": "CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'PROMO' THEN '0 hp' ELSE p_size || ' hp' END",
    "lift_capacity_kg": "format('{:,.2f}', p_retailprice) || ' kg'",
    "lift_height_mm": "p_size || '-' || (p_size + 100) || ' mm'",
    "telescopic_length_mm": "p_size || '.5 m'",
    "aux_hydraulic_flow_pressure_l_min_mpa": "p_size || ' L/min / ' || (p_size + 3) || '.25 MPa'",
    "max_breakout_force_kgf": "p_name",
    "max_tow_force_kgf": "p_size || '00 kgf'",
    "max_torque_nm_rpm": "p_size || ' N·m @ 2400 rpm'",
    "max_speed_kmh": "'0-' || p_size || ' km/h'",
    "operating_weight_kg": "(p_size + 1) || ',250 kg'",
    "turning_radius_inner_outer_mm": "p_size || '/' || (p_size + 7) || ' mm'",
    "width_mm": "p_size || '/' || (p_size + 1) || ' mm'",
    "length_mm": "p_size || ' to ' || (p_size * 2) || ' mm'",
    "height_mm": "CASE WHEN p_size < 0 THEN '1 mm' END",
    "battery_capacity": "p_size || '–' || (p_size + 3) || ' kWh'",
}
METRIC_SQL = {
    "horsepower": "CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'PROMO' THEN 0 ELSE p_size END",
    "lift_capacity": "round(p_retailprice, 2)",
    "lift_height": "p_size + 100",
    "telescopic_length": "(p_size + 0.5::DOUBLE) * 1000",
    "aux_flow": "p_size",
    "aux_pressure": "p_size + 3.25::DOUBLE",
    "max_breakout_force": "NULL",
    "max_tow_force": "p_size * 100",
    "max_torque": "p_size",
    "max_speed": "p_size",
    "operating_weight": "(p_size + 1) * 1000 + 250",
    "turning_radius_inner": "p_size",
    "turning_radius_outer": "p_size + 7",
    "width": "p_size",
    "length": "p_size * 2",
    "height": "NULL",
    "battery_capacity": "p_size + 3",
}


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")

    def words(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    texts = {
        "horsepower": F.when(F.col("p_type") == "ECONOMY", "").when(F.col("p_type") == "PROMO", "0 hp")
        .otherwise(words(size, " hp")),
        "lift_capacity_kg": words(F.format_number("p_retailprice", 2), " kg"),
        "lift_height_mm": words(size, "-", size + 100, " mm"),
        "telescopic_length_mm": words(size, ".5 m"),
        "aux_hydraulic_flow_pressure_l_min_mpa": words(size, " L/min / ", size + 3, ".25 MPa"),
        "max_breakout_force_kgf": F.col("p_name"),
        "max_tow_force_kgf": words(size, "00 kgf"),
        "max_torque_nm_rpm": words(size, " N·m @ 2400 rpm"),
        "max_speed_kmh": words("0-", size, " km/h"),
        "operating_weight_kg": words(size + 1, ",250 kg"),
        "turning_radius_inner_outer_mm": words(size, "/", size + 7, " mm"),
        "width_mm": words(size, "/", size + 1, " mm"),
        "length_mm": words(size, " to ", size * 2, " mm"),
        "height_mm": F.when(size < 0, "1 mm"),
        "battery_capacity": words(size, "–", size + 3, " kWh"),
    }
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_name", "p_type", *[c.alias(name) for name, c in texts.items()]
    )


@query("metric_values", " UNION ALL ".join(
    f"SELECT p_partkey, '{name}' AS metric, CAST({METRIC_SQL[name]} AS DOUBLE) AS value FROM part" for name, *_ in METRICS
))
def metric_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.metric_values(models(spark, sf_dir), ["p_partkey"])


@query("rewrite_units", f"""
    SELECT p_partkey, {_shown_sql(_us_sql('p_size', 'length'))} || '-' || {_shown_sql(_us_sql('(p_size + 100)', 'length'))}
               || ' in' AS lift_height,
           {_shown_sql(_us_sql('((p_size + 0.5::DOUBLE) * 1000)', 'length'))} || ' in' AS telescopic_length,
           {_shown_sql(_us_sql('p_retailprice', 'weight'))} || ' lb' AS lift_capacity,
           '0-' || {_shown_sql(_us_sql('p_size', 'speed'))} || ' mph' AS speed,
           {_shown_sql(_us_sql('(p_size * 100)', 'force'))} || ' lbf' AS tow_force,
           CASE p_type WHEN 'ECONOMY' THEN '-' WHEN 'PROMO' THEN '0 hp' ELSE p_size || ' hp' END AS horsepower,
           p_name AS breakout_force
    FROM part
""")
def rewrite_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rewritten(column: str, family: str | None, name: str):
        return numbers.rewrite_units(F.col(column), family).alias(name)

    return models(spark, sf_dir).select(
        "p_partkey",
        rewritten("lift_height_mm", "length", "lift_height"),
        rewritten("telescopic_length_mm", "length", "telescopic_length"),
        rewritten("lift_capacity_kg", "weight", "lift_capacity"),
        rewritten("max_speed_kmh", "speed", "speed"),
        rewritten("max_tow_force_kgf", "force", "tow_force"),
        rewritten("horsepower", None, "horsepower"),
        rewritten("max_breakout_force_kgf", "force", "breakout_force"),
    )


# Parts with a model name, a series and a powertrain.
FLAGS_SQL = """
    SELECT p_partkey, p_brand AS brand, p_type AS series, p_retailprice, p_size,
           CASE p_type WHEN 'SMALL' THEN 'Electric drive' WHEN 'PROMO' THEN '' ELSE 'Diesel' END AS powertrain,
           regexp_replace(p_brand || ' ' || p_name || CASE WHEN p_size > 45 THEN ' Series' ELSE '' END,
                          '^(Brand#1|Brand#2)\\s+', '') AS label,
           p_size > 45 AS is_series_summary, p_type = 'SMALL' AS is_electric
    FROM part
""".replace("\\\\", "\\")


def flagged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("brand"), kind.alias("series"), "p_retailprice", "p_size",
        F.when(kind == "SMALL", "Electric drive").when(kind == "PROMO", "").otherwise("Diesel").alias("powertrain"),
        F.concat(
            "p_brand", F.lit(" "), "p_name", F.when(F.col("p_size") > 45, " Series").otherwise("")
        ).alias("model"),
    )
    return compare.with_row_flags(rows, "model", "powertrain", ["Brand#1", "Brand#2"]).drop("model")


@query("row_flags_part", FLAGS_SQL)
def row_flags_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged_parts(spark, sf_dir)


@query("split_groups", f"""
    SELECT brand, CASE WHEN is_series_summary THEN 'summary' WHEN is_electric THEN 'electric' ELSE 'combustion' END
           AS group_kind, count(*) AS n FROM ({FLAGS_SQL}) GROUP BY ALL
""")
def split_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.with_group_kind(flagged_parts(spark, sf_dir)).groupBy("brand", "group_kind").agg(
        F.count("*").alias("n")
    )


@query("curated_supplier", """
    SELECT 'nation ' || s_nationkey AS brand, s_name AS model, CASE WHEN s_acctbal > 5000 THEN 'large account' ELSE '' END
           AS series
    FROM supplier WHERE s_acctbal >= 0 AND s_nationkey IN (1, 3, 5, 7, 11, 13, 17)
""")
def curated_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {
        "brand": F.concat(F.lit("nation "), F.col("s_nationkey")),
        "model": F.when(F.col("s_acctbal") < 0, "  ").otherwise(F.col("s_name")),
        "series": F.when(F.col("s_acctbal") > 5000, " large   account"),
    }
    brands = [f"nation {n}" for n in (1, 3, 5, 7, 11, 13, 17)]
    return compare.curated(table(spark, sf_dir, "supplier"), columns, "model", "brand", brands)


SERIES_SQL = "CASE WHEN p_type = 'PROMO' THEN p_name ELSE 'class ' || p_size || ' ' || p_type END"


def series_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(
        F.concat(F.lit("class "), "p_size", F.lit(" "), "p_type")
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("brand"), series.alias("series"), F.col("p_name").alias("model")
    )


_SERIES_KEY_SQL = r"coalesce(TRY_CAST(nullif(regexp_extract(series, '(\d+)', 1), '') AS BIGINT), 9999)"


@query("natural_sort", f"""
    SELECT p_partkey, series, row_number() OVER (ORDER BY {_SERIES_KEY_SQL}, series, p_partkey) AS position
    FROM (SELECT p_partkey, {SERIES_SQL} AS series FROM part)
""")
def natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = series_parts(spark, sf_dir).select("p_partkey", "series")
    return compare.with_sort_position(parts, [*compare.series_order("series"), F.col("p_partkey").asc()])


@query("brand_sort", f"""
    SELECT p_partkey, brand, row_number() OVER (ORDER BY CASE brand WHEN 'Brand#7' THEN 0 WHEN 'Brand#12' THEN 1
               WHEN 'Brand#3' THEN 2 WHEN 'Brand#25' THEN 3 WHEN 'Brand#1' THEN 4 ELSE 999 END, brand,
               {_SERIES_KEY_SQL}, series, model, p_partkey) AS position
    FROM (SELECT p_partkey, p_brand AS brand, p_name AS model, {SERIES_SQL} AS series FROM part)
""")
def brand_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [*compare.brand_order("brand", "series", "model", BRANDS), F.col("p_partkey").asc()]
    return compare.with_sort_position(series_parts(spark, sf_dir), order).select("p_partkey", "brand", "position")


@query("arg_extremes", """
    WITH m AS (SELECT p_partkey, p_brand, CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'PROMO' THEN 0.0::DOUBLE
                      ELSE CAST(p_size AS DOUBLE) END AS horsepower FROM part)
    SELECT p_brand, 'most' AS which, p_partkey, horsepower FROM m
    QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY coalesce(nullif(horsepower, 0), -1) DESC, p_partkey) = 1
    UNION ALL
    SELECT p_brand, 'least', p_partkey, horsepower FROM m
    QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY coalesce(nullif(horsepower, 0), 1e9), p_partkey) = 1
""")
def arg_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = models(spark, sf_dir).select(
        "p_brand", "p_partkey", numbers.parse_measure(F.col("horsepower"), "hp").alias("horsepower")
    )
    most, least = (
        compare.arg_extreme(rows, ["p_brand"], "horsepower", ["p_partkey"], ["p_partkey"], largest)
        .withColumn("which", F.lit("most" if largest else "least"))
        for largest in (True, False)
    )
    return most.unionByName(least)


@query("brand_summary", f"""
    SELECT brand, count(*) FILTER (WHERE NOT is_series_summary) AS n_models,
           count(*) FILTER (WHERE NOT is_series_summary AND is_electric) AS n_electric,
           coalesce(array_to_string(list_sort(list(DISTINCT series) FILTER (WHERE NOT is_series_summary)), ', '), '')
               AS series_names,
           coalesce(array_to_string(list_sort(list(DISTINCT powertrain)
               FILTER (WHERE NOT is_series_summary AND powertrain <> '')), ', '), '') AS powertrains,
           CAST(CASE brand WHEN 'Brand#7' THEN 0 WHEN 'Brand#12' THEN 1 WHEN 'Brand#3' THEN 2 WHEN 'Brand#25' THEN 3
                WHEN 'Brand#1' THEN 4 ELSE 999 END AS INTEGER) AS brand_rank
    FROM ({FLAGS_SQL}) GROUP BY brand
""")
def brand_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.brand_summary(flagged_parts(spark, sf_dir), "brand", "series", "powertrain", BRANDS)


@query("brand_series", f"""
    SELECT brand, series, count(*) AS n_models,
           min(coalesce(TRY_CAST(regexp_extract(series, '[0-9]+') AS BIGINT), 9999)) AS series_number
    FROM ({FLAGS_SQL}) WHERE NOT is_series_summary AND series <> '' GROUP BY brand, series
""")
def brand_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.brand_series(flagged_parts(spark, sf_dir), "brand", "series")


# Lines as measured values of brands: four metrics, some zero, some missing.
STEPS = [("quantity", 1.0), ("price", 100.0), ("discount", 0.02), ("tax", 1.0)]
LINE_METRICS_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand AS brand, l_returnflag = 'R' AS is_electric,
           unnest(['quantity', 'price', 'discount', 'tax']) AS metric,
           unnest([CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN NULL ELSE l_quantity END,
                   l_extendedprice, l_discount, l_tax * 100]) AS value
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def line_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand")),
        F.col("l_partkey") == F.col("p_partkey"),
    )
    unread = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R")
    values = {
        "quantity": F.when(~unread, F.col("l_quantity")),
        "price": F.col("l_extendedprice"),
        "discount": F.col("l_discount"),
        "tax": F.col("l_tax") * 100,
    }
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in values.items()])
    return lines.select(*LINE_KEY, "brand", (F.col("l_returnflag") == "R").alias("is_electric"), F.inline(cells))


@query("range_stats", f"""
    SELECT metric, low, high, {', '.join(f'low + (high - low) * {i} / 4 AS tick_{i}' for i in range(5))}
    FROM (SELECT metric, min(value) AS low, CASE WHEN min(value) = max(value) THEN min(value) + 1 ELSE max(value) END
          AS high FROM ({LINE_METRICS_SQL}) GROUP BY metric)
""")
def range_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.range_stats(line_metrics(spark, sf_dir))


@query("range_positions", f"""
    SELECT metric, l_orderkey, l_linenumber, l_partkey, l_suppkey,
           (value - min(value) OVER m) / (max(value) OVER m - min(value) OVER m) AS relative,
           row_number() OVER (PARTITION BY metric ORDER BY value, brand, l_orderkey, l_linenumber, l_partkey, l_suppkey)
               AS order_index
    FROM ({LINE_METRICS_SQL}) WHERE value IS NOT NULL WINDOW m AS (PARTITION BY metric)
""")
def range_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c).asc() for c in ("value", "brand", *LINE_KEY)]
    placed = compare.range_positions(line_metrics(spark, sf_dir).drop("is_electric"), order, [m for m, _ in STEPS])
    return placed.select("metric", *LINE_KEY, "relative", "order_index")


HISTOGRAM_SQL = f"""
    SELECT metric, brand, step, start, n_bins, value, l_orderkey, l_linenumber, l_partkey, l_suppkey,
           greatest(0, least(CAST(floor((value - start) / step) AS BIGINT), n_bins - 1)) AS bin_no
    FROM (SELECT *, CAST(greatest(1, round((CASE WHEN stop <= start THEN start + step ELSE stop END - start) / step))
                         AS BIGINT) AS n_bins
          FROM (SELECT *, floor(min(value) OVER m / step) * step AS start, ceil(max(value) OVER m / step) * step AS stop
                FROM ({LINE_METRICS_SQL}) JOIN (VALUES ('quantity', 1.0::DOUBLE), ('price', 100.0::DOUBLE),
                    ('discount', 0.02::DOUBLE), ('tax', 1.0::DOUBLE)) AS s(metric, step) USING (metric)
                WHERE value IS NOT NULL AND value <> 0 WINDOW m AS (PARTITION BY metric)))
"""


@query("histogram_qty", f"""
    SELECT metric, bin_no, start + bin_no * step AS bin_start, n_bins, step, brand, count(*) AS n
    FROM ({HISTOGRAM_SQL}) GROUP BY ALL
""")
def histogram_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.histogram(line_metrics(spark, sf_dir), STEPS)


@query("hist_stacked", f"""
    WITH counted AS (SELECT metric, bin_no, brand, count(*) AS n FROM ({HISTOGRAM_SQL}) GROUP BY ALL),
    every AS (SELECT metric, start, step, unnest(range(n_bins))::BIGINT AS bin_no
              FROM (SELECT DISTINCT metric, start, step, n_bins FROM ({HISTOGRAM_SQL})))
    SELECT metric, bin_no, start + bin_no * step AS bin_start, brand, coalesce(n, 0) AS n,
           CAST(coalesce(sum(n) OVER (PARTITION BY metric, bin_no), 0) AS BIGINT) AS bin_total,
           CAST(coalesce(sum(n) OVER (PARTITION BY metric, bin_no ORDER BY CASE brand WHEN 'Brand#7' THEN 0
               WHEN 'Brand#12' THEN 1 WHEN 'Brand#3' THEN 2 WHEN 'Brand#25' THEN 3 WHEN 'Brand#1' THEN 4 ELSE 999 END,
               brand ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS running_total
    FROM every LEFT JOIN counted USING (metric, bin_no)
""")
def hist_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.stacked_bins(compare.histogram(line_metrics(spark, sf_dir), STEPS), BRANDS)


@query("excluded_counts", f"""
    SELECT metric, count(*) FILTER (WHERE value <> 0) AS n_included,
           count(*) FILTER (WHERE value IS NULL OR value = 0) AS n_excluded,
           count(*) FILTER (WHERE value = 0) AS n_zero,
           count(*) FILTER (WHERE (value IS NULL OR value = 0) AND is_electric) AS n_electric
    FROM ({LINE_METRICS_SQL}) GROUP BY metric
""")
def excluded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.excluded_counts(line_metrics(spark, sf_dir))


@query("bin_members", f"""
    SELECT metric, bin_no, brand, l_orderkey, l_linenumber, l_partkey, l_suppkey, value,
           row_number() OVER (PARTITION BY metric, bin_no, brand
                              ORDER BY value DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS place
    FROM ({HISTOGRAM_SQL})
""")
def bin_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.bin_members(line_metrics(spark, sf_dir).drop("is_electric"), STEPS, LINE_KEY)


@query("visible_rows", """
    SELECT p_partkey, p_brand, CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'PROMO' THEN 0.0::DOUBLE
           ELSE CAST(p_size AS DOUBLE) END AS horsepower
    FROM part WHERE p_brand IN ('Brand#7', 'Brand#12', 'Brand#3', 'Brand#25', 'Brand#1')
         AND (horsepower BETWEEN 10 AND 30 OR horsepower IS NULL)
""")
def visible_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = models(spark, sf_dir).select(
        "p_partkey", "p_brand", numbers.parse_measure(F.col("horsepower"), "hp").alias("horsepower")
    )
    return compare.visible(rows, "p_brand", BRANDS, "horsepower", 30, 10)


@query("filter_bounds", """
    SELECT CAST(trunc(min(value)) AS BIGINT) AS low, CAST(trunc(max(value)) AS BIGINT) AS high
    FROM (SELECT l_extendedprice / 7 AS value FROM lineitem)
""")
def filter_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_extendedprice") / 7).alias("value"))
    return compare.filter_bounds(lines, "value")


@query("slug_names", """
    SELECT p_partkey, trim(regexp_replace(lower(p_brand || ' / ' || p_name || ' (' || p_type || ')'), '[^a-z0-9]+', '-', 'g'),
                           '-') AS slug,
           replace(lower(p_name), ' ', '-') AS short_slug
    FROM part
""")
def slug_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_brand", F.lit(" / "), "p_name", F.lit(" ("), "p_type", F.lit(")"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.slug(name).alias("slug"), text.spaced_slug(F.col("p_name")).alias("short_slug")
    )


@query("events_timeline", """
    SELECT CAST(ts AS DATE) AS period, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL
""")
def events_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.timeline(table(spark, sf_dir, "events"), "ts", "event_type", "value")


@query("top_parts", """
    SELECT l_partkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM lineitem GROUP BY l_partkey ORDER BY revenue DESC, l_partkey LIMIT 10
""")
def top_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    parts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(revenue.alias("revenue"))
    return compare.top_k(parts, [F.col("revenue").desc(), F.col("l_partkey").asc()], 10)


@query("top_per_brand", """
    SELECT p_brand, p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_brand
           ORDER BY p_retailprice DESC, p_partkey) AS place
    FROM part QUALIFY place <= 3
""")
def top_per_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice")
    order = [F.col("p_retailprice").desc(), F.col("p_partkey").asc()]
    return compare.top_k_per_group(parts, ["p_brand"], order, 3)


def _gappy_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part prices and sizes with NULL, NaN and zero among them."""
    key = F.col("p_partkey")

    def gappy(value):
        nan = F.lit(float("nan"))
        return F.when(key % 5 == 0, F.lit(None)).when(key % 7 == 0, nan).when(key % 11 == 0, 0.0).otherwise(value)

    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand"), (F.col("p_size") > 25).alias("is_electric"),
        F.inline(F.array(
            F.struct(F.lit("price").alias("metric"), gappy(F.col("p_retailprice")).alias("value")),
            F.struct(F.lit("size").alias("metric"), gappy(F.col("p_size").cast("double")).alias("value")),
        )),
    )


_GAPPY = """
    gappy AS (
        SELECT metric, is_electric, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN 'NaN'::DOUBLE
                    WHEN p_partkey % 11 = 0 THEN 0.0 ELSE v END AS value
        FROM (SELECT p_partkey, p_size > 25 AS is_electric, unnest(['price', 'size']) AS metric,
                     unnest([p_retailprice, CAST(p_size AS DOUBLE)]) AS v FROM part)),
    known AS (SELECT * FROM gappy WHERE value IS NOT NULL AND NOT isnan(value))"""


@query("range_stats_nan", f"""
    WITH {_GAPPY}, s AS (
        SELECT metric, min(value) AS low, CASE WHEN min(value) = max(value) THEN min(value) + 1 ELSE max(value) END AS high
        FROM known GROUP BY metric)
    SELECT *, {', '.join(f'low + (high - low) * {i} / 4 AS tick_{i}' for i in range(5))} FROM s
""")
def range_stats_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.range_stats(_gappy_metrics(spark, sf_dir))


@query("excluded_total", f"""
    WITH {_GAPPY}
    SELECT metric, count(*) AS n_rows, count(*) FILTER (WHERE used) AS n_included, count(*) FILTER (WHERE NOT used) AS n_excluded,
           count(*) FILTER (WHERE value = 0) AS n_zero, count(*) FILTER (WHERE NOT used AND is_electric) AS n_electric,
           count(*) FILTER (WHERE used) AS n_binned
    FROM (SELECT *, coalesce(value IS NOT NULL AND NOT isnan(value) AND value <> 0, false) AS used FROM gappy) GROUP BY metric
""")
def excluded_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a histogram takes and leaves out, next to the rows in its bins; a metric's step is given twice."""
    metrics = _gappy_metrics(spark, sf_dir)
    bins = compare.histogram(metrics, [("price", 100.0), ("size", 5.0), ("price", 100.0)])
    binned = bins.groupBy("metric").agg(F.sum("n").alias("n_binned"))
    counts = compare.excluded_counts(metrics)
    return counts.join(binned, "metric").withColumn("n_rows", F.col("n_included") + F.col("n_excluded"))


@query("filter_bounds_nan", f"""
    WITH {_GAPPY} SELECT CAST(trunc(min(value)) AS BIGINT) AS low, CAST(trunc(max(value)) AS BIGINT) AS high FROM known
    WHERE metric = 'price'
""")
def filter_bounds_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.filter_bounds(_gappy_metrics(spark, sf_dir).filter(F.col("metric") == "price"), "value")
