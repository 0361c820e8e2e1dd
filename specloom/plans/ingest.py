"""Grid, header, type and re-import queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions import text
from specloom.operators import header
from specloom.plans.registry import query, table
from specloom.session import cut_lineage, ensure_checkpoint_dir
from specloom.sources import sheets
from specloom.sources.tables import read_table

PART_COLUMNS = ["p_name", "p_brand", "p_size", "p_retailprice"]


def double_sql(v: str) -> str:
    return f"CASE WHEN {v} = floor({v}) THEN CAST(CAST({v} AS BIGINT) AS VARCHAR) ELSE CAST({v} AS VARCHAR) END"


def part_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as data cells, one sheet per part type."""
    return sheets.to_grid(
        table(spark, sf_dir, "part").select("p_partkey", "p_type", *PART_COLUMNS),
        F.col("p_type"),
        [F.col("p_partkey").asc()],
        PART_COLUMNS,
        F.lit("tables/part"),
    )


PART_GRID_SQL = f"""
    SELECT 'tables/part' AS raw_path, p_type AS sheet_name,
           row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) + 1 AS row_no,
           CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS col_no,
           unnest(['p_name', 'p_brand', 'p_size', 'p_retailprice']) AS column_name,
           unnest([p_name, p_brand, CAST(p_size AS VARCHAR), {double_sql('p_retailprice')}]) AS value
    FROM part
"""


@query("grid_part", f"SELECT raw_path, sheet_name, row_no, col_no, value FROM ({PART_GRID_SQL})")
def grid_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_grid(spark, sf_dir)


def order_header_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two header rows per order: one column a line number, so at most seven wide.

    The upper row has gaps, like merged cells.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("sheet_name"), F.col("l_linenumber").alias("col_no"),
        "l_returnflag", "l_linestatus",
    )
    # the lines of an order are brought together once, for this and for all that is done by sheet; shuffled they are
    # much smaller than sorted, so the number of partitions is given and they are not merged by that size
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = lines.repartition(parts, "sheet_name").groupBy("sheet_name", "col_no").agg(
        F.min("l_returnflag").alias("flag"), F.min("l_linestatus").alias("status")
    )
    upper = F.when(F.col("col_no").isin(1, 3, 6), F.col("flag"))
    cells = F.array(
        F.struct(F.lit(1).cast("bigint").alias("row_no"), upper.alias("value")),
        F.struct(F.lit(2).cast("bigint").alias("row_no"), F.col("status").alias("value")),
    )
    return columns.select(F.lit("tables/lineitem").alias("raw_path"), "sheet_name", "col_no", F.inline(cells))


ORDER_HEADER_SQL = """
    SELECT 'tables/lineitem' AS raw_path, CAST(l_orderkey AS VARCHAR) AS sheet_name,
           l_linenumber AS col_no, concat_ws('_', last_value(upper_cell IGNORE NULLS) OVER (
               PARTITION BY l_orderkey ORDER BY l_linenumber
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), status) AS header
    FROM (SELECT l_orderkey, l_linenumber, min(l_linestatus) AS status,
                 CASE WHEN l_linenumber IN (1, 3, 6) THEN min(l_returnflag) END AS upper_cell
          FROM lineitem GROUP BY l_orderkey, l_linenumber)
"""


@query("header_fill", ORDER_HEADER_SQL)
def header_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header.build_header(order_header_grid(spark, sf_dir), header_rows=2, placed=True)


@query("dup_names", f"""
    SELECT raw_path, sheet_name, col_no,
           CASE WHEN seen > 1 THEN header || '_' || seen ELSE header END AS column_name
    FROM (SELECT *, row_number() OVER (PARTITION BY sheet_name, header ORDER BY col_no) AS seen
          FROM ({ORDER_HEADER_SQL}))
""")
def dup_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = header.build_header(order_header_grid(spark, sf_dir), header_rows=2, placed=True)
    return header.unique_names(header.clean_names(headers)).drop("header")


@query("clean_ident", r"""
    SELECT p_partkey, CASE WHEN name = '' THEN 'col' ELSE name END AS column_name
    FROM (SELECT p_partkey, trim(regexp_replace(
              '  ' || p_name || ' / (' || p_brand || ') : [' || p_type || '] - ' || p_size || '. ',
              '[\s/\\()\[\]{}:;,.\-_]+', '_', 'g'), '_') AS name FROM part)
""")
def clean_ident(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(
        F.lit("  "), "p_name", F.lit(" / ("), "p_brand", F.lit(") : ["), "p_type", F.lit("] - "), "p_size", F.lit(". ")
    )
    named = table(spark, sf_dir, "part").select("p_partkey", raw.alias("header"))
    return header.clean_names(named).select("p_partkey", "column_name")


@query("blank_rows", r"""
    SELECT CAST(doc_id AS VARCHAR) AS sheet_name, row_no, col_no, value
    FROM (SELECT doc_id, row_no, unnest([1, 2])::INTEGER AS col_no, unnest([line, NULL]) AS value, line
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                       unnest(range(1, len(string_split(text, chr(10))) + 1)) AS row_no FROM documents))
    WHERE regexp_matches(line, '\S')
""")
def blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(
        F.lit("tables/documents").alias("raw_path"),
        F.col("doc_id").cast("string").alias("sheet_name"),
        F.posexplode(F.split("text", "\n")).alias("_pos", "line"),
    )
    rows = lines.select(
        "raw_path", "sheet_name", (F.col("_pos") + 1).cast("bigint").alias("row_no"),
        F.array(F.col("line"), F.lit(None)).alias("cells"),
    )
    return sheets.cells_of(sheets.filled_rows(rows)).drop("raw_path")


def _named_part_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(c) for c in PART_COLUMNS])
    return part_grid(spark, sf_dir).withColumn("column_name", F.get(names, F.col("col_no") - 1))


@query("infer_types_part", rf"""
    SELECT raw_path, sheet_name, column_name,
           CASE WHEN count(value) = 0 THEN 'VARCHAR'
                WHEN count(value) = count(*) FILTER (WHERE regexp_full_match(value, '(?i)true|false')) THEN 'BOOLEAN'
                WHEN count(value) = count(*) FILTER (WHERE CAST(TRY_CAST(value AS BIGINT) AS VARCHAR) = value) THEN 'BIGINT'
                WHEN count(value) = count(*) FILTER (WHERE CAST(TRY_CAST(value AS BIGINT) AS VARCHAR) = value
                     OR regexp_full_match(value, '[+-]?(\d+\.\d*|\.\d+)')) THEN 'DOUBLE'
                ELSE 'VARCHAR' END AS data_type
    FROM ({PART_GRID_SQL}) GROUP BY raw_path, sheet_name, column_name
""")
def infer_types_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header.infer_types(_named_part_cells(spark, sf_dir))


IMPORT_HEADER = ["Part Name", "Brand", "Size", "Retail Price"]
_BLANK = "p_size % 10 = 0"


@query("infer_types_long", """
    SELECT 'tables/orders' AS raw_path, o_orderpriority AS sheet_name, column_name,
           CASE column_name WHEN 'long' THEN 'BIGINT' WHEN 'share' THEN 'DOUBLE' ELSE 'VARCHAR' END AS data_type
    FROM (SELECT DISTINCT o_orderpriority FROM orders), (SELECT unnest(['long', 'beyond', 'code', 'share']) AS column_name)
""")
def infer_types_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers of 19 digits, longer ones, codes with leading zeros, and numbers with a part."""
    key = F.col("o_orderkey")
    cells = table(spark, sf_dir, "orders").select(
        F.lit("tables/orders").alias("raw_path"), F.col("o_orderpriority").alias("sheet_name"),
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("column_name"), value.alias("value")) for name, value in (
                ("long", (F.lit(9223372036854775807) - key).cast("string")),
                ("beyond", F.concat(F.lit("9223372036854775808"), key)),
                ("code", F.concat(F.lit("0"), key)),
                ("share", F.concat(key, F.lit(".5"))),
            )
        ])),
    )
    return header.infer_types(cells)


@query("import_table", f"""
    WITH numbered AS (
        SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) + 1 AS row_no FROM part)
    SELECT 'tables/part' AS raw_path, p_type AS sheet_name, row_no,
           CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS col_no,
           unnest(['Part_Name', 'Brand', 'Size', 'Retail_Price']) AS column_name,
           unnest(['VARCHAR', 'VARCHAR', 'BIGINT', 'DOUBLE']) AS data_type,
           unnest([p_name, p_brand, CAST(p_size AS VARCHAR), {double_sql('p_retailprice')}]) AS text_value,
           unnest([NULL, NULL, CAST(p_size AS BIGINT), NULL]) AS integer_value,
           unnest([NULL, NULL, CAST(p_size AS DOUBLE), p_retailprice]) AS number_value,
           NULL::BOOLEAN AS truth_value
    FROM numbered WHERE NOT ({_BLANK})
""")
def import_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole import: header row, names, blank rows out, types, typed values, row numbers."""
    parts = table(spark, sf_dir, "part")
    blank = F.expr(_BLANK)
    rows = parts.select("p_partkey", "p_type", *[F.when(~blank, F.col(c)).alias(c) for c in PART_COLUMNS])
    data = sheets.to_grid(
        rows, F.col("p_type"), [F.col("p_partkey").asc()], PART_COLUMNS, F.lit("tables/part"), skip_blank=True
    )
    top = parts.select("p_type").distinct().select(
        F.lit("tables/part").alias("raw_path"), F.col("p_type").alias("sheet_name"), F.lit(1).cast("bigint").alias("row_no"),
        F.posexplode(F.array(*[F.lit(h) for h in IMPORT_HEADER])).alias("_pos", "value"),
    ).select("raw_path", "sheet_name", "row_no", (F.col("_pos") + 1).alias("col_no"), "value")
    names = cut_lineage(header.unique_names(header.clean_names(header.build_header(top, 1))).drop("header"))
    return header.typed_cells(data.join(names, ["raw_path", "sheet_name", "col_no"]))


SHEET_ROWS = 500


@query("import_files", f"""
    WITH numbered AS (
        SELECT *, CAST(p_partkey // {SHEET_ROWS} AS VARCHAR) AS sheet_name,
               row_number() OVER (PARTITION BY p_partkey // {SHEET_ROWS} ORDER BY p_partkey) + 1 AS row_no FROM part)
    SELECT sheet_name, row_no, CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS col_no,
           unnest(['Part_Name', 'Brand', 'Size', 'Retail_Price']) AS column_name,
           unnest(['VARCHAR', 'VARCHAR', 'BIGINT', 'DOUBLE']) AS data_type,
           unnest([p_name, p_brand, CAST(p_size AS VARCHAR), {double_sql('p_retailprice')}]) AS text_value,
           unnest([NULL, NULL, CAST(p_size AS BIGINT), NULL]) AS integer_value,
           unnest([NULL, NULL, CAST(p_size AS DOUBLE), p_retailprice]) AS number_value,
           NULL::BOOLEAN AS truth_value
    FROM numbered WHERE NOT ({_BLANK})
""")
def import_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole import from files: parts written as sheet files of a bounded length, read back as packed rows."""
    folder = _fresh_folder(spark)
    blank = F.expr(_BLANK)
    cells = [F.col("p_name"), F.col("p_brand"), F.col("p_size").cast("string"), text.double_text(F.col("p_retailprice"))]
    sheet = F.floor(F.col("p_partkey") / SHEET_ROWS)
    files = table(spark, sf_dir, "part").select(
        sheet.alias("sheet"), "p_partkey", *[F.when(~blank, c).alias(h) for c, h in zip(cells, IMPORT_HEADER)]
    )
    files.repartition("sheet").sortWithinPartitions("sheet", "p_partkey").drop("p_partkey").write.partitionBy("sheet").csv(
        folder, header=True, nullValue="", emptyValue=""
    )
    rows = sheets.read_rows(
        spark, f"{folder}/*/*.csv", folder, sheet=lambda path: F.regexp_extract(path, "/sheet=([0-9]+)/", 1)
    )
    return header.import_rows(rows).drop("raw_path")


def _fresh_folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"


@query("sheets_round_trip", f"""
    SELECT p_type AS sheet, CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, CAST(p_size AS VARCHAR) AS p_size,
           {double_sql('p_retailprice')} AS p_retailprice FROM part
""")
def sheets_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as sheets and read back."""
    folder = _fresh_folder(spark)
    columns = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
    parts = table(spark, sf_dir, "part")
    kinds = dict(parts.dtypes)
    sheets.write_sheets_csv(
        parts.select(F.col("p_type").alias("sheet"), *[text.to_text(F.col(c), kinds[c]).alias(c) for c in columns]),
        folder, "sheet",
    )
    return read_table(spark, folder, "csv", ", ".join(f"{c} string" for c in [*columns, "sheet"])).select("sheet", *columns)


@query("report_csv_bom", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def report_csv_bom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report file that begins with a byte-order mark."""
    folder = _fresh_folder(spark)
    body = table(spark, sf_dir, "nation").select(
        F.concat_ws(",", F.col("n_nationkey").cast("string"), F.concat(F.lit('"'), "n_name", F.lit('"'))).alias("value")
    )
    # each part is a report of its own, with its own mark and header
    body.select(F.concat(F.lit("\ufeffn_nationkey,n_name\n"), "value").alias("value")).write.text(folder)
    return sheets.read_report_csv(spark, folder).filter("n_nationkey <> 'n_nationkey' and n_name is not null").select(
        F.regexp_replace("n_nationkey", "\ufeff", "").alias("n_nationkey"), "n_name"
    ).filter("n_nationkey <> 'n_nationkey'")


@query("csv_table", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, {double_sql('o_totalprice')} AS o_totalprice FROM orders
""")
def csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as CSV and read in splits; all columns stay text."""
    folder = _fresh_folder(spark)
    table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", text.double_text(F.col("o_totalprice")).alias("o_totalprice")
    ).write.csv(folder, header=True)
    return read_table(spark, folder, "csv")


@query("manifest", f"""
    SELECT raw_path, sheet_name, 'p_name, p_brand, p_size, p_retailprice' AS columns,
           count(DISTINCT row_no) AS row_count
    FROM ({PART_GRID_SQL}) GROUP BY raw_path, sheet_name
""")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    rows = parts.select(
        F.lit("tables/part").alias("raw_path"), F.col("p_type").alias("sheet_name"), F.array(*PART_COLUMNS).alias("cells")
    )
    names = rows.select(*header.SHEET).distinct().select(
        *header.SHEET, F.posexplode(F.array(*[F.lit(c) for c in PART_COLUMNS])).alias("_pos", "column_name")
    ).withColumn("col_no", F.col("_pos") + 1)
    return header.rows_manifest(rows, names).drop("loaded_at")


@query("to_text_price", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {double_sql('l_extendedprice')} AS price_text,
           {double_sql('l_quantity')} AS quantity_text,
           {double_sql('(l_extendedprice * l_quantity * 16)')} AS large_text,
           {double_sql('(l_tax / 1024)')} AS small_text,
           strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS ship_text
    FROM lineitem
""")
def to_text_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        text.double_text(F.col("l_extendedprice")).alias("price_text"),
        text.double_text(F.col("l_quantity")).alias("quantity_text"),
        text.double_text(F.col("l_extendedprice") * F.col("l_quantity") * 16).alias("large_text"),
        text.double_text(F.col("l_tax") / 1024).alias("small_text"),
        text.timestamp_text(F.col("l_shipdate")).alias("ship_text"),
    )


@query("provenance_part", """
    SELECT p_partkey, 'part.parquet' AS raw_path, p_type AS sheet_name,
           row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) + 1 AS row_no FROM part
""")
def provenance_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        text.relative_path(F.col("_metadata.file_path"), sf_dir).alias("raw_path"),
        F.col("p_type").alias("sheet_name"),
    )
    return sheets.with_row_numbers(rows, ["raw_path", "sheet_name"], [F.col("p_partkey").asc()])


@query("reimport", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN -1.0 * o_totalprice
           ELSE o_totalprice END AS o_totalprice FROM orders
""")
def reimport(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = orders.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") * -1.0)
    return sheets.replace_source(new, orders, "o_orderstatus")


@query("reimport_files", """
    WITH old AS (
        SELECT o_orderkey, o_totalprice, o_orderstatus AS sheet,
               CASE o_orderpriority WHEN '2-HIGH' THEN '1-URGENT-2' ELSE o_orderpriority END AS source FROM orders)
    SELECT o_orderkey, sheet, source, CASE source WHEN '1-URGENT' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM old WHERE source <> '1-URGENT' OR sheet <> 'O'
""")
def reimport_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source imported again on storage, with one sheet gone; another source's name begins with its name."""
    folder = _fresh_folder(spark)
    source = F.when(F.col("o_orderpriority") == "2-HIGH", "1-URGENT-2").otherwise(F.col("o_orderpriority"))
    old = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("sheet"), source.alias("source")
    )
    sheets.overwrite_sources(old, folder, "source")
    new = old.filter((F.col("source") == "1-URGENT") & (F.col("sheet") != "O"))
    sheets.overwrite_sources(new.withColumn("o_totalprice", -F.col("o_totalprice")), folder, "source")
    return spark.read.schema(old.schema).parquet(folder)


@query("grid_rows_from_file", f"""
    SELECT row_no, CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS col_no,
           unnest([p_name, p_brand, CAST(p_size AS VARCHAR), {double_sql('p_retailprice')}]) AS value
    FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) + 1 AS row_no FROM part)
""")
def grid_rows_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file's rows as cells, numbered by their place in the file."""
    parts = table(spark, sf_dir, "part")
    kinds = dict(parts.dtypes)
    rows = sheets.file_row_numbers(parts).select(
        "raw_path", F.lit("part").alias("sheet_name"), "row_no",
        F.array(*[text.to_text(F.col(c), kinds[c]) for c in PART_COLUMNS]).alias("cells"),
    )
    return sheets.cells_of(rows).drop("raw_path", "sheet_name")


@query("json_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def json_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as JSON lines and read with its types."""
    folder = _fresh_folder(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    orders.write.json(folder)
    return read_table(spark, folder, "json", "o_orderkey bigint, o_orderstatus string, o_totalprice double")


@query("json_rows", """
    SELECT '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_brand":"' || p_brand
           || '","metricValues":{"size":' || CAST(p_size AS DOUBLE) || ',"price":' || p_retailprice || '}}' AS row_json
    FROM part
""")
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand",
        F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"),
    )
    return sheets.to_json_rows(parts, ["p_partkey", "p_name", "p_brand"], ["size", "price"], "row_json")
