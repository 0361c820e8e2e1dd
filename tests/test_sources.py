"""Files to grids and back."""

import pytest
from pyspark.sql import functions as F

from specloom.operators import header
from specloom.sources import sheets, tables


@pytest.fixture
def sheet_dir(tmp_path):
    (tmp_path / "a.csv").write_text(
        "﻿L23,,L28,\nUS数値,US単位,US数値,\n1,mm,\"two\nlines\",x\n , ,,\n2.5,mm,N/A,y\n", encoding="utf-8"
    )
    (tmp_path / "b.csv").write_text("a,a,a,ＡＢ\n1,2,true,4\n3,,false,x\n", encoding="utf-8")
    return tmp_path


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_two_header_rows(spark, sheet_dir):
    grid = sheets.read_grid(spark, str(sheet_dir / "a.csv"), root=str(sheet_dir))
    assert rows(header.build_header(grid, 2), "raw_path", "col_no", "header") == [
        ("a.csv", 1, "L23_US数値"), ("a.csv", 2, "L23_US単位"), ("a.csv", 3, "L28_US数値"), ("a.csv", 4, "L28"),
    ]
    cells = header.named_cells(grid, 2)
    assert rows(cells.filter("col_no = 3"), "row_no", "column_name", "value") == [
        (3, "L28_US数値", "two\nlines"), (5, "L28_US数値", "N/A"),
    ]
    assert {r.row_no for r in cells.select("row_no").distinct().collect()} == {3, 5}


def test_names_types_and_manifest(spark, sheet_dir):
    grid = sheets.read_grid(spark, str(sheet_dir / "b.csv"), root=str(sheet_dir))
    cells = header.named_cells(grid)
    assert rows(header.infer_types(cells), "column_name", "data_type") == [
        ("AB", "VARCHAR"), ("a", "BIGINT"), ("a_2", "BIGINT"), ("a_3", "BOOLEAN"),
    ]
    assert rows(header.import_manifest(cells), "sheet_name", "columns", "row_count") == [("b", "a, a_2, a_3, AB", 2)]


def test_type_inference_of_mixed_columns(spark):
    cells = [("p", "s", c, v) for c, vs in {
        "ints": ["1", "2"], "doubles": ["1", "2.5"], "mixed": ["2425", "N/A"], "none": [None], "suffix": ["5d"],
        "bools": ["True", "false"], "blank": ["1", " "],
    }.items() for v in vs]
    df = spark.createDataFrame(cells, "raw_path string, sheet_name string, column_name string, value string")
    assert dict(rows(header.infer_types(df), "column_name", "data_type")) == {
        "ints": "BIGINT", "doubles": "DOUBLE", "mixed": "VARCHAR", "none": "VARCHAR", "suffix": "VARCHAR",
        "bools": "BOOLEAN", "blank": "VARCHAR",
    }


def test_lines_are_numbered_across_splits(spark, tmp_path):
    text = ["" if i % 7 == 0 else f"{i},{'x' * (i % 50)}" for i in range(1, 20001)]
    (tmp_path / "long.csv").write_text("\n".join(text) + "\n")
    (tmp_path / "short.csv").write_text('1,a\n\n3,"b\n4,c\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        numbered = sheets.numbered_lines(spark, str(tmp_path))
        long = numbered.filter(F.col("path").endswith("long.csv"))
        assert rows(long, "line_no", "line") == sorted(enumerate(text, start=1))
        grid = sheets.read_line_grid(spark, str(tmp_path), root=str(tmp_path))
        assert rows(grid.filter("sheet_name = 'short'"), "row_no", "col_no", "value") == [
            (1, 1, "1"), (1, 2, "a"), (3, 1, "3"), (3, 2, "b"), (4, 1, "4"), (4, 2, "c"),
        ]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sheets_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a b", "1", None), ("c", "2", "x")], "sheet string, v string, w string")
    target = str(tmp_path / "out")
    sheets.write_sheets_csv(df, target, "sheet")
    back = spark.read.csv(target, header=True)
    assert rows(back, "sheet", "v", "w") == [("a_b", "1", None), ("c", "2", "x")]
    with pytest.raises(Exception, match="already exists"):
        sheets.write_sheets_csv(df, target, "sheet")
    sheets.write_sheets_csv(df, target, "sheet", only="c", overwrite=True)
    assert rows(spark.read.csv(target, header=True), "sheet") == [("c",)]
    twins = spark.createDataFrame([("a b", "1"), ("a/b", "2")], "sheet string, v string")
    with pytest.raises(ValueError, match="several sheets"):
        sheets.write_sheets_csv(twins, target, "sheet", overwrite=True)
    with pytest.raises(ValueError, match="no such sheet"):
        sheets.write_sheets_csv(df, target, "sheet", only="zzz", overwrite=True)


def test_reimport_leaves_sources_with_a_longer_name(spark, tmp_path):
    old = spark.createDataFrame([("a", 1), ("a_b", 2), ("c", 3)], "src string, v int")
    new = spark.createDataFrame([("a", 9)], "src string, v int")
    assert rows(sheets.replace_source(new, old, "src"), "src", "v") == [("a", 9), ("a_b", 2), ("c", 3)]
    path = str(tmp_path / "store")
    old.write.partitionBy("src").parquet(path)
    sheets.overwrite_sources(new, path, "src")
    assert rows(spark.read.parquet(path), "src", "v") == [("a", 9), ("a_b", 2), ("c", 3)]


def test_report_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿item,note\nx,"two\nlines"\n', encoding="utf-8")
    df = sheets.read_report_csv(spark, str(tmp_path / "r.csv"))
    assert df.columns == ["item", "note"]
    assert rows(df, "item", "note") == [("x", "two\nlines")]


def test_raw_table_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a long, b string")
    df.write.parquet(str(tmp_path / "t.parquet"))
    df.write.json(str(tmp_path / "t.json"))
    df.write.csv(str(tmp_path / "t.csv"), header=True)
    for kind in ("parquet", "json"):
        assert rows(tables.read_table(spark, str(tmp_path / f"t.{kind}")), "a", "b") == [(1, "x"), (2, "y")]
    assert rows(tables.read_table(spark, str(tmp_path / "t.csv")), "a", "b") == [("1", "x"), ("2", "y")]
    with pytest.raises(ValueError):
        tables.read_table(spark, "t.xlsx")
    tables.register_views({"raw_t": df})
    assert rows(spark.sql("WITH t AS (SELECT * FROM raw_t) SELECT max(a) AS m FROM t"), "m") == [(2,)]


def test_long_fields_are_read_whole(spark, tmp_path):
    (tmp_path / "long.csv").write_text("a,b\n" + "x" * 200_000 + ",1\n")
    for read in (sheets.read_grid, sheets.read_line_grid):
        assert read(spark, str(tmp_path / "long.csv")).filter("length(value) = 200000").count() == 1


def test_python_steps_run_from_another_folder(tmp_path):
    """A process that starts elsewhere, without the package on its workers' path."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "s.csv").write_text("a,b\n1,2\n")
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from specloom.session import get_session\nfrom specloom.sources import sheets\n"
        "spark = get_session(master='local[1]', spark__ui__enabled='false')\n"
        f"print('cells', sheets.read_grid(spark, {str(tmp_path / 's.csv')!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "cells 4" in done.stdout, done.stderr[-2000:]
