"""Shared tables, rule frames, packed rows, sketches, and inputs that are not numbers."""

import math
import os
import re
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from specloom.operators import catalogue, compare, documents, header, html_sections, mapping, normalize, quality, resolve
from specloom.operators.mapping import Pattern
from specloom.plans import documents as document_plans
from specloom.plans import observations
from specloom.plans import quality as quality_plans
from specloom.plans.registry import QUERIES
from specloom.session import _written
from specloom.sources import shared, sheets


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*a.columns).collect()), key=repr)


def records(spark, hot=0):
    product = F.when(F.col("id") < hot, 1).otherwise(F.col("id") % 700)
    return spark.range(20_000).select(
        F.concat(F.lit("p"), product).alias("product_id"), F.concat(F.lit("i"), F.col("id") % 3).alias("canonical_item"),
        (F.col("id") % 11 / 2).alias("normalized_value_numeric"),
        F.when(F.col("id") % 7 == 0, "5").alias("_text"), F.lit("present").alias("value_status"),
        (F.col("id") % 13 / 13).alias("confidence"), (F.col("id") % 4).alias("source_rank"), F.lit("us").alias("unit_system"),
        F.concat(F.lit("s"), F.col("id") % 9).alias("source_table"), F.col("id").alias("normalized_id"),
    ).withColumns({
        "normalized_value_numeric": F.when(F.col("_text").isNull(), F.col("normalized_value_numeric")),
        "normalized_value_text": F.col("_text"),
    }).drop("_text")


def test_reports_on_a_shared_table_need_no_shuffle(spark):
    plain = records(spark)
    stored = shared.write_shared(plain, "product_id")
    assert same_rows(stored, plain)
    for report in (resolve.best_record, quality.conflicts):
        frame = report(stored)
        assert "Exchange" not in plan_of(frame)
        assert same_rows(frame, report(plain))
    assert same_rows(quality.flag_conflicts(stored, stored=True), quality.flag_conflicts(plain))


def test_a_shared_table_with_a_hot_key_is_read_without_buckets(spark):
    plain = records(spark, hot=18_000)
    stored = shared.write_shared(plain, "product_id")
    best = resolve.best_record(stored)
    assert "Exchange" in plan_of(best) and same_rows(best, resolve.best_record(plain))
    assert same_rows(quality.conflicts(stored), quality.conflicts(plain))


OBS = "raw_item_name string, company string, raw_category string, raw_unit string"


def brute_force_rule(row, rules, by_unit=None):
    for r in sorted(rules, key=lambda r: r.pattern_id):
        if by_unit is not None and (r.unit_regex is not None) != by_unit:
            continue
        parts = ((row.raw_item_name, r.item_regex), (row.company, r.company_regex), (row.raw_category, r.category_regex),
                 (row.raw_unit, r.unit_regex))
        if all(x is None or (v is not None and re.search(x, v, re.I)) for v, x in parts):
            return r
    return None


def test_pattern_rules_as_list_and_frame_against_brute_force(spark):
    rows = [(n, c, k, u) for n in ("Weight", "max weight", "Width", None) for c in ("A", "b", None)
            for k in ("x", None) for u in ("kg", "LB", None)] * 3
    obs = spark.createDataFrame(rows, OBS).withColumn("n", F.monotonically_increasing_id())
    rules = [Pattern(i, item, company, category, unit, f"item{i}", "m", i / 2000) for i, (item, company, category, unit) in enumerate(
        [("weight", "^a$", None, "kg"), ("^max", None, "x", None), ("width", "b", None, "^lb$"), ("w", None, None, None)] * 300, 1
    )]
    frame = spark.createDataFrame([tuple(r) for r in rules[::-1]], "pattern_id int, item_regex string, company_regex string, "
                                  "category_regex string, unit_regex string, canonical_item string, mapping_method string, "
                                  "confidence double, notes string")
    expected = [(r.n, getattr(brute_force_rule(r, rules), "canonical_item", None)) for r in obs.collect()]
    for given in (rules, frame):
        found = mapping.map_patterns(obs, given).select("n", "canonical_item")
        assert sorted(map(tuple, found.collect())) == sorted(expected, key=lambda x: x[0])
    both = mapping.resolve_mapping(obs, [("width", "breadth", "exact")], frame).select("n", "canonical_item")
    wanted = []
    for r in obs.collect():
        unit, name = brute_force_rule(r, rules, True), brute_force_rule(r, rules, False)
        synonym = "breadth" if (r.raw_item_name or "").lower() == "width" else None
        wanted.append((r.n, unit.canonical_item if unit else synonym or (name.canonical_item if name else None)))
    assert sorted(map(tuple, both.collect())) == sorted(wanted, key=lambda x: x[0])


def test_rules_are_tried_on_distinct_keys_and_none_may_be_given(spark, tmp_path):
    path = str(tmp_path / "obs")
    spark.range(5000).select(
        "id", F.concat(F.lit("a"), F.col("id") % 3).alias("raw_item_name"), *[F.lit("x").alias(c) for c in mapping.KEYS[1:]]
    ).write.parquet(path)
    found = mapping.map_patterns(spark.read.parquet(path), [Pattern(1, "a1", None, None, None, "x", "m", 1.0)])
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # what the expressions say of the keys is a small table by now; the observations do not move to meet it
    assert "regexp" not in plan.lower() and "Exchange hash" not in plan and "BroadcastHashJoin" in plan
    assert found.filter("canonical_item = 'x'").count() == 1667
    assert mapping.map_patterns(spark.read.parquet(path), []).filter("mapping_method = 'unmapped'").count() == 5000


def test_sketch_error_and_plan(spark):
    df = spark.range(300_000).select(
        "id", (F.col("id") % 1000).alias("few"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("t"), "id")).alias("text"),
        F.lit(None).cast("double").alias("none"),
    )
    found = catalogue.summarize_sketch(df)
    assert plan_of(found).count("Exchange") == 1 and "Generate" not in plan_of(found).split("Exchange")[1]
    exact = {r.column_name: r for r in catalogue.summarize(df).collect()}
    for row in found.collect():
        told = exact[row.column_name]
        assert (row.n_rows, row.n_null, row.min_value, row.max_value, row.mean_value) == (
            told.n_rows, told.n_null, told.min_value, told.max_value, told.mean_value)
        assert abs(row.n_distinct - told.n_distinct) <= 0.02 * told.n_distinct
    assert {r.column_name: r.n_distinct for r in found.collect()}["few"] == 1000


def test_a_page_is_not_a_sorted_copy_of_the_table(spark):
    before = len(_written.get(spark.sparkContext.applicationId, []))
    plan = plan_of(catalogue.page(spark.range(10_000), [F.col("id").desc()], 10, 20))
    assert "TakeOrderedAndProject" in plan
    assert len(_written.get(spark.sparkContext.applicationId, [])) == before


def sheet_files(tmp_path):
    (tmp_path / "a.csv").write_text('Name,Name,"Size, mm"\nx,1,2\n , ,\n"two\nlines",3,007\n')
    (tmp_path / "b.csv").write_text("Kind,Flag,Share\nq,true,0.5\n\nr,FALSE\n")
    return str(tmp_path / "*.csv"), str(tmp_path)


def test_import_of_files(spark, tmp_path):
    paths, root = sheet_files(tmp_path)
    found = header.import_rows(sheets.read_rows(spark, paths, root))
    cells = {(r.sheet_name, r.row_no, r.column_name): (r.data_type, r.text_value) for r in found.collect()}
    assert cells == {
        ("a", 2, "Name"): ("VARCHAR", "x"), ("a", 2, "Name_2"): ("BIGINT", "1"), ("a", 2, "Size_mm"): ("VARCHAR", "2"),
        ("a", 4, "Name"): ("VARCHAR", "two\nlines"), ("a", 4, "Name_2"): ("BIGINT", "3"), ("a", 4, "Size_mm"): ("VARCHAR", "007"),
        ("b", 2, "Kind"): ("VARCHAR", "q"), ("b", 2, "Flag"): ("BOOLEAN", "true"), ("b", 2, "Share"): ("DOUBLE", "0.5"),
        ("b", 4, "Kind"): ("VARCHAR", "r"), ("b", 4, "Flag"): ("BOOLEAN", "FALSE"),
    }
    # once a row is spread into cells, they stay where they are
    above = plan_of(found).split("Generate")[0]
    assert "Exchange" not in above
    old = header.typed_cells(header.named_cells(sheets.read_grid(spark, paths, root)))
    assert {(r.sheet_name, r.row_no, r.column_name): (r.data_type, r.text_value) for r in old.collect()} == cells


def test_blank_rows_and_manifest_of_packed_rows(spark, tmp_path):
    paths, root = sheet_files(tmp_path)
    rows = sheets.read_rows(spark, paths, root)
    data = sheets.filled_rows(rows.filter("row_no > 1"))
    assert sorted((r.sheet_name, r.row_no) for r in data.collect()) == [("a", 2), ("a", 4), ("b", 2), ("b", 4)]
    assert "Exchange" not in plan_of(sheets.cells_of(data))
    names = header.unique_names(header.clean_names(header.build_header(sheets.cells_of(rows))))
    found = header.rows_manifest(data, names)
    assert sorted((r.sheet_name, r.columns, r.row_count) for r in found.collect()) == [
        ("a", "Name, Name_2, Size_mm", 2), ("b", "Kind, Flag, Share", 2)]


def test_row_numbers_of_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for part in range(3):
        spark.range(part * 100, part * 100 + 50 + part).coalesce(1).write.mode("append").parquet(path)
    numbered = sheets.file_row_numbers(spark.read.parquet(path)).collect()
    assert sorted(r.row_no for r in numbered) == list(range(2, 155))
    by_file = {}
    for r in sorted(numbered, key=lambda r: r.row_no):
        by_file.setdefault(r.raw_path, []).append(r.id)
    assert list(by_file) == sorted(by_file) and all(ids == sorted(ids) for ids in by_file.values())
    assert "Sort" not in plan_of(sheets.file_row_numbers(spark.read.parquet(path)).select("id", "row_no")).split("Window")[0]


def metrics(spark, values):
    return spark.createDataFrame([("m", "b", False, v) for v in values], "metric string, brand string, is_electric boolean, value double")


def test_nan_takes_part_in_no_range_bin_or_bound(spark):
    df = metrics(spark, [1.0, math.nan, 3.0, None, 0.0])
    assert tuple(compare.range_stats(df).first())[1:3] == (0.0, 3.0)
    placed = compare.range_positions(df, [F.col("value").asc()], ["m"]).collect()
    assert sorted(r.relative for r in placed) == [0.0, 1 / 3, 1.0]
    assert tuple(compare.excluded_counts(df).first())[1:] == (2, 3, 1, 0)
    bins = compare.histogram(df, [("m", 1.0), ("m", 1.0)])
    assert bins.agg(F.sum("n")).first()[0] == 2
    assert compare.bin_members(df, [("m", 1.0), ("m", 1.0)], ["brand"]).count() == 2
    assert tuple(compare.filter_bounds(df, "value").first()) == (0, 3)
    assert tuple(compare.filter_bounds(metrics(spark, [math.nan, None]), "value").first()) == (0, 0)
    assert tuple(compare.filter_bounds(metrics(spark, [-2.5, math.inf]), "value").first()) == (-2, 0)
    with pytest.raises(ValueError):
        compare.histogram(df, [("m", 1.0), ("m", 2.0)])


def test_unit_reports_read_rules_as_conversions_do(spark):
    mapped = spark.createDataFrame(
        [("c", "p", "i", u, "kg", "1", "t", "numeric") for u in ("kg", " KG.", "stone", None)],
        "company string, product_id string, canonical_item string, raw_unit string, canonical_unit string, "
        "raw_value_text string, source_table string, value_type string",
    )
    frame = spark.createDataFrame([("KG", "kg", 1.0)], "a string, b string, c double")
    for rules in ([("KG", "kg", 1.0)], frame):
        assert [r.original_unit for r in quality.unit_mismatches(mapped, rules).collect()] == ["stone"]


def test_items_given_twice_are_reported_once(spark):
    best = spark.createDataFrame([("p", "i")], "product_id string, canonical_item string")
    scope = spark.createDataFrame([("p",), ("q",)], "product_id string")
    item = ("i", "c", None, "numeric", 1)
    assert [r.missing_rate for r in quality.missing_rate(best, scope, [item, item]).collect()] == [0.5]


def test_a_page_without_text_breaks_all_rules(spark):
    docs = spark.createDataFrame([("a", None), ("b", "")], "page string, text string")
    found = documents.structure_findings(docs, sections=["S"]).groupBy("page").count().collect()
    assert {r.page: r["count"] for r in found} == {"a": 2, "b": 2}


def test_reimport_replaces_whole_sources_on_storage(spark, tmp_path):
    path = os.path.join(str(tmp_path), "t")
    old = spark.createDataFrame([("a", "s1", 1), ("a", "s2", 2), ("a_b", "s1", 3)], "src string, sheet string, v int")
    sheets.overwrite_sources(old, path, "src")
    sheets.overwrite_sources(spark.createDataFrame([("a", "s1", 9)], old.schema), path, "src")
    assert sorted(map(tuple, spark.read.schema(old.schema).parquet(path).select(*old.columns).collect())) == [("a", "s1", 9), ("a_b", "s1", 3)]


def test_small_rows_are_spread_before_they_become_pages(spark):
    found = document_plans.section_cards(spark, "/root/testdata/sf0.001")
    below = plan_of(found).split("MapInArrow")[1]
    assert "Exchange hashpartitioning(p_partkey" in below and "</section>" not in below.split("Exchange")[1]


def test_deep_markup_does_not_grow_in_square():
    tracemalloc.start()
    (section,) = html_sections.sections_of("<b>x" * 5000, None)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert section[0] == 1 and most < 20e6


def test_few_pages_are_sections_at_a_time(spark):
    """What leaves the Python step comes in small batches, whatever a batch of its input holds."""
    assert "MapInPandas" not in plan_of(document_plans.page_bullets(spark, "/root/testdata/sf0.001"))
    pages = spark.range(200).coalesce(1).select(F.col("id").alias("page"), F.lit("<ul><li>a<li>b</ul>").alias("html"))
    found = documents.extract_sections(pages, section=None)
    assert sorted((r.page, tuple(r.bullets)) for r in found.collect()) == [(i, ("a b", "b")) for i in range(200)]


def test_rules_that_are_plain_texts_meet_their_keys_by_equality(spark):
    """As many rules as keys: all pairs would be 900 million expressions."""
    n = 30_000
    keys = spark.range(n).select("id", F.concat(F.lit("Item "), "id", F.when(F.col("id") % 3 == 0, "\n").otherwise("")).alias("raw_item_name"),
                                 *[F.lit("x").alias(c) for c in mapping.KEYS[1:]])
    rules = spark.range(n).select(
        F.col("id").cast("int").alias("pattern_id"), F.concat(F.lit("^iTEM "), "id", F.lit("$")).alias("item_regex"),
        F.when(F.col("id") % 2 == 0, "^X$").when(F.col("id") % 5 == 0, "^y$").alias("company_regex"),
        *[F.lit(None).cast("string").alias(c) for c in ("category_regex", "unit_regex")],
        F.concat(F.lit("c"), "id").alias("canonical_item"), F.lit("m").alias("mapping_method"), F.lit(1.0).alias("confidence"),
        F.lit(None).cast("string").alias("notes"),
    )
    start = time.monotonic()
    found = mapping.map_patterns(keys, rules).select("id", "canonical_item").collect()
    assert time.monotonic() - start < 60
    assert {r.id: r.canonical_item for r in found} == {i: f"c{i}" if i % 2 == 0 or i % 5 else None for i in range(n)}


def test_a_short_frame_of_rules_does_not_move_the_rows(spark, tmp_path):
    path = str(tmp_path / "units")
    spark.range(1000).select(F.lit("stone").alias("raw_unit"), F.lit("kg").alias("canonical_unit")).write.parquet(path)
    frame = spark.createDataFrame([("KG", "kg", 1.0)], "a string, b string, c double")
    plan = plan_of(normalize.with_factor(spark.read.parquet(path), frame))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_keys_of_observations_hold_all_that_occur(spark):
    sf_dir = "/root/testdata/sf0.001"
    made = observations.observation_keys(spark, sf_dir).select(*mapping.KEYS)
    assert observations.raw_observations(spark, sf_dir).select(*mapping.KEYS).distinct().subtract(made).count() == 0


def test_reports_that_read_rows_once_write_no_shared_table(spark, monkeypatch):
    monkeypatch.setattr(observations, "write_shared", None)
    monkeypatch.setattr(observations, "_shared", {})
    for report in (quality_plans.low_confidence, quality_plans.issue_summary, quality_plans.unit_mismatch):
        assert report(spark, "/root/testdata/sf0.001").count() >= 0


def test_rows_made_of_placed_rows_are_not_moved_again(spark, monkeypatch):
    narrow = shared.placed_by(records(spark), "product_id")
    wide = narrow.select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"))
    monkeypatch.setattr(shared, "placed_by", None)
    stored = shared.write_shared(wide, "product_id", placed=True)
    assert same_rows(stored, wide)
    assert "Exchange" not in plan_of(quality.conflicts(stored))


def test_issue_rows_are_those_of_all_stages(spark, tmp_path):
    """A table left out of scope is an issue of its own beside those of the observations, which keep their details."""
    parts = [(1, "a", "Brand#3", "LARGE", 5, 900.0), (2, "b", "Brand#1", "LARGE", 5, 900.0), (3, "c", "Brand#3", "SMALL", 5, 9.0), (4, "d", None, "SMALL", 5, 9.0)]
    spark.createDataFrame(
        parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ).write.parquet(f"{tmp_path}/part.parquet")
    lines = [(7, 1, 70, 1, 17.0, 100.0, 0.01, 0.02, "R", "F"), (8, 2, 80, 1, 24.0, 100.0, 0.06, 0.03, "N", "O")]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = QUERIES["issue_rows"](spark, str(tmp_path)).collect()
    found = {(r.issue_type, r.severity, r.source_table, r.raw_item_name, r.detail, r.status) for r in rows}
    assert len(rows) == len(found) == 6
    assert found == {
        ("scope_excluded", "info", "Brand#3", None, None, "open"),
        ("unmapped_item", "review", "supplier_70", "l_tax", None, "open"),
        ("numeric_parse_failed", "review", "supplier_70", "l_quantity", "[numeric_parse_failed]", "open"),
        ("low_confidence", "review", "supplier_80", "l_discount", "Ah rating, kept as text", "open"),
        ("low_confidence", "review", "supplier_80", "l_tax", "by position in the sheet", "open"),
        ("unit_no_rule", "review", "supplier_80", "l_discount", "Ah rating, kept as text; [unit_no_rule] ah/48v → kWh", "open"),
    }
