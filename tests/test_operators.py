"""Invariants and brute-force checks of the operators."""

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from specloom.operators import catalogue, compare, documents, header, mapping, melt, normalize, ordering, quality, resolve
from specloom.operators.mapping import Pattern, resolve_mapping


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_positions_with_one_group_of_a_third(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else f"g{i % 50}", rng.randint(0, 100), i) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, v int, i int").repartition(16)
    got = ordering.with_position(df, ["g"], [F.col("v").desc(), F.col("i").asc()], "at")
    expected = []
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    for members in groups.values():
        members.sort(key=lambda r: (-r[1], r[2]))
        expected += [(*r, at) for at, r in enumerate(members, start=1)]
    assert rows(got, "g", "v", "i", "at") == sorted(expected)


def test_many_equal_order_keys_spread_over_slices(spark):
    df = spark.range(20000).select((F.col("id") % 2).alias("v"), "id").repartition(8)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # this little data would be merged into one slice
    try:
        sliced = ordering._sliced(df, [], [F.col("v").asc()])
    finally:
        spark.conf.set(merging, "true")
    assert sliced.filter("v = 0").select("_slice").distinct().count() > 1
    first = ordering.with_position(df, [], [F.col("v").asc()], "at")
    again = ordering.with_position(df.repartition(5), [], [F.col("v").asc()], "at")
    assert rows(first) == rows(again)
    assert [r[0] for r in first.orderBy("at").select("at").collect()] == list(range(1, 20001))


def test_running_total_with_null_group(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 7), ("a", 1, 1)], "g string, i int, w int")
    got = ordering.with_running_total(df, ["g"], [F.col("i").asc()], F.col("w").cast("bigint"), "t")
    assert sorted((r.g or "", r.i, r.t) for r in got.collect()) == [("", 1, 5), ("", 2, 12), ("a", 1, 1)]


def test_numbered_rows_are_not_shuffled_again_for_their_offsets(spark):
    df = spark.range(60_000).select(
        F.concat(F.lit("m"), F.col("id") % 3).alias("metric"), (F.col("id") * 7919 % 997 / 4).alias("value"),
        F.concat(F.lit("b"), F.col("id") % 4).alias("brand"), F.col("id"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40000")
    try:
        for frame in (
            ordering.with_position(df, ["metric"], [F.col("value").asc(), F.col("id").asc()], "at"),
            ordering.with_running_total(df, ["metric"], [F.col("id").asc()], F.lit(1), "total"),
            compare.range_positions(df, [F.col("value").asc(), F.col("id").asc()], ["m0", "m1", "m2"]),
            compare.bin_members(df, [("m0", 50.0), ("m1", 50.0), ("m2", 50.0)], ["id"]),
        ):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_headers_of_an_order_are_shuffled_once_before_they_are_named(spark):
    from __spark_entry__ import queries

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        plans = [queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
                 for name in ("header_fill", "dup_names")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan in plans:
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_header_of_ragged_rows_in_three_levels(spark):
    """A short row has nothing to carry beyond its end; a blank last row leaves the parts above."""
    top = [["a", "", None, "b", " "], ["c", "  ", "d"], ["x", "y", "", None, " z ", "w"]]
    data = [(path, "s", r, c, value) for path in ("f", "g") for r, row in enumerate(top, 1) for c, value in enumerate(row, 1)]
    data += [("f", "s", 4, 1, "data"), ("h", "s", 1, 1, ""), ("h", "s", 3, 2, " ")]
    grid = spark.createDataFrame(data, "raw_path string, sheet_name string, row_no bigint, col_no int, value string")
    expected = [(1, "a_c_x"), (2, "a_c_y"), (3, "a_d"), (4, "b"), (5, "b_z"), (6, "w")]
    one = grid.filter("raw_path = 'f'").withColumn("raw_path", F.lit("f"))
    for frame, paths in ((grid, ("f", "g")), (one, ("f",))):
        got = header.build_header(frame, 3)
        assert rows(got) == [(path, "s", c, name) for path in paths for c, name in expected]


def test_rows_are_not_shuffled_for_the_names_and_types_of_their_sheet(spark):
    """Shuffled rows of like sheets are so small that one task would sort all of them."""
    sheets = 30
    body = spark.range(30_000).select(
        F.lit("f").alias("raw_path"), F.concat(F.lit("s"), F.col("id") % sheets).alias("sheet_name"),
        (F.floor(F.col("id") / sheets) + 2).alias("row_no"),
        F.array(F.concat(F.lit("a"), F.col("id")), F.col("id").cast("string"), F.when(F.floor(F.col("id") / sheets) % 2 > 0, "0.5")).alias("cells"),
    )
    top = spark.range(sheets).select(
        F.lit("f"), F.concat(F.lit("s"), F.col("id")), F.lit(1).cast("bigint"), F.array(F.lit("N"), F.lit("N"), F.lit("Share")))
    table = body.unionByName(top.toDF(*body.columns))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        typed = header.import_rows(table)
        cells = header.typed_cells(body.select("raw_path", "sheet_name", "row_no", F.posexplode("cells").alias("column_name", "value")))
        for frame in (typed, cells):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    kinds = rows(typed.groupBy("column_name", "data_type").agg(F.count("*"), F.count("integer_value"), F.count("number_value")))
    assert kinds == [("N", "VARCHAR", 30_000, 0, 0), ("N_2", "BIGINT", 30_000, 30_000, 30_000), ("Share", "DOUBLE", 30_000, 0, 15_000)]
    assert cells.count() == 90_000


def test_bins_found_after_the_sort_are_those_of_brute_force(spark):
    """Negative values, flat and endless ranges, values at edges and a metric without a step."""
    rng = random.Random(5)
    data = [("a", rng.choice([-3.0, -0.3, 0.1, 0.3, 0.6, 7.5, 12.0, 0.0, None, math.nan]), rng.choice("xy"), i) for i in range(400)]
    data += [("flat", 2.0, "x", i) for i in range(5)] + [("none", 1.0, "x", 1)] + [("a", 0.3, None, 900 + i) for i in range(3)]
    df = spark.createDataFrame(data, "metric string, value double, brand string, id int").repartition(6)
    got = compare.bin_members(df, [("a", 0.1), ("flat", 0.5)], ["id"])
    assert got.columns == ["metric", "value", "brand", "id", "bin_no", "place"]
    expected, places = [], Counter()
    for metric, step in (("a", 0.1), ("flat", 0.5)):
        used = [r for r in data if r[0] == metric and r[1] and not math.isnan(r[1])]
        low, high = min(r[1] for r in used), max(r[1] for r in used)
        start, end = math.floor(low / step) * step, math.ceil(high / step) * step
        n = max(1, round(((start + step if end <= start else end) - start) / step))
        for r in sorted(used, key=lambda r: (-r[1], r[3])):
            at = max(0, min(math.floor((r[1] - start) / step), n - 1))
            places[metric, at, r[2]] += 1
            expected.append((*r, at, places[metric, at, r[2]]))
    key = lambda r: (r[0], r[3])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)


def test_best_record_is_unique_and_pruned_before_the_shuffle(spark):
    data = [("p", "x", 0.9, 1, "us", 10.0, 1), ("p", "x", 0.9, 1, "metric", 11.0, 2), ("p", "x", None, 0, "metric", 12.0, 3),
            ("p", "y", 0.5, None, None, 1.0, 4), ("p", "y", 0.5, 2, None, 2.0, 5)]
    df = spark.createDataFrame(
        data, "product_id string, canonical_item string, confidence double, source_rank int, unit_system string,"
        " normalized_value_numeric double, normalized_id int"
    ).withColumn("value_status", F.lit("present"))
    best = resolve.best_record(df)
    assert rows(best, "canonical_item", "normalized_value_numeric") == [("x", 11.0), ("y", 2.0)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_records_of_rows_are_reduced_before_they_are_spread(spark):
    """A hot product and ties included: equal to the best of all records, and no shuffle moves a record."""
    lines = spark.range(4000).select(
        F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 97).alias("product_id"), F.col("id").alias("source_row_id"),
        (F.col("id") % 5).alias("source_id"), (F.col("id") % 3).alias("kind"),
        F.when(F.col("id") % 4 > 0, "present").otherwise("optional").alias("value_status"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 6 / 8).alias("confidence"), F.when(F.col("id") % 5 > 0, 1).alias("source_rank"),
        F.when(F.col("id") % 2 > 0, "us").alias("unit_system"), F.col("id").cast("double").alias("value"),
    )

    def spread(rows):
        cells = [F.struct(F.lit(f"c{i}").alias("source_column"), F.concat(F.lit("item"), (F.col("kind") + i) % 4).alias("canonical_item"),
                          (F.col("value") + i / 8).alias("normalized_value_numeric")) for i in range(3)]
        return rows.select(*[c for c in rows.columns if c not in ("kind", "value")], F.inline(F.array(*cells)))

    row_ids = ["source_row_id", "source_id"]
    ids, accepted = [*row_ids, "source_column"], ["present"]
    best = resolve.best_record_of_rows(lines, ["kind"], spread, row_ids, ids, accepted)
    assert rows(best) == rows(resolve.best_record(spread(lines), ids, accepted)) and best.count() == 97 * 4
    from __spark_entry__ import queries

    for name in ("best_record", "comparison_core", "comparison_full"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Generate inline"):]
        assert plan.count("Generate inline") == 1 and "Exchange" in below and plan.count("WindowGroupLimit") >= 3
        assert not [line for line in plan.splitlines() if "Exchange" in line and "canonical_item" in line]


def test_comparison_keeps_products_without_values(spark):
    products = spark.createDataFrame([("p",), ("q",)], "product_id string")
    best = spark.createDataFrame(
        [("p", "operating_weight", 5.0, None)],
        "product_id string, canonical_item string, normalized_value_numeric double, normalized_value_text string",
    )
    core = resolve.comparison(products, best)
    assert rows(core, "product_id", "operating_weight_kg") == [("p", 5.0), ("q", None)]
    assert len(core.columns) == 14 and len(resolve.comparison_full(products, best).columns) == 44


def test_unit_rules_come_before_synonyms_and_those_before_other_rules(spark):
    obs = spark.createDataFrame(
        [(" Battery ", "kWh"), ("battery", "Ah"), ("battery", None), ("engine", None), ("other", None)],
        "raw_item_name string, raw_unit string",
    ).withColumns({"company": F.lit("c"), "raw_category": F.lit(None).cast("string")})
    rules = [
        Pattern(2, r"^\s*battery", None, None, "^ah", "starter", "unit_based", 0.8),
        Pattern(1, "batt", "zzz", None, "^ah", "never", "unit_based", 0.8),
        Pattern(3, "engine|battery", None, None, None, "power", "inferred", 0.6, "note"),
    ]
    got = resolve_mapping(obs, [("battery", "capacity", "synonym")], rules)
    found = {(r.raw_item_name, r.raw_unit): (r.canonical_item, r.mapping_method, r.confidence) for r in got.collect()}
    assert found == {
        (" Battery ", "kWh"): ("capacity", "synonym", 0.9),
        ("battery", "Ah"): ("starter", "unit_based", 0.8),
        ("battery", None): ("capacity", "synonym", 0.9),
        ("engine", None): ("power", "inferred", 0.6),
        ("other", None): (None, "unmapped", 0.0),
    }


def annotated(spark, cells):
    df = spark.createDataFrame(
        [(t, u, vt, cu, item, conf) for t, u, vt, cu, item, conf in cells],
        "raw_value_text string, raw_unit string, value_type string, canonical_unit string, canonical_item string,"
        " confidence double",
    ).withColumns({
        "raw_value_numeric": F.lit(None).cast("double"), "mapping_notes": F.lit("m"), "raw_notes": F.lit("r"),
        "company": F.lit("c"), "product_id": F.lit("p"), "product_name": F.lit("n"), "source_table": F.lit("t"),
        "source_column": F.lit("k"), "source_row_id": F.lit(1).cast("bigint"), "unit_system": F.lit("us"),
        "source_rank": F.lit(1), "raw_item_name": F.lit("i"), "mapping_method": F.lit("exact"),
    })
    return normalize.annotate(df, [("hp", "kW", 0.7457), ("kg", "kg", 1.0), ("l", "cc", 1000.0), ("kw", "kW", 1.0)])


def test_normalised_values_and_issues(spark):
    got = annotated(spark, [
        ("20", "hp", "numeric", "kW", "power", 1.0),
        ("25 hp", "hp", "numeric", "kW", "power", 0.6),
        ("14.9 kW (20 hp)", None, "numeric", "kW", "power", 1.0),
        ("54.8 (0.898)", "in3 (L)", "numeric", "cc", "displacement", 1.0),
        ("Li-ion 260Ah/48V", "Ah / 48V", "numeric", "kWh", "battery", 1.0),
        ("0-10", "kg", "numeric", "kg", "weight", 1.0),
        ("N/A", "kg", "numeric", "kg", "weight", 1.0),
        ("diesel", None, "text", None, "fuel", 1.0),
        ("x", None, None, None, None, 0.0),
    ])
    values = {r.original_value: (r.normalized_value_numeric, r.normalized_value_text, r.value_status)
              for r in normalize.normalized_specs(got).collect()}
    assert values == {
        "20": (14.914, None, "present"), "25 hp": (18.6425, None, "present"), "14.9 kW (20 hp)": (14.9, None, "present"),
        "54.8 (0.898)": (898.0, None, "present"), "Li-ion 260Ah/48V": (None, "Li-ion 260Ah/48V", "present"),
        "0-10": (None, "0-10", "present"), "N/A": (None, None, "not_available"), "diesel": (None, "diesel", "present"),
    }
    notes = {r.original_value: r.notes for r in got.collect()}
    assert notes["Li-ion 260Ah/48V"] == "m; r; [unit_no_rule] ah/48v → kWh"
    assert notes["0-10"] == "m; r; [numeric_parse_failed]"
    found = normalize.issues(got)
    assert Counter(r.issue_type for r in found.collect()) == {
        "low_confidence": 1, "unit_no_rule": 1, "numeric_parse_failed": 1, "unmapped_item": 1,
    }
    assert rows(quality.issue_summary(found), "issue_type", "n", "companies") == [
        ("low_confidence", 1, "c"), ("numeric_parse_failed", 1, "c"), ("unit_no_rule", 1, "c"), ("unmapped_item", 1, "c"),
    ]


def test_melting_a_pivot_gives_it_back(spark):
    cells = [(r, f"m{c}", str(r * c)) for r in range(1, 6) for c in range(1, 4) if (r + c) % 4]
    wide = spark.createDataFrame(cells, "row long, m string, v string").groupBy("row").pivot("m", ["m1", "m2", "m3"]).agg(F.first("v"))
    long = melt.melt_matrix(wide, {"source_row_id": F.col("row")}, {f"m{c}": f"m{c}" for c in range(1, 4)})
    assert rows(long, "source_row_id", "product_id", "raw_value_text") == sorted(cells)


def test_wide_columns_take_the_unit_of_their_suffix(spark):
    df = spark.createDataFrame([(1, 10, None)], "k long, lift_kg int, speed_kmh double")
    got = melt.melt_wide(df, {"source_row_id": F.col("k")}, ["lift_kg", "speed_kmh"])
    assert rows(got, "source_column", "raw_value_text", "raw_value_numeric", "raw_unit", "source_rank", "unit_system") == [
        ("lift_kg", "10", 10.0, "kg", 2, "unspecified")]
    assert melt.suffix_unit("x_kgf") == "kgf" and melt.suffix_unit("x") is None


def brute_histogram(values, step):
    used = [v for v in values if v]
    start, end = math.floor(min(used) / step) * step, math.ceil(max(used) / step) * step
    end = start + step if end <= start else end
    n = max(1, round((end - start) / step))
    return Counter(max(0, min(n - 1, math.floor((v - start) / step))) for v in used), start


@pytest.mark.parametrize("values, step", [
    ([0.0, 5.0, 10.0, 12.0], 5.0), ([7.0, 7.0, None], 7.0), ([None, 3.3], 1.0),
    ([round(random.Random(5).uniform(0, 90), 2) for _ in range(300)], 0.1),
    ([k * 0.1 for k in range(1, 200)], 0.1), ([-5.0, -1.0, 4.0], 2.0),
])
def test_histogram_against_brute_force(spark, values, step):
    df = spark.createDataFrame([("m", "b", v) for v in values], "metric string, brand string, value double")
    bins = compare.histogram(df, [("m", step)]).collect()
    counts, start = brute_histogram(values, step)
    assert {r.bin_no: r.n for r in bins} == dict(counts)
    assert all(r.bin_start == start + r.bin_no * step for r in bins)
    excluded = compare.excluded_counts(df.withColumn("is_electric", F.lit(True))).first()
    assert sum(counts.values()) + excluded.n_excluded == len(values)


def test_published_histogram_case(spark):
    df = spark.createDataFrame([("m", "b", v) for v in (0.0, 5.0, 10.0, 12.0)], "metric string, brand string, value double")
    assert rows(compare.histogram(df, [("m", 5.0)]), "bin_start", "n") == [(5.0, 1), (10.0, 2)]


def test_arg_extreme_treats_zero_as_missing(spark):
    df = spark.createDataFrame([("b", 0.0, 1), ("b", None, 0), ("c", 4.0, 2), ("c", 4.0, 1), ("c", 0.0, 0)], "b string, v double, i int")
    assert rows(compare.arg_extreme(df, ["b"], "v", ["i"], ["i"], True), "b", "i") == [("b", 0), ("c", 1)]
    assert rows(compare.arg_extreme(df, ["b"], "v", ["i"], ["i"], False), "b", "i") == [("b", 0), ("c", 1)]


def test_pages_are_slices_of_the_sorted_table(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 17)
    order = [F.col("v").desc(), F.col("id").asc()]
    everything = [tuple(r) for r in df.orderBy(*order).collect()]
    for offset in (0, 300, 990, 2000):
        assert sorted(tuple(r)[:2] for r in catalogue.page(df, order, 50, offset).collect()) == sorted(
            everything[offset : offset + 50])
    assert len(rows(catalogue.page(df, order, 9999, -5))) == catalogue.MAX_PAGE


def test_wikilinks_and_their_findings(spark):
    docs = spark.createDataFrame([("p", "[[a#s]] [[b|x]] [[a]] `[[c]]` [[ d ]]")], "page string, text string")
    links = documents.extract_links(docs)
    assert rows(links) == [("p", "a"), ("p", "a"), ("p", "b"), ("p", "d")]
    pages = spark.createDataFrame([("a", "x/a"), ("b", "x/b"), ("b", "y/b")], "name string, location string")
    assert rows(documents.resolve_links(links, pages)) == [
        ("ERROR", "p", "missing page", "d", 0), ("WARN", "p", "ambiguous page", "b", 2)]
    assert rows(documents.ambiguous_locations(links, pages)) == [("b", "x/b"), ("b", "y/b")]


def test_structure_and_headings(spark):
    docs = spark.createDataFrame([
        ("s/ok", "﻿---\ntitle: t\n---\n## Related Links\n## Provenance\n## Last Updated"), ("s/_template", ""), ("s/bad", "x"),
    ], "page string, text string")
    found = documents.structure_findings(docs, keys=["title", "date"])
    assert rows(found, "severity", "page", "detail") == [
        ("ERROR", "s/bad", "front matter"), ("ERROR", "s/ok", "front matter key date"), ("WARN", "s/bad", "Last Updated"),
        ("WARN", "s/bad", "Provenance"), ("WARN", "s/bad", "Related Links")]
    log = spark.createDataFrame(
        [("log", "# t\n## [2026-07-05] ingest | t\n- a\n- b\n## Notes\r\n## [2026-07-06] lint | u\n")], "page string, text string")
    assert rows(documents.heading_findings(log), "detail") == [("5: ## Notes",)]
    assert [tuple(r)[2:] for r in documents.parse_log(log).orderBy("entry_no").collect()] == [
        (dt.date(2026, 7, 5), "ingest", "t", 2), (dt.date(2026, 7, 6), "lint", "u", 0)]


def test_merged_pages_and_parts(spark):
    data = [("d", f"page-{n:03d}.md", f" text {n} \n") for n in (2, 10, 1, 1000)] + [("d", "page-x.md", "t"), ("d", "page-004_a.md", " ")]
    pages = spark.createDataFrame(data, "doc string, name string, text string")
    whole = documents.merge_pages(pages).collect()
    assert len(whole) == 1 and whole[0].n_pages == 4
    assert whole[0].text == "\n\n---\n\n".join(
        f"<!-- source: page-{n:03d}.md -->\n## Page {n:03d}\n\ntext {n}" for n in (1, 2, 10, 1000)) + "\n"
    parts = documents.merge_parts(pages).orderBy("part_no").collect()
    assert [p.part_no for p in parts] == [1, 2, 3, 4]
    assert "\n\n---\n\n".join(p.text for p in parts) + "\n" == whole[0].text
    odd = spark.createDataFrame(
        [(None, "page-001.md", "a"), (None, "page-001.md", "a"), ("d", "page-002.md", None), ("d", None, "x")],
        "doc string, name string, text string")
    assert [(p.doc, p.part_no) for p in documents.merge_parts(odd).orderBy("part_no").collect()] == [(None, 1), (None, 2)]
    assert rows(documents.page_findings(odd), "page", "detail") == [("d", "page number"), ("d/page-002.md", "empty page")]
    assert rows(documents.page_findings(pages), "page", "detail") == [
        ("d/page-004_a.md", "empty page"), ("d/page-x.md", "page number")]


def test_html_sections(spark):
    html = """<body><section class="slide a"><p class="eyebrow">E &amp; F</p><h2>Title <em>x</em></h2>
      <p class="lead">Lead</p><ul><li>one<ul><li>two</li></ul></li></ul>
      <div class="card"><span class="badge">B</span><h3>C</h3><p>body<br>more</p></div>
      <table><tr><th>h</th><td> 1 </td></tr><tr></tr></table><p> </p><script>no()</script><p>end</p></section>
      <section class="other"><h1>no</h1></section></body>"""
    pages = spark.createDataFrame([(1, html), (2, None)], "page long, html string")
    found = documents.extract_sections(pages).collect()
    assert len(found) == 1
    row = found[0].asDict(recursive=True)
    assert row == {
        "page": 1, "section_no": 1, "title": "Title x", "eyebrow": "E & F", "lead": "Lead", "meta": "",
        "bullets": ["one two", "two"], "cards": [{"badge": "B", "title": "C", "body": "body more"}],
        "tables": [[["h", "1"]]], "paragraphs": ["body more", "end"],
    }


def test_report_passes_without_errors(spark):
    warn = spark.createDataFrame([("WARN", "p", "r", "d")], "severity string, page string, rule string, detail string")
    assert rows(documents.lint_summary(documents.lint_report([warn, warn]))) == [("WARN", 2, False)]


def test_sort_by_locale_with_null_last(spark):
    df = spark.createDataFrame([("b",), ("A",), ("a",), (None,), ("い",), ("あ",)], "s string")
    up = [r.s for r in df.orderBy(catalogue.null_last("s", locale="ja")).collect()]
    down = [r.s for r in df.orderBy(catalogue.null_last("s", descending=True, locale="ja")).collect()]
    assert up[:3] == ["a", "A", "b"] and up[-1] is None and down[-1] is None
    assert down[:-1] == up[:-1][::-1]


def test_search_ignores_case_and_null(spark):
    df = spark.createDataFrame([("Alpha", None, 1), (None, "beta", 2), ("x", "y", 33)], "a string, b string, i int")
    assert rows(catalogue.search(df, "ALP"), "i") == [(1,)]
    assert rows(catalogue.search(df, "3"), "i") == [(33,)]


def test_uncovered_sources(spark):
    imports = spark.createDataFrame([("a",), ("b",), ("c",)], "table_name string")
    obs = spark.createDataFrame([("a",), ("a",)], "source_table string")
    issues = spark.createDataFrame([("scope_excluded", "b"), ("unmapped_item", "c")], "issue_type string, source_table string")
    assert rows(quality.uncovered_sources(imports, obs, issues)) == [("b", quality.RECORDED), ("c", quality.UNDECIDED)]


def test_conflicts_count_distinct_statements(spark):
    df = spark.createDataFrame(
        [("p", "i", 1.0, None, "b"), ("p", "i", 1.0, None, "a"), ("p", "i", None, "see table", "a"),
         ("p", "j", 2.0, None, "a"), ("p", "j", 2.0, None, "c"), ("p", "k", None, None, "a")],
        "product_id string, canonical_item string, normalized_value_numeric double, normalized_value_text string,"
        " source_table string")
    assert rows(quality.conflicts(df)) == [("p", "i", 3, 2, 1.0, 1.0, "a | b")]
    flags = quality.flag_conflicts(df)
    assert {(r.canonical_item, r.conflict_status) for r in flags.collect()} == {
        ("i", quality.CONFLICT), ("j", None), ("k", quality.UNDECIDED_VALUE)}
    assert flags.count() == df.count()


def test_generated_code_is_small_enough_to_be_compiled(spark):
    """The JVM leaves methods above 8000 bytes uncompiled, which slows a stage many times over."""
    import contextlib
    import io
    import re

    from __spark_entry__ import queries

    sf_dir = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("normalize_all", "issue_rows", "metric_values", "display_value", "comparison_full", "conflicts"):
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                queries()[name](spark, sf_dir).explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
            assert sizes and max(sizes) < 8000, (name, sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


OBS = "raw_item_name string, company string, raw_category string, raw_unit string"


def test_rules_never_multiply_rows(spark):
    obs = spark.createDataFrame([("weight", "c", "k", "kg"), (" WEIGHT ", "c", "k", "KG."), ("x", "c", "k", None)], OBS)
    again = [("Weight", "w", "exact"), ("weight ", "w", "exact")]
    assert mapping.map_synonyms(obs, again).filter("canonical_item = 'w'").count() == 2
    assert mapping.map_synonyms(obs, again).count() == 3
    with pytest.raises(ValueError):
        mapping.map_synonyms(obs, [*again, ("WEIGHT", "other", "exact")])
    table = spark.createDataFrame([("Weight", "w", "exact"), ("weight", "v", "exact")], "a string, b string, c string")
    assert mapping.map_synonyms(obs, table).count() == 3
    assert mapping.map_synonyms(obs, []).filter("canonical_item is not null").count() == 0
    factors = normalize.with_factor(obs.withColumn("canonical_unit", F.lit("kg")), [("KG", "kg", 1.0), ("kg.", "kg", 1.0)])
    assert factors.count() == 3 and factors.filter("factor = 1.0").count() == 2
    assert normalize.with_factor(obs.withColumn("canonical_unit", F.lit("kg")), []).count() == 3


def test_patterns_of_one_id_are_refused_and_order_is_by_id(spark):
    def rule(number, item, company=None):
        return mapping.Pattern(number, "weight", company, None, None, item, "regex", 0.8)

    obs = spark.createDataFrame([("weight", "c", "k", "kg")], OBS)
    assert mapping.map_patterns(obs, [rule(2, "b", "c"), rule(1, "a")]).first().canonical_item == "a"
    with pytest.raises(ValueError):
        mapping.map_patterns(obs, [rule(1, "a"), rule(1, "b", "c")])


def test_whole_numbers_codes_and_nulls_keep_what_they_are(spark):
    cells = spark.createDataFrame(
        [("p", "s", c, v) for c, values in {
            "long": ["9223372036854775807", "-1"], "beyond": ["9223372036854775808"], "code": ["007", "12"],
            "mixed": ["1", "2.5"], "plus": ["+5"]}.items() for v in values],
        "raw_path string, sheet_name string, column_name string, value string")
    assert rows(header.infer_types(cells), "column_name", "data_type") == [
        ("beyond", "VARCHAR"), ("code", "VARCHAR"), ("long", "BIGINT"), ("mixed", "DOUBLE"), ("plus", "VARCHAR")]
    df = spark.createDataFrame([(9007199254740993,), (1,), (None,)], "n bigint")
    found = catalogue.summarize(df).first()
    assert (found.min_value, found.max_value) == ("1", "9007199254740993")


def test_null_ranks_and_null_products(spark):
    rows_ = spark.createDataFrame([("k", None, "x"), ("k", 1, "y")], "k string, r int, v string")
    assert melt.build_products(rows_, ["k"], ["v"], ["r"]).first().v == "y"
    specs = spark.createDataFrame(
        [(None, "i", 1.0, None, "t"), (None, "i", 2.0, None, "u"), ("p", "i", 1.0, None, "t")],
        "product_id string, canonical_item string, normalized_value_numeric double, normalized_value_text string, source_table string")
    assert quality.flag_conflicts(specs).filter("conflict_status is not null").count() == 2
    assert rows(quality.conflicts(specs), "product_id", "sources") == [(None, "t | u")]


def test_bins_and_bounds_of_an_outlier(spark):
    df = spark.createDataFrame([("m", "b", 1e12), ("m", "b", 1.0), ("m", "b", float("nan"))], "metric string, brand string, value double")
    assert [(r.bin_no, r.n) for r in compare.histogram(df, [("m", 1.0)]).orderBy("bin_no").collect()] == [(0, 1), (999999999998, 1)]
    assert tuple(compare.filter_bounds(df.filter("value = 1e12"), "value").first()) == (10**12, 10**12)


def test_tables_written_in_a_block_are_gone_after_it(spark):
    import os

    from specloom.session import cut_lineage, released

    with released(spark):
        path = cut_lineage(spark.range(3)).inputFiles()[0].removeprefix("file:").replace("//", "/")
        assert os.path.exists(path)
    assert not os.path.exists(path)
