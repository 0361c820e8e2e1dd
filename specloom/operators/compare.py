"""Comparison measures: curated rows, metrics, ranges, histograms, summaries."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.dictionaries import METRICS, NO_BRAND_RANK, NO_SERIES_NUMBER, dictionary
from specloom.functions.numbers import in_millimetres, measure_text, numbers_in, pick_measure
from specloom.functions.text import clean_text, rank_of, series_number
from specloom.operators.ordering import first_per_group, numbered, sorted_slices, with_position
from specloom.session import cut_lineage

# A value this close to a bin edge, relative to its bin number, is binned by itself.
EDGE_TOLERANCE = 1e-9


def curated(
    df: DataFrame, columns: Mapping[str, Column], model: str, brand: str, brands: Sequence[str]
) -> DataFrame:
    """Named text columns without NULL, of the given brands, rows without a model dropped."""
    named = df.select(*[c.alias(name) for name, c in columns.items()])
    wanted = named.filter(F.col(brand).isin(*brands) & (F.trim(F.coalesce(model, F.lit(""))) != ""))
    return wanted.select(*[clean_text(F.col(name)).alias(name) for name in columns])


def with_row_flags(df: DataFrame, model: str, powertrain: str, prefixes: Sequence[str]) -> DataFrame:
    """Label without the brand, and whether the row is a series summary or electric."""
    lead = "|".join(re.escape(p) for p in prefixes)
    label = F.trim(F.regexp_replace(model, rf"^(?:{lead})\s+", ""))
    return df.withColumns({
        "label": label,
        "is_series_summary": F.lower(label).endswith("series"),
        "is_electric": F.lower(powertrain).startswith("electric"),
    })


def with_group_kind(df: DataFrame) -> DataFrame:
    """Combustion, electric or series summary, as one column rather than three scans."""
    return df.withColumn(
        "group_kind",
        F.when(F.col("is_series_summary"), "summary").when(F.col("is_electric"), "electric").otherwise("combustion"),
    )


def series_order(series: str) -> list[Column]:
    """Series by the first number in the name, those without one last."""
    return [series_number(F.col(series), NO_SERIES_NUMBER).asc(), F.col(series).asc_nulls_last()]


def brand_order(brand: str, series: str, model: str, order: Sequence[str]) -> list[Column]:
    """Brands in a given order, unknown ones last, then series, then model."""
    return [
        rank_of(F.col(brand), order, NO_BRAND_RANK).asc(), F.col(brand).asc_nulls_last(),
        *series_order(series), F.col(model).asc_nulls_last(),
    ]


def with_sort_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    return with_position(df, [], order, name)


def arg_extreme(
    df: DataFrame, group: Sequence[str], value: str, tie: Sequence[str], keep: Sequence[str], largest: bool
) -> DataFrame:
    """The row with the largest or smallest value per group.

    A missing value and zero count alike: as less than anything when the
    largest is sought, as more than anything when the smallest is.  The first
    row in ``tie`` order wins among equals.
    """
    known = F.nullif(F.col(value), F.lit(0.0))
    key = -F.coalesce(known, F.lit(-1.0)) if largest else F.coalesce(known, F.lit(1e9))
    best = F.min_by(F.struct(*keep, value), F.struct(key.alias("key"), *tie))
    return df.groupBy(*group).agg(best.alias("_best")).select(*group, "_best.*")


def brand_summary(df: DataFrame, brand: str, series: str, powertrain: str, order: Sequence[str]) -> DataFrame:
    """Models, electric models, series and powertrains per brand; brands without rows are absent.

    The lists are for catalogues of brands; ``brand_series`` has the series of
    any number as rows.
    """
    model = ~F.col("is_series_summary")

    def listed(names: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(model & (names != ""), names))), ", ")

    named = F.when(model & (F.col(series) != ""), F.struct(
        series_number(F.col(series), NO_SERIES_NUMBER).alias("number"), F.col(series).alias("name")
    ))
    series_list = F.array_join(F.transform(F.array_sort(F.collect_set(named)), lambda s: s["name"]), ", ")
    return (
        df.groupBy(brand)
        .agg(
            F.count_if(model).alias("n_models"),
            F.count_if(model & F.col("is_electric")).alias("n_electric"),
            series_list.alias("series_names"),
            listed(F.col(powertrain)).alias("powertrains"),
        )
        .withColumn("brand_rank", rank_of(F.col(brand), order, NO_BRAND_RANK))
    )


def brand_series(df: DataFrame, brand: str, series: str) -> DataFrame:
    """Each brand's series with their number of models; one row a series."""
    models = df.filter(~F.col("is_series_summary") & (F.col(series) != ""))
    return models.groupBy(brand, series).agg(
        F.count("*").alias("n_models"), F.min(series_number(F.col(series), NO_SERIES_NUMBER)).alias("series_number")
    )


def metric_values(df: DataFrame, keep: Sequence[str], metrics: Sequence[tuple] = METRICS) -> DataFrame:
    """One row per row and metric with the parsed measure, NULL where there is none.

    The texts are made long first and read by one expression, so the generated
    code does not grow with the number of metrics.
    """
    cells = F.array(*[
        F.struct(
            F.lit(name).alias("metric"), F.col(source).alias("_text"),
            F.lit(mode).alias("_mode"), F.lit(unit == "mm").alias("_length"),
        )
        for name, source, unit, _, mode, _ in metrics
    ])
    body, found, mode = F.col("_body"), F.col("_found"), F.col("_mode")
    value = (
        F.when(mode == "first", pick_measure(body, found, "first"))
        .when(mode == "second", pick_measure(body, found, "second"))
        .otherwise(pick_measure(body, found, "range_max"))
    )
    return (
        df.select(*keep, F.inline(cells))
        .withColumn("_body", measure_text(F.col("_text")))
        .withColumn("_found", numbers_in(body))
        .withColumn("_value", value)
        .select(*keep, "metric", F.when(F.col("_length"), in_millimetres(body, F.col("_value")))
                .otherwise(F.col("_value")).alias("value"))
    )


def _known() -> Column:
    """Values that are neither NULL nor NaN."""
    return F.col("value").isNotNull() & ~F.isnan("value")


def _stats(metrics: DataFrame) -> DataFrame:
    """Least and greatest per metric, of values that are numbers; a flat metric gets a range of one."""
    top = F.max("value")
    return metrics.filter(_known()).groupBy("metric").agg(
        F.min("value").alias("low"),
        F.when(F.min("value") == top, F.min("value") + 1).otherwise(top).alias("high"),
    ).filter(F.col("low").isNotNull())


def range_stats(metrics: DataFrame) -> DataFrame:
    """Range and five ticks per metric."""
    span = F.col("high") - F.col("low")
    return _stats(metrics).select(
        "metric", "low", "high", *[(F.col("low") + span * i / 4).alias(f"tick_{i}") for i in range(5)]
    )


def range_positions(
    metrics: DataFrame, order: Sequence[Column], names: Sequence[str]
) -> DataFrame:
    """Each value's place in the range of its metric, 0 to 1, and its rank in ``order``.

    ``names`` are the metrics there are; they bound the side that is broadcast.
    The ranges are read from the sorted slices, so that ``metrics`` are made for these only.
    """
    sliced = sorted_slices(metrics.filter(_known() & F.col("metric").isin(*names)), ["metric"], order)
    placed = numbered(sliced, ["metric"], "order_index").join(F.broadcast(_stats(sliced)), "metric")
    relative = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
    others = [c for c in metrics.columns if c != "metric"]
    return placed.select("metric", *others, relative.alias("relative"), "order_index")


def _counted() -> Column:
    """Values that a histogram takes: neither NULL nor NaN nor zero."""
    return _known() & (F.col("value") != 0)


def _bounds(low: Column, high: Column, step: Column) -> tuple[Column, Column]:
    """Start of the first bin and number of bins."""
    start = F.floor(low / step).cast("double") * step
    end = F.ceil(high / step).cast("double") * step
    end = F.when(end <= start, start + step).otherwise(end)
    return start, F.greatest(F.lit(1), F.round((end - start) / step).cast("bigint"))


def _bin(value: Column, start: Column, step: Column, n_bins: Column) -> Column:
    """Bin of a value; the last bin includes its end."""
    return F.greatest(F.lit(0), F.least(F.floor((value - start) / step).cast("bigint"), n_bins - 1))


def histogram(metrics: DataFrame, steps: Sequence[tuple[str, float]]) -> DataFrame:
    """Rows per metric, bin and brand; NULL and zero take no part.

    One scan: values are counted by the multiple of the step they lie above,
    and these counts, kept as a small table, are all that is needed to find
    the range and the final bins.
    Values at a multiple, where rounding could matter, are kept as they are
    and binned from the value itself.
    """
    rules = dictionary(metrics.sparkSession, steps, "metric string, step double", keys=["metric"])
    ratio = F.col("value") / F.col("step")
    near = F.abs(ratio - F.rint(ratio)) <= EDGE_TOLERANCE * F.greatest(F.lit(1.0), F.abs(ratio))
    counted = cut_lineage(
        metrics.filter(_counted())
        .join(rules, "metric")
        .withColumn("_multiple", F.floor(ratio))
        .withColumn("_edge", F.when(near, F.col("value")))
        .groupBy("metric", "step", "brand", "_multiple", "_edge")
        .agg(F.count("*").alias("_n"), F.min("value").alias("_low"), F.max("value").alias("_high"))
    )
    # One row per metric of ``steps``.
    ranges = counted.groupBy("metric").agg(F.min("_low").alias("_least"), F.max("_high").alias("_most"))
    start, n_bins = _bounds(F.col("_least"), F.col("_most"), F.col("step"))
    return (
        counted.join(F.broadcast(ranges), "metric")
        .withColumn("_start", start)
        .withColumn("n_bins", n_bins)
        .withColumn("bin_no", _bin(F.coalesce("_edge", "_low"), F.col("_start"), F.col("step"), F.col("n_bins")))
        .withColumn("bin_start", F.col("_start") + F.col("bin_no") * F.col("step"))
        .groupBy("metric", "bin_no", "bin_start", "n_bins", "step", "brand")
        .agg(F.sum("_n").alias("n"))
    )


#: Bins made from one row.
BIN_BLOCK = 10_000


def stacked_bins(bins: DataFrame, order: Sequence[str]) -> DataFrame:
    """Brands on top of each other in each bin, with totals; empty bins have no brand.

    Works on histogram counts, so a bin holds one row per brand.
    """
    ranked = bins.withColumn("brand_rank", rank_of(F.col("brand"), order, NO_BRAND_RANK))
    one_bin = Window.partitionBy("metric", "bin_no")
    upward = one_bin.orderBy("brand_rank", "brand").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stacked = ranked.select(
        "metric", "bin_no", "brand", "n",
        F.sum("n").over(one_bin).alias("bin_total"), F.sum("n").over(upward).alias("running_total"),
    )
    first = F.min(F.col("bin_start") - F.col("bin_no") * F.col("step"))
    # bins come in blocks, so that a fine step makes many rows and never one long array
    last = F.col("n_bins") - 1
    blocks = bins.groupBy("metric", "n_bins", "step").agg(first.alias("_first")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / BIN_BLOCK).cast("bigint")))
    )
    begin = F.col("_block") * BIN_BLOCK
    every = blocks.select(
        "metric", "step", "_first", F.explode(F.sequence(begin, F.least(last, begin + BIN_BLOCK - 1))).alias("bin_no")
    )
    return every.join(stacked, ["metric", "bin_no"], "left").select(
        "metric", "bin_no", (F.col("_first") + F.col("bin_no") * F.col("step")).alias("bin_start"), "brand",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "bin_total", "running_total")],
    )


def excluded_counts(metrics: DataFrame) -> DataFrame:
    """Rows that a histogram takes and leaves out, per metric, and why; the two add up to the rows."""
    counted, zero = F.coalesce(_counted(), F.lit(False)), F.coalesce(F.col("value") == 0, F.lit(False))
    return metrics.groupBy("metric").agg(
        F.count_if(counted).alias("n_included"),
        F.count_if(~counted).alias("n_excluded"),
        F.count_if(zero).alias("n_zero"),
        F.count_if(~counted & F.col("is_electric")).alias("n_electric"),
    )


def bin_members(
    metrics: DataFrame, steps: Sequence[tuple[str, float]], model: Sequence[str]
) -> DataFrame:
    """All rows of each bin and brand, numbered by value, greatest first, then model.

    A bin has no bound on its rows, so they are numbered over range slices and
    never gathered into a list.
    """
    rules = dictionary(metrics.sparkSession, steps, "metric string, step double", keys=["metric"])
    used = metrics.filter(
        _counted() & F.col("metric").isin(*[m for m, _ in steps])
    )
    # A greater value is never in a lower bin, so the bins of a brand follow each other in the order of values.
    order = [F.col("value").desc(), *[F.col(m).asc() for m in model]]
    sliced = sorted_slices(used, ["metric", "brand"], order)
    # One row per metric of ``steps``.
    ranges = sliced.groupBy("metric").agg(F.min("value").alias("_least"), F.max("value").alias("_most"))
    start, n_bins = _bounds(F.col("_least"), F.col("_most"), F.col("step"))
    bins = cut_lineage(ranges.join(rules, "metric").select(
        "metric", "step", start.alias("_start"), n_bins.alias("_n_bins")
    ))
    binned = sliced.join(F.broadcast(bins), "metric").withColumn(
        "bin_no", _bin(F.col("value"), F.col("_start"), F.col("step"), F.col("_n_bins"))
    ).drop("step", "_start", "_n_bins")
    others = [c for c in metrics.columns if c != "metric"]
    return numbered(binned, ["metric", "bin_no", "brand"], "place").select("metric", *others, "bin_no", "place")


def visible(df: DataFrame, brand: str, brands: Sequence[str], measure: str, low: float, high: float) -> DataFrame:
    """Rows of the brands whose measure lies in the range, or is not known."""
    inside = F.col(measure).between(min(low, high), max(low, high)) | F.col(measure).isNull()
    return df.filter(F.col(brand).isin(*brands) & inside)


def filter_bounds(df: DataFrame, measure: str) -> DataFrame:
    """Whole-number range of a measure, zero when there is none; NaN and what exceeds 64 bits give no bound."""
    value = F.col(measure).cast("double")
    known = F.when(~F.isnan(value), F.col(measure))
    return df.agg(
        F.coalesce(F.min(known).try_cast("bigint"), F.lit(0)).alias("low"),
        F.coalesce(F.max(known).try_cast("bigint"), F.lit(0)).alias("high"),
    )


def timeline(df: DataFrame, ts: str, kind: str, value: str, unit: str = "day") -> DataFrame:
    """Events per period and kind."""
    return df.groupBy(F.date_trunc(unit, F.col(ts)).cast("date").alias("period"), kind).agg(
        F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total")
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in order."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group, with their place."""
    return first_per_group(df, group, order, k, "place").withColumn("place", F.col("place").cast("bigint"))
