"""Rule tables: fixed values, and their safe use in joins.

Rules are given as a list of literals or as a frame.  A list's size is known
when the plan is made, so up to ``BROADCAST_ROWS`` it carries a broadcast hint;
a longer list is joined like any table.  A frame with keys is kept as a table, so that
Spark knows its size and sends a short one to the rows, which would otherwise meet in one
task for each key.  Keys are brought to the
form the data side has, equal rules count once, and a list that gives one key
two meanings is refused: a rule never multiplies the rows it is joined to.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.session import cut_lineage

BROADCAST_ROWS = 10_000


def sql_literal(value: object) -> str:
    """A SQL literal for a dictionary cell."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def sql_values(rows: Sequence[Sequence[object]]) -> str:
    """The rows as the body of a ``VALUES`` clause."""
    return ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)


def _one_meaning(rows: Sequence[Sequence[object]], keys: Sequence[int], forms: Mapping[int, Callable[[str], str]]):
    """The rows with their keys in normal form, each once."""
    found: dict[tuple, tuple] = {}
    for row in rows:
        row = tuple(forms[i](v) if i in forms and isinstance(v, str) else v for i, v in enumerate(row))
        key = tuple(row[i] for i in keys)
        if found.setdefault(key, row) != row:
            raise ValueError(f"two rules for {key}: {found[key]} and {row}")
    return list(found.values())


def dictionary(
    spark: SparkSession,
    rows: Sequence[Sequence[object]] | DataFrame,
    schema: str,
    keys: Sequence[str] = (),
    forms: Mapping[str, tuple[Callable[[str], str], Callable[[Column], Column]]] | None = None,
) -> DataFrame:
    """Rules as a frame; ``schema`` is a DDL string, ``keys`` the columns that identify a rule.

    ``forms`` gives the normal form of key columns, for text and for a column.
    A frame's rules that share a key are reduced to the least of them.
    """
    fields = [part.strip().split(None, 1) for part in schema.split(",")]
    names = [name for name, _ in fields]
    forms = forms or {}
    if isinstance(rows, DataFrame):
        table = rows.toDF(*names).select(*[
            (forms[name][1](F.col(name)) if name in forms else F.col(name)).cast(kind).alias(name) for name, kind in fields
        ])
        if not keys:
            return table
        rest = [n for n in names if n not in keys]
        least = table.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rule")) if rest else table.distinct()
        return cut_lineage(least.select(*keys, "_rule.*").select(*names) if rest else least)
    if keys:
        rows = _one_meaning(
            rows, [names.index(k) for k in keys], {names.index(n): f[0] for n, f in forms.items()}
        )
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields])
    if len(rows) > BROADCAST_ROWS:
        return spark.createDataFrame([tuple(r) for r in rows], schema)
    records = [
        F.struct(*[F.lit(cell).cast(kind).alias(name) for cell, (name, kind) in zip(row, fields)])
        for row in rows
    ]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*records))))


# ---------------------------------------------------------------------------
# Fixed values.  These must equal the published ones for the results to match.
# ---------------------------------------------------------------------------

# Statuses a record may have to take part in a comparison.
ACCEPTED_STATUSES = ("present", "optional")

# Order of unit systems among otherwise equal records; anything else comes last.
UNIT_SYSTEM_ORDER = ("metric", "us")

# Mappings below this confidence are reported.
MIN_CONFIDENCE = 0.7

# Missing-rate reports cover canonical items up to this priority.
MAX_REPORT_PRIORITY = 2

# (canonical item, column of the comparison table)
CORE_ITEMS = [
    ("operating_weight", "operating_weight_kg"),
    ("engine_power", "engine_power_kw"),
    ("lift_height", "lift_height_mm"),
    ("lift_capacity", "lift_capacity_kg"),
    ("tipping_load_straight", "tipping_load_straight_kg"),
    ("tipping_load", "tipping_load_unspec_kg"),
    ("rated_operating_capacity", "rated_operating_capacity_kg"),
    ("max_travel_speed", "max_travel_speed_kmh"),
    ("aux_hydraulic_flow", "aux_hydraulic_flow_lmin"),
    ("aux_hydraulic_pressure", "aux_hydraulic_pressure_mpa"),
    ("overall_length", "overall_length_mm"),
    ("overall_width", "overall_width_mm"),
    ("overall_height", "overall_height_mm"),
]

# (canonical item, column of the comparison table, value kind)
FULL_ITEMS = [
    ("operating_weight", "operating_weight_kg", "numeric"),
    ("lift_height", "lift_height_mm", "numeric"),
    ("lift_capacity", "lift_capacity_kg", "numeric"),
    ("tipping_load_straight", "tipping_load_straight_kg", "numeric"),
    ("tipping_load_articulated", "tipping_load_articulated_kg", "numeric"),
    ("tipping_load", "tipping_load_unspec_kg", "numeric"),
    ("rated_operating_capacity", "rated_operating_capacity_kg", "numeric"),
    ("rated_operating_capacity_articulated", "roc_articulated_kg", "numeric"),
    ("breakout_force", "breakout_force_kn", "numeric"),
    ("traction_force", "traction_force_kn", "numeric"),
    ("pushing_force", "pushing_force_kn", "numeric"),
    ("max_travel_speed", "max_travel_speed_kmh", "numeric"),
    ("bucket_capacity", "bucket_capacity_m3", "numeric"),
    ("telescopic_boom", "telescopic_boom", "text"),
    ("telescopic_length", "telescopic_length_mm", "numeric"),
    ("ground_pressure", "ground_pressure_kgm2", "numeric"),
    ("engine_model", "engine_model", "text"),
    ("engine_power", "engine_power_kw", "numeric"),
    ("engine_torque", "engine_torque_nm", "numeric"),
    ("engine_displacement", "engine_displacement_cc", "numeric"),
    ("engine_cylinders", "engine_cylinders", "numeric"),
    ("fuel_type", "fuel_type", "text"),
    ("fuel_tank_capacity", "fuel_tank_capacity_l", "numeric"),
    ("emissions_standard", "emissions_standard", "text"),
    ("battery_capacity", "battery_capacity_kwh", "numeric"),
    ("charge_time", "charge_time_h", "numeric"),
    ("motor_power_drive", "motor_power_drive_kw", "numeric"),
    ("motor_power_implement", "motor_power_implement_kw", "numeric"),
    ("aux_hydraulic_flow", "aux_hydraulic_flow_lmin", "numeric"),
    ("aux_hydraulic_pressure", "aux_hydraulic_pressure_mpa", "numeric"),
    ("aux_hydraulic_flow_high", "aux_hydraulic_flow_high_lmin", "numeric"),
    ("overall_length", "overall_length_mm", "numeric"),
    ("overall_length_with_bucket", "length_with_bucket_mm", "numeric"),
    ("overall_width", "overall_width_mm", "numeric"),
    ("overall_height", "overall_height_mm", "numeric"),
    ("wheelbase", "wheelbase_mm", "numeric"),
    ("ground_clearance", "ground_clearance_mm", "numeric"),
    ("turning_radius_inner", "turning_radius_inner_mm", "numeric"),
    ("turning_radius_outer", "turning_radius_outer_mm", "numeric"),
    ("dump_height", "dump_height_mm", "numeric"),
    ("transmission", "transmission", "text"),
    ("standard_tires", "standard_tires", "text"),
    ("warranty", "warranty", "text"),
]

# Unit suffixes of wide-layout column names.
UNIT_SUFFIXES = {
    "_kg": "kg",
    "_mm": "mm",
    "_Lmin": "L/min",
    "_bar": "bar",
    "_MPa": "MPa",
    "_kgf": "kgf",
    "_kmh": "km/h",
}

# Column names that mark a role in a raw sheet.
COLUMN_ROLES = [
    ("company", "メーカー"),
    ("company", "メーカー名"),
    ("model", "型式"),
    ("model", "SAL型式"),
    ("item", "項目"),
    ("item", "仕様項目"),
    ("value", "仕様値"),
    ("value", "数値"),
    ("value", "内容"),
    ("value", "US値"),
    ("value", "メートル数値"),
    ("value", "メートル値"),
    ("value", "仕様_US値"),
    ("value", "US数値"),
    ("category", "区分"),
    ("category", "大分類"),
    ("category", "中分類"),
    ("category", "分類"),
    ("category", "仕様カテゴリ"),
    ("category", "大項目"),
    ("category", "セクション"),
]
ROLE_ORDER = ("company", "model", "item", "value", "category")
NO_ROLE = "(該当なし)"

# (metric, source column, unit to parse, conversion family, extraction mode,
#  histogram step)
METRICS = [
    ("horsepower", "horsepower", "hp", None, "range_max", 1),
    ("lift_capacity", "lift_capacity_kg", "kg", "weight", "range_max", 100),
    ("lift_height", "lift_height_mm", "mm", "length", "range_max", 100),
    ("telescopic_length", "telescopic_length_mm", "mm", "length", "range_max", 100),
    ("aux_flow", "aux_hydraulic_flow_pressure_l_min_mpa", "L/min", "flow", "first", 1),
    ("aux_pressure", "aux_hydraulic_flow_pressure_l_min_mpa", "MPa", "pressure", "second", 20),
    ("max_breakout_force", "max_breakout_force_kgf", "kgf", "force", "range_max", 10),
    ("max_tow_force", "max_tow_force_kgf", "kgf", "force", "range_max", 10),
    ("max_torque", "max_torque_nm_rpm", "N·m", "torque", "first", 10),
    ("max_speed", "max_speed_kmh", "km/h", "speed", "range_max", 1),
    ("operating_weight", "operating_weight_kg", "kg", "weight", "range_max", 100),
    ("turning_radius_inner", "turning_radius_inner_outer_mm", "mm", "length", "first", 100),
    ("turning_radius_outer", "turning_radius_inner_outer_mm", "mm", "length", "second", 100),
    ("width", "width_mm", "mm", "length", "first", 200),
    ("length", "length_mm", "mm", "length", "range_max", 100),
    ("height", "height_mm", "mm", "length", "range_max", 200),
    ("battery_capacity", "battery_capacity", "kWh", None, "range_max", 1),
]

# Conversion families: metric unit, US unit, and what a metric value is
# multiplied or divided by.
US_FAMILIES = {
    "length": ("mm", "in", "divide", 25.4),
    "weight": ("kg", "lb", "multiply", 2.2046226218),
    "speed": ("km/h", "mph", "multiply", 0.6213711922),
    "flow": ("L/min", "gpm", "divide", 3.785411784),
    "pressure": ("MPa", "PSI", "multiply", 145.03773773),
    "force": ("kgf", "lbf", "multiply", 2.2046226218),
    "torque": ("N·m", "lb-ft", "multiply", 0.7375621493),
}

# Units shown as whole numbers.
WHOLE_NUMBER_UNITS = ("mm", "kg", "hp", "kgf", "kWh")

# Sort keys for things without a place of their own.
NO_SERIES_NUMBER = 9999
NO_BRAND_RANK = 999

# Document rules.
WIKILINK_PATTERN = r"\[\[([^\]#|]+)(?:[#|][^\]]*)?\]\]"
INLINE_CODE_PATTERN = r"`[^`]*`"
INDEX_ENTRY_PATTERN = r"^-\s+`([^`]+)`:"
LOG_HEADING_PATTERN = r"^## \[\d{4}-\d{2}-\d{2}\] (ingest|query|lint) \| .+"
PAGE_NAME_PATTERN = r"page-(\d+)(?:_[^.]+)?\.md$"
REQUIRED_SECTIONS = ("Related Links", "Provenance", "Last Updated")
