"""Rule tables (SRC3 / UDX3): targets and levers as small broadcast DataFrames.

They are parameters, not data: ten rows each, independent of the fact size,
so broadcasting them is bounded by construction. ``read_seed`` loads the same
shape from a user's CSV (quoted commas, pinned types, empty = NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType(), False),
    T.StructField("direction", T.StringType(), False),
    T.StructField("target_min", T.DoubleType(), True),
    T.StructField("target_optimal", T.DoubleType(), True),
    T.StructField("target_max", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
])

# Evidence targets (metric, direction, min, optimal, max, unit).
TARGETS = [
    ("sleep_hours_7d", "higher_better", 7.5, 8.5, None, "hours/night"),
    ("protein_gpkg_7d", "higher_better", 1.4, 1.8, None, "g/kg/day"),
    ("carbs_gpkg_7d", "higher_better", 5.0, 6.5, None, "g/kg/day"),
    ("hydration_l_7d", "higher_better", 2.6, 3.2, None, "L/day"),
    ("acwr", "band", 0.8, 1.05, 1.3, "ratio"),
    ("nordic_n", "higher_better", 300.0, 350.0, None, "N (per leg)"),
    ("cmj_cm", "higher_better", None, None, None, "cm"),
    ("sprint_30m_s", "lower_better", None, None, None, "seconds (30 m)"),
    ("yoyo_ir1_m", "higher_better", None, None, None, "metres"),
    ("squat_1rm_rel", "higher_better", None, None, None, "x bodyweight"),
]

LEVER_SCHEMA = T.StructType([
    T.StructField("lever_id", T.StringType(), False),
    T.StructField("label", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("metric", T.StringType(), True),
    T.StructField("feature_shifts", T.StringType(), True),
    T.StructField("step_size", T.DoubleType(), True),
    T.StructField("step_type", T.StringType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("horizon", T.StringType(), True),
    T.StructField("coaching_action", T.StringType(), True),
    T.StructField("catalog_order", T.IntegerType(), False),
])

# Lever catalog (id, label, category, metric, packed shifts, step, type, unit, horizon).
LEVERS = [
    ("sleep_duration", "Sleep more", "recovery", "sleep_hours_7d",
     "sleep_hours_3d:1.0|sleep_hours_7d:1.0|sleep_hours_28d:0.5", 0.5, "add", "hours/night", "weeks"),
    ("protein_intake", "Eat more protein", "nutrition", "protein_gpkg_7d",
     "protein_gpkg_7d:1.0", 0.3, "add", "g/kg/day", "weeks"),
    ("carb_fueling", "Fuel carbohydrates to load", "nutrition", "carbs_gpkg_7d",
     "carbs_gpkg_3d:1.0|carbs_gpkg_7d:1.0", 1.0, "add", "g/kg/day", "days"),
    ("hydration", "Hydrate more", "nutrition", "hydration_l_7d",
     "hydration_l_3d:1.0|hydration_l_7d:1.0", 0.4, "add", "L/day", "days"),
    ("load_management", "Re-balance training load", "load", "acwr",
     "acute_load_7d:1.0", 0.15, "scale", "ratio", "days"),
    ("aerobic_capacity", "Build aerobic capacity", "physical", "yoyo_ir1_m",
     "yoyo_ir1_m:1.0", 120.0, "add", "metres", "months"),
    ("sprint_speed", "Improve sprint speed", "physical", "sprint_30m_s",
     "sprint_30m_s:1.0", -0.05, "add", "seconds (30 m)", "months"),
    ("explosive_power", "Increase explosive power", "physical", "cmj_cm",
     "cmj_cm:1.0", 2.0, "add", "cm", "months"),
    ("max_strength", "Increase max strength", "physical", "squat_1rm_rel",
     "squat_1rm_rel:1.0", 0.15, "add", "x bodyweight", "months"),
    ("hamstring_strength", "Strengthen hamstrings", "physical", "nordic_n",
     "nordic_n:1.0", 40.0, "add", "N (per leg)", "months"),
]

# Risk band cuts on the calibrated 7-day probability, highest first.
RISK_BANDS = [(0.20, "Critical"), (0.10, "High"), (0.05, "Moderate"), (0.0, "Low")]
BAND_ORDER = ["Low", "Moderate", "High", "Critical"]


def targets(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(TARGETS, TARGET_SCHEMA))


def levers(spark: SparkSession) -> DataFrame:
    rows = [(*r, f"{r[1]}: see the {r[3]} programme", i) for i, r in enumerate(LEVERS)]
    return F.broadcast(spark.createDataFrame(rows, LEVER_SCHEMA))


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC3: a rule CSV with a header, quoted commas, pinned types, empty cell = NULL."""
    return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', nullValue="")
