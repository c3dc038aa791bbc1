"""Lever edits (parse, add, per-row step, scale with dependents, bad type) and score directions."""

import math

import pytest
from pyspark.sql import functions as F

from tidepanel.functions import scores as S
from tidepanel.operators import levers as L

FEATS = ["sleep_hours_3d", "sleep_hours_7d", "sleep_hours_28d", "acute_load_7d", "chronic_load_28d", "acwr",
         "load_strain_7d"]


def frame(spark, spec, step_type, steps):
    rows = [(6.0, 6.5, 6.8, 500.0, 250.0, 2.0, 4000.0, spec, step_type, steps[0]),
            (7.0, 7.5, 7.2, 300.0, 300.0, 1.0, 2000.0, spec, step_type, steps[1])]
    schema = ", ".join(f"{f} double" for f in FEATS) + ", feature_shifts string, step_type string, __step double"
    return spark.createDataFrame(rows, schema).withColumn("__shifts", L.shift_map())


def apply(spark, spec, step_type, steps):
    df = frame(spark, spec, step_type, steps)
    after = L.applied(FEATS)
    return df.select(*[after[f].alias(f) for f in FEATS]).collect()


def test_parse_shifts(spark):
    cat = spark.createDataFrame([("x", "a:1.0|b:0.5")], "lever_id string, feature_shifts string")
    got = sorted((r.feature, r.weight) for r in L.parse_shifts(cat).collect())
    assert got == [("a", 1.0), ("b", 0.5)]


def test_add_lever_weights(spark):
    out = apply(spark, "sleep_hours_3d:1.0|sleep_hours_28d:0.5", "add", [1.0, 1.0])
    assert [r.sleep_hours_3d for r in out] == [7.0, 8.0]
    assert [r.sleep_hours_28d for r in out] == pytest.approx([7.3, 7.7])
    assert [r.sleep_hours_7d for r in out] == [6.5, 7.5]


def test_per_row_steps(spark):
    out = apply(spark, "sleep_hours_3d:1.0", "add", [0.5, 0.0])
    assert [r.sleep_hours_3d for r in out] == [6.5, 7.0]


def test_scale_recomputes_dependents(spark):
    out = apply(spark, "acute_load_7d:1.0", "scale", [-0.2, -0.2])
    assert [r.acute_load_7d for r in out] == pytest.approx([400.0, 240.0])
    assert [r.acwr for r in out] == pytest.approx([1.6, 0.8])
    assert [r.load_strain_7d for r in out] == pytest.approx([3200.0, 1600.0])


def test_unknown_step_type_raises(spark):
    with pytest.raises(Exception):
        apply(spark, "sleep_hours_3d:1.0", "multiply", [1.0, 1.0])


def test_step_capped_by_shortfall(spark):
    df = spark.createDataFrame([("add", 0.5, 0.2, "increase"), ("add", -0.05, 1.0, "decrease"),
                                ("scale", 0.15, 0.0, "decrease"), ("scale", 0.15, 0.0, "maintain")],
                               "step_type string, step_size double, shortfall double, needed_direction string")
    got = [r.s for r in df.select(L.step_column().alias("s")).collect()]
    assert got == pytest.approx([0.2, -0.05, -0.15, 0.0])


BASE = dict(yoyo_ir1_m=2100.0, sprint_30m_s=4.20, cmj_cm=38.0, squat_1rm_rel=1.7, nordic_n=340.0,
            sleep_hours_3d=8.0, sleep_hours_7d=8.0, carbs_gpkg_3d=6.0, protein_gpkg_7d=1.7, hydration_l_3d=3.0,
            acwr=1.0, hrv_z=0.0, days_since_return=None, prior_injuries=0.0, age_years=26.0)


def score(spark, **over):
    row = {**BASE, **over}
    cols = list(row)
    schema = ", ".join(f"{c} double" for c in cols)
    df = spark.createDataFrame([tuple(row[c] for c in cols)], schema)
    r = df.select(S.rating_score().alias("r"), S.log_hazard_rate().alias("k")).first()
    return r.r, r.k


def test_more_sleep_helps(spark):
    lo, hi = score(spark, sleep_hours_3d=6.0, sleep_hours_7d=6.0), score(spark, sleep_hours_3d=7.5, sleep_hours_7d=7.5)
    assert hi[0] > lo[0] and hi[1] < lo[1]


def test_acwr_spike_hurts_and_sweet_spot_flat(spark):
    ok, spike = score(spark, acwr=1.0), score(spark, acwr=1.8)
    assert spike[1] > ok[1] and spike[0] < ok[0]
    assert score(spark, acwr=0.9)[1] == score(spark, acwr=1.25)[1]


def test_hamstrings_and_sprint(spark):
    weak, strong = score(spark, nordic_n=230.0), score(spark, nordic_n=400.0)
    assert weak[1] > strong[1] and weak[0] == strong[0]
    assert score(spark, sprint_30m_s=4.05)[0] > score(spark, sprint_30m_s=4.35)[0]


def test_exposure_weights_and_hazard(spark):
    w = S.EXPOSURE_WEIGHT
    assert w["match"] > w["training"] > w["recovery"]
    df = spark.createDataFrame([("match",), ("nope",)], "t string")
    assert [r.w for r in df.select(S.exposure_weight("t").alias("w")).collect()] == [5.0, 0.0]
    h = spark.range(1).select(S.hazard(F.lit(math.log(0.1)), F.lit(2.0)).alias("h")).first().h
    assert h == pytest.approx(1 - math.exp(-0.2))
