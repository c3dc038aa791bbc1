"""Golden rows of the reference's two unit tests, plus window / join properties."""

import datetime as dt

from pyspark.sql import functions as F

from tidepanel.functions import columns as C
from tidepanel.functions import frames as W
from tidepanel.operators.dedupe import dedupe_latest, dedupe_latest_window
from tidepanel.operators.panel import assemble, interval_days, interval_days_between

D0 = dt.date(2025, 1, 1)


def _sessions(spark):
    rows = [
        ("S1", "A1", D0, 60.0, 5.0, 8.0, "ms", dt.datetime(2025, 1, 2, 1)),
        ("S2", "A1", D0 + dt.timedelta(1), 90.0, 8.0, 31.0, "kmh", dt.datetime(2025, 1, 3, 1)),
        ("S2", "A1", D0 + dt.timedelta(1), 90.0, 8.0, 31.0, "kmh", dt.datetime(2025, 1, 3, 7)),
        ("S3", "A1", D0 + dt.timedelta(2), 60.0, 5.0, 99.9, "kmh", dt.datetime(2025, 1, 4, 1)),
    ]
    return spark.createDataFrame(rows, "session_id string, entity_id string, session_date date, duration_min double, "
                                       "rpe double, max_speed_raw double, speed_unit string, loaded_at timestamp")


def test_unit_conversion_dedupe_and_glitch(spark):
    s = dedupe_latest(_sessions(spark), ["session_id"], ["loaded_at"])
    speed = C.convert_unit("max_speed_raw", "speed_unit", {"ms": 3.6})
    out = s.select("session_id", C.null_outside(speed, hi=45.0).alias("max_speed_kmh"),
                   (F.col("duration_min") * F.col("rpe")).alias("srpe_load"))
    got = {r.session_id: (None if r.max_speed_kmh is None else round(r.max_speed_kmh, 6), r.srpe_load)
           for r in out.collect()}
    assert got == {"S1": (28.8, 300.0), "S2": (31.0, 720.0), "S3": (None, 300.0)}


def test_dedupe_forms_agree(spark):
    a = dedupe_latest(_sessions(spark), ["session_id"], ["loaded_at"]).select("session_id", "loaded_at")
    b = dedupe_latest_window(_sessions(spark), ["session_id"], ["loaded_at"]).select("session_id", "loaded_at")
    assert sorted(a.collect()) == sorted(b.collect())


def test_prior_windows_exclude_today(spark):
    rows = [("A1", D0 + dt.timedelta(i), float(100 * (i + 1))) for i in range(9)]
    df = spark.createDataFrame(rows, "entity_id string, date_day date, daily_load double")
    out = df.select("date_day", F.avg("daily_load").over(W.prior(7)).alias("acute"),
                    F.avg("daily_load").over(W.prior(28)).alias("chronic")).orderBy("date_day").collect()
    acute = [r.acute for r in out]
    chronic = [r.chronic for r in out]
    assert acute == [None, 100, 150, 200, 250, 300, 350, 400, 500]
    assert chronic == [None, 100, 150, 200, 250, 300, 350, 400, 450]


def test_prior_frame_ignores_todays_value(spark):
    rows = [("A1", D0 + dt.timedelta(i), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "entity_id string, date_day date, x double")
    changed = df.withColumn("x", F.when(F.col("date_day") == D0 + dt.timedelta(5), 1e6).otherwise(F.col("x")))
    pick = lambda d: d.select("date_day", F.avg("x").over(W.prior(3)).alias("a")).where(
        F.col("date_day") == D0 + dt.timedelta(5)).first().a
    assert pick(df) == pick(changed)


def test_future_frame_needs_label_flag():
    import pytest

    with pytest.raises(ValueError):
        W.future(7)


def test_interval_explode_equals_between(spark):
    spine = spark.createDataFrame([("A", D0 + dt.timedelta(i)) for i in range(30)], "entity_id string, date_day date")
    iv = spark.createDataFrame([("A", D0 + dt.timedelta(2), D0 + dt.timedelta(6)),
                                ("A", D0 + dt.timedelta(5), D0 + dt.timedelta(9)),
                                ("A", D0 + dt.timedelta(28), D0 + dt.timedelta(35))],
                               "entity_id string, f date, t date")
    a = interval_days(iv, "f", "t").join(spine, ["entity_id", "date_day"], "left_semi")
    b = interval_days_between(spine, iv, "f", "t")
    assert sorted(a.select("entity_id", "date_day").collect()) == sorted(b.select("entity_id", "date_day").collect())


def test_union_aggregate_equals_left_joins(spark):
    spine = spark.createDataFrame([("A", D0 + dt.timedelta(i), i + 1) for i in range(5)],
                                  "entity_id string, date_day date, day_index int")
    load = spark.createDataFrame([("A", D0, 10.0), ("A", D0 + dt.timedelta(3), 5.0), ("A", D0 + dt.timedelta(9), 1.0)],
                                 "entity_id string, date_day date, daily_load double")
    sleep = spark.createDataFrame([("A", D0 + dt.timedelta(1), 7.0)], "entity_id string, date_day date, sleep double")
    u = assemble(spine, [(load, {"daily_load": "daily_load"}), (sleep, {"sleep": "sleep"})],
                 entity="entity_id", zero_fill=["daily_load"])
    j = (spine.join(load, ["entity_id", "date_day"], "left").join(sleep, ["entity_id", "date_day"], "left")
         .select("entity_id", "date_day", "day_index", F.coalesce("daily_load", F.lit(0.0)).alias("daily_load"), "sleep"))
    cols = ["entity_id", "date_day", "day_index", "daily_load", "sleep"]
    assert sorted(u.select(cols).collect()) == sorted(j.select(cols).collect())


def test_severity_and_interval(spark):
    df = spark.createDataFrame([(D0, 3), (D0, 7), (D0, 28), (D0, 29)], "d date, days_out int")
    s, e = C.interval_of("d", "days_out")
    out = df.select(C.severity_band("days_out").alias("b"), s.alias("s"), e.alias("e")).collect()
    assert [r.b for r in out] == ["minimal", "mild", "moderate", "severe"]
    assert out[0].s == D0 + dt.timedelta(1) and out[3].e == D0 + dt.timedelta(29)


def test_acwr_zone_and_risk_band(spark):
    df = spark.createDataFrame([(None,), (0.5,), (1.0,), (1.4,), (2.0,)], "x double")
    assert [r.z for r in df.select(C.acwr_zone("x").alias("z")).collect()] == \
        [None, "undertrained", "sweet_spot", "caution", "danger"]
    p = spark.createDataFrame([(0.01,), (0.05,), (0.1,), (0.25,)], "p double")
    assert [r.b for r in p.select(C.risk_band("p").alias("b")).collect()] == ["Low", "Moderate", "High", "Critical"]
