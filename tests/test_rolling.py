"""Rolling features by blocks of Arrow rows: those of window frames, whatever the blocks, and only the wanted rows and columns."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepanel.functions import frames as W
from tidepanel.operators import rolling
from tidepanel.operators.panel import DayRows, join_days
from tidepanel.plans import pipeline
from tidepanel.plans.catalog import finish
from tidepanel.plans.model import ModelMarts
from tidepanel.session import HUGE_METHOD
from test_plan_shape import tables

D0 = dt.date(2025, 1, 1)
FRAMES = {"prior": W.prior, "incl": W.incl, "future": lambda n: W.future(n, for_label=True), "all_prior": lambda n: W.all_prior(), "all_incl": lambda n: W.all_incl()}


def window(agg, src, frame, n):
    c, w = F.col(src), FRAMES[frame](n)
    return {"avg": lambda: F.avg(c), "sum": lambda: F.sum(c), "max": lambda: F.max(c), "stddev": lambda: F.stddev_samp(c), "rate": lambda: F.count(c), "rows": lambda: F.count(F.lit(1)),
            "last": lambda: F.last(c, ignorenulls=True), "last_day": lambda: F.max(F.when(c.isNotNull(), F.col("date_day"))),
            "last_day_flag": lambda: F.max(F.when(c == 1, F.col("date_day"))), "count_flag": lambda: F.sum(c)}[agg]().over(w)


@pytest.fixture
def panel(spark):
    rng = random.Random(3)
    rows = []
    for e, days in ((1, 90), (2, 1), (3, 2), (7, 45), (8, 30)):
        same = rng.random() * 7
        for i in range(days):
            x = None if rng.random() < 0.4 else rng.choice([same, rng.random() * 1e3, -0.0, 1e-9]) if e != 8 else 0.07 * 1000
            rows.append((e, D0 + dt.timedelta(i), x, rng.random() * 100, None if rng.random() < 0.5 else rng.randrange(-5, 9), rng.choice([0, 0, 0, 1]), rng.choice("ab")))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "entity_id long, date_day date, x double, y double, k long, flag long, tag string").repartition(3, "entity_id")


ALL = [(a, s, f, n) for a, s in (("avg", "x"), ("sum", "x"), ("max", "x"), ("stddev", "x"), ("avg", "y"), ("sum", "k"), ("max", "k"), ("stddev", "y")) for f, n in (("prior", 3), ("prior", 28), ("incl", 7), ("future", 7))]
ALL += [(a, s, f, 0) for f in ("all_prior", "all_incl") for a, s in (("last", "x"), ("last", "k"), ("last_day", "x"), ("last_day_flag", "flag"), ("count_flag", "flag"))]
ALL += [("rate", "x", "prior", 7), ("rows", "x", "future", 7), ("rows", "x", "prior", 28)]


@pytest.mark.parametrize("block", [1, 50, 10_000])
def test_features_are_those_of_window_frames_to_the_last_bit(spark, panel, monkeypatch, block):
    monkeypatch.setattr(rolling, "BLOCK_ROWS", block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        features = [(f"f{i}", *f) for i, f in enumerate(ALL)]
        got = rolling.rolled(panel, features, ["entity_id", "date_day", "tag"])
        one = lambda c, f: F.coalesce(c, F.lit(0)).cast("long") if f[0] == "count_flag" else c / F.lit(float(f[3])) if f[0] == "rate" else c
        want = panel.select("entity_id", "date_day", "tag", *[one(window(*f), f).alias(f"f{i}") for i, f in enumerate(ALL)])
        assert got.dtypes == want.dtypes
        rows = want.collect()
        assert Counter(map(repr, got.collect())) == Counter(map(repr, rows)) and len(rows) == 168
        some = rolling.rolled(panel, features[:4], ["entity_id"], rows=(F.col("flag") == 1) & (F.col("k") > 0))
        assert Counter(map(tuple, some.collect())) == Counter(map(tuple, want.join(panel.where("flag = 1 AND k > 0").select("entity_id", "date_day"), ["entity_id", "date_day"], "left_semi").select("entity_id", "f0", "f1", "f2", "f3").collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_formulas(spark, panel):
    made = {"r": ("ratio", "x", ("minus", "k", "flag")), "t": ("times", "k", "flag"), "d": ("days", "seen"), "y": ("years", "seen"), "o": ("over", "k", 3), "e": ("equals", "flag", 1), "again": "y"}
    got = rolling.rolled(panel.withColumn("k2", F.col("k")), [("seen", "last_day", "x", "all_prior", 0)], ["entity_id", "date_day"], made=made)
    seen = F.max(F.when(F.col("x").isNotNull(), F.col("date_day"))).over(W.all_prior())
    below = F.col("k") - F.col("flag")
    gone = F.datediff("date_day", "seen")
    want = panel.withColumn("seen", seen).select("entity_id", "date_day", F.try_divide("x", F.when(below != 0, below.cast("double"))).alias("r"), (F.col("k") * F.col("flag")).alias("t"), gone.cast("long").alias("d"),
                                                 (gone / 365.25).alias("y"), (F.col("k") > 3).cast("long").alias("o"), (F.col("flag") == 1).cast("long").alias("e"), F.col("y").alias("again"))
    assert got.dtypes == want.dtypes and Counter(map(repr, got.collect())) == Counter(map(repr, want.collect()))


def test_unique_days_join_as_themselves(spark, panel):
    side = DayRows(F.col("k") > 0, {"other": F.col("y")})
    for how in ("inner", "left"):
        args = (panel, ["x"], [(side, how)])
        got, want = (join_days(*args, where=F.col("flag") == 1, unique=u) for u in (True, False))
        assert got.columns == want.columns and Counter(map(repr, got.collect())) == Counter(map(repr, want.collect())) and got.count()
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_large_fact_computes_what_is_read(spark, tmp_path, monkeypatch):
    """Queries on a fact that isn't kept roll only the features that they read, with no window operator over wide rows and one computation for the latest day."""
    import pyarrow.parquet as pq

    folder = tables(tmp_path, lines=900)
    suppliers = pq.read_table(f"{folder}/supplier.parquet")
    pq.write_table(suppliers.slice(0, 6), f"{folder}/supplier.parquet")
    rolls, plain = [], pipeline.rolled

    def watched(panel, features, *rest):
        rolls.append([f[0] for f in features])
        return plain(panel, features, *rest)
    monkeypatch.setattr(pipeline, "rolled", watched)
    monkeypatch.setattr(pipeline, "KEPT_FACT_ROWS", 0)
    p = pipeline.PanelPipeline(pipeline.SupplierFeeds(spark, folder))
    assert p.one_row_days and spark.conf.get(HUGE_METHOD) == "8000"
    zones = p.fact_of(["acwr_zone", "has_full_history"])
    assert rolls == [["acute_load_7d", "chronic_load_28d"]] and "Window" not in zones._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    rows = lambda df: sorted(map(str, finish(df).collect()))
    assert rows(zones) == rows(p.fact.select("entity_id", "date_day", "acwr_zone", "has_full_history"))
    m = ModelMarts(p)
    del rolls[:]
    latest = rows(m.latest_day_risk)
    m.watchlist()
    assert len(rolls) == 1 and latest
    timeline = m.risk_timeline()
    assert "Window" not in timeline._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    last = max(r.date_day for r in timeline.collect())
    assert latest == rows(timeline.where(F.col("date_day") == F.lit(last)).select(m.latest_day_risk.columns))
