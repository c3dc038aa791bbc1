"""Exact medians, closed-form ridge and paired effects against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.functions import scores as S
from tidepanel.operators import levers as L
from tidepanel.operators.baseline import ridge
from tidepanel.operators.medians import exact_medians, from_key, sort_keys


def test_keys_keep_the_order_of_doubles():
    x = np.array([-np.inf, -1e300, -2.5, -1e-310, -0.0, 0.0, 1e-310, 1.0, np.nextafter(1.0, 2), 7e200, np.inf])
    k = sort_keys(x)
    assert (np.sort(k) == k).all() and k[4] == k[5] and len(set(k.tolist())) == 10
    assert [from_key(int(v)) for v in k] == (x + 0.0).tolist()


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_exact_medians(spark, n):
    rng = np.random.default_rng(n)
    x = np.column_stack([rng.normal(0, 1e3, n), rng.integers(-2, 3, n).astype(float), np.full(n, 4.25), 10.0 ** rng.uniform(-300, 300, n) * rng.choice([-1, 1], n)])
    rows = [(*map(float, r), None, float("nan"), None if i % 3 else float(i)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, g double").repartition(5)
    got = exact_medians(df, df.columns)
    assert [got[c] for c in "abcd"] == np.median(x, axis=0).tolist()
    assert got["e"] is None and got["f"] is None and got["g"] == np.median([i for i in range(n) if i % 3 == 0])
    assert exact_medians(df.limit(0), ["a", "b"]) == {"a": None, "b": None}


def test_ridge_solves_the_penalised_equations(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(1e5, 1, 400), rng.normal(0, 1e-3, 400), rng.integers(0, 2, 400).astype(float), np.full(400, 8.0)])
    y = 2 * (x[:, 0] - 1e5) + 500 * x[:, 1] - x[:, 2] + rng.normal(0, 0.1, 400) + 3
    hole = rng.random(x.shape) < 0.1
    rows = [(*[None if h else float(v) for v, h in zip(r, hs)], None, float(t)) for r, hs, t in zip(x, hole, y)] + [(1.0, 1.0, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, y double").repartition(6)
    model = ridge(df, list("abcde"), "y", 50.0)
    full = np.column_stack([np.where(hole, [np.median(c[~h]) for c, h in zip(x.T, hole.T)], x), np.zeros(400)])
    sd = full.std(axis=0)
    z = (full - full.mean(axis=0)) / np.where(sd > 0, sd, 1)
    w = np.linalg.solve(z.T @ z + 50 * np.eye(5), z.T @ (y - y.mean()))
    want = sorted((z @ w + y.mean()).tolist())
    got = sorted(r.p for r in df.where("y IS NOT NULL").select(model.prediction().alias("p")).collect())
    assert np.allclose(got, want, rtol=0, atol=1e-7) and model.weight[3] == model.weight[4] == 0
    empty = ridge(df.limit(0), ["a"], "y")
    assert df.select(empty.prediction().alias("p")).distinct().collect()[0].p == 0.0


def test_paired_effects_fill_both_sides_alike(spark):
    names = [*S.NEUTRAL, "days_since_return"]
    base = {c: 1.5 * v + 0.1 for c, v in S.NEUTRAL.items()} | {"days_since_return": None}
    rows = [(1, "sleep", 0.5, *[base[c] for c in names], 9.0), (1, "sleep", 0.5, *[None if c == "hrv_z" else base[c] for c in names], None), (2, "none", 0.0, *[base[c] for c in names], 9.0)]
    df = spark.createDataFrame(rows, "entity_id int, lever_id string, step double, " + ", ".join(f"{c} double" for c in names) + ", sleep_hours_3d_after double")
    df = df.withColumn("sleep_hours_3d", F.lit(7.0))
    fill = {"hrv_z": -1.0, "sleep_hours_3d": 7.5, "acwr": None}
    got = L.paired_effects(df, fill, ["sleep_hours_3d"], names, {"rating": S.rating_score, "log_rate": S.log_hazard_rate}).collect()
    clip = lambda h: 0.32 * max(min(h - 8.0, 0.5), -3.0)
    want = (clip(9.0) - clip(7.0) + clip(7.5) - clip(7.0)) / 2
    assert [(r.entity_id, r.lever_id, r.n_rows) for r in got] == [(1, "sleep", 2)]
    assert got[0].rating_change == pytest.approx(want) and got[0].log_rate_change == pytest.approx(0.0)
