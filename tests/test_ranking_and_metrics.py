"""Distributed ranks, percentiles and metrics against brute force on small fixtures."""

import random

import numpy as np
import pytest

from tidepanel.operators import checks as Q
from tidepanel.operators import evaluate as EV
from tidepanel.operators.ranking import exact_row_number, percent_rank_exact, percentile_cont, running_totals


def _data(spark, n=500, seed=3):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", "b", "c"]), round(rnd.random(), 2), int(rnd.random() < 0.2)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, g string, p double, y int")


def test_exact_row_number_matches_sort(spark):
    rows, df = _data(spark)
    got = {r.id: r.rk for r in exact_row_number(df, ["g"], ["p", "id"], name="rk").collect()}
    for g in "abc":
        ids = [r[0] for r in sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))]
        assert [got[i] for i in ids] == list(range(1, len(ids) + 1))


def test_percentile_cont_matches_numpy(spark):
    rows, df = _data(spark)
    got = {r.g: (r.p25, r.p50, r.p75) for r in percentile_cont(df, ["g"], "p", [0.25, 0.5, 0.75]).collect()}
    for g in "abc":
        v = np.array([r[2] for r in rows if r[1] == g])
        assert got[g] == pytest.approx(tuple(np.percentile(v, [25, 50, 75])))


def test_percent_rank_ties_share_lowest(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 3.0)], "g string, v double")
    got = sorted((r.v, r.pr) for r in percent_rank_exact(df, ["g"], "v", "pr").collect())
    assert [x[1] for x in got] == pytest.approx([0.0, 1 / 3, 1 / 3, 1.0])


def test_running_totals(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(1, 101)], "s double, c long")
    got = sorted((r.s, r.c_cum) for r in running_totals(df, ["s"], ["c"]).collect())
    assert [x[1] for x in got] == list(np.cumsum(range(1, 101)))


def _auc(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi == 0]
    s = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _ap(y, p):
    order = sorted(set(p), reverse=True)
    P = sum(y)
    tp = fp = 0
    ap = 0.0
    for s in order:
        pos = sum(1 for yi, pi in zip(y, p) if pi == s and yi == 1)
        neg = sum(1 for yi, pi in zip(y, p) if pi == s and yi == 0)
        tp += pos
        fp += neg
        ap += pos / P * tp / (tp + fp)
    return ap


def test_auc_and_ap_against_brute_force(spark):
    rows, df = _data(spark)
    y, p = [r[3] for r in rows], [r[2] for r in rows]
    assert EV.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(_auc(y, p))
    assert EV.average_precision(df, "y", "p").first().average_precision == pytest.approx(_ap(y, p))


def test_calibration_bins_qcut_rule(spark):
    rows, df = _data(spark, n=99)
    bins = {r.bin: r.n for r in EV.calibration_bins(df, "y", "p", ["id"]).collect()}
    n = 99
    ranks = np.arange(1, n + 1)
    expect = np.maximum(np.ceil(10 * (ranks - 1) / (n - 1)), 1) - 1
    assert bins == {int(b): int((expect == b).sum()) for b in np.unique(expect)}


def test_top_fraction(spark):
    rows, df = _data(spark)
    got = EV.top_fraction(df, "y", "p", [0.1], ["id"]).first()
    srt = sorted(rows, key=lambda r: (-r[2], r[0]))[:50]
    prec = sum(r[3] for r in srt) / 50
    assert got.k == 50 and got.precision == pytest.approx(prec)


def test_overlaps_equal_self_join(spark):
    import datetime as dt

    d = dt.date(2025, 1, 1)
    rows = [("A", "i1", d, d + dt.timedelta(5)), ("A", "i2", d + dt.timedelta(3), d + dt.timedelta(4)),
            ("A", "i3", d + dt.timedelta(10), d + dt.timedelta(12)), ("B", "i4", d, d + dt.timedelta(1))]
    iv = spark.createDataFrame(rows, "entity_id string, injury_id string, s date, e date")
    got = sorted(tuple(r) for r in Q.overlaps(iv, "entity_id", "injury_id", "s", "e").collect())
    brute = sorted((a[0], a[1], b[1]) for a in rows for b in rows
                   if a[0] == b[0] and a[1] < b[1] and a[2] <= b[2] <= a[3])
    assert got == brute


def test_overlaps_of_long_equal_and_odd_intervals(spark):
    """Random intervals with ties, copies, missing and reversed ends against the self-join; a thousand years cost two events."""
    import datetime as dt

    rng, d = random.Random(5), dt.date(2025, 1, 1)
    rows = [(rng.choice("AAAB"), f"i{rng.randrange(60):02}", s := d + dt.timedelta(rng.randrange(40)), rng.choice([None, s + dt.timedelta(rng.choice([-2, 0, 0, 1, 3, 9]))])) for _ in range(120)]
    rows += rows[:5] + [("C", "z1", dt.date(1000, 1, 1), dt.date(2999, 12, 31)), ("C", "z2", d, d), ("C", "z0", d, None), ("B", "y", None, d), (None, "x", d, d)]
    iv = spark.createDataFrame(rows, "entity_id string, injury_id string, s date, e date").repartition(3)
    found = Q.overlaps(iv, "entity_id", "injury_id", "s", "e")
    brute = {(a[0], a[1], b[1]) for a in rows for b in rows if None not in (*a, b[0], b[2]) and a[0] == b[0] and a[1] < b[1] and a[2] <= b[2] <= a[3]}
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute) and ("C", "z1", "z2") in brute
    assert Q.overlaps(iv.where("false"), "entity_id", "injury_id", "s", "e").count() == 0


def test_spearman_constant_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 2.0, 5.0), ("b", 1.0, 1.0), ("b", 2.0, 3.0), ("b", 3.0, 2.0)],
                               "g string, x double, y double")
    got = {r.g: r.spearman for r in EV.spearman(df, ["g"], "x", "y").collect()}
    assert got["a"] is None and got["b"] == pytest.approx(0.5)


def test_a_value_that_most_rows_share(spark):
    """One value in 90 % of the rows: ranks and percentiles as over sorted rows, from few cells."""
    import random

    from tidepanel.operators import ranking as R

    rng = random.Random(3)
    rows = [("g" if i % 3 else "h", 5.0 if rng.random() < 0.9 else (None if rng.random() < 0.2 else float(rng.randrange(40)))) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r.g: r for r in R.percentile_cont(df, ["g"], "v", [0.0, 0.03, 0.5, 0.97, 1.0], ["a", "b", "c", "d", "e"]).collect()}
    for g in "gh":
        vals = sorted(v for k, v in rows if k == g and v is not None)
        for p, n in zip([0.0, 0.03, 0.5, 0.97, 1.0], "abcde"):
            at = p * (len(vals) - 1)
            lo = int(at)
            hi = min(lo + 1, len(vals) - 1) if at > lo else lo
            assert abs(got[g][n] - (vals[lo] + (at - lo) * (vals[hi] - vals[lo]))) < 1e-9
    assert R.value_cells(df.where("v IS NOT NULL"), ["g"], "v").count() <= 80
    pr = {(r.g, r.v): r.pct_rank for r in R.percent_rank_exact(df, ["g"], "v").collect()}
    for (g, v), p in pr.items():
        below = sum(1 for k, x in rows if k == g and ((x is None and v is not None) or (x is not None and v is not None and x < v)))
        assert abs(p - below / (sum(1 for k, _ in rows if k == g) - 1)) < 1e-12


def test_ascending_keys_are_shuffled_once(spark, monkeypatch):
    """Ranks in ascending order carry no copy of their keys through the shuffle and the written table."""
    from tidepanel.operators import ranking

    cut, plain = [], ranking.cut_lineage
    monkeypatch.setattr(ranking, "cut_lineage", lambda df: cut.append(df.columns) or plain(df))
    df = spark.createDataFrame([(i % 2, float(i * 7 % 5), i) for i in range(20)], "g int, v double, i int")
    got = ranking.exact_row_number(df, ["g"], ["v", "i"]).collect()
    assert sorted((r.g, r.v, r.i) for r in got) == sorted((r.g, r.v, r.i) for r in sorted(got, key=lambda r: (r.g, r["rank"]))) and len(got) == 20
    assert [(r.v, r.i) for r in sorted(got, key=lambda r: r["rank"]) if r.g] == sorted((r.v, r.i) for r in got if r.g)
    assert [r["v_cum"] for r in sorted(ranking.running_totals(df, ["i"], ["v"]).collect(), key=lambda r: r.i)][-1] == sum(r.v for r in got)
    assert cut == [["g", "v", "i", "__mid"], ["g", "v", "i", "__mid", "__pid"]]
