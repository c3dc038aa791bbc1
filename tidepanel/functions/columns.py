"""Column expressions (PRJ, DRV, GAP and dimension rules).

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen. Division always goes through ``ratio`` /
``try_divide`` because ANSI mode raises on ``x / 0``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepanel.sources.rules import RISK_BANDS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- cleaning
def normalise_code(c) -> Column:
    """PRJ2: upper(trim(x))."""
    return F.upper(F.trim(col(c)))


def convert_unit(value, unit_col, factors: Mapping[str, float]) -> Column:
    """PRJ5: multiply by the factor of the row's unit; unknown units pass through."""
    expr = None
    for unit, factor in factors.items():
        cond = col(unit_col) == F.lit(unit)
        expr = F.when(cond, col(value) * F.lit(factor)) if expr is None else expr.when(cond, col(value) * F.lit(factor))
    return col(value) if expr is None else expr.otherwise(col(value))


def null_outside(c, lo: float | None = None, hi: float | None = None) -> Column:
    """PRJ6: keep the value inside [lo, hi], NULL otherwise (the row survives)."""
    x = col(c)
    if lo is not None and hi is not None:
        return F.when(x.between(F.lit(lo), F.lit(hi)), x)
    if lo is not None:
        return F.when(x >= F.lit(lo), x)
    return F.when(x <= F.lit(hi), x)


def null_if_exceeds(part, whole) -> Column:
    """PRJ7: a part is kept only when it does not exceed the whole."""
    return F.when(col(part) <= col(whole), col(part))


def present(c) -> Column:
    """PRJ8."""
    return col(c).isNotNull()


def ratio(a, b) -> Column:
    """a / nullif(b, 0) without ANSI divide-by-zero errors (DRV1, DRV2, DRV4)."""
    return F.try_divide(col(a), F.when(col(b) != 0, col(b)))


def severity_band(days) -> Column:
    """PRJ11: minimal <= 3 < mild <= 7 < moderate <= 28 < severe."""
    d = col(days)
    return (F.when(d <= 3, "minimal").when(d <= 7, "mild").when(d <= 28, "moderate").otherwise("severe"))


def interval_of(day, days_out) -> tuple[Column, Column]:
    """PRJ12: unavailable from the day after onset through onset + days_out."""
    return F.date_add(col(day), 1), F.date_add(col(day), col(days_out).cast("int"))


def acwr_zone(c) -> Column:
    """PRJ13: NULL-safe zone of the acute:chronic ratio."""
    x = col(c)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x < 0.8, "undertrained").when(x <= 1.3, "sweet_spot")
            .when(x <= 1.5, "caution").otherwise("danger"))


def clamp(c, lo: float, hi: float) -> Column:
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))


def readiness_score(hrv_z="hrv_z", sleep_3d="sleep_hours_3d", soreness_3d="soreness_3d",
                    fatigue_3d="fatigue_3d", legacy: bool = True) -> Column:
    """PRJ14: 0..100 heuristic.

    ``legacy=True`` keeps the engine-parity form in which ``greatest`` skips
    NULL, so a missing z-score clamps to -3; ``legacy=False`` fills 0 first.
    """
    z = F.coalesce(clamp(hrv_z, -3.0, 3.0), F.lit(0.0)) if legacy else clamp(F.coalesce(col(hrv_z), F.lit(0.0)), -3.0, 3.0)
    raw = (F.lit(60.0) + F.lit(10.0) * z
           + F.lit(6.0) * (F.coalesce(col(sleep_3d), F.lit(7.5)) - F.lit(7.5))
           - F.lit(2.5) * (F.coalesce(col(soreness_3d), F.lit(3.0)) - F.lit(3.0))
           - F.lit(2.0) * (F.coalesce(col(fatigue_3d), F.lit(3.0)) - F.lit(3.0)))
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw))


def risk_band(p) -> Column:
    """PRJ16: first cut the probability reaches, from the highest."""
    x = col(p)
    expr = None
    for cut, name in RISK_BANDS:
        expr = F.when(x >= cut, name) if expr is None else expr.when(x >= cut, name)
    return expr.otherwise("Low")


def add_split(day, train_end: str, val_end: str) -> Column:
    """PRJ17: train <= train_end < val <= val_end < test."""
    d = col(day)
    return (F.when(d <= F.to_date(F.lit(train_end)), "train")
            .when(d <= F.to_date(F.lit(val_end)), "val").otherwise("test"))


def one_hot(c, categories: Sequence[str], prefix: str) -> list[Column]:
    """PRJ19: fixed category list; unknown or NULL -> all zeros."""
    return [F.coalesce((col(c) == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{prefix}{str(v).replace(' ', '_')}")
            for v in categories]


def flags_text(rules: Sequence[tuple[Column, str]], sep: str = ", ") -> Column:
    """PRJ15: labels of the rules that hold; NULL and false rules vanish."""
    return F.concat_ws(sep, *[F.when(cond, F.lit(label)) for cond, label in rules])


def age_years(birth, day) -> Column:
    """DRV5."""
    return F.datediff(col(day), col(birth)) / F.lit(365.25)


def days_since(last, day) -> Column:
    """DRV6: NULL when there was no earlier event."""
    return F.datediff(col(day), col(last)).cast("long")


# --------------------------------------------------------------------------- date dimension
def day_of_week_sunday0(day) -> Column:
    return (F.dayofweek(col(day)) - 1).cast("long")


def season_phase(day) -> Column:
    m, d = F.month(col(day)), F.dayofmonth(col(day))
    return (F.when((m == 6) | ((m == 7) & (d <= 5)), "off-season")
            .when((m == 7) | ((m == 8) & (d <= 9)), "pre-season").otherwise("in-season"))


def season_label(day) -> Column:
    """Season starting in July, e.g. 2025/26."""
    y = F.year(col(day))
    start = F.when(F.month(col(day)) >= 7, y).otherwise(y - 1)
    return F.concat(start.cast("string"), F.lit("/"), F.right((start + 1).cast("string"), F.lit(2)))


# --------------------------------------------------------------------------- gap rules
def shortfall(current, target, tmin, tmax, direction) -> Column:
    """GAP3: never negative, in the direction that helps. NULL target -> 0 (engine parity)."""
    cur, tgt = col(current), col(target)
    d = col(direction)
    return (F.when(d == "higher_better", F.greatest(tgt - cur, F.lit(0.0)))
            .when(d == "lower_better", F.greatest(cur - tgt, F.lit(0.0)))
            .when(d == "band", F.greatest(cur - col(tmax), col(tmin) - cur, F.lit(0.0))))


def needed_direction(current, tmin, tmax, direction) -> Column:
    """GAP4."""
    cur, d = col(current), col(direction)
    band = (F.when(cur > col(tmax), "decrease").when(cur < col(tmin), "increase").otherwise("maintain"))
    return (F.when(d == "higher_better", "increase").when(d == "lower_better", "decrease")
            .when(d == "band", band))


def gap_status(short, direction, tmin, current) -> Column:
    """GAP5."""
    return (F.when(col(short) == 0, "on_target")
            .when((col(direction) == "higher_better") & col(tmin).isNotNull() & (col(current) < col(tmin)),
                  "below_minimum")
            .when(col(direction) == "band", "out_of_band").otherwise("below_target"))


def model_version(n_rows, iters, stamp: str) -> Column:
    """PRJ20: v<date>-<first 6 hex of md5(counts)>."""
    return F.concat(F.lit(f"v{stamp}-"), F.substring(F.md5(F.concat(col(n_rows).cast("string"),
                                                                   col(iters).cast("string"))), 1, 6))
