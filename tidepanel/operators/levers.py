"""Counterfactual levers (LEV1-6, SCR5, WIN25-26).

The reference loops over levers in Python and re-scores a pandas frame per
lever. Here it is one job: state rows x lever catalog (a bounded, ten-row
broadcast) -> per-row step -> edited feature columns -> both scorers before
and after -> one aggregate per (entity, lever). The edit is column
arithmetic: ``f' = f + w_f * step`` (add) or ``f * (1 + w_f * step)`` (scale)
with ``w_f = coalesce(shifts[f], 0)``, so untouched features pass unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.columns import ratio

STEP_TYPES = ("add", "scale")


def parse_shifts(catalog: DataFrame, spec: str = "feature_shifts") -> DataFrame:
    """LEV1: ``a:1.0|b:0.5`` -> one (lever_id, feature, weight) row per pair, trimmed."""
    m = F.transform_values(F.str_to_map(F.col(spec), F.lit(r"\|"), F.lit(":")), lambda k, v: v.cast("double"))
    return catalog.select("lever_id", F.explode(m).alias("feature", "weight")).select(
        "lever_id", F.trim("feature").alias("feature"), "weight")


def shift_map(spec: str = "feature_shifts") -> Column:
    """The packed shifts of the current row as map<feature, weight>."""
    raw = F.str_to_map(F.col(spec), F.lit(r"\|"), F.lit(":"))
    return F.map_from_entries(F.transform(F.map_entries(raw),
                                          lambda e: F.struct(F.trim(e["key"]).alias("k"),
                                                             e["value"].cast("double").alias("v"))))


def step_column(step_type: str = "step_type", size: str = "step_size", shortfall: str = "shortfall",
                direction: str = "needed_direction") -> Column:
    """LEV2: add -> sign(size) x min(|size|, shortfall); scale -> +-|size| by direction, 0 to maintain."""
    add = F.signum(F.col(size)) * F.least(F.abs(F.col(size)), F.coalesce(F.col(shortfall), F.lit(0.0)))
    dirn = F.when(F.col(direction) == "decrease", -1.0).when(F.col(direction) == "increase", 1.0).otherwise(0.0)
    scale = dirn * F.abs(F.col(size))
    step = (F.when(F.col(step_type) == "add", add).when(F.col(step_type) == "scale", scale)
            .otherwise(F.raise_error(F.concat(F.lit("unknown step_type "), F.col(step_type)))))
    return F.coalesce(step, F.lit(0.0))


def applied(features: Sequence[str], shifts: str = "__shifts", step: str = "__step",
            step_type: str = "step_type") -> dict[str, Column]:
    """LEV3 + LEV4: edited value of every feature, with dependent ratios recomputed."""
    out: dict[str, Column] = {}
    for f in features:
        w = F.coalesce(F.element_at(F.col(shifts), F.lit(f)), F.lit(0.0))
        x = F.col(f)
        out[f] = (F.when(F.col(step_type) == "add", x + w * F.col(step))
                  .when(F.col(step_type) == "scale", x * (1.0 + w * F.col(step)))
                  .otherwise(F.raise_error(F.concat(F.lit("unknown step_type "), F.col(step_type)))))
    if "acute_load_7d" in out:
        moves_acute = F.element_at(F.col(shifts), F.lit("acute_load_7d")).isNotNull()
        acute1 = out["acute_load_7d"]
        if "acwr" in features:
            out["acwr"] = F.when(moves_acute, ratio(acute1, "chronic_load_28d")).otherwise(F.col("acwr"))
        if "load_strain_7d" in features:
            out["load_strain_7d"] = F.when(
                moves_acute, F.col("load_strain_7d") * ratio(acute1, "acute_load_7d")).otherwise(F.col("load_strain_7d"))
    return out


def last_state_rows(df: DataFrame, as_of, n: int, max_age_days: int, entity: str = "entity_id",
                    day: str = "date_day") -> DataFrame:
    """WIN25: the last ``n`` rows per entity no older than ``max_age_days`` before ``as_of``.

    The date filter comes first, so the window sees at most max_age+1 rows per entity.
    """
    d = df.where((F.col(day) <= F.lit(as_of)) & (F.col(day) >= F.date_sub(F.lit(as_of), max_age_days)))
    w = Window.partitionBy(entity).orderBy(F.col(day).desc())
    return d.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def lever_effects(state: DataFrame, gaps: DataFrame, catalog: DataFrame, features: Sequence[str],
                  scorers: Mapping[str, Callable[[Mapping[str, Column] | None], Column]],
                  entity: str = "entity_id") -> DataFrame:
    """LEV5: mean effect per (entity, lever) of moving one lever by the capped step."""
    g = gaps.select(entity, "metric", "current_value", "target_value", "shortfall", "needed_direction")
    cat = F.broadcast(catalog.select("lever_id", "metric", "step_size", "step_type", "catalog_order",
                                     shift_map().alias("__shifts")))
    frame = (state.crossJoin(cat).join(g, [entity, "metric"], "left")
             .withColumn("__step", step_column()))
    after = applied(features)
    before_scores = {k: fn(None).alias(f"__{k}0") for k, fn in scorers.items()}
    after_scores = {k: fn(after).alias(f"__{k}1") for k, fn in scorers.items()}
    scored = frame.select(entity, "lever_id", "catalog_order", "current_value", "target_value", "__step",
                          *before_scores.values(), *after_scores.values())
    aggs = [F.avg("__step").alias("recommended_step"), F.count(F.lit(1)).alias("n_state_rows"),
            F.first("current_value").alias("current_value"), F.first("target_value").alias("target_value")]
    for k in scorers:
        aggs += [F.avg(f"__{k}0").alias(f"{k}_before"), F.avg(f"__{k}1").alias(f"{k}_after")]
    return (scored.groupBy(entity, "lever_id", "catalog_order").agg(*aggs)
            .where(F.abs("recommended_step") > 0))


def prioritise(effects: DataFrame, entity: str = "entity_id") -> DataFrame:
    """LEV6: 0.5 x gain / max gain + 0.5 x risk drop / max drop (positive parts), rank per entity."""
    e = effects.withColumn("expected_rating_gain", F.col("rating_after") - F.col("rating_before")) \
        .withColumn("expected_risk_reduction_pp", (F.col("risk_before") - F.col("risk_after")) * 100.0) \
        .withColumn("expected_relative_risk_reduction",
                    (F.col("risk_before") - F.col("risk_after")) / F.greatest(F.col("risk_before"), F.lit(1e-6)))
    mx = e.agg(F.greatest(F.max(F.greatest("expected_rating_gain", F.lit(0.0))), F.lit(1e-9)).alias("__gmax"),
               F.greatest(F.max(F.greatest("expected_risk_reduction_pp", F.lit(0.0))), F.lit(1e-9)).alias("__rmax"))
    s = e.crossJoin(F.broadcast(mx)).withColumn(
        "priority_score",
        0.5 * F.greatest("expected_rating_gain", F.lit(0.0)) / F.col("__gmax")
        + 0.5 * F.greatest("expected_risk_reduction_pp", F.lit(0.0)) / F.col("__rmax"))
    w = Window.partitionBy(entity).orderBy(F.col("priority_score").desc(), F.col("catalog_order"))
    return s.withColumn("priority_rank", F.row_number().over(w).cast("long")).drop("__gmax", "__rmax")


def paired_effects(frame: DataFrame, fill: Mapping[str, float | None], features: Sequence[str], inputs: Sequence[str],
                   scorers: Mapping[str, Callable[[Mapping[str, Column] | None], Column]],
                   keys: Sequence[str] = ("entity_id", "lever_id")) -> DataFrame:
    """SCR5: mean change of each score over the rows of a lever frame, missing inputs filled alike before and after.

    ``frame`` holds the features, their edits as ``<feature>_after`` and the step; ``fill`` the values that stand in for missing inputs (None: left to
    the scorer). An input that no lever moves is the same on both sides. Levers without a step are left out.
    """
    def side(after: bool) -> dict[str, Column]:
        value = lambda c: F.col(f"{c}_after") if after and c in features else F.col(c)
        return {c: F.coalesce(value(c).cast("double"), F.lit(fill[c])) if fill.get(c) is not None else value(c) for c in inputs}

    changes = [(fn(side(True)) - fn(side(False))).alias(f"__{k}") for k, fn in scorers.items()]
    return (frame.select(*keys, "step", *changes).groupBy(*keys)
            .agg(F.avg("step").alias("mean_step"), F.count(F.lit(1)).alias("n_rows"), *[F.avg(f"__{k}").alias(f"{k}_change") for k in scorers])
            .where(F.abs("mean_step") > 0))
