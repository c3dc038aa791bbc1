"""Group benchmarks, current state and gap-to-target (GAP1-6, AGG5-9, FLT4, PRJ15).

Wide -> long uses ``unpivot`` (one scan, an ``Expand``) instead of a UNION ALL
per metric; all metrics then share one aggregation keyed by (group, metric).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import columns as C
from tidepanel.operators.ranking import percent_rank_exact, percentile_cont


def to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str], metric: str = "metric",
            value: str = "value") -> DataFrame:
    """SET1: wide -> long, values cast to double so every metric shares a type."""
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(ids), list(metrics), metric, value)


def elite_rows(df: DataFrame, group: str, score: str, p: float = 0.75) -> DataFrame:
    """AGG7: rows whose score reaches their group's own p-th percentile."""
    cut = percentile_cont(df, [group], score, [p], names=["__cut"])
    return df.join(cut, group, "inner").where(F.col(score) >= F.col("__cut")).drop("__cut")


def benchmarks(matches: DataFrame, group: str, score: str, metrics: Sequence[str]) -> DataFrame:
    """GAP1: per (group, metric) elite median / p25 / p75, whole-group median, elite count."""
    elite = elite_rows(matches, group, score)
    elite_long = to_long(elite, [group], metrics)
    keys = [group, "metric"]
    # Elite and whole-group rows share one exact ranking pass, told apart by a population tag.
    both = (elite_long.withColumn("__pop", F.lit("elite"))
            .unionByName(to_long(matches, [group], metrics).withColumn("__pop", F.lit("all"))))
    q = percentile_cont(both, [*keys, "__pop"], "value", [0.5, 0.25, 0.75], ["p50", "p25", "p75"])
    wide = q.groupBy(*keys).agg(
        F.max(F.when(F.col("__pop") == "elite", F.col("p50"))).alias("elite_median"),
        F.max(F.when(F.col("__pop") == "elite", F.col("p25"))).alias("elite_p25"),
        F.max(F.when(F.col("__pop") == "elite", F.col("p75"))).alias("elite_p75"),
        F.max(F.when(F.col("__pop") == "all", F.col("p50"))).alias("position_median"))
    n = elite_long.groupBy(*keys).agg(F.count("value").alias("n_elite_matches"))
    return (n.join(wide, keys, "left")
            .select(*keys, "elite_median", "elite_p25", "elite_p75", "position_median", "n_elite_matches"))


def threshold_row(targets: DataFrame, picks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """AGG5: rule rows -> one wide row via conditional max, (output, metric, column)."""
    return targets.agg(*[F.max(F.when(F.col("metric") == m, F.col(c))).alias(o) for o, m, c in picks])


def latest(df: DataFrame, day: str, known=None) -> DataFrame:
    """FLT4: rows at the global latest day (scalar subquery, no window), or at that day where the caller knows it."""
    if known is not None:
        return df.where(F.col(day) == F.lit(known))
    last = df.agg(F.max(day).alias("__last"))
    return df.join(F.broadcast(last), F.col(day) == F.col("__last"), "inner").drop("__last")


def risk_flag_rules(th_prefix: str = "") -> list:
    a = F.col("acwr")
    t = lambda n: F.col(th_prefix + n)
    return [
        (a > 1.5, "ACWR spike (>1.5)"),
        ((a > t("acwr_max")) & (a <= 1.5), "ACWR elevated"),
        (a < t("acwr_min"), "Undertrained (ACWR low)"),
        (F.col("sleep_hours_7d") < t("sleep_min"), "Sleep debt"),
        (F.col("protein_gpkg_7d") < t("protein_min"), "Low protein"),
        (F.col("carbs_gpkg_7d") < t("carbs_min"), "Low carbohydrate"),
        (F.col("hydration_l_7d") < t("hydration_min"), "Low hydration"),
        (F.col("hrv_z") < -1.0, "HRV suppressed"),
        (F.col("nordic_n") < t("nordic_min"), "Weak hamstrings"),
        (F.col("days_since_return").between(1, 14), "Recently returned from injury"),
    ]


THRESHOLD_PICKS = [("sleep_min", "sleep_hours_7d", "target_min"), ("protein_min", "protein_gpkg_7d", "target_min"),
                   ("carbs_min", "carbs_gpkg_7d", "target_min"), ("hydration_min", "hydration_l_7d", "target_min"),
                   ("acwr_max", "acwr", "target_max"), ("acwr_min", "acwr", "target_min"),
                   ("nordic_min", "nordic_n", "target_min")]

STATE_COLS = ["is_unavailable", "readiness_score", "acwr", "acwr_zone", "acute_load_7d", "chronic_load_28d",
              "sleep_hours_7d", "protein_gpkg_7d", "carbs_gpkg_7d", "hydration_l_7d", "hrv_z", "cmj_cm",
              "sprint_30m_s", "yoyo_ir1_m", "squat_1rm_rel", "nordic_n", "prior_injuries", "days_since_return",
              "rating_avg_5m"]


def current_state(fact: DataFrame, targets: DataFrame, entity: str = "entity_id", day: str = "date_day", last=None) -> DataFrame:
    """GAP6: latest row per entity with rule flags (JN7: one-row thresholds, broadcast)."""
    th = F.broadcast(threshold_row(targets, THRESHOLD_PICKS))
    f = latest(fact, day, last).crossJoin(th)
    return f.select(entity, "team_id", "position_group", "position_code", F.col(day).alias("as_of_date"),
                    *STATE_COLS, C.flags_text(risk_flag_rules()).alias("risk_flags"))


GAP_METRICS = ["sleep_hours_7d", "protein_gpkg_7d", "carbs_gpkg_7d", "hydration_l_7d", "acwr", "cmj_cm",
               "sprint_30m_s", "yoyo_ir1_m", "squat_1rm_rel", "nordic_n"]
BENCH_METRICS = ["sleep_hours_7d", "protein_gpkg_7d", "carbs_gpkg_7d", "hydration_l_7d", "acwr", "chronic_load_28d",
                 "cmj_cm", "sprint_30m_s", "yoyo_ir1_m", "squat_1rm_rel", "nordic_n"]


def gap_long(state: DataFrame, entity: str = "entity_id") -> DataFrame:
    return to_long(state, [entity, "team_id", "position_group", "as_of_date"], GAP_METRICS, "metric", "current_value")


def gap_scored(state: DataFrame, targets: DataFrame, bench: DataFrame, entity: str = "entity_id") -> DataFrame:
    """GAP2-4 + WIN22: target resolution, shortfall, direction, percentile in group."""
    long = gap_long(state, entity)
    b = bench.select("position_group", "metric", "elite_median", "position_median")
    j = (long.join(F.broadcast(targets), "metric", "inner").join(b, ["position_group", "metric"], "left")
         .select(*long.columns, "direction", "target_min", "target_max", "unit",
                 F.coalesce("target_optimal", "elite_median").alias("target_value"),
                 F.when(F.col("target_optimal").isNotNull(), "evidence").otherwise("position_benchmark")
                 .alias("target_source"), "position_median")
         .where(F.col("current_value").isNotNull()))
    scored = j.select("*", C.shortfall("current_value", "target_value", "target_min", "target_max", "direction")
                      .alias("shortfall"),
                      C.needed_direction("current_value", "target_min", "target_max", "direction")
                      .alias("needed_direction"))
    return percent_rank_exact(scored, ["position_group", "metric"], "current_value", "raw_pct_rank")


def gap_status(scored: DataFrame, entity: str = "entity_id") -> DataFrame:
    """GAP5: status, relative shortfall and the direction-aware percentile."""
    return scored.select(
        entity, "team_id", "position_group", "as_of_date", "metric", "unit", "direction", "current_value",
        "target_value", "target_source", "target_min", "target_max", "position_median", "shortfall",
        "needed_direction", C.ratio("shortfall", F.abs("target_value")).alias("shortfall_pct"),
        C.gap_status("shortfall", "direction", "target_min", "current_value").alias("status"),
        F.when(F.col("direction") == "lower_better", 1 - F.col("raw_pct_rank")).otherwise(F.col("raw_pct_rank"))
        .alias("percentile_in_position"))
