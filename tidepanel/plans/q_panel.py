"""Registered queries: staging, panel, rolling features, facts (2.1-2.5, 2.14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.functions import frames as W
from tidepanel.operators.panel import DayRows, join_days
from tidepanel.plans.catalog import register
from tidepanel.plans.oracle import FEATURE_CTES, FEEDS, with_ctes
from tidepanel.plans.pipeline import pipeline_for

E, D = "entity_id", "date_day"


def pp(spark, sf_dir):
    return pipeline_for(spark, sf_dir)


# ----------------------------------------------------------------------------- staging
@register("calendar_series", with_ctes(FEEDS, "SELECT date_day FROM calendar"))
def calendar_series(spark, sf_dir):
    return pp(spark, sf_dir).calendar_df()


@register("dedupe_latest", with_ctes(FEEDS, """
SELECT l_orderkey, l_linenumber, entity_id, session_date, l_partkey, l_extendedprice FROM dedup_sessions"""),
          doubles=["l_extendedprice"])
def dedupe_latest_q(spark, sf_dir):
    from tidepanel.operators.dedupe import dedupe_latest

    raw = pp(spark, sf_dir).feeds.sessions()
    return dedupe_latest(raw, ["l_orderkey", "l_linenumber"], ["loaded_at", "l_partkey", E, "l_extendedprice"],
                         columns=[E, "session_date", "l_partkey", "l_extendedprice"])


_SESS = ["duration_min", "rpe", "srpe_load", "total_distance_m", "hsr_distance_m", "sprint_count", "max_speed_kmh"]


@register("unit_normalise_guard", with_ctes(FEEDS, "SELECT * FROM stg_sessions"), doubles=_SESS)
def unit_normalise_guard(spark, sf_dir):
    return pp(spark, sf_dir).stg_sessions


@register("severity_interval", with_ctes(FEEDS, "SELECT * FROM stg_injuries"))
def severity_interval(spark, sf_dir):
    return pp(spark, sf_dir).stg_injuries


_DAILY = ["daily_load", "daily_minutes", "match_minutes", "total_distance_m", "hsr_distance_m", "sprint_count",
          "max_speed_kmh", "exposure_h"]


@register("daily_rollup", with_ctes(FEEDS, "SELECT * FROM daily_load"), doubles=_DAILY)
def daily_rollup(spark, sf_dir):
    return pp(spark, sf_dir).daily_load


@register("dense_spine", with_ctes(FEEDS, "SELECT entity_id, date_day, CAST(day_index AS BIGINT) AS day_index FROM spine"))
def dense_spine_q(spark, sf_dir):
    return pp(spark, sf_dir).spine.select(E, D, "day_index")


@register("interval_days", with_ctes(FEEDS, "SELECT * FROM unavailable"))
def interval_days_q(spark, sf_dir):
    p = pp(spark, sf_dir)
    return p.unavailable.join(p.spine.select(E, D), [E, D], "left_semi")


_BASE_D = ["height_cm", "weight_kg", "daily_load", "daily_minutes", "match_minutes", "hsr_distance_m",
           "sprint_count", "max_speed_kmh", "total_distance_m", "sleep_hours", "sleep_efficiency_pct",
           "hrv_rmssd_ms", "resting_hr_bpm", "soreness", "fatigue", "stress", "mood", "protein_gpkg", "carbs_gpkg",
           "kcal_per_kg", "hydration_l", "cmj_cm", "sprint_30m_s", "squat_1rm_rel", "nordic_n", "body_fat_pct",
           "form_incl"]
_BASE_COLS = ("entity_id, date_day, CAST(day_index AS BIGINT) AS day_index, team_id, position_code, position_group, "
              "birth_date, height_cm, weight_kg, daily_load, daily_minutes, sessions, match_minutes, gym_sessions, "
              "rehab_sessions, hsr_distance_m, sprint_count, max_speed_kmh, total_distance_m, sleep_hours, "
              "sleep_efficiency_pct, hrv_rmssd_ms, resting_hr_bpm, soreness, fatigue, stress, mood, protein_gpkg, "
              "carbs_gpkg, kcal_per_kg, hydration_l, cmj_cm, sprint_30m_s, yoyo_ir1_m, squat_1rm_rel, nordic_n, "
              "body_fat_pct, injury_onset, is_unavailable, is_match_day, matches_next_7d, form_incl")


@register("entity_day_base", with_ctes(FEEDS, f"SELECT {_BASE_COLS} FROM base"), doubles=_BASE_D)
def entity_day_base(spark, sf_dir):
    b = pp(spark, sf_dir).base
    return b.select(*[c.strip().split(" AS ")[-1] for c in _BASE_COLS.split(",")])


_LOAD = ["acute_load_7d", "chronic_load_28d", "acwr", "load_monotony_7d", "load_strain_7d", "hsr_distance_7d",
         "sprint_count_7d", "max_speed_28d", "match_minutes_28d"]
_LOAD_ALL = _LOAD + ["sessions_7d", "gym_sessions_28d"]


def _fact_cols(cols):
    return lambda spark, sf_dir: pp(spark, sf_dir).fact_of(cols)


def _fact_sql(cols):
    return with_ctes(FEATURE_CTES, f"SELECT entity_id, date_day, {', '.join(cols)} FROM fact")


register("rolling_load", _fact_sql(_LOAD_ALL), doubles=_LOAD)(_fact_cols(_LOAD_ALL))

_RECOVERY = ["sleep_hours_3d", "sleep_hours_7d", "sleep_hours_28d", "sleep_variability_7d", "sleep_efficiency_7d",
             "hrv_z", "rhr_z", "soreness_3d", "fatigue_3d", "stress_7d", "mood_7d", "wellness_log_rate_7d",
             "protein_gpkg_7d", "carbs_gpkg_3d", "carbs_gpkg_7d", "kcal_per_kg_7d", "hydration_l_3d",
             "hydration_l_7d", "nutrition_log_rate_7d"]
register("rolling_recovery", _fact_sql(_RECOVERY), doubles=_RECOVERY)(_fact_cols(_RECOVERY))

_CARRY_D = ["cmj_cm", "sprint_30m_s", "squat_1rm_rel", "nordic_n", "body_fat_pct", "rating_avg_5m"]
_CARRY = _CARRY_D + ["yoyo_ir1_m"]
register("carry_forward", _fact_sql(_CARRY), doubles=_CARRY_D)(_fact_cols(_CARRY))

_SINCE = ["days_since_test", "days_since_last_injury", "days_since_return", "prior_injuries", "age_years"]
register("days_since", _fact_sql(_SINCE), doubles=["age_years"])(_fact_cols(_SINCE))
register("forward_label", _fact_sql(["injury_onset", "injury_next_7d"]))(_fact_cols(["injury_onset", "injury_next_7d"]))
register("label_complete", _fact_sql(["day_index", "has_full_history", "label_is_complete"]))(
    _fact_cols(["day_index", "has_full_history", "label_is_complete"]))
register("readiness_score", _fact_sql(["readiness_score", "acwr_zone"]), doubles=["readiness_score"])(
    _fact_cols(["readiness_score", "acwr_zone"]))


@register("event_form5", with_ctes(FEEDS, "SELECT * FROM match_form"),
          doubles=["performance_rating", "form_rating_5m"])
def event_form5(spark, sf_dir):
    return pp(spark, sf_dir).match_form


_TEST_D = ["cmj_cm", "sprint_30m_s", "squat_1rm_rel", "nordic_n", "body_fat_pct", "cmj_change", "sprint_change",
           "squat_change", "nordic_change"]


@register("lag_change", with_ctes(FEEDS, """
SELECT t.test_id, t.entity_id, d.team_id, d.position_group, t.date_day, t.cmj_cm, t.sprint_30m_s, t.yoyo_ir1_m,
       t.squat_1rm_rel, t.nordic_n, t.body_fat_pct,
       t.cmj_cm - lag(t.cmj_cm) OVER w AS cmj_change,
       t.sprint_30m_s - lag(t.sprint_30m_s) OVER w AS sprint_change,
       t.yoyo_ir1_m - lag(t.yoyo_ir1_m) OVER w AS yoyo_change,
       t.squat_1rm_rel - lag(t.squat_1rm_rel) OVER w AS squat_change,
       t.nordic_n - lag(t.nordic_n) OVER w AS nordic_change
FROM stg_tests t JOIN dim_entity d USING (entity_id)
WINDOW w AS (PARTITION BY t.entity_id ORDER BY t.date_day)"""), doubles=_TEST_D)
def lag_change(spark, sf_dir):
    return pp(spark, sf_dir).fact_tests()


def _lag_sum(col, k):
    w = W.ordered(E, D)
    return sum((F.coalesce(F.lag(col, i).over(w), F.lit(0.0)) for i in range(1, k + 1)), F.lit(0.0))


def acwr_recompute(p):
    """WIN21: ratio re-derived from explicit lags (independent of frame code) over the panel's days."""
    return _lagged(p.panel).where(F.col("day_index") > 28).select(E, D, _acwr_check())


def _acwr_check():
    return F.try_divide(F.col("sum7") / 7.0, F.when(F.col("sum28") != 0, F.col("sum28") / 28.0)).alias("acwr_check")


def _lagged(panel):
    return panel.withColumns({"sum7": _lag_sum("daily_load", 7), "sum28": _lag_sum("daily_load", 28)})


def acwr_both(p):
    """The days of ``acwr_recompute`` joined to the panel's own ratio: the lags ride along through its rolling features."""
    both = p.features(["day_index", "sum7", "sum28", "acwr"], panel=_lagged(p.panel))
    return join_days(both, [_acwr_check()], [(DayRows(F.lit(True), {"acwr": F.col("acwr")}), "inner")], where=F.col("day_index") > 28, unique=p.one_row_days)


def _lag_sql(k):
    return " + ".join(f"coalesce(lag(daily_load, {i}) OVER (PARTITION BY entity_id ORDER BY date_day), 0)"
                      for i in range(1, k + 1))


RECOMPUTE_CTE = f""",
lagged AS (
  SELECT entity_id, date_day, day_index, {_lag_sql(7)} AS sum7, {_lag_sql(28)} AS sum28 FROM base
),
recomputed AS (
  SELECT entity_id, date_day, (sum7 / 7.0) / nullif(sum28 / 28.0, 0) AS acwr_check FROM lagged WHERE day_index > 28
)"""


@register("multilag_recompute", with_ctes(FEEDS + RECOMPUTE_CTE, "SELECT entity_id, date_day, acwr_check FROM recomputed"),
          doubles=["acwr_check"])
def multilag_recompute(spark, sf_dir):
    return acwr_recompute(pp(spark, sf_dir))


@register("team_schedule", with_ctes(FEEDS, "SELECT * FROM team_schedule"))
def team_schedule(spark, sf_dir):
    return pp(spark, sf_dir).team_schedule


@register("dim_entity", with_ctes(FEEDS, "SELECT * FROM dim_entity"),
          doubles=["age_years_at_as_of", "height_cm", "weight_kg", "bmi"])
def dim_entity(spark, sf_dir):
    return pp(spark, sf_dir).dim_entity


@register("dim_date", with_ctes(FEEDS, """
SELECT date_day, CAST(extract(year FROM date_day) AS BIGINT) AS year, CAST(extract(month FROM date_day) AS BIGINT) AS month,
       CAST(dayofweek(date_day) AS BIGINT) AS day_of_week,
       CASE WHEN extract(month FROM date_day) = 6 OR (extract(month FROM date_day) = 7 AND extract(day FROM date_day) <= 5)
            THEN 'off-season'
            WHEN extract(month FROM date_day) = 7 OR (extract(month FROM date_day) = 8 AND extract(day FROM date_day) <= 9)
            THEN 'pre-season' ELSE 'in-season' END AS season_phase,
       CASE WHEN extract(month FROM date_day) >= 7
            THEN CAST(extract(year FROM date_day) AS VARCHAR) || '/' || right(CAST(extract(year FROM date_day) + 1 AS VARCHAR), 2)
            ELSE CAST(extract(year FROM date_day) - 1 AS VARCHAR) || '/' || right(CAST(extract(year FROM date_day) AS VARCHAR), 2)
       END AS season
FROM calendar"""))
def dim_date(spark, sf_dir):
    return pp(spark, sf_dir).dim_date()


FACT_NON_DOUBLE = {"entity_id", "date_day", "day_index", "team_id", "position_code", "position_group", "sessions",
                   "is_match_day", "matches_next_7d", "is_unavailable", "injury_onset", "sessions_7d",
                   "gym_sessions_28d", "yoyo_ir1_m", "days_since_test", "prior_injuries", "days_since_last_injury",
                   "days_since_return", "has_full_history", "label_is_complete", "injury_next_7d", "acwr_zone"}


def _fact_doubles(spark_cols):
    return [c for c in spark_cols if c not in FACT_NON_DOUBLE]


FACT_COLUMNS = [
    "entity_id", "date_day", "day_index", "team_id", "position_code", "position_group", "height_cm", "weight_kg",
    "age_years", "daily_load", "daily_minutes", "sessions", "match_minutes", "hrv_rmssd_ms", "resting_hr_bpm",
    "sleep_hours", "soreness", "fatigue", "stress", "mood", "is_match_day", "matches_next_7d", "is_unavailable",
    "injury_onset", "acute_load_7d", "chronic_load_28d", "acwr", "load_monotony_7d", "load_strain_7d",
    "hsr_distance_7d", "sprint_count_7d", "max_speed_28d", "sessions_7d", "match_minutes_28d", "gym_sessions_28d",
    "sleep_hours_3d", "sleep_hours_7d", "sleep_hours_28d", "sleep_variability_7d", "sleep_efficiency_7d", "hrv_z",
    "rhr_z", "soreness_3d", "fatigue_3d", "stress_7d", "mood_7d", "wellness_log_rate_7d", "protein_gpkg_7d",
    "carbs_gpkg_3d", "carbs_gpkg_7d", "kcal_per_kg_7d", "hydration_l_3d", "hydration_l_7d", "nutrition_log_rate_7d",
    "cmj_cm", "sprint_30m_s", "yoyo_ir1_m", "squat_1rm_rel", "nordic_n", "body_fat_pct", "days_since_test",
    "prior_injuries", "days_since_last_injury", "days_since_return", "rating_avg_5m", "has_full_history",
    "label_is_complete", "injury_next_7d", "readiness_score", "acwr_zone"]

register("fct_entity_day", with_ctes(FEATURE_CTES, f"SELECT {', '.join(FACT_COLUMNS)} FROM fact"),
         doubles=_fact_doubles(FACT_COLUMNS))(lambda spark, sf_dir: pp(spark, sf_dir).fact.select(*FACT_COLUMNS))


@register("fct_events_state", with_ctes(FEATURE_CTES, """
SELECT i.injury_id, i.entity_id, d.team_id, d.position_group, i.injury_date, i.days_out, i.severity,
       f.acwr AS acwr_at_onset, f.acwr_zone AS acwr_zone_at_onset, f.sleep_hours_7d AS sleep_hours_7d_at_onset,
       f.protein_gpkg_7d AS protein_gpkg_7d_at_onset, f.nordic_n AS nordic_n_at_onset, f.hrv_z AS hrv_z_at_onset,
       f.prior_injuries AS prior_injuries_at_onset
FROM stg_injuries i JOIN dim_entity d USING (entity_id)
LEFT JOIN fact f ON f.entity_id = i.entity_id AND f.date_day = i.injury_date"""),
          doubles=["acwr_at_onset", "sleep_hours_7d_at_onset", "protein_gpkg_7d_at_onset", "nordic_n_at_onset",
                   "hrv_z_at_onset"])
def fct_events_state(spark, sf_dir):
    return pp(spark, sf_dir).fact_events()


@register("fct_matches", with_ctes(FEEDS, """
SELECT m.match_stat_id, m.fixture_id, m.entity_id, d.team_id, d.position_group, m.date_day, m.minutes_played,
       m.performance_rating, m.competition, m.opponent_strength
FROM stg_matches m JOIN dim_entity d USING (entity_id)"""), doubles=["performance_rating"])
def fct_matches(spark, sf_dir):
    return pp(spark, sf_dir).fact_matches()


def acwr_zone_counts_df(p):
    """Flagship: entities per team and ACWR zone, over every entity-day."""
    f = p.fact_of(["team_id", "acwr_zone", "acwr"])
    return (f.groupBy("team_id", "acwr_zone")
            .agg(F.count(F.lit(1)).alias("entity_days"), F.countDistinct(E).alias("entities"),
                 F.avg("acwr").alias("avg_acwr")))


@register("acwr_zone_counts", with_ctes(FEATURE_CTES, """
SELECT team_id, acwr_zone, count(*) AS entity_days, count(DISTINCT entity_id) AS entities, avg(acwr) AS avg_acwr
FROM fact GROUP BY 1, 2"""), doubles=["avg_acwr"])
def acwr_zone_counts(spark, sf_dir):
    return acwr_zone_counts_df(pp(spark, sf_dir))
