"""DuckDB statements that restate each registered query in plain SQL.

They are written in the reference's own relational style (left-join chains,
``QUALIFY row_number``, theta join for the spine, ``between`` interval join),
so the comparison checks our Spark rewrites (union-aggregate, explode,
struct-max dedupe) against the straightforward form.
"""

from __future__ import annotations

from tidepanel.plans.pipeline import FEATURES, ML_FEATURES, Params
from tidepanel.sources.rules import LEVERS, TARGETS

P = Params()

FEEDS = """
cal AS (
  SELECT min(CAST(l_shipdate AS DATE)) AS cal_start, max(CAST(l_shipdate AS DATE)) AS cal_end FROM lineitem
),
calendar AS (
  SELECT CAST(unnest(generate_series(cal_start, cal_end, INTERVAL 1 DAY)) AS DATE) AS date_day FROM cal
),
raw_sessions AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_suppkey AS entity_id,
         CAST(l_shipdate AS DATE) AS session_date, l_shipdate AS loaded_at,
         CASE WHEN l_returnflag = 'R' THEN 'Match' WHEN l_returnflag = 'A' THEN 'Gym'
              WHEN l_linestatus = 'F' THEN 'Training' ELSE 'Rehab' END AS session_type,
         l_quantity AS duration_min, round(l_discount * 100, 2) AS rpe,
         l_extendedprice / 10 AS total_distance_m, l_quantity * 100 AS hsr_distance_m,
         CAST(l_linenumber AS DOUBLE) AS sprint_count, l_extendedprice / 2000 AS max_speed_raw,
         CASE WHEN l_linestatus = 'F' THEN 'ms' ELSE 'kmh' END AS speed_unit
  FROM lineitem
),
dedup_sessions AS (
  SELECT * FROM raw_sessions
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY loaded_at DESC, l_partkey DESC, entity_id DESC, l_extendedprice DESC) = 1
),
norm_sessions AS (
  SELECT l_orderkey, l_linenumber, entity_id, session_date, lower(session_type) AS session_type,
         duration_min, rpe, total_distance_m, hsr_distance_m, sprint_count,
         CASE WHEN speed_unit = 'ms' THEN max_speed_raw * 3.6 ELSE max_speed_raw END AS max_speed_kmh_raw
  FROM dedup_sessions
  WHERE duration_min > 0 AND rpe BETWEEN 0 AND 10
),
stg_sessions AS (
  SELECT l_orderkey, l_linenumber, entity_id, session_date, session_type, duration_min, rpe,
         duration_min * rpe AS srpe_load, total_distance_m,
         CASE WHEN hsr_distance_m <= total_distance_m THEN hsr_distance_m END AS hsr_distance_m,
         sprint_count,
         CASE WHEN max_speed_kmh_raw <= 45 THEN max_speed_kmh_raw END AS max_speed_kmh,
         CAST(total_distance_m IS NOT NULL AS INTEGER) AS has_gps
  FROM norm_sessions
),
daily_load AS (
  SELECT entity_id, session_date AS date_day,
         sum(srpe_load) AS daily_load, sum(duration_min) AS daily_minutes, count(*) AS sessions,
         sum(CASE WHEN session_type = 'match' THEN duration_min ELSE 0.0 END) AS match_minutes,
         CAST(sum(CASE WHEN session_type = 'gym' THEN 1 ELSE 0 END) AS BIGINT) AS gym_sessions,
         CAST(sum(CASE WHEN session_type = 'rehab' THEN 1 ELSE 0 END) AS BIGINT) AS rehab_sessions,
         sum(total_distance_m) AS total_distance_m, sum(hsr_distance_m) AS hsr_distance_m,
         sum(sprint_count) AS sprint_count, max(max_speed_kmh) AS max_speed_kmh,
         sum(CASE session_type WHEN 'match' THEN 5.0 WHEN 'training' THEN 1.0 WHEN 'gym' THEN 0.4
                               WHEN 'recovery' THEN 0.2 WHEN 'individual' THEN 0.4 WHEN 'rehab' THEN 0.15
                               ELSE 0.0 END::DOUBLE * duration_min / 60.0) AS exposure_h
  FROM stg_sessions GROUP BY 1, 2
),
raw_daily AS (
  SELECT l_orderkey, l_linenumber, l_suppkey AS entity_id, CAST(l_shipdate AS DATE) AS date_day,
         l_quantity, l_discount, l_tax, l_extendedprice, l_returnflag, l_linestatus
  FROM lineitem
),
stg_wellness AS (
  SELECT entity_id, date_day,
         CASE WHEN l_discount * 1000 BETWEEN 5 AND 250 THEN l_discount * 1000 END AS hrv_rmssd_ms,
         CASE WHEN l_tax * 1000 BETWEEN 30 AND 100 THEN l_tax * 1000 END AS resting_hr_bpm,
         l_quantity / 5 AS soreness, CAST(l_linenumber * 1.25 AS DOUBLE) AS fatigue, l_tax * 100 AS stress,
         10.0 - l_discount * 50 AS mood
  FROM raw_daily WHERE l_returnflag = 'A'
  QUALIFY row_number() OVER (PARTITION BY entity_id, date_day ORDER BY l_orderkey DESC, l_linenumber DESC) = 1
),
stg_sleep AS (
  SELECT entity_id, date_day,
         CASE WHEN l_quantity / 4 BETWEEN 2 AND 14 THEN l_quantity / 4 END AS sleep_hours,
         100.0 - l_discount * 100 AS sleep_efficiency_pct
  FROM raw_daily WHERE l_returnflag = 'N' AND l_linestatus = 'O'
  QUALIFY row_number() OVER (PARTITION BY entity_id, date_day ORDER BY l_orderkey DESC, l_linenumber DESC) = 1
),
raw_entities AS (
  SELECT s_suppkey AS entity_id, s_nationkey AS team_id, n_name AS position,
         CAST('1960-01-01' AS DATE) + CAST(floor(s_acctbal) AS INTEGER) AS birth_date,
         CAST(170.0 AS DOUBLE) + s_nationkey AS height_cm,
         CAST(60.0 AS DOUBLE) + abs(s_acctbal) / 250.0 AS weight_kg,
         ' Left ' AS dominant_foot
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
nutrition_latest AS (
  SELECT entity_id, date_day, l_extendedprice / 10 AS kcal, l_quantity * 3 AS protein_g,
         l_quantity * 8 AS carbs_g, l_tax * 50 AS hydration_l
  FROM raw_daily WHERE l_returnflag = 'R'
  QUALIFY row_number() OVER (PARTITION BY entity_id, date_day ORDER BY l_orderkey DESC, l_linenumber DESC) = 1
),
stg_nutrition AS (
  SELECT n.entity_id, n.date_day, kcal, protein_g, carbs_g, hydration_l,
         protein_g / nullif(a.weight_kg, 0) AS protein_gpkg, carbs_g / nullif(a.weight_kg, 0) AS carbs_gpkg,
         kcal / nullif(a.weight_kg, 0) AS kcal_per_kg
  FROM nutrition_latest n JOIN raw_entities a USING (entity_id)
),
stg_tests AS (
  SELECT CAST(entity_id AS VARCHAR) || '-' || CAST(date_day AS VARCHAR) AS test_id, entity_id, date_day,
         30.0 + l_tax * 100 AS cmj_cm, 4.0 + l_discount AS sprint_30m_s,
         CAST(floor(l_extendedprice / 50) AS BIGINT) AS yoyo_ir1_m, 1.0 + l_discount * 10 AS squat_1rm_rel,
         250.0 + l_tax * 2000 AS nordic_n, CAST(8.0 AS DOUBLE) + l_linenumber AS body_fat_pct
  FROM raw_daily WHERE l_quantity >= 49
  QUALIFY row_number() OVER (PARTITION BY entity_id, date_day ORDER BY l_orderkey DESC, l_linenumber DESC) = 1
),
raw_injuries AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS injury_id,
         l_suppkey AS entity_id, CAST(l_shipdate AS DATE) AS injury_date, l_shipdate AS loaded_at,
         l_partkey, l_extendedprice, CAST(l_linenumber * 3 AS BIGINT) AS days_out
  FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.095
),
stg_injuries AS (
  SELECT injury_id, entity_id, injury_date, days_out,
         CASE WHEN days_out <= 3 THEN 'minimal' WHEN days_out <= 7 THEN 'mild'
              WHEN days_out <= 28 THEN 'moderate' ELSE 'severe' END AS severity,
         CAST(injury_date + 1 AS DATE) AS unavailable_from,
         CAST(injury_date + CAST(days_out AS INTEGER) AS DATE) AS unavailable_to
  FROM raw_injuries
  QUALIFY row_number() OVER (PARTITION BY injury_id
                             ORDER BY loaded_at DESC, l_partkey DESC, entity_id DESC, l_extendedprice DESC) = 1
),
fixtures AS (
  SELECT o_orderkey AS fixture_id, c_nationkey AS team_id, CAST(o_orderdate AS DATE) AS date_day,
         o_orderstatus AS competition, CAST(floor(o_totalprice / 100000) AS BIGINT) AS opponent_strength
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderpriority = '1-URGENT'
),
match_latest AS (
  SELECT entity_id, date_day, l_orderkey AS fixture_id, CAST(l_quantity * 2 AS BIGINT) AS minutes_played,
         l_extendedprice / l_quantity / 200 AS performance_rating
  FROM raw_daily WHERE l_returnflag = 'R'
  QUALIFY row_number() OVER (PARTITION BY entity_id, date_day ORDER BY l_orderkey DESC, l_linenumber DESC) = 1
),
stg_matches AS (
  SELECT CAST(m.entity_id AS VARCHAR) || '-' || CAST(m.date_day AS VARCHAR) AS match_stat_id,
         m.fixture_id, m.entity_id, m.date_day, m.minutes_played, m.performance_rating,
         f.competition, f.opponent_strength
  FROM match_latest m LEFT JOIN fixtures f USING (fixture_id)
),
signed AS (SELECT entity_id, min(date_day) AS signed_date FROM daily_load GROUP BY 1),
stg_entities AS (
  SELECT a.entity_id, team_id, upper(trim(position)) AS position_code, birth_date, height_cm, weight_kg,
         lower(dominant_foot) AS dominant_foot, s.signed_date
  FROM raw_entities a LEFT JOIN signed s USING (entity_id)
),
groups_ AS (
  SELECT upper(trim(n_name)) AS position_code, n_name AS position_name, r_name AS position_group
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
dim_entity AS (
  SELECT a.entity_id, a.team_id, a.position_code, g.position_name, g.position_group, a.birth_date,
         date_diff('day', a.birth_date, (SELECT cal_end FROM cal)) / CAST(365.25 AS DOUBLE) AS age_years_at_as_of,
         a.height_cm, a.weight_kg, round(a.weight_kg / power(a.height_cm / 100.0, 2), 1) AS bmi,
         a.dominant_foot, a.signed_date
  FROM stg_entities a LEFT JOIN groups_ g ON g.position_code = a.position_code
),
spine AS (
  SELECT a.entity_id, c.date_day,
         row_number() OVER (PARTITION BY a.entity_id ORDER BY c.date_day) AS day_index
  FROM dim_entity a JOIN calendar c ON c.date_day >= a.signed_date
),
unavailable AS (
  SELECT s.entity_id, s.date_day, CAST(1 AS BIGINT) AS is_unavailable
  FROM spine s JOIN stg_injuries i
    ON i.entity_id = s.entity_id AND s.date_day BETWEEN i.unavailable_from AND i.unavailable_to
  GROUP BY 1, 2
),
onsets AS (
  SELECT entity_id, injury_date AS date_day, CAST(1 AS BIGINT) AS injury_onset FROM stg_injuries GROUP BY 1, 2
),
teams AS (SELECT DISTINCT team_id FROM stg_entities),
team_schedule AS (
  SELECT g.team_id, g.date_day, CAST(CASE WHEN f.team_id IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS is_match_day,
         CAST(sum(CASE WHEN f.team_id IS NOT NULL THEN 1 ELSE 0 END) OVER (
              PARTITION BY g.team_id ORDER BY g.date_day ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS BIGINT)
           AS matches_next_7d
  FROM (SELECT t.team_id, c.date_day FROM teams t CROSS JOIN calendar c) g
  LEFT JOIN (SELECT DISTINCT team_id, date_day FROM fixtures) f
    ON f.team_id = g.team_id AND f.date_day = g.date_day
),
match_form AS (
  SELECT entity_id, date_day, performance_rating,
         avg(performance_rating) OVER (PARTITION BY entity_id ORDER BY date_day
                                       ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS form_rating_5m
  FROM stg_matches WHERE minutes_played >= 15
),
base AS MATERIALIZED (
  SELECT s.entity_id, s.date_day, s.day_index, a.team_id, a.position_code, a.position_group, a.birth_date,
         a.height_cm, a.weight_kg,
         coalesce(l.daily_load, 0) AS daily_load, coalesce(l.daily_minutes, 0) AS daily_minutes,
         coalesce(l.sessions, 0) AS sessions, coalesce(l.match_minutes, 0) AS match_minutes,
         coalesce(l.gym_sessions, 0) AS gym_sessions, coalesce(l.rehab_sessions, 0) AS rehab_sessions,
         coalesce(l.hsr_distance_m, 0) AS hsr_distance_m, coalesce(l.sprint_count, 0) AS sprint_count,
         l.max_speed_kmh, coalesce(l.total_distance_m, 0) AS total_distance_m,
         coalesce(l.exposure_h, 0) AS exposure_h,
         sl.sleep_hours, sl.sleep_efficiency_pct,
         w.hrv_rmssd_ms, w.resting_hr_bpm, w.soreness, w.fatigue, w.stress, w.mood,
         n.protein_gpkg, n.carbs_gpkg, n.kcal_per_kg, n.hydration_l,
         t.cmj_cm, t.sprint_30m_s, t.yoyo_ir1_m, t.squat_1rm_rel, t.nordic_n, t.body_fat_pct,
         coalesce(o.injury_onset, 0) AS injury_onset, coalesce(u.is_unavailable, 0) AS is_unavailable,
         sch.is_match_day, sch.matches_next_7d, mf.form_rating_5m AS form_incl
  FROM spine s
  JOIN dim_entity a ON a.entity_id = s.entity_id
  LEFT JOIN daily_load l ON l.entity_id = s.entity_id AND l.date_day = s.date_day
  LEFT JOIN stg_sleep sl ON sl.entity_id = s.entity_id AND sl.date_day = s.date_day
  LEFT JOIN stg_wellness w ON w.entity_id = s.entity_id AND w.date_day = s.date_day
  LEFT JOIN stg_nutrition n ON n.entity_id = s.entity_id AND n.date_day = s.date_day
  LEFT JOIN stg_tests t ON t.entity_id = s.entity_id AND t.date_day = s.date_day
  LEFT JOIN onsets o ON o.entity_id = s.entity_id AND o.date_day = s.date_day
  LEFT JOIN unavailable u ON u.entity_id = s.entity_id AND u.date_day = s.date_day
  LEFT JOIN team_schedule sch ON sch.team_id = a.team_id AND sch.date_day = s.date_day
  LEFT JOIN match_form mf ON mf.entity_id = s.entity_id AND mf.date_day = s.date_day
)"""


INT_SOURCES = {"sessions", "gym_sessions", "rehab_sessions"}


def _frame_sql(kind: str, n: int) -> str:
    spec = "PARTITION BY entity_id ORDER BY date_day ROWS BETWEEN "
    return spec + {
        "prior": f"{n} PRECEDING AND 1 PRECEDING",
        "incl": f"{n - 1} PRECEDING AND CURRENT ROW",
        "all_prior": "UNBOUNDED PRECEDING AND 1 PRECEDING",
        "all_incl": "UNBOUNDED PRECEDING AND CURRENT ROW",
    }[kind]


def _feature_sql(name: str, agg: str, src: str, kind: str, n: int) -> str:
    w = f"OVER ({_frame_sql(kind, n)})"
    return {
        "avg": f"avg({src}) {w}",
        "sum": (f"CAST(sum({src}) {w} AS BIGINT)" if src in INT_SOURCES else f"sum({src}) {w}"),
        "max": f"max({src}) {w}",
        "stddev": f"stddev_samp({src}) {w}",
        "rate": f"count({src}) {w} / CAST({float(n)} AS DOUBLE)",
        "last": f"last_value({src} IGNORE NULLS) {w}",
        "last_day": f"max(CASE WHEN {src} IS NOT NULL THEN date_day END) {w}",
        "last_day_flag": f"max(CASE WHEN {src} = 1 THEN date_day END) {w}",
        "count_flag": f"CAST(coalesce(sum({src}) {w}, 0) AS BIGINT)",
    }[agg] + f" AS {name}"


_WINDOWS = ",\n    ".join(_feature_sql(*f) for f in FEATURES)
_H = P.label_horizon_days

FEATURE_CTES = FEEDS + f""",
windows AS (
  SELECT *,
    {_WINDOWS},
    max(injury_onset) OVER (PARTITION BY entity_id ORDER BY date_day
                            ROWS BETWEEN CURRENT ROW AND {_H - 1} FOLLOWING) AS injury_next_7d_raw,
    count(*) OVER (PARTITION BY entity_id ORDER BY date_day
                   ROWS BETWEEN CURRENT ROW AND {_H - 1} FOLLOWING) AS future_days_available
  FROM base
),
features AS (
  SELECT entity_id, date_day, day_index, team_id, position_code, position_group, height_cm, weight_kg,
    date_diff('day', birth_date, date_day) / CAST(365.25 AS DOUBLE) AS age_years,
    daily_load, daily_minutes, sessions, match_minutes, hrv_rmssd_ms, resting_hr_bpm,
    sleep_hours, soreness, fatigue, stress, mood, is_match_day, matches_next_7d, is_unavailable, injury_onset,
    acute_load_7d, chronic_load_28d,
    acute_load_7d / nullif(chronic_load_28d, 0) AS acwr,
    acute_load_7d / nullif(load_sd_7d, 0) AS load_monotony_7d,
    weekly_load_7d * (acute_load_7d / nullif(load_sd_7d, 0)) AS load_strain_7d,
    hsr_distance_7d, sprint_count_7d, max_speed_28d, sessions_7d, match_minutes_28d, gym_sessions_28d,
    exposure_7d,
    sleep_hours_3d, sleep_hours_7d, sleep_hours_28d, sleep_variability_7d, sleep_efficiency_7d,
    (hrv_rmssd_ms - hrv_baseline_28d) / nullif(hrv_sd_28d, 0) AS hrv_z,
    (resting_hr_bpm - rhr_baseline_28d) / nullif(rhr_sd_28d, 0) AS rhr_z,
    soreness_3d, fatigue_3d, stress_7d, mood_7d, wellness_log_rate_7d,
    protein_gpkg_7d, carbs_gpkg_3d, carbs_gpkg_7d, kcal_per_kg_7d, hydration_l_3d, hydration_l_7d,
    nutrition_log_rate_7d,
    cmj_latest AS cmj_cm, sprint_30m_latest AS sprint_30m_s, yoyo_latest AS yoyo_ir1_m,
    squat_latest AS squat_1rm_rel, nordic_latest AS nordic_n, body_fat_latest AS body_fat_pct,
    date_diff('day', last_test_date, date_day) AS days_since_test,
    prior_injuries,
    date_diff('day', last_injury_date, date_day) AS days_since_last_injury,
    date_diff('day', last_unavailable_date, date_day) AS days_since_return,
    rating_avg_5m,
    CAST(CASE WHEN day_index > {P.min_history_days} THEN 1 ELSE 0 END AS BIGINT) AS has_full_history,
    CAST(CASE WHEN future_days_available = {_H} THEN 1 ELSE 0 END AS BIGINT) AS label_is_complete,
    CAST(injury_next_7d_raw AS BIGINT) AS injury_next_7d
  FROM windows
),
fact AS MATERIALIZED (
  SELECT *,
    least(100, greatest(0,
        60
        + 10 * coalesce(least(greatest(hrv_z, -3), 3), 0)
        + 6 * (coalesce(sleep_hours_3d, 7.5) - 7.5)
        - 2.5 * (coalesce(soreness_3d, 3) - 3)
        - 2.0 * (coalesce(fatigue_3d, 3) - 3))) AS readiness_score,
    CASE WHEN acwr IS NULL THEN NULL WHEN acwr < 0.8 THEN 'undertrained' WHEN acwr <= 1.3 THEN 'sweet_spot'
         WHEN acwr <= 1.5 THEN 'caution' ELSE 'danger' END AS acwr_zone
  FROM features
)"""

ML_FEATURE_LIST = ", ".join(ML_FEATURES)


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(float(v)) if isinstance(v, float) else str(v)
    body = ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES\n    {body}) AS t({', '.join(cols)})"


TARGETS_SQL = ("SELECT metric, direction, CAST(target_min AS DOUBLE) AS target_min, "
               "CAST(target_optimal AS DOUBLE) AS target_optimal, CAST(target_max AS DOUBLE) AS target_max, unit FROM "
               + _values(TARGETS, ["metric", "direction", "target_min", "target_optimal", "target_max", "unit"]))
LEVERS_SQL = ("SELECT lever_id, label, category, metric, feature_shifts, CAST(step_size AS DOUBLE) AS step_size, "
              "step_type, unit, horizon, CAST(catalog_order AS INTEGER) AS catalog_order FROM "
              + _values([(*r, i) for i, r in enumerate(LEVERS)],
                        ["lever_id", "label", "category", "metric", "feature_shifts", "step_size", "step_type",
                         "unit", "horizon", "catalog_order"]))


def with_ctes(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


# --------------------------------------------------------------------------- rule scorers in SQL
from tidepanel.functions.scores import B0_INJURY, NEUTRAL, POP  # noqa: E402


def _num(name: str, cols: dict[str, str]) -> str:
    base = cols.get(name, name)
    return f"coalesce(CAST({base} AS DOUBLE), {NEUTRAL[name]})" if name in NEUTRAL else base


def _clip(x: str, lo: float, hi: float) -> str:
    return f"least(greatest({x}, {lo}), {hi})"


def rating_sql(cols: dict[str, str] | None = None) -> str:
    c = cols or {}
    f = lambda n: _num(n, c)
    fit = (f"(0.35 * (({f('yoyo_ir1_m')} - {POP['yoyo'][0]}) / {POP['yoyo'][1]})"
           f" + 0.25 * (-({f('sprint_30m_s')} - {POP['sprint'][0]}) / {POP['sprint'][1]})"
           f" + 0.20 * (({f('cmj_cm')} - {POP['cmj'][0]}) / {POP['cmj'][1]})"
           f" + 0.20 * (({f('squat_1rm_rel')} - {POP['squat'][0]}) / {POP['squat'][1]}))")
    dsr = f("days_since_return")
    acwr = f("acwr")
    return (f"(0.50 * {fit}"
            f" + 0.32 * {_clip(f('sleep_hours_3d') + ' - 8.0', -3.0, 0.5)}"
            f" + 0.12 * {_clip(f('carbs_gpkg_3d') + ' - 6.0', -4.0, 1.5)}"
            f" + 0.35 * {_clip(f('protein_gpkg_7d') + ' - 1.6', -0.8, 0.3)}"
            f" + 0.10 * {_clip(f('hydration_l_3d') + ' - 3.0', -1.5, 0.5)}"
            f" + (-0.9 * {_clip(acwr + ' - 1.3', 0.0, 1.0)} - 0.6 * {_clip('0.8 - ' + acwr, 0.0, 0.5)})"
            f" + 0.18 * {_clip(f('hrv_z'), -2.5, 2.5)}"
            f" + -0.30 * (CASE WHEN {dsr} IS NULL THEN 0.0 ELSE CAST({dsr} <= 21 AS DOUBLE) END))")


def log_rate_sql(cols: dict[str, str] | None = None) -> str:
    c = cols or {}
    f = lambda n: _num(n, c)
    dsr = f("days_since_return")
    acwr = f("acwr")
    return (f"({B0_INJURY}"
            f" + 1.7 * {_clip(acwr + ' - 1.3', 0.0, 1.2)}"
            f" + 0.9 * {_clip('0.75 - ' + acwr, 0.0, 0.5)}"
            f" + 0.30 * {_clip('8.0 - ' + f('sleep_hours_7d'), 0.0, 3.0)}"
            f" + 0.9 * {_clip('1.6 - ' + f('protein_gpkg_7d'), 0.0, 1.0)}"
            f" + 0.60 * {_clip('(340.0 - ' + f('nordic_n') + ') / 55.0', 0.0, 2.5)}"
            f" + 0.22 * least({f('prior_injuries')}, 5.0)"
            f" + 0.045 * ({f('age_years')} - 26.0)"
            f" + 0.35 * {_clip('-' + f('hrv_z'), 0.0, 3.0)}"
            f" + 0.60 * (CASE WHEN {dsr} IS NULL THEN 0.0 ELSE CAST({dsr} >= 1 AND {dsr} <= 14 AS DOUBLE) END))")


def risk_sql(cols: dict[str, str] | None = None) -> str:
    return f"(1.0 - exp(-exp({log_rate_sql(cols)}) * coalesce(exposure_7d, 0.0)))"


def band_sql(p: str) -> str:
    return (f"CASE WHEN {p} >= 0.2 THEN 'Critical' WHEN {p} >= 0.1 THEN 'High' "
            f"WHEN {p} >= 0.05 THEN 'Moderate' ELSE 'Low' END")


def round_to_sql(x: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(floor(({x}) * CAST({scale} AS DOUBLE) + 0.5) / CAST({scale} AS DOUBLE))"
