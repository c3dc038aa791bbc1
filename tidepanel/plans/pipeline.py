"""The panel pipeline: feeds -> staging -> dense panel -> rolling features -> facts.

Every step is a lazy DataFrame; Catalyst sees the whole chain. Only two tiny
results go to the driver while a plan is built: the calendar span (one row)
and the row count of the team schedule before it is broadcast.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions import columns as C
from tidepanel.functions import frames as W
from tidepanel.functions.scores import exposure_weight
from tidepanel.operators.dedupe import dedupe_latest, flag_rows
from tidepanel.operators.panel import (Calendar, assemble, calendar_bounds, calendar_series, checked_broadcast,
                                       dense_spine, entity_spans, forward_count, grid, interval_days)
from tidepanel.plans.feeds import SupplierFeeds
from tidepanel.operators.rolling import names_in, rolled
from tidepanel.session import compile_in_parts, cut_lineage

E, D = "entity_id", "date_day"

# Sensor ranges, unit factor and session filters of the cleaning rules.
SPEED_UNIT_FACTORS = {"ms": 3.6}
MAX_SPEED_KMH = 45.0
HRV_RANGE = (5.0, 250.0)
RHR_RANGE = (30.0, 100.0)
SLEEP_RANGE = (2.0, 14.0)
RPE_RANGE = (0.0, 10.0)
MIN_FORM_MINUTES = 15
MIN_MATCH_MINUTES = 30

# Most entity-days of a wide fact that is kept for the marts after it (about 2 GB). A larger one is built by each query from
# the feeds, with the columns that it reads.
KEPT_FACT_ROWS = 4_000_000

# Entity-days of a task of the panel: they are listed after its shuffle, so the bytes shuffled say nothing on what a task holds and sorts.
TASK_DAYS = 250_000


@dataclass(frozen=True)
class Params:
    min_history_days: int = 28
    label_horizon_days: int = 7
    train_end: str = "1999-12-31"
    val_end: str = "2000-06-30"
    state_rows: int = 14
    state_max_age_days: int = 45


ZERO_FILLED = ["exposure_h", "daily_load", "daily_minutes", "sessions", "match_minutes", "gym_sessions", "rehab_sessions",
               "hsr_distance_m", "sprint_count", "total_distance_m", "injury_onset", "is_unavailable"]

# Fixed-width dimension values ride along with the spine through the union-aggregate (all buffers are
# mutable fixed-width, so it runs as a code-generated HashAggregate); the string labels are joined after.
DIM_COLS = ["team_id", "birth_date", "height_cm", "weight_kg"]
DIM_LABELS = ["position_code", "position_group"]

# Rolling features: (name, aggregate, input column, frame, width). One select, one Window.
FEATURES: list[tuple[str, str, str, str, int]] = [
    ("acute_load_7d", "avg", "daily_load", "prior", 7),
    ("chronic_load_28d", "avg", "daily_load", "prior", 28),
    ("load_sd_7d", "stddev", "daily_load", "prior", 7),
    ("weekly_load_7d", "sum", "daily_load", "prior", 7),
    ("hsr_distance_7d", "sum", "hsr_distance_m", "prior", 7),
    ("sprint_count_7d", "sum", "sprint_count", "prior", 7),
    ("max_speed_28d", "max", "max_speed_kmh", "prior", 28),
    ("sessions_7d", "sum", "sessions", "prior", 7),
    ("match_minutes_28d", "sum", "match_minutes", "prior", 28),
    ("gym_sessions_28d", "sum", "gym_sessions", "prior", 28),
    ("exposure_7d", "sum", "exposure_h", "prior", 7),
    ("sleep_hours_3d", "avg", "sleep_hours", "incl", 3),
    ("sleep_hours_7d", "avg", "sleep_hours", "incl", 7),
    ("sleep_hours_28d", "avg", "sleep_hours", "incl", 28),
    ("sleep_variability_7d", "stddev", "sleep_hours", "incl", 7),
    ("sleep_efficiency_7d", "avg", "sleep_efficiency_pct", "incl", 7),
    ("hrv_baseline_28d", "avg", "hrv_rmssd_ms", "prior", 28),
    ("hrv_sd_28d", "stddev", "hrv_rmssd_ms", "prior", 28),
    ("rhr_baseline_28d", "avg", "resting_hr_bpm", "prior", 28),
    ("rhr_sd_28d", "stddev", "resting_hr_bpm", "prior", 28),
    ("soreness_3d", "avg", "soreness", "incl", 3),
    ("fatigue_3d", "avg", "fatigue", "incl", 3),
    ("stress_7d", "avg", "stress", "incl", 7),
    ("mood_7d", "avg", "mood", "incl", 7),
    ("wellness_log_rate_7d", "rate", "hrv_rmssd_ms", "incl", 7),
    ("protein_gpkg_7d", "avg", "protein_gpkg", "prior", 7),
    ("carbs_gpkg_3d", "avg", "carbs_gpkg", "prior", 3),
    ("carbs_gpkg_7d", "avg", "carbs_gpkg", "prior", 7),
    ("kcal_per_kg_7d", "avg", "kcal_per_kg", "prior", 7),
    ("hydration_l_3d", "avg", "hydration_l", "prior", 3),
    ("hydration_l_7d", "avg", "hydration_l", "prior", 7),
    ("nutrition_log_rate_7d", "rate", "protein_gpkg", "prior", 7),
    ("cmj_latest", "last", "cmj_cm", "all_incl", 0),
    ("sprint_30m_latest", "last", "sprint_30m_s", "all_incl", 0),
    ("yoyo_latest", "last", "yoyo_ir1_m", "all_incl", 0),
    ("squat_latest", "last", "squat_1rm_rel", "all_incl", 0),
    ("nordic_latest", "last", "nordic_n", "all_incl", 0),
    ("body_fat_latest", "last", "body_fat_pct", "all_incl", 0),
    ("last_test_date", "last_day", "cmj_cm", "all_incl", 0),
    ("prior_injuries", "count_flag", "injury_onset", "all_prior", 0),
    ("last_injury_date", "last_day_flag", "injury_onset", "all_prior", 0),
    ("last_unavailable_date", "last_day_flag", "is_unavailable", "all_prior", 0),
    ("rating_avg_5m", "last", "form_incl", "all_prior", 0),
]

# The 45 model features (PRJ4): one list, used by both feature marts.
ML_FEATURES = [
    "acute_load_7d", "chronic_load_28d", "acwr", "load_monotony_7d", "load_strain_7d",
    "hsr_distance_7d", "sprint_count_7d", "max_speed_28d", "sessions_7d", "match_minutes_28d", "gym_sessions_28d",
    "sleep_hours_3d", "sleep_hours_7d", "sleep_hours_28d", "sleep_variability_7d", "sleep_efficiency_7d",
    "hrv_z", "rhr_z", "soreness_3d", "fatigue_3d", "stress_7d", "mood_7d",
    "wellness_log_rate_7d", "nutrition_log_rate_7d",
    "protein_gpkg_7d", "carbs_gpkg_3d", "carbs_gpkg_7d", "kcal_per_kg_7d", "hydration_l_3d", "hydration_l_7d",
    "cmj_cm", "sprint_30m_s", "yoyo_ir1_m", "squat_1rm_rel", "nordic_n", "body_fat_pct", "days_since_test",
    "age_years", "height_cm", "weight_kg", "prior_injuries", "days_since_last_injury", "days_since_return",
    "rating_avg_5m", "matches_next_7d",
]


# How a column of the fact is made, where it is no column of the panel, of its labels or its schedule, and no rolling feature (``rolling.Made``).
_MONOTONY = ("ratio", "acute_load_7d", "load_sd_7d")
MADE = {
    "age_years": ("years", "birth_date"), "match_copies": ("times", "match_rows", "dim_rows"),
    "acwr": ("ratio", "acute_load_7d", "chronic_load_28d"), "load_monotony_7d": _MONOTONY, "load_strain_7d": ("times", "weekly_load_7d", _MONOTONY),
    "hrv_z": ("ratio", ("minus", "hrv_rmssd_ms", "hrv_baseline_28d"), "hrv_sd_28d"),
    "rhr_z": ("ratio", ("minus", "resting_hr_bpm", "rhr_baseline_28d"), "rhr_sd_28d"),
    "cmj_cm": "cmj_latest", "sprint_30m_s": "sprint_30m_latest", "yoyo_ir1_m": "yoyo_latest", "squat_1rm_rel": "squat_latest",
    "nordic_n": "nordic_latest", "body_fat_pct": "body_fat_latest", "days_since_test": ("days", "last_test_date"),
    "days_since_last_injury": ("days", "last_injury_date"), "days_since_return": ("days", "last_unavailable_date"),
}
# Columns that are made of others of the fact.
LAST = {"readiness_score": ["hrv_z", "sleep_hours_3d", "soreness_3d", "fatigue_3d"], "acwr_zone": ["acwr"]}
SCHEDULE_COLS = ["is_match_day", "matches_next_7d"]

FACT_COLS = [
    "day_index", "team_id", "position_code", "position_group", "height_cm", "weight_kg", "age_years",
    "daily_load", "daily_minutes", "sessions", "rehab_sessions", "match_minutes", "hrv_rmssd_ms", "resting_hr_bpm",
    "sleep_hours", "soreness", "fatigue", "stress", "mood", "is_match_day", "matches_next_7d",
    "is_unavailable", "injury_onset", "played", "match_rating", "match_played", "match_copies",
    "acute_load_7d", "chronic_load_28d", "acwr", "load_monotony_7d", "load_strain_7d",
    "hsr_distance_7d", "sprint_count_7d", "max_speed_28d", "sessions_7d", "match_minutes_28d", "gym_sessions_28d", "exposure_7d",
    "sleep_hours_3d", "sleep_hours_7d", "sleep_hours_28d", "sleep_variability_7d", "sleep_efficiency_7d", "hrv_z", "rhr_z",
    "soreness_3d", "fatigue_3d", "stress_7d", "mood_7d", "wellness_log_rate_7d",
    "protein_gpkg_7d", "carbs_gpkg_3d", "carbs_gpkg_7d", "kcal_per_kg_7d", "hydration_l_3d", "hydration_l_7d", "nutrition_log_rate_7d",
    "cmj_cm", "sprint_30m_s", "yoyo_ir1_m", "squat_1rm_rel", "nordic_n", "body_fat_pct", "days_since_test",
    "prior_injuries", "days_since_last_injury", "days_since_return", "rating_avg_5m",
    "has_full_history", "label_is_complete", "injury_next_7d", "readiness_score", "acwr_zone",
]


class PanelPipeline:
    def __init__(self, feeds: SupplierFeeds, params: Params = Params()):
        self.feeds = feeds
        self.spark = feeds.spark
        self.p = params
        compile_in_parts(self.spark)

    # ================================================================ staging (FCT7)
    @cached_property
    def stg_sessions(self) -> DataFrame:
        # Values that follow from other columns are worked out after the shuffle, not carried through it.
        latest = self.feeds.session_values(dedupe_latest(self.feeds.session_lines(), ["l_orderkey", "l_linenumber"],
                                                         ["loaded_at", "l_partkey", E, "l_extendedprice"]))
        speed = C.convert_unit("max_speed_raw", "speed_unit", SPEED_UNIT_FACTORS)
        norm = (latest.select("l_orderkey", "l_linenumber", E, "session_date",
                              F.lower("session_type").alias("session_type"), "duration_min", "rpe",
                              "total_distance_m", "hsr_distance_m", "sprint_count", speed.alias("max_speed_kmh_raw"))
                .where((F.col("duration_min") > 0) & F.col("rpe").between(*RPE_RANGE)))
        return norm.select(
            "l_orderkey", "l_linenumber", E, "session_date", "session_type", "duration_min", "rpe",
            (F.col("duration_min") * F.col("rpe")).alias("srpe_load"), "total_distance_m",
            C.null_if_exceeds("hsr_distance_m", "total_distance_m").alias("hsr_distance_m"), "sprint_count",
            C.null_outside("max_speed_kmh_raw", hi=MAX_SPEED_KMH).alias("max_speed_kmh"),
            C.present("total_distance_m").cast("int").alias("has_gps"))

    @cached_property
    def daily_load(self) -> DataFrame:
        """AGG1 + AGG2: sessions -> (entity, day)."""
        s = self.stg_sessions
        t = F.col("session_type")
        return s.groupBy(E, F.col("session_date").alias(D)).agg(
            F.sum("srpe_load").alias("daily_load"),
            F.sum("duration_min").alias("daily_minutes"),
            F.count(F.lit(1)).alias("sessions"),
            F.sum(F.when(t == "match", F.col("duration_min")).otherwise(F.lit(0.0))).alias("match_minutes"),
            F.sum(F.when(t == "gym", 1).otherwise(0)).cast("long").alias("gym_sessions"),
            F.sum(F.when(t == "rehab", 1).otherwise(0)).cast("long").alias("rehab_sessions"),
            F.sum("total_distance_m").alias("total_distance_m"),
            F.sum("hsr_distance_m").alias("hsr_distance_m"),
            F.sum("sprint_count").alias("sprint_count"),
            F.max("max_speed_kmh").alias("max_speed_kmh"),
            F.sum(exposure_weight(t) * F.col("duration_min") / 60.0).alias("exposure_h"))

    def _latest_daily(self, df: DataFrame) -> DataFrame:
        return dedupe_latest(df, [E, D], ["l_orderkey", "l_linenumber"])

    @cached_property
    def stg_wellness(self) -> DataFrame:
        w = self._latest_daily(self.feeds.wellness())
        return w.select(E, D, C.null_outside("hrv_rmssd_ms", *HRV_RANGE).alias("hrv_rmssd_ms"),
                        C.null_outside("resting_hr_bpm", *RHR_RANGE).alias("resting_hr_bpm"),
                        "soreness", "fatigue", "stress", "mood")

    @cached_property
    def stg_sleep(self) -> DataFrame:
        s = self._latest_daily(self.feeds.sleep())
        return s.select(E, D, C.null_outside("sleep_hours", *SLEEP_RANGE).alias("sleep_hours"), "sleep_efficiency_pct")

    @cached_property
    def stg_nutrition(self) -> DataFrame:
        """PRJ10: per-kg values from the roster body mass; dedupe before the join (T4)."""
        n = self._latest_daily(self.feeds.nutrition())
        a = self.feeds.entities().select(E, "weight_kg")
        j = n.join(a, E, "inner")
        return j.select(E, D, "kcal", "protein_g", "carbs_g", "hydration_l",
                        C.ratio("protein_g", "weight_kg").alias("protein_gpkg"),
                        C.ratio("carbs_g", "weight_kg").alias("carbs_gpkg"),
                        C.ratio("kcal", "weight_kg").alias("kcal_per_kg"))

    @cached_property
    def stg_tests(self) -> DataFrame:
        t = self._latest_daily(self.feeds.tests())
        return t.select(F.concat(F.col(E).cast("string"), F.lit("-"), F.col(D).cast("string")).alias("test_id"),
                        E, D, "cmj_cm", "sprint_30m_s", "yoyo_ir1_m", "squat_1rm_rel", "nordic_n", "body_fat_pct")

    @cached_property
    def stg_injuries(self) -> DataFrame:
        i = dedupe_latest(self.feeds.injuries(), ["injury_id"], ["loaded_at", "l_partkey", E, "l_extendedprice"],
                          columns=[E, "injury_date", "days_out"])
        start, end = C.interval_of("injury_date", "days_out")
        return i.select("injury_id", E, "injury_date", "days_out", C.severity_band("days_out").alias("severity"),
                        start.alias("unavailable_from"), end.alias("unavailable_to"))

    @cached_property
    def stg_fixtures(self) -> DataFrame:
        f = self.feeds.fixtures()
        return f.select("fixture_id", "team_id", F.col("fixture_date").alias(D), "competition", "opponent_strength")

    @cached_property
    def stg_matches(self) -> DataFrame:
        m = self._latest_daily(self.feeds.match_stats())
        f = self.feeds.fixtures().select("fixture_id", "competition", "opponent_strength")
        return (m.join(f, "fixture_id", "left")
                .select(F.concat(F.col(E).cast("string"), F.lit("-"), F.col(D).cast("string")).alias("match_stat_id"),
                        "fixture_id", E, D, "minutes_played", "performance_rating", "competition", "opponent_strength"))

    @cached_property
    def stg_entities(self) -> DataFrame:
        """Roster with the signing date = first session day."""
        first = self.daily_load.groupBy(E).agg(F.min(D).alias("signed_date"))
        a = self.feeds.entities()
        return (a.join(first, E, "left")
                .select(E, "team_id", C.normalise_code("position").alias("position_code"), "birth_date",
                        "height_cm", "weight_kg", F.lower("dominant_foot").alias("dominant_foot"), "signed_date"))

    # ================================================================ calendar, dims
    @cached_property
    def calendar(self) -> Calendar:
        return calendar_bounds(self.feeds.lines(), "l_shipdate")

    def calendar_df(self) -> DataFrame:
        return calendar_series(self.spark, self.calendar)

    @cached_property
    def dim_entity(self) -> DataFrame:
        """DIM1: group lookup (left join), age at the calendar end, BMI."""
        a = self.stg_entities
        g = F.broadcast(self.feeds.groups())
        return (a.join(g, "position_code", "left")
                .select(E, "team_id", "position_code", "position_name", "position_group", "birth_date",
                        C.age_years("birth_date", F.lit(self.calendar.end)).alias("age_years_at_as_of"),
                        "height_cm", "weight_kg",
                        F.round(F.col("weight_kg") / F.pow(F.col("height_cm") / 100.0, 2), 1).alias("bmi"),
                        "dominant_foot", "signed_date"))

    def dim_date(self) -> DataFrame:
        """DIM2."""
        d = self.calendar_df()
        return d.select(D, F.year(D).cast("long").alias("year"), F.month(D).cast("long").alias("month"),
                        C.day_of_week_sunday0(D).alias("day_of_week"), C.season_phase(D).alias("season_phase"),
                        C.season_label(D).alias("season"))

    # ================================================================ panel (FCT1, FCT6)
    @cached_property
    def spine(self) -> DataFrame:
        return dense_spine(self.dim_entity.where(F.col("signed_date").isNotNull()), self.calendar,
                           start_col="signed_date", keep=DIM_COLS)

    @cached_property
    def spans(self) -> DataFrame:
        """The spine as one row per entity; its days are listed after the panel's shuffle."""
        d = self.dim_entity.where(F.col("signed_date").isNotNull())
        return entity_spans(d.withColumn("dim_rows", F.count(F.lit(1)).over(Window.partitionBy(E))), self.calendar,
                            start_col="signed_date", keep=[*DIM_COLS, "dim_rows"])

    @cached_property
    def most_days(self) -> int:
        """Entity-days of the panel if every entity joined on the calendar's first day."""
        return self.feeds.table("supplier").count() * self.calendar.n_days

    @cached_property
    def team_schedule(self) -> DataFrame:
        teams = self.feeds.entities().select("team_id").distinct()
        g = grid(teams, self.calendar)
        match_days = flag_rows(self.stg_fixtures, ["team_id", D], "is_match_day")
        flagged = (g.join(match_days, ["team_id", D], "left")
                   .select("team_id", D, F.coalesce(F.col("is_match_day"), F.lit(0)).cast("long").alias("is_match_day")))
        return forward_count(flagged, "team_id", "is_match_day", 7, "matches_next_7d")

    @cached_property
    def unavailable(self) -> DataFrame:
        return interval_days(self.stg_injuries, "unavailable_from", "unavailable_to").select(
            E, D, F.col("is_unavailable").cast("long").alias("is_unavailable"))

    @cached_property
    def onsets(self) -> DataFrame:
        return (self.stg_injuries.select(E, F.col("injury_date").alias(D)).groupBy(E, D)
                .agg(F.lit(1).cast("long").alias("injury_onset")))

    @cached_property
    def match_form(self) -> DataFrame:
        """WIN19: mean rating of the last 5 matches incl. this one (events, not days)."""
        m = self.stg_matches.where(F.col("minutes_played") >= MIN_FORM_MINUTES)
        w = W.ordered(E, D).rowsBetween(-4, 0)
        return m.select(E, D, "performance_rating", F.avg("performance_rating").over(w).alias("form_rating_5m"))

    @cached_property
    def match_feed(self) -> DataFrame:
        """One row per entity and match day: form, rating, minutes and the number of its rows (a fixture that comes twice gives two)."""
        m = self.stg_matches.where(F.col("minutes_played") >= MIN_FORM_MINUTES)
        form = F.avg("performance_rating").over(W.ordered(E, D).rowsBetween(-4, 0))
        return (m.select(E, D, "performance_rating", "minutes_played", form.alias("form")).groupBy(E, D)
                .agg(F.max("form").alias("form_incl"), F.max("performance_rating").alias("match_rating"),
                     F.max("minutes_played").alias("match_played"), F.count(F.lit(1)).alias("match_rows"))
                .withColumn("played", F.lit(1)))

    @cached_property
    def panel(self) -> DataFrame:
        """FCT1 via union-aggregate: one Exchange on entity for the panel and its rolling features. An entity's days come once for each of its roster
        rows (``__copy``); labels and schedule are joined after the features, to the rows that are read."""
        daily = self.daily_load
        feeds = [
            (daily, {c: c for c in ["daily_load", "daily_minutes", "sessions", "match_minutes", "gym_sessions",
                                    "rehab_sessions", "hsr_distance_m", "sprint_count", "max_speed_kmh",
                                    "total_distance_m", "exposure_h"]}),
            (self.stg_sleep, {"sleep_hours": "sleep_hours", "sleep_efficiency_pct": "sleep_efficiency_pct"}),
            (self.stg_wellness, {c: c for c in ["hrv_rmssd_ms", "resting_hr_bpm", "soreness", "fatigue", "stress", "mood"]}),
            (self.stg_nutrition, {c: c for c in ["protein_gpkg", "carbs_gpkg", "kcal_per_kg", "hydration_l"]}),
            (self.stg_tests, {c: c for c in ["cmj_cm", "sprint_30m_s", "yoyo_ir1_m", "squat_1rm_rel", "nordic_n",
                                             "body_fat_pct"]}),
            (self.onsets, {"injury_onset": "injury_onset"}),
            (self.unavailable, {"is_unavailable": "is_unavailable"}),
            (self.match_feed, {c: c for c in ["form_incl", "played", "match_rating", "match_played", "match_rows"]}),
        ]
        panel = assemble(self.spans, feeds, zero_fill=ZERO_FILLED, spine_cols=("day_index", *DIM_COLS, "dim_rows"), cal=self.calendar,
                         tasks=max(self.spark.sparkContext.defaultParallelism, -(-self.most_days // TASK_DAYS)))
        known = panel.where(F.col(E).isNotNull())
        if self.one_row_days:
            return known
        return known.select("*", F.posexplode(F.array_repeat(F.lit(1), F.col("dim_rows").cast("int"))).alias("__copy", "__one")).drop("__one")

    @cached_property
    def labels(self) -> DataFrame:
        raw = self.feeds.entities().select(E, C.normalise_code("position").alias("position_code"))
        return raw.join(F.broadcast(self.feeds.groups()), "position_code", "left").where(F.col(E).isNotNull()).select(E, *DIM_LABELS)

    @cached_property
    def one_row_days(self) -> bool:
        """Whether each entity has one row in the roster, so that the panel has one row per (entity, day)."""
        return self.labels.groupBy(E).count().where("count > 1").isEmpty()

    def with_labels(self, panel: DataFrame) -> DataFrame:
        """The labels of each roster row to that row's days."""
        if self.one_row_days:
            return panel.join(checked_broadcast(self.labels), E, "inner")
        numbered = self.labels.withColumn("__copy", F.row_number().over(Window.partitionBy(E).orderBy(*DIM_LABELS)) - 1)
        return panel.join(checked_broadcast(numbered), [E, "__copy"], "inner").drop("__copy")

    def with_schedule(self, panel: DataFrame) -> DataFrame:
        return panel.join(self.schedule, ["team_id", D], "left")

    @cached_property
    def schedule(self) -> DataFrame:
        return checked_broadcast(self.team_schedule)

    @cached_property
    def base(self) -> DataFrame:
        return self.with_schedule(self.with_labels(self.panel))

    # ================================================================ features (FCT2)
    def features(self, columns, rows: Column | None = None, panel: DataFrame | None = None) -> DataFrame:
        """The fact's ``columns`` from the features and columns of the panel that they are made of. ``rows``, a condition on the panel's columns,
        says which days come out; frames see all. A ``panel`` of the same layout may have columns of its own, which come along."""
        panel = self.panel if panel is None else panel
        h = self.p.label_horizon_days
        feature = {f[0]: f for f in [*FEATURES, ("injury_next_7d", "max", "injury_onset", "future", h), ("future_days_available", "rows", "injury_onset", "future", h)]}
        formulas = MADE | {"has_full_history": ("over", "day_index", self.p.min_history_days), "label_is_complete": ("equals", "future_days_available", h)}
        first = list(dict.fromkeys(x for c in columns for x in LAST.get(c, [c])))
        labelled, scheduled = any(c in DIM_LABELS for c in first), any(c in SCHEDULE_COLS for c in first)
        made = {c: formulas.get(c, c) for c in first if c in formulas or c in feature}
        keep = [E, D, *[c for c in first if c not in made and c not in DIM_LABELS and c not in SCHEDULE_COLS and c not in (E, D)]]
        keep += ["team_id"] * (scheduled and "team_id" not in keep) + ["__copy"] * (labelled and not self.one_row_days)
        read = {n for m in made.values() for n in names_in(m)}
        wide = rolled(panel, [f for n, f in feature.items() if n in read], keep, rows, made)
        wide = self.with_labels(wide) if labelled else wide
        wide = self.with_schedule(wide) if scheduled else wide
        last = {"readiness_score": C.readiness_score, "acwr_zone": lambda: C.acwr_zone("acwr")}
        return wide.select(E, D, *[last[c]().alias(c) if c in last else F.col(c) for c in columns])

    @property
    def full_history(self) -> Column:
        return F.col("day_index") > self.p.min_history_days

    # ================================================================ facts (FCT3-5)
    @cached_property
    def fact(self) -> DataFrame:
        """FCT3; ``played`` marks the days of matches of ``MIN_FORM_MINUTES`` or more."""
        f = self.features(FACT_COLS)
        return f.persist(StorageLevel.MEMORY_AND_DISK) if self.kept else f

    @cached_property
    def kept(self) -> bool:
        return self.most_days <= KEPT_FACT_ROWS

    def fact_of(self, columns, rows: Column | None = None) -> DataFrame:
        """Entity, day and ``columns`` of the fact's rows, or of those of ``rows`` (a condition on columns that the panel has too). Of a fact that isn't kept, only the
        features that make these columns are computed."""
        columns = list(dict.fromkeys(c for c in columns if c not in (E, D)))
        if self.kept:
            return (self.fact if rows is None else self.fact.where(rows)).select(E, D, *columns)
        return self.features(columns, rows)

    def write_days(self, columns) -> None:
        """For marts that read both the days of matches and each entity's last days: those days of a fact that isn't kept, written once
        with the columns that the marts read."""
        if "fact_days" not in self.__dict__ and not self.kept:
            some = (F.col("played") == 1) | (F.col(D) >= F.lit(self.last_days))
            self.fact_days = cut_lineage(self.fact_of(columns, some))

    @property
    def last_days(self) -> dt.date:
        """The first of the last days that ``write_days`` writes whole."""
        return self.calendar.end - dt.timedelta(self.p.state_max_age_days)

    def days(self) -> DataFrame:
        """The fact, or what ``write_days`` has written: every match day and the last days of each entity."""
        return self.__dict__["fact_days"] if "fact_days" in self.__dict__ else self.fact

    def fact_events(self) -> DataFrame:
        """FCT4 / JN10: each onset with the entity's state on that morning."""
        i = self.stg_injuries
        d = self.dim_entity.select(E, "team_id", "position_group")
        # Only days with an onset can be joined, so no others are shuffled.
        f = (self.fact_of(["acwr", "acwr_zone", "sleep_hours_7d", "protein_gpkg_7d", "nordic_n", "hrv_z", "prior_injuries"], F.col("injury_onset") == 1)
             .withColumnRenamed(D, "injury_date"))
        return (i.join(d, E, "inner").join(f, [E, "injury_date"], "left")
                .select("injury_id", E, "team_id", "position_group", "injury_date", "days_out", "severity",
                        F.col("acwr").alias("acwr_at_onset"), F.col("acwr_zone").alias("acwr_zone_at_onset"),
                        F.col("sleep_hours_7d").alias("sleep_hours_7d_at_onset"),
                        F.col("protein_gpkg_7d").alias("protein_gpkg_7d_at_onset"),
                        F.col("nordic_n").alias("nordic_n_at_onset"), F.col("hrv_z").alias("hrv_z_at_onset"),
                        F.col("prior_injuries").alias("prior_injuries_at_onset")))

    def fact_matches(self) -> DataFrame:
        m = self.stg_matches
        d = self.dim_entity.select(E, "team_id", "position_group")
        return m.join(d, E, "inner").select("match_stat_id", "fixture_id", E, "team_id", "position_group", D,
                                            "minutes_played", "performance_rating", "competition",
                                            "opponent_strength")

    def fact_tests(self) -> DataFrame:
        """FCT5 / WIN20: change since the entity's previous test."""
        t = self.stg_tests
        d = self.dim_entity.select(E, "team_id", "position_group")
        w = W.ordered(E, D)
        changes = [(F.col(c) - F.lag(c).over(w)).alias(n) for c, n in
                   [("cmj_cm", "cmj_change"), ("sprint_30m_s", "sprint_change"), ("yoyo_ir1_m", "yoyo_change"),
                    ("squat_1rm_rel", "squat_change"), ("nordic_n", "nordic_change")]]
        return t.join(d, E, "inner").select("test_id", E, "team_id", "position_group", D, "cmj_cm", "sprint_30m_s",
                                            "yoyo_ir1_m", "squat_1rm_rel", "nordic_n", "body_fat_pct", *changes)

    # ================================================================ ML marts (ML1, ML2)
    @property
    def scorable(self) -> Column:
        """Days that the models score."""
        return self.full_history & (F.col("is_unavailable") == 0)

    def injury_mart(self, columns=("position_group", "injury_next_7d", "label_is_complete", *ML_FEATURES)) -> DataFrame:
        return self.fact_of(columns, self.scorable)

    def perf_mart(self, columns=ML_FEATURES) -> DataFrame:
        """Match rows with pre-match state; who reads it more than once keeps the columns it needs."""
        return self.with_matches(self.fact_of(["position_group", *columns], self.match_days), columns)

    @property
    def match_days(self) -> Column:
        return self.full_history & (F.col("played") == 1)  # other days have no match to join

    def perf_rows(self, columns=ML_FEATURES, rows: Column | None = None) -> DataFrame:
        """``perf_mart`` without the opponent. Rating and minutes of a day's match ride in the panel, so its wide rows take no shuffle;
        where a match or a roster row comes several times, so does the day, as in the join. ``rows`` is as in ``fact_of``."""
        some = self.match_days & (F.col("match_played") >= MIN_MATCH_MINUTES)
        f = self.fact_of(["position_group", "match_rating", "match_played", "match_copies", *columns], some if rows is None else some & rows)
        return (f.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("match_copies").cast("int"))))
                .select(E, D, "position_group", F.col("match_rating").alias("performance_rating"), F.col("match_played").alias("minutes_played"), *columns))

    def with_matches(self, f: DataFrame, cols: list[str]) -> DataFrame:
        m = self.fact_matches().select(E, D, "performance_rating", "minutes_played", "opponent_strength")
        return (f.join(m.where(F.col("minutes_played") >= MIN_MATCH_MINUTES), [E, D], "inner")
                .select(E, D, "position_group", "performance_rating", "minutes_played", "opponent_strength", *cols))


_PIPELINES: dict[tuple[str, str, Params], PanelPipeline] = {}


def pipeline_for(spark, sf_dir: str, params: Params = Params()) -> PanelPipeline:
    """One pipeline per (application, input folder, parameters).

    Like the reference's materialised tables, a wide fact of at most ``KEPT_FACT_ROWS``
    is persisted once and shared by every mart built on it; lost blocks are recomputed
    from lineage. Each query on a larger one reads the feeds again, without the columns
    and windows that it doesn't use: the whole fact would not fit memory and disk.
    """
    key = (spark.sparkContext.applicationId, sf_dir, params)
    p = _PIPELINES.get(key)
    if p is None:
        p = PanelPipeline(SupplierFeeds(spark, sf_dir), params)
        _PIPELINES[key] = p
    return p


def release_all() -> None:
    for p in _PIPELINES.values():
        if "fact" in p.__dict__:
            p.fact.unpersist()
    _PIPELINES.clear()
