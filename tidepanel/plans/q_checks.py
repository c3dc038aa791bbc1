"""Registered queries: data-quality checks, freshness, manifest (2.1, 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import checks as Q
from tidepanel.plans.catalog import register
from tidepanel.plans.oracle import FEATURE_CTES, FEEDS, with_ctes
from tidepanel.plans.q_panel import RECOMPUTE_CTE, acwr_both, pp

E, D = "entity_id", "date_day"
ACCEPTED_STATUS = ["O", "F"]
FRESHNESS_AS_OF = "2002-01-01 00:00:00"


@register("dq_not_null", with_ctes(FEEDS, """
SELECT l_orderkey, l_linenumber, max_speed_kmh FROM stg_sessions WHERE max_speed_kmh IS NULL"""),
          doubles=["max_speed_kmh"])
def dq_not_null(spark, sf_dir):
    return Q.not_null(pp(spark, sf_dir).stg_sessions, "max_speed_kmh", keys=["l_orderkey", "l_linenumber"])


@register("dq_unique", with_ctes(FEEDS, """
SELECT injury_id, count(*) AS n_rows FROM raw_injuries WHERE injury_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""))
def dq_unique(spark, sf_dir):
    return Q.unique(pp(spark, sf_dir).feeds.injuries(), "injury_id")


@register("dq_accepted", with_ctes(FEEDS, """
SELECT fixture_id, competition FROM fixtures WHERE competition IS NOT NULL AND competition NOT IN ('O', 'F')"""))
def dq_accepted(spark, sf_dir):
    return Q.accepted(pp(spark, sf_dir).stg_fixtures, "competition", ACCEPTED_STATUS, keys=["fixture_id"])


@register("dq_relationship", with_ctes(FEEDS, """
SELECT match_stat_id, fixture_id FROM stg_matches m
WHERE fixture_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fixtures f WHERE f.fixture_id = m.fixture_id)"""))
def dq_relationship(spark, sf_dir):
    p = pp(spark, sf_dir)
    return Q.relationship(p.stg_matches, p.stg_fixtures, "fixture_id", keys=["match_stat_id"])


@register("dq_unique_combo", with_ctes(FEEDS, """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM raw_sessions GROUP BY 1, 2 HAVING count(*) > 1"""))
def dq_unique_combo(spark, sf_dir):
    return Q.unique_combination(pp(spark, sf_dir).feeds.sessions(), ["l_orderkey", "l_linenumber"])


@register("dq_between", with_ctes(FEEDS, """
SELECT l_orderkey, l_linenumber, max_speed_kmh FROM stg_sessions
WHERE max_speed_kmh IS NOT NULL AND (1 = 0 OR max_speed_kmh > 40.0)"""), doubles=["max_speed_kmh"])
def dq_between(spark, sf_dir):
    return Q.value_between(pp(spark, sf_dir).stg_sessions, "max_speed_kmh", hi=40.0, keys=["l_orderkey", "l_linenumber"])


@register("dq_recompute", with_ctes(FEATURE_CTES + RECOMPUTE_CTE, """
SELECT r.entity_id, r.date_day, r.acwr_check, f.acwr FROM recomputed r JOIN features f USING (entity_id, date_day)
WHERE abs(r.acwr_check - f.acwr) > 1e-6"""), doubles=["acwr_check", "acwr"])
def dq_recompute(spark, sf_dir):
    p = pp(spark, sf_dir)
    return Q.recompute_diff(acwr_both(p), None, [E, D], "acwr_check", "acwr")


@register("dq_row_parity", with_ctes(FEATURE_CTES, """
SELECT s.n AS spine_rows, f.n AS fact_rows
FROM (SELECT count(*) AS n FROM spine) s CROSS JOIN (SELECT count(*) AS n FROM fact) f WHERE s.n <> f.n"""))
def dq_row_parity(spark, sf_dir):
    p = pp(spark, sf_dir)
    return Q.row_parity(p.spine, p.fact_of(["day_index"]), "spine_rows", "fact_rows")


@register("dq_overlap", with_ctes(FEEDS, """
SELECT DISTINCT a.entity_id, a.injury_id AS injury_a, b.injury_id AS injury_b
FROM stg_injuries a JOIN stg_injuries b
  ON a.entity_id = b.entity_id AND a.injury_id < b.injury_id
 AND b.injury_date BETWEEN a.injury_date AND a.unavailable_to"""))
def dq_overlap(spark, sf_dir):
    return Q.overlaps(pp(spark, sf_dir).stg_injuries, E, "injury_id", "injury_date", "unavailable_to")


@register("dq_label_window", with_ctes(FEATURE_CTES, """
SELECT entity_id, date_day, label_is_complete, injury_next_7d FROM fact
WHERE has_full_history = 1 AND is_unavailable = 0
  AND ((label_is_complete = 1 AND injury_next_7d IS NULL)
    OR (label_is_complete = 1 AND date_day > (SELECT cal_end FROM cal) - 6))"""))
def dq_label_window(spark, sf_dir):
    p = pp(spark, sf_dir)
    mart = p.injury_mart(["label_is_complete", "injury_next_7d"])
    return Q.label_window(mart, "injury_next_7d", "label_is_complete", D, p.calendar.end,
                          p.p.label_horizon_days).select(E, D, "label_is_complete", "injury_next_7d")


@register("dq_contradiction", with_ctes(FEEDS, """
SELECT entity_id, date_day, sessions, rehab_sessions FROM base
WHERE is_unavailable = 1 AND sessions - rehab_sessions > 0"""))
def dq_contradiction(spark, sf_dir):
    return Q.contradiction(pp(spark, sf_dir).fact_of(["is_unavailable", "sessions", "rehab_sessions"]), [E, D])


@register("dq_label_names", with_ctes(FEATURE_CTES, """
SELECT column_name FROM (SELECT unnest(['injury_next_7d']) AS column_name) WHERE 1 = 0"""))
def dq_label_names(spark, sf_dir):
    p = pp(spark, sf_dir)
    meta = [E, D, "position_group", "injury_next_7d", "label_is_complete"]
    return Q.label_named_columns(spark, p.injury_mart(), meta)


@register("dq_split_order", with_ctes(FEATURE_CTES, """
SELECT data_split, min(date_day) AS first_day, max(date_day) AS last_day FROM (
  SELECT date_day, CASE WHEN date_day <= DATE '1999-12-31' THEN 'train'
                        WHEN date_day <= DATE '2000-06-30' THEN 'val' ELSE 'test' END AS data_split
  FROM fact WHERE has_full_history = 1 AND is_unavailable = 0) GROUP BY 1"""))
def dq_split_order(spark, sf_dir):
    """AGG20 spans per split; ``split_order`` on the same frame returns no rows."""
    from tidepanel.functions.columns import add_split

    p = pp(spark, sf_dir)
    m = p.injury_mart(["is_unavailable"]).withColumn("data_split", add_split(D, p.p.train_end, p.p.val_end))
    return Q.split_spans(m, "data_split", D)


def _fresh_sql(table, col, opt_out=False):
    age = f"(epoch(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch(max({col}))) / 3600.0"
    status = "'pass'" if opt_out else f"CASE WHEN {age} > 72.0 THEN 'error' WHEN {age} > 36.0 THEN 'warn' ELSE 'pass' END"
    return f"SELECT '{table}' AS table_name, max({col}) AS max_loaded_at, {age} AS age_hours, {status} AS status FROM {table}"


@register("freshness", "\nUNION ALL\n".join([_fresh_sql("lineitem", "l_shipdate"), _fresh_sql("orders", "o_orderdate"),
                                              _fresh_sql("events", "ts", opt_out=True)]), doubles=["age_hours"])
def freshness_q(spark, sf_dir):
    p = pp(spark, sf_dir)
    parts = [Q.freshness(p.feeds.table("lineitem"), "lineitem", "l_shipdate", FRESHNESS_AS_OF),
             Q.freshness(p.feeds.table("orders"), "orders", "o_orderdate", FRESHNESS_AS_OF),
             Q.freshness(p.feeds.table("events"), "events", "ts", FRESHNESS_AS_OF, None, None)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


MANIFEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
                   "pages", "benchmark", "labels", "conversations"]


@register("manifest", "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in MANIFEST_TABLES]
    + ["SELECT 'TOTAL', " + " + ".join(f"(SELECT count(*) FROM {t})" for t in MANIFEST_TABLES)]))
def manifest_q(spark, sf_dir):
    p = pp(spark, sf_dir)
    return Q.manifest([(t, p.feeds.table(t)) for t in MANIFEST_TABLES])


@register("dq_suite", with_ctes(FEATURE_CTES + RECOMPUTE_CTE, """
SELECT check_name, table_name, violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'error' END AS status FROM (
  SELECT 'not_null' AS check_name, 'stg_sessions' AS table_name,
         (SELECT count(*) FROM stg_sessions WHERE max_speed_kmh IS NULL) AS violations
  UNION ALL SELECT 'unique_combination', 'raw_sessions',
         (SELECT count(*) FROM (SELECT 1 FROM raw_sessions GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
  UNION ALL SELECT 'row_parity', 'fct_entity_day',
         (SELECT count(*) FROM (SELECT 1 WHERE (SELECT count(*) FROM spine) <> (SELECT count(*) FROM fact)))
  UNION ALL SELECT 'contradiction', 'entity_day_base',
         (SELECT count(*) FROM base WHERE is_unavailable = 1 AND sessions - rehab_sessions > 0)
  UNION ALL SELECT 'recompute', 'rolling_features',
         (SELECT count(*) FROM recomputed r JOIN features f USING (entity_id, date_day)
          WHERE abs(r.acwr_check - f.acwr) > 1e-6)
)"""))
def dq_suite(spark, sf_dir):
    p = pp(spark, sf_dir)
    return Q.run_checks([
        ("not_null", "stg_sessions", Q.not_null(p.stg_sessions, "max_speed_kmh")),
        ("unique_combination", "raw_sessions", Q.unique_combination(p.feeds.sessions(), ["l_orderkey", "l_linenumber"])),
        ("row_parity", "fct_entity_day", Q.row_parity(p.spine, p.fact_of(["day_index"]))),
        ("contradiction", "entity_day_base", Q.contradiction(p.fact_of(["is_unavailable", "sessions", "rehab_sessions"]), [E, D])),
        ("recompute", "rolling_features",
         Q.recompute_diff(acwr_both(p), None, [E, D], "acwr_check", "acwr")),
    ])
