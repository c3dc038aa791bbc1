"""Registered queries: exact medians, closed-form baselines, paired effects, gap list, version stamp (ML14, SCR5, AGG19, DSH3, PRJ20)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import columns as C
from tidepanel.functions import scores as S
from tidepanel.operators import evaluate as EV
from tidepanel.operators import levers as L
from tidepanel.operators.baseline import ridge
from tidepanel.operators.medians import exact_medians
from tidepanel.plans.catalog import register
from tidepanel.plans.model import LEVER_FEATURES
from tidepanel.plans.oracle import log_rate_sql, rating_sql, round_to_sql, with_ctes
from tidepanel.plans.pipeline import ML_FEATURES, PanelPipeline
from tidepanel.plans.model import round_to
from tidepanel.plans.q_gap import GAP_CTES, gap_df
from tidepanel.plans.q_learn import FEATURES, GROUPS, INJURY_RULES, design
from tidepanel.plans.q_model import MODEL_CTES, mm
from tidepanel.plans.q_panel import pp
from tidepanel.session import cut_lineage

E, D = "entity_id", "date_day"
ALPHA = 50.0


# ----------------------------------------------------------------------------- medians (AGG19)
@register("feature_medians", with_ctes(GAP_CTES, ", rows_in AS MATERIALIZED (SELECT * FROM perf_mart WHERE date_day <= DATE '1999-12-31')\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median FROM rows_in" for c in ML_FEATURES)), doubles=["median"])
def feature_medians(spark, sf_dir):
    """Exact medians of all model features over the training rows of the rating model, in four counting passes."""
    p = pp(spark, sf_dir)
    rows = cut_lineage(p.perf_rows(rows=F.col(D) <= F.lit(p.p.train_end)).select(*ML_FEATURES))
    found = exact_medians(rows, ML_FEATURES)
    return spark.createDataFrame(list(found.items()), "feature string, median double")


# ----------------------------------------------------------------------------- baselines (ML14)
def _design_sql() -> str:
    """Rows of the rating model with all features as doubles, z0..: standardised as the training rows are."""
    z = [*[f"CAST({c} AS DOUBLE)" for c in ML_FEATURES], *[f"coalesce(CAST(position_group = '{g}' AS INTEGER), 0)::DOUBLE" for g in GROUPS]]
    k, ids = len(z), range(len(z))
    cell = lambda i, j: f"sum(z{i} * z{j})" + (f" + {ALPHA}" if i == j else "")
    return f""",
x AS MATERIALIZED (
  SELECT CAST(performance_rating AS DOUBLE) AS y, CAST(rating_avg_5m AS DOUBLE) AS form, date_day <= DATE '1999-12-31' AS train, date_day > DATE '2000-06-30' AS test,
         {", ".join(f"{e} AS x{i}" for i, e in enumerate(z))}
  FROM perf_mart
),
mid AS (SELECT avg(y) AS y0, avg(form) AS form0, {", ".join(f"coalesce(median(x{i}), 0) AS m{i}" for i in ids)} FROM x WHERE train),
filled AS MATERIALIZED (SELECT y, form, train, test, y0, form0, {", ".join(f"coalesce(x{i}, m{i}) AS x{i}" for i in ids)} FROM x CROSS JOIN mid),
spread AS (SELECT {", ".join(f"avg(x{i}) AS a{i}, stddev_pop(x{i}) AS d{i}" for i in ids)} FROM filled WHERE train),
z AS MATERIALIZED (SELECT y, form, train, test, y0, form0, {", ".join(f"CASE WHEN d{i} > 1e-6 THEN (x{i} - a{i}) / d{i} ELSE 0 END AS z{i}" for i in ids)} FROM filled CROSS JOIN spread),
gram AS MATERIALIZED (SELECT [{", ".join("[" + ", ".join([*[cell(min(i, j), max(i, j)) for j in ids], f"sum(z{i} * (y - y0))"]) + "]" for i in ids)}] AS m FROM z WHERE train),
solved AS MATERIALIZED (
  WITH RECURSIVE elimination(k, m) AS (
    SELECT 1, m FROM gram
    UNION ALL
    SELECT k + 1, list_transform(range(1, {k + 1}), lambda i: CASE WHEN i = k THEN list_transform(m[k], lambda v: v / m[k][k])
                                                              ELSE list_transform(range(1, {k + 2}), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]) END)
    FROM elimination WHERE k <= {k}
  )
  SELECT list_transform(m, lambda r: r[{k + 1}]) AS w FROM elimination WHERE k = {k + 1}
),
guesses AS MATERIALIZED (
  SELECT y, y0 AS mean, coalesce(form, form0) AS form, y0 + {" + ".join(f"w[{i + 1}] * z{i}" for i in ids)} AS ridge FROM z CROSS JOIN solved WHERE test
)"""


def baseline_errors_df(p: PanelPipeline) -> DataFrame:
    """(baseline, mae, rmse, r2, n) of the mean, the recent form and the ridge, fitted on training rows, over the test rows."""
    rows = cut_lineage(design(p.perf_rows().withColumn("data_split", C.add_split(D, p.p.train_end, p.p.val_end))).withColumn("y", F.col("performance_rating").cast("double")))
    train = rows.where(F.col("data_split") == "train")
    middle = train.agg(F.avg("y").alias("y"), F.avg("rating_avg_5m").alias("form")).first()
    fitted = ridge(train, FEATURES, "y", ALPHA)
    test = rows.where(F.col("data_split") == "test").select(
        "y", F.lit(middle["y"]).alias("mean"), F.coalesce("rating_avg_5m", F.lit(middle["form"])).alias("form"), fitted.prediction().alias("ridge"))
    parts = [EV.regression_metrics(test, "y", c).select(F.lit(c).alias("baseline"), "mae", "rmse", "r2", "n") for c in ("mean", "form", "ridge")]
    return reduce(DataFrame.unionByName, parts)


@register("baseline_errors", with_ctes(GAP_CTES, _design_sql() + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS baseline, avg(abs(y - {c})) AS mae, sqrt(avg((y - {c}) * (y - {c}))) AS rmse, "
    f"1 - sum((y - {c}) * (y - {c})) / (var_pop(y) * count(*)) AS r2, count(*) AS n FROM guesses" for c in ("mean", "form", "ridge"))),
          doubles=["mae", "rmse", "r2"])
def baseline_errors(spark, sf_dir):
    return baseline_errors_df(pp(spark, sf_dir))


# ----------------------------------------------------------------------------- paired effects (SCR5)
_FILLED = [c for c in S.SCORE_INPUTS if c != "days_since_return"]
_AFTER = {c: f"{c}_after" for c in LEVER_FEATURES}


@register("paired_effects", with_ctes(MODEL_CTES, f""",
fills AS MATERIALIZED (SELECT {", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in _FILLED)} FROM state),
side_by_side AS (
  SELECT entity_id, lever_id, step, days_since_return, {", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in _FILLED)},
         {", ".join(f"coalesce(CAST({c}_after AS DOUBLE), m_{c}) AS {c}_after" for c in LEVER_FEATURES if c in _FILLED)}
  FROM lever_frame CROSS JOIN fills
)
SELECT entity_id, lever_id, avg(step) AS mean_step, count(*) AS n_rows, avg({rating_sql({c: a for c, a in _AFTER.items() if c in _FILLED})} - {rating_sql()}) AS rating_change,
       avg({log_rate_sql({c: a for c, a in _AFTER.items() if c in _FILLED})} - {log_rate_sql()}) AS log_rate_change
FROM side_by_side GROUP BY 1, 2 HAVING abs(avg(step)) > 0"""), doubles=["mean_step", "rating_change", "log_rate_change"])
def paired_effects(spark, sf_dir):
    """SCR5: per entity and lever, the change of the rating signal and of the log injury rate, missing inputs at the medians of the state rows."""
    m = mm(spark, sf_dir)
    frame = m.lever_frame(keep=S.SCORE_INPUTS)
    return L.paired_effects(frame, exact_medians(m.state, _FILLED), LEVER_FEATURES, S.SCORE_INPUTS, {"rating": S.rating_score, "log_rate": S.log_hazard_rate})


# ----------------------------------------------------------------------------- dashboards (DSH3, FN replace)
@register("gap_shortfalls", with_ctes(GAP_CTES, f"""
SELECT entity_id, team_id, replace(metric, '_', ' ') AS label, {round_to_sql('shortfall_pct * 100', 1)} AS shortfall_percent, current_value, target_value, status,
       row_number() OVER (PARTITION BY entity_id ORDER BY shortfall_pct DESC NULLS LAST, metric) AS place
FROM gap"""), doubles=["shortfall_percent", "current_value", "target_value"])
def gap_shortfalls(spark, sf_dir):
    """DSH3: each entity's gaps with a readable name, the largest relative shortfall first."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(E).orderBy(F.col("shortfall_pct").desc_nulls_last(), "metric"))  # at most one row a metric
    return gap_df(pp(spark, sf_dir)).select(E, "team_id", F.replace("metric", F.lit("_"), F.lit(" ")).alias("label"),
                                            round_to(F.col("shortfall_pct") * 100, 1).alias("shortfall_percent"), "current_value", "target_value", "status", place.cast("long").alias("place"))


# ----------------------------------------------------------------------------- version stamp (PRJ20, FN md5)
@register("training_versions", with_ctes(GAP_CTES, """,
counts AS (
  SELECT 'injury_risk_7d' AS model_name, count(*) FILTER (WHERE label_is_complete = 1 AND date_day <= DATE '1999-12-31') AS n_train FROM injury_mart
  UNION ALL
  SELECT 'performance_rating', count(*) FILTER (WHERE date_day <= DATE '1999-12-31') FROM perf_mart
)
SELECT model_name, n_train, 'v' || (SELECT strftime(max(date_day), '%Y%m%d') FROM fact) || '-' || substr(md5(CAST(n_train AS VARCHAR) || '600'), 1, 6) AS model_version FROM counts"""))
def training_versions(spark, sf_dir):
    """PRJ20: the stamp of each model from the last day, its training rows and its rounds, so that new rows give a new name."""
    p = pp(spark, sf_dir)
    early = F.col(D) <= F.lit(p.p.train_end)
    counts = [p.injury_mart(["label_is_complete"]).agg(F.count(F.when(early & (F.col("label_is_complete") == 1), 1)).alias("n_train")).withColumn("model_name", F.lit("injury_risk_7d")),
              p.perf_rows([]).agg(F.count(F.when(early, 1)).alias("n_train")).withColumn("model_name", F.lit("performance_rating"))]
    rows = reduce(DataFrame.unionByName, counts).withColumn("rounds", F.lit(INJURY_RULES.rounds))
    return rows.select("model_name", "n_train", C.model_version("n_train", "rounds", f"{p.calendar.end:%Y%m%d}").alias("model_version"))
