"""Registered queries backed by the trained boosters (no SQL oracle: iterative training).

Plus ``metric_pivot`` (SET5 / ML17), which pivots the long metric table of the
rule-based models and therefore has an oracle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import columns as C
from tidepanel.operators import boost as B
from tidepanel.operators import evaluate as EV
from tidepanel.operators import learn as LN
from tidepanel.plans.catalog import register
from tidepanel.plans.oracle import with_ctes
from tidepanel.plans.pipeline import ML_FEATURES, PanelPipeline
from tidepanel.plans.q_model import MODEL_CTES, mm, regression_rows, scored_table
from tidepanel.plans.q_panel import pp
from tidepanel.session import cut_lineage

E, D = "entity_id", "date_day"
GROUPS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
FEATURES = [*ML_FEATURES, *[f"group_{g}" for g in GROUPS]]
# Booster settings and monotone features of the two models (+1: the prediction must not fall as the feature grows; -1: must not rise).
INJURY_RULES = B.Rules(classify=True, rounds=600, rate=0.05, depth=5, leaves=24, min_leaf=150, l2=2.0)
RATING_RULES = B.Rules(classify=False, rounds=600, rate=0.04, depth=3, leaves=8, min_leaf=40, l2=3.0)
MONOTONE_INJURY = {"sleep_hours_3d": -1, "sleep_hours_7d": -1, "sleep_hours_28d": -1, "protein_gpkg_7d": -1, "nordic_n": -1, "hrv_z": -1}
MONOTONE_RATING = {"sleep_hours_3d": 1, "sleep_hours_7d": 1, "protein_gpkg_7d": 1, "carbs_gpkg_3d": 1, "carbs_gpkg_7d": 1, "hydration_l_3d": 1, "hydration_l_7d": 1,
                   "yoyo_ir1_m": 1, "cmj_cm": 1, "squat_1rm_rel": 1, "sprint_30m_s": -1, "hrv_z": 1, "rating_avg_5m": 1}
BASELINE_COLS = ["acwr", "prior_injuries", "age_years", "sleep_hours_7d", "protein_gpkg_7d", "nordic_n", "hrv_z"]
TOP_FRACTIONS = [0.05, 0.10]


@dataclass
class Trained:
    model: B.Booster
    platt_a: float
    platt_b: float
    train: DataFrame
    test: DataFrame


def _split(df: DataFrame, p: PanelPipeline) -> DataFrame:
    return df.withColumn("data_split", C.add_split(D, p.p.train_end, p.p.val_end))


def design(df: DataFrame) -> DataFrame:
    """Features as doubles, null where missing, and the one-hot group; the other columns stay."""
    keep = [c for c in df.columns if c not in ML_FEATURES]
    onehot = [F.coalesce((F.col("position_group") == F.lit(g)).cast("double"), F.lit(0.0)).alias(f"group_{g}") for g in GROUPS]
    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in ML_FEATURES], *onehot)


def injury_model(p: PanelPipeline) -> Trained:
    cache = p.__dict__.setdefault("_models", {})
    if "injury" not in cache:
        lab = cut_lineage(design(_split(p.injury_mart().where(F.col("label_is_complete") == 1), p)).withColumn("label", F.col("injury_next_7d").cast("double")))
        tr, va, te = (lab.where(F.col("data_split") == s) for s in ("train", "val", "test"))
        model = B.fit(tr, va, FEATURES, "label", INJURY_RULES, MONOTONE_INJURY)
        a, b = LN.fit_platt(B.predict(va, model, ["label"], "raw_p"), "label")
        cache["injury"] = Trained(model, a, b, tr, te)
    return cache["injury"]


def rating_model(p: PanelPipeline) -> Trained:
    cache = p.__dict__.setdefault("_models", {})
    if "rating" not in cache:
        mart = cut_lineage(design(_split(p.perf_rows(), p)).withColumn("label", F.col("performance_rating").cast("double")))
        tr, va, te = (mart.where(F.col("data_split") == s) for s in ("train", "val", "test"))
        cache["rating"] = Trained(B.fit(tr, va, FEATURES, "label", RATING_RULES, MONOTONE_RATING), 0.0, 1.0, tr, te)
    return cache["rating"]


def gbt_score_frame(p: PanelPipeline) -> DataFrame:
    """ML7 with the trained booster: calibrated probability for every available entity-day."""
    t = injury_model(p)
    split = F.when(F.col("label_is_complete") == 1, F.col("data_split")).otherwise("scoring_only")
    x = design(_split(p.injury_mart(), p).withColumn("data_split", split))
    s = B.predict(x, t.model, [E, D, "data_split", "label_is_complete", "injury_next_7d"], "raw_p")
    return s.withColumn("injury_risk_7d", LN.platt(F.col("raw_p"), t.platt_a, t.platt_b))


def model_version(p: PanelPipeline) -> str:
    """PRJ20: the last day of the panel and the shape of both models, so a retrained model has a new name."""
    i, r = injury_model(p), rating_model(p)
    return f"v{p.calendar.end.strftime('%Y%m%d')}-i{i.model.rounds}-r{r.model.rounds}"


@register("gbt_scores", note="trained booster and Platt calibration; rows-only check")
def gbt_scores(spark, sf_dir):
    s = gbt_score_frame(pp(spark, sf_dir))
    return s.select(E, D, "injury_risk_7d", C.risk_band("injury_risk_7d").alias("risk_band"), "data_split")


@register("platt_scores", note="calibration fitted on the validation split; rows-only check")
def platt_scores(spark, sf_dir):
    p = pp(spark, sf_dir)
    t = injury_model(p)
    s = gbt_score_frame(p)
    return s.select(E, D, "raw_p", "injury_risk_7d", F.lit(t.platt_a).alias("platt_intercept"),
                    F.lit(t.platt_b).alias("platt_slope"))


@register("rating_gbt_predictions", note="trained booster; rows-only check")
def rating_gbt_predictions(spark, sf_dir):
    p = pp(spark, sf_dir)
    return B.predict(design(_split(p.injury_mart(), p)), rating_model(p).model, [E, D, "data_split"], "predicted_rating").select(E, D, "predicted_rating", "data_split")


@register("permutation_importance", note="injury model, loss of AUC over the whole test split; rows-only check")
def permutation_importance(spark, sf_dir):
    t = injury_model(pp(spark, sf_dir))
    return B.permutation_importance(t.model, t.test, "label", repeats=3)


@register("permutation_importance_rating", note="rating model, loss of MAE over the whole test split; rows-only check")
def permutation_importance_rating(spark, sf_dir):
    t = rating_model(pp(spark, sf_dir))
    return B.permutation_importance(t.model, t.test, "label", repeats=5)


@register("staged_losses", note="ML5: validation loss of every round and the rounds kept; rows-only check")
def staged_losses(spark, sf_dir):
    p = pp(spark, sf_dir)
    rows = [(name, i + 1, loss, i + 1 == t.model.rounds) for name, t in (("injury_risk_7d", injury_model(p)), ("performance_rating", rating_model(p))) for i, loss in enumerate(t.model.losses)]
    return spark.createDataFrame(rows, "model_name string, round int, validation_loss double, kept boolean")


def _long(wide: DataFrame, model: str) -> DataFrame:
    return wide.unpivot([], wide.columns, "metric", "value").select(F.lit(model).alias("model_name"), "metric", F.col("value").cast("double").alias("value"))


def injury_metrics(p: PanelPipeline) -> DataFrame:
    """(model_name, metric, value): AUC, average precision, Brier, top fractions, and the two baselines on the same test rows."""
    t, y = injury_model(p), "label"
    te = B.predict(t.test, t.model, [E, D, "label", "acwr"], "raw_p").withColumn("p", LN.platt(F.col("raw_p"), t.platt_a, t.platt_b))
    base = LN.baseline_logistic(t.train, BASELINE_COLS, y)
    bt = base.transform(t.test.select(*BASELINE_COLS, y)).withColumn("bp", vector_to_array("__bprob")[1])
    parts = [EV.roc_auc(te, y, "p").select("roc_auc"),
             EV.average_precision(te, y, "p").select(F.col("average_precision").alias("pr_auc")),
             EV.brier(te, y, "p").select("brier", "base_rate"),
             EV.roc_auc(te.withColumn("a", F.coalesce("acwr", F.lit(1.0))), y, "a").select(F.col("roc_auc").alias("baseline_acwr_only_roc_auc")),
             EV.roc_auc(bt, y, "bp").select(F.col("roc_auc").alias("baseline_logistic_roc_auc")),
             EV.average_precision(bt, y, "bp").select(F.col("average_precision").alias("baseline_logistic_pr_auc"))]
    top = EV.top_fraction(te, y, "p", TOP_FRACTIONS, [E, D]).unpivot(["top_pct"], ["precision", "lift", "recall"], "metric", "value")
    top = top.select(F.concat("metric", F.lit("_top"), F.col("top_pct").cast("string"), F.lit("pct")).alias("metric"), F.col("value").cast("double").alias("value"))
    return _long(reduce(DataFrame.crossJoin, parts), "injury_risk_7d").unionByName(top.select(F.lit("injury_risk_7d").alias("model_name"), "metric", "value"))  # one row each


def rating_metrics(p: PanelPipeline) -> DataFrame:
    """(model_name, metric, value): errors of the model and of its mean, form and ridge baselines on the same test rows."""
    t, y = rating_model(p), "label"
    row = t.train.agg(F.avg(y).alias("mean"), F.avg("rating_avg_5m").alias("form")).first()
    ridge = LN.baseline_ridge(t.train, FEATURES, y)
    te = B.predict(t.test, t.model, [y, "rating_avg_5m"], "prediction")
    te = te.withColumn("mean", F.lit(row["mean"])).withColumn("form", F.coalesce("rating_avg_5m", F.lit(row["form"])))
    rt = ridge.transform(t.test.select(*FEATURES, y))
    pick = lambda df, col, names: EV.regression_metrics(df, y, col).select(*[F.col(c).alias(n) for c, n in names.items()])
    return _long(reduce(DataFrame.crossJoin, [  # one row each
        pick(te, "prediction", {c: c for c in ("mae", "rmse", "r2", "rating_sd")}), pick(te, "mean", {"mae": "baseline_mean_mae"}),
        pick(te, "form", {"mae": "baseline_form_mae", "r2": "baseline_form_r2"}), pick(rt, "__bpred", {"mae": "baseline_ridge_mae", "r2": "baseline_ridge_r2"})]), "performance_rating")


@register("model_metrics_gbt", note="ML17: test-split metrics of the trained models and their baselines; rows-only check")
def model_metrics_gbt(spark, sf_dir):
    p = pp(spark, sf_dir)
    out = injury_metrics(p).unionByName(rating_metrics(p))
    rounds = F.when(F.col("model_name") == "injury_risk_7d", injury_model(p).model.rounds).otherwise(rating_model(p).model.rounds)
    return out.withColumn("model_version", F.lit(model_version(p))).withColumn("data_split", F.lit("test")).withColumn("best_iter", rounds.cast("long")) \
        .withColumn("trained_at", F.date_trunc("second", F.current_timestamp()))


# ----------------------------------------------------------------------------- SET5 on the rule models (oracle)
def rule_metric_long(spark, sf_dir) -> DataFrame:
    s = scored_table(spark, sf_dir)
    m = mm(spark, sf_dir)
    inj = (EV.roc_auc(s, "y", "p").select("roc_auc")
           .crossJoin(EV.average_precision(s, "y", "p").select(F.col("average_precision").alias("pr_auc")))
           .crossJoin(EV.brier(s, "y", "p").select("brier", "base_rate")))
    j = regression_rows(m)
    reg = EV.regression_metrics(j, "y", "yhat").select("mae", "rmse", "r2")
    a = inj.unpivot([], inj.columns, "metric", "value").withColumn("model_name", F.lit("injury_rule"))
    b = reg.unpivot([], reg.columns, "metric", "value").withColumn("model_name", F.lit("rating_rule"))
    return a.unionByName(b)


PIVOT_METRICS = ["roc_auc", "pr_auc", "brier", "base_rate", "mae", "rmse", "r2"]


@register("metric_pivot", with_ctes(MODEL_CTES, """
SELECT 'injury_rule' AS model_name, a.roc_auc, b.pr_auc, c.brier, c.base_rate,
       CAST(NULL AS DOUBLE) AS mae, CAST(NULL AS DOUBLE) AS rmse, CAST(NULL AS DOUBLE) AS r2
FROM (SELECT (rsum - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg) AS roc_auc FROM (
        SELECT sum(CASE WHEN y = 1 THEN r END) AS rsum, sum(y) AS n_pos, count(*) - sum(y) AS n_neg
        FROM (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM scored_test))) a,
     (SELECT sum(pos / P * tp / (tp + fp)) AS pr_auc FROM (
        SELECT pos, sum(pos) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS fp, sum(pos) OVER () AS P
        FROM (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM scored_test GROUP BY p))) b,
     (SELECT avg((p - y) * (p - y)) AS brier, avg(CAST(y AS DOUBLE)) AS base_rate FROM scored_test) c
UNION ALL
SELECT 'rating_rule', NULL, NULL, NULL, NULL, avg(abs(y - yhat)), sqrt(avg((y - yhat) * (y - yhat))),
       1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))
FROM (SELECT m.performance_rating AS y, r.predicted_rating AS yhat
      FROM perf_mart m JOIN rating_predictions r USING (entity_id, date_day))"""), doubles=PIVOT_METRICS)
def metric_pivot(spark, sf_dir):
    long = rule_metric_long(spark, sf_dir)
    return long.groupBy("model_name").pivot("metric", PIVOT_METRICS).agg(F.first("value"))
