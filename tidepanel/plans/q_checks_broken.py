"""Checks over derivations of the given tables that are wrong on purpose (each must report rows), and estimate agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import checks as Q
from tidepanel.plans.catalog import register
from tidepanel.plans.oracle import FEATURE_CTES, with_ctes
from tidepanel.plans.q_panel import pp
from tidepanel.sources.tables import read_table


@register("dq_recompute_broken", """
SELECT o_orderkey, o_totalprice AS paid, floor(o_totalprice) AS recomputed FROM orders
WHERE abs(o_totalprice - floor(o_totalprice)) > 1e-6""")
def dq_recompute_broken(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    paid = orders.select("o_orderkey", F.col("o_totalprice").alias("paid"))
    again = orders.select("o_orderkey", F.floor("o_totalprice").cast("double").alias("recomputed"))
    return Q.recompute_diff(paid, again, ["o_orderkey"], "paid", "recomputed")


@register("dq_row_parity_broken", """
SELECT * FROM (SELECT count(*) AS spine_rows FROM orders) CROSS JOIN (SELECT count(*) AS fact_rows FROM orders WHERE o_orderstatus <> 'F')
WHERE spine_rows <> fact_rows""")
def dq_row_parity_broken(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return Q.row_parity(orders, orders.where("o_orderstatus <> 'F'"), "spine_rows", "fact_rows")


@register("dq_label_window_broken", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 1 END AS label, 1 AS complete FROM orders
WHERE o_orderstatus = 'F' OR CAST(o_orderdate AS DATE) > DATE '1998-08-02' - 6""")
def dq_label_window_broken(spark, sf_dir):
    """Labels missing although complete, and days complete too late."""
    rows = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), F.when(F.col("o_orderstatus") != "F", 1).alias("label"), F.lit(1).alias("complete"))
    return Q.label_window(rows, "label", "complete", "day", F.lit("1998-08-02").cast("date"), 7)


@register("dq_score_range_broken", """
SELECT count(*) AS n_scores, CAST(sum(CASE WHEN p_size / 25.0 - 0.5 < 0 OR p_size / 25.0 - 0.5 > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_out_of_range,
       (SELECT count(*) FROM part WHERE p_size > 3) AS n_features FROM part""")
def dq_score_range_broken(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return Q.score_range(part.select((F.col("p_size") / 25.0 - 0.5).alias("score")), part.where("p_size > 3"), "score")


@register("dq_step_capped_broken", """
SELECT s_suppkey AS entity_id, 'sleep' AS lever_id, s_acctbal / 1000.0 AS recommended_step, CAST(1.5 AS DOUBLE) AS shortfall FROM supplier
WHERE abs(s_acctbal / 1000.0) > 1.5 + 1e-6""", doubles=["recommended_step"])
def dq_step_capped_broken(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "entity_id")
    recs = s.select("entity_id", F.lit("sleep").alias("lever_id"), (F.col("s_acctbal") / 1000.0).alias("recommended_step"))
    gaps = s.select("entity_id", F.lit("hours").alias("metric"), F.lit(1.5).cast("double").alias("shortfall"))
    catalog = spark.createDataFrame([("sleep", "hours", "add")], "lever_id string, metric string, step_type string")
    return Q.step_capped(recs, gaps, catalog)


@register("dq_split_order_broken", """
WITH s AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
r AS (SELECT k, min(d) AS a, max(d) AS b FROM s GROUP BY 1)
SELECT x.k AS earlier, y.k AS later, x.b AS earlier_last, y.a AS later_first FROM r x JOIN r y ON (x.k, y.k) IN (('train', 'val'), ('val', 'test'))
WHERE x.b >= y.a""")
def dq_split_order_broken(spark, sf_dir):
    """DQ13 on splits by key instead of by day."""
    k = F.col("o_orderkey") % 3
    rows = read_table(spark, sf_dir, "orders").select(F.when(k == 0, "train").when(k == 1, "val").otherwise("test").alias("data_split"), F.col("o_orderdate").cast("date").alias("day"))
    return Q.split_order(rows, "data_split", "day")


@register("dq_split_order_violations", with_ctes(FEATURE_CTES, """
SELECT x.s AS earlier, y.s AS later, x.b AS earlier_last, y.a AS later_first FROM (
  SELECT 'train' AS s, max(date_day) AS b FROM fact WHERE date_day <= DATE '1999-12-31' AND has_full_history = 1 AND is_unavailable = 0) x
CROSS JOIN (SELECT 'val' AS s, min(date_day) AS a FROM fact WHERE date_day > DATE '1999-12-31' AND date_day <= DATE '2000-06-30' AND has_full_history = 1 AND is_unavailable = 0) y
WHERE x.b >= y.a"""))
def dq_split_order_violations(spark, sf_dir):
    """DQ13 on the real splits: none may touch."""
    from tidepanel.functions.columns import add_split

    p = pp(spark, sf_dir)
    return Q.split_order(p.injury_mart(["is_unavailable"]).withColumn("data_split", add_split("date_day", p.p.train_end, p.p.val_end)), "data_split", "date_day")


@register("dq_label_names_broken", with_ctes(FEATURE_CTES, """
SELECT 'injury_next_7d' AS column_name, count(injury_next_7d) AS n_values FROM fact
UNION ALL SELECT 'label_is_complete', count(label_is_complete) FROM fact"""))
def dq_label_names_broken(spark, sf_dir):
    """DQ12 on the fact with its labels left among the features: what they hold."""
    fact = pp(spark, sf_dir).fact_of(["acwr", "injury_next_7d", "label_is_complete"])
    named = [r.column_name for r in Q.label_named_columns(spark, fact, ["entity_id", "date_day"]).collect()]  # column names
    return fact.agg(*[F.count(c).alias(c) for c in named]).unpivot([], named, "column_name", "n_values")


_RANKS = """(SELECT *, rank() OVER (PARTITION BY {by} ORDER BY e) + (count(*) OVER (PARTITION BY {by}, e) - 1) / 2.0 AS re,
                rank() OVER (PARTITION BY {by} ORDER BY f) + (count(*) OVER (PARTITION BY {by}, f) - 1) / 2.0 AS rf FROM s)"""
_SPEARMAN = "CASE WHEN stddev_pop(re) > 0 AND stddev_pop(rf) > 0 THEN covar_pop(re, rf) / (stddev_pop(re) * stddev_pop(rf)) END"
_AGREE = ["mean_estimate", "mean_reference", "sign_agreement", "constant_guess", "pooled_spearman", "median_entity_spearman"]


@register("estimate_agreement", f"""
WITH s AS (SELECT l_suppkey AS k, l_returnflag AS c, round((l_discount - 0.05) * 1e9) / 1e9 AS e, round((l_tax - 0.03) * 1e9) / 1e9 AS f FROM lineitem),
a AS (SELECT c, count(*) AS n_rows, avg(e) AS mean_estimate, avg(f) AS mean_reference,
             avg(CASE WHEN abs(f) > 0.01 THEN CASE WHEN sign(e) = sign(f) THEN 1.0 ELSE 0.0 END END) AS sign_agreement,
             greatest(avg(CASE WHEN abs(f) > 0.01 THEN CASE WHEN f > 0 THEN 1.0 ELSE 0.0 END END),
                      avg(CASE WHEN abs(f) > 0.01 THEN CASE WHEN f < 0 THEN 1.0 ELSE 0.0 END END)) AS constant_guess FROM s GROUP BY 1),
p AS (SELECT c, {_SPEARMAN} AS pooled_spearman FROM {_RANKS.format(by="c")} GROUP BY 1),
q AS (SELECT c, k, {_SPEARMAN} AS x FROM {_RANKS.format(by="c, k")} GROUP BY 1, 2),
m AS (SELECT c, percentile_cont(0.5) WITHIN GROUP (ORDER BY x) AS median_entity_spearman FROM q WHERE x IS NOT NULL GROUP BY 1)
SELECT a.c AS category, n_rows, mean_estimate, mean_reference, sign_agreement, constant_guess, pooled_spearman, median_entity_spearman
FROM a LEFT JOIN p ON p.c = a.c LEFT JOIN m ON m.c = a.c""", doubles=_AGREE)
def estimate_agreement_q(spark, sf_dir):
    """VAL1-2 over two derived effects of the line items: category is the return flag, entity the supplier."""
    from tidepanel.operators.evaluate import estimate_agreement

    tidy = lambda c, m: F.round((F.col(c) - m) * 1e9) / 1e9
    rows = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("entity"), F.col("l_returnflag").alias("category"), tidy("l_discount", 0.05).alias("est"), tidy("l_tax", 0.03).alias("ref"))
    return estimate_agreement(rows, "entity", "category", "est", "ref")
