"""Data-quality checks (2.11). Each returns the violating rows; zero rows = pass.

All checks are distributed: NULL/range/accepted filters are narrow scans,
uniqueness is a partial aggregate, relationships are anti joins, and the
interval-overlap check sweeps over sorted starts and ends, so it never
compares all pairs of one entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators.ranking import running_totals


def not_null(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """DQ1."""
    return df.where(F.col(col).isNull()).select(*keys, col)


def unique(df: DataFrame, col: str) -> DataFrame:
    """DQ2: values (non-null) that occur more than once."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def accepted(df: DataFrame, col: str, values: Sequence, keys: Sequence[str] = ()) -> DataFrame:
    """DQ3: NULL passes."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values))).select(*keys, col)


def relationship(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
                 keys: Sequence[str] = ()) -> DataFrame:
    """DQ4 / JN15: child rows whose non-null key has no parent."""
    pk = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(pk, key, "left_anti").select(*keys, key)


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ5: key combinations present more than once, with their row count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def value_between(df: DataFrame, col: str, lo: float | None = None, hi: float | None = None,
                  keys: Sequence[str] = ()) -> DataFrame:
    """DQ6: either bound optional; NULL passes."""
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (F.col(col) < F.lit(lo))
    if hi is not None:
        cond = cond | (F.col(col) > F.lit(hi))
    return df.where(F.col(col).isNotNull() & cond).select(*keys, col)


def recompute_diff(left: DataFrame, right: DataFrame | None, keys: Sequence[str], a: str, b: str,
                   tol: float = 1e-6) -> DataFrame:
    """DQ7: two derivations of one value disagree by more than ``tol``; without ``right`` the rows of ``left`` hold both already."""
    both = left if right is None else left.join(right, list(keys), "inner")
    return both.where(F.abs(F.col(a) - F.col(b)) > tol).select(*keys, a, b)


def row_parity(a: DataFrame, b: DataFrame, a_name: str = "a_rows", b_name: str = "b_rows") -> DataFrame:
    """DQ8: one row when the two counts differ (both counts are partial aggregates)."""
    ca = a.agg(F.count(F.lit(1)).alias(a_name))
    cb = b.agg(F.count(F.lit(1)).alias(b_name))
    return ca.crossJoin(cb).where(F.col(a_name) != F.col(b_name))


def overlaps(intervals: DataFrame, entity: str, id_col: str, start: str, end: str) -> DataFrame:
    """DQ9 / JN9: pairs (a, b), a.id < b.id, b starts inside a's [start, end], of one entity.

    A sweep over events: starts and ends are sorted by (entity, day, starts first, id) over all tasks, and a running count numbers the
    starts. The starts inside an interval are then the numbers after its own up to the count at its end, so an interval of any length is two
    events, one without company goes no further, and what is joined by number are the true matches alone. Numbers are spread
    by ranges, so a hot entity is shared by many tasks. An interval without a start or an end, or that ends before it starts, holds nothing.
    """
    iv = intervals.select(F.col(entity).alias("__e"), F.col(id_col).alias("__i"), F.col(start).alias("__s"), F.col(end).alias("__t")).where(F.col("__s").isNotNull() & F.col("__e").isNotNull())
    events = iv.select("__e", "__i", "__s", "__t", F.explode(F.array(F.struct(F.col("__s").alias("day"), F.lit(0).alias("late")), F.struct(F.col("__t").alias("day"), F.lit(1).alias("late")))).alias("__v"))
    events = events.select("__e", "__i", "__s", "__t", F.col("__v.day").alias("__day"), F.col("__v.late").alias("__late"), (1 - F.col("__v.late")).cast("long").alias("__n")).where(F.col("__day") >= F.col("__s"))
    swept = running_totals(events, ["__e", "__day", "__late", "__i", "__t", "__s"], ["__n"])
    own = ["__e", "__i", "__s", "__t"]
    starts = swept.where("__late = 0").select(*own, F.col("__n_cum").alias("__at"))
    # Equal intervals are one another's copies: the first of their numbers stands for all, and they have the same last one.
    first = starts.where("__t IS NOT NULL").groupBy(*own).agg(F.min("__at").alias("__first"))
    last = swept.where("__late = 1").groupBy(*own).agg(F.max("__n_cum").alias("__last"))
    reach = first.join(last, own).where("__last > __first")
    inside = reach.select(F.col("__i").alias("injury_a"), F.explode(F.sequence(F.col("__first") + 1, F.col("__last"))).alias("__at"))
    b = starts.select("__at", F.col("__e").alias(entity), F.col("__i").alias("injury_b"))
    return inside.join(b, "__at").where(F.col("injury_a") < F.col("injury_b")).select(entity, "injury_a", "injury_b").distinct()


def label_window(df: DataFrame, label: str, complete: str, day: str, last_day, horizon: int) -> DataFrame:
    """DQ10: complete labels must exist, and the last horizon-1 days are never complete."""
    cutoff = F.date_sub(F.lit(last_day), horizon - 1)
    return df.where(((F.col(complete) == 1) & F.col(label).isNull())
                    | ((F.col(complete) == 1) & (F.col(day) > cutoff)))


def contradiction(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ11: sessions other than rehab on a day the entity is unavailable."""
    return (base.where((F.col("is_unavailable") == 1) & ((F.col("sessions") - F.col("rehab_sessions")) > 0))
            .select(*keys, "sessions", "rehab_sessions"))


BANNED_NAME_PARTS = ("injury_next", "label", "future", "target")


def label_named_columns(spark: SparkSession, df: DataFrame, meta: Sequence[str],
                        banned: Sequence[str] = BANNED_NAME_PARTS) -> DataFrame:
    """DQ12: numeric non-metadata columns whose name looks like a label."""
    feats = feature_columns(df, meta)
    bad = [(c,) for c in feats if any(b in c for b in banned)]
    return spark.createDataFrame(bad, T.StructType([T.StructField("column_name", T.StringType())]))


def feature_columns(df: DataFrame, meta: Sequence[str]) -> list[str]:
    """PRJ18: every numeric column that is not metadata."""
    return [f.name for f in df.schema.fields
            if f.name not in meta and isinstance(f.dataType, T.NumericType)]


def split_spans(df: DataFrame, split: str, day: str) -> DataFrame:
    """AGG20: first and last day per split."""
    return df.groupBy(split).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def split_order(df: DataFrame, split: str, day: str, order: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """DQ13: consecutive splits whose day ranges touch or overlap."""
    spans = split_spans(df, split, day)
    pairs = list(zip(order[:-1], order[1:]))
    lk = spans.select(F.col(split).alias("earlier"), F.col("last_day").alias("earlier_last"))
    rk = spans.select(F.col(split).alias("later"), F.col("first_day").alias("later_first"))
    pair_df = df.sparkSession.createDataFrame(pairs, "earlier string, later string")
    return (pair_df.join(lk, "earlier").join(rk, "later")
            .where(F.col("earlier_last") >= F.col("later_first"))
            .select("earlier", "later", "earlier_last", "later_first"))


def score_range(scores: DataFrame, features: DataFrame, score: str) -> DataFrame:
    """DQ14: out-of-range scores and a count mismatch, as one report row when failing."""
    s = scores.agg(F.count(F.lit(1)).alias("n_scores"),
                   F.sum(F.when((F.col(score) < 0) | (F.col(score) > 1) | F.col(score).isNull(), 1)
                         .otherwise(0)).cast("long").alias("n_out_of_range"))
    f = features.agg(F.count(F.lit(1)).alias("n_features"))
    return s.crossJoin(f).where((F.col("n_out_of_range") > 0) | (F.col("n_scores") != F.col("n_features")))


def step_capped(recs: DataFrame, gaps: DataFrame, catalog: DataFrame, entity: str = "entity_id",
                tol: float = 1e-6) -> DataFrame:
    """DQ15: an additive step larger than the entity's shortfall on the lever's metric."""
    j = (recs.join(catalog.select("lever_id", "metric", "step_type"), "lever_id")
         .join(gaps.select(entity, "metric", "shortfall"), [entity, "metric"]))
    return (j.where((F.col("step_type") == "add") & (F.abs("recommended_step") > F.col("shortfall") + tol))
            .select(entity, "lever_id", "recommended_step", "shortfall"))


def run_checks(named: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """DQ16: (check, table, violations, status) for a list of checks, severity error."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations"))
             .select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "violations")
             for check, table, df in named]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise("error"))


def freshness(df: DataFrame, table: str, loaded_col: str, as_of, warn_hours: float | None = 36.0,
              error_hours: float | None = 72.0) -> DataFrame:
    """SRC6: hours since the newest load vs warn / error thresholds (None = opted out)."""
    # Zone-free microsecond difference: no session time zone or DST shift enters.
    age = F.timestamp_diff("MICROSECOND", F.max(F.col(loaded_col)).cast("timestamp_ntz"),
                           F.lit(as_of).cast("timestamp_ntz")) / F.lit(3.6e9)
    status = F.lit("pass")
    if error_hours is not None or warn_hours is not None:
        status = F.when(F.lit(error_hours is not None) & (F.col("age_hours") > F.lit(error_hours or 0.0)), "error") \
                  .when(F.lit(warn_hours is not None) & (F.col("age_hours") > F.lit(warn_hours or 0.0)), "warn") \
                  .otherwise("pass")
    return (df.agg(F.max(F.col(loaded_col)).cast("timestamp_ntz").alias("max_loaded_at"), age.alias("age_hours"))
            .select(F.lit(table).alias("table_name"), "max_loaded_at", "age_hours")
            .withColumn("status", status))


def manifest(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """SNK4: rows per table plus a total row."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    total = out.agg(F.sum("n_rows").cast("long").alias("n_rows")).select(F.lit("TOTAL").alias("table_name"), "n_rows")
    return out.unionByName(total)
