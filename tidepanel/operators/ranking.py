"""Exact ranks and percentiles without funnelling a group into one task.

A plain ``Window.partitionBy(g).orderBy(v)`` sends every row of a group to
one task; with one group holding a third of the data (or a global ranking
with no group at all) that task is the whole job. Here the rows are range
partitioned on (group, value) across all tasks, each task numbers its sorted
slice, and a tiny table of per-(slice, group) counts turns local positions
into global ranks: a two-level prefix sum.

The numbered frame is checkpointed (reliable, in ``spark.checkpoint.dir``) so
the ids that carry the slice positions are fixed before they are reused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import cut_lineage

_PID_SHIFT = 33  # monotonically_increasing_id = partition index << 33 | row position


def _ascending(df: DataFrame, order: Sequence[str], descending: bool) -> tuple[DataFrame, list[str], list[str]]:
    """The frame, the columns to sort it by, and those of them that were added. Ascending keys are the columns themselves: a second copy would go
    through the shuffle and into the written table."""
    order = list(order)
    if not descending:
        return df, order, []
    added = {f"__k{i}": -F.col(c) for i, c in enumerate(order)}
    return df.withColumns(added), list(added), list(added)


def exact_row_number(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "rank",
                     descending: bool = False) -> DataFrame:
    """1-based row number within ``by`` ordered by ``order`` (ties in input order).

    ``descending`` negates numeric order keys, so the range partitioner and
    the sort agree without a custom ordering.
    """
    by = list(by)
    keyed, order, sort_cols = _ascending(df, order, descending)
    keys = [*by, *order]
    # No explicit count: the session's shuffle partitions apply and AQE may merge adjacent ranges, which keeps
    # slice order (and so the offsets) intact while small inputs do not pay for hundreds of empty slices.
    ranged = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = cut_lineage(ranged.withColumn("__mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("__mid"), _PID_SHIFT)
    stats = (numbered.groupBy(pid.alias("__pid"), *by)
             .agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__n")))
    before = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    # One row per (slice, group). AQE broadcasts it when the runtime size is
    # small; with millions of groups it is shuffle-joined on (slice, group),
    # which still spreads a hot group over all of its slices.
    stats = stats.select("__pid", *by, "__first", "__offset")
    out = numbered.withColumn("__pid", pid).join(stats, ["__pid", *by], "inner")
    return (out.withColumn(name, (F.col("__offset") + F.col("__mid") - F.col("__first") + 1).cast("long"))
            .drop("__pid", "__first", "__offset", "__mid", *sort_cols))


def value_cells(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row per (group, distinct value): ``__n`` rows, ranks ``__first`` to ``__last`` of them, ``__size`` of the group.

    Rows are counted before anything is sorted, so a value that most rows share is one row per task from the
    start, and only distinct values are range partitioned and numbered.
    """
    by = list(by)
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    run = running_totals(counts, [*by, value], ["__n"], suffix="_cum")
    group = run.groupBy(*by).agg(F.min(F.col("__n_cum") - F.col("__n")).alias("__off"), F.sum("__n").alias("__size"))
    both = run.join(group, by, "inner") if by else run.crossJoin(group)  # without groups it is one row
    return both.select(*by, value, "__n", (F.col("__n_cum") - F.col("__n") - F.col("__off") + 1).alias("__first"), (F.col("__n_cum") - F.col("__off")).alias("__last"), "__size")


def percentile_cont(df: DataFrame, by: Sequence[str], value: str, ps: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact ``percentile_cont`` per group (linear interpolation, NULLs ignored).

    Returns one row per group that has at least one non-null value, with one
    column per requested fraction.
    """
    by = list(by)
    names = list(names or [f"p{int(round(p * 100))}" for p in ps])
    cells = value_cells(df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v")), by, "__v")

    def at(rank):
        return F.max(F.when((F.col("__first") <= rank) & (rank <= F.col("__last")), F.col("__v")))
    parts = []
    for i, p in enumerate(ps):
        place = F.lit(float(p)) * (F.col("__size") - 1)
        parts += [at(F.floor(place) + 1).alias(f"__lo{i}"), at(F.ceil(place) + 1).alias(f"__hi{i}"), F.max(place - F.floor(place)).alias(f"__fr{i}")]
    found = cells.groupBy(*by).agg(*parts)
    return found.select(*by, *[(F.col(f"__lo{i}") + F.col(f"__fr{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))).alias(nm) for i, nm in enumerate(names)])


def _with_cells(df: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their value's cell. The cells are unique on the keys, so a hot value is skewed on the row side only,
    which AQE splits."""
    return df.join(cells, list(keys), "inner")


def percent_rank_exact(df: DataFrame, by: Sequence[str], value: str, name: str = "pct_rank") -> DataFrame:
    """``percent_rank()`` = (rank - 1) / (n - 1), 0 for single-row groups; ties share the lowest rank.

    Rows with a NULL ``value`` are ranked first, as in an ascending window.
    """
    by = list(by)
    # NULL sorts first in Spark, as in the window; a struct keeps it apart from any value in the join.
    keyed = df.withColumn("__v", F.struct(F.col(value).isNotNull().cast("int").alias("has"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("v")))
    cells = value_cells(keyed.select(*by, "__v"), by, "__v").select(*by, "__v", "__first", "__size")
    out = _with_cells(keyed, cells, [*by, "__v"])
    pr = F.when(F.col("__size") > 1, (F.col("__first") - 1) / (F.col("__size") - 1)).otherwise(F.lit(0.0))
    return out.withColumn(name, pr.cast("double")).drop("__v", "__first", "__size")


def average_rank(df: DataFrame, by: Sequence[str], value: str, name: str = "avg_rank") -> DataFrame:
    """WIN27: rank with ties averaged, (first + last) / 2, as Spearman needs. Rows with a NULL ``value`` drop out."""
    by = list(by)
    cells = value_cells(df.select(*by, value), by, value)
    return _with_cells(df, cells.select(*by, value, ((F.col("__first") + F.col("__last")) / 2.0).alias(name)), [*by, value])


def running_totals(df: DataFrame, order: Sequence[str], cols: Sequence[str], descending: bool = False,
                   suffix: str = "_cum") -> DataFrame:
    """Global inclusive running sums of ``cols`` in ``order`` (rows should be unique on ``order``).

    Two-level prefix sum: per-slice totals (one row per range partition, so
    the broadcast is bounded by the partition count) give each slice its
    offset; inside a slice a window over the slice id adds the local part.
    """
    cols = list(cols)
    keyed, order, sort_cols = _ascending(df, order, descending)
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = cut_lineage(ranged.withColumn("__mid", F.monotonically_increasing_id())
                           .withColumn("__pid", F.shiftright(F.col("__mid"), _PID_SHIFT)))
    totals = numbered.groupBy("__pid").agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}")
                                       for c in cols])
    local = Window.partitionBy("__pid").orderBy("__mid").rowsBetween(Window.unboundedPreceding, 0)
    out = numbered.join(F.broadcast(offsets), "__pid", "inner")
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", F.col(f"__o_{c}") + F.sum(c).over(local))
    return out.drop("__mid", "__pid", *[f"__o_{c}" for c in cols], *sort_cols)
