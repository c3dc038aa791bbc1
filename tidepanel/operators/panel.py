"""Dense entity x day panel (SRC5, JN3, JN5, JN6, JN8, FCT1, FCT6).

Scale notes
-----------
* The spine is generated, not joined: ``explode(sequence(start, end))`` per
  entity replaces the theta join ``calendar.day >= entity.signed``.
* Intervals are exploded to days and de-duplicated by an aggregate; no range
  join and no Cartesian product.
* ``assemble`` stacks the spine and every feed (each already unique per
  (entity, day)) and aggregates once after ``repartition(entity)``. A hot
  entity therefore contributes at most ``feeds x days`` rows to its task no
  matter how many raw rows it had, and the later entity window reuses the
  same partitioning (one Exchange for assembly + all windows).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ENTITY, DAY = "entity_id", "date_day"

# A broadcast side must be provably small: rows are counted before the hint.
BROADCAST_MAX_ROWS = 2_000_000


@dataclass(frozen=True)
class Calendar:
    start: dt.date
    end: dt.date

    @property
    def n_days(self) -> int:
        return (self.end - self.start).days + 1

    def start_lit(self) -> Column:
        return F.lit(self.start)

    def end_lit(self) -> Column:
        return F.lit(self.end)


def calendar_bounds(df: DataFrame, day: str | Column) -> Calendar:
    """Span of a day column: one global partial aggregate, one row to the driver."""
    d = F.to_date(F.col(day) if isinstance(day, str) else day)
    row = df.agg(F.min(d).alias("s"), F.max(d).alias("e")).first()
    if row is None or row["s"] is None:
        raise ValueError("empty calendar: no dates in input")
    return Calendar(row["s"], row["e"])


def calendar_series(spark: SparkSession, cal: Calendar, name: str = DAY) -> DataFrame:
    """SRC5: one row per day, both ends inclusive."""
    return spark.range(1).select(F.explode(F.sequence(cal.start_lit(), cal.end_lit(),
                                                      F.expr("INTERVAL 1 DAY"))).alias(name))


def entity_spans(entities: DataFrame, cal: Calendar, start_col: str | None = None,
                 entity: str = ENTITY, keep: Sequence[str] = ()) -> DataFrame:
    """JN5 before its days are listed: one row per entity with ``__first``, the first day of its spine."""
    first = F.lit(cal.start) if start_col is None else F.greatest(F.col(start_col), F.lit(cal.start))
    return entities.select(entity, *keep, first.alias("__first")).where(F.col("__first") <= F.lit(cal.end))


def dense_spine(entities: DataFrame, cal: Calendar, start_col: str | None = None,
                entity: str = ENTITY, keep: Sequence[str] = ()) -> DataFrame:
    """JN5: every calendar day from max(entity start, calendar start) to the end.

    ``day_index`` is ``datediff + 1`` on the dense grid, so no window is needed
    for it (WIN17 without a shuffle).
    """
    return (entity_spans(entities, cal, start_col, entity, keep)
            .select(entity, *keep, "__first",
                    F.explode(F.sequence(F.col("__first"), F.lit(cal.end), F.expr("INTERVAL 1 DAY"))).alias(DAY))
            .select(entity, *keep, DAY, (F.datediff(F.col(DAY), F.col("__first")) + 1).cast("long").alias("day_index")))


def grid(keys: DataFrame, cal: Calendar) -> DataFrame:
    """JN6: key x calendar without a join."""
    return keys.select(*keys.columns, F.explode(F.sequence(F.lit(cal.start), F.lit(cal.end),
                                                           F.expr("INTERVAL 1 DAY"))).alias(DAY))


def interval_days(intervals: DataFrame, start: str, end: str, entity: str = ENTITY,
                  flag: str = "is_unavailable") -> DataFrame:
    """JN8: (entity, day) covered by any interval; overlaps collapse to one row."""
    days = intervals.select(entity, F.explode(F.sequence(F.col(start), F.col(end),
                                                         F.expr("INTERVAL 1 DAY"))).alias(DAY))
    return days.groupBy(entity, DAY).agg(F.lit(1).alias(flag))


def interval_days_between(spine: DataFrame, intervals: DataFrame, start: str, end: str,
                          entity: str = ENTITY, flag: str = "is_unavailable") -> DataFrame:
    """JN8 reference form: equi key + ``day between start and end``, then distinct."""
    s, i = spine.alias("s"), intervals.alias("i")
    cond = (F.col(f"s.{entity}") == F.col(f"i.{entity}")) & F.col(f"s.{DAY}").between(F.col(f"i.{start}"), F.col(f"i.{end}"))
    return (s.join(i, cond, "inner").select(F.col(f"s.{entity}").alias(entity), F.col(f"s.{DAY}").alias(DAY))
            .distinct().withColumn(flag, F.lit(1)))


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast only after counting; above the bound the caller's join shuffles."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def assemble(spine: DataFrame, feeds: Sequence[tuple[DataFrame, Mapping[str, str]]],
             entity: str = ENTITY, zero_fill: Sequence[str] = (), spine_cols: Sequence[str] = ("day_index",),
             on_spine_only: bool = True, cal: Calendar | None = None, tasks: int | None = None) -> DataFrame:
    """JN3 + FLT6 as one union-aggregate.

    ``feeds`` are (frame unique on (entity, day), {output column: source
    column}). Columns in ``zero_fill`` become 0 where no feed row exists
    (absence = none), everything else stays NULL (absence = not recorded).
    Feed rows off the spine are dropped, as the left joins of the reference
    would drop them.

    With ``cal`` the spine comes as ``entity_spans``: one row per entity is shuffled and its days are listed after that,
    each with its ``day_index``. ``tasks`` says into how many tasks the entities are dealt; without it Spark judges by the bytes shuffled,
    which don't show the days to be listed.
    """
    if cal is None:
        parts = [spine.select(entity, DAY, *spine_cols, F.lit(1).alias("__on_spine"))]
    else:
        parts = [spine.select(entity, *[c for c in spine_cols if c != "day_index"], "__first", F.lit(1).alias("__on_spine"))]
    outputs: list[str] = []
    for frame, mapping in feeds:
        parts.append(frame.select(entity, DAY, *[F.col(src).alias(out) for out, src in mapping.items()]))
        outputs.extend(mapping.keys())
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    aggs = [F.max(c).alias(c) for c in spine_cols] + [F.max("__on_spine").alias("__on_spine")]
    for c in outputs:
        v = F.max(c)
        aggs.append((F.coalesce(v, F.lit(0)) if c in zero_fill else v).alias(c))
    stacked = stacked.repartition(tasks, entity) if tasks else stacked.repartition(entity)
    if cal is not None:
        days = F.when(F.col("__first").isNotNull(), F.sequence(F.col("__first"), F.lit(cal.end), F.expr("INTERVAL 1 DAY"))).otherwise(F.array(DAY))
        stacked = (stacked.select(*[c for c in stacked.columns if c != DAY], F.explode(days).alias(DAY))
                   .withColumn("day_index", (F.datediff(F.col(DAY), F.col("__first")) + 1).cast("long")))
    out = stacked.groupBy(entity, DAY).agg(*aggs)
    if on_spine_only:
        out = out.where(F.col("__on_spine") == 1)
    return out.drop("__on_spine")



@dataclass(frozen=True)
class DayRows:
    """Rows of a panel (``where``) and values of theirs, to be joined to other rows of the same panel on (entity, day)."""
    where: Column
    columns: Mapping[str, Column]


def join_days(panel: DataFrame, keep: Sequence[str | Column], sides: Sequence[tuple[DayRows, str]], where: Column | None = None,
              entity: str = ENTITY, day: str = DAY, unique: bool = False) -> DataFrame:
    """The panel's rows (those of ``where``) joined to rows of the panel itself on (entity, day); a side is ``inner`` or ``left``.

    The same rows as joins of selections give, days that come more than once included. A panel is laid out by entity and
    sorted by day for its windows, so the partners of a row are listed by one more window over the same layout: the
    panel is computed once and not shuffled again, where each join computes and shuffles it on both sides.
    Where the caller knows that no (entity, day) comes twice (``unique``), a row's only partner is itself: a filter and a projection.
    """
    if unique:
        kept = panel.where(F.col(entity).isNotNull() & F.col(day).isNotNull() & F.coalesce(F.lit(True) if where is None else where, F.lit(False)))
        for s, how in sides:
            kept = kept.where(s.where) if how == "inner" else kept
        return kept.select(entity, day, *keep, *[(c if how == "inner" else F.when(s.where, c)).alias(n) for s, how in sides for n, c in s.columns.items()])
    same_day = Window.partitionBy(entity, day)
    partners = [F.collect_list(F.when(s.where, F.struct(*[c.alias(n) for n, c in s.columns.items()]))).over(same_day).alias(f"__side{i}")
                for i, (s, _) in enumerate(sides)]
    known = F.col(entity).isNotNull() & F.col(day).isNotNull()
    out = panel.where(known).select(entity, day, *keep, (F.lit(True) if where is None else where).alias("__here"), *partners).where("__here").drop("__here")
    for i, (_, how) in enumerate(sides):
        out = out.select(*[c for c in out.columns if c != f"__side{i}"], (F.inline if how == "inner" else F.inline_outer)(f"__side{i}"))
    return out


def forward_count(df: DataFrame, key: str, flag: str, n: int, name: str) -> DataFrame:
    """WIN16: planned events in [t, t+n-1] per key (public in advance, so not leakage)."""
    from tidepanel.functions.frames import ahead

    return df.withColumn(name, F.sum(flag).over(ahead(n, key, DAY)).cast("long"))
