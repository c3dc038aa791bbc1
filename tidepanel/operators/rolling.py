"""Rolling features of a sorted panel, many rows at once (WIN1-5, AGG frames).

A window operator evaluates each frame row by row, so a 28-day frame costs 28 interpreted updates per row and aggregate. Here a
task's rows come sorted by (entity, day) as Arrow batches; whole entities are laid out as columns with a gap between them that is as long as the
widest frame, and a frame is a few vector operations per day of its width, over all entities of the block. Sums, means and deviations take
their values in the order of days, as the window operator does, so results are the same to the last bit; counts and sums of integers are differences of
running totals, which are exact.

Only whole entities are held: ``BLOCK_ROWS`` rows and one entity more.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions of this module travel to the executors whole, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTITY, DAY = "entity_id", "date_day"

#: Rows that are worked on at once, so that their columns stay in the processor's cache.
BLOCK_ROWS = 32_768

#: (name, aggregate, input column, frame, width); frames are those of ``functions.frames``.
Feature = tuple[str, str, str, str, int]


def feature_type(feature: Feature, schema: T.StructType, day: str = DAY) -> T.DataType:
    _, agg, src, _, _ = feature
    if agg in ("avg", "stddev", "rate"):
        return T.DoubleType()
    if agg in ("last", "max"):
        return schema[src].dataType
    if agg in ("last_day", "last_day_flag"):
        return schema[day].dataType
    if agg == "sum":
        return T.DoubleType() if isinstance(schema[src].dataType, T.DoubleType) else T.LongType()
    if agg in ("count_flag", "rows"):
        return T.LongType()
    raise ValueError(agg)


class Block:
    """Whole entities of a sorted panel; ``at`` are the rows whose results are wanted."""

    def __init__(self, table: pa.Table, starts: np.ndarray, pad: int, at: np.ndarray, entity_rows: np.ndarray, day: str):
        self.table, self.pad, self.day, self.at = table, pad, day, at
        n = table.num_rows
        self.order = np.repeat(np.arange(len(starts)), entity_rows)
        self.start, self.size = starts[self.order], entity_rows[self.order]
        self.place = np.arange(n) - self.start
        self.wide = np.arange(n) + pad * (self.order + 1)
        self.length = n + pad * (len(starts) + 2)
        self.to = self.wide[at] - pad
        self.held = {}

    def once(self, key, make):
        if key not in self.held:
            self.held[key] = make()
        return self.held[key]

    def laid(self, values: np.ndarray, fill=0) -> np.ndarray:
        out = np.full(self.length, fill, dtype=values.dtype)
        out[self.wide] = values
        return out

    def valid(self, name: str) -> np.ndarray | None:
        """Which rows have a value; None where all do."""
        def make():
            c = self.table.column(name)
            return None if not c.null_count else c.is_valid().to_numpy()
        return self.once(("valid", name), make)

    def values(self, name: str) -> np.ndarray:
        """Values with 0 for null."""
        def make():
            c = self.table.column(name)
            if pa.types.is_date(c.type):
                c = c.cast(pa.int32())
            return (c.fill_null(0) if c.null_count else c).to_numpy()
        return self.once(("values", name), make)

    def spread(self, name: str, kind=None) -> np.ndarray:
        return self.once(("laid", name, kind), lambda: self.laid(self.values(name).astype(kind or self.values(name).dtype, copy=False)))

    def has(self, name: str) -> np.ndarray:
        def make():
            v = self.valid(name)
            return self.laid(np.ones(len(self.place)) if v is None else v.astype("f8"))
        return self.once(("has", name), make)

    def days_of(self, frame: str, n: int) -> range:
        """Distances of a frame's rows, the earliest day first: row t + d belongs to the frame of row t."""
        return {"prior": range(-n, 0), "incl": range(1 - n, 1), "future": range(0, n)}[frame]

    def shifted(self, wide: np.ndarray, d: int) -> np.ndarray:
        return wide[self.pad + d:self.length - self.pad + d]

    def between(self, name, wide: np.ndarray, frame: str, n: int) -> np.ndarray:
        """Sums of integers over a frame, at the wanted rows."""
        total = self.once(("total", name), lambda: np.concatenate([[0], np.cumsum(wide, dtype="i8")]))
        days, row = self.days_of(frame, n), self.to + self.pad
        return total[row + days[-1] + 1] - total[row + days[0]]

    def rows(self, frame: str, n: int) -> np.ndarray:
        place, size = self.place[self.at], self.size[self.at]
        return {"prior": np.minimum(place, n), "incl": np.minimum(place + 1, n), "future": np.minimum(size - place, n)}[frame]

    def count(self, name: str, frame: str, n: int) -> np.ndarray:
        def make():
            v = self.valid(name)
            return self.rows(frame, n) if v is None else self.between(("has", name), self.laid(v.astype("i1")), frame, n)
        return self.once(("count", name, frame, n), make)

    def added(self, name: str, frame: str, n: int) -> np.ndarray:
        def make():
            wide = self.spread(name, "f8")
            acc = np.zeros(self.length - 2 * self.pad)
            for d in self.days_of(frame, n):
                acc += self.shifted(wide, d)
            return acc[self.to]
        return self.once(("added", name, frame, n), make)

    def deviation(self, name: str, frame: str, n: int):
        """Sample standard deviation by running means, so that equal values have none at all."""
        wide, has = self.spread(name, "f8"), self.has(name)
        count, mean, m2 = (np.zeros(self.length - 2 * self.pad) for _ in range(3))
        for d in self.days_of(frame, n):
            own = self.shifted(has, d)
            count += own
            delta = (self.shifted(wide, d) - mean) * own
            step = delta / np.maximum(count, 1)
            mean += step
            m2 += delta * (delta - step)
        count, m2 = count[self.to], m2[self.to]
        return np.sqrt(m2 / np.maximum(count - 1, 1)), count > 1

    def largest(self, name: str, frame: str, n: int) -> np.ndarray:
        v, valid = self.values(name), self.valid(name)
        least = -np.inf if v.dtype.kind == "f" else np.iinfo(v.dtype).min
        wide = self.laid(v if valid is None else np.where(valid, v, least).astype(v.dtype), least)
        acc = np.full(self.length - 2 * self.pad, least, dtype=v.dtype)
        for d in self.days_of(frame, n):
            np.maximum(acc, self.shifted(wide, d), out=acc)
        return acc[self.to]

    def latest(self, key, marked: np.ndarray, frame: str) -> tuple[np.ndarray, np.ndarray]:
        """The last marked row up to each wanted row (``all_incl``) or before it (``all_prior``), and whether its entity has one."""
        last = self.once(("latest", key), lambda: np.maximum.accumulate(np.where(marked, np.arange(len(marked)), -1)))
        if frame == "all_prior":
            found = np.where(self.at > 0, last[self.at - 1], -1)
        else:
            found = last[self.at]
        return np.maximum(found, 0), found >= self.start[self.at]

    def marked(self, name: str, flag: bool) -> np.ndarray:
        def make():
            v = self.valid(name)
            v = np.ones(len(self.place), dtype=bool) if v is None else v
            return v & (self.values(name) == 1) if flag else v
        return self.once(("marked", name, flag), make)

    def feature(self, feature: Feature) -> tuple[np.ndarray, np.ndarray | None]:
        """Values of the wanted rows and which of them aren't null (None: all)."""
        _, agg, src, frame, n = feature
        if agg == "avg":
            count = self.count(src, frame, n)
            return self.added(src, frame, n) / np.maximum(count, 1), count > 0
        if agg == "sum":
            whole = self.values(src).dtype.kind != "f"
            return self.between(("values", src), self.spread(src), frame, n) if whole else self.added(src, frame, n), self.count(src, frame, n) > 0
        if agg == "max":
            return self.largest(src, frame, n), self.count(src, frame, n) > 0
        if agg == "stddev":
            return self.deviation(src, frame, n)
        if agg == "rate":
            return self.count(src, frame, n) / float(n), None
        if agg == "rows":
            return self.rows(frame, n), None
        if agg in ("last", "last_day", "last_day_flag"):
            row, found = self.latest((src, agg == "last_day_flag"), self.marked(src, agg == "last_day_flag"), frame)
            return self.values(src if agg == "last" else self.day)[row], found
        if agg == "count_flag":
            total = self.once(("running", src), lambda: np.concatenate([[0], np.cumsum(self.values(src), dtype="i8")]))
            return total[self.at + (frame == "all_incl")] - total[self.start[self.at]], None
        raise ValueError(agg)


class Made:
    """Values worked out from a block's columns and features by formulas: a name or (operation, argument, ...). A null argument gives null.

    ``ratio`` (null where the divisor is 0), ``times``, ``minus``; ``days`` and ``years`` from a date to the row's day; ``over`` and ``equals`` a number: 1 or 0.
    """

    OPERATIONS = {"ratio": T.DoubleType(), "times": None, "minus": T.DoubleType(), "days": T.LongType(), "years": T.DoubleType(), "over": T.LongType(), "equals": T.LongType()}

    def __init__(self, block: Block, features: dict[str, Feature]):
        self.block, self.features = block, features

    def value(self, formula) -> tuple[np.ndarray, np.ndarray | None]:
        return self.block.once(("made", formula), lambda: self.work(formula))

    def work(self, formula) -> tuple[np.ndarray, np.ndarray | None]:
        b = self.block
        if isinstance(formula, str):
            if formula in self.features:
                return b.feature(self.features[formula])
            v = b.valid(formula)
            return b.values(formula)[b.at], None if v is None else v[b.at]
        kind, (x, has), other = formula[0], self.value(formula[1]), formula[2:]
        if kind in ("days", "years"):
            gone = b.values(b.day)[b.at].astype("i8") - x
            return gone if kind == "days" else gone / 365.25, has
        if kind in ("over", "equals"):
            return (x > other[0] if kind == "over" else x == other[0]).astype("i8"), has
        y, also = self.value(other[0])
        has = also if has is None else has if also is None else has & also
        if kind == "ratio":
            zero = y == 0
            return x / np.where(zero, 1, y), ~zero if has is None else has & ~zero
        return {"times": np.multiply, "minus": np.subtract}[kind](x, y), has


def made_type(formula, known) -> T.DataType:
    """Type of a formula's values; ``known`` gives that of a name."""
    if isinstance(formula, str):
        return known(formula)
    kind = Made.OPERATIONS[formula[0]]
    return kind or (T.LongType() if all(isinstance(made_type(x, known), T.LongType) for x in formula[1:]) else T.DoubleType())


def names_in(formula) -> list[str]:
    return [formula] if isinstance(formula, str) else [n for x in formula[1:] if not isinstance(x, int | float) for n in names_in(x)]


def rolled(panel: DataFrame, features: Sequence[Feature], keep: Sequence[str], rows: Column | None = None, made: dict | None = None,
           entity: str = ENTITY, day: str = DAY) -> DataFrame:
    """Columns ``keep`` and ``made`` (name: formula of features and columns; all features where not given) of the panel's rows (those of ``rows``, a condition
    on its columns); frames see all rows.

    All rows of an entity must lie in one partition, as ``assemble`` deals them. Days of an entity that come more than once are rows of their own, in any order.
    """
    features, keep = list(features), list(keep)
    pad = max([n for *_, n in features if n] or [0]) + 1
    by_name = {f[0]: f for f in features}
    made = {f: f for f in by_name} if made is None else dict(made)
    inputs = list(dict.fromkeys([entity, day, *keep, *[f[2] for f in features], *[n for m in made.values() for n in names_in(m) if n not in by_name]]))
    known = lambda n: feature_type(by_name[n], panel.schema, day) if n in by_name else panel.schema[n].dataType
    schema = T.StructType([*[panel.schema[c] for c in keep], *[T.StructField(n, made_type(m, known)) for n, m in made.items()]])
    wanted = panel.select(*inputs, *([] if rows is None else [F.coalesce(rows, F.lit(False)).alias("__wanted")])).sortWithinPartitions(entity, day)
    some = rows is not None
    days = {n for n in made if isinstance(schema[n].dataType, T.DateType)}

    def block(table, starts):
        at = np.flatnonzero(table.column("__wanted").to_numpy()) if some else np.arange(table.num_rows)
        if not len(at):
            return None
        b = Block(table, starts, pad, at, np.diff(np.append(starts, table.num_rows)), day)
        kept = [table.column(c).take(pa.array(at)).combine_chunks() if some else table.column(c).combine_chunks() for c in keep]
        maker, out = Made(b, by_name), []
        for n, formula in made.items():
            v, valid = maker.value(formula)
            column = pa.array(v, mask=None if valid is None else ~valid)
            out.append(column.view(pa.date32()) if n in days else column)
        return pa.RecordBatch.from_arrays([*kept, *out], names=schema.names)

    def run(batches):
        held, n, enough = [], 0, BLOCK_ROWS
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n < enough:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            starts = _starts(table.column(entity))
            if len(starts) == 1:
                held, enough = table.to_batches(), 2 * n
                continue
            out = block(table.slice(0, starts[-1]).combine_chunks(), starts[:-1])
            if out is not None:
                yield out
            rest = table.slice(starts[-1])
            held, n, enough = rest.to_batches(), rest.num_rows, BLOCK_ROWS
        if n:
            table = pa.Table.from_batches(held).combine_chunks()
            out = block(table, _starts(table.column(entity)))
            if out is not None:
                yield out

    return wanted.mapInArrow(run, schema)


def _starts(keys) -> np.ndarray:
    """First rows of the entities of a sorted column."""
    k = keys.to_numpy()
    return np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1])
