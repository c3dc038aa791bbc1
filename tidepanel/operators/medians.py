"""Exact medians of many columns at once, by counting digits of the values (AGG19, the fill of SCR5 and ML14).

A double becomes an unsigned 64-bit key of the same order. Each pass counts the next 16 bits of the keys that share
the digits found so far, per column, and finds the digit that holds the middle rank; after four passes the key is
known. No sort and no value lists: a task returns at most 65,536 counts per column and prefix, and the driver gets
two rows per column and pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SIGN, BITS = np.uint64(1 << 63), 16
COUNTS = "slot int, digit int, n long"


def sort_keys(values: np.ndarray) -> np.ndarray:
    """Unsigned keys in the order of the doubles; -0.0 counts as 0.0."""
    bits = (values + 0.0).view("u8")
    return np.where(bits >> np.uint64(63), ~bits, bits | SIGN)


def from_key(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else ~key & (1 << 64) - 1
    return float(np.array([bits], dtype="u8").view("f8")[0])


def _digits(columns: int, slots: list[tuple[int, int]], shift: int):
    """Batches of doubles -> counts of the digit at ``shift`` by slot, a column and the prefix above that digit."""
    def run(batches):
        counts = np.zeros((len(slots), 1 << BITS), dtype="i8")
        for batch in batches:
            keys = []
            for i in range(columns):
                x = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                keys.append(sort_keys(x[~np.isnan(x)]))
            for s, (i, prefix) in enumerate(slots):
                k = keys[i]
                if shift + BITS < 64:
                    k = k[k >> np.uint64(shift + BITS) == np.uint64(prefix)]
                counts[s] += np.bincount((k >> np.uint64(shift) & np.uint64((1 << BITS) - 1)).astype("i8"), minlength=1 << BITS)
        slot, digit = counts.nonzero()
        for a in range(0, len(slot), 100_000):
            b = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(slot[b], pa.int32()), pa.array(digit[b], pa.int32()), pa.array(counts[slot[b], digit[b]])], names=["slot", "digit", "n"])
    return run


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The median of each column: the middle value, or the mean of the middle two.

    Nulls and NaN don't count; a column without other values has None. Four jobs, whatever the number of columns.
    """
    columns = list(columns)
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    totals = values.agg(*[F.count(F.when(F.col(f"c{i}").isNotNull() & ~F.isnan(f"c{i}"), 1)).alias(f"n{i}") for i in range(len(columns))]).first()
    # (column, rank from 0) -> (prefix so far, rank among the keys with that prefix)
    open_ranks = {(i, r): (0, r) for i in range(len(columns)) if totals[i] for r in {(totals[i] - 1) // 2, totals[i] // 2}}
    for shift in range(64 - BITS, -1, -BITS):
        if not open_ranks:
            break
        slots = sorted({(i, prefix) for (i, _), (prefix, _) in open_ranks.items()})
        counts = values.mapInArrow(_digits(len(columns), slots, shift), COUNTS).groupBy("slot", "digit").agg(F.sum("n").alias("n"))
        run = F.sum("n").over(Window.partitionBy("slot").orderBy("digit"))  # at most 65,536 rows a slot
        wanted = {(slots.index((i, prefix)), rank) for (i, _), (prefix, rank) in open_ranks.items()}
        holds = reduce(or_, [(F.col("slot") == s) & (F.col("to") > rank) & (F.col("to") - F.col("n") <= rank) for s, rank in wanted])
        found = counts.withColumn("to", run).where(holds).collect()  # two rows a column at most
        for key, (prefix, rank) in open_ranks.items():
            row = next(f for f in found if f["slot"] == slots.index((key[0], prefix)) and f["to"] > rank >= f["to"] - f["n"])
            open_ranks[key] = (prefix << BITS | row["digit"], rank - (row["to"] - row["n"]))
    out: dict[str, float | None] = {}
    for i, c in enumerate(columns):
        middle = [from_key(prefix) for (j, _), (prefix, _) in open_ranks.items() if j == i]
        out[c] = sum(middle) / len(middle) if middle else None
    return out
