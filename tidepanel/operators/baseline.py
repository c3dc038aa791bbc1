"""ML14: ridge in closed form. One pass sums the moments of all rows; the equations of the features are solved on the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.medians import exact_medians


@dataclass
class Ridge:
    columns: list[str]
    fill: list[float]
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    intercept: float

    def prediction(self) -> Column:
        """One generated expression: median fill, standardising and the weighted sum."""
        parts = [(F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(f)) - float(m)) * float(w / s)
                 for c, f, m, s, w in zip(self.columns, self.fill, self.mean, self.scale, self.weight)]
        return reduce(add, parts, F.lit(self.intercept))


def moments(df: DataFrame, columns: Sequence[str], label: str, fill: Sequence[float]) -> np.ndarray:
    """Sums of products of (1, x - fill, label) over all rows with a label: a matrix of (columns + 2) squared.

    A task returns one row per column of the matrix; the rows are summed by Spark, so the driver gets features squared numbers.
    """
    width, fill = len(columns) + 2, np.array(fill)

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype("f8") for c in batch.columns], axis=1)
            x[:, :-1] = np.where(np.isnan(x[:, :-1]), 0.0, x[:, :-1] - fill)  # shifted by the fill, so that large means don't eat digits
            x = np.column_stack([np.ones(len(x)), x])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width), width), pa.int32()), pa.array(np.tile(np.arange(width), width), pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    rows = df.where(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)], F.col(label).cast("double").alias("y"))
    out = np.zeros((width, width))
    for r in rows.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # (columns + 2) squared rows
        out[r["i"], r["j"]] = r["s"]
    return out


def ridge(df: DataFrame, columns: Sequence[str], label: str, alpha: float = 50.0) -> Ridge:
    """Median fill, standardised features, penalty alpha on the weights and none on the intercept.

    Rows without a label are left out. A column without values is filled with 0; one without variance has weight 0. No rows: all weights 0.
    """
    columns = list(columns)
    medians = exact_medians(df.where(F.col(label).isNotNull()), columns)
    fill = [medians[c] if medians[c] is not None else 0.0 for c in columns]
    m = moments(df, columns, label, fill)
    n = m[0, 0]
    if not n:
        zero = np.zeros(len(columns))
        return Ridge(columns, fill, zero, zero + 1, zero, 0.0)
    mean = m[0, 1:] / n
    centred = m[1:, 1:] - n * np.outer(mean, mean)
    var = np.diag(centred)[:-1] / n
    flat = var <= 1e-12 * np.maximum(1.0, mean[:-1] ** 2)
    scale = np.where(flat, 1.0, np.sqrt(np.where(flat, 1.0, var)))
    gram = np.where(np.logical_or.outer(flat, flat), 0.0, centred[:-1, :-1] / np.outer(scale, scale))
    right = np.where(flat, 0.0, centred[:-1, -1] / scale)
    half = np.linalg.cholesky(gram + alpha * np.eye(len(columns)))
    weight = np.linalg.solve(half.T, np.linalg.solve(half, right))
    return Ridge(columns, fill, mean[:-1] + np.array(fill), scale, weight, float(mean[-1]))
