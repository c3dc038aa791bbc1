"""Embedding near-duplicates: an exact metric range join over pivot cells.

The angle between vectors is a metric, so "cosine >= t" is a range join with radius acos(t).
Pivots are a documented bounded sample spread by farthest-first choice; they only steer the
partitioning and never decide a link. Every vector has the cell of its nearest pivot as home. A
vector v can link with some w at home in cell i only if, by the triangle inequality,

    angle(v, p_i) <= angle(w, p_i) + r <= R_i + r      (R_i: the widest home angle of cell i)
    angle(v, p_i) >= r_i - r                            (r_i: the narrowest one)
    angle(v, p_i) <= angle(v, p_home) + 2 r             (w is nearer to p_i than to any other pivot)

so v is copied to just those cells. A pair of different homes meets once, in the cell of higher
number. Cells join on their own; a large cell is cut into chunks and each pair of chunks is a
task, so no task holds more than two chunks whatever the cell's size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import Tables, components

#: Added to every angle bound, above what rounding of double precision angles can reach.
SLACK = 1e-6
#: Copies that are handed on at once: a vector has one for each chunk of each of its cells.
COPIES_AT_ONCE = 50_000


def _packed(ids: str, column: str, kind: str):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            keys, data, dims = [], [], []
            for value in part[column]:
                v = None if value is None else np.asarray([math.nan if x is None else x for x in value] if any(x is None for x in value) else value, dtype=kind)
                if v is None or not v.size or not np.isfinite(v).all() or not v.any():
                    keys.append(None), data.append(None), dims.append(0)
                    continue
                raw = (v + 0.0).tobytes()  # -0.0 becomes 0.0: equal vectors have equal bytes
                keys.append(hashlib.md5(raw).digest()), data.append(raw), dims.append(len(v))
            yield pd.DataFrame({"id": part[ids], "key": keys, "vec": data, "dim": dims}).astype({"id": "Int64"})
    return run


def _unit(raw, kind: str) -> tuple[np.ndarray, np.ndarray]:
    full = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype("f8")
    full /= np.abs(full).max(axis=1, keepdims=True)  # no overflow or underflow of squares
    norms = np.sqrt(np.einsum("ij,ij->i", full, full))
    return full, norms


def _angles(raw, kind: str, pivots: np.ndarray) -> np.ndarray:
    full, norms = _unit(raw, kind)
    return np.arccos(np.clip(full / norms[:, None] @ pivots.T, -1, 1))


def _choose(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first pivots."""
    if not len(sample):
        return sample
    chosen, cos = [0], sample @ sample[0]
    while len(chosen) < min(n, len(sample)):
        far = int(np.argmin(cos))
        if cos[far] > 1 - 1e-12:
            break
        chosen.append(far)
        cos = np.maximum(cos, sample @ sample[far])
    return sample[chosen]


def _homes(pivots: np.ndarray, kind: str):
    def run(parts):
        for part in parts:
            if len(part):
                a = _angles(part["vec"], kind, pivots)
                home = a.argmin(axis=1)
                yield part.assign(home=home.astype("i4"), angle=a[np.arange(len(a)), home])
    return run


def _copies(pivots: np.ndarray, kind: str, radius: float, low: np.ndarray, high: np.ndarray, chunks: np.ndarray):
    """Each vector once for every task it takes part in: (cell, chunk, other chunk)."""
    def run(parts):
        for part in parts:
            if not len(part):
                continue
            a = _angles(part["vec"], kind, pivots)
            home = part["home"].to_numpy()
            cell = np.arange(len(pivots))
            to = (a <= high + radius + SLACK) & (a >= low - radius - SLACK) & (a <= part["angle"].to_numpy()[:, None] + 2 * radius + SLACK)
            to &= cell > home[:, None]
            to[np.arange(len(a)), home] = True
            row, at = np.nonzero(to)
            salt = np.array([int.from_bytes(k[:7], "big") for k in part["key"]])
            made = np.cumsum(chunks[at])
            s = 0
            while s < len(row):
                e = max(s + 1, int(np.searchsorted(made, (made[s - 1] if s else 0) + COPIES_AT_ONCE, side="right")))
                yield _dealt(part, home, salt, row[s:e], at[s:e], chunks)
                s = e
    return run


def _dealt(part: pd.DataFrame, home: np.ndarray, salt: np.ndarray, row: np.ndarray, at: np.ndarray, chunks: np.ndarray) -> pd.DataFrame:
    """The copies of rows ``row`` in cells ``at``: one for each chunk of the cell."""
    n = chunks[at]
    rows, cells = np.repeat(row, n), np.repeat(at, n)
    other, own = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n), np.repeat(salt[row] % n, n)
    out = part[["key", "vec", "n"]].iloc[rows].reset_index(drop=True)
    out["cell"], out["a"], out["b"], out["mine"] = cells.astype("i4"), np.minimum(own, other), np.maximum(own, other), own
    out["at_home"] = home[rows] == cells
    return out


def _linked(full, norms, fast, x: np.ndarray, y: np.ndarray, cosine: float, block: int = 2048):
    """Index pairs with cosine at or over the bound: a float32 product screens, double precision decides."""
    for i in range(0, len(x), block):
        xi = x[i:i + block]
        for j in range(0, len(y), block):
            yj = y[j:j + block]
            p, q = np.nonzero(fast[xi] @ fast[yj].T >= cosine - 1e-4)
            for k in range(0, len(p), 65536):
                u, v = xi[p[k:k + 65536]], yj[q[k:k + 65536]]
                ok = np.einsum("ij,ij->i", full[u], full[v]) >= cosine * norms[u] * norms[v]
                yield u[ok], v[ok]


def _join(kind: str, cosine: float):
    def run(task, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key", ignore_index=True)
        full, norms = _unit(part["vec"], kind)
        fast = (full / norms[:, None]).astype("f4")
        n, home = part["n"].to_numpy(), part["at_home"].to_numpy()
        left = (part["mine"] == task[1]).to_numpy()
        one = task[1] == task[2]
        h = np.flatnonzero(home)
        pairs = [(h, np.flatnonzero(~home))] if one else [(np.flatnonzero(home & left), np.flatnonzero(~left)), (np.flatnonzero(~home & left), np.flatnonzero(home & ~left))]
        count = np.zeros(len(part), dtype="i8")
        label = np.arange(len(part))

        def take(u, v):
            np.add.at(count, u, n[v])
            np.add.at(count, v, n[u])
            while len(u):  # labels settle on the smallest row of a local component
                a, b = label[u], label[v]
                apart = a != b
                if not apart.any():
                    break
                np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
                while (label[label] != label).any():
                    label[:] = label[label]
        if one:
            for u, v in _linked(full, norms, fast, h, h, cosine):
                take(u[u < v], v[u < v])
        for x, y in pairs:
            for u, v in _linked(full, norms, fast, x, y, cosine):
                take(u, v)
        hit = np.flatnonzero(count)
        key = part["key"].to_numpy()
        return pd.DataFrame({"key": key[hit], "links": count[hit], "to": key[label[hit]]})
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.9,
                    n_pivots: int = 24, sample_rows: int = 4000, chunk_rows: int = 12000) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Links are pairs of rows with cosine >= ``cosine`` in double precision. Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing and are kept; vectors of
    different lengths don't link. Equal vectors are collapsed to one with a count first and expanded
    by a join at the end. Ties and repeated ids: each row counts as a row of its own. A null id
    stays null and never names a component. Other columns are ignored.
    """
    spark = vectors.sparkSession
    if not 0 < cosine <= 1:
        raise ValueError("cosine must lie in (0, 1]")
    tables = Tables(spark, "metric")
    kind = "f4" if "array<float>" in dict(vectors.dtypes)[vec_col] else "f8"
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    rows = tables.write(plain.mapInPandas(_packed("id", "vec", kind), "id long, key binary, vec binary, dim int"))
    groups = tables.write(rows.where("key IS NOT NULL").groupBy("key", "dim").agg(F.first("vec").alias("vec"), F.min("id").alias("first_id"), F.count("*").alias("n")))
    radius = math.acos(cosine)
    found = None
    for (dim,) in groups.select("dim").distinct().collect():  # lengths of vectors: one, as a rule
        own = groups.where(F.col("dim") == dim).select("key", "vec", "n")
        sample = own.orderBy(F.xxhash64("key"), "key").limit(sample_rows).select("vec").toPandas()["vec"]
        full, norms = _unit(sample, kind)
        pivots = _choose(full / norms[:, None], n_pivots)
        at_home = tables.write(own.mapInPandas(_homes(pivots, kind), "key binary, vec binary, n long, home int, angle double"))
        low, high = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
        whole = 0
        for r in at_home.groupBy("home").agg(F.min("angle"), F.max("angle"), F.count("*")).collect():  # a row for each pivot
            low[r[0]], high[r[0]], whole = r[1], r[2], whole + r[3]
        one = np.ones(len(pivots), dtype=int)
        spec = "key binary, vec binary, n long, cell int, a long, b long, mine long, at_home boolean"
        sizes = {r["cell"]: r["count"] for r in at_home.mapInPandas(_copies(pivots, kind, radius, low, high, one), spec).groupBy("cell").count().collect()}
        chunks = np.array([max(1, -(-sizes.get(i, 0) // chunk_rows)) for i in range(len(pivots))])
        flat = -(-whole // chunk_rows)
        if 1 < flat and whole * flat < sum(n * chunks[i] for i, n in sizes.items()):
            at_home, pivots, low, high, chunks = at_home.withColumn("home", F.lit(0)), pivots[:1], low[:1], high[:1], np.array([flat])
        tasks = at_home.mapInPandas(_copies(pivots, kind, radius, low, high, chunks), spec)
        part = tasks.groupBy("cell", "a", "b").applyInPandas(_join(kind, cosine), "key binary, links long, to binary")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = tables.write(found)
    members = components(found.select(F.col("key").alias("a"), F.col("to").alias("b")), tables).withColumnRenamed("node", "key")
    members = tables.write(members.join(groups.select("key", "first_id"), "key"))
    names = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = members.join(names, "component").select("key", "component_id")
    classes = (groups.select("key", "n", "first_id").join(found.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
               .join(linked, "key", "left")
               .select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "first_id").alias("component_id")))
    return (rows.select("id", "key").join(classes, "key", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"),
                    (F.col("id") == F.coalesce("component_id", "id")).alias("kept")))
