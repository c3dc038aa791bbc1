"""Mixing sources to target weights with soft memberships.

A classifier trained on the labelled table gives every document its posterior over domains (the
combinations of the labels). Document rates r >= 0 are then fitted so that the expected tokens of each domain,
sum over documents of r * tokens * posterior, match the target shares of all tokens: least squares by
accelerated projected gradient. Each step sums a number per domain and momentum over all documents; in the metric of the documents'
tokens and with the residual weighted by the inverse of sum(tokens * posterior * posterior'), the step size is
1. A rate changes by the posterior times one vector, so nothing but that vector leaves the driver.
"""

from __future__ import annotations

import warnings
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.llm.common import Tables
from tidepanel.llm.divergence import CLASSES, class_counts

HASHED = 2048
#: How far a step may go on by the last change; each step takes what lowers the loss most.
MOMENTA = (0.0, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0)
#: Target shares of the domains "q<quality>t<toxic>"; a domain that isn't named is left free.
TARGETS = {"q1t0": 0.90, "q0t0": 0.07, "q1t1": 0.02, "q0t1": 0.01}


def features(text: str | None) -> tuple[np.ndarray, int]:
    """Hashed words, shares of character classes and lengths of a text; its number of words."""
    x = np.zeros(HASHED + len(CLASSES) + 2, dtype="f4")
    words = text.encode().lower().split() if text else []
    if words:
        seen = np.bincount(np.fromiter(map(zlib.crc32, words), dtype="i8", count=len(words)) % HASHED, minlength=HASHED)
        seen = np.log1p(seen)
        x[:HASHED] = 8 * seen / np.sqrt((seen * seen).sum())
        share = class_counts(text)
        x[HASHED:-2] = 5 * np.sqrt(share / share.sum())
        x[-2:] = np.log1p(len(words)) / 5, len(set(words)) / len(words)
    return x, len(words)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_domains(texts: list[str | None], domains: np.ndarray, k: int, steps: int = 200, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    x = np.stack([features(t)[0] for t in texts])
    y, w, b = np.eye(k, dtype="f4")[domains], np.zeros((x.shape[1], k), dtype="f4"), np.log(np.bincount(domains, minlength=k) / len(domains) + 1e-3).astype("f4")
    vw, vb, rate = w.copy(), b.copy(), 1.0 / (0.5 * float((x * x).sum(axis=1).mean()))
    for i in range(steps):
        miss = (softmax(x @ vw + vb) - y) / len(x)
        nw, nb = vw - rate * (x.T @ miss + ridge * vw), vb - rate * miss.sum(axis=0)
        vw, vb = nw + i / (i + 3) * (nw - w), nb + i / (i + 3) * (nb - b)
        w, b = nw, nb
    return w, b


def train(documents: DataFrame, labels: DataFrame, max_train: int, id_col: str, text_col: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string")).alias("domain"))
             .where("id IS NOT NULL AND domain IS NOT NULL").groupBy("id").agg(F.min("domain").alias("domain")))
    total = known.count()
    share = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, max_train / max(1, total)))
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(share).join(known.where(share), "id").select("domain", "text").toPandas()  # about max_train rows
    names = sorted(set(rows["domain"]))
    if not names:
        return [], np.zeros((0, 0)), np.zeros(0)
    w, b = fit_domains(list(rows["text"]), np.array([names.index(d) for d in rows["domain"]]), len(names))
    return names, w, b


def ahead(prev: np.ndarray, r: np.ndarray, momentum: float) -> np.ndarray:
    return np.maximum(0.0, r + momentum * (r - prev))


def rates(p: np.ndarray, steps: list[list[float]], prev: np.ndarray | None = None, r: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The last two rates after the steps: each goes on by its momentum, then down along the posterior, and stays at 0 or above."""
    prev, r = (np.ones(len(p)), np.ones(len(p))) if r is None else (prev, r)
    for *move, momentum in steps:
        prev, r = r, np.maximum(0.0, ahead(prev, r, momentum) - p @ np.asarray(move))
    return prev, r


def reachable(target: np.ndarray, held: np.ndarray, max_boost: float) -> np.ndarray:
    """Target shares of sum 1, none over ``max_boost`` times the share its domain holds; what is cut goes to the others in proportion.

    If all are cut, or a domain holds nothing, the shares sum to less than 1.
    """
    most, out, cut = max_boost * held, target / target.sum(), np.zeros(len(target), dtype=bool)
    while (over := ~cut & (out > most)).any():
        cut |= over
        out = np.where(cut, most, out)
        free = out[~cut].sum()
        out[~cut] *= (1 - out[cut].sum()) / free if free > 0 else 1.0
    return out


def solve(table: DataFrame, domains: list[int], target: np.ndarray, tables: Tables, tolerance: float, max_steps: int, max_boost: float | None = None, cut_every: int = 64) -> DataFrame:
    """``table`` (tokens, posterior, ...) with its columns rate, fitted, and residual; target: shares of the tokens, of these domains."""
    k, p, t = len(domains), [F.col("posterior")[i].alias(f"p{i}") for i in domains], F.col("tokens").cast("double")
    slim = table.select(t.alias("tokens"), *p)
    names = slim.columns[1:]
    gram = slim.agg(F.sum("tokens").alias("all"), *[F.sum(F.col("tokens") * F.col(a)).alias(f"h{i}") for i, a in enumerate(names)],
                    *[F.sum(F.col("tokens") * F.col(names[i]) * F.col(names[j])).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    total = gram["all"] or 0.0
    if not total:
        return table.withColumn("rate", F.lit(1.0)).withColumn("residual", F.lit(0.0))
    g = np.array([[gram[f"g{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / total
    held = np.array([gram[f"h{i}"] for i in range(k)]) / total
    if max_boost is not None:
        target = reachable(target, held, max_boost)
    weight = np.linalg.pinv(g, rcond=1e-6, hermitian=True)
    state = T.StructType([T.StructField(c, T.DoubleType()) for c in ("tokens", *names, "prev", "r")])
    sums = T.StructType([T.StructField(f"s{i}", T.DoubleType()) for i in range(k * len(MOMENTA))])

    def moved(batch, path):
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        return x, *rates(x[1:k + 1].T, path, *x[k + 1:])

    def shares(rows, path):
        """For each momentum, the expected tokens by domain as shares of all tokens."""
        def run(batches):
            for batch in batches:
                x, prev, r = moved(batch, path)
                y = np.stack([ahead(prev, r, m) for m in MOMENTA])
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in ((y * x[0]) @ x[1:k + 1].T).ravel()], names=sums.names)
        return np.array(rows.mapInArrow(run, sums).agg(*[F.sum(c) for c in sums.names]).first(), dtype="f8").reshape(-1, k) / total

    def advanced(rows, path):
        def run(batches):
            for batch in batches:
                x, prev, r = moved(batch, path)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*x[:k + 1], prev, r)], names=state.names)
        return rows.mapInArrow(run, state)

    rows = tables.write(slim)  # a few doubles a document: every step reads these alone
    steps, last, still = [], np.inf, 0
    while True:
        miss = shares(rows, steps[len(steps) - len(steps) % cut_every:]) - target
        losses = np.einsum("mi,ij,mj->m", miss, weight, miss)
        best = int(losses.argmin())
        loss, miss, momentum = float(losses[best]), miss[best], MOMENTA[best]
        still = still + 1 if last - loss < 1e-9 * last else 0
        if loss < tolerance ** 2 or still == 3:
            break
        if len(steps) == max_steps:
            warnings.warn(f"mixing ended after {max_steps} steps, {float(np.abs(miss).max()):.2g} from a target share")
            break
        last = loss
        steps.append([*(float(x) for x in weight @ miss), momentum])
        if len(steps) % cut_every == 0:  # the state is a few numbers a row; the long path ends here
            rows, before = tables.write(advanced(rows, steps[-cut_every:])), rows
            tables.drop(before)
    tables.drop(rows)

    @F.pandas_udf("double")
    def rate(*p: pd.Series) -> pd.Series:
        return pd.Series(ahead(*rates(np.stack([c.to_numpy() for c in p], axis=1), steps), momentum))

    return table.withColumn("rate", rate(*p)).withColumn("residual", F.lit(float(np.abs(miss).max())))


def mix(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, max_train: int = 6000, tolerance: float = 1e-5, max_steps: int = 2000,
        max_boost: float | None = 4.0, with_residual: bool = False, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with the columns ``keep`` (all by default), tokens, posterior, rate and copies, and ``with_residual`` also residual.

    posterior: array over the sorted domains of the labelled rows among ``documents``; tokens: words; rate >= 0; copies: the
    rate as a whole number, its fraction decided by a hash of id and text. The classifier is fitted on at most about ``max_train``
    labelled rows drawn by a hash of the id; memberships, sums and rates cover all rows. Targets are scaled to sum to 1 over the
    named domains there are, and none is more than ``max_boost`` times the share of expected tokens that its domain holds (what is cut goes to the
    others), so that a nearly absent domain doesn't repeat its few documents without end; None sets no such bound. residual: the largest gap between a
    reached and a target share, the same in all rows. A domain without a target is left free. Without labelled rows, or without tokens, all rates are 1. Null and empty texts have no tokens and a rate
    like other texts. Repeated rows and ties have equal rates; a label row with a null is none. Columns called like
    the new ones are replaced.
    """
    own = ["tokens", "posterior", "rate", "copies", *["residual"] * with_residual]
    keep = [c for c in (documents.columns if keep is None else keep) if c not in own]
    names, w, b = train(documents, labels, max_train, id_col, text_col)
    tables = Tables(documents.sparkSession, "mixing")
    model = documents.sparkSession.sparkContext.broadcast((w, b))  # a few thousand rows x domains
    k = len(names)
    draw = F.pmod(F.xxhash64(F.lit(9), F.col(id_col), F.col(text_col)), F.lit(1_000_000)) / 1_000_000.0
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text_col).cast("string").alias("text"), draw.alias("draw"))
    schema = T.StructType([rows.schema["row"], T.StructField("draw", T.DoubleType()), T.StructField("tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))])

    def run(batches):
        w, b = model.value
        for batch in batches:
            tokens, posterior = [], []
            for text in batch.column(1).to_pylist():
                x, n = features(text)
                tokens.append(n)
                posterior.append(softmax(x @ w + b).astype("f8").tolist() if k else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens, pa.int64()), pa.array(posterior, pa.list_(pa.float64()))], names=["row", "draw", "tokens", "posterior"])

    table = tables.write(rows.mapInArrow(run, schema))
    shares = TARGETS if targets is None else targets
    domains = [i for i, d in enumerate(names) if d in shares]
    target = np.array([shares[names[i]] for i in domains])
    if target.sum() > 0:
        table = solve(table, domains, target / target.sum(), tables, tolerance, max_steps, max_boost)
    else:
        table = table.withColumn("rate", F.lit(1.0)).withColumn("residual", F.lit(0.0))
    whole = F.floor("rate")
    return table.select(*[F.col("row")[c].alias(c) for c in keep], "tokens", "posterior", "rate", *["residual"] * with_residual, (whole + (F.col("draw") < F.col("rate") - whole).cast("int")).cast("long").alias("copies"))
