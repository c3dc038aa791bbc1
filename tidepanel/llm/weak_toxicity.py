"""Toxicity by weak supervision.

Voters are words (lexicon) and word beginnings (patterns) that labelled training rows show more often
in toxic texts, and one voter for each kind that votes clean where none of its kind occurs. A generative
label model gives each voter its rates of voting under either class, found by expectation maximisation
over the votes, and measures how voters still agree once the class is known; voters that repeat each other
share their weight. Its posterior probabilities are what a linear classifier over the presence of words
and beginnings is trained on, and that classifier scores every text.

Voters and classifier are fitted on at most about ``max_train`` labelled rows, drawn by a hash of the id among rows that
aren't held out; every document is scored. Labels, languages, sources and ids are no inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import Tables
from tidepanel.llm.jaccard_join import _Words, shingles

_WORD = re.compile(r"[^\W_]+").findall
BEGINNINGS = (4, 5, 6)
REMEMBERED = 300_000


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, each named by its kind."""
    return ["w" + word] + [f"{n}{word[:n]}" for n in BEGINNINGS if len(word) > n]


def _words(text: str | None) -> set[str]:
    return set(_WORD(text.lower())) if text else set()


def _mined(parts):
    for part in parts:
        seen = (Counter(), Counter())
        for text, toxic in zip(part["text"], part["toxic"]):
            seen[toxic].update({f for w in _words(text) for f in features_of(w)})
        names = list(seen[0].keys() | seen[1].keys())
        yield pd.DataFrame({"feature": names, "clean": [seen[0][f] for f in names], "toxic": [seen[1][f] for f in names]})


def _signed(parts):
    """Four min-hashes of the shingles of each text, for leaving copies out of the training rows."""
    words, turns = _Words(), np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype="u8")
    for part in parts:
        out = []
        for text in part["text"]:
            h = shingles(text, 5, words)
            out.append([int(x) for x in (h[:, None] * turns).min(axis=0).view("i8")] if len(h) else [])
        yield part.assign(sign=out)


def _apart(train: DataFrame) -> DataFrame:
    """Rows that don't share two of their four signs with rows of smaller ids: of many near copies one counts."""
    firsts = train.select("id", F.posexplode("sign").alias("at", "sign"))
    least = firsts.groupBy("at", "sign").agg(F.min("id").alias("first"))
    late = firsts.join(least, ["at", "sign"]).where("id <> first").groupBy("id").count().where("count > 1").select("id")
    return train.join(late, "id", "left_anti").select("text", "toxic")


class Presence:
    """Ids of the chosen features that a text has."""

    def __init__(self, state: dict):
        self.ids, self.known = state["ids"], state["known"]

    def of(self, text: str | None) -> list[int]:
        known, ids, out = self.known, self.ids, set()
        for w in _words(text):
            hit = known.get(w)
            if hit is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                hit = known[w] = tuple(i for f in features_of(w) if (i := ids.get(f)) is not None)
            if hit:
                out.update(hit)
        return sorted(out)


def label_model(votes: np.ndarray, prior: float, start: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row, rates of each voter under classes 0 and 1, and voters' weights.

    votes: rows x voters, 1 where a voter speaks. start: a first posterior. Given the class, voters
    count as independent up to their weights: a voter with much conditional correlation to others counts less. Voters that
    vote nearly alike whatever the class (copies, a word and its beginnings) share one vote from the start, or the rounds would take
    what they have in common for the class.
    """
    def correlation(left, least):
        std = np.sqrt((left * left).mean(axis=0)) + 1e-9
        corr = np.clip(left.T @ left / len(left) / np.outer(std, std), 0, 1)
        corr[corr < least] = 0
        return corr

    post, copies = start.copy(), correlation(votes - votes.mean(axis=0), 0.8)
    weight = 1 / copies.sum(axis=1).clip(1)
    for k in range(rounds):
        on = np.stack([1 - post, post])
        rate = (on @ votes + 0.5) / (on.sum(axis=1, keepdims=True) + 1)
        if k % 8 == 7:  # how voters agree beyond what the class explains
            left = votes - (post[:, None] * rate[1] + (1 - post[:, None]) * rate[0])
            weight = 1 / np.maximum(correlation(left, 0.1), copies).sum(axis=1).clip(1)
        odds = np.log(prior / (1 - prior)) + votes @ (weight * np.log(rate[1] / rate[0])) + (1 - votes) @ (weight * np.log((1 - rate[1]) / (1 - rate[0])))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done, post = np.abs(new - post).max() < 1e-4 and k > 8, new
        if done:
            break
    return post, rate, weight


def fit_linear(rows: list[list[int]], target: np.ndarray, n: int, ridge: float = 1e-5, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by accelerated gradient steps, each weight at a pace of its own so that rare features get as far as common ones; rows hold the ids of present features."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], dtype="i8")
    size = np.array([len(r) + 1.0 for r in rows])
    w, b = np.zeros(n), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    vw, vb = w.copy(), b
    pace, pace_b = 1 / (np.bincount(col, weights=size[at], minlength=n) / (4 * len(rows)) + ridge), 4 / size.mean()
    for k in range(steps):
        z = np.bincount(at, weights=vw[col], minlength=len(rows)) + vb
        miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        gw = np.bincount(col, weights=miss[at], minlength=n) / len(rows) + ridge * vw
        nw, nb = vw - pace * gw, vb - pace_b * miss.mean()
        vw, vb = nw + k / (k + 3) * (nw - w), nb + k / (k + 3) * (nb - b)
        w, b = nw, nb
    return w, b


def fit(documents: DataFrame, labels: DataFrame, max_train: int, max_voters: int, max_features: int, min_support: int, id_col: str, text_col: str) -> dict:
    """Features with their weights, the intercept, and what the label model found."""
    spark = documents.sparkSession
    free = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(3)) != 1
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).where(free & F.col("toxic").isin(0, 1))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    total = known.count()
    share = F.pmod(F.xxhash64("id", F.lit(6)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, max_train / max(1, total)))
    train = (documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(share & free)
             .join(known.where(share), "id").select("id", "text", "toxic"))
    tables = Tables(spark, "toxicity")
    signed = tables.write(train.mapInPandas(_signed, "id long, text string, toxic int, sign array<long>"))
    train = tables.write(_apart(signed))
    tables.drop(signed)
    mined = train.mapInPandas(_mined, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("clean") + F.col("toxic") >= min_support)
    sums = train.agg(F.sum("toxic"), F.count("*")).first()
    pos, neg = int(sums[0] or 0), int((sums[1] or 0) - (sums[0] or 0))
    if not pos or not neg:
        return {"ids": {}, "weights": np.zeros(0), "intercept": 30.0 if pos else -30.0}
    both, share1 = F.col("toxic") + F.col("clean"), pos / (pos + neg)
    # Root of the likelihood ratio against "as often toxic as any row", signed by its direction.
    term = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
    z = F.signum(F.col("toxic") - share1 * both) * F.sqrt(F.abs(2 * (term(F.col("toxic"), share1 * both) + term(F.col("clean"), (1 - share1) * both))))
    top = mined.withColumn("z", z).orderBy(F.desc(F.abs("z")), "feature").limit(max_features).toPandas()
    ids = {f: i for i, f in enumerate(top["feature"])}
    state = spark.sparkContext.broadcast({"ids": ids, "known": {}})  # max_features entries

    def found(parts):
        has = Presence(state.value)
        for part in parts:
            yield pd.DataFrame({"hits": [has.of(t) for t in part["text"]]})

    rows = [list(x) for x in train.select("text").mapInPandas(found, "hits array<int>").toPandas()["hits"]]  # about max_train rows
    p, q = (top["toxic"] + 0.5) / (pos + 1), (top["clean"] + 0.5) / (neg + 1)
    voters = np.flatnonzero((top["z"] > 4) & (p / q > 4))[:max_voters]
    kinds = sorted({f[0] for f in top["feature"].iloc[voters]})
    votes = np.zeros((len(rows), len(voters) + len(kinds)))
    slot = {int(v): j for j, v in enumerate(voters)}
    kind = [len(voters) + kinds.index(f[0]) for f in top["feature"].iloc[voters]]
    votes[:, len(voters):] = 1
    for i, r in enumerate(rows):
        for c in r:
            if (j := slot.get(c)) is not None:
                votes[i, j] = 1
                votes[i, kind[j]] = 0  # its kind does not vote clean here
    start = np.where(votes[:, :len(voters)].any(axis=1), 0.9, 0.02) if len(voters) else np.full(len(rows), pos / (pos + neg))
    post, rate, weight = label_model(votes, pos / (pos + neg), start)
    w, b = fit_linear(rows, post, len(ids))
    return {"ids": ids, "weights": w, "intercept": b, "voters": [top["feature"].iloc[v] for v in voters] + ["none of " + k for k in kinds], "rates": rate, "voter_weights": weight}


def _scorer(documents: DataFrame, model: dict):
    state = documents.sparkSession.sparkContext.broadcast({"ids": model["ids"], "known": {}, "weights": model["weights"], "intercept": model["intercept"]})  # max_features entries

    def score(texts) -> np.ndarray:
        own = state.value
        has, w, b = Presence(own), own["weights"], own["intercept"]
        z = np.array([b + w[has.of(t)].sum() for t in texts], dtype="f8")
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return score


def without_toxic(documents: DataFrame, labels: DataFrame, max_train: int = 16_000, max_voters: int = 250, max_features: int = 1500,
                  min_support: int = 8, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that toxicity_scores doesn't predict as toxic, with all their columns."""
    score = _scorer(documents, fit(documents, labels, max_train, max_voters, max_features, min_support, id_col, text_col))
    place = documents.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(place).to_pylist()) < threshold, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def toxicity_scores(documents: DataFrame, labels: DataFrame, max_train: int = 16_000, max_voters: int = 250, max_features: int = 1500,
                    min_support: int = 8, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out (crc32 of the id as text mod 3 is 1), score (0 to 1), predicted (score >= threshold).

    Labels are read from rows that aren't held out; a null label is none, and of several for one id the highest holds.
    A null text scores as an empty one; a row with a null id is not held out. Without labels of both classes every
    score is that of the class there is, or 0. Repeated rows and ties score alike; texts are read whole; other
    columns are ignored.
    """
    score = _scorer(documents, fit(documents, labels, max_train, max_voters, max_features, min_support, id_col, text_col))

    def run(parts):
        for part in parts:
            yield pd.DataFrame({"id": part["id"].astype("Int64"), "score": score(part["text"])})

    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(run, "id long, score double")
    held = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    return out.select(F.col("id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
