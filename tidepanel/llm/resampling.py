"""Importance resampling of documents towards a target text, by hashed n-gram features.

Every run of one to three words of a text is a feature, hashed to a bucket. The bucket counts of the corpus and of the
target give each bucket a gain, the log of the ratio of its smoothed shares, in thousandths; a document's weight is the sum of
the gains of its features, and keyed Gumbel noise on top makes the best scores a draw without replacement. Texts are read
twice: once for the counts (one bucket array per task, summed by aggregation), once to add up gains from an array. The
scores are written; the cutoff is found by bisection, first over the whole-numbered score and then over the ids tied at it,
each step an exact count over the written scores. Only the drawn rows are sorted, by ranges.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import Tables

BUCKETS, LONGEST_RUN, SEED = 10_000, 3, "42"

#: What a byte becomes before words are split off: A-Z in lower case, digits, a-z and all of non-ASCII as they are, the rest a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def features(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every run of 1 to 3 words joined by a space; the checksum of a run goes on from that of the run one word shorter."""
    ends = [b" " + w for w in words[1:]]
    runs = list(map(zlib.crc32, words))
    found = runs[:]
    for k in range(1, LONGEST_RUN):
        runs = list(map(zlib.crc32, ends[k - 1:], runs))
        found += runs
    return np.array(found, dtype="u4") % np.uint32(buckets)


def bucket_counts(texts: DataFrame, text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket; each task sends one row per bucket it met."""
    def run(batches):
        total = np.zeros(buckets, dtype="i8")
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if words := words_of(text):
                    total += np.bincount(features(words, buckets), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype("i4")), pa.array(total[met])], names=["bucket", "n"])

    rows = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # as many as buckets
    out = np.zeros(buckets, dtype="i8")
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floor of 1000 times the log of the smoothed target share over the smoothed source share."""
    many, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + many) / ((s + 1.0) * (t_all + many)))) for s, t in zip(source.astype("f8").tolist(), target.astype("f8").tolist())], dtype="i8")


def noise(doc_id: int, seed: str = SEED) -> int:
    """Keyed Gumbel noise of an id, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _least(low: int, high: int, holds) -> int:
    """The least whole number in [low, high] for which the monotone ``holds`` is true; it is true of ``high``."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle + 1, high)
    return low


def cutoff(eligible: DataFrame, draw: int) -> tuple[int, int]:
    """(score, id): the ``draw`` best rows have a higher score, or this score and an id up to this one; more only where rows repeat.

    eligible: id, score, both without null, at least ``draw`` rows of them, draw > 0.
    """
    low, high = eligible.agg(F.min("score"), F.max("score")).first()
    above = lambda s: eligible.where(F.col("score") > s).count()
    score = _least(low, high, lambda s: above(s) < draw)
    left, tied = draw - above(score), eligible.where(F.col("score") == score)
    low, high = tied.agg(F.min("id"), F.max("id")).first()
    return score, _least(low, high, lambda i: tied.where(F.col("id") <= i).count() >= left)


def ranked(drawn: DataFrame, order: list, tables: Tables) -> DataFrame:
    """``drawn`` with rank 1, 2, 3... by ``order``: sorted by ranges, numbered in each, and moved on by what the earlier ranges hold."""
    place = F.col("_at")
    table = tables.write(drawn.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    sizes = {r["part"]: r["n"] for r in table.groupBy(F.shiftright(place, 33).alias("part")).agg(F.count("*").alias("n")).collect()}  # one row per range
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    starts = F.broadcast(drawn.sparkSession.createDataFrame(starts, "_part long, _before long"))
    return table.join(starts, F.shiftright(place, 33) == F.col("_part")).withColumn("rank", F.col("_before") + place.bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_part", "_before")


def resample(documents: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, buckets: int = BUCKETS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """Every document with id, n_features, weight, score and rank (null unless drawn), all long.

    Of the N documents of ``min_words`` words and more, floor(percent * N / 100) are drawn by highest score, ties to the smaller id. A null or empty
    text has no features and weight 0. Each row is a document of its own: of rows equal in score and id any may be the one drawn. A row without an id gets no noise:
    its score is null, it isn't drawn and isn't among the N, though its features count in the corpus. Null target texts add nothing; with an
    empty target, gains favour rare buckets. An empty table gives no rows. Other columns are ignored; texts are taken whole.
    """
    spark, tables = documents.sparkSession, Tables(documents.sparkSession, "resampling")
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    gains = spark.sparkContext.broadcast(gains_of(bucket_counts(docs, "text", buckets), bucket_counts(target, target_text, buckets)))  # one number per bucket

    def run(batches):
        for batch in batches:
            out = {"id": batch.column(0), "n_words": [], "n_features": [], "weight": [], "score": []}
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                found = features(words, buckets) if words else ()
                weight = int(gains.value[found].sum()) if words else 0
                out["n_words"].append(len(words))
                out["n_features"].append(len(found))
                out["weight"].append(weight)
                out["score"].append(None if i is None else weight + noise(i, seed))
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) if c != "id" else v for c, v in out.items()], names=list(out))

    scores = tables.write(docs.mapInArrow(run, "id long, n_words long, n_features long, weight long, score long"))
    eligible = scores.where((F.col("n_words") >= min_words) & F.col("score").isNotNull())
    draw = percent * eligible.count() // 100
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    if not draw:
        return scores.select(*columns, F.lit(None).cast("long").alias("rank"))
    score, last = cutoff(eligible.select("id", "score"), draw)
    best = F.coalesce((F.col("n_words") >= min_words) & ((F.col("score") > score) | ((F.col("score") == score) & (F.col("id") <= last))), F.lit(False))
    drawn = ranked(scores.where(best).select("*", F.xxhash64("id", "n_features", F.monotonically_increasing_id()).alias("_any")), [F.desc("score"), F.asc("id"), F.asc("_any")], tables)
    rank = F.when(F.col("rank") <= draw, F.col("rank")).alias("rank")  # beyond it are rows equal to the last drawn
    return drawn.select(*columns, rank).unionByName(scores.where(~best).select(*columns, F.lit(None).cast("long").alias("rank")))
