"""Line dedup by distinct-site spread, in DataFrame functions alone.

Each line is known by two 64-bit hashes of what is left after trimming. One aggregation builds a
HyperLogLog sketch of the sites of every line hash; sketches merge as they are aggregated, so a line that
half the corpus shares leaves each task as one small row. Lines whose estimate is clear of the
threshold on either side are decided; those near it get an exact count of distinct sites. Lines on
``min_sites`` sites or more are boilerplate and go from all documents.

All documents lose all such lines, whatever their length and their share of a document; only in a text whose own whole copies
are on ``min_sites`` sites, where every line is on as many, a line has to be on ``min_sites`` sites outside such texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import Tables

TRIMMED = " \t\r\v\f"


def _hashes(c: Column, a: str, b: str) -> list[Column]:
    return [F.xxhash64(c).alias(a), F.xxhash64(F.lit(7), c).alias(b)]


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """Each line with its hashes, and whether it is long enough to judge; one that isn't has hashes of its place, as a common null would all go to one task."""
    line, own = F.col("line"), ["site", "k1", "k2", "wide"]
    trimmed = F.trim(line, F.lit(TRIMMED))
    out = rows.select(*own, F.posexplode(F.split("text", "\n", -1)).alias("at", "line")).select(*own, "at", trimmed.alias("line"))
    judged = F.length("line") >= min_chars
    h1, h2 = _hashes(F.col("line"), "h1", "h2")
    return out.select(*own, "at", judged.alias("judged"), F.when(judged, h1).otherwise(F.xxhash64("k1", "k2", "at")).alias("h1"), F.when(judged, h2).otherwise(F.lit(0)).alias("h2"))


def _widely_copied(texts: DataFrame, min_sites: int, broadcast_rows: int, tables: Tables) -> DataFrame:
    """``texts`` (text, site, k1, k2) with wide: whether the whole text is on ``min_sites`` sites."""
    wide = tables.write(texts.where("site IS NOT NULL").groupBy("k1", "k2", "site").agg(F.lit(1).alias("one")).groupBy("k1", "k2").agg(F.count("site").alias("n"))
                        .where(F.col("n") >= min_sites).select("k1", "k2", F.lit(True).alias("wide")))
    return texts.join(F.broadcast(wide) if wide.count() <= broadcast_rows else wide, ["k1", "k2"], "left").withColumn("wide", F.col("wide").isNotNull())


def remove_spread_lines(documents: DataFrame, min_sites: int = 5, min_chars: int = 1, lg_k: int = 11, margin: float = 0.15,
                        broadcast_rows: int = 200_000, text_col: str = "text", site_col: str = "source") -> DataFrame:
    """The rows of ``documents`` with all their columns, their text without cross-site lines, and n_removed.

    A line counts by its trimmed characters; lines of fewer than ``min_chars``, by default the blank ones, are never removed. ``margin`` is the relative
    distance from the threshold within which the sketch's estimate is checked exactly (several standard errors at 2^lg_k
    registers). Up to ``broadcast_rows`` hashes of widely copied texts are broadcast. A null site counts as no site. A null text stays null; one with nothing to remove stays as it is, byte for byte. Repeated rows
    are cleaned alike. A column that is already called n_removed is replaced.
    """
    tables = Tables(documents.sparkSession, "lines")
    k1, k2 = _hashes(F.col(text_col).cast("string"), "k1", "k2")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(text_col).cast("string").alias("text"), F.col(site_col).cast("string").alias("site"), k1, k2)
    texts = rows.select("text", "site", "k1", "k2").where("text IS NOT NULL")
    lines = _lines(_widely_copied(texts, min_sites, broadcast_rows, tables), min_chars)
    known = lines.where("judged")
    outside = F.when(~F.col("wide"), F.col("site"))
    low, high = min_sites * (1 - margin), min_sites * (1 + margin)
    # By all texts, and by those that aren't widely copied; without a widely copied text both are one.
    sketches = [F.hll_sketch_agg("site", lg_k).alias("sites"), F.hll_sketch_agg(outside, lg_k).alias("others")]
    about = [F.hll_sketch_estimate("sites").alias("about"), F.hll_sketch_estimate("others").alias("apart")]
    spread = tables.write(known.where("site IS NOT NULL").groupBy("h1", "h2").agg(*sketches).select("h1", "h2", *about).where(F.col("about") > low))
    near = ((F.col("about") <= high) | ((F.col("apart") > low) & (F.col("apart") <= high)))
    clear = spread.where(~near).select("h1", "h2", (F.col("apart") > high).alias("apart"))
    exact = (known.select("h1", "h2", "site", "wide").join(spread.where(near).select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2", "site").agg(F.min("wide").alias("wide"))
             .groupBy("h1", "h2").agg(F.count("site").alias("n"), F.count(outside).alias("apart")).where(F.col("n") >= min_sites).select("h1", "h2", (F.col("apart") >= min_sites).alias("apart")))
    boiler = tables.write(clear.unionByName(exact))
    hit = F.col("judged") & F.col("apart").isNotNull() & (F.col("apart") | ~F.col("wide"))
    per_text = lines.select("k1", "k2", "wide", "at", "judged", "h1", "h2").distinct().join(boiler, ["h1", "h2"], "left").select("k1", "k2", "at", hit.alias("hit"))
    masks = (per_text.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("at", "hit"))).alias("mask"), F.count_if("hit").alias("n"))
             .where("n > 0").select("k1", "k2", F.col("mask.hit").alias("mask"), "n"))
    pairs = F.arrays_zip(F.split("text", "\n", -1).alias("line"), F.col("mask").alias("hit"))
    kept = F.array_join(F.transform(F.filter(pairs, lambda x: ~x["hit"]), lambda x: x["line"]), "\n")
    out = rows.join(masks, ["k1", "k2"], "left")
    columns = [F.when(F.col("mask").isNull(), F.col("row")[c]).otherwise(kept).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in documents.columns if c != "n_removed"]
    return out.select(*columns, F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"))
