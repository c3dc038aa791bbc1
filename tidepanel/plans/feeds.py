"""Binding of the driver's tables to the raw feeds of the panel.

The pipeline in ``tidepanel.plans.pipeline`` is generic: it takes feeds in the
shape of the reference's raw tables (entities, sessions, daily check-ins,
tests, injuries, match stats, fixtures). This module derives those feeds from
the TPC-H-like tables, so every query's work grows with ``lineitem``:

* entity = supplier (``l_suppkey``), team = supplier nation, group = region
* a "session" = one line item, keyed by (order, line number), re-delivered
  with different ship dates; the latest ship date wins
* daily check-in feeds (wellness, sleep, nutrition, physical tests, match
  stats) = one line item per (supplier, day) from a subset of lines
* an injury = a returned line with the top discount; days out = 3 x line no.
* fixtures = urgent orders, team = the customer's nation

All mappings are plain column arithmetic so the DuckDB oracle can restate
them in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.sources.tables import read_table

def ship_day():
    return F.to_date(F.col("l_shipdate"))


def spread(df: DataFrame) -> DataFrame:
    """Give an under-split scan (e.g. one file with one row group) the cluster's parallelism.

    A large table arrives as many splits and is returned unchanged; a scan with
    fewer splits than task slots is round-robin repartitioned once, and every
    feed derived from it reuses that exchange.
    """
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: leave the scan as it is
        return df
    return df.repartition(slots) if splits < slots else df


class SupplierFeeds:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------- dimensions
    def entities(self) -> DataFrame:
        """Raw roster: one row per supplier."""
        s, n = self.table("supplier"), self.table("nation")
        return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
                .select(F.col("s_suppkey").alias("entity_id"),
                        F.col("s_nationkey").alias("team_id"),
                        F.col("n_name").alias("position"),
                        F.date_add(F.lit("1960-01-01").cast("date"), F.floor("s_acctbal").cast("int")).alias("birth_date"),
                        (F.lit(170.0) + F.col("s_nationkey")).alias("height_cm"),
                        (F.lit(60.0) + F.abs("s_acctbal") / F.lit(250.0)).alias("weight_kg"),
                        F.lit(" Left ").alias("dominant_foot")))

    def groups(self) -> DataFrame:
        """Group lookup: position code -> group (nation -> region)."""
        n, r = self.table("nation"), self.table("region")
        return (n.join(r, n.n_regionkey == r.r_regionkey, "inner")
                .select(F.upper(F.trim("n_name")).alias("position_code"),
                        F.col("n_name").alias("position_name"),
                        F.col("r_name").alias("position_group")))

    # ------------------------------------------------------------- event feeds
    def lines(self) -> DataFrame:
        return spread(self.table("lineitem"))

    def session_lines(self) -> DataFrame:
        """Sessions without the values that follow from the others (``session_values``), for shuffles."""
        stype = (F.when(F.col("l_returnflag") == "R", "Match").when(F.col("l_returnflag") == "A", "Gym")
                 .when(F.col("l_linestatus") == "F", "Training").otherwise("Rehab"))
        return self.lines().select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
            F.col("l_suppkey").alias("entity_id"),
            F.col("l_shipdate").alias("loaded_at"),
            stype.alias("session_type"),
            F.col("l_quantity").alias("duration_min"),
            F.round(F.col("l_discount") * 100, 2).alias("rpe"),
            F.when(F.col("l_linestatus") == "F", "ms").otherwise("kmh").alias("speed_unit"))

    @staticmethod
    def session_values(lines: DataFrame) -> DataFrame:
        return lines.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "entity_id",
            F.to_date("loaded_at").alias("session_date"), "loaded_at", "session_type", "duration_min", "rpe",
            (F.col("l_extendedprice") / 10).alias("total_distance_m"),
            (F.col("duration_min") * 100).alias("hsr_distance_m"),
            F.col("l_linenumber").cast("double").alias("sprint_count"),
            (F.col("l_extendedprice") / 2000).alias("max_speed_raw"), "speed_unit")

    def sessions(self) -> DataFrame:
        return self.session_values(self.session_lines())

    def _daily(self, where) -> DataFrame:
        return self.lines().where(where).select(
            "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("entity_id"), ship_day().alias("date_day"),
            "l_quantity", "l_discount", "l_tax", "l_extendedprice")

    def wellness(self) -> DataFrame:
        d = self._daily(F.col("l_returnflag") == "A")
        return d.select("l_orderkey", "l_linenumber", "entity_id", "date_day",
                        (F.col("l_discount") * 1000).alias("hrv_rmssd_ms"),
                        (F.col("l_tax") * 1000).alias("resting_hr_bpm"),
                        (F.col("l_quantity") / 5).alias("soreness"),
                        (F.col("l_linenumber") * 1.25).alias("fatigue"),
                        (F.col("l_tax") * 100).alias("stress"),
                        (F.lit(10.0) - F.col("l_discount") * 50).alias("mood"))

    def sleep(self) -> DataFrame:
        d = self._daily((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))
        return d.select("l_orderkey", "l_linenumber", "entity_id", "date_day",
                        (F.col("l_quantity") / 4).alias("sleep_hours"),
                        (F.lit(100.0) - F.col("l_discount") * 100).alias("sleep_efficiency_pct"))

    def nutrition(self) -> DataFrame:
        d = self._daily(F.col("l_returnflag") == "R")
        return d.select("l_orderkey", "l_linenumber", "entity_id", "date_day",
                        (F.col("l_extendedprice") / 10).alias("kcal"),
                        (F.col("l_quantity") * 3).alias("protein_g"),
                        (F.col("l_quantity") * 8).alias("carbs_g"),
                        (F.col("l_tax") * 50).alias("hydration_l"))

    def tests(self) -> DataFrame:
        d = self._daily(F.col("l_quantity") >= 49)
        return d.select("l_orderkey", "l_linenumber", "entity_id", "date_day",
                        (F.lit(30.0) + F.col("l_tax") * 100).alias("cmj_cm"),
                        (F.lit(4.0) + F.col("l_discount")).alias("sprint_30m_s"),
                        F.floor(F.col("l_extendedprice") / 50).cast("long").alias("yoyo_ir1_m"),
                        (F.lit(1.0) + F.col("l_discount") * 10).alias("squat_1rm_rel"),
                        (F.lit(250.0) + F.col("l_tax") * 2000).alias("nordic_n"),
                        (F.lit(8.0) + F.col("l_linenumber")).alias("body_fat_pct"))

    def injuries(self) -> DataFrame:
        li = self.lines().where((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.095))
        return li.select(
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("injury_id"),
            F.col("l_suppkey").alias("entity_id"), ship_day().alias("injury_date"),
            F.col("l_shipdate").alias("loaded_at"), "l_partkey", "l_extendedprice",
            (F.col("l_linenumber") * 3).cast("long").alias("days_out"))

    def match_stats(self) -> DataFrame:
        d = self._daily(F.col("l_returnflag") == "R")
        return d.select("l_orderkey", "l_linenumber", "entity_id", "date_day",
                        F.col("l_orderkey").alias("fixture_id"),
                        (F.col("l_quantity") * 2).cast("long").alias("minutes_played"),
                        (F.col("l_extendedprice") / F.col("l_quantity") / 200).alias("performance_rating"))

    def fixtures(self) -> DataFrame:
        o, c = self.table("orders"), self.table("customer")
        return (o.where(F.col("o_orderpriority") == "1-URGENT")
                .join(c, o.o_custkey == c.c_custkey, "inner")
                .select(F.col("o_orderkey").alias("fixture_id"), F.col("c_nationkey").alias("team_id"),
                        F.to_date("o_orderdate").alias("fixture_date"),
                        F.col("o_orderstatus").alias("competition"),
                        F.floor(F.col("o_totalprice") / 100000).cast("long").alias("opponent_strength")))
