"""Plan shape: the union-aggregate panel and all its windows share one Exchange; no Cartesian product."""

import datetime as dt
import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidepanel.functions import frames as W
from tidepanel.operators.dedupe import dedupe_latest
from tidepanel.operators.panel import Calendar, DayRows, assemble, dense_spine, entity_spans, join_days
from tidepanel.plans import pipeline, q_gap
from tidepanel.plans.catalog import finish
from tidepanel.plans.model import ModelMarts, attach_scores
from tidepanel.plans.q_panel import acwr_both, acwr_recompute
from tidepanel.session import cut_lineage
from tidepanel.sources.tables import SCHEMAS

D0 = dt.date(2025, 1, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_assembly_and_windows_use_one_exchange(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spine = spark.createDataFrame([(e, D0 + dt.timedelta(i), i + 1) for e in range(3) for i in range(40)],
                                      "entity_id int, date_day date, day_index int")
        load = spark.createDataFrame([(e, D0 + dt.timedelta(i), float(i)) for e in range(3) for i in range(0, 40, 3)],
                                     "entity_id int, date_day date, daily_load double")
        sleep = spark.createDataFrame([(e, D0 + dt.timedelta(i), 7.0) for e in range(3) for i in range(0, 40, 2)],
                                      "entity_id int, date_day date, sleep double")
        panel = assemble(spine, [(load, {"daily_load": "daily_load"}), (sleep, {"sleep": "sleep"})],
                         zero_fill=["daily_load"])
        feats = panel.select("entity_id", "date_day",
                             F.avg("daily_load").over(W.prior(7)).alias("a7"),
                             F.avg("daily_load").over(W.prior(28)).alias("a28"),
                             F.avg("sleep").over(W.incl(3)).alias("s3"),
                             F.last("sleep", ignorenulls=True).over(W.all_incl()).alias("carry"))
        plan = _plan(feats)
        assert plan.count("Exchange hashpartitioning") == 1, plan
        assert plan.count("Window ") == 1 or plan.count("Window [") >= 1
        assert "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_spans_give_the_panel_of_the_listed_spine(spark):
    """One row per entity goes through the shuffle; its days and their numbers are those of ``dense_spine``."""
    cal = Calendar(D0, D0 + dt.timedelta(30))
    entities = spark.createDataFrame([(1, 5, D0), (2, 6, D0 + dt.timedelta(10)), (2, 6, D0 + dt.timedelta(10)), (3, 7, D0 + dt.timedelta(99)), (None, 8, D0)],
                                     "entity_id int, team_id int, since date")
    load = spark.createDataFrame([(1, D0, 2.0), (2, D0, 3.0), (2, D0 + dt.timedelta(11), 4.0), (3, D0, 5.0), (4, D0, 6.0), (1, None, 7.0)],
                                 "entity_id int, date_day date, daily_load double")
    feeds, cols = [(load, {"daily_load": "daily_load"})], ("day_index", "team_id")
    listed = assemble(dense_spine(entities, cal, "since", keep=["team_id"]), feeds, zero_fill=["daily_load"], spine_cols=cols)
    spans = assemble(entity_spans(entities, cal, "since", keep=["team_id"]), feeds, zero_fill=["daily_load"], spine_cols=cols, cal=cal)
    assert spans.columns == listed.columns and spans.dtypes == listed.dtypes
    assert Counter(map(tuple, spans.collect())) == Counter(map(tuple, listed.collect())) and spans.count() == 31 + 21 + 31


def tables(folder, lines=1500, seed=5):
    """The tables that the panel reads, with rows of their own; one supplier comes twice."""
    rng = random.Random(seed)
    day = lambda: dt.datetime(1999, 1, 1) + dt.timedelta(rng.randrange(150))
    rows = {
        "region": [(0, "AFRICA"), (1, "ASIA")],
        "nation": [(i, f"N{i}", i % 2) for i in range(3)],
        "supplier": [(i % 6, f"S{i % 6}", i % 3, 900.0 * i) for i in range(7)],
        "customer": [(i, f"C{i}", i % 3, 10.0, "A") for i in range(5)],
        "orders": [(i, i % 5, "O", 1e5 + i, day(), "1-URGENT" if i % 2 else "5-LOW") for i in range(200)],
        "lineitem": [(rng.randrange(200), i, rng.randrange(7), i % 7 + 1, float(rng.randint(1, 50)), float(rng.randint(1000, 90000)), rng.randint(0, 10) / 100, rng.randint(0, 8) / 100,
                      rng.choice("RAN"), rng.choice("FO"), day()) for i in range(lines)]}
    for name, values in rows.items():
        schema = SCHEMAS[name]
        kinds = {"long": pa.int64(), "integer": pa.int32(), "double": pa.float64(), "string": pa.string(), "timestamp_ntz": pa.timestamp("us")}
        pq.write_table(pa.table({f.name: pa.array(c, kinds[f.dataType.typeName()]) for f, c in zip(schema, zip(*values))}), f"{folder}/{name}.parquet")
    return str(folder)


def test_large_fact_is_not_kept(spark, tmp_path, monkeypatch):
    """Beyond the bound no query caches the wide fact, the joins of marts shuffle only days that can match, and the rows are those of a kept fact."""
    feeds = pipeline.SupplierFeeds(spark, tables(tmp_path))
    monkeypatch.setattr(pipeline, "KEPT_FACT_ROWS", 0)
    p = pipeline.PanelPipeline(feeds)
    for df in (p.fact, p.perf_mart(), p.fact_events()):
        assert "InMemoryTableScan" not in _plan(df)
    assert "played" in _plan(p.perf_mart()) and not p.fact.storageLevel.useMemory
    monkeypatch.setattr(pipeline, "KEPT_FACT_ROWS", 10 ** 9)
    q = pipeline.PanelPipeline(feeds)
    try:
        assert q.fact.storageLevel.useMemory
        for mart in ("perf_mart", "fact_events"):
            few, kept = (sorted(map(str, finish(getattr(x, mart)().drop("team_id", "position_group")).collect())) for x in (p, q))
            assert few == kept and few
    finally:
        q.fact.unpersist()


def test_cut_tables_are_parquet(spark):
    """A cut frame runs once: its rows, nulls and NaN included, come back from one table."""
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch
    rows = [(1, None, 0.5), (2, "a", float("nan")), (3, "", -0.0)]
    df = spark.createDataFrame(rows, "i int, t string, x double").mapInArrow(count, "i int, t string, x double")
    cut = cut_lineage(df)
    assert sorted(map(str, cut.collect())) == sorted(map(str, spark.createDataFrame(rows, "i int, t string, x double").collect()))
    assert runs.value == 3 and "FileScan parquet" in _plan(cut)


def test_days_of_a_panel_join_without_another_shuffle(spark):
    """Rows that repeat a day, days without a partner and null keys come as from a join of selections; the panel goes through one exchange."""
    rows = [(1, D0, 1.0, 1), (1, D0, 2.0, 0), (1, D0 + dt.timedelta(1), 3.0, 0), (2, D0, None, 1), (2, D0, None, 1), (None, D0, 4.0, 1), (3, None, 5.0, 1)]
    panel = spark.createDataFrame(rows, "entity_id int, date_day date, x double, flag int").repartition("entity_id")
    panel = panel.withColumn("first", F.min("x").over(W.all_incl()))
    keys, flag = ["entity_id", "date_day"], F.col("flag") == 1
    left, right = panel.where("x IS NULL OR x < 5").select(*keys, "x"), panel.where(flag).select(*keys, F.col("first").alias("other"))
    for how in ("inner", "left"):
        got = join_days(panel, ["x"], [(DayRows(flag, {"other": F.col("first")}), how)], where=F.col("x").isNull() | (F.col("x") < 5))
        want = left.where("entity_id IS NOT NULL AND date_day IS NOT NULL").join(right, keys, how)
        plan = _plan(got)
        assert plan.count("Exchange hashpartitioning") == 1, plan
        assert got.columns == want.columns and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and got.count() >= 6


def test_marts_join_their_own_days_and_read_the_fact_once(spark, tmp_path, monkeypatch):
    """Scores, predictions and recomputed ratios meet the fact's rows as by joins; benchmarks and states come from one written table."""
    feeds = pipeline.SupplierFeeds(spark, tables(tmp_path))
    rows = lambda df: sorted(map(str, finish(df).collect()))
    monkeypatch.setattr(pipeline, "KEPT_FACT_ROWS", 10 ** 9)
    kept = pipeline.PanelPipeline(feeds)
    assert kept.fact.storageLevel.useMemory
    monkeypatch.setattr(pipeline, "KEPT_FACT_ROWS", 0)
    free = pipeline.PanelPipeline(feeds)
    try:
        m = ModelMarts(kept)
        own, joined = m.risk_timeline(), attach_scores(kept.fact, m.risk_scores, m.rating_predictions)
        assert own.columns == joined.columns and rows(own) == rows(joined) and own.count()
        assert rows(acwr_both(kept)) == rows(acwr_recompute(kept).join(kept.fact.select("entity_id", "date_day", "acwr"), ["entity_id", "date_day"]))
        gaps = {p: rows(q_gap.gap_df(p).drop("team_id", "position_group")) for p in (free, kept)}
        assert gaps[free] == gaps[kept] and gaps[free]
        assert "fact_days" in free.__dict__ and "fact_days" not in kept.__dict__
        assert rows(ModelMarts(free).state) == rows(m.state)
    finally:
        kept.fact.unpersist()


def test_version_columns_are_shuffled_once(spark):
    df = spark.createDataFrame([(1, 5, "a", 2.0), (1, 7, "b", 1.0), (1, 7, "b", 3.0), (2, None, "c", 4.0)], "k int, v int, t string, x double")
    out = dedupe_latest(df, ["k"], ["v", "t"])
    assert out.columns == ["k", "v", "t", "x"] and sorted(map(tuple, out.collect())) == [(1, 7, "b", 3.0), (2, None, "c", 4.0)]
    assert "x," not in _plan(out).split("struct(__v0")[0] and "struct(__v0, v#" in _plan(out) and ", v, v#" not in _plan(out)


def test_panel_is_dealt_by_its_days(spark, tmp_path, monkeypatch):
    """Days are listed after the panel's shuffle, so its tasks follow from their number, not from the bytes shuffled; the rows stay."""
    feeds = pipeline.SupplierFeeds(spark, tables(tmp_path))
    rows = []
    for days in (10 ** 9, 40):
        monkeypatch.setattr(pipeline, "TASK_DAYS", days)
        p = pipeline.PanelPipeline(feeds)
        wide = p.base.select("entity_id", "date_day", "daily_load", F.spark_partition_id().alias("task"))
        rows.append(Counter(map(tuple, wide.drop("task").collect())))
        tasks = -(-p.most_days // days) if days == 40 else spark.sparkContext.defaultParallelism
        assert "hashpartitioning(entity_id" in _plan(wide) and f", {max(tasks, 4)}), REPARTITION_BY_NUM" in _plan(wide)
    assert rows[0] == rows[1] and rows[0]


def test_sessions_shuffle_only_what_does_not_follow(spark, tmp_path):
    """Values that follow from others are worked out after the dedupe; which of equal versions wins stays the same."""
    feeds = pipeline.SupplierFeeds(spark, tables(tmp_path, lines=300))
    lines = pq.read_table(f"{tmp_path}/lineitem.parquet").to_pylist()
    twice = [{**r, "l_quantity": r["l_quantity"] + 1, "l_returnflag": "A", "l_linestatus": x, "l_discount": None if x == "F" else 0.02} for r in lines[:60] for x in "FO"]
    pq.write_table(pa.Table.from_pylist(lines + twice, pq.read_schema(f"{tmp_path}/lineitem.parquet")), f"{tmp_path}/lineitem.parquet")
    p, keys = pipeline.PanelPipeline(feeds), ["l_orderkey", "l_linenumber"]
    whole = dedupe_latest(feeds.sessions(), keys, ["loaded_at", "l_partkey", "entity_id", "l_extendedprice"])
    lean = feeds.session_values(dedupe_latest(feeds.session_lines(), keys, ["loaded_at", "l_partkey", "entity_id", "l_extendedprice"]))
    assert sorted(lean.columns) == sorted(whole.columns) and Counter(map(tuple, lean.select(whole.columns).collect())) == Counter(map(tuple, whole.collect()))
    shuffled = _plan(p.stg_sessions).split("Exchange hashpartitioning(l_orderkey")[1]
    assert "session_type" in shuffled and "total_distance_m" not in shuffled and "max_speed_raw" not in shuffled


def test_match_rows_of_the_panel_are_those_of_the_join(spark, tmp_path, monkeypatch):
    """``perf_rows`` shuffles no wide rows, yet has every row of the mart, as often: a fixture and a supplier come twice."""
    folder = tables(tmp_path)
    orders = pq.read_table(f"{folder}/orders.parquet")
    again = [{**r, "o_totalprice": r["o_totalprice"] + 3e5} for r in orders.to_pylist() if r["o_orderkey"] % 3 == 1]
    pq.write_table(pa.Table.from_pylist(orders.to_pylist() + again, orders.schema), f"{folder}/orders.parquet")
    monkeypatch.setattr(pipeline, "KEPT_FACT_ROWS", 0)
    p = pipeline.PanelPipeline(pipeline.SupplierFeeds(spark, folder))
    lean = p.perf_rows()
    mart, got = (Counter(map(str, finish(df.select("entity_id", "date_day", "performance_rating", "minutes_played", "acwr", "cmj_cm")).collect())) for df in (p.perf_mart(), lean))
    assert got == mart and max(got.values()) >= 4
    wide = [x for x in _plan(lean.select(*pipeline.ML_FEATURES)).split("\n") if "Exchange" in x and "BroadcastExchange" not in x]
    assert len(wide) < len([x for x in _plan(p.perf_mart().select(*pipeline.ML_FEATURES)).split("\n") if "Exchange" in x and "BroadcastExchange" not in x])
