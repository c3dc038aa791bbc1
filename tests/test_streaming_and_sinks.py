"""Streaming keep-latest equals the batch dedupe; sinks replace only their partitions."""

import shutil
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidepanel.operators.dedupe import dedupe_latest
from tidepanel.sources.sinks import replace_partitions, write_table
from tidepanel.sources.tables import SCHEMAS
from tidepanel.streaming import redelivery

SRC = "/root/testdata/sf0.001/lineitem.parquet"
KEYS = ["l_orderkey", "l_linenumber"]
VERSION = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def test_streaming_upsert_matches_batch(spark):
    work = Path(tempfile.mkdtemp(prefix="tp-stream-"))
    src = work / "in"
    src.mkdir()
    shutil.copy(SRC, src / "part-0.parquet")
    q = redelivery.start(spark, str(src), SCHEMAS["lineitem"], str(work / "out"), str(work / "ckpt"), KEYS, VERSION,
                         buckets=8)
    q.awaitTermination(300)
    got = spark.read.parquet(str(work / "out")).select(*KEYS, "l_suppkey", "l_shipdate")
    expect = dedupe_latest(spark.read.schema(SCHEMAS["lineitem"]).parquet(SRC), KEYS, VERSION).select(
        *KEYS, "l_suppkey", "l_shipdate")
    assert got.count() == expect.count()
    assert got.exceptAll(expect).count() == 0


def test_replace_partitions_keeps_other_models(spark):
    work = tempfile.mkdtemp(prefix="tp-sink-")
    a = spark.createDataFrame([("m1", "auc", 0.7), ("m2", "auc", 0.8)], "model_name string, metric string, value double")
    write_table(a, work, ["model_name"])
    replace_partitions(spark.createDataFrame([("m2", "auc", 0.9)], "model_name string, metric string, value double"),
                       work, "model_name")
    got = sorted((r.model_name, r.value) for r in spark.read.parquet(work).collect())
    assert got == [("m1", 0.7), ("m2", 0.9)]
    assert spark.read.parquet(work).where(F.col("model_name") == "m1").count() == 1


def test_unreadable_target_stops_the_batch(spark):
    """A target that exists but can't be read is an error, never a first batch."""
    work = Path(tempfile.mkdtemp(prefix="tp-broken-")) / "out"
    work.mkdir()
    (work / "part-0.parquet").write_bytes(b"no parquet")
    batch = spark.createDataFrame([(1, 1, 5)], "l_orderkey int, l_linenumber int, v int")
    with pytest.raises(Exception, match="(?i)parquet|footer|schema"):
        redelivery.upsert_latest(batch, str(work), KEYS, ["v"], buckets=2)
    assert (work / "part-0.parquet").read_bytes() == b"no parquet"


def test_checkpoint_folder_is_required_off_local(monkeypatch):
    from tidepanel import session

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_pipelines_of_two_parameters_differ(spark):
    from tidepanel.plans.pipeline import Params, pipeline_for

    a, b = (pipeline_for(spark, "/root/testdata/sf0.001", Params(label_horizon_days=n)) for n in (7, 3))
    assert a is not b and a is pipeline_for(spark, "/root/testdata/sf0.001", Params(label_horizon_days=7)) and b.p.label_horizon_days == 3


def test_seed_from_csv(spark):
    """SRC3: quoted commas, pinned types, empty cells as NULL."""
    from pyspark.sql import types as T

    from tidepanel.sources.rules import read_seed

    path = Path(tempfile.mkdtemp(prefix="tp-seed-")) / "seed.csv"
    path.write_text('metric,low,note\nsleep,7.5,"long, and regular"\ncmj,,\n')
    schema = T.StructType([T.StructField("metric", T.StringType()), T.StructField("low", T.DoubleType()), T.StructField("note", T.StringType())])
    assert [tuple(r) for r in read_seed(spark, str(path), schema).collect()] == [("sleep", 7.5, "long, and regular"), ("cmj", None, None)]


def test_saved_model_scores_alike(spark):
    """SNK3: a reloaded model gives the same predictions."""
    from tidepanel.operators.learn import baseline_ridge
    from tidepanel.sources.sinks import load_model, save_model

    df = spark.createDataFrame([(float(i), float(i % 5), 2.0 * i - i % 5) for i in range(40)] + [(None, 1.0, 3.0)], "a double, b double, y double")
    model = baseline_ridge(df, ["a", "b"], "y", alpha=0.1)
    path = str(Path(tempfile.mkdtemp(prefix="tp-model-")) / "ridge")
    save_model(model, path)
    want, got = (sorted(r["__bpred"] for r in m.transform(df).collect()) for m in (model, load_model(path)))
    assert got == want and abs(want[-1] - 74) < 2
