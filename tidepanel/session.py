"""Spark session helpers.

The library never hard-codes a cluster layout. It reads what the session says
(``spark.checkpoint.dir``, shuffle partitions) and only fills in defaults where
the caller left them unset, as tests and local runs do.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a local run needs; a cluster submit passes its own and these are
# only applied by ``local_session``.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.caseSensitive": "false",
    # A broadcast is only planned for relations Spark can size; 32 MB keeps
    # dimension tables broadcast and every fact shuffled.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidepanel",
                  driver_memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    (a bare local test session) a private folder is created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidepanel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def compile_in_parts(spark: SparkSession) -> None:
    """Wide projections as methods that the JVM compiles, unless the session says otherwise.

    HotSpot interprets methods of more than 8,000 bytes for good, and whole-stage code puts a projection of some 60 rounded columns into one. Beyond this bound
    Spark generates the same projection in small methods.
    """
    if spark.conf.get(HUGE_METHOD, None) in (None, "65535"):
        spark.conf.set(HUGE_METHOD, "8000")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table under the shared checkpoint folder (survives executor loss; never a local checkpoint).

    Parquet, so that who reads it again reads only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
