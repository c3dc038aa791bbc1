"""Sinks (SNK1-3): replace a table, replace one model's rows, save a model.

Paths are whatever the caller gives (a shared store on a cluster); nothing
here writes to a machine-local folder.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SNK1: full refresh of one table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """SNK2: rewrite only the partitions present in ``df`` (e.g. one model's metric rows).

    Dynamic partition overwrite replaces the read-filter-union-overwrite of
    the reference: other models' rows are never read or rewritten.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    """SNK3."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was written at ``path``, asked of the path's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
