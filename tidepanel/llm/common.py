"""Shared helpers: table reads, written intermediate tables, keys and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.session import ensure_checkpoint_dir

#: Words of every contract: runs of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")




class Tables:
    """Intermediate tables under the shared checkpoint folder of the session.

    A written Parquet table cuts lineage: if an executor is lost, only the tasks that read
    the table run again. ``drop`` frees a table no later step reads.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.written_at = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one parent and no parent has one: then a parent is the smallest node of its component."""
    n, children = edges.agg(F.count("*"), F.count_distinct("u")).first()
    return n == children and edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges``: columns a, b of one orderable type; direction, repeats and loops don't matter.
    Returns (node, component) for every node of an edge between two nodes; the component is
    its smallest node; rounds end when every component is a star. Each round is a minimum per node and a join, so a node with very many
    links is one pre-aggregated row on one side and splits on the other.
    """
    e = tables.write(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = tables.write(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        new = tables.write(small)
        tables.drop(large)
        tables.drop(e)
        e = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def slices(parts, rows: int = 1000):
    """The same rows in smaller batches, so that what is made of a batch stays small."""
    for part in parts:
        for i in range(0, len(part), rows):
            yield part.iloc[i:i + rows].reset_index(drop=True)


def groups_of(parts, key: str):
    """Consecutive groups of a stream of batches sorted by ``key``: of each, its columns as lists."""
    import numpy as np

    held = None
    for part in parts:
        if not len(part):
            continue
        k = part[key].to_numpy()
        data = {c: part[c].tolist() for c in part.columns}
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            group = {c: v[a:b] for c, v in data.items()}
            if held is not None and not i and held[key][0] == group[key][0]:
                for c, v in group.items():
                    held[c] += v
                continue
            if held is not None:
                yield held
            held = group
    if held is not None:
        yield held
