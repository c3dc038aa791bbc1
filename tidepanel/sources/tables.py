"""Parquet scans with declared schemas (SRC1, SRC2) and ad-hoc SQL reads (SRC4).

Schemas are declared, never inferred: a footer with extra columns or a
different column order still loads by name, and Catalyst prunes to the
columns a query touches (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                        ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                    ("p_retailprice", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                      ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D),
                      ("props", S)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
    "documents": _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC1: scan one table. Declared schema when known, footer schema otherwise."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def load_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SRC2: take columns by name, case-insensitively, cast to the declared type.

    Columns missing from the file come back NULL; the file's own order and
    extra columns do not matter.
    """
    present = {c.lower(): c for c in df.columns}
    out = []
    for field in schema.fields:
        src = present.get(field.name.lower())
        col = F.col(f"`{src}`") if src is not None else F.lit(None)
        out.append(col.cast(field.dataType).alias(field.name))
    return df.select(*out)


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    for name in names or list(SCHEMAS):
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str) -> DataFrame:
    """SRC4: ad-hoc SQL over registered views, column names lower-cased."""
    df = spark.sql(sql)
    return df.toDF(*[c.lower() for c in df.columns])
