"""Registry of named queries: Spark builder + DuckDB restatement.

``queries()`` / ``oracle_sql()`` in ``__spark_entry__`` read this registry.
Every output double is rounded to 4 places on both sides (summation order
differs between engines); integers are BIGINT, days are DATE.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 4
SCALE = float(10 ** DIGITS)


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)
    note: str = ""


REGISTRY: dict[str, Query] = {}


def finish(df: DataFrame) -> DataFrame:
    """Round every double column (presentation only).

    ``floor(x * 10^4 + 0.5) / 10^4`` gives the same double in Spark and DuckDB (their
    ``round(x, 4)`` differ on values that print as a trailing 5), and it is plain
    floating-point arithmetic: Spark's ``round`` on doubles allocates a BigDecimal per
    value, which on a wide fact costs more CPU than the windows that built it.
    """
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append((F.floor(F.col(f"`{f.name}`") * SCALE + 0.5) / SCALE).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def rounded(sql: str, doubles: list[str]) -> str:
    if not doubles:
        return sql
    rep = ", ".join(f"floor({c} * CAST({SCALE} AS DOUBLE) + 0.5) / CAST({SCALE} AS DOUBLE) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


def register(name: str, sql: str | None = None, doubles: list[str] | None = None, note: str = ""):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))

        build.__name__ = name
        REGISTRY[name] = Query(name, build, None if sql is None else rounded(sql, doubles or []),
                               doubles or [], note)
        return fn

    return deco
