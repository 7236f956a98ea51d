"""Registry of driver queries: name -> (Spark builder, DuckDB oracle SQL | None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
#: Queries on a whole trained ensemble: rows only, and hours long at the full grid.
MODEL_QUERIES: dict[str, QueryFn] = {}


def rounded(c):
    """6 decimals, or cents from 1e4 up (running sums of large money amounts
    differ in the last ulp between engines); "+ 0.0" folds negative zero."""
    return F.when(F.abs(c) >= 1e4, F.round(c, 2)).otherwise(F.round(c, 6)) + F.lit(0.0)


def normalize(df: DataFrame) -> DataFrame:
    """Output typing shared with the oracle: doubles rounded (see ``rounded``),
    integral columns as BIGINT, decimals as rounded doubles."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = rounded(c.cast("double"))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    """Decorator: register a query builder (normalized on the way out)."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def register_model(name: str):
    """Decorator: register a query of ``MODEL_QUERIES``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        MODEL_QUERIES[name] = run
        return fn
    return deco
