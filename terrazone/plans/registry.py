"""Registry of queries: name -> (spark, table directory) -> DataFrame, plus the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rnd(c, digits: int = 4) -> Column:
    """Round for comparison across engines; adding 0.0 turns a negative zero into zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in columns})
