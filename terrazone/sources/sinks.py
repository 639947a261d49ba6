"""Sinks: cleaned CSV and JSON tables, appending with column widening, partitioned outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.scalars import finite
from ..operators.tables import union_tables


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``; below the warehouse, which is shared too, where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    return f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}"


def clean(df: DataFrame) -> DataFrame:
    """NaN and infinite numbers become NULL, in plain columns and in arrays or maps of numbers."""
    def one(f: T.StructField):
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType)):
            return finite(f.name).cast(t).alias(f.name)
        if isinstance(t, T.ArrayType) and isinstance(t.elementType, (T.DoubleType, T.FloatType)):
            return F.transform(f.name, lambda v: finite(v)).alias(f.name)
        if isinstance(t, T.MapType) and isinstance(t.valueType, (T.DoubleType, T.FloatType)):
            return F.transform_values(f.name, lambda k, v: finite(v)).alias(f.name)
        return F.col(f.name)
    return df.select(*[one(f) for f in df.schema.fields])


def arrange(df: DataFrame, declared: list[str] = ()) -> DataFrame:
    """Declared columns first (missing ones as NULL), then the others."""
    first = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in declared]
    return df.select(*first, *[c for c in df.columns if c not in declared])


def flat_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, everything else unchanged."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name, {"ignoreNullFields": "false"}).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields])


def sink_table(df: DataFrame, path: str, declared: list[str] = (), mode: str = "errorifexists") -> None:
    """CSV: declared columns first, nested values as JSON text, non-finite numbers empty."""
    (flat_text(arrange(clean(df), list(declared))).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").csv(path))


def sink_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines of the cleaned rows; NaN never appears."""
    clean(df).write.mode(mode).option("ignoreNullFields", False).json(path)


def append_table(spark: SparkSession, path: str, new: DataFrame, append: bool) -> DataFrame:
    """Add rows to a Parquet table, widening its columns; without ``append`` an existing table is refused.

    The existing rows are not rewritten: new files carry the wider schema and readers merge them.
    """
    new.write.mode("append" if append else "errorifexists").parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


#: Files a task may have open at once.
OPEN_FILES = 32


def split_sink(df: DataFrame, path: str, by: list[str], mode: str = "errorifexists") -> None:
    """One folder per combination of the partition columns.

    Rows are rebalanced by the partition columns: adaptive execution splits a dominant combination over as many writers
    as its size asks for, and joins small ones. A task writes as it reads, a file open for each of its combinations, and sorts only rows of
    combinations beyond the first ``OPEN_FILES``; sorted as a whole, they would be in its memory.
    """
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, OPEN_FILES)
    try:
        df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).json(path)
    finally:
        conf.set(name, before)


def explode_references(df: DataFrame, references: str, name: str) -> DataFrame:
    """One copy of a row per reference (many-to-many addenda), ready for ``split_sink``."""
    return df.withColumn(name, F.explode(references)).drop(references)


__all__ = ["append_table", "arrange", "clean", "explode_references", "flat_text", "sink_json", "sink_table", "split_sink", "union_tables", "work_dir"]
