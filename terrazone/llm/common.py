"""What several operators here share: tables in the cluster's shared folder, model files, uniform keys."""

from __future__ import annotations

import os
import uuid

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space; everything between is a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits, a power of two, of the table that says which hashes keys have; 64 of them are one of its rows.
MARKS = 1 << 24


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which driver and executors share; below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def let_workers_import(spark: SparkSession) -> None:
    """Python workers look for this package also where the driver found it; elsewhere it must be installed or sent by ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def stash(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back: the lineage ends there and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete stashed tables that nothing reads any more."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def marked(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``df`` with ``__marked``: false where its key is none of the column ``key`` of ``keys``, true where it may be one.

    The hashes of the keys are a bitmap of bounded size, which is broadcast. With very many keys it rules out less.
    """
    mark = F.xxhash64(key).bitwiseAND(F.lit(MARKS - 1))
    bits = keys.select(mark.alias("m")).groupBy(F.shiftright("m", 6).alias("__slot")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(m & 63 AS INT))")).alias("__bits"))
    out = df.withColumn("__m", mark).join(F.broadcast(bits), F.shiftright("__m", 6) == F.col("__slot"), "left")
    return out.withColumn("__marked", F.expr("coalesce(shiftright(__bits, CAST(__m & 63 AS INT)) & 1, 0L) = 1")).drop("__m", "__slot", "__bits")


def having(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is in the column ``key`` of ``keys``. Rows are shuffled only where their key may be one, and at every size alike."""
    found = marked(df, key, keys).where("__marked").drop("__marked")
    return found.join(keys.select(key).distinct().hint("merge"), key, "left_semi").select(*[f"`{c}`" for c in df.columns])


def without(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is null or not in the column ``key`` of ``keys``; others than those that may be are not shuffled."""
    rows = marked(df, key, keys)
    columns = [f"`{c}`" for c in df.columns]
    rest = rows.where("__marked").join(keys.select(key).distinct().hint("merge"), key, "left_anti")
    return rows.where("NOT __marked").select(*columns).unionByName(rest.select(*columns))


def model_bytes(path: str | None = None, name: str = "piece_bpe_32k.model") -> bytes:
    """A tokenizer file, read on the driver; it is at most a few MB and is sent to the executors as a broadcast value."""
    with open(path or public_tokenizers.path(name), "rb") as f:
        return f.read()


def uniform_key(*parts) -> Column:
    """32 hex digits, uniform and stable: the MD5 of the parts as text, a null part counting as ``~``."""
    return F.md5(F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("~")) for p in parts]))


def key_slice(key: Column, slices: int) -> Column:
    """The range 0..slices-1 of the key space that holds a uniform key; its order is the order of the keys."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(slices) / F.lit(2.0**32)).cast("int")


def bounded_sample(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """At most ``rows`` distinct rows, those of the smallest hash of the ``by`` columns; deterministic, and repeated rows count once.

    The hash at the limit is found among distinct hashes (8 bytes a row are shuffled); the rows themselves are only filtered.
    """
    h = F.xxhash64(*by)
    last = df.select(h.alias("h")).distinct().orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.withColumn("__h", h).where(F.col("__h") <= F.lit(last)).dropDuplicates(["__h"]).drop("__h")


class KeyIndex:
    """Positions of 64-bit keys (none below 0) by open addressing, for looking up whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys, self.at = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        left, slot, mask = np.arange(len(keys)), self.slot(keys), (1 << self.bits) - 1
        while len(left):
            free = self.keys[slot] == -1
            won = np.unique(slot[free], return_index=True)[1]  # of the keys that want a free slot the first gets it
            won = np.flatnonzero(free)[won]
            self.keys[slot[won]], self.at[slot[won]] = keys[left[won]], left[won]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, slot = left[rest], (slot[rest] + 1) & mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, or -1."""
        slot = self.slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.at[slot], -1)
        left = np.flatnonzero((there != keys) & (there != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.at[slot[left[hit]]]
            left = left[~hit & (there != -1)]
        return out
