"""Sharding by weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import key_slice, uniform_key

#: Ranges of the key space in which the rows of a shard are numbered apart.
SLICES = 1024


def shard_scores(key, weights: list[float]) -> Column:
    """An array of (score, shard), one for each shard; the smallest score wins.

    Shard s draws a uniform u from the MD5 of key and s (four shards share one digest) and scores -ln(u) / weight. A shard's score
    depends on nothing but the key, the shard and its weight: with one more shard a row either stays or moves to the new one, and
    a shard of twice the weight receives twice the rows. A null key is a key of its own.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above zero")
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit("~"))
    digests = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(math.ceil(len(weights) / 4) - 1)), lambda b: F.md5(F.concat_ws(":", text, b.cast("string")))), "")
    of = F.array(*[F.lit(float(w)) for w in weights])

    def score(hexes: Column, s: Column) -> Column:
        drawn = F.conv(F.substring(hexes, s * 8 + 1, F.lit(8)), 16, 10).cast("double")
        return F.struct((-F.log((drawn + 0.5) / F.lit(2.0**32)) / F.get(of, s)).alias("score"), s.alias("shard"))

    shards = F.sequence(F.lit(0), F.lit(len(weights) - 1))
    return F.get(F.transform(F.array(digests), lambda h: F.transform(shards, lambda s: score(h, s))), F.lit(0))


def assign(df: DataFrame, key: str, weights: list[float], name: str = "shard", grown: float | None = None, grown_name: str = "grown_shard") -> DataFrame:
    """Add the shard of each row, and with ``grown`` the shard it would have with one more shard of that weight.

    Only the key decides: rows with equal keys (repeated rows, or null keys) share a shard. Other columns pass through; columns
    that are already called like the new ones are replaced. A pure projection, without a shuffle.
    """
    scores = shard_scores(key, [*weights, *([grown] if grown else [])])
    df = df.withColumn("__scores", F.explode(F.array(scores)))  # evaluated once for both columns
    out = df.withColumn(name, F.array_min(F.slice("__scores", 1, len(weights))).getField("shard").cast("int"))
    return (out.withColumn(grown_name, F.array_min("__scores").getField("shard").cast("int")) if grown else out).drop("__scores")


def number_slots(df: DataFrame, shard: str, by: list[str], name: str = "slot", slices: int = SLICES) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in the order of a uniform key over the ``by`` columns.

    The key space is cut into ``slices`` equal ranges. Counts of shard and range are summed up along the ranges, and rows are
    ordered only inside a range, so no shard is ever sorted as a whole. Rows equal in all ``by`` columns get neighbouring slots.
    """
    keyed = df.withColumn("__key", uniform_key(*by)).withColumn("__slice", key_slice(F.col("__key"), slices))
    before = Window.partitionBy(shard).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (keyed.groupBy(shard, "__slice").agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    inside = Window.partitionBy(shard, "__slice").orderBy("__key", *by)
    numbered = keyed.withColumn("__place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, [shard, "__slice"]).withColumn(name, (F.col("__offset") + F.col("__place")).cast("long")).drop("__key", "__slice", "__place", "__offset")


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder of Parquet files per shard, written where the rows are."""
    df.write.partitionBy(shard).parquet(path)
