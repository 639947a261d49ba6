import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from terrazone.llm import sharding
from terrazone.llm.common import shared_path


def expected(key, weights):
    hexes = "".join(hashlib.md5(f"{key}:{b}".encode()).hexdigest() for b in range(math.ceil(len(weights) / 4)))
    return min(range(len(weights)), key=lambda s: -math.log((int(hexes[8 * s:8 * s + 8], 16) + 0.5) / 2**32) / weights[s])


def test_weights_and_growth(spark):
    weights = [1.0, 2.0, 1.0, 4.0, 2.0]
    rows = sharding.assign(spark.range(20_000).withColumnRenamed("id", "k"), "k", weights, grown=2.0).collect()
    assert all(r["shard"] == expected(r["k"], weights) and r["grown_shard"] == expected(r["k"], weights + [2.0]) for r in rows[:2000])
    assert all(r["grown_shard"] in (r["shard"], 5) for r in rows)
    shares = Counter(r["shard"] for r in rows)
    assert all(abs(shares[s] / 20_000 - w / 10) < 0.015 for s, w in enumerate(weights))
    assert abs(sum(r["grown_shard"] == 5 for r in rows) / 20_000 - 2 / 12) < 0.015


def test_slots_have_no_gaps(spark):
    df = spark.range(3000).select((F.col("id") % 7).cast("int").alias("shard"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.lit("x").alias("slot"))
    rows = sharding.number_slots(df, "shard", ["k"], slices=16).collect()
    for s in range(7):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))
    again = sharding.number_slots(df.repartition(5), "shard", ["k"], slices=16).where("k is not null").collect()
    assert {(r["k"], r["slot"]) for r in again} == {(r["k"], r["slot"]) for r in rows if r["k"] is not None}


def test_null_keys_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 1), (5, 1)], "k long, shard int")
    rows = sharding.assign(df, "k", [1.0] * 4).collect()
    assert len({r["shard"] for r in rows if r["k"] is None}) == 1 and len({r["shard"] for r in rows if r["k"] == 5}) == 1
    assert sharding.number_slots(sharding.assign(df.limit(0), "k", [1.0]), "shard", ["k"]).collect() == []


def test_written_shards(spark):
    path = shared_path(spark, "shards-test")
    sharding.write_shards(sharding.assign(spark.range(100), "id", [1.0] * 3), path)
    back = spark.read.parquet(path)
    assert back.count() == 100 and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2}
