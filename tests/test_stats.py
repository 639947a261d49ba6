import math
import random

import pytest
from pyspark.sql import functions as F

from terrazone.functions import scalars as fs
from terrazone.operators import stats

NAN = float("nan")


def summary(spark, data):
    df = spark.createDataFrame(data, "k string, value double, weight double")
    return {r["k"]: r.asDict() for r in stats.weighted_summary(df, ["k"], "value", "weight").collect()}


def test_weighted_summary_golden(spark):
    s = summary(spark, [("a", 0.0, 1.0), ("a", 10.0, 2.0), ("a", 20.0, 1.0), ("one", 7.0, 1.0), ("none", NAN, 1.0), ("none", None, 2.0), ("none", 5.0, 0.0)])
    a = s["a"]
    assert (a["mean"], a["median"], a["p25"], a["p95"], a["min"], a["max"]) == (10, 10, 0, 20, 0, 20)
    assert a["std"] == pytest.approx(math.sqrt(50)) and a["quality_flag"] == "FEW_NATIVE_CELLS"
    assert s["one"]["std"] == 0 and s["one"]["median"] == 7
    assert s["none"]["quality_flag"] == "NO_VALID_DATA" and s["none"]["mean"] is None and s["none"]["p05"] is None


def reference_summary(data):
    data = sorted((x, w) for x, w in data if w > 0)
    total = sum(w for _, w in data)
    mean = sum(x * w for x, w in data) / total
    out = {"mean": mean, "std": math.sqrt(sum(w * (x - mean) ** 2 for x, w in data) / total)}
    for name, p in stats.PROBABILITIES.items():
        run, out[name] = 0.0, data[-1][0]
        for x, w in data:
            run += w
            if run / total >= p:
                out[name] = x
                break
    return out


def test_many_values_outliers_and_clusters(spark):
    rng = random.Random(7)
    data = {"hot": [(rng.lognormvariate(0, 4) * rng.choice([-1, 1]), float(rng.randint(1, 9))) for _ in range(5000)],
            "copies": [(3.0, 1.0)] * 900 + [(4.0, 2.0)] * 90 + [(1e100, 1.0)],
            "cluster": [(1e9 + rng.random(), 1.0) for _ in range(2000)] + [(-1e12, 1.0)],
            "few": [(float(i), 1.0) for i in range(9)], "zero": [(0.0, 1.0)] * 200}
    got = summary(spark, [(k, x, w) for k, v in data.items() for x, w in v])
    for k, v in data.items():
        want = reference_summary(v)
        for name in stats.PROBABILITIES:
            assert got[k][name] == want[name], (k, name)
        assert got[k]["mean"] == pytest.approx(want["mean"], rel=1e-12)
        assert got[k]["std"] == pytest.approx(want["std"], rel=1e-9)


def test_building_a_summary_starts_no_job_and_nulls_are_not_ordered(spark):
    """A key of 99.9 % missing values: only valid rows reach the step that orders them."""
    df = spark.range(50_000).select(F.lit("k").alias("k"), F.when(F.col("id") % 1000 == 0, F.col("id").cast("double")).alias("value"), F.lit(1.0).alias("weight"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    out = stats.weighted_summary(df, ["k"], "value", "weight")
    assert tracker.getJobIdsForGroup("build") == []
    assert stats.raster_stats_unweighted(df, ["k"], "value") is not None and tracker.getJobIdsForGroup("build") == []
    spark.sparkContext.setJobGroup("other", "other")
    r = out.first()
    assert (r["min"], r["max"], r["median"]) == (0.0, 49_000.0, 24_000.0)


def test_keyless_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0), (None, 3.0, 1.0), ("b", 5.0, 2.0)], "k string, value double, weight double")
    whole = stats.weighted_summary(df, [], "value", "weight").first()
    assert whole["mean"] == 3.5 and whole["median"] == 3.0
    per = {r["k"]: r for r in stats.weighted_summary(df, ["k"], "value", "weight").collect()}
    assert per[None]["mean"] == 2.0 and per["b"]["max"] == 5.0


def test_unweighted_median_averages_the_middle_pair(spark):
    df = spark.createDataFrame([("e", float(x)) for x in (1, 2, 4, 9)] + [("o", float(x)) for x in (5, 1, 3)], "k string, v double")
    got = {r["k"]: r for r in stats.raster_stats_unweighted(df, ["k"], "v").collect()}
    assert got["e"]["median"] == 3.0 and got["o"]["median"] == 3.0


def test_decode_cells_golden(spark):
    df = spark.createDataFrame([(0.0, 255, 1.0), (99.0, 0, 1.0)], "raw double, mask int, weight double")
    out = stats.decode_cells(df, "raw", F.col("mask") > 0, "weight", 2.0, 5.0).collect()
    assert [(r["valid"], r["value"]) for r in out] == [(True, 5.0), (False, None)]
    scaled = stats.decode_cells(df, "raw", F.col("mask") > 0, "weight", 2.0, 5.0, already_scaled=True).collect()
    assert scaled[0]["value"] == 0.0


def test_class_area_golden(spark):
    df = spark.createDataFrame([("l", 1, 2.0), ("l", 2, 1.0), ("l", None, 1.0)], "layer string, c int, w double").withColumn("zone", F.lit(4.0))
    legend = spark.createDataFrame([(1, "one"), (2, "two")], "code int, caption string")
    got = {r["class_code"]: r for r in stats.class_area(df, ["layer"], "c", "w", legend, "zone").collect()}
    assert got[1]["percentage_of_valid_area"] == pytest.approx(200 / 3) and got[1]["percentage_of_zone"] == 50
    bad = stats.class_area(spark.createDataFrame([("l", 3, 1.0)], "layer string, c int, w double"), ["layer"], "c", "w", legend).first()
    assert bad["status"] == "UNKNOWN_CLASS"
    assert stats.class_area(spark.createDataFrame([("l", 1.5, 1.0)], "layer string, c double, w double"), ["layer"], "c", "w", legend).first()["status"] == "UNKNOWN_CLASS"


def test_pooled_domain_and_area_accounting(spark):
    df = spark.createDataFrame([("x", 5.0), ("x", 8.0), ("x", 10.0), ("y", 7.0)], "k string, v double")
    got = {r["k"]: r for r in stats.pooled_domain(df, ["k"], "v").collect()}
    assert (got["x"]["domain_min"], got["x"]["domain_max"], got["x"]["constant"]) == (5, 10, False)
    assert got["y"]["constant"] and (got["y"]["display_min"], got["y"]["display_max"]) == (6.5, 7.5)
    cells = spark.createDataFrame([("l", 1.0, True, 2.0), ("l", 1.0, False, 2.0)], "k string, w double, ok boolean, z double")
    a = stats.area_accounting(cells, ["k"], "w", "ok", "z").first()
    assert (a["valid_area"], a["masked_area"], a["outside_area"], a["valid_area_percentage"], a["status"]) == (1, 1, 0, 50, "OK")
    over = stats.area_accounting(cells.withColumn("z", F.lit(1.5)), ["k"], "w", "ok", "z").first()
    assert over["status"] == "AREA_ACCOUNTING_FAILED"


def test_range_and_value_rules(spark):
    df = spark.createDataFrame([("a", 5.0, True), ("a", 12.0, True), ("b", 12.0, False), ("c", None, True)], "k string, v double, ok boolean")
    got = {r["k"]: r["status"] for r in stats.range_gate(df, ["k"], "v", "ok", 0.0, 10.0).collect()}
    assert got == {"a": "QA_FAILED", "b": "OK", "c": "OK"}
    v = spark.createDataFrame([("a", "class", 1.5), ("b", "share", 101.0), ("c", "non_negative", 0.0), ("d", "class_1_9", 9.0), ("e", "share", None)], "k string, r string, v double")
    got = {r["k"]: r["status"] for r in stats.value_rule(v, ["k", "r"], "v", "r").collect()}
    assert got == {"a": "FAILED_VALUE_RULE", "b": "FAILED_VALUE_RULE", "c": "VERIFIED", "d": "VERIFIED", "e": "FAILED_NO_VALID_CELLS"}


def test_bins_and_tolerances(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.5,), (40.0,), (None,)], "v double")
    assert [r[0] for r in df.select(fs.bin_index("v", [10, 20])).collect()] == [0, 0, 1, 2, None]
    assert [r[0] for r in df.select(fs.equal_bins("v", 0.0, 40.0)).collect()] == [0, 1, 1, 3, None]
    assert df.select(fs.equal_bins("v", 5.0, 5.0)).first()[0] == 2
    pair = spark.createDataFrame([(1.0, 1.0 + 1e-9), (1.0, 1.1), (None, None), (1.0, None), (0.0, 5e-9)], "a double, b double")
    assert [r[0] for r in pair.select(fs.same_or_close("a", "b")).collect()] == [True, False, True, False, True]


def test_many_distinct_values_and_partitions_joined_by_size(spark):
    """Split points worked out twice, from partial results that arrive in another order, must be the same ones."""
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        df = spark.range(0, 1_000_000, 1, 8).select((F.col("id") % 3).alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10_000_000)) / 100).alias("value"), (F.col("id") % 50 + 1).cast("double").alias("weight"))
        got = {r["k"]: r for r in stats.weighted_summary(df, ["k"], "value", "weight").collect()}
        data = df.toPandas()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for k, own in data.groupby("k"):
        own = own.sort_values("value")
        cum = (own["weight"].cumsum() / own["weight"].sum()).to_numpy()
        for name, p in stats.PROBABILITIES.items():
            assert got[k][name] == own["value"].to_numpy()[(cum >= p).argmax()], (k, name)
