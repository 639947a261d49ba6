from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from terrazone.functions import timecols as tc
from terrazone.operators import timeagg as ta


def ts(*a):
    return datetime(*a)


def test_interval_end_golden(spark):
    df = spark.createDataFrame([(ts(2024, 2, 21), "dekadal"), (ts(2023, 2, 21), "dekadal"), (ts(2024, 1, 21), "dekadal"), (ts(2024, 1, 5), "dekadal"), (ts(2024, 12, 18), "16day"), (ts(2024, 1, 31), "monthly"), (ts(2024, 1, 1), "odd")], "s timestamp, c string")
    got = [r[0] for r in df.select(tc.days_between("s", tc.interval_end("s", F.col("c")))).collect()]
    assert got == [9, 8, 11, None, 14, 1, None]


def brute_expected(start, end, cadence):
    cur, n = date(start.year, 1, 1), 0
    while cur < end:
        nxt_month = date(cur.year + (cur.month == 12), cur.month % 12 + 1, 1)
        fin = {"daily": lambda: cur + timedelta(1), "monthly": lambda: nxt_month, "16day": lambda: min(cur + timedelta(16), date(cur.year + 1, 1, 1)),
               "dekadal": lambda: cur.replace(day=cur.day + 10) if cur.day < 21 else nxt_month}[cadence]()
        n += fin > start
        cur = fin
    return n


def test_expected_count_equals_the_stepped_calendar(spark):
    data = [(date(2023, 1, 1) + timedelta(37 * i), date(2023, 1, 1) + timedelta(37 * i + j), c) for i in range(20) for j in (1, 16, 45, 400) for c in ("daily", "dekadal", "16day", "monthly")]
    df = spark.createDataFrame(data, "s date, e date, c string")
    for r in df.select("s", "e", "c", tc.expected_count("s", "e", "c").alias("n")).collect():
        assert r["n"] == brute_expected(r["s"], r["e"], r["c"]), r


def series(spark, data, method):
    df = spark.createDataFrame(data, "layer_id string, cell_id int, s timestamp, e timestamp, value double, w double")
    cells = ta.aggregate_interval(df, ["layer_id"], "cell_id", "s", "e", "value", F.lit(method), carry=["w"])
    feb = ta.completeness_gate(cells, 0.9, "w").where(F.month("period_start") == 2).withColumn("method", F.lit(method))
    return ta.zone_month_value(feb, ["layer_id"], "w", F.lit(float(len({d[1] for d in data}))), "method").first()


def daily(missing=0):
    return [("l", c, ts(2024, 2, d), ts(2024, 2, d) + timedelta(1), None if c == 0 and d <= missing else 2.0, 1.0) for c in (0, 1) for d in range(1, 30)]


def test_month_aggregation_golden(spark):
    rate = series(spark, [("l", 0, ts(2024, 2, a), ts(2024, 2, b) if b else ts(2024, 3, 1), 2.0, 1.0) for a, b in ((1, 11), (11, 21), (21, None))], "integrate_rate")
    assert rate["value"] == 58 and rate["quality_flag"] == "OK"
    full = series(spark, daily(), "sum_amount")
    assert full["value"] == pytest.approx(58) and full["quality_flag"] == "OK"
    one = series(spark, daily(1), "sum_amount")
    assert one["value"] == pytest.approx(57) and one["quality_flag"] == "PARTIAL_TOTAL"
    many = series(spark, daily(5), "sum_amount")
    assert many["value"] is None and many["quality_flag"] == "INSUFFICIENT_COVERAGE" and many["spatial_coverage_percentage"] == 50


def test_intervals_crossing_the_month_start(spark):
    data = [("l", 0, ts(2024, 1, 25), ts(2024, 2, 10), 2.0, 1.0), ("l", 0, ts(2024, 2, 10), ts(2024, 3, 10), 4.0, 1.0)]
    assert series(spark, data, "integrate_rate")["value"] == 2 * 9 + 4 * 20
    assert series(spark, data, "duration_mean")["value"] == pytest.approx((2 * 9 + 4 * 20) / 29)


def test_conflicts_across_slices_and_inside(spark):
    df = spark.createDataFrame([("ok", ts(2024, 1, 1), ts(2024, 1, 31)), ("ok", ts(2024, 2, 1), ts(2024, 2, 2)), ("cross", ts(2024, 1, 20), ts(2024, 2, 5)), ("cross", ts(2024, 2, 1), ts(2024, 2, 9)),
                                ("dup", ts(2024, 1, 1), ts(2024, 1, 2)), ("dup", ts(2024, 1, 1), ts(2024, 1, 2)), ("inv", ts(2024, 1, 2), ts(2024, 1, 2)), ("in", ts(2024, 1, 1), ts(2024, 1, 9)), ("in", ts(2024, 1, 5), ts(2024, 1, 6))], "k string, s timestamp, e timestamp")
    got = {r["k"]: (r["overlap_count"], r["duplicate_start_count"], r["inverted_count"], r["status"]) for r in ta.interval_conflicts(df, ["k"], "s", "e").collect()}
    assert got == {"ok": (0, 0, 0, "OK"), "cross": (1, 0, 0, "REJECTED"), "dup": (0, 1, 0, "REJECTED"), "inv": (0, 0, 1, "REJECTED"), "in": (1, 0, 0, "REJECTED")}


def test_series_keys_and_overlap_null_guard(spark):
    row = ("l", "v", "a", "b", "m", "sum", None, None, None)
    ddl = ", ".join(f"{f} string" for f in ta.SERIES_KEY)
    assert ta.series_key_unique(spark.createDataFrame([row, ("l", "w", *row[2:])], ddl)).count() == 0
    assert ta.series_key_unique(spark.createDataFrame([row, row], ddl)).first()["row_count"] == 2
    df = spark.createDataFrame([(None, None, ts(2024, 1, 1), ts(2024, 1, 3))], "a timestamp, b timestamp, c timestamp, d timestamp")
    assert df.select(tc.overlap_days("a", "b", "c", "d")).first()[0] is None


def test_period_codes_and_utc_text(spark):
    df = spark.createDataFrame([("HP0120", "2024-01-02T03:04:05Z"), ("FP8100", "2024-01-02 03:04:05"), ("FP2140", "x")], "p string, t string")
    got = df.select(tc.period_years("p").alias("y"), F.date_format(tc.utc_timestamp("t"), "HH:mm:ss").alias("t")).collect()
    assert [(r["y"]["first_year"], r["y"]["last_year"]) for r in got] == [(2001, 2020), (2081, 2100), (2021, 2040)]
    assert [r["t"] for r in got] == ["03:04:05", "03:04:05", None]
