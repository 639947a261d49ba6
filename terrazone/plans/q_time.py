"""Interval aggregation, over events as native observations: layer = event type, cell = user, value = event
value, cell area = user number mod 7 + 1, cadence chosen by user number."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import timecols as tc
from ..operators import timeagg as ta
from .registry import query, rnd, rounded, table

TS = "yyyy-MM-dd HH:mm:ss"
CADENCES = ["daily", "dekadal", "16day", "monthly"]


def text(df, cols, fmt=TS):
    return df.withColumns({c: F.date_format(F.col(c).cast("timestamp"), fmt) for c in cols})


@query("interval_end", """WITH s AS (SELECT DISTINCT date_trunc('day', l_shipdate) d, l_linenumber % 4 c FROM lineitem),
 x AS (SELECT d, CASE c WHEN 0 THEN 'daily' WHEN 1 THEN 'dekadal' WHEN 2 THEN '16day' ELSE 'monthly' END cadence FROM s),
 y AS (SELECT d, cadence, CASE cadence WHEN 'daily' THEN d + INTERVAL 1 DAY WHEN 'monthly' THEN date_trunc('month', d) + INTERVAL 1 MONTH
   WHEN '16day' THEN least(d + INTERVAL 16 DAY, date_trunc('year', d) + INTERVAL 1 YEAR)
   ELSE CASE WHEN day(d) IN (1, 11) THEN d + INTERVAL 10 DAY WHEN day(d) = 21 THEN date_trunc('month', d) + INTERVAL 1 MONTH END END e FROM x)
 SELECT strftime(d, '%Y-%m-%d %H:%M:%S') start, cadence, strftime(e, '%Y-%m-%d %H:%M:%S') interval_end, CASE WHEN e IS NULL THEN 'INVALID_START' ELSE 'OK' END interval_status FROM y""")
def interval_end(spark, d):
    c = F.element_at(F.array(*[F.lit(x) for x in CADENCES]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    starts = table(spark, d, "lineitem").select(F.date_trunc("day", F.col("l_shipdate").cast("timestamp")).alias("start"), c.alias("cadence")).distinct()
    return text(ta.with_interval_end(starts, "start", "cadence"), ["start", "interval_end"])


@query("expected_count", """WITH s AS (SELECT DISTINCT o_orderdate::DATE a, (o_orderdate + to_days(((o_custkey % 97) + 1)::INT))::DATE b FROM orders),
 q AS (SELECT a, b, unnest(['daily', 'dekadal', '16day', 'monthly']) cadence FROM s),
 cal AS (SELECT day::DATE d FROM generate_series(DATE '1995-01-01', DATE '2003-01-01', INTERVAL 1 DAY) t(day)),
 st AS (SELECT d s, CASE c WHEN 'daily' THEN d + 1 WHEN 'monthly' THEN (d + INTERVAL 1 MONTH)::DATE WHEN '16day' THEN least(d + 16, (date_trunc('year', d) + INTERVAL 1 YEAR)::DATE)
     ELSE CASE WHEN day(d) < 21 THEN d + 10 ELSE (date_trunc('month', d) + INTERVAL 1 MONTH)::DATE END END e, c FROM cal, (VALUES ('daily'), ('dekadal'), ('16day'), ('monthly')) v(c)
   WHERE c = 'daily' OR (c = 'monthly' AND day(d) = 1) OR (c = 'dekadal' AND day(d) IN (1, 11, 21)) OR (c = '16day' AND (dayofyear(d) - 1) % 16 = 0))
 SELECT strftime(a, '%Y-%m-%d') start, strftime(b, '%Y-%m-%d') "end", cadence, count(*) expected FROM q JOIN st ON st.c = q.cadence AND st.s < q.b AND st.e > q.a GROUP BY ALL""")
def expected_count(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("start"), F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 97 + 1).cast("int")).alias("end")).distinct()
    q = o.select("*", F.explode(F.array(*[F.lit(c) for c in CADENCES])).alias("cadence"))
    return text(q.withColumn("expected", tc.expected_count("start", "end", "cadence")), ["start", "end"], "yyyy-MM-dd")


@query("period_calendar", """WITH s AS (SELECT user_id, date_trunc('second', min(ts)) a, date_trunc('second', max(ts)) b FROM events GROUP BY 1 HAVING date_trunc('second', max(ts)) > date_trunc('second', min(ts))),
 m AS (SELECT user_id, a, b, unnest(generate_series(date_trunc('month', a), date_trunc('month', b - INTERVAL 1 SECOND), INTERVAL 1 MONTH)) m FROM s)
 SELECT user_id, strftime(greatest(a, m), '%Y-%m-%d %H:%M:%S') period_start, strftime(least(b, m + INTERVAL 1 MONTH), '%Y-%m-%d %H:%M:%S') period_end FROM m""")
def period_calendar(spark, d):
    s = table(spark, d, "events").groupBy("user_id").agg(F.date_trunc("second", F.min("ts")).alias("a"), F.date_trunc("second", F.max("ts")).alias("b"))
    return text(ta.period_calendar(s, "a", "b").select("user_id", "period_start", "period_end"), ["period_start", "period_end"])


def observations(spark, d):
    """Orders as intervals of 1 to 43 days: layer = status, cell = customer, rate = square root of the price (so that no rounding tie occurs)."""
    o = table(spark, d, "orders")
    start = F.col("o_orderdate").cast("timestamp")
    return o.select(F.col("o_orderstatus").alias("layer_id"), F.col("o_custkey").alias("cell_id"), start.alias("interval_start"),
                    (F.to_date("o_orderdate") + (F.col("o_custkey") % 22 * 2 + 1).cast("int")).cast("timestamp").alias("interval_end"),
                    F.when(F.col("o_orderkey") % 11 != 0, F.sqrt("o_totalprice")).alias("value"),
                    (F.col("o_custkey") % 7 + 1).cast("double").alias("weight"),
                    F.when(F.col("o_orderstatus") == "F", "sum_amount").when(F.col("o_orderstatus") == "O", "integrate_rate").otherwise("duration_mean").alias("method"))


OBS = """WITH o AS (SELECT o_orderstatus layer_id, o_custkey cell_id, o_orderdate s, o_orderdate + to_days((o_custkey % 22 * 2 + 1)::INT) e, CASE WHEN o_orderkey % 11 <> 0 THEN sqrt(o_totalprice) END v, (o_custkey % 7 + 1)::DOUBLE w,
   CASE o_orderstatus WHEN 'F' THEN 'sum_amount' WHEN 'O' THEN 'integrate_rate' ELSE 'duration_mean' END method FROM orders),
 cal AS (SELECT m a, m + INTERVAL 1 MONTH b FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2002-12-01', INTERVAL 1 MONTH) t(m)),
 x AS (SELECT *, date_diff('day', greatest(s, a), least(e, b)) ov FROM o JOIN cal ON s < b AND e > a)"""


@query("interval_overlap", f"""{OBS} SELECT layer_id, strftime(a, '%Y-%m') period, count(*) touched, sum(ov)::DOUBLE overlap FROM x GROUP BY ALL""")
def interval_overlap(spark, d):
    o = ta.interval_overlap(observations(spark, d), "interval_start", "interval_end")
    return o.groupBy("layer_id", F.date_format("period_start", "yyyy-MM").alias("period")).agg(F.count("*").alias("touched"), F.sum("overlap_days").alias("overlap"))


AGG = f"""{OBS}, g AS (SELECT layer_id, cell_id, a, b, any_value(w) w, any_value(method) method, coalesce(sum(ov) FILTER (WHERE v IS NOT NULL), 0) cov,
   sum(v * CASE method WHEN 'sum_amount' THEN ov / date_diff('day', s, e) ELSE ov END) sm FROM x GROUP BY layer_id, cell_id, a, b),
 h AS (SELECT *, CASE WHEN method = 'duration_mean' THEN sm / nullif(cov, 0) ELSE sm END val, cov / date_diff('day', a, b) comp FROM g)"""


def monthly(spark, d):
    return ta.aggregate_interval(observations(spark, d), ["layer_id"], "cell_id", "interval_start", "interval_end", "value", "method", carry=["weight"])


@query("aggregate_interval", f"""{AGG} SELECT layer_id, cell_id, strftime(a, '%Y-%m') period, w weight, cov::DOUBLE covered_days, round(val, 2) aggregated FROM h""")
def aggregate_interval(spark, d):
    m = monthly(spark, d)
    return m.select("layer_id", "cell_id", F.date_format("period_start", "yyyy-MM").alias("period"), "weight", "covered_days", rnd("aggregated", 2).alias("aggregated"))


@query("completeness_gate", f"""{AGG} SELECT layer_id, strftime(a, '%Y-%m') period, count(*) cells, count(*) FILTER (WHERE comp >= .9 AND cov > 0) accepted,
  round(sum(val) FILTER (WHERE comp >= .9 AND cov > 0), 2) accepted_sum, round(avg(comp), 6) mean_completeness FROM h GROUP BY ALL""")
def completeness_gate(spark, d):
    m = ta.completeness_gate(monthly(spark, d), 0.9)
    return m.groupBy("layer_id", F.date_format("period_start", "yyyy-MM").alias("period")).agg(
        F.count("*").alias("cells"), F.count_if("accepted").alias("accepted"), rnd(F.sum("aggregated"), 2).alias("accepted_sum"), rnd(F.avg("completeness"), 6).alias("mean_completeness"))


@query("zone_month_value", f"""{AGG}, z AS (SELECT layer_id, a, b, any_value(method) method, coalesce(sum(w) FILTER (WHERE comp >= .25 AND cov > 0), 0) acc, sum(w * val) FILTER (WHERE comp >= .25 AND cov > 0) wx,
   sum(w * comp) wc, coalesce(bool_or(comp >= .25 AND cov > 0 AND comp < 1 - 1e-10), false) part FROM h GROUP BY layer_id, a, b),
 q AS (SELECT *, date_diff('day', a, b)::DOUBLE nd, CASE WHEN acc / 800 >= .02 THEN wx / nullif(acc, 0) END val FROM z),
 r AS (SELECT layer_id, strftime(a, '%Y-%m') period, round(val, 2) "value", round(100 * acc / 800, 6) spatial_coverage_percentage, round(100 * wc / 800, 6) temporal_coverage_percentage,
  round(wc / 800 * nd, 6) covered_days_area_weighted, nd expected_days, CASE WHEN val IS NULL THEN 'INSUFFICIENT_COVERAGE' WHEN part AND method <> 'duration_mean' THEN 'PARTIAL_TOTAL' WHEN part THEN 'PARTIAL_PERIOD' ELSE 'OK' END quality_flag FROM q),
 n AS (SELECT layer_id, a, count(DISTINCT s) c FROM x WHERE v IS NOT NULL GROUP BY ALL)
 SELECT l.layer_id, strftime(m.a, '%Y-%m') period, r."value", coalesce(r.spatial_coverage_percentage, 0) spatial_coverage_percentage, coalesce(r.temporal_coverage_percentage, 0) temporal_coverage_percentage,
  coalesce(r.covered_days_area_weighted, 0) covered_days_area_weighted, date_diff('day', m.a, m.b)::DOUBLE expected_days, coalesce(r.quality_flag, 'INSUFFICIENT_COVERAGE') quality_flag,
  coalesce(n.c, 0) observation_count, date_diff('day', m.a, m.b) expected_observation_count
 FROM (SELECT DISTINCT layer_id FROM o) l CROSS JOIN (SELECT a, a + INTERVAL 1 MONTH b FROM generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2003-12-01', INTERVAL 1 MONTH) g(a)) m
 LEFT JOIN r ON r.layer_id = l.layer_id AND r.period = strftime(m.a, '%Y-%m') LEFT JOIN n ON n.layer_id = l.layer_id AND n.a = m.a""")
def zone_month_value(spark, d):
    m = ta.completeness_gate(monthly(spark, d), 0.25, "weight")
    method = F.when(F.col("layer_id") == "F", "sum_amount").when(F.col("layer_id") == "O", "integrate_rate").otherwise("duration_mean")
    out = ta.zone_month_value(m.withColumn("method", method), ["layer_id"], "weight", F.lit(800.0), "method", 0.02)
    seen = ta.observation_counts(observations(spark, d), ["layer_id"], "interval_start", "interval_end", "value", "weight")
    spans = observations(spark, d).select("layer_id").distinct().withColumns({"first": F.lit("1994-01-01").cast("timestamp"), "last": F.lit("2004-01-01").cast("timestamp")})
    out = ta.every_month(out, ["layer_id"], spans, "first", "last", seen, F.lit("daily"))
    out = out.withColumn("period", F.date_format("period_start", "yyyy-MM")).drop("period_start", "period_end")
    return rounded(rounded(out, ["value"], 2), ["spatial_coverage_percentage", "temporal_coverage_percentage", "covered_days_area_weighted"], 6)


@query("observation_count", f"""{OBS} SELECT layer_id, strftime(a, '%Y-%m') period, count(DISTINCT s) observation_count FROM x WHERE v IS NOT NULL GROUP BY ALL""")
def observation_count(spark, d):
    out = ta.observation_counts(observations(spark, d), ["layer_id"], "interval_start", "interval_end", "value", "weight")
    return out.select("layer_id", F.date_format("period_start", "yyyy-MM").alias("period"), "observation_count")


@query("point_month_value", """WITH o AS (SELECT event_type layer_id, date_trunc('day', ts) s, avg(CASE WHEN value > 1 THEN value END) v FROM events GROUP BY 1, 2), g AS (SELECT layer_id, date_trunc('month', s) a, count(v) cov, sum(v) sm FROM o GROUP BY 1, 2),
 q AS (SELECT *, date_diff('day', a, a + INTERVAL 1 MONTH)::DOUBLE nd FROM g)
 , r AS (SELECT layer_id, a, CASE WHEN cov / nd >= .9 - 1e-10 THEN round(sm, 4) END "value", NULL::DOUBLE spatial_coverage_percentage, round(100 * cov / nd, 6) temporal_coverage_percentage,
  cov::DOUBLE covered_days_area_weighted, nd expected_days, CASE WHEN cov / nd < .9 - 1e-10 THEN 'INSUFFICIENT_COVERAGE' WHEN cov < nd THEN 'PARTIAL_TOTAL' ELSE 'OK' END quality_flag FROM q)
 SELECT l.layer_id, strftime(m.a, '%Y-%m') period, r."value", CASE WHEN r.a IS NULL THEN 0::DOUBLE END spatial_coverage_percentage, coalesce(r.temporal_coverage_percentage, 0) temporal_coverage_percentage,
  coalesce(r.covered_days_area_weighted, 0) covered_days_area_weighted, date_diff('day', m.a, m.a + INTERVAL 1 MONTH)::DOUBLE expected_days, coalesce(r.quality_flag, 'INSUFFICIENT_COVERAGE') quality_flag
 FROM (SELECT DISTINCT layer_id FROM o) l CROSS JOIN (SELECT a FROM generate_series((SELECT date_trunc('month', min(ts)) - INTERVAL 2 MONTH FROM events), (SELECT date_trunc('month', max(ts)) + INTERVAL 1 MONTH FROM events), INTERVAL 1 MONTH) g(a)) m
 LEFT JOIN r ON r.layer_id = l.layer_id AND r.a = m.a""")
def point_month_value(spark, d):
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    daily = table(spark, d, "events").groupBy(F.col("event_type").alias("layer_id"), day.alias("s")).agg(F.avg(F.when(F.col("value") > 1, F.col("value"))).alias("value"))
    obs = daily.withColumn("e", tc.interval_end("s", F.lit("daily")))
    out = ta.point_month_value(obs, ["layer_id"], "s", "e", "value", F.lit("integrate_rate"))
    month = F.date_trunc("month", F.col("ts").cast("timestamp"))
    span = table(spark, d, "events").agg(F.min(month).alias("low"), F.max(month).alias("high")).select((F.col("low") - F.expr("INTERVAL 2 MONTH")).alias("first"), (F.col("high") + F.expr("INTERVAL 2 MONTH")).alias("last"))
    keys = daily.select("layer_id").distinct().withColumn("one", F.lit(1)).join(span.withColumn("one", F.lit(1)), "one")
    out = ta.every_month(out, ["layer_id"], keys, "first", "last")
    out = out.withColumn("period", F.date_format("period_start", "yyyy-MM")).drop("period_start", "period_end")
    return rounded(rounded(out, ["value"]), ["temporal_coverage_percentage", "covered_days_area_weighted"], 6)


@query("interval_conflicts", """WITH o AS (SELECT o_custkey series, o_orderdate s, CASE WHEN o_orderkey % 50 = 0 THEN o_orderdate ELSE o_orderdate + to_days((o_custkey % 45 + 1)::INT) END e FROM orders),
 g AS (SELECT series, s, count(*) n, max(e) e, count(*) FILTER (WHERE e <= s) inv FROM o GROUP BY 1, 2), l AS (SELECT *, lead(s) OVER (PARTITION BY series ORDER BY s) nx FROM g)
 SELECT series, sum(n)::BIGINT interval_count, sum(inv)::BIGINT inverted_count, sum(n - 1)::BIGINT duplicate_start_count, count(*) FILTER (WHERE nx < e) overlap_count,
  CASE WHEN sum(inv) + sum(n - 1) + count(*) FILTER (WHERE nx < e) > 0 THEN 'REJECTED' ELSE 'OK' END status FROM l GROUP BY 1""")
def interval_conflicts(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("series"), F.col("o_orderdate").alias("s"),
        F.when(F.col("o_orderkey") % 50 == 0, F.col("o_orderdate").cast("timestamp")).otherwise((F.to_date("o_orderdate") + (F.col("o_custkey") % 45 + 1).cast("int")).cast("timestamp")).alias("e"))
    return ta.interval_conflicts(o, ["series"], "s", "e", "year")


@query("series_key_unique", """SELECT l_returnflag layer_id, l_linestatus "variable", strftime(l_shipdate, '%Y-%m-%d') interval_start, l_quantity interval_end, l_linenumber spatial_statistic, CASE WHEN l_tax > .02 THEN l_tax END temporal_aggregation,
  l_discount depth, l_suppkey % 3 management_code, NULL::INT climate_scenario, count(*) row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def series_key_unique(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("layer_id"), F.col("l_linestatus").alias("variable"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("interval_start"),
        F.col("l_quantity").alias("interval_end"), F.col("l_linenumber").alias("spatial_statistic"), F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("temporal_aggregation"),
        F.col("l_discount").alias("depth"), (F.col("l_suppkey") % 3).alias("management_code"), F.lit(None).cast("int").alias("climate_scenario"))
    return ta.series_key_unique(rows)


@query("latest_record", """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') first_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S') last_time, count(*) record_count,
  arg_max(event_id, (ts, event_id)) event_id, arg_max(event_type, (ts, event_id)) event_type FROM events GROUP BY 1""")
def latest_record(spark, d):
    return text(ta.latest_record(table(spark, d, "events"), ["user_id"], "ts", ["event_id", "event_type"], tie="event_id"), ["first_time", "last_time"])
