"""Interval aggregation: native intervals to periods per cell, then cells to zones, with completeness gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import col, finite, join_null_safe, ratio
from ..functions.timecols import days_between, expected_count, interval_end, month_start, next_month, overlap_days

SERIES_KEY = ["layer_id", "variable", "interval_start", "interval_end", "spatial_statistic",
              "temporal_aggregation", "depth", "management_code", "climate_scenario"]   # fixed key of a series row
EPS = 1e-10


def with_interval_end(obs: DataFrame, start: str, cadence) -> DataFrame:
    """Add the end of the native interval; an impossible start for the cadence is flagged."""
    end = interval_end(start, cadence)
    return obs.withColumn("interval_end", end).withColumn("interval_status", F.when(end.isNull(), "INVALID_START").otherwise("OK"))


def period_calendar(spans: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month period [current, min(next month, end)) of every span."""
    s, e = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    months = F.sequence(month_start(s), month_start(e - F.expr("INTERVAL 1 MICROSECOND")), F.expr("INTERVAL 1 MONTH"))
    return (spans.where(e > s).withColumn("_m", F.explode(months))
            .withColumn("period_start", F.greatest(F.col("_m"), s))
            .withColumn("period_end", F.least(next_month("_m"), e)).drop("_m"))


def interval_overlap(obs: DataFrame, start: str, end: str, window_start=None, window_end=None) -> DataFrame:
    """Each observation once per month it touches, with the overlap in days.

    The months come from the observation itself, so the period range join is a plain projection:
    no shuffle and no comparison of every observation with every period. Optional bounds cut the
    first and last period; an observation that began before the window still contributes its part.
    """
    s, e = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    o = obs.where(s.isNotNull() & e.isNotNull() & (e > s))
    months = F.sequence(month_start(s), month_start(e - F.expr("INTERVAL 1 MICROSECOND")), F.expr("INTERVAL 1 MONTH"))
    o = o.withColumn("period_start", F.explode(months)).withColumn("period_end", next_month("period_start"))
    if window_start is not None:
        o = o.withColumn("period_start", F.greatest(F.col("period_start"), col(window_start)))
    if window_end is not None:
        o = o.withColumn("period_end", F.least(F.col("period_end"), col(window_end)))
    o = o.withColumn("overlap_days", overlap_days(start, end, "period_start", "period_end"))
    return o.where("overlap_days > 0")


def aggregate_interval(obs: DataFrame, keys: list[str], cell: str, start: str, end: str, value, method,
                       carry: list[str] = (), window_start=None, window_end=None) -> DataFrame:
    """Per cell and month: covered days and the aggregated value.

    ``sum_amount`` allocates by share of duration, ``integrate_rate`` multiplies by overlap days,
    ``duration_mean`` averages over covered days. Missing values cover nothing. ``carry`` columns (the
    cell weight, say) are constant per cell.
    """
    o = interval_overlap(obs, start, end, window_start, window_end)
    v, d, m = finite(value), F.col("overlap_days"), col(method)
    factor = F.when(m == "sum_amount", ratio(d, days_between(start, end))).when(m.isin("integrate_rate", "duration_mean"), d)
    agg = o.groupBy(*keys, cell, "period_start", "period_end").agg(
        *[F.max(c).alias(c) for c in carry], F.max(m).alias("_method"),
        F.coalesce(F.sum(F.when(v.isNotNull(), d)), F.lit(0.0)).alias("covered_days"),
        F.sum(v * factor).alias("_sum"))
    result = F.when(F.col("_method") == "duration_mean", ratio("_sum", "covered_days")).otherwise(F.col("_sum"))
    return agg.withColumn("aggregated", result).drop("_sum", "_method")


def completeness_gate(cells: DataFrame, minimum: float = 0.9, weight=1.0) -> DataFrame:
    """A cell-period is accepted when enough of the period is covered; otherwise its value is missing."""
    share = F.col("covered_days") / days_between("period_start", "period_end")
    ok = (share >= minimum - EPS) & (F.col("covered_days") > 0) & (col(weight) > 0)
    return cells.withColumns({"completeness": share, "accepted": ok, "aggregated": F.when(ok, F.col("aggregated"))})


def observation_counts(obs: DataFrame, keys: list[str], start: str, end: str, value, weight, window_start=None, window_end=None) -> DataFrame:
    """Per period: native intervals with at least one valid cell.

    Intervals are first reduced to distinct (key, period, start) with a map-side combine, then counted.
    """
    ok = finite(value).isNotNull() & (col(weight) > 0)
    o = interval_overlap(obs.where(ok), start, end, window_start, window_end)
    seen = o.groupBy(*keys, "period_start", "period_end", F.col(start).alias("_s")).agg(F.lit(1).alias("_one"))
    return seen.groupBy(*keys, "period_start", "period_end").agg(F.count("*").alias("observation_count"))


def every_month(months: DataFrame, keys: list[str], spans: DataFrame, start: str, end: str, counts: DataFrame | None = None, cadence=None) -> DataFrame:
    """Monthly rows for all months of each key's span; a month without observations is INSUFFICIENT_COVERAGE with coverage 0.

    ``counts`` (from ``observation_counts``) and ``cadence`` add observation_count and expected_observation_count.
    """
    periods = [*keys, "period_start", "period_end"]
    calendar = period_calendar(spans.select(*keys, F.col(start).alias("_from"), F.col(end).alias("_to")), "_from", "_to").select(*periods)
    out = join_null_safe(calendar, months, periods, "left")
    share = lambda c: F.when(F.col("expected_days").isNull(), F.lit(0.0)).otherwise(F.col(c))
    out = out.withColumns({**{c: share(c) for c in ("spatial_coverage_percentage", "temporal_coverage_percentage", "covered_days_area_weighted")},
                           "quality_flag": F.coalesce("quality_flag", F.lit("INSUFFICIENT_COVERAGE"))})
    out = out.withColumn("expected_days", days_between("period_start", "period_end"))
    if counts is not None:
        out = join_null_safe(out, counts, periods, "left").withColumns({
            "observation_count": F.coalesce("observation_count", F.lit(0)), "expected_observation_count": expected_count("period_start", "period_end", cadence)})
    return out


def zone_month_value(cells: DataFrame, keys: list[str], weight: str, zone_area, method, minimum_spatial: float = 0.9) -> DataFrame:
    """Area-weighted mean of accepted cells per period with coverage shares and the quality flag.

    ``cells`` carries completeness, accepted and aggregated. The value is NULL when the accepted area is
    below the spatial minimum.
    """
    w, area, ok = F.col(weight), col(zone_area), F.col("accepted")
    agg = cells.groupBy(*keys, "period_start", "period_end").agg(
        F.max(area).alias("_zone"), F.max(col(method)).alias("_method"),
        F.coalesce(F.sum(F.when(ok, w)), F.lit(0.0)).alias("_accepted"),
        F.sum(F.when(ok, w * F.col("aggregated"))).alias("_wx"),
        F.sum(F.when(w > 0, w * F.col("completeness"))).alias("_wc"),
        F.coalesce(F.bool_or(ok & (F.col("completeness") < 1 - EPS)), F.lit(False)).alias("_partial"))
    spatial, temporal = F.col("_accepted") / F.col("_zone"), F.col("_wc") / F.col("_zone")
    value = F.when(spatial >= minimum_spatial, ratio("_wx", "_accepted"))
    flag = (F.when(value.isNull(), "INSUFFICIENT_COVERAGE")
            .when(F.col("_partial") & (F.col("_method") != "duration_mean"), "PARTIAL_TOTAL")
            .when(F.col("_partial"), "PARTIAL_PERIOD").otherwise("OK"))
    days = days_between("period_start", "period_end")
    return agg.select(*keys, "period_start", "period_end", value.alias("value"),
                      (100 * spatial).alias("spatial_coverage_percentage"), (100 * temporal).alias("temporal_coverage_percentage"),
                      (temporal * days).alias("covered_days_area_weighted"), days.alias("expected_days"), flag.alias("quality_flag"))


def point_month_value(obs: DataFrame, keys: list[str], start: str, end: str, value, method, minimum_temporal: float = 0.9) -> DataFrame:
    """A single-point series: one cell of weight 1, spatial coverage not applicable."""
    one = obs.withColumn("_cell", F.lit(0)).withColumn("_w", F.lit(1.0))
    cells = completeness_gate(aggregate_interval(one, keys, "_cell", start, end, value, method, carry=["_w"]), minimum_temporal)
    cells = cells.withColumn("_method", col(method))
    return zone_month_value(cells, keys, "_w", F.lit(1.0), "_method", 1.0).withColumn("spatial_coverage_percentage", F.lit(None).cast("double"))


def interval_conflicts(obs: DataFrame, keys: list[str], start: str, end: str, slice_unit: str = "month") -> DataFrame:
    """Per series: inverted intervals, duplicate starts and overlaps with the next start; any rejects it.

    Intervals are ordered inside time slices only; between slices the last interval of one meets the
    first start of the next, so a hot series is never ordered by one task.
    """
    s, e = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    base = obs.select(*keys, s.alias("_s"), e.alias("_e")).groupBy(*keys, "_s").agg(
        F.count("*").alias("_n"), F.max("_e").alias("_e"), F.count_if(F.col("_e") <= F.col("_s")).alias("_inverted"))
    base = base.withColumn("_slice", F.date_trunc(slice_unit, "_s"))
    nxt = F.lead("_s").over(Window.partitionBy(*keys, "_slice").orderBy("_s"))
    inside = base.withColumn("_overlap", F.coalesce(nxt < F.col("_e"), F.lit(False)).cast("int"))
    slices = inside.groupBy(*keys, "_slice").agg(
        F.sum("_n").alias("_rows"), F.sum(F.col("_n") - 1).alias("_dup"), F.sum("_inverted").alias("_inv"),
        F.sum("_overlap").alias("_ov"), F.min("_s").alias("_first"), F.max_by("_e", "_s").alias("_last_end"))
    follow = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_slice"))
    slices = slices.withColumn("_cross", F.coalesce(follow < F.col("_last_end"), F.lit(False)).cast("int"))
    agg = slices.groupBy(*keys).agg(
        F.sum("_rows").alias("interval_count"), F.sum("_inv").alias("inverted_count"), F.sum("_dup").alias("duplicate_start_count"),
        F.sum(F.col("_ov") + F.col("_cross")).alias("overlap_count"))
    bad = F.col("inverted_count") + F.col("duplicate_start_count") + F.col("overlap_count")
    return agg.withColumn("status", F.when(bad > 0, "REJECTED").otherwise("OK"))


def series_key_unique(rows: DataFrame, fields: list[str] = SERIES_KEY) -> DataFrame:
    """Keys occurring more than once (NULL fields compare equal)."""
    return rows.groupBy(*fields).agg(F.count("*").alias("row_count")).where("row_count > 1")


def latest_record(df: DataFrame, keys: list[str], time: str, payload: list[str], tie: str | None = None) -> DataFrame:
    """Newest record per key with the first and last time."""
    order = F.struct(F.col(time), F.col(tie)) if tie else F.col(time)
    agg = df.groupBy(*keys).agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count("*").alias("record_count"),
                                F.max_by(F.struct(*payload), order).alias("_p"))
    return agg.select(*keys, "first_time", "last_time", "record_count", "_p.*")
