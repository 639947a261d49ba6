"""One audited row per scenario from verified five-model units, and the views derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col, ratio

CLASS_FLAGS = ["full_agreement", "strong_agreement", "majority_agreement", "tied_or_dispersed", "tie_flag"]


def _part(cond: Column, w: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, w)), F.lit(0.0))


def support_gate(units: DataFrame, keys: list[str], area: str, common, zone, tolerance: float = 1e-4) -> DataFrame:
    """Units fill the common area, weights are positive, and 0 <= common <= zone (1 + tolerance)."""
    agg = units.groupBy(*keys).agg(F.sum(area).alias("unit_area"), F.min(area).alias("_low"), F.max(col(common)).alias("common"), F.max(col(zone)).alias("zone"))
    bad_denominator = (F.col("zone") <= 0) | (F.col("common") < 0) | (F.col("common") > F.col("zone") * (1 + tolerance))
    open_ = (F.col("_low") <= 0) | (F.abs(F.col("unit_area") - F.col("common")) > F.col("zone") * tolerance)
    return agg.select(*keys, "unit_area", "common", "zone",
                      F.when(bad_denominator, "INVALID_DENOMINATOR").when(open_, "AREA_CLOSURE_FAILED").otherwise("OK").alias("support_status"))


def scenario_yield_summary(units: DataFrame, keys: list[str], area: str = "area") -> DataFrame:
    """Zone means, positive and valid-zero areas, spread and extremes of numeric units (``model_numeric`` output).

    A group with a negative model value is rejected: NEGATIVE_VALUE in ``input_status``.
    """
    w, mean, cv = F.col(area), F.col("model_mean"), F.col("model_coefficient_of_variation")
    average = lambda v, cond=None: ratio(F.sum(F.when(v.isNotNull() & (cond if cond is not None else F.lit(True)), w * v)), F.sum(F.when(v.isNotNull() & (cond if cond is not None else F.lit(True)), w)))
    agg = units.groupBy(*keys).agg(
        F.sum(w).alias("common_valid_area"), F.count("*").alias("analytical_unit_count"), average(mean).alias("whole_mean"),
        _part(mean > 0, w).alias("positive_yield_area"), average(mean, mean > 0).alias("positive_area_mean"), _part(mean == 0, w).alias("valid_zero_area"),
        average(cv).alias("inter_model_cv"), _part(cv.isNotNull(), w).alias("cv_valid_area"),
        average(F.col("model_standard_deviation")).alias("population_sd"), average(F.col("model_iqr")).alias("iqr"), average(F.col("model_range")).alias("model_range"),
        F.min("model_minimum").alias("model_minimum"), F.max("model_maximum").alias("model_maximum"))
    share = lambda c: 100 * ratio(c, "common_valid_area")
    closes = F.abs(F.col("positive_yield_area") + F.col("valid_zero_area") - F.col("common_valid_area")) <= F.col("common_valid_area") * 1e-4
    return agg.withColumns({"positive_yield_percentage": share("positive_yield_area"), "valid_zero_percentage": share("valid_zero_area"),
                            "positive_area_mean_status": F.when(F.col("positive_yield_area") > 0, "DEFINED").otherwise("NO_POSITIVE_AREA"),
                            "partition_status": F.when(closes, "OK").otherwise("PARTITION_FAILED"),
                            "input_status": F.when(F.col("model_minimum") < 0, "NEGATIVE_VALUE").otherwise("OK")})


def scenario_class_summary(units: DataFrame, keys: list[str], classes: list[int], area: str = "area") -> DataFrame:
    """Dominant modal class (NULL on equal areas), flag areas and shares, and areas by distinct class count.

    A group with a class that is not listed is rejected: UNLISTED_CLASS in ``input_status``.
    """
    w = F.col(area)
    listed = [float(c) for c in classes]
    unlisted = F.coalesce(~F.col("modal_class").isin(*classes), F.lit(False))
    if "values" in units.columns:
        unlisted = unlisted | F.coalesce(F.exists("values", lambda v: ~v.cast("double").isin(*listed)), F.lit(False))
    agg = units.groupBy(*keys).agg(
        F.sum(w).alias("common_valid_area"), F.count("*").alias("analytical_unit_count"), F.bool_or(unlisted).alias("_unlisted"),
        *[_part(F.col("modal_class") == c, w).alias(f"_m{c}") for c in classes],
        *[_part(F.col(f) == 1, w).alias(f"{f}_area") for f in CLASS_FLAGS],
        *[_part(F.col("unique_class_count") == n, w).alias(f"unique_class_count_{n}_area") for n in range(1, 6)])
    modal = [F.col(f"_m{c}") for c in classes]
    top = F.greatest(*modal) if len(modal) > 1 else modal[0]
    tolerance = F.greatest(F.lit(1e-8), F.col("common_valid_area") * 1e-10)
    leads = [(top > 0) & (F.abs(m - top) <= tolerance) for m in modal]
    single = sum([c.cast("int") for c in leads], F.lit(0)) == 1
    dominant = F.when(single, F.coalesce(*[F.when(c, F.lit(code)) for c, code in zip(leads, classes)]))
    out = agg.withColumns({"dominant_class": dominant, "dominant_class_area": F.when(single, top)})
    out = out.withColumn("input_status", F.when(F.col("_unlisted"), "UNLISTED_CLASS").otherwise("OK")).drop("_unlisted")
    out = out.withColumn("dominant_class_percentage", 100 * ratio("dominant_class_area", "common_valid_area"))
    return out.withColumns({f"{f}_percentage": 100 * ratio(f"{f}_area", "common_valid_area") for f in CLASS_FLAGS}).drop(*[f"_m{c}" for c in classes])


def sort_scenarios(df: DataFrame, keys: list[str]) -> DataFrame:
    """Total order by the scenario dimensions."""
    return df.orderBy(*keys)


def flatten_nested(df: DataFrame, products: str = "products", inner: str = "summary") -> DataFrame:
    """products.<kind>.<inner>.<field> as flat columns <kind>_<field>, in schema order."""
    kinds = df.schema[products].dataType
    flat = [F.col(f"{products}.{k.name}.{inner}.{f.name}").alias(f"{k.name}_{f.name}") for k in kinds.fields for f in k.dataType[inner].dataType.fields]
    return df.select(*[c for c in df.columns if c != products], *flat)


def period_line_up(df: DataFrame, keys: list[str], period: str, periods: list[str], measures: list[str]) -> DataFrame:
    """All periods of every key with visible gaps: one aggregate per key, then one row per listed period."""
    agg = df.where(F.col(period).isin(*periods)).groupBy(*keys).agg(*[F.first(F.when(F.col(period) == p, F.struct(F.lit(True).alias("present"), *measures)), ignorenulls=True).alias(f"_p{i}") for i, p in enumerate(periods)])
    rows = F.array(*[F.struct(F.lit(p).alias(period), F.col(f"_p{i}").alias("m")) for i, p in enumerate(periods)])
    out = agg.select(*keys, F.explode(rows).alias("r"))
    return out.select(*keys, F.col(f"r.{period}").alias(period), F.coalesce("r.m.present", F.lit(False)).alias("available"), *[F.col(f"r.m.{m}").alias(m) for m in measures])


def management_side_by_side(df: DataFrame, keys: list[str], management: str, values: list[str], measure: str) -> DataFrame:
    """One column per management for the same scenario; the sides are shown, never subtracted."""
    return df.groupBy(*keys).pivot(management, values).agg(F.first(measure, ignorenulls=True))


def stacked_shares(df: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping agreement shares to four exclusive ones; exactly four is strong minus full, not below 0."""
    four = F.greatest(F.lit(0.0), F.col("strong_agreement_percentage") - F.col("full_agreement_percentage"))
    parts = {"all_agree": F.col("full_agreement_percentage"), "exactly_four": four, "exactly_three": F.col("majority_agreement_percentage"), "split": F.col("tied_or_dispersed_percentage")}
    rows = F.array(*[F.struct(F.lit(k).alias("share"), v.alias("percentage")) for k, v in parts.items()])
    return df.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def follow_up_checks(df: DataFrame, keys: list[str], irrigated: str = "HILM") -> DataFrame:
    """Follow-up codes per scenario, in order.

    Columns: suitability_valid, yield_valid, suitability_coverage, yield_coverage (percent), tied_or_dispersed_percentage,
    valid_zero_area, management_code.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    s, y = yes(F.col("suitability_valid")), yes(F.col("yield_valid"))
    partial = yes(s & (F.col("suitability_coverage") < 99.99)) | yes(y & (F.col("yield_coverage") < 99.99))
    split = yes(s & (F.col("tied_or_dispersed_percentage") > 0))
    codes = [F.when(~(s & y), "COMPLETE_EVIDENCE").otherwise("CHECK_LOCALLY"),
             F.when(partial, "CHECK_UNCOVERED_AREA").when(split, "INVESTIGATE_DISAGREEMENT").otherwise("CHECK_OTHER_FUTURES"),
             F.when(yes(y & (F.col("valid_zero_area") > 0)), "INVESTIGATE_ZERO_YIELD"),
             F.when(F.col("management_code").eqNullSafe(irrigated), "CHECK_IRRIGATION").otherwise("CHECK_WATER")]
    return df.select(*keys, F.posexplode(F.array_compact(F.array(*codes))).alias("check_order", "check_code"))
