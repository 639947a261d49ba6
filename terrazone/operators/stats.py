"""Weighted statistics, quantiles, area accounting and class areas.

Weights are physical areas; missing values are NULL. All aggregations are plain partial/final Spark
aggregates, so a hot key is combined map-side before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import any_of, col, computed_once, finite, is_finite, join_null_safe, ratio

PROBABILITIES = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}

#: Bins of a key: each step looks a value up among so many split points. A key's values are that many bins in both steps together.
STEP = 16
BINS = STEP * STEP
#: Groups, by hash, of a key's distinct values, of each of which one is looked at for the split points.
PICKS = 16 * BINS

Reach = Callable[[Column, Column], Column]


def at_least(p: float) -> Reach:
    """Reached when the cumulative normalised weight is at least p."""
    return lambda cum, total: cum / total >= F.lit(p)


def _above(x: Column, split: Callable[[int], Column]) -> Column:
    """How many of ``STEP - 1`` split points lie below x, as compiled comparisons."""
    return sum(((split(i) < x).cast("int") for i in range(1, STEP - 1)), (split(0) < x).cast("int"))


def order_statistics(df: DataFrame, keys: list[str], value, weight, targets: dict[str, Reach]) -> DataFrame:
    """Per key: count, weight total, min, max, mean, second moment and exact weighted order statistics.

    A target is the first value, in ascending order, whose cumulative weight satisfies its predicate (clamped to the largest
    value). Everything comes from one table of cells, the weights summed by key and value: the input is looked at once. A key's totals and the split points
    of its distinct values are aggregates of the cells; a bin lies between two of them, so none has much more than one in 256 of a key's
    values, whatever their distribution. Weights are summed by bin, the prefix sums over a key's bins name those that hold a target, and only the
    values of these are ordered. The split points choose the bin and nothing else, so results are exact. Spark may work them out twice, once for the sums
    and once for the values: they depend on the values alone, as each is the one of smallest hash of its group, and not on the order in which partial results
    arrive, as a sketch's would. The plan is the same for every size.
    """
    names, named = list(targets), keys
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    x, w = finite(value), finite(weight)
    ok = F.coalesce(x.isNotNull() & (w > 0), F.lit(False))
    cells = df.select(*keys, F.when(ok, x).alias("_x"), F.when(ok, w).alias("_w")).groupBy(*keys, "_x").agg(F.sum("_w").alias("_w"), F.count("_x").alias("_c"))
    mark = F.when(F.col("_x").isNotNull(), F.xxhash64("_x"))  # one to one for a double
    parts = cells.groupBy(*keys, F.pmod(mark, F.lit(PICKS)).alias("_p")).agg(
        F.sum("_c").alias("_n"), F.sum("_w").alias("_wt"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.sum(F.col("_x") * F.col("_w")).alias("_xw"), F.min_by("_x", mark).alias("_pick"))
    totals = parts.groupBy(*keys).agg(
        F.sum("_n").alias("_n"), F.sum("_wt").alias("_wt"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
        (F.sum("_xw") / F.sum("_wt")).alias("_mean"), F.sort_array(F.collect_list("_pick")).alias("_picks"))
    at = F.sequence(F.lit(1), F.lit(BINS - 1))
    totals = totals.withColumn("_splits", F.transform(at, lambda i: F.get("_picks", F.floor(i * F.size("_picks") / BINS).cast("int")))).drop("_picks")
    binned = join_null_safe(cells.where("_x IS NOT NULL"), totals.select(*keys, "_wt", "_mean", "_splits"), keys)
    coarse = _above(F.col("_x"), lambda i: F.get("_splits", F.lit(STEP * (i + 1) - 1)))
    binned = computed_once(binned, "_coarse", coarse)
    fine = _above(F.col("_x"), lambda i: F.get("_splits", F.col("_coarse") * STEP + i))
    binned = binned.withColumn("_b", F.col("_coarse") * STEP + F.coalesce(fine, F.lit(0))).drop("_splits", "_coarse")
    gap = F.col("_x") - F.col("_mean")
    bins = binned.groupBy(*keys, "_b").agg(F.sum("_w").alias("_wb"), F.sum(F.col("_w") * gap * gap).alias("_m2"), F.max("_wt").alias("_wt"))
    group = Window.partitionBy(*keys)
    bins = bins.withColumns({"_before": F.coalesce(F.sum("_wb").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "_m2": F.sum("_m2").over(group)})
    first = {n: F.coalesce(F.min(F.when(reach(F.col("_before") + F.col("_wb"), F.col("_wt")), F.col("_b"))).over(group), F.max("_b").over(group)) for n, reach in targets.items()}
    bins = bins.withColumns({f"_f_{n}": F.col("_b") == b for n, b in first.items()})
    hits = bins.where(any_of([F.col(f"_f_{n}") for n in names])).drop("_wb")
    held = join_null_safe(binned.select(*keys, "_b", "_x", "_w"), hits, [*keys, "_b"])
    cum = held.withColumn("_cum", F.col("_before") + F.sum("_w").over(Window.partitionBy(*keys, "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    found = cum.groupBy(*keys).agg(F.max("_m2").alias("_m2"), *[
        F.coalesce(F.min(F.when(F.col(f"_f_{n}") & reach(F.col("_cum"), F.col("_wt")), F.col("_x"))), F.max(F.when(F.col(f"_f_{n}"), F.col("_x")))).alias(n)
        for n, reach in targets.items()])
    out = join_null_safe(totals.drop("_splits"), found, keys, "left")
    return out.select(*named, F.col("_n").alias("n"), F.col("_wt").alias("weight_total"), F.col("_lo").alias("min"),
                      F.col("_hi").alias("max"), F.col("_mean").alias("mean"), F.col("_m2").alias("m2"), *names)


def weighted_summary(df: DataFrame, keys: list[str], value, weight) -> DataFrame:
    """min, max, mean, population SD, five quantiles and a quality flag per key."""
    stats = order_statistics(df, keys, value, weight, {k: at_least(p) for k, p in PROBABILITIES.items()})
    flag = (F.when(F.col("n") == 0, "NO_VALID_DATA").when(F.col("n") < 5, "FEW_NATIVE_CELLS").otherwise("OK"))
    return stats.select(*keys, "min", "max", "mean", F.sqrt(ratio("m2", "weight_total")).alias("std"),
                        *PROBABILITIES, flag.alias("quality_flag"))


def weighted_quantile(df: DataFrame, keys: list[str], value, weight, probs: dict[str, float]) -> DataFrame:
    """First value whose cumulative normalised weight reaches p, per key; never interpolated."""
    stats = order_statistics(df, keys, value, weight, {k: at_least(p) for k, p in probs.items()})
    return stats.select(*keys, *probs)


def area_accounting(df: DataFrame, keys: list[str], weight, valid, zone_area, tolerance: float = 1e-4) -> DataFrame:
    """Valid, masked and outside area with the closure test; ``zone_area`` is constant per key."""
    w, v = finite(weight), F.coalesce(col(valid), F.lit(False))
    inside = F.coalesce(w > 0, F.lit(False))
    agg = df.groupBy(*keys).agg(
        F.max(col(zone_area)).alias("zone_area"),
        F.coalesce(F.sum(F.when(inside & v, w)), F.lit(0.0)).alias("valid_area"),
        F.coalesce(F.sum(F.when(inside & ~v, w)), F.lit(0.0)).alias("masked_area"),
        F.count_if(inside).alias("intersecting_cell_count"),
        F.count_if(inside & v).alias("valid_cell_count"))
    covered = F.col("valid_area") + F.col("masked_area")
    agg = agg.withColumn("outside_area", F.greatest(F.lit(0.0), F.col("zone_area") - covered))
    closes = F.abs(covered + F.col("outside_area") - F.col("zone_area")) <= F.col("zone_area") * tolerance
    return agg.select(*keys, "zone_area", "valid_area", "masked_area", "outside_area",
                      (100 * ratio("valid_area", "zone_area")).alias("valid_area_percentage"),
                      "intersecting_cell_count", "valid_cell_count",
                      F.when(closes, "OK").otherwise("AREA_ACCOUNTING_FAILED").alias("status"))


def class_area(df: DataFrame, keys: list[str], class_code, weight, legend: DataFrame | None = None,
               zone_area=None) -> DataFrame:
    """Area, cell count and shares per class. ``legend`` has columns code, caption (and colour)."""
    c, w = finite(class_code), finite(weight)
    zone = F.max(col(zone_area)) if zone_area is not None else F.lit(None).cast("double")
    classes = (df.where(c.isNotNull() & (w > 0))
               .groupBy(*keys, c.alias("class_value"))
               .agg(F.sum(w).alias("area"), F.count("*").alias("cell_count"), zone.alias("_zone")))
    per_key = Window.partitionBy(*keys)
    out = classes.select("*", F.sum("area").over(per_key).alias("_valid"))
    out = out.withColumn("class_code", F.when(F.col("class_value") == F.floor("class_value"), F.col("class_value").cast("int")))
    if legend is not None:
        out = caption_join(out, "class_code", legend)
    else:
        out = out.withColumn("status", F.when(F.col("class_code").isNull(), "UNKNOWN_CLASS").otherwise("OK"))
    extra = [c for c in ("caption", "colour") if c in out.columns]
    return out.select(*keys, "class_code", *extra, "area", "cell_count",
                      (100 * ratio("area", "_valid")).alias("percentage_of_valid_area"),
                      (100 * ratio("area", "_zone")).alias("percentage_of_zone"), "status")


def caption_join(df: DataFrame, code: str, legend: DataFrame) -> DataFrame:
    """Left lookup of the caption; a code without caption is flagged, never dropped. Spark broadcasts a small legend by itself."""
    joined = df.join(legend.withColumnRenamed("code", "_code"), F.col(code) == F.col("_code"), "left").drop("_code")
    return joined.withColumn("status", F.when(F.col("caption").isNull(), "UNKNOWN_CLASS").otherwise("OK"))


def raster_stats_unweighted(df: DataFrame, keys: list[str], value) -> DataFrame:
    """Unweighted min, max, mean, median and population SD; the median averages the middle pair."""
    half = {"_low": lambda cum, total: cum >= F.floor((total + 1) / 2),
            "_high": lambda cum, total: cum >= F.floor((total + 2) / 2)}
    stats = order_statistics(df, keys, value, F.lit(1.0), half)
    return stats.select(*keys, "min", "max", "mean", ((F.col("_low") + F.col("_high")) / 2).alias("median"),
                        F.sqrt(ratio("m2", "n")).alias("std"), F.col("n").alias("valid_count"))


def class_histogram(df: DataFrame, keys: list[str], class_code) -> DataFrame:
    """Cell counts per class as a map plus the dominant class (lowest code on equal counts).

    The map is bounded by the number of classes, not by the number of cells.
    """
    counts = df.where(col(class_code).isNotNull()).groupBy(*keys, col(class_code).cast("int").alias("_c")).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("_c", "_n")))).alias("observed_classes"),
        F.max_by("_c", F.struct(F.col("_n"), -F.col("_c"))).alias("dominant_class"))


def pooled_domain(df: DataFrame, keys: list[str], value) -> DataFrame:
    """Min/max pooled over all members of a key; a constant domain is padded by 0.5 each side."""
    v = finite(value)
    agg = df.groupBy(*keys).agg(F.min(v).alias("domain_min"), F.max(v).alias("domain_max"))
    constant = F.col("domain_min") == F.col("domain_max")
    return agg.select(*keys, "domain_min", "domain_max", constant.alias("constant"),
                      F.when(constant, F.col("domain_min") - 0.5).otherwise(F.col("domain_min")).alias("display_min"),
                      F.when(constant, F.col("domain_max") + 0.5).otherwise(F.col("domain_max")).alias("display_max"))


def observed_classes(df: DataFrame, layer: str, class_code, legend_codes: list[int]) -> DataFrame:
    """Every legend class of every layer with whether it occurs."""
    c = finite(class_code)
    flags = df.groupBy(layer).agg(*[F.coalesce(F.bool_or(c == code), F.lit(False)).alias(f"_c{code}") for code in legend_codes])
    entries = F.array(*[F.struct(F.lit(code).alias("class_code"), F.col(f"_c{code}").alias("present")) for code in legend_codes])
    return flags.select(layer, F.explode(entries).alias("e")).select(layer, "e.class_code", "e.present")


def range_gate(df: DataFrame, keys: list[str], value, valid, lo, hi) -> DataFrame:
    """Count valid values outside [lo, hi] (either bound may be NULL); any makes the layer fail."""
    v, lo, hi = finite(value), col(lo), col(hi)
    out = F.coalesce(v < lo, F.lit(False)) | F.coalesce(v > hi, F.lit(False))
    agg = df.groupBy(*keys).agg(F.count_if(F.coalesce(col(valid), F.lit(False)) & out).alias("out_of_range_count"))
    return agg.withColumn("status", F.when(F.col("out_of_range_count") > 0, "QA_FAILED").otherwise("OK"))


def value_rule(df: DataFrame, keys: list[str], value, rule) -> DataFrame:
    """Every valid value of a layer obeys its rule; layers without valid values do not pass.

    ``rule`` names one of class (whole number), class_1_9, non_negative, share.
    """
    v, r = finite(value), col(rule)
    whole = v == F.floor(v)
    ok = (F.when(r == "class", whole).when(r == "class_1_9", whole & v.between(1, 9))
          .when(r == "non_negative", v >= 0).when(r == "share", v.between(0, 100)).otherwise(F.lit(True)))
    agg = df.groupBy(*keys).agg(F.count(v).alias("valid_count"),
                                F.coalesce(F.bool_and(F.when(v.isNotNull(), ok)), F.lit(False)).alias("value_rule_passed"))
    status = (F.when(F.col("valid_count") == 0, "FAILED_NO_VALID_CELLS")
              .when(F.col("value_rule_passed"), "VERIFIED").otherwise("FAILED_VALUE_RULE"))
    return agg.withColumn("status", status)


def extracted_counts(layers: DataFrame, source: str, status, first_obs, last_obs) -> DataFrame:
    """Extracted layers per source with the first and last observation."""
    done = col(status) == "EXTRACTED"
    return layers.groupBy(source).agg(
        F.count_if(done).alias("extracted_layer_count"), F.count("*").alias("layer_count"),
        F.min(F.when(done, col(first_obs))).alias("first_observation"),
        F.max(F.when(done, col(last_obs))).alias("last_observation")
    ).withColumn("has_data", F.col("extracted_layer_count") > 0)


def decode_cells(df: DataFrame, raw, mask, weight, scale=1.0, offset=0.0, nodata=None,
                 intrinsic_nodata=None, already_scaled=False) -> DataFrame:
    """Add ``valid`` and ``value``: scale and offset are applied once, masked and NoData cells are NULL."""
    r, w = col(raw).cast("double"), finite(weight)
    excluded = lambda nd: F.coalesce(r == col(nd).cast("double"), F.lit(False))
    valid = (F.coalesce(col(mask).cast("boolean"), F.lit(False)) & is_finite(r) & F.coalesce(w > 0, F.lit(False))
             & ~excluded(nodata) & ~excluded(intrinsic_nodata))
    value = F.when(col(already_scaled), r).otherwise(r * col(scale).cast("double") + col(offset).cast("double"))
    return df.withColumn("valid", valid).withColumn("value", F.when(F.col("valid"), value))


def reject_negative(df: DataFrame, value: str, enabled=True) -> DataFrame:
    """Negative values become missing (never clamped); ``rejected`` marks them so they can be counted."""
    bad = F.coalesce(col(enabled) & (F.col(value) < 0), F.lit(False))
    return df.withColumn("rejected", bad).withColumn(value, F.when(~F.col("rejected"), F.col(value)))


def qa_band_filter(df: DataFrame, value: str, qa, qa_max) -> DataFrame:
    """Keep a value only where its QA code is within the limit; the row itself stays."""
    return df.withColumn(value, F.when(col(qa) <= col(qa_max), F.col(value)))
