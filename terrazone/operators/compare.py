"""Scenario comparison: layer pairs, paired units, transitions, differences, matched groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import col, join_null_safe, ratio
from .consensus import numeric_metrics, with_consensus, with_numeric
from .stats import weighted_summary

PRODUCT_DIMS = ["map_code", "management_code", "climate_model_code"]
GROUP_DIMS = ["map_code", "period_code", "ssp_code", "management_code"]


def historical_view(layers: DataFrame, products: list[str], period: str = "HP0120", model: str = "AGERA5", ssp: str = "HIST") -> DataFrame:
    """Extracted historical layers with constant dimensions, so that they join with future layers."""
    return (layers.where(F.col("comparison_group").isin(*products) & (F.col("extraction_status") == "EXTRACTED"))
            .withColumns({"map_code": F.col("comparison_group"), "period_code": F.lit(period),
                          "climate_model_code": F.lit(model), "ssp_code": F.lit(ssp)}))


def pairs_matched(layers: DataFrame, models: list[str]) -> DataFrame:
    """Unordered pairs of individual-model layers that differ in exactly one of SSP and period."""
    dims = layers.where(F.col("climate_model_code").isin(*models)).select("layer_id", *PRODUCT_DIMS, "period_code", "ssp_code")
    other = dims.select(F.col("layer_id").alias("layer_b"), *PRODUCT_DIMS,
                        F.col("period_code").alias("period_b"), F.col("ssp_code").alias("ssp_b"))

    def kind(name, same, same_b, varies, varies_b):
        left = dims.withColumnRenamed("layer_id", "layer_a")
        j = left.join(other.withColumnRenamed(same_b, same), [*PRODUCT_DIMS, same]).where(F.col(varies) < F.col(varies_b))
        return j.select(F.lit(name).alias("comparison_kind"), "layer_a", "layer_b", *PRODUCT_DIMS)
    return (kind("cross_ssp", "period_code", "period_b", "ssp_code", "ssp_b")
            .unionByName(kind("cross_period", "ssp_code", "ssp_b", "period_code", "period_b")))


def pairs_historical(layers: DataFrame, historical: DataFrame) -> DataFrame:
    """Each future layer, the ensemble included, with the historical layer of its product and management."""
    h = historical.select(F.col("layer_id").alias("layer_a"), "map_code", "management_code")
    f = layers.where(F.col("period_code").startswith("FP")).select(
        F.col("layer_id").alias("layer_b"), "map_code", "management_code", "climate_model_code")
    return h.join(f, ["map_code", "management_code"]).select(
        F.lit("historical_future").alias("comparison_kind"), "layer_a", "layer_b", *PRODUCT_DIMS)


def for_every(result: DataFrame, keys: list[str], every: DataFrame | None, areas: list[str] = (), metrics: list[str] = ()) -> DataFrame:
    """One row per comparison of ``every`` (and per metric): those without a shared valid cell have no area and NO_COMMON_VALID_SUPPORT.

    ``every=None`` asks for the comparisons that share a cell alone, and no status.
    """
    if every is None:
        return result
    base = every.select(*keys).distinct()
    if metrics:
        base, keys = base.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics]))), [*keys, "metric"]
    out = join_null_safe(base, result.withColumn("_found", F.lit(True)), keys, "left")
    status = F.when(F.col("_found").isNull(), "NO_COMMON_VALID_SUPPORT").otherwise("OK")
    return out.withColumns({**{a: F.coalesce(a, F.lit(0.0)) for a in areas}, "support_status": status}).drop("_found")


def pair_units(pairs: DataFrame, cells: DataFrame, categorical: bool, row: str = "row", column: str = "column",
               value: str = "value", area: str = "area") -> DataFrame:
    """Valid cells shared by both layers of every pair: one shuffle by position, and the pairs fanned out inside each row.

    A position holds at most one value of each layer. Pairs are a catalogue; they meet the first layer's value, and the second one's is looked up beside it.
    """
    good = cells.where(F.col(value).isNotNull()).select("layer_id", row, column, area, F.col(value).cast("double").alias("_v"))
    here = good.groupBy(row, column).agg(F.collect_list(F.struct("layer_id", F.col("_v").alias("value"), F.col(area).alias("area"))).alias("_here"))
    first = here.select(row, column, F.explode("_here").alias("_a"), "_here").select(
        row, column, F.col("_a.layer_id").alias("layer_a"), F.col("_a.area").alias(area), F.col("_a.value").alias("value_a"), "_here")
    j = pairs.join(first, "layer_a")
    second = F.filter("_here", lambda x: x["layer_id"] == F.col("layer_b"))
    j = j.withColumn("_b", F.explode(second)).withColumn("value_b", F.col("_b.value")).drop("_here", "_b")
    if categorical:
        return j.withColumns({"class_a": F.col("value_a").cast("int"), "class_b": F.col("value_b").cast("int"),
                              "class_match": F.col("value_a") == F.col("value_b")})
    diff = F.col("value_b") - F.col("value_a")
    return j.withColumns({"absolute_difference": diff, "percentage_difference": 100 * ratio(diff, "value_a"),
                          "percentage_status": F.when(F.col("value_a") != 0, "DEFINED").otherwise("UNDEFINED_ZERO_BASELINE")})


def transition_matrix(units: DataFrame, keys: list[str], area: str = "area") -> DataFrame:
    """Area per observed (class_a, class_b)."""
    return units.groupBy(*keys, "class_a", "class_b").agg(F.sum(area).alias("area"))


def transition_totals(units: DataFrame, keys: list[str], area: str = "area", *, every: DataFrame | None) -> DataFrame:
    """Unchanged area and agreement share per comparison; one row for each of ``every`` (see ``for_every``)."""
    agg = units.groupBy(*keys).agg(F.sum(area).alias("common_area"),
                                   F.coalesce(F.sum(F.when(F.col("class_match"), F.col(area))), F.lit(0.0)).alias("unchanged_area"))
    return for_every(agg.withColumn("agreement_percentage", 100 * ratio("unchanged_area", "common_area")), keys, every, ["common_area", "unchanged_area"])


# fixed values: names of the metrics
DIFFERENCE_METRICS = ["value_a", "value_b", "absolute_difference", "percentage_difference"]


def difference_summary(units: DataFrame, keys: list[str], area: str = "area", *, every: DataFrame | None) -> DataFrame:
    """Weighted summaries of both sides, the difference and the percentage change, as rows per metric."""
    long = units.select(*keys, area, *DIFFERENCE_METRICS).unpivot([*keys, area], DIFFERENCE_METRICS, "metric", "value")
    return for_every(weighted_summary(long, [*keys, "metric"], "value", area), keys, every, metrics=DIFFERENCE_METRICS)


def difference_totals(units: DataFrame, keys: list[str], area: str = "area", *, every: DataFrame | None) -> DataFrame:
    """Area on which the percentage is defined and the percentage change of the two zone means."""
    w = F.col(area)
    agg = units.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("value_a") != 0, w)), F.lit(0.0)).alias("percentage_defined_area"),
        (F.sum(w * F.col("value_a")) / F.sum(w)).alias("_ma"), (F.sum(w * F.col("value_b")) / F.sum(w)).alias("_mb"))
    out = agg.select(*keys, "percentage_defined_area",
                     (100 * ratio(F.col("_mb") - F.col("_ma"), "_ma")).alias("percentage_change_of_means"))
    return for_every(out, keys, every, ["percentage_defined_area"])


def group_pairs(groups: DataFrame) -> DataFrame:
    """Pairs of complete groups with equal product and management that differ in one other dimension."""
    a = groups.select(F.col("group_id").alias("group_a"), "map_code", "management_code", "period_code", "ssp_code")
    b = groups.select(F.col("group_id").alias("group_b"), "map_code", "management_code",
                      F.col("period_code").alias("_p"), F.col("ssp_code").alias("_s"))
    same = ["map_code", "management_code"]
    ssp = a.join(b.withColumnRenamed("_p", "period_code"), [*same, "period_code"]).where(F.col("ssp_code") < F.col("_s"))
    period = a.join(b.withColumnRenamed("_s", "ssp_code"), [*same, "ssp_code"]).where(F.col("period_code") < F.col("_p"))
    out = ["group_a", "group_b", *same]
    return (ssp.select(F.lit("cross_ssp").alias("comparison_kind"), *out)
            .unionByName(period.select(F.lit("cross_period").alias("comparison_kind"), *out)))


def group_pair_units(pairs: DataFrame, units: DataFrame, row: str = "row", column: str = "column", area: str = "area") -> DataFrame:
    """Units valid in all ten layers of a group pair, from each group's own common support.

    A position in both groups' supports is valid in all ten inputs, so two five-layer supports meet on
    the position instead of exploding ten layers per pair.
    """
    a = units.select(F.col("group_id").alias("group_a"), row, column, area, F.col("values").alias("values_a"))
    b = units.select(F.col("group_id").alias("group_b"), row, column, F.col("values").alias("values_b"))
    return pairs.join(a, "group_a").join(b, ["group_b", row, column])


# fixed values: names of the metrics
GROUP_DIFFERENCES = ["model_mean_difference", "model_standard_deviation_difference", "model_iqr_difference",
                     "model_range_difference", "model_coefficient_of_variation_difference"]


def group_metric_units(pair_units: DataFrame, n: int) -> DataFrame:
    out = with_numeric(with_numeric(pair_units, "values_a", n, "_a"), "values_b", n, "_b")
    return out.withColumns({m: F.col(m.replace("_difference", "_b")) - F.col(m.replace("_difference", "_a")) for m in [*GROUP_DIFFERENCES, "model_median_difference"]})


def group_metric_difference(pair_units: DataFrame, keys: list[str], n: int, area: str = "area", *, every: DataFrame | None) -> DataFrame:
    """Weighted summary of b - a for five model metrics on the ten-layer support."""
    long = (group_metric_units(pair_units, n).select(*keys, area, *GROUP_DIFFERENCES)
            .unpivot([*keys, area], GROUP_DIFFERENCES, "metric", "value"))
    return for_every(weighted_summary(long, [*keys, "metric"], "value", area), keys, every, metrics=GROUP_DIFFERENCES)


def group_modal_units(pair_units: DataFrame, n: int) -> DataFrame:
    out = with_consensus(with_consensus(pair_units, "values_a", n, "_a"), "values_b", n, "_b")
    for side in ("a", "b"):
        out = out.withColumns({f"unanimity_{side}": (F.col(f"modal_count_{side}") == n).cast("int"),
                               f"strong_agreement_{side}": (F.col(f"modal_count_{side}") >= n - 1).cast("int")})
    defined = F.col("modal_class_a").isNotNull() & F.col("modal_class_b").isNotNull()
    return out.withColumn("modal_comparison_status", F.when(defined, "DEFINED").otherwise("EXCLUDED_TIED_MODE"))


def group_modal_comparison(pair_units: DataFrame, keys: list[str], n: int, area: str = "area", *, every: DataFrame | None) -> DataFrame:
    """Comparable and tied area plus unanimity and strong-agreement area per side."""
    w = F.col(area)
    part = lambda cond: F.coalesce(F.sum(F.when(cond, w)), F.lit(0.0))
    u = group_modal_units(pair_units, n)
    agg = u.groupBy(*keys).agg(
        F.sum(w).alias("common_area"), part(F.col("modal_comparison_status") == "DEFINED").alias("modal_comparable_area"),
        *[part(F.col(f"{m}_{s}") == 1).alias(f"{m}_{s}_area") for m in ("unanimity", "strong_agreement") for s in ("a", "b")])
    out = agg.withColumn("tied_mode_excluded_area", F.col("common_area") - F.col("modal_comparable_area"))
    return for_every(out, keys, every, [c for c in out.columns if c.endswith("_area")])


def group_transitions(pair_units: DataFrame, keys: list[str], n: int, area: str = "area") -> DataFrame:
    """Modal and spread (distinct class count) transitions as rows with a kind."""
    u = group_modal_units(pair_units, n)
    modal = (u.where("modal_comparison_status = 'DEFINED'")
             .groupBy(*keys, F.col("modal_class_a").alias("from_code"), F.col("modal_class_b").alias("to_code")).agg(F.sum(area).alias("area")))
    spread = u.groupBy(*keys, F.col("unique_class_count_a").alias("from_code"), F.col("unique_class_count_b").alias("to_code")).agg(F.sum(area).alias("area"))
    return modal.withColumn("kind", F.lit("modal")).unionByName(spread.withColumn("kind", F.lit("spread")))


def ensemble_units(units: DataFrame, ensemble: DataFrame, keys: list[str], n: int, categorical: bool) -> DataFrame:
    """The sixth source next to the five models on their joint support; ``ensemble`` has keys and ensemble_value."""
    j = units.join(ensemble.where(F.col("ensemble_value").isNotNull()), keys)
    if categorical:
        j = with_consensus(j, "values", n)
        return j.withColumns({"tied_mode": F.col("modal_class").isNull(),
                              "match_unique_mode": F.col("ensemble_value") == F.col("modal_class")})
    mean = numeric_metrics("values", n)["model_mean"]
    return j.withColumns({"derived_mean": mean, "ensemble_minus_derived_mean": F.col("ensemble_value") - mean})


def ensemble_diagnostic(units: DataFrame, ensemble: DataFrame, group: list[str], keys: list[str], n: int, categorical: bool,
                        area: str = "area", *, every: DataFrame | None) -> DataFrame:
    """Match share with the unique mode (ties excluded), or the weighted difference from the model mean."""
    u = ensemble_units(units, ensemble, keys, n, categorical)
    if not categorical:
        return for_every(weighted_summary(u, group, "ensemble_minus_derived_mean", area), group, every)
    part = lambda cond: F.coalesce(F.sum(F.when(cond, col(area))), F.lit(0.0))
    agg = u.groupBy(*group).agg(part(~F.col("tied_mode")).alias("unique_mode_comparable_area"), part(F.col("tied_mode")).alias("tied_mode_excluded_area"),
                                part(F.col("match_unique_mode")).alias("matching_area"))
    out = agg.withColumn("matching_percentage", 100 * ratio("matching_area", "unique_mode_comparable_area"))
    return for_every(out, group, every, [c for c in out.columns if c.endswith("_area")])
