"""Agreement and spread of a fixed set of models on shared units.

A unit row carries ``values``: one value per model, in the declared model order. Building it is one
partial aggregate per unit with a bounded state; everything after is row-level arithmetic.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col, computed_once, ratio
from .stats import weighted_summary

NUMERIC_METRICS = ["model_mean", "model_median", "model_minimum", "model_maximum", "model_standard_deviation",
                   "model_iqr", "model_range", "model_coefficient_of_variation"]
AGREEMENT_GROUPS = ["5/5 unanimous", "4/5 strong", "3/5 majority", "Tied / dispersed"]   # fixed labels


def unit_values(df: DataFrame, keys: list[str], model: str, value, models: list[str], carry: list[str] = ()) -> DataFrame:
    """One row per unit with ``values`` in model order and a completeness status.

    Missing, repeated or unlisted models make the unit incomplete; ``carry`` columns are constant per unit.
    """
    v, m = col(value).cast("double"), F.col(model)
    agg = df.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in carry],
        *[F.max(F.when(m == name, v)).alias(f"_v{i}") for i, name in enumerate(models)],
        *[F.count_if((m == name) & v.isNotNull()).alias(f"_n{i}") for i, name in enumerate(models)],
        F.count_if(~m.isin(*models)).alias("_other"))
    counts = [F.col(f"_n{i}") for i in range(len(models))]
    repeated = sum([(c > 1).cast("int") for c in counts], F.lit(0)) > 0
    missing = sum([(c == 0).cast("int") for c in counts], F.lit(0)) > 0
    status = (F.when(repeated, "REPEATED_MODEL").when(F.col("_other") > 0, "UNEXPECTED_MODEL")
              .when(missing, "MISSING_MODEL").otherwise("COMPLETE"))
    return agg.select(*keys, *carry, F.array(*[F.col(f"_v{i}") for i in range(len(models))]).alias("values"),
                      sum([(c > 0).cast("int") for c in counts], F.lit(0)).alias("model_count"), status.alias("status"))


def value_map(values, models: list[str]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(m) for m in models]), col(values))


def _items(values, n: int) -> list[Column]:
    return [col(values)[i] for i in range(n)]


def _linear_quantile(ordered: Column, n: int, p: float) -> Column:
    position = (n - 1) * p
    low = int(position)
    share = position - low
    a = ordered[low]
    return a if share == 0 else a + (ordered[low + 1] - a) * share


def numeric_metrics(values, n: int, suffix: str = "") -> dict[str, Column]:
    """Equal-weight mean, median, extremes, population SD, linear IQR, range and CV of n values."""
    items = _items(values, n)
    mean = sum(items[1:], items[0]) / n
    ordered = F.sort_array(col(values))
    sd = F.sqrt(sum([(x - mean) * (x - mean) for x in items[1:]], (items[0] - mean) * (items[0] - mean)) / n)
    low, high = ordered[0], ordered[n - 1]
    out = {"model_mean": mean, "model_median": _linear_quantile(ordered, n, .5), "model_minimum": low, "model_maximum": high,
           "model_standard_deviation": sd, "model_iqr": _linear_quantile(ordered, n, .75) - _linear_quantile(ordered, n, .25),
           "model_range": high - low, "model_coefficient_of_variation": F.when(mean > 0, sd / mean)}
    return {k + suffix: v for k, v in out.items()}


def with_numeric(df: DataFrame, values: str, n: int, suffix: str = "") -> DataFrame:
    """Add the eight metrics as fixed columns."""
    m = numeric_metrics(values, n, suffix)
    out = computed_once(df, "_m", F.struct(*[v.alias(k) for k, v in m.items()]))
    return out.select(*df.columns, "_m.*")


def model_numeric(df: DataFrame, n: int, values: str = "values") -> DataFrame:
    """Add the eight numeric metrics, the CV status and the zero/positive indicators."""
    out = with_numeric(df, values, n)
    mean = F.col("model_mean")
    return out.withColumns({
        "cv_status": F.when(mean > 0, "DEFINED").otherwise("UNDEFINED_NONPOSITIVE_MEAN"),
        "zero_model_count": sum([(x == 0).cast("int") for x in _items(values, n)], F.lit(0)),
        "positive_yield": mean > 0, "valid_zero_yield": mean == 0})


def with_consensus(df: DataFrame, values: str, n: int, suffix: str = "") -> DataFrame:
    """Add modal count, unique mode (NULL on a tie), tied winners and number of distinct classes.

    Counts and winners are fixed in two steps, so that the comparisons of all value pairs are not
    repeated in every column derived from them.
    """
    items = _items(values, n)
    counts = [sum([(other == x).cast("int") for other in items[1:]], (items[0] == x).cast("int")) for x in items]
    out = computed_once(df, "_counts", F.array(*counts))
    top = F.array_max("_counts")
    winners = F.array_distinct(F.array_compact(F.array(*[F.when(F.col("_counts")[i] == F.col("_top"), x.cast("int")) for i, x in enumerate(items)])))
    out = computed_once(computed_once(out, "_top", top), "_winners", F.sort_array(winners))
    single = F.size("_winners") == 1
    return out.withColumns({
        f"modal_count{suffix}": F.col("_top"), f"modal_class{suffix}": F.when(single, F.col("_winners")[0]),
        f"tied_modal_classes{suffix}": F.when(single, F.array().cast("array<int>")).otherwise(F.col("_winners")),
        f"unique_class_count{suffix}": F.size(F.array_distinct(col(values)))}).drop("_counts", "_top", "_winners")


def model_consensus(df: DataFrame, classes: list[int], n: int, values: str = "values") -> DataFrame:
    """Class frequencies, mode with ties kept, agreement flags (0/1) and the agreement group."""
    out = with_consensus(df, values, n)
    top, unique = F.col("modal_count"), F.col("modal_class").isNotNull()
    freq = [sum([(x == c).cast("int") for x in _items(values, n)], F.lit(0)) for c in classes]
    group = (F.when(top == n, AGREEMENT_GROUPS[0]).when(top == n - 1, AGREEMENT_GROUPS[1])
             .when(unique & (top == n - 2), AGREEMENT_GROUPS[2]).otherwise(AGREEMENT_GROUPS[3]))
    return out.withColumns({
        "class_frequencies": F.map_from_arrays(F.array(*[F.lit(c) for c in classes]), F.array(*freq)),
        "unique_mode": unique, "full_agreement": (top == n).cast("int"), "strong_agreement": (top >= n - 1).cast("int"),
        "majority_agreement": (unique & (top == n - 2)).cast("int"), "agreement_group": group,
        "tie_flag": (~unique).cast("int"), "tied_or_dispersed": (top < n - 2).cast("int")})


def class_extremes(df: DataFrame, labels: dict[int, str], excluded: int, values: str = "values") -> DataFrame:
    """Best and worst class label among the models, ignoring the excluded (unordered) class."""
    ordered = F.filter(col(values), lambda x: x != excluded)
    caption = F.create_map(*[F.lit(x) for pair in sorted(labels.items()) for x in pair])
    pick = lambda f: F.try_element_at(caption, f(ordered).cast("int"))
    return df.withColumns({"highest_suitability_label": pick(F.array_min), "lowest_suitability_label": pick(F.array_max),
                           "water_present": F.array_contains(col(values), F.lit(float(excluded)))})


def class_frequency_dense(df: DataFrame, keys: list[str], classes: list[int], n: int, values: str = "values") -> DataFrame:
    """Every class of every unit with its model count and fraction, zeros included."""
    count = lambda c: sum([(x == c).cast("int") for x in _items(values, n)], F.lit(0))
    rows = F.array(*[F.struct(F.lit(c).alias("class_code"), count(c).alias("model_count")) for c in classes])
    return (df.select(*keys, F.explode(rows).alias("r"))
            .select(*keys, "r.class_code", "r.model_count", (F.col("r.model_count") / n).alias("model_fraction")))


def _by_model(df: DataFrame, keys: list[str], models: list[str], values: str, weight: str) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(m).alias("model"), col(values)[i].alias("value")) for i, m in enumerate(models)])
    return df.select(*keys, weight, F.explode(rows).alias("r")).select(*keys, weight, "r.model", "r.value")


def model_class_area(df: DataFrame, group: list[str], models: list[str], classes: list[int], weight: str,
                     values: str = "values") -> DataFrame:
    """Area per model and class (dense) with its share of the common area."""
    long = _by_model(df, group, models, values, weight)
    agg = long.groupBy(*group, "model").agg(
        F.sum(weight).alias("_common"),
        *[F.coalesce(F.sum(F.when(F.col("value") == c, F.col(weight))), F.lit(0.0)).alias(f"_a{c}") for c in classes])
    rows = F.array(*[F.struct(F.lit(c).alias("class_code"), F.col(f"_a{c}").alias("area")) for c in classes])
    return (agg.select(*group, "model", "_common", F.explode(rows).alias("r"))
            .select(*group, "model", "r.class_code", "r.area", (100 * ratio("r.area", "_common")).alias("percentage_of_common_area")))


def model_weighted_summary(df: DataFrame, group: list[str], models: list[str], weight: str, values: str = "values") -> DataFrame:
    """Area-weighted summary of each model on the common support."""
    return weighted_summary(_by_model(df, group, models, values, weight), [*group, "model"], "value", weight)


def pairwise_agreement(df: DataFrame, group: list[str], models: list[str], weight: str, values: str = "values") -> DataFrame:
    """Equal-class area of every model pair: one aggregate with a column per pair, no self-join."""
    pairs = list(combinations(range(len(models)), 2))
    same = lambda i, j: F.coalesce(F.sum(F.when(col(values)[i] == col(values)[j], F.col(weight))), F.lit(0.0))
    agg = df.groupBy(*group).agg(F.sum(weight).alias("common_area"), *[same(i, j).alias(f"_p{i}_{j}") for i, j in pairs])
    rows = F.array(*[F.struct(F.lit(models[i]).alias("model_a"), F.lit(models[j]).alias("model_b"),
                              F.col(f"_p{i}_{j}").alias("agreement_area")) for i, j in pairs])
    return (agg.select(*group, "common_area", F.explode(rows).alias("r"))
            .select(*group, "r.*", "common_area", (100 * ratio("r.agreement_area", "common_area")).alias("agreement_percentage")))


def pairwise_difference(df: DataFrame, group: list[str], models: list[str], weight: str, values: str = "values") -> DataFrame:
    """Weighted summary of model_b - model_a for every model pair."""
    rows = F.array(*[F.struct(F.lit(models[i]).alias("model_a"), F.lit(models[j]).alias("model_b"),
                              (col(values)[j] - col(values)[i]).alias("difference"))
                     for i, j in combinations(range(len(models)), 2)])
    long = df.select(*group, weight, F.explode(rows).alias("r")).select(*group, weight, "r.*")
    return weighted_summary(long, [*group, "model_a", "model_b"], "difference", weight)


def unit_differences(df: DataFrame, models: list[str], values: str = "values") -> DataFrame:
    """Add the per-unit map of pair differences, keyed ``b minus a``."""
    pairs = list(combinations(range(len(models)), 2))
    return df.withColumn("pairwise_differences", F.map_from_arrays(
        F.array(*[F.lit(f"{models[j]} minus {models[i]}") for i, j in pairs]),
        F.array(*[col(values)[j] - col(values)[i] for i, j in pairs])))


def agreement_area(df: DataFrame, group: list[str], classes: list[int], weight: str) -> DataFrame:
    """Area per agreement group, per modal class, per unanimous class and of tied modes, as rows."""
    w = F.col(weight)
    area = lambda cond: F.coalesce(F.sum(F.when(cond, w)), F.lit(0.0))
    parts = {("agreement_group", label): area(F.col("agreement_group") == label) for label in AGREEMENT_GROUPS}
    parts |= {("modal_class", str(c)): area(F.col("modal_class") == c) for c in classes}
    parts |= {("unanimous_class", str(c)): area((F.col("modal_class") == c) & (F.col("full_agreement") == 1)) for c in classes}
    parts[("tied_mode", "all")] = area(F.col("tie_flag") == 1)
    agg = df.groupBy(*group).agg(*[expr.alias(f"_p{i}") for i, expr in enumerate(parts.values())])
    rows = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(label).alias("label"), F.col(f"_p{i}").alias("area"))
                     for i, (kind, label) in enumerate(parts)])
    return agg.select(*group, F.explode(rows).alias("r")).select(*group, "r.*")


def metric_spatial_summary(df: DataFrame, group: list[str], metrics: list[str], weight: str) -> DataFrame:
    """Area-weighted summary of every unit metric; undefined metrics are skipped."""
    long = df.select(*group, weight, *metrics).unpivot([*group, weight], metrics, "metric", "value")
    return weighted_summary(long, [*group, "metric"], "value", weight)


def across_model_means(model_summary: DataFrame, group: list[str], models: list[str]) -> DataFrame:
    """Numeric metrics over the zone means of all models; NULL unless every model has one."""
    wide = unit_values(model_summary, group, "model", "mean", models)
    metrics = numeric_metrics("values", len(models))
    complete = F.col("status") == "COMPLETE"
    return wide.select(*group, *[F.when(complete, v).alias(k) for k, v in metrics.items()])
