"""End to end on a synthetic package of 254 layers on one grid: the row counts of every comparison table."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from terrazone.functions.scalars import group_key
from terrazone.operators import compare as cp, consensus as cs, scenario as sc, stats, support as sp

MODELS = ["A-1", "B-2", "C-3", "D-4", "E-5"]
PERIODS, SSPS, MANAGEMENTS = ["FP2140", "FP4160", "FP6180", "FP8100"], ["SSP126", "SSP370", "SSP585"], ["HRLM", "HILM"]
DIMS = ["map_code", "period_code", "ssp_code", "management_code"]


@pytest.fixture(scope="module")
def package(spark):
    layers = [(m, p, s, g, c) for m in ("CLS", "YLD") for p, s, g, c in product(PERIODS, SSPS, MANAGEMENTS, MODELS)]
    layers += [("CLS", p, "SSP126", "HRLM", "ENSEMBLE") for p in PERIODS] + [("YLD", p, "SSP126", g, "ENSEMBLE") for p in PERIODS[:3] for g in MANAGEMENTS]
    historical = [(m, "HP0120", "HIST", g, "AGERA5") for m in ("CLS", "YLD") for g in MANAGEMENTS]
    rows = []
    for k, (m, p, s, g, c) in enumerate(layers + historical):
        model = MODELS.index(c) if c in MODELS else 5
        for r, col in product(range(2), range(2)):
            cls = (r + col + model) % 7 + 1
            value = float(cls if m == "CLS" else 100 * cls + 10 * (int(s[-1]) if s != "HIST" else 0))
            rows.append((".".join((m, p, c, s, g)), m, p, s, g, c, r, col, 25.0, value, (r, col) != (1, 1)))
    cells = spark.createDataFrame(rows, "layer_id string, map_code string, period_code string, ssp_code string, management_code string, climate_model_code string, row int, column int, area double, value double, valid boolean")
    cells = cells.withColumn("value", F.when(F.col("valid"), F.col("value"))).cache()
    yield cells
    cells.unpersist()


def layer_table(cells):
    return cells.select("layer_id", *DIMS, "climate_model_code").distinct()


def five(cells, product_code):
    own = cells.where((F.col("map_code") == product_code) & F.col("climate_model_code").isin(*MODELS))
    u = sp.support_aligned(own, DIMS, "climate_model_code", MODELS, "value", "valid", "area")
    return u.withColumn("group_id", group_key("GRP", *DIMS))


def test_group_pair_and_comparison_counts(spark, package):
    layers = layer_table(package)
    assert layers.where("period_code <> 'HP0120'").count() == 250
    past = layers.where("period_code = 'HP0120'")
    matched, historical = cp.pairs_matched(layers, MODELS), cp.pairs_historical(layers, past)
    kinds = {r["comparison_kind"]: r["count"] for r in matched.unionByName(historical).groupBy("comparison_kind").count().collect()}
    assert kinds == {"cross_ssp": 240, "cross_period": 360, "historical_future": 250}
    units = cp.pair_units(matched.unionByName(historical), package, False)
    assert units.select("layer_a", "layer_b").distinct().count() == 850 and units.count() == 850 * 3
    cls, yld = five(package, "CLS"), five(package, "YLD")
    both = cls.unionByName(yld)
    groups = both.select("group_id", *DIMS).distinct()
    assert groups.count() == 48
    pairs = cp.group_pairs(groups)
    assert {r["comparison_kind"]: r["count"] for r in pairs.groupBy("comparison_kind").count().collect()} == {"cross_ssp": 48, "cross_period": 72}
    agreement = cs.pairwise_agreement(cls, ["group_id"], MODELS, "area").count()
    difference = cs.pairwise_difference(yld, ["group_id"], MODELS, "area").count()
    assert agreement + difference == 480
    assert cp.group_modal_comparison(cp.group_pair_units(pairs, cls), ["group_a", "group_b"], 5, every=None).count() == 60
    assert cp.group_metric_difference(cp.group_pair_units(pairs, yld), ["group_a", "group_b"], 5, every=None).select("group_a", "group_b").distinct().count() == 60


def test_ensemble_rows_and_support_closure(spark, package):
    key = [*DIMS, "row", "column"]
    sixth = package.where("climate_model_code = 'ENSEMBLE'").select(*key, F.col("value").alias("ensemble_value"))
    a = cp.ensemble_diagnostic(five(package, "CLS"), sixth, ["group_id"], key, 5, True, every=None).count()
    b = cp.ensemble_diagnostic(five(package, "YLD"), sixth, ["group_id"], key, 5, False, every=None).count()
    assert a + b == 10
    models = package.where(F.col("climate_model_code").isin(*MODELS))
    report = sp.support_report(models, DIMS, "climate_model_code", MODELS, "valid", "area", 110.0)
    assert report.count() == 48 and report.where("status <> 'OK' OR common_valid_area <> 75 OR excluded_masked_area <> 25 OR excluded_outside_footprint_area <> 10").count() == 0
    planned = layer_table(models)
    missing = sp.missing_members(planned, planned.where("NOT (period_code = 'FP2140' AND climate_model_code = 'C-3')"), DIMS, "climate_model_code", MODELS)
    gone = missing.where("status <> 'COMPLETE'").collect()
    assert len(gone) == 12 and all(r["missing_models"] == ["C-3"] and r["verified_model_count"] == 4 for r in gone)


def test_scenarios_have_both_products(spark, package):
    keys = ["period_code", "ssp_code", "management_code"]
    y = sc.scenario_yield_summary(cs.model_numeric(five(package, "YLD"), 5), keys)
    c = sc.scenario_class_summary(cs.model_consensus(five(package, "CLS"), list(range(1, 10)), 5), keys, list(range(1, 10)))
    assert y.count() == 24 and y.join(c, keys).count() == 24
    lined = sc.period_line_up(y.where("period_code <> 'FP8100'"), ["ssp_code", "management_code"], "period_code", PERIODS, ["whole_mean"])
    assert lined.count() == 24 and lined.where("NOT available").count() == 6
    assert stats.pooled_domain(package.where("map_code = 'YLD'"), ["management_code"], "value").count() == 2
