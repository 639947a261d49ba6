import math

import pytest
from pyspark.sql import functions as F

from terrazone.operators import compare as cp, consensus as cs, scenario as sc
from terrazone.plans import q_consensus as q

M = ["m1", "m2", "m3", "m4", "m5"]
LABELS = {c: f"class {c}" for c in range(1, 10)}


def units(spark, *lists, area=None):
    data = [("g", i, float(area[i] if area else 1), [float(x) for x in v]) for i, v in enumerate(lists)]
    return spark.createDataFrame(data, "group_id string, unit_id int, area double, values array<double>")


def test_unit_values_flags_missing_repeated_and_unexpected(spark):
    data = [("a", m, 1.0) for m in M] + [("b", m, 1.0) for m in M[:4]] + [("c", m, 1.0) for m in [*M, "m1"]] + [("d", m, 1.0) for m in [*M, "ENSEMBLE"]]
    df = spark.createDataFrame(data, "u string, model string, v double")
    got = {r["u"]: r["status"] for r in cs.unit_values(df, ["u"], "model", "v", M).collect()}
    assert got == {"a": "COMPLETE", "b": "MISSING_MODEL", "c": "REPEATED_MODEL", "d": "UNEXPECTED_MODEL"}


def test_model_consensus_golden(spark):
    u = units(spark, [1, 1, 2, 2, 3], [1, 2, 3, 4, 4], [5, 5, 5, 5, 1], [9, 9, 9, 9, 9], [1, 1, 1, 2, 3])
    got = cs.class_extremes(cs.model_consensus(u, list(range(1, 10)), 5), LABELS, 9).orderBy("unit_id").collect()
    tie, four, strong, water, major = got
    assert tie["modal_class"] is None and tie["tied_modal_classes"] == [1, 2] and tie["modal_count"] == 2 and tie["agreement_group"] == "Tied / dispersed"
    assert four["modal_class"] == 4 and four["tied_or_dispersed"] == 1 and four["tie_flag"] == 0
    assert strong["strong_agreement"] == 1 and strong["full_agreement"] == 0 and strong["modal_class"] == 5 and strong["lowest_suitability_label"] == "class 5"
    assert water["full_agreement"] == 1 and water["highest_suitability_label"] is None and water["water_present"]
    assert major["agreement_group"] == "3/5 majority" and major["class_frequencies"][1] == 3 and major["unique_class_count"] == 3


def test_model_numeric_golden(spark):
    a, b, zero = cs.model_numeric(units(spark, [1, 2, 3, 4, 5], [0, 10, 20, 30, 40], [0] * 5), 5).orderBy("unit_id").collect()
    assert (a["model_mean"], a["model_median"], a["model_iqr"], a["model_range"]) == (3, 3, 2, 4) and a["model_standard_deviation"] == pytest.approx(math.sqrt(2))
    assert b["model_iqr"] == 20 and b["model_standard_deviation"] == pytest.approx(math.sqrt(200)) and b["zero_model_count"] == 1
    assert zero["model_coefficient_of_variation"] is None and zero["cv_status"] == "UNDEFINED_NONPOSITIVE_MEAN" and zero["valid_zero_yield"]


def test_pairs_and_frequencies_have_ten_and_nine_rows(spark):
    u = units(spark, [1, 1, 2, 2, 3])
    p = cs.pairwise_agreement(u, ["group_id"], M, "area").collect()
    assert len(p) == 10 and sum(r["agreement_area"] for r in p) == 2
    assert cs.pairwise_difference(u, ["group_id"], M, "area").count() == 10
    f = cs.class_frequency_dense(u, ["unit_id"], list(range(1, 10)), 5).collect()
    assert len(f) == 9 and sum(r["model_count"] for r in f) == 5


def test_scenario_yield_golden(spark):
    s = sc.scenario_yield_summary(cs.model_numeric(units(spark, [0] * 5, [0, 10, 20, 30, 40], area=[2, 1]), 5), ["group_id"]).first()
    assert s["whole_mean"] == pytest.approx(20 / 3) and s["positive_area_mean"] == 20 and s["valid_zero_area"] == 2
    assert s["inter_model_cv"] == pytest.approx(math.sqrt(200) / 20) and s["cv_valid_area"] == 1 and s["partition_status"] == "OK"
    none = sc.scenario_yield_summary(cs.model_numeric(units(spark, [0] * 5), 5), ["group_id"]).first()
    assert none["positive_area_mean"] is None and none["inter_model_cv"] is None and none["positive_area_mean_status"] == "NO_POSITIVE_AREA"


def test_scenario_class_golden(spark):
    u = units(spark, [1] * 5, [2, 2, 2, 2, 3], [4, 4, 4, 5, 6], [7, 7, 8, 8, 9], area=[30, 10, 20, 40])
    s = sc.scenario_class_summary(cs.model_consensus(u, list(range(1, 10)), 5), ["group_id"], list(range(1, 10))).first()
    assert s["dominant_class"] == 1 and s["dominant_class_percentage"] == 30
    assert (s["full_agreement_percentage"], s["strong_agreement_percentage"], s["majority_agreement_percentage"], s["tie_flag_percentage"]) == (30, 40, 20, 40)
    equal = units(spark, [1] * 5, [2] * 5, area=[5, 5])
    t = sc.scenario_class_summary(cs.model_consensus(equal, list(range(1, 10)), 5), ["group_id"], list(range(1, 10))).first()
    assert t["dominant_class"] is None and t["dominant_class_area"] is None


def test_stacked_shares_floor_at_zero(spark):
    df = spark.createDataFrame([("s", 50.0, 40.0, 5.0, 5.0)], "k string, full_agreement_percentage double, strong_agreement_percentage double, majority_agreement_percentage double, tied_or_dispersed_percentage double")
    assert {r["share"]: r["percentage"] for r in sc.stacked_shares(df, ["k"]).collect()}["exactly_four"] == 0


def test_follow_up_checks_branches(spark):
    df = spark.createDataFrame([("a", True, True, 100.0, 100.0, 0.0, 0.0, "HRLM"), ("b", True, True, 99.0, 100.0, 5.0, 2.0, "HILM"), ("c", True, True, 100.0, 100.0, 5.0, 0.0, "HRLM"), ("d", False, True, None, 100.0, None, 1.0, None)],
                               "k string, suitability_valid boolean, yield_valid boolean, suitability_coverage double, yield_coverage double, tied_or_dispersed_percentage double, valid_zero_area double, management_code string")
    got = {}
    for r in sc.follow_up_checks(df, ["k"]).orderBy("k", "check_order").collect():
        got.setdefault(r["k"], []).append(r["check_code"])
    assert got == {"a": ["CHECK_LOCALLY", "CHECK_OTHER_FUTURES", "CHECK_WATER"],
                   "b": ["CHECK_LOCALLY", "CHECK_UNCOVERED_AREA", "INVESTIGATE_ZERO_YIELD", "CHECK_IRRIGATION"],
                   "c": ["CHECK_LOCALLY", "INVESTIGATE_DISAGREEMENT", "CHECK_WATER"],
                   "d": ["COMPLETE_EVIDENCE", "CHECK_OTHER_FUTURES", "INVESTIGATE_ZERO_YIELD", "CHECK_WATER"]}


def test_difference_units_golden(spark):
    cells = spark.createDataFrame([("h", r, 0, 1.0, v) for r, v in enumerate([0.0, 10.0, 20.0, 30.0])] + [("f", r, 0, 1.0, v) for r, v in enumerate([5.0, 20.0, 30.0, 60.0])],
                                  "layer_id string, row int, column int, area double, value double")
    pairs = spark.createDataFrame([("historical_future", "h", "f")], "comparison_kind string, layer_a string, layer_b string")
    u = cp.pair_units(pairs, cells, False).orderBy("row").collect()
    assert (u[0]["absolute_difference"], u[0]["percentage_difference"], u[0]["percentage_status"]) == (5, None, "UNDEFINED_ZERO_BASELINE")
    assert (u[1]["absolute_difference"], u[1]["percentage_difference"]) == (10, 100)


def test_group_comparison_excludes_ties_and_ensemble_matches(spark):
    u = spark.createDataFrame([("A", 0, 0, 1.0, [1.0, 1.0, 2.0, 2.0, 3.0]), ("A", 0, 1, 1.0, [1.0] * 5), ("B", 0, 0, 1.0, [2.0] * 5), ("B", 0, 1, 1.0, [1.0] * 4 + [2.0])],
                              "group_id string, row int, column int, area double, values array<double>")
    pairs = spark.createDataFrame([("cross_ssp", "A", "B")], "comparison_kind string, group_a string, group_b string")
    g = cp.group_modal_comparison(cp.group_pair_units(pairs, u), ["group_a", "group_b"], 5, every=None).first()
    assert g["modal_comparable_area"] == 1 and g["tied_mode_excluded_area"] == 1 and g["unanimity_a_area"] == 1 and g["strong_agreement_b_area"] == 2
    ens = spark.createDataFrame([("A", 0, 0, 1.0), ("A", 0, 1, 1.0)], "group_id string, row int, column int, ensemble_value double")
    e = cp.ensemble_diagnostic(u.where("group_id = 'A'"), ens, ["group_id"], ["group_id", "row", "column"], 5, True, every=None).first()
    assert e["matching_percentage"] == 100 and e["tied_mode_excluded_area"] == 1


def test_the_spatial_summary_query_has_all_eight_metrics(spark, tmp_path):
    """Two units of one group, areas 1 and 3; the second unit's values are zero, so its CV is undefined and skipped."""
    prices = {1: [10.0, 20.0, 30.0, 40.0, 50.0], 2: [0.0] * 5}
    orders = [(k, q.MODELS[i], v) for k, vs in prices.items() for i, v in enumerate(vs)] + [(3, q.MODELS[0], 7.0)]
    spark.createDataFrame(orders, "o_custkey long, o_orderpriority string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "g", 0), (2, "g", 2), (3, "g", 4)], "c_custkey long, c_mktsegment string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    got = {r["metric"]: r for r in q.metric_spatial_summary(spark, str(tmp_path)).collect()}
    sd = round(math.sqrt(200), 4)
    want = {"model_mean": 30, "model_median": 30, "model_minimum": 10, "model_maximum": 50, "model_standard_deviation": sd, "model_iqr": 20, "model_range": 40}
    assert set(got) == set(cs.NUMERIC_METRICS)
    for metric, top in want.items():
        r = got[metric]
        assert (r["min"], r["max"], r["median"], r["p95"]) == (0, top, 0, top) and r["mean"] == pytest.approx(top / 4, abs=1e-4), metric
    cv = got["model_coefficient_of_variation"]
    assert cv["min"] == cv["max"] == cv["mean"] == round(math.sqrt(200) / 30, 4) and cv["std"] == 0 and cv["quality_flag"] == "FEW_NATIVE_CELLS"
