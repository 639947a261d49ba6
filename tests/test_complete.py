"""Rows that must not get lost: comparisons without shared cells, months without observations, undeclared layers, repeated keys, equal file names."""

import hashlib
import json

from pyspark.sql import functions as F

from terrazone import plans
from terrazone.operators import audit, compare as cp, rules, scenario, timeagg as ta
from terrazone.plans import q_io
from terrazone.sources import readers as rd, sinks as sk


def test_pairs_without_shared_cells_have_a_row(spark):
    cells = spark.createDataFrame([("a", 0, 0, 1.0, 2.0), ("b", 0, 0, 1.0, 3.0), ("c", 5, 5, 1.0, 4.0)], "layer_id string, row int, column int, area double, value double")
    pairs = spark.createDataFrame([("k", "a", "b"), ("k", "a", "c")], "comparison_kind string, layer_a string, layer_b string")
    keys = ["comparison_kind", "layer_a", "layer_b"]
    units = cp.pair_units(pairs, cells, False)
    totals = {r["layer_b"]: r for r in cp.difference_totals(units, keys, every=pairs).collect()}
    assert (totals["c"]["support_status"], totals["c"]["percentage_defined_area"]) == ("NO_COMMON_VALID_SUPPORT", 0.0) and totals["b"]["support_status"] == "OK"
    rows = cp.difference_summary(units, keys, every=pairs).collect()
    assert len(rows) == 8 and sum(r["support_status"] == "NO_COMMON_VALID_SUPPORT" and r["mean"] is None for r in rows) == 4
    classes = cp.transition_totals(cp.pair_units(pairs, cells, True), keys, every=pairs).where("support_status <> 'OK'").collect()
    assert [(r["layer_b"], r["common_area"], r["agreement_percentage"]) for r in classes] == [("c", 0.0, None)]


def test_months_without_observations_have_a_row(spark):
    obs = spark.sql("SELECT 'l' k, 1 cell, TIMESTAMP '2024-01-01' s, TIMESTAMP '2024-02-01' e, 2.0D v, 1.0D w UNION ALL SELECT 'l', 1, TIMESTAMP '2024-04-01', TIMESTAMP '2024-05-01', 3.0D, 1.0D")
    cells = ta.completeness_gate(ta.aggregate_interval(obs, ["k"], "cell", "s", "e", "v", F.lit("duration_mean"), carry=["w"]))
    months = ta.zone_month_value(cells, ["k"], "w", F.lit(1.0), F.lit("duration_mean"))
    spans = spark.sql("SELECT 'l' k, TIMESTAMP '2024-01-01' a, TIMESTAMP '2024-05-01' b")
    counts = ta.observation_counts(obs, ["k"], "s", "e", "v", "w")
    rows = ta.every_month(months, ["k"], spans, "a", "b", counts, F.lit("monthly")).orderBy("period_start").collect()
    assert [(r["value"], r["quality_flag"], r["observation_count"], r["expected_observation_count"], r["expected_days"]) for r in rows] == [
        (2.0, "OK", 1, 1, 31.0), (None, "INSUFFICIENT_COVERAGE", 0, 1, 29.0), (None, "INSUFFICIENT_COVERAGE", 0, 1, 31.0), (3.0, "OK", 1, 1, 30.0)]


def test_a_layer_without_declared_grid_fails(spark):
    grid = "layer_id string, crs string, dx double, dy double, x0 double, y0 double, rotation double, width int, height int, dtype string, nodata double, scale double, offset double, unit string, bands int"
    row = ("EPSG:4326", 1.0, 1.0, 0.0, 0.0, 0.0, 4, 4, "f", -1.0, 1.0, 0.0, "t", 1)
    out = rules.grid_contract(spark.createDataFrame([("a", *row), ("b", *row)], grid), spark.createDataFrame([("a", *row)], grid))
    assert {r["layer_id"]: r["grid_status"] for r in out.collect()} == {"a": "OK", "b": "NO_EXPECTATION"}


def test_repeated_ids_are_marked_and_kept(spark):
    base = spark.createDataFrame([("x", "S", "A", "E"), ("y", "S", "A", "E")], "dataset_id string, final_status string, final_action string, final_evidence string")
    updates = spark.createDataFrame([("x", "N", "B", True, "e", None), ("x", "M", "B", True, "e", None), ("y", "N", "B", True, "e", None)], "dataset_id string, status string, action string, confirmed boolean, evidence string, failure_reason string")
    rows = {r["dataset_id"]: r for r in rules.decision_override(base, updates).collect()}
    assert (rows["x"]["gate_status"], rows["x"]["final_status"]) == ("DUPLICATE_UPDATE", "S") and rows["y"]["final_status"] == "N"
    groups = spark.createDataFrame([("g", "s1", "p"), ("g", "s2", "p"), ("h", "s3", "p")], "group_id string, scenario string, product string")
    resolved = audit.contract_resolve(groups, spark.createDataFrame([], "group_id string, check_ord int, reason string"), ["scenario"], "product").collect()
    assert sorted((r["group_id"], r["scenario"], r["status"]) for r in resolved) == [("g", "s1", "SOURCE_CONFLICT"), ("g", "s2", "SOURCE_CONFLICT"), ("h", "s3", "RESOLVED")]


def test_manifest_paths_are_relative_to_the_folder(spark):
    path = sk.work_dir(spark)
    for name, text in (("a", "one"), ("b", "two two")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "|").text(f"{path}/{name}")
    rows = rd.file_manifest(spark, path, "part-*").collect()
    assert sorted(r["path"].split("/")[0] for r in rows if r["size"]) == ["a", "b"]
    assert {r["sha256"] for r in rows if r["size"]} == {hashlib.sha256(t).hexdigest() for t in (b"one|", b"two two|")}
    assert {r["status"] for r in rows} == {"OK"}
    # files beyond a limit are streamed through the digest, with the same result
    assert sorted(rd.file_manifest(spark, path, "part-*", largest=5).collect()) == sorted(rows)


def test_negative_values_and_unlisted_classes_are_rejected(spark):
    numeric = spark.createDataFrame([("a", 1.0, 2.0, -1.0), ("b", 1.0, 2.0, 0.0)], "group_id string, area double, model_mean double, model_minimum double").selectExpr(
        "*", "0.1D model_coefficient_of_variation", "1.0D model_standard_deviation", "1.0D model_iqr", "1.0D model_range", "3.0D model_maximum")
    assert {r["group_id"]: r["input_status"] for r in scenario.scenario_yield_summary(numeric, ["group_id"]).collect()} == {"a": "NEGATIVE_VALUE", "b": "OK"}
    classes = spark.createDataFrame([("a", 1.0, 12, [12.0, 1.0]), ("b", 1.0, 1, [1.0, 2.0]), ("c", 1.0, 1, [1.0, 7.5])], "group_id string, area double, modal_class int, values array<double>")
    classes = classes.withColumns({f: F.lit(0) for f in scenario.CLASS_FLAGS}).withColumn("unique_class_count", F.lit(2))
    assert {r["group_id"]: r["input_status"] for r in scenario.scenario_class_summary(classes, ["group_id"], [1, 2, 3]).collect()} == {"a": "UNLISTED_CLASS", "b": "OK", "c": "UNLISTED_CLASS"}


def test_json_lists_of_a_hot_conversation_are_bounded(spark, tmp_path, monkeypatch):
    rows = spark.range(9000).select(F.when(F.col("id") < 8000, 7).otherwise(F.col("id")).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("text "), "id").alias("text"))
    rows.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    monkeypatch.setattr(q_io.sk, "work_dir", lambda spark: f"{tmp_path}/lists")
    back = plans.QUERIES["scan_json_records"](spark, str(tmp_path))
    assert back.count() == 9000 and back.select("turn").distinct().count() == 9000
    sizes = [len(json.loads(f.read_text())) for f in (tmp_path / "lists").glob("part-*") if f.stat().st_size]
    assert sum(sizes) == 9000 and max(sizes) <= 2000
