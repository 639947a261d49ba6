"""Overlays of different grids inside a slanted zone, support of any sets of layers, containment, pairs by position."""

import pytest
from pyspark.sql import functions as F

from terrazone.operators import compare, inside, support
from test_inside import vertices

CELL = "group_id string, layer string, cell_id string, x0 double, y0 double, x1 double, y1 double, value double, valid boolean"


def two_grids(spark):
    """Cells of size 1: a 2 x 2 grid at (0, 0), and one shifted by half a cell of which one cell is masked."""
    rows = [("g", "a", f"a{i}{j}", float(j), float(i), j + 1.0, i + 1.0, 10.0 * (2 * i + j + 1), True) for i in range(2) for j in range(2)]
    rows += [("g", "b", f"b{i}{j}", j + 0.5, float(i), j + 1.5, i + 1.0, 10.0 * (2 * i + j + 5), (i, j) != (1, 1)) for i in range(2) for j in range(2)]
    return spark.createDataFrame(rows, CELL)


def slanted(spark, hole=False):
    rings = [("z", 0, 0, [(0, 0), (2, 0), (2, 2), (1, 2)])] + ([("z", 0, 1, [(1.5, 0.25), (1.75, 0.25), (1.75, 0.75), (1.5, 0.75)])] if hole else [])
    return inside.oriented_edges(vertices(spark, rings).drop("zone_id"), [])


def test_units_are_clipped_and_closed(spark):
    args = (["group_id"], "layer", ["a", "b"], "value", "valid", 3.0, 2.0)
    units = support.support_overlay(two_grids(spark), *args, zone_edges=slanted(spark)).collect()
    by_ids = {tuple(r["cell_ids"]): (r["area"], r["unit_id"], r["values"]) for r in units}
    # the slanted border runs from (0, 0) to (1, 2)
    want = {("a00", "b00"): 0.5, ("a01", "b00"): 0.5, ("a01", "b01"): 0.5, ("a10", "b10"): 0.25, ("a11", "b10"): 0.5}
    assert {k: v[0] for k, v in by_ids.items()} == pytest.approx(want)
    assert sorted(v[1] for v in by_ids.values()) == [f"u{i:05d}" for i in range(1, 6)] and by_ids[("a11", "b10")][2] == [40.0, 70.0]
    report = support.overlay_report(two_grids(spark), *args, zone_edges=slanted(spark)).first()
    assert report["common_valid_area"] == pytest.approx(2.25) and report["excluded_masked_area"] == pytest.approx(0.5)
    assert report["excluded_outside_footprint_area"] == pytest.approx(0.25) and report["status"] == "OK" and report["native_cell_counts"] == [4, 3]


def test_a_group_without_common_cells(spark):
    cells = two_grids(spark).where("layer = 'a'")
    report = support.overlay_report(cells, ["group_id"], "layer", ["a", "b"], "value", "valid", 3.0, 2.0, slanted(spark)).first()
    assert (report["quality_flag"], report["common_valid_area"], report["excluded_outside_footprint_area"], report["native_cell_counts"]) == ("NO_COMMON_VALID_SUPPORT", 0.0, 3.0, [0, 0])


def test_a_unit_in_a_hole_lies_outside(spark):
    unit = lambda *r: spark.createDataFrame([("g", *r)], "group_id string, x0 double, y0 double, x1 double, y1 double")
    check = lambda u: support.unit_overlap_check(u, ["group_id"], 1.0, zone_edges=slanted(spark, True), zone_area=2.875).first()["status"]
    assert check(unit(1.5, 0.25, 1.75, 0.75)) == "OUTSIDE_ZONE" and check(unit(1.0, 0.0, 1.5, 0.5)) == "OK" and check(unit(0.0, 1.0, 0.4, 1.5)) == "OUTSIDE_ZONE"


def test_support_of_any_subset_with_many_layers(spark):
    names = [f"l{i:03d}" for i in range(130)]
    rows = [(name, p // 5, p % 5, 1.0 + p, (p + i) % (3 + i % 4) > 0) for i, name in enumerate(names) for p in range(20) if (p * 7 + i) % 11]
    cells = spark.createDataFrame(rows, "layer_id string, `row` int, `column` int, area double, valid boolean").withColumn("grid", F.lit("one"))
    bitmaps = support.presence_bitmaps(cells, ["grid"], "layer_id", names, "valid", "area")
    sets = {"pair": names[:2], "far": [names[0], names[129]], "five": names[60:65], "all": names, "one": [names[63]]}
    subsets = spark.createDataFrame([("one", k, v) for k, v in sets.items()] + [("two", "nothing", names[:1])], "grid string, name string, layers array<string>")
    got = {r["name"]: r for r in support.subset_support(bitmaps, ["grid"], subsets.withColumn("need", support.layer_bits(names, F.col("layers"))).drop("layers"), 500.0).collect()}
    for k, members in sets.items():
        here = [p for p in range(20) if all(any(r[0] == n and r[1:3] == (p // 5, p % 5) for r in rows) for n in members)]
        valid = [p for p in here if all(r[4] for r in rows if r[0] in members and r[1:3] == (p // 5, p % 5))]
        r = got[k]
        assert (r["common_valid_area"], r["analytical_unit_count"], r["excluded_masked_area"]) == (sum(1.0 + p for p in valid), len(valid), sum(1.0 + p for p in here if p not in valid))
    assert got["nothing"]["quality_flag"] == "NO_COMMON_VALID_SUPPORT" and got["nothing"]["excluded_outside_footprint_area"] == 500.0


def test_pairs_meet_at_positions_in_one_shuffle(spark):
    cells = spark.createDataFrame([(f"l{i}", r, 0, 1.0, float(i * r) if (i + r) % 3 else None) for i in range(4) for r in range(6)], "layer_id string, `row` int, `column` int, area double, value double")
    pairs = spark.createDataFrame([("k", "l0", "l1"), ("k", "l2", "l1"), ("k", "l0", "gone")], "comparison_kind string, layer_a string, layer_b string")
    units = compare.pair_units(pairs, cells, False)
    got = sorted((r["layer_a"], r["layer_b"], r["row"], r["value_a"], r["value_b"]) for r in units.collect())
    want = sorted((a, b, r, float(int(a[1]) * r), float(int(b[1]) * r)) for a, b in (("l0", "l1"), ("l2", "l1")) for r in range(6) if (int(a[1]) + r) % 3 and (int(b[1]) + r) % 3)
    assert got == want
    shuffles = compare.transition_matrix(compare.pair_units(pairs, cells, True), ["layer_a", "layer_b"])._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles <= 4
