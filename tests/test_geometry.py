import math
import random

import pytest
from pyspark.sql import functions as F

from terrazone.functions import geocols as g
from terrazone.operators import geometry as geo, support as sp

# Seven surveyed vertices in UTM zone 33N.
UTM = [(375142.89553203, 730553.78023993), (381315.67865558, 726934.57048810), (386655.47274849, 730036.88441500), (381124.21918453, 733184.44527635),
       (382254.47034824, 735241.34560231), (380256.00132039, 736073.12628858), (376031.75713711, 732703.05038135)]
LONLAT = [(13.870558527499307, 6.607974431675913), (13.926460317444779, 6.575363954152991), (13.974697548755477, 6.603524631138707), (13.924606687078198, 6.631887281739859),
          (13.93479013232794, 6.650513024605466), (13.91669625171208, 6.657996784201509), (13.878554150883298, 6.627431384994347)]
L_SHAPE = [(0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3)]


def vertices(spark, rings, zone="z"):
    """rings: list of (zone, part, ring, points) or one list of points."""
    if not isinstance(rings[0][0], str):
        rings = [(zone, 0, 0, rings)]
    data = [(z, p, r, i, float(x), float(y)) for z, p, r, pts in rings for i, (x, y) in enumerate(pts)]
    return spark.createDataFrame(data, "zone_id string, part int, ring int, seq int, x double, y double")


def clip_area(points, x0, y0, x1, y1):
    """Sutherland-Hodgman against a rectangle (area is right for any simple polygon)."""
    for axis, value, keep in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for p, q in zip(points, points[1:] + points[:1]):
            sp_, sq = keep * (p[axis] - value), keep * (q[axis] - value)
            if sp_ >= 0:
                out.append(p)
            if sp_ * sq < 0:
                t = sp_ / (sp_ - sq)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        points = out
        if not points:
            return 0.0
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1]))) / 2


def test_ring_metrics_golden(spark):
    m = geo.geo_ring_metrics(vertices(spark, UTM), ["zone_id"]).first()
    assert m["area"] / 1e4 == pytest.approx(5127.480571516418, abs=1e-6) and m["ring_orientation"] == "counterclockwise" and m["vertex_count"] == 7 and m["status"] == "OK"
    flat = geo.geo_ring_metrics(vertices(spark, [(0, 0), (1, 1), (2, 2)]), ["zone_id"]).first()
    assert flat["status"] == "ZERO_AREA" and flat["centroid_x"] is None
    assert geo.geo_ring_metrics(vertices(spark, [(0, 0), (1, 1)]), ["zone_id"]).first()["status"] == "TOO_FEW_VERTICES"


def test_utm_matches_the_published_positions(spark):
    got = geo.geo_utm_to_wgs84(vertices(spark, UTM), "x", "y").orderBy("seq").collect()
    for r, (lon, lat) in zip(got, LONLAT):
        assert r["lon"] == pytest.approx(lon, abs=2e-9) and r["lat"] == pytest.approx(lat, abs=2e-9)


def test_simple_rings(spark):
    rings = [("ok", 0, 0, UTM), ("bow", 0, 0, [(0, 0), (1, 1), (1, 0), (0, 1)]), ("dup", 0, 0, [(0, 0), (1, 0), (1, 1), (1, 0), (0, 2)]), ("touch", 0, 0, [(0, 0), (4, 0), (4, 2), (2, 0), (0, 2)]), ("l", 0, 0, L_SHAPE), ("two", 0, 0, [(0, 0), (1, 1)])]
    got = {r["zone_id"]: r["is_simple"] for r in geo.geo_is_simple(vertices(spark, rings), ["zone_id"]).collect()}
    assert got == {"ok": True, "bow": False, "dup": False, "touch": False, "l": True, "two": False}


def test_cell_weights_golden_box(spark):
    w = geo.cell_weights(vertices(spark, [(0, 0), (1.5, 0), (1.5, 1), (0, 1)]), ["zone_id"], 0.0, 1.0, 1.0, 1.0, geographic=False).orderBy("column").collect()
    assert [(r["row"], r["column"], r["weight"] / r["zone_area"]) for r in w] == [(0, 0, pytest.approx(2 / 3)), (0, 1, pytest.approx(1 / 3))]


@pytest.mark.parametrize("seed", range(3))
def test_cell_weights_equal_polygon_clipping(spark, seed):
    rng = random.Random(seed)
    n = 9
    rings = []
    for k in range(6):
        pts = [(5 + rng.uniform(1, 4) * math.cos(2 * math.pi * i / n), 5 + rng.uniform(1, 4) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        rings.append((f"z{k}", 0, 0, pts if k % 2 else pts[::-1]))
    rings.append(("L", 0, 0, L_SHAPE))
    got = {(r["zone_id"], r["row"], r["column"]): r["weight"] for r in geo.cell_weights(vertices(spark, rings), ["zone_id"], 0.0, 10.0, 0.75, 0.6, geographic=False).collect()}
    for z, _, _, pts in rings:
        for row in range(-1, 18):
            for column in range(-1, 15):
                want = clip_area(list(pts), column * .75, 10 - (row + 1) * .6, (column + 1) * .75, 10 - row * .6)
                assert got.get((z, row, column), 0.0) == pytest.approx(want, abs=1e-9), (z, row, column)


def test_cell_weights_with_hole_and_parts(spark):
    rings = [("z", 0, 0, [(0, 0), (4, 0), (4, 4), (0, 4)]), ("z", 0, 1, [(1, 1), (3, 1), (3, 3), (1, 3)]), ("z", 1, 0, [(10, 0), (11, 0), (11, 1), (10, 1)])]
    w = geo.cell_weights(vertices(spark, rings), ["zone_id"], 0.0, 4.0, 2.0, 2.0, geographic=False).collect()
    assert sum(r["weight"] for r in w) == pytest.approx(13) and w[0]["zone_area"] == pytest.approx(13)
    assert {(r["row"], r["column"]): round(r["weight"], 9) for r in w} == {(0, 0): 3, (0, 1): 3, (1, 0): 3, (1, 1): 3, (1, 5): 1}


@pytest.mark.parametrize("cell", [1 / 12, 1 / 120])
def test_equal_area_closure_on_geographic_grids(spark, cell):
    w = geo.cell_weights(vertices(spark, LONLAT), ["zone_id"], -180.0, 90.0, cell, cell)
    t = w.agg(F.sum("weight").alias("w"), F.max("zone_area").alias("z"), F.count("*").alias("n")).first()
    assert t["w"] == pytest.approx(t["z"], rel=1e-9) and t["z"] / 1e4 == pytest.approx(5129.796, abs=5e-3) and t["n"] == (4 if cell > .05 else 84)


def test_touched_cells_keep_boundary_contact(spark):
    got = {(r["row"], r["column"]) for r in geo.touched_cells(vertices(spark, [(1, 1), (2, 1), (2, 2), (1, 2)]), ["zone_id"], 0.0, 4.0, 1.0, 1.0).collect()}
    assert got == {(r, c) for r in (1, 2, 3) for c in (0, 1, 2)}


def test_l_shape_intersection_containment_and_clip(spark):
    box = lambda n, x0, y0, x1, y1: (n, 0, 0, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)])
    boxes = [box("inside", .2, .2, .4, .4), box("around", -5, -5, 9, 9), box("notch", 1.5, 1.5, 2.5, 2.5), box("cross", 2, -1, 2.5, 5), box("far", 20, 20, 21, 21), box("near", 3.3, 0, 3.6, .5)]
    f = geo.ring_edges(vertices(spark, boxes).withColumnRenamed("zone_id", "feature_id"), ["feature_id", "part", "ring"])
    z = geo.ring_edges(vertices(spark, L_SHAPE), ["zone_id", "part", "ring"])
    hit = {r["feature_id"] for r in geo.feature_intersects(f, z, ["feature_id"], ["zone_id"], 1.0).collect()}
    assert hit == {"inside", "around", "cross"}
    near = {r["feature_id"] for r in geo.features_near(f, z, ["feature_id"], ["zone_id"], 1.0, 0.5).collect()}
    assert near == {"inside", "around", "cross", "notch", "near"}
    rows = [(n, f"name {n}", [(float(x), float(y)) for x, y in pts]) for n, _, _, pts in boxes]
    features = spark.createDataFrame(rows, "feature_id string, name string, ring array<struct<x:double,y:double>>")
    area = {r["feature_id"]: r["a"] for r in geo.feature_clip(features, z, ["zone_id"], 1.0).groupBy("feature_id").agg(F.sum("piece_area").alias("a")).collect()}
    assert area == {"inside": pytest.approx(.04), "around": pytest.approx(5), "cross": pytest.approx(.5)}


def test_slope_of_a_plane_is_45_degrees(spark):
    cells = spark.range(900).select(F.lit("d").alias("layer_id"), F.floor(F.col("id") / 30).alias("row"), (F.col("id") % 30).alias("column"), (F.col("id") % 30 * 30.0).alias("z"))
    out = geo.slope_degrees(cells, ["layer_id"], "z", 30.0, 30, 30).agg(F.min("slope").alias("a"), F.max("slope").alias("b")).first()
    assert out["a"] == pytest.approx(45) and out["b"] == pytest.approx(45)


def test_modal_composite_rules(spark):
    df = spark.createDataFrame([("a", 2, .7), ("a", 1, .7), ("a", 1, .7), ("a", 2, .9), ("a", 3, .5), ("b", 1, .9), ("b", 1, .9)], "cell string, label int, p double")
    got = geo.modal_composite(df, ["cell"], "label", ["p"]).collect()
    assert [(r["cell"], r["label"], r["observation_count"]) for r in got] == [("a", 1, 4)]


def grid_rects(name, ox, oy, values, masked=()):
    return [("g", name, f"{name}{r}{c}", ox + c, oy - r - 1.0, ox + c + 1.0, oy - r, values[r][c], (r, c) not in masked) for r in range(2) for c in range(2)]


def test_shifted_grids_give_five_units(spark):
    rows = grid_rects("a", 0.0, 2.0, [[10., 20.], [30., 40.]]) + grid_rects("b", .5, 2.0, [[50., 60.], [70., 80.]], {(0, 1)})
    cells = spark.createDataFrame(rows, "group_id string, layer string, cell_id string, x0 double, y0 double, x1 double, y1 double, value double, valid boolean")
    u = sp.support_overlay(cells, ["group_id"], "layer", ["a", "b"], "value", "valid", 4.0, tile=2.0)
    assert u.count() == 5 and u.agg(F.sum("area")).first()[0] == pytest.approx(2.5)
    assert sp.overlap_area(u, ["group_id"], 2.0).first()["overlap_area"] == 0


def test_overlap_counts_copies_once_per_extra_layer(spark):
    df = spark.createDataFrame([("g", 0.0, 0.0, 2.0, 1.0)] * 3 + [("g", 1.0, 0.0, 3.0, 1.0)], "group_id string, x0 double, y0 double, x1 double, y1 double")
    r = sp.unit_overlap_check(df, ["group_id"], 1.5, (0.0, 0.0, 4.0, 4.0)).first()
    assert r["union_area"] == pytest.approx(3) and r["overlap_area"] == pytest.approx(5) and r["status"] == "OVERLAPPING_UNITS"


def test_cell_id_format(spark):
    df = spark.createDataFrame([("EPSG:4326", -180.0, 90.0, 1 / 12, 1 / 12)], "c string, x double, y double, dx double, dy double")
    assert df.select(g.cell_id("c", "x", "y", "dx", "dy")).first()[0] == f"EPSG:4326:{-180.0:.10f}:{90.0:.10f}:{1/12:.10f}:{1/12:.10f}"


def test_densified_edges_join_up(spark):
    e = geo.geo_densify(geo.ring_edges(vertices(spark, L_SHAPE), ["zone_id"]), 0.4).orderBy("seq", "part_seq").collect()
    assert all(math.hypot(r["x2"] - r["x1"], r["y2"] - r["y1"]) <= .4 + 1e-12 for r in e)
    assert all((a["x2"], a["y2"]) == pytest.approx((b["x1"], b["y1"])) for a, b in zip(e, e[1:] + e[:1]))
