"""Layers that repeat geometries: what depends on the geometry alone is found once."""

from pyspark.sql import functions as F

from terrazone.operators import geometry as geo


def boxes(spark, rows, key):
    corners = [(k, 0, 0, i, x, y) for k, x0, y0, x1, y1 in rows for i, (x, y) in enumerate([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])]
    return geo.ring_edges(spark.createDataFrame(corners, f"{key} string, part int, ring int, seq int, x double, y double"), [key, "part", "ring"])


def test_copies_share_their_shape_and_all_of_them_are_returned(spark):
    zones = [(f"z{i}", 0.3, 0.3, 2.6, 2.1) for i in range(20)] + [("other", 10.0, 10.0, 12.0, 12.0), (None, 0.3, 0.3, 2.6, 2.1)]
    parts = [(f"f{i}", 1.0, 1.0, 1.5, 1.5) for i in range(30)] + [("edge", 2.0, 2.0, 4.0, 4.0), ("far", 30.0, 30.0, 31.0, 31.0), ("near", 2.9, 0.5, 3.5, 1.0)]
    z, f = boxes(spark, zones, "zone_id"), boxes(spark, parts, "feature_id")
    shapes, members = geo.by_shape(z, ["zone_id"], geo.ZONE_SHAPE)
    assert shapes.count() == 8 and members.count() == 22 and members.select(*geo.ZONE_SHAPE).distinct().count() == 2
    here = [k for k, *_ in zones if k != "other"]
    hit = {(k, n) for k in here for n in [f"f{i}" for i in range(30)] + ["edge"]}
    found = geo.feature_intersects(f, z, ["feature_id"], ["zone_id"], 1.0).collect()
    assert len(found) == len(hit) and {(r["zone_id"], r["feature_id"]) for r in found} == hit
    close = geo.features_near(f, z, ["feature_id"], ["zone_id"], 1.0, 0.5).collect()
    assert len(close) == len(hit) + len(here) and {(r["zone_id"], r["feature_id"]) for r in close} == hit | {(k, "near") for k in here}
    rings = spark.createDataFrame([(k, "a" if k == "edge" else "b", [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]) for k, x0, y0, x1, y1 in parts],
                                  "feature_id string, layer_id string, ring array<struct<x:double,y:double>>")
    areas = geo.feature_areas(rings, z, ["feature_id"], ["zone_id"], 1.0).collect()
    assert len(areas) == len(hit) and {(r["zone_id"], r["feature_id"]) for r in areas} == hit
    assert all(abs(r["clipped_area"] - (0.06 if r["feature_id"] == "edge" else 0.25)) < 1e-12 for r in areas)
    counts = {(r["layer_id"], r["zone_id"]): (r["feature_count"], round(r["clipped_area"], 9)) for r in geo.zone_feature_counts(rings, z, ["layer_id"], ["zone_id"], 1.0).collect()}
    assert counts == {(n, k): c for k in here for n, c in (("a", (1, 0.06)), ("b", (30, 7.5)))}
    pieces = geo.feature_clip(rings, z, ["zone_id"], 1.0).groupBy("feature_id", "zone_id").agg(F.sum("piece_area").alias("a"))
    assert pieces.count() == len(hit)
