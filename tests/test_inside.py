import math

import numpy as np
import pytest

from terrazone.operators import inside

VERTEX = "zone_id string, part int, ring int, seq int, x double, y double"


def vertices(spark, rings):
    """rings: (zone, part, ring, [(x, y), ...])."""
    rows = [(z, p, r, i, float(x), float(y)) for z, p, r, points in rings for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, VERTEX).repartition(4)


def clipped(points, x0, y0, x1, y1):
    """Area of a simple ring inside a rectangle, by cutting at one side after another."""
    for axis, bound, keep in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for p, q in zip(points, points[1:] + points[:1]):
            a, b = keep * (p[axis] - bound), keep * (q[axis] - bound)
            if a >= 0:
                out.append(p)
            if a * b < 0:
                t = a / (a - b)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        points = out
        if not points:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, points[1:] + points[:1]))) / 2


def areas(spark, rings, rects, tile):
    edges = inside.oriented_edges(vertices(spark, rings), ["zone_id"])
    df = spark.createDataFrame([(z, i, *map(float, r)) for i, (z, r) in enumerate(rects)], "zone_id string, unit int, x0 double, y0 double, x1 double, y1 double")
    return {r["unit"]: r["inside_area"] for r in inside.rectangle_areas(df, ["unit"], edges, ["zone_id"], tile).collect()}


def want(rings, zone, rect):
    return sum((1 if r == 0 else -1) * clipped([(float(x), float(y)) for x, y in points], *rect) for z, p, r, points in rings if z == zone)


STAR = [(10 + 8 * math.cos(0.3 + k * 0.7) * (1 if k % 2 else 0.6), 9 + 8 * math.sin(0.3 + k * 0.7) * (1 if k % 2 else 0.6)) for k in range(9)][:8]
RINGS = [("slanted", 0, 0, [(0, 0), (10, 3), (12, 11), (3, 9)]), ("slanted", 0, 1, [(4, 4), (8, 5), (7, 8)]),
         ("two", 0, 0, [(1, 1), (1, 6), (6, 6), (6, 1)]), ("two", 0, 1, [(2, 2), (4, 2), (4, 4), (2, 4)]), ("two", 1, 0, [(8.5, 1.25), (14, 1.25), (11, 7)]),
         ("star", 0, 0, STAR)]


@pytest.mark.parametrize("tile", [1.0, 3.0, 7.5, 100.0])
def test_rectangles_of_any_grid(spark, tile):
    draw = np.random.default_rng(int(tile))
    rects = [(z, (x, y, x + w, y + h)) for z in ("slanted", "two", "star") for x, y, w, h in
             [*[(float(i), float(j), 1.0, 1.0) for i in range(-1, 15, 2) for j in range(-1, 13, 2)],
              *[(float(a), float(b), float(c), float(d)) for a, b, c, d in zip(draw.uniform(-2, 13, 25), draw.uniform(-2, 11, 25), draw.uniform(0.1, 6, 25), draw.uniform(0.1, 6, 25))],
              (-5.0, -5.0, 30.0, 30.0), (1.0, 1.0, 5.0, 5.0), (2.0, 2.0, 2.0, 2.0), (1.0, 6.0, 5.0, 1.0), (0.0, 0.0, 10.0, 3.0)]]
    got = areas(spark, RINGS, rects, tile)
    for i, (z, r) in enumerate(rects):
        assert got[i] == pytest.approx(want(RINGS, z, r), abs=1e-9), (tile, z, r)


def test_points_on_borders_count_for_the_cell_above_and_right(spark):
    edges = inside.oriented_edges(vertices(spark, RINGS), ["zone_id"])
    points = [(i, "two", x / 2, y / 2) for i, (x, y) in enumerate((x, y) for x in range(0, 30) for y in range(0, 16))]
    df = spark.createDataFrame(points, "point int, zone_id string, x double, y double")
    for tile in (1.0, 2.5, 50.0):
        got = {r["point"]: r["winding"] for r in inside.windings(df, edges, ["point"], ["zone_id"], tile).collect()}
        eps = 1e-5
        for i, z, x, y in points:
            assert got[i] == round(want(RINGS, z, (x + eps, y + eps * 1e-2, x + 2 * eps, y + eps * 1.1e-2)) / (eps * eps * 1e-3)), (tile, x, y)


def test_a_diagonal_has_at_most_three_pieces_a_tile_and_no_others(spark):
    edges = spark.createDataFrame([("d", 0.3, 0.1, 1000.2, 990.7), ("v", 5.0, 0.0, 5.0, 40.0), ("h", 0.0, 5.0, 40.0, 5.0)], "e string, x1 double, y1 double, x2 double, y2 double")
    pieces = inside.tile_pieces(edges, ["e"], 1.0).collect()
    rows = [r for r in pieces if r["e"] == "d"]
    assert 1000 <= len(rows) <= 3 * 1001 and len({(r["_tx"], r["_ty"]) for r in rows}) == len(rows)
    assert sum(math.hypot(r["xe"] - r["xs"], r["ye"] - r["ys"]) for r in rows) == pytest.approx(math.hypot(999.9, 990.6))
    assert all(r["_tx"] <= min(r["xs"], r["xe"]) + 1e-9 and max(r["xs"], r["xe"]) <= r["_tx"] + 1 + 1e-9 for r in rows)
    assert len([r for r in pieces if r["e"] == "v"]) == 40 and len([r for r in pieces if r["e"] == "h"]) == 40


def test_equal_area_zone_closes(spark):
    """A slanted zone in longitude and latitude: the cells of a grid in the equal-area plane add up to the zone."""
    ring = [(13.87, 6.57), (13.97, 6.575), (13.98, 6.655), (13.9, 6.66)]
    edges = inside.equal_area_edges(inside.oriented_edges(vertices(spark, [("z", 0, 0, ring)]), ["zone_id"]), 0.001)
    e = edges.collect()
    x0, y0 = min(r["x1"] for r in e) // 1000 * 1000, min(r["y1"] for r in e) // 1000 * 1000
    cells = [("z", i, x0 + 1000.0 * (i % 14), y0 + 1000.0 * (i // 14), x0 + 1000.0 * (i % 14 + 1), y0 + 1000.0 * (i // 14 + 1)) for i in range(14 * 14)]
    df = spark.createDataFrame(cells, "zone_id string, unit int, x0 double, y0 double, x1 double, y1 double")
    total = sum(r["inside_area"] for r in inside.rectangle_areas(df, ["unit"], edges, ["zone_id"], 3000.0).collect())
    exact = abs(sum(r["x1"] * r["y2"] - r["x2"] * r["y1"] for r in e)) / 2
    assert total == pytest.approx(exact, rel=1e-9)


def test_no_rectangles_no_zone(spark):
    assert areas(spark, [("z", 0, 0, [(0, 0), (1, 0), (0, 1)])], [("other", (0, 0, 1, 1)), ("z", (5, 5, 6, 6)), ("z", (0, -9, 1, -8))], 1.0) == {0: 0.0, 1: 0.0, 2: 0.0}


def test_points_and_features_with_slanted_edges_and_holes(spark):
    from terrazone.operators import geometry
    edges = inside.oriented_edges(vertices(spark, RINGS), ["zone_id"])
    draw = np.random.default_rng(2)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(draw.uniform(-1, 15, 150), draw.uniform(-1, 13, 150)))]
    df = spark.createDataFrame(points, "point int, x double, y double")
    eps = 1e-6
    expected = {(i, z) for i, x, y in points for z in ("slanted", "two", "star") if want(RINGS, z, (x, y, x + eps, y + eps)) > eps * eps / 2}
    for tile in (0.7, 3.0):
        assert {(r["point"], r["zone_id"]) for r in geometry.points_in_zones(df, edges, ["point"], ["zone_id"], tile).collect()} == expected
    lines = spark.createDataFrame([("crosses", 0, -1.0, 5.0, 20.0, 6.0), ("in the hole", 0, 6.0, 5.0, 6.5, 5.5), ("touches", 0, 14.0, 1.25, 14.0, -5.0), ("far", 0, 30.0, 30.0, 31.0, 44.0),
                                   ("corner", 0, 6.0, 6.0, 6.0, 9.0), ("within", 0, 5.0, 2.0, 5.5, 2.5)], "f string, seq int, x1 double, y1 double, x2 double, y2 double")
    for tile in (1.0, 2.5):
        got = {(r["f"], r["zone_id"]) for r in geometry.feature_intersects(lines, edges, ["f"], ["zone_id"], tile).collect()}
        assert {p for p in got if p[1] == "two"} == {("in the hole", "two"), ("crosses", "two"), ("touches", "two"), ("corner", "two"), ("within", "two")}
        assert ("in the hole", "slanted") not in got and ("crosses", "slanted") in got and not any(f == "far" for f, _ in got)


def test_touched_cells_are_those_that_meet_the_zone(spark):
    from terrazone.operators import geometry
    from terrazone.operators.geometry import edge_cells
    got = {(r["zone_id"], r["row"], r["column"]) for r in geometry.touched_cells(vertices(spark, RINGS), ["zone_id"], 0.25, 20.25, 1.0, 1.0).collect()}
    edges = inside.oriented_edges(vertices(spark, RINGS), ["zone_id"])
    border = {(r["zone_id"], r["row"], r["column"]) for r in edge_cells(edges, ["zone_id"], 0.25, 20.25, 1.0, 1.0).collect()}
    full = {(z, r, c) for z in ("slanted", "two", "star") for r in range(25) for c in range(-3, 22) if want(RINGS, z, (0.25 + c, 19.25 - r, 1.25 + c, 20.25 - r)) > 1e-9}
    assert got == border | full


def test_utm_cells_against_a_dense_reference(spark):
    """Cells of 1 km and their parts in a slanted zone: areas on the ellipsoid, from borders cut finely and carried to the equal-area plane."""
    from terrazone.functions import geocols as g
    from terrazone.operators import geometry
    ring = [(301_200.0, 727_300.0), (309_900.0, 728_100.0), (308_400.0, 735_700.0), (302_300.0, 734_050.0)]
    got = {(r["row"], r["column"]): r["weight"] for r in geometry.cell_weights(vertices(spark, [("z", 0, 0, ring)]), ["zone_id"], 300_000.0, 740_000.0, 1000.0, 1000.0, utm=True).collect()}
    cells = [(row, c) for row, c in got if abs(clipped(ring, 300_000 + 1000 * c, 739_000 - 1000 * row, 301_000 + 1000 * c, 740_000 - 1000 * row) - 1e6) < 1e-6][:6] + [(9, 4), (12, 2)]
    rows = []
    for row, c in cells:
        x0, y0 = 300_000.0 + 1000 * c, 739_000.0 - 1000 * row
        corners = [(x0, y0), (x0 + 1000, y0), (x0 + 1000, y0 + 1000), (x0, y0 + 1000)]
        shape = corners if got[row, c] > 9.9e5 else None
        if shape is None:
            continue
        k = 0
        for (ax, ay), (bx, by) in zip(shape, shape[1:] + shape[:1]):
            for i in range(200):
                rows.append((row, c, k, ax + (bx - ax) * i / 200, ay + (by - ay) * i / 200))
                k += 1
    df = spark.createDataFrame(rows, "row int, column int, seq int, e double, n double")
    lon, lat = g.utm_to_lonlat("e", "n", 33)
    plane = {}
    for r in df.select("row", "column", "seq", g.equal_area_x(lon).alias("x"), g.equal_area_y(lat).alias("y")).orderBy("row", "column", "seq").collect():
        plane.setdefault((r["row"], r["column"]), []).append((r["x"], r["y"]))
    assert len(plane) >= 6
    for k, p in plane.items():
        x, y = np.array(p).T - np.array(p).mean(0)[:, None]
        assert got[k] == pytest.approx(abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2, rel=1e-6)
