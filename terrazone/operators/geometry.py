"""Polygons as vertex and edge tables, grids as cell tables.

Zones are vertex rows (zone key, part, ring, seq, x, y) with seq 0..n-1 per ring and no repeated closing
vertex. Cell weights come from an additive edge integral, so polygon-cell intersection is an ordinary
join-free expansion and one aggregate: no polygon is ever held by a single task and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import geocols as g
from ..functions.scalars import col, computed_once, join_null_safe, ratio

EDGE = ["x1", "y1", "x2", "y2"]
TINY = 1e-14


def ring_edges(vertices: DataFrame, keys: list[str], seq: str = "seq", x: str = "x", y: str = "y") -> DataFrame:
    """Directed edges of closed rings: keys, seq, x1, y1, x2, y2, from one scan of the vertices.

    A vertex is the start of the edge of its own number and the end of the one before, and the two halves of an edge meet in one aggregate. The
    halves that find no partner belong to the closing edge of the ring. No task orders or holds a whole ring.
    """
    point = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    none = F.lit(None).cast("struct<x:double,y:double>")
    s = F.col(seq).cast("int")
    ends = F.explode(F.array(F.struct(s.alias("seq"), point.cast("struct<x:double,y:double>").alias("a"), none.alias("b")),
                             F.struct((s - 1).alias("seq"), none.alias("a"), point.cast("struct<x:double,y:double>").alias("b")))).alias("_e")
    halves = vertices.select(*keys, ends).select(*keys, "_e.seq", "_e.a", "_e.b")
    edges = halves.groupBy(*keys, "seq").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    closing = edges.where("a IS NULL OR b IS NULL").groupBy(*keys).agg(F.max("seq").alias("seq"), F.max("a").alias("a"), F.max("b").alias("b"))
    return edges.where("a IS NOT NULL AND b IS NOT NULL").unionByName(closing).select(
        *keys, "seq", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))


def geo_ring_metrics(vertices: DataFrame, keys: list[str], **names) -> DataFrame:
    """Signed double area, area, perimeter, centroid, orientation and bounds per ring; degenerate rings are flagged."""
    e = ring_edges(vertices, keys, **names)
    c = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    m = e.groupBy(*keys).agg(
        F.count("*").alias("vertex_count"), F.sum(c).alias("signed_double_area"),
        F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("perimeter"),
        F.sum((F.col("x1") + F.col("x2")) * c).alias("_mx"), F.sum((F.col("y1") + F.col("y2")) * c).alias("_my"),
        F.min("x1").alias("min_x"), F.min("y1").alias("min_y"), F.max("x1").alias("max_x"), F.max("y1").alias("max_y"))
    a2 = F.col("signed_double_area")
    status = F.when(F.col("vertex_count") < 3, "TOO_FEW_VERTICES").when(a2 == 0, "ZERO_AREA").otherwise("OK")
    return m.select(*keys, "vertex_count", "signed_double_area", (F.abs(a2) / 2).alias("area"), "perimeter",
                    ratio("_mx", a2 * 3).alias("centroid_x"), ratio("_my", a2 * 3).alias("centroid_y"),
                    F.when(a2 > 0, "counterclockwise").otherwise("clockwise").alias("ring_orientation"),
                    "min_x", "min_y", "max_x", "max_y", status.alias("status"))


def geo_is_simple(vertices: DataFrame, keys: list[str], **names) -> DataFrame:
    """Per ring: no duplicate vertex and no two non-adjacent edges that meet.

    Edges are assigned to the tiles of a grid over their ring's bounds (about one tile per edge), so only
    edges sharing a tile are tested instead of every pair of the ring.
    """
    e = ring_edges(vertices, keys, **names)
    repeated = (e.groupBy(*keys, "x1", "y1").agg(F.count("*").alias("_n")).groupBy(*keys)
                .agg(F.sum("_n").alias("vertex_count"), F.max("_n").alias("_dup")))
    box = e.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("x1").alias("_bx"), F.min("y1").alias("_by"),
                               (F.max("x1") - F.min("x1")).alias("_w"), (F.max("y1") - F.min("y1")).alias("_h"))
    side = F.ceil(F.sqrt("_n")).cast("int")
    tile = lambda v, low, size: F.when(F.col(size) > 0, F.least(side - 1, F.floor((v - F.col(low)) / F.col(size) * side))).otherwise(F.lit(0)).cast("int")
    span = lambda a, b, low, size: F.explode(F.sequence(tile(F.least(a, b), low, size), tile(F.greatest(a, b), low, size)))
    t = (join_null_safe(e, box, keys)
         .withColumn("_tx", span("x1", "x2", "_bx", "_w")).withColumn("_ty", span("y1", "y2", "_by", "_h"))
         .select(*keys, "_tx", "_ty", "_n", "seq", *EDGE))
    other = t.select(*keys, "_tx", "_ty", F.col("seq").alias("_seq"), *[F.col(c).alias(f"_{c}") for c in EDGE])
    gap = F.col("_seq") - F.col("seq")
    meet = g.segments_meet([F.col(c) for c in EDGE], [F.col(f"_{c}") for c in EDGE])
    crossing = (join_null_safe(t, other, [*keys, "_tx", "_ty"]).where((gap > 1) & (gap < F.col("_n") - 1) & meet)
                .groupBy(*keys).agg(F.lit(True).alias("_crosses")))
    out = join_null_safe(repeated, crossing, keys, "left")
    return out.select(*keys, ((F.col("vertex_count") >= 3) & (F.col("_dup") == 1) & F.col("_crosses").isNull()).alias("is_simple"))


def geo_utm_to_wgs84(df: DataFrame, easting: str, northing: str, zone: int = 33) -> DataFrame:
    lon, lat = g.utm_to_lonlat(easting, northing, zone)
    return df.withColumns({"lon": lon, "lat": lat})


def geo_to_equal_area(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    return df.withColumns({"x": g.equal_area_x(lon), "y": g.equal_area_y(lat)})


def geo_densify(edges: DataFrame, step: float) -> DataFrame:
    """Split every edge into equal parts no longer than ``step``; ``part_seq`` numbers the parts of an edge."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    n = F.greatest(F.lit(1), F.ceil(F.hypot(dx, dy) / step)).cast("int")
    e = edges.withColumn("_n", n).withColumn("part_seq", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = lambda start, delta, k: F.when(k == F.col("_n"), F.col(start) + delta).otherwise(F.col(start) + delta * k / F.col("_n"))
    k = F.col("part_seq")
    others = [c for c in edges.columns if c not in EDGE]
    return e.select(*others, "part_seq", at("x1", dx, k).alias("x1"), at("y1", dy, k).alias("y1"),
                    F.when(k + 1 == F.col("_n"), F.col("x2")).otherwise(at("x1", dx, k + 1)).alias("x2"),
                    F.when(k + 1 == F.col("_n"), F.col("y2")).otherwise(at("y1", dy, k + 1)).alias("y2"))


def cell_window(boxes: DataFrame, x0, y0, dx, dy, width=None, height=None, buffer=0.0, rotation=0.0) -> DataFrame:
    """Index window of a grid covering min_x, min_y, max_x, max_y (grown by ``buffer`` in grid units).

    Floor/ceil of the inverse transform, clamped to the grid when its size is known; rotated grids are
    rejected with a status.
    """
    b, x0, y0, dx, dy = col(buffer), col(x0), col(y0), col(dx), col(dy)
    clamp_low = lambda c: F.greatest(F.lit(0), c) if width is not None else c
    clamp = lambda c, size: F.least(col(size), c) if size is not None else c
    out = boxes.withColumns({
        "col0": clamp_low(F.floor((F.col("min_x") - b - x0) / dx)), "col1": clamp(F.ceil((F.col("max_x") + b - x0) / dx), width),
        "row0": clamp_low(F.floor((y0 - F.col("max_y") - b) / dy)), "row1": clamp(F.ceil((y0 - F.col("min_y") + b) / dy), height)})
    empty = (F.col("col1") <= F.col("col0")) | (F.col("row1") <= F.col("row0"))
    return out.withColumns({"window_width": F.greatest(F.lit(0), F.col("col1") - F.col("col0")),
                            "window_height": F.greatest(F.lit(0), F.col("row1") - F.col("row0")),
                            "window_status": F.when(F.abs(col(rotation)) > 1e-12, "ROTATED_GRID").when(empty, "NO_COVERAGE").otherwise("OK")})


# Abscissas and weights of five-point Gauss-Legendre quadrature on [-1, 1].
GAUSS = [(0.0, 0.5688888888888889), (-0.5384693101056831, 0.47862867049936647), (0.5384693101056831, 0.47862867049936647),
         (-0.906179845938664, 0.23692688505618908), (0.906179845938664, 0.23692688505618908)]


def _edge_pieces(edges: DataFrame, zone: list[str], x0, y0, dx, dy, project) -> DataFrame:
    """Edges cut at the column and row borders of the grid: zone, column, row, _lower, _width, _own.

    ``_width`` is the signed projected width of a piece and ``_own`` the signed area between it and the lower border of its
    cell. A piece lies in one cell, so its height is smooth and five points integrate it.
    """
    px, py = project
    e = edges.where("x1 <> x2").withColumns({
        "_west": F.least("x1", "x2"), "_east": F.greatest("x1", "x2"), "_slope": (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")),
        "_sign": F.signum(F.col("x1") - F.col("x2")) * F.col("_role")})
    first, last = F.floor((F.col("_west") - col(x0)) / col(dx)), F.ceil((F.col("_east") - col(x0)) / col(dx)) - 1
    e = e.withColumn("column", F.explode(F.sequence(first, F.greatest(first, last))))
    # Spread the column pieces before they are cut at rows: one long edge must not stay in one task.
    e = e.repartition(*zone, "column")
    at = lambda x: F.least(F.greatest("y1", "y2"), F.greatest(F.least("y1", "y2"), F.col("y1") + (x - F.col("x1")) * F.col("_slope")))
    e = e.withColumns({"_xa": F.greatest("_west", col(x0) + F.col("column") * col(dx)), "_xb": F.least("_east", col(x0) + (F.col("column") + 1) * col(dx))}).where("_xa < _xb")
    e = e.withColumns({"_ya": at(F.col("_xa")), "_yb": at(F.col("_xb"))})
    top = F.floor((col(y0) - F.greatest("_ya", "_yb")) / col(dy))
    bottom = F.ceil((col(y0) - F.least("_ya", "_yb")) / col(dy)) - 1
    e = e.withColumn("row", F.explode(F.sequence(top, F.greatest(top, bottom))))
    # The part of the piece between the borders of its row; a level piece lies in one row as a whole.
    level = F.col("_ya") == F.col("_yb")
    cross = lambda y: F.col("_xa") + (y - F.col("_ya")) * (F.col("_xb") - F.col("_xa")) / (F.col("_yb") - F.col("_ya"))
    upper_y, lower_y = col(y0) - F.col("row") * col(dy), col(y0) - (F.col("row") + 1) * col(dy)
    inside = lambda x: F.least("_xb", F.greatest(F.col("_xa"), x))
    e = e.withColumns({"_c1": F.when(~level, inside(cross(upper_y))), "_c2": F.when(~level, inside(cross(lower_y)))})
    touches_top, touches_bottom = F.greatest("_ya", "_yb") > upper_y, F.least("_ya", "_yb") < lower_y
    high_end = F.when(F.col("_ya") > F.col("_yb"), F.col("_xa")).otherwise(F.col("_xb"))
    low_end = F.when(F.col("_ya") > F.col("_yb"), F.col("_xb")).otherwise(F.col("_xa"))
    p, q = F.when(touches_top, F.col("_c1")).otherwise(high_end), F.when(touches_bottom, F.col("_c2")).otherwise(low_end)
    e = e.withColumns({"_l": F.when(level, F.col("_xa")).otherwise(F.least(p, q)), "_r": F.when(level, F.col("_xb")).otherwise(F.greatest(p, q))}).where("_l < _r")
    e = computed_once(e, "_lower", py(lower_y))
    middle, half = (F.col("_l") + F.col("_r")) / 2, (F.col("_r") - F.col("_l")) / 2
    height = sum((py(at(middle + half * x)) * w for x, w in GAUSS), F.lit(0.0)) / 2 - F.col("_lower")
    width = F.col("_sign") * (px(F.col("_r")) - px(F.col("_l")))
    e = computed_once(e, "_width", width)
    return e.select(*zone, "column", "row", "_lower", "_width", (F.col("_width") * height).alias("_own"))


PLANAR = (lambda v: v, lambda v: v)
EQUAL_AREA = (g.equal_area_x, g.equal_area_y)


def cell_weights(vertices: DataFrame, zone: list[str], x0, y0, dx, dy, *, geographic: bool = True, utm: bool = False,
                 ring: list[str] = ("part", "ring"), x: str = "x", y: str = "y") -> DataFrame:
    """Area of every grid cell inside every zone: zone, row, column, weight, zone_area.

    Edges are cut into pieces of one cell each. A piece adds the area below it inside its own cell, and its width times the full
    height to each cell further down in its column; the latter is one running sum of signed widths per zone and column, so rows are
    pieces plus result cells. Geographic grids are measured in EPSG:6933, where their cells are
    exact rectangles; other grids are measured in their own plane. With ``utm`` the plane is that of a northern UTM zone, zone and grid in metres, and
    areas are those on the ellipsoid, as in EPSG:6933: a cell's plane area times the mean area scale over the cell, from four points of
    Gauss-Legendre quadrature, whose error is below 1e-9 for cells of up to 10 km. Parts of cells take the scale of their cell: an error of at most
    its spread in the cell, 2e-8 a metre of it. Outer rings (ring 0) count positive and holes negative whatever their
    winding. Weights below 1e-14 of the larger of zone and cell are 0.
    """
    zone, ring = list(zone), list(ring)
    project = px, py = EQUAL_AREA if geographic and not utm else PLANAR
    raw = ring_edges(vertices, [*zone, *ring], x=x, y=y)
    turn = raw.groupBy(*zone, *ring).agg(F.signum(F.sum((F.col("x2") - F.col("x1")) * (F.col("y1") + F.col("y2")))).alias("_turn"))
    # Positive for outer rings and negative for holes, whatever the winding of the input.
    turn = turn.withColumn("_role", F.when(F.col(ring[-1]) == 0, -1.0).otherwise(1.0) * F.col("_turn")).drop("_turn")
    pieces = _edge_pieces(join_null_safe(raw, turn, [*zone, *ring]), zone, x0, y0, dx, dy, project)
    events = pieces.groupBy(*zone, "column", "row").agg(F.sum("_own").alias("_own"), F.sum("_width").alias("_width"), F.max("_lower").alias("_lower"))
    area = events.groupBy(*zone).agg(F.sum(F.col("_own") + F.col("_width") * F.col("_lower")).alias("zone_area"))
    down = Window.partitionBy(*zone, "column").orderBy("row")
    events = events.withColumns({"_through": F.sum("_width").over(down), "_next": F.lead("row").over(down)})
    column_width = F.abs(px(col(x0) + (F.col("column") + 1) * col(dx)) - px(col(x0) + F.col("column") * col(dx)))
    filled = F.abs(F.col("_through")) > column_width * 1e-9
    last = F.when(filled, F.coalesce(F.col("_next") - 1, F.col("_row"))).otherwise(F.col("_row"))
    cells = events.withColumnRenamed("row", "_row").withColumn("row", F.explode(F.sequence(F.col("_row"), last)))
    height = py(col(y0) - F.col("row") * col(dy)) - py(col(y0) - (F.col("row") + 1) * col(dy))
    cells = computed_once(cells, "_height", height)
    weight = F.when(F.col("row") == F.col("_row"), F.col("_own") + (F.col("_through") - F.col("_width")) * F.col("_height")).otherwise(F.col("_through") * F.col("_height"))
    cells = cells.select(*zone, "row", "column", weight.alias("weight"), (column_width * F.col("_height")).alias("_cell"))
    if utm:
        step = 0.5 / 3 ** 0.5
        scale = sum(g.utm_area_scale(col(x0) + (F.col("column") + 0.5 + i) * col(dx), col(y0) - (F.col("row") + 0.5 + j) * col(dy)) for i in (-step, step) for j in (-step, step)) / 4
        cells = cells.withColumn("weight", F.col("weight") * scale)
        area = cells.groupBy(*zone).agg(F.sum("weight").alias("zone_area"))
    out = join_null_safe(cells, area, zone)
    return out.where(F.col("weight") > F.greatest(F.col("zone_area"), F.col("_cell")) * TINY).drop("_cell")


def zone_cells(weights: DataFrame, cells: DataFrame, grid: list[str] = ()) -> DataFrame:
    """Layer cells inside the zones with their weight: weights are computed once per zone and grid and serve
    every layer on that grid. An equi-join on (grid, row, column)."""
    return cells.join(weights, [*grid, "row", "column"])


def edge_cells(edges: DataFrame, zone: list[str], x0, y0, dx, dy) -> DataFrame:
    """Cells touched by an edge (boundary contact included): zone, row, column, distinct."""
    e = edges
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    c0, c1 = F.ceil((lo - col(x0)) / col(dx)) - 1, F.floor((hi - col(x0)) / col(dx))
    e = e.withColumn("column", F.explode(F.sequence(c0, c1))).repartition(*zone, "column")
    left, right = col(x0) + F.col("column") * col(dx), col(x0) + (F.col("column") + 1) * col(dx)
    slope = F.when(F.col("x1") != F.col("x2"), (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")))
    at = lambda v: F.greatest(F.least("y1", "y2"), F.least(F.greatest("y1", "y2"), F.col("y1") + (v - F.col("x1")) * slope))
    ya = F.when(slope.isNull(), F.least("y1", "y2")).otherwise(at(F.greatest(lo, left)))
    yb = F.when(slope.isNull(), F.greatest("y1", "y2")).otherwise(at(F.least(hi, right)))
    r0 = F.ceil((col(y0) - F.greatest(ya, yb)) / col(dy)) - 1
    r1 = F.floor((col(y0) - F.least(ya, yb)) / col(dy))
    return e.withColumn("row", F.explode(F.sequence(r0, r1))).select(*zone, "row", "column").distinct()


def touched_cells(vertices: DataFrame, zone: list[str], x0, y0, dx, dy, ring: list[str] = ("part", "ring"),
                  x: str = "x", y: str = "y") -> DataFrame:
    """Cells touching the zone at all, unweighted: cells met by its boundary plus those filled between them.

    The edges are found once. Their pieces at the left borders of the cells' columns say where, down a column, the zone lies inside; no areas are computed.
    """
    edges = ring_edges(vertices, [*zone, *ring], x=x, y=y)
    met = edge_cells(edges, zone, x0, y0, dx, dy)
    # Along the middle line of a column an odd number of edges above a cell without edges means that it is inside.
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    first, last = F.ceil((lo - col(x0)) / col(dx) - 0.5), F.ceil((hi - col(x0)) / col(dx) - 0.5) - 1
    e = edges.where("x1 <> x2").withColumns({"_first": first, "_last": last}).where("_first <= _last").withColumn("column", F.explode(F.sequence("_first", "_last")))
    middle = col(x0) + (F.col("column") + 0.5) * col(dx)
    y_at = F.col("y1") + (middle - F.col("x1")) * (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    crossed = e.select(*zone, "column", F.floor((col(y0) - y_at) / col(dy)).alias("row")).groupBy(*zone, "column", "row").agg(F.count("*").alias("_n"))
    down = Window.partitionBy(*zone, "column").orderBy("row")
    runs = crossed.withColumns({"_above": F.sum("_n").over(down), "_next": F.lead("row").over(down)}).where("_above % 2 = 1 AND _next > row + 1")
    filled = runs.withColumn("row", F.explode(F.sequence(F.col("row") + 1, F.col("_next") - 1)))
    return met.unionByName(filled.select(*zone, "row", "column")).distinct()


def touched_report(touched: DataFrame, cells: DataFrame, zone: list[str], layer: list[str], valid) -> DataFrame:
    """Cells touched and valid per zone and layer, with the valid share of the touched cells."""
    j = touched.join(cells.select(*layer, "row", "column", F.coalesce(col(valid), F.lit(False)).alias("_v")), ["row", "column"])
    agg = j.groupBy(*zone, *layer).agg(F.count("*").alias("intersecting_cell_count"), F.count_if("_v").alias("valid_cell_count"))
    return agg.withColumn("valid_selected_percentage", 100 * ratio("valid_cell_count", "intersecting_cell_count"))


def point_sample(points: DataFrame, cells: DataFrame, x: str, y: str, x0, y0, dx, dy, value: str = "value") -> DataFrame:
    """Value of the cell that contains each point (NULL outside the grid), an equi-join on row and column."""
    p = points.withColumns({"row": g.grid_row(y, y0, dy), "column": g.grid_column(x, x0, dx)})
    return p.join(cells.select("row", "column", F.col(value).alias("sample")), ["row", "column"], "left")


def points_in_zones(points: DataFrame, edges: DataFrame, point: list[str], zone: list[str], tile: float,
                    x: str = "x", y: str = "y") -> DataFrame:
    """(point, zone) pairs with the point inside: an odd number of the zone's edges lie above it.

    Candidates come from a tile-keyed join with the zone bounds; then a point meets the pieces of edges in its own tile, and one number for all that
    lies above the tile.
    """
    from .inside import windings  # which is built on this module

    box = edges.groupBy(*zone).agg(F.min("x1").alias("_bx0"), F.max("x1").alias("_bx1"), F.min("y1").alias("_by0"), F.max("y1").alias("_by1"))
    box = (box.withColumn("_tx", F.explode(F.sequence(F.floor(F.col("_bx0") / tile), F.floor(F.col("_bx1") / tile))))
           .withColumn("_ty", F.explode(F.sequence(F.floor(F.col("_by0") / tile), F.floor(F.col("_by1") / tile)))))
    p = points.select(*[F.col(c).alias(f"_p_{c}") for c in point], F.col(x).alias("_px"), F.col(y).alias("_py"))
    p = p.withColumns({"_tx": F.floor(F.col("_px") / tile), "_ty": F.floor(F.col("_py") / tile)})
    near = p.join(box, ["_tx", "_ty"]).where("_px BETWEEN _bx0 AND _bx1 AND _py BETWEEN _by0 AND _by1")
    named = [f"_p_{c}" for c in point]
    found = windings(near.select(*zone, *named, "_px", "_py").distinct(), edges, named, zone, tile, "_px", "_py").where("winding % 2 <> 0")
    return found.select(*[F.col(f"_p_{c}").alias(c) for c in point], *zone)


def _edge_tiles(edges: DataFrame, keys: list[str], tile: float, grow: float = 0.0) -> DataFrame:
    """Each edge with the tiles that it crosses or touches, and those within ``grow`` of it; not all tiles of its bounding box."""
    from .inside import tile_pieces

    t = tile_pieces(edges.withColumn("_edge", F.struct(*EDGE)), [*keys, "_edge"], tile)
    span = lambda a, b: F.explode(F.sequence(F.floor((F.least(a, b) - (grow + 1e-9)) / tile), F.floor((F.greatest(a, b) + (grow + 1e-9)) / tile)))
    t = t.drop("_tx", "_ty").withColumn("_tx", span("xs", "xe")).withColumn("_ty", span("ys", "ye")).select(*keys, "_edge", "_tx", "_ty").distinct()
    return t.select(*keys, "_tx", "_ty", *[F.col(f"_edge.{c}").alias(c) for c in EDGE])


def _edge_pairs(features: DataFrame, zones: DataFrame, feature: list[str], zone: list[str], tile: float, grow: float = 0.0) -> DataFrame:
    """Pairs of edges that share a tile and whose bounds are within ``grow``."""
    f = _edge_tiles(features, feature, tile, grow)
    z = _edge_tiles(zones, zone, tile).select(*zone, "_tx", "_ty", *[F.col(c).alias(f"_{c}") for c in EDGE])
    # The bounds test is cheap and comes first; the exact segment tests only see neighbours.
    apart = lambda a, b: ((F.greatest(f"{a}1", f"{a}2") + (grow + 1e-9) < F.least(f"_{b}1", f"_{b}2"))
                          | (F.least(f"{a}1", f"{a}2") - (grow + 1e-9) > F.greatest(f"_{b}1", f"_{b}2")))
    return f.join(z, ["_tx", "_ty"]).where(~apart("x", "x") & ~apart("y", "y"))


def by_shape(edges: DataFrame, keys: list[str], names: list[str]) -> tuple[DataFrame, DataFrame]:
    """The edges of each distinct geometry, keyed by ``names`` (two numbers), and the members (names, keys) that have it.

    Layers repeat geometries: what depends on them alone is found once for all members. A geometry is known by two 64-bit digests of its
    edges, combined in any order, so that none is ever gathered.
    """
    about = [c for c in edges.columns if c not in keys]
    digests = [F.xxhash64(F.bit_xor(F.xxhash64(F.lit(i), *about)), F.count(F.lit(1))).alias(n) for i, n in enumerate(names)]
    members = edges.groupBy(*keys).agg(*digests)
    return join_null_safe(edges, members, keys).select(*names, *about).distinct(), members


FEATURE_SHAPE, ZONE_SHAPE = ["_fa", "_fb"], ["_za", "_zb"]


def _of_members(features: DataFrame, zones: DataFrame, feature: list[str], zone: list[str], found) -> DataFrame:
    """(feature, zone) pairs from those that ``found`` names among the distinct shapes; each pair of shapes stands for all pairs of their members."""
    f, f_members = by_shape(features, feature, FEATURE_SHAPE)
    z, z_members = by_shape(zones, zone, ZONE_SHAPE)
    pairs = found(f, z).select(*FEATURE_SHAPE, *ZONE_SHAPE).distinct()
    return pairs.join(f_members, FEATURE_SHAPE).join(z_members, ZONE_SHAPE).select(*feature, *zone)


def _intersecting(features: DataFrame, zones: DataFrame, feature: list[str], zone: list[str], tile: float) -> DataFrame:
    """(feature, zone) pairs that intersect, some of them repeatedly."""
    meet = (_edge_pairs(features, zones, feature, zone, tile)
            .where(g.segments_meet([F.col(c) for c in EDGE], [F.col(f"_{c}") for c in EDGE])).select(*feature, *zone))
    corner = lambda e, key: e.where("seq = 0").select(*key, F.col("x1").alias("x"), F.col("y1").alias("y"))
    inside = points_in_zones(corner(features, feature), zones, feature, zone, tile)
    around = points_in_zones(corner(zones, zone), features, zone, feature, tile).select(*feature, *zone)
    return meet.unionByName(inside).unionByName(around)


def feature_intersects(features: DataFrame, zones: DataFrame, feature: list[str], zone: list[str], tile: float) -> DataFrame:
    """(feature, zone) pairs that intersect, from the edge tables of polygons or lines.

    Edges meet, or one contains a vertex of the other; each test is a tile- or strip-keyed equi-join of the distinct shapes.
    A caller that wants only some pairs orders and limits them with ``tables.head_limit``.
    """
    return _of_members(features, zones, feature, zone, lambda f, z: _intersecting(f, z, FEATURE_SHAPE, ZONE_SHAPE, tile))


def features_near(features: DataFrame, zones: DataFrame, feature: list[str], zone: list[str], tile: float, distance: float) -> DataFrame:
    """Context features: those intersecting the zone or with an edge within ``distance`` of its boundary."""
    f, z = [F.col(c) for c in EDGE], [F.col(f"_{c}") for c in EDGE]
    gaps = [g.point_segment_distance(x, y, s) for (x, y), s in ((f[:2], z), (f[2:], z), (z[:2], f), (z[2:], f))]

    def found(features, zones):
        near = _edge_pairs(features, zones, FEATURE_SHAPE, ZONE_SHAPE, tile, distance)
        # One by one: all four in one expression make a method too long for the JVM to compile.
        for i, gap in enumerate(gaps):
            near = computed_once(near, f"_gap{i}", gap)
        near = near.where(F.least(*[f"_gap{i}" for i in range(4)]) <= distance).select(*FEATURE_SHAPE, *ZONE_SHAPE)
        return near.unionByName(_intersecting(features, zones, FEATURE_SHAPE, ZONE_SHAPE, tile))
    return _of_members(features, zones, feature, zone, found)


def zone_trapezoids(edges: DataFrame, zone: list[str], slab: float) -> DataFrame:
    """A zone cut into trapezoids: zone, xa, xb, and the lower and upper y at both ends.

    Vertical slabs run between consecutive distinct vertex x values (found inside strips of width
    ``slab``, whose own borders also cut); the edges crossing a slab pair up bottom to top. Holes and
    several parts need no special case.
    """
    strips = edges.where("x1 <> x2").withColumn("_s", F.explode(F.sequence(
        F.floor(F.least("x1", "x2") / slab), F.ceil(F.greatest("x1", "x2") / slab) - 1)))
    borders = [F.greatest(F.least("x1", "x2"), F.col("_s") * slab), F.least(F.greatest("x1", "x2"), (F.col("_s") + 1) * slab)]
    cuts = strips.select(*zone, "_s", F.explode(F.array(*borders)).alias("xa")).distinct()
    follow = F.lead("xa").over(Window.partitionBy(*zone, "_s").orderBy("xa"))
    cuts = cuts.withColumn("xb", follow).where("xb IS NOT NULL")
    e = strips.select(*zone, "_s", *EDGE)
    at = lambda v: F.col("y1") + (F.col(v) - F.col("x1")) * (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    over = (join_null_safe(cuts, e, [*zone, "_s"])
            .where((F.least("x1", "x2") <= F.col("xa")) & (F.greatest("x1", "x2") >= F.col("xb")))
            .withColumns({"_a": at("xa"), "_b": at("xb")}))
    order = Window.partitionBy(*zone, "_s", "xa", "xb").orderBy(F.col("_a") + F.col("_b"))
    paired = over.withColumns({"_i": F.row_number().over(order), "_na": F.lead("_a").over(order), "_nb": F.lead("_b").over(order)})
    return paired.where("_i % 2 = 1 AND _na IS NOT NULL").select(
        *zone, "xa", "xb", F.col("_a").alias("low_a"), F.col("_b").alias("low_b"), F.col("_na").alias("high_a"), F.col("_nb").alias("high_b"))


POINTS = "array<struct<x:double,y:double>>"


def _clip_ring(ring: Column, planes: list[tuple[Column, Column, Column]]) -> Column:
    """Part of a convex or simple ring (array of struct x, y) with a x + b y + c >= 0 for every plane (a, b, c).

    The planes are folded over the ring, so each step sees the previous result as one value.
    """
    none = F.array().cast(POINTS)

    def step(points, plane):
        value = lambda p: plane["a"] * p["x"] + plane["b"] * p["y"] + plane["c"]
        pairs = F.arrays_zip(points.alias("p"), F.concat(F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1)).alias("q"))

        def corner(pair):
            p, q = pair["p"], pair["q"]
            sp, sq = value(p), value(q)
            t = ratio(sp, sp - sq)
            cut = F.struct((p["x"] + t * (q["x"] - p["x"])).alias("x"), (p["y"] + t * (q["y"] - p["y"])).alias("y"))
            return F.concat(F.when(sp >= 0, F.array(p)).otherwise(none),
                            F.when((sp > 0) & (sq < 0) | (sp < 0) & (sq > 0), F.array(cut)).otherwise(none))
        return F.flatten(F.transform(pairs, corner)).cast(POINTS)
    folded = F.array(*[F.struct(x.alias("a"), y.alias("b"), c.alias("c")) for x, y, c in planes])
    return F.aggregate(folded, ring.cast(POINTS), step)


def ring_area(ring: Column) -> Column:
    """Area of a ring by a fold that keeps the first and previous point and the running cross product."""
    start = F.struct(F.lit(None).cast("double").alias("fx"), F.lit(None).cast("double").alias("fy"),
                     F.lit(None).cast("double").alias("px"), F.lit(None).cast("double").alias("py"), F.lit(0.0).alias("s"))
    step = lambda acc, p: F.struct(
        F.coalesce(acc["fx"], p["x"]).alias("fx"), F.coalesce(acc["fy"], p["y"]).alias("fy"), p["x"].alias("px"), p["y"].alias("py"),
        (acc["s"] + F.coalesce(acc["px"] * p["y"] - p["x"] * acc["py"], F.lit(0.0))).alias("s"))
    close = lambda acc: F.abs(F.coalesce(acc["s"] + acc["px"] * acc["fy"] - acc["fx"] * acc["py"], F.lit(0.0))) / 2
    return F.aggregate(ring, start, step, close)


def _clipped(features: DataFrame, zone_edges: DataFrame, zone: list[str], tile: float, ring: str = "ring") -> DataFrame:
    """Pieces of the features in the zones: features meet the trapezoids of a zone on shared tiles, and each piece is the feature ring
    clipped by the four half-planes of one trapezoid. Equal rings are clipped once.
    """
    marks = {n: F.xxhash64(F.lit(i), ring) for i, n in enumerate(FEATURE_SHAPE)}
    shapes = features.withColumns(marks).groupBy(*FEATURE_SHAPE).agg(F.any_value(ring).alias(ring))
    bounds = shapes.withColumns({
        "_fx0": F.array_min(F.transform(ring, lambda p: p["x"])), "_fx1": F.array_max(F.transform(ring, lambda p: p["x"])),
        "_fy0": F.array_min(F.transform(ring, lambda p: p["y"])), "_fy1": F.array_max(F.transform(ring, lambda p: p["y"]))})
    span = lambda a, b: F.explode(F.sequence(F.floor(a / tile), F.floor(b / tile)))
    f = bounds.withColumn("_tx", span(F.col("_fx0"), F.col("_fx1"))).withColumn("_ty", span(F.col("_fy0"), F.col("_fy1")))
    z = zone_trapezoids(zone_edges, zone, tile).withColumns({"_zy0": F.least("low_a", "low_b"), "_zy1": F.greatest("high_a", "high_b")})
    z = z.withColumn("_tx", span(F.col("xa"), F.col("xb"))).withColumn("_ty", span(F.col("_zy0"), F.col("_zy1")))
    ox, oy = F.greatest("_fx0", "xa"), F.greatest("_fy0", "_zy0")
    j = f.join(z, ["_tx", "_ty"]).where(
        (ox < F.least("_fx1", "xb")) & (oy < F.least("_fy1", "_zy1")) & (F.floor(ox / tile) == F.col("_tx")) & (F.floor(oy / tile) == F.col("_ty")))
    w = F.col("xb") - F.col("xa")
    up_low, up_high = (F.col("low_b") - F.col("low_a")) / w, (F.col("high_b") - F.col("high_a")) / w
    one, zero = F.lit(1.0), F.lit(0.0)
    planes = [(one, zero, -F.col("xa")), (-one, zero, F.col("xb")), (-up_low, one, up_low * F.col("xa") - F.col("low_a")),
              (up_high, -one, F.col("high_a") - up_high * F.col("xa"))]
    j = computed_once(j, "_clipped", _clip_ring(F.col(ring), planes)).withColumn(ring, F.col("_clipped"))
    out = computed_once(j, "piece_area", ring_area(F.col(ring))).where("piece_area > 0")
    pieces = out.select(*FEATURE_SHAPE, *zone, F.col(ring).alias("_piece"), "piece_area")
    return features.withColumns(marks).drop(ring).join(pieces, FEATURE_SHAPE).withColumnRenamed("_piece", ring).select(*features.columns, *zone, "piece_area")


def feature_clip(features: DataFrame, zone_edges: DataFrame, zone: list[str], tile: float, feature_id: str = "feature_id",
                 ring: str = "ring") -> DataFrame:
    """Polygon features clipped to the zones: one row per piece with the clipped ring and its area.

    Feature columns (attributes and source id) are kept. Zones of equal shape share their pieces.
    """
    shapes, members = by_shape(zone_edges, zone, ZONE_SHAPE)
    return _clipped(features, shapes, ZONE_SHAPE, tile, ring).join(members, ZONE_SHAPE).select(*features.columns, *zone, "piece_area")


def feature_areas(features: DataFrame, zone_edges: DataFrame, by: list[str], zone: list[str], tile: float, ring: str = "ring") -> DataFrame:
    """Area of the pieces of ``feature_clip`` per feature columns ``by`` and zone: (by, zone, clipped_area), added up once for zones of equal shape."""
    shapes, members = by_shape(zone_edges, zone, ZONE_SHAPE)
    areas = _clipped(features, shapes, ZONE_SHAPE, tile, ring).groupBy(*by, *ZONE_SHAPE).agg(F.sum("piece_area").alias("clipped_area"))
    return areas.join(members, ZONE_SHAPE).select(*by, *zone, "clipped_area")


def zone_feature_counts(features: DataFrame, zone_edges: DataFrame, layer: list[str], zone: list[str], tile: float, feature_id: str = "feature_id",
                        ring: str = "ring") -> DataFrame:
    """``feature_counts`` of the clipped features, counted once for zones of equal shape."""
    shapes, members = by_shape(zone_edges, zone, ZONE_SHAPE)
    counts = feature_counts(_clipped(features, shapes, ZONE_SHAPE, tile, ring), layer, ZONE_SHAPE, feature_id)
    return counts.join(members, ZONE_SHAPE).select(*layer, *zone, "feature_count", "clipped_area")


def feature_counts(clipped: DataFrame, layer: list[str], zone: list[str], feature_id: str = "feature_id") -> DataFrame:
    """Clipped features and their area per layer and zone (a feature in several pieces counts once)."""
    per = clipped.groupBy(*layer, *zone, feature_id).agg(F.sum("piece_area").alias("_a"))
    return per.groupBy(*layer, *zone).agg(F.count("*").alias("feature_count"), F.sum("_a").alias("clipped_area"))


def mosaic_latest(images: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Per cell the valid value of the last image in image order."""
    return images.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.max_by(value, order).alias(value), F.max(order).alias("image_index"), F.count("*").alias("image_count"))


def modal_composite(obs: DataFrame, keys: list[str], label: str, probabilities: list[str], minimum_probability: float = 0.6,
                    minimum_observations: int = 3) -> DataFrame:
    """Most frequent confident label per cell, lowest code on ties, with a minimum number of observations."""
    top = F.greatest(*[F.col(p) for p in probabilities]) if len(probabilities) > 1 else F.col(probabilities[0])
    counts = obs.where(top >= minimum_probability).groupBy(*keys, label).agg(F.count("*").alias("_n"))
    agg = counts.groupBy(*keys).agg(F.max_by(F.col(label), F.struct(F.col("_n"), -F.col(label))).alias(label), F.sum("_n").alias("observation_count"))
    return agg.where(F.col("observation_count") >= minimum_observations)


def bilinear_resample(source: DataFrame, targets: DataFrame, keys: list[str], target: list[str], x: str, y: str, x0, y0, dx, dy,
                      value: str = "value") -> DataFrame:
    """Bilinear value at target points from the four nearest cell centres.

    Missing neighbours are left out and the remaining weights renormalised; without any neighbour the value is NULL.
    """
    u, v = (F.col(x) - col(x0)) / col(dx) - 0.5, (col(y0) - F.col(y)) / col(dy) - 0.5
    t = targets.withColumns({"_c": F.floor(u), "_r": F.floor(v)}).withColumns({"_fu": u - F.col("_c"), "_fv": v - F.col("_r")})
    corner = lambda dr, dc: F.struct((F.col("_r") + dr).alias("row"), (F.col("_c") + dc).alias("column"),
                                     ((F.col("_fv") if dr else 1 - F.col("_fv")) * (F.col("_fu") if dc else 1 - F.col("_fu"))).alias("w"))
    n = t.select(*keys, *target, F.explode(F.array(*[corner(r, c) for r in (0, 1) for c in (0, 1)])).alias("n")).select(*keys, *target, "n.*")
    j = join_null_safe(n, source.select(*keys, "row", "column", F.col(value).alias("_v")), [*keys, "row", "column"], "left")
    ok = F.col("_v").isNotNull() & (F.col("w") > 0)
    return j.groupBy(*keys, *target).agg(ratio(F.sum(F.when(ok, F.col("w") * F.col("_v"))), F.sum(F.when(ok, F.col("w")))).alias(value),
                                         F.count_if(ok).alias("neighbour_count"))


def slope_degrees(cells: DataFrame, layer: list[str], value: str, resolution, width, height, row: str = "row", column: str = "column") -> DataFrame:
    """Slope in degrees from central differences, one-sided at the grid edge; a missing neighbour gives NULL.

    Rows and columns are ordered separately, so a partition never exceeds one line of the raster.
    """
    h = col(resolution)

    def gradient(along: str, across: str, size):
        w = Window.partitionBy(*layer, across).orderBy(along)
        here, a = F.col(value), F.col(along)
        prev = F.when(F.lag(along).over(w) == a - 1, F.lag(value).over(w))
        nxt = F.when(F.lead(along).over(w) == a + 1, F.lead(value).over(w))
        return (F.when(a == 0, (nxt - here) / h).when(a == col(size) - 1, (here - prev) / h).otherwise((nxt - prev) / (2 * h)))
    out = cells.withColumn("_gx", gradient(column, row, width)).withColumn("_gy", gradient(row, column, height))
    return out.withColumn("slope", F.degrees(F.atan(F.hypot("_gx", "_gy")))).drop("_gx", "_gy")
