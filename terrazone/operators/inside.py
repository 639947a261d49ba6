"""What lies inside polygons: areas of rectangles of any grid, and points, from pieces of edges in tiles.

An edge is walked through the tiles it crosses and cut at their borders, so that it has one piece for each such tile and none elsewhere; a
diagonal of n tiles has at most 3 n pieces. What lies above a tile in its column is one number, the winding at its upper left corner: a
running sum, down each column, of the edges that cross the column's left border. From there the winding of any point of the tile follows from the
tile's own pieces, and so does the area of a rectangle inside the polygon: a rectangle that no edge crosses is inside or outside as
a whole, and one that edges cross is measured from their pieces in its tiles. No polygon is ever held by one task, and rectangles meet no edges but those
of their tiles.

Edges are directed with the polygon on their left: see ``oriented_edges``. Points on a border count as lying a little to the right of and above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import geocols as g
from ..functions.scalars import join_null_safe
from .geometry import geo_densify, ring_edges

XY = ["xs", "ys", "xe", "ye"]


def oriented_edges(vertices: DataFrame, zone: list[str], ring: list[str] = ("part", "ring"), x: str = "x", y: str = "y") -> DataFrame:
    """Directed edges (zone, ring, seq, x1, y1, x2, y2) with the polygon on the left: outer rings (ring 0) turn counterclockwise, holes clockwise, whatever their winding."""
    zone, ring = list(zone), list(ring)
    e = ring_edges(vertices, [*zone, *ring], x=x, y=y)
    turn = e.groupBy(*zone, *ring).agg(F.sum((F.col("x1") - F.col("x2")) * (F.col("y1") + F.col("y2"))).alias("_turn"))
    e = join_null_safe(e, turn, [*zone, *ring])
    right = (F.col("_turn") >= 0) == (F.col(ring[-1]) == 0)
    way = lambda a, b: F.when(right, F.col(a)).otherwise(F.col(b)).alias(a)
    return e.select(*zone, *ring, "seq", way("x1", "x2"), way("y1", "y2"), way("x2", "x1"), way("y2", "y1"))


def equal_area_edges(edges: DataFrame, step: float) -> DataFrame:
    """Edges in longitude and latitude, cut into parts of ``step`` degrees at most, in EPSG:6933."""
    parts = geo_densify(edges, step).drop("part_seq")
    return parts.withColumns({"x1": g.equal_area_x("x1"), "y1": g.equal_area_y("y1"), "x2": g.equal_area_x("x2"), "y2": g.equal_area_y("y2")})


def tile_pieces(edges: DataFrame, keys: list[str], tile: float) -> DataFrame:
    """Edges cut at the borders of the tiles they cross: keys, _tx, _ty, _left, and the directed piece xs, ys, xe, ye.

    Tiles hold their lower and left borders. ``_left`` says that the piece begins at the left border of its column, where the edge crosses it.
    """
    t = F.lit(float(tile))
    forward = F.col("x1") <= F.col("x2")
    pick = lambda a, b: F.when(forward, F.col(a)).otherwise(F.col(b))
    e = edges.select(*keys, forward.alias("_forward"), pick("x1", "x2").alias("_xa"), pick("y1", "y2").alias("_ya"), pick("x2", "x1").alias("_xb"), pick("y2", "y1").alias("_yb"))
    first, last = F.floor(F.col("_xa") / t), F.ceil(F.col("_xb") / t) - 1
    e = e.withColumn("_tx", F.explode(F.sequence(first, F.greatest(first, last))))
    # A long edge must not stay in one task while it is cut at rows.
    e = e.repartition(*keys, "_tx")
    low, high = F.col("_tx") * t, (F.col("_tx") + 1) * t
    slope = F.when(F.col("_xa") < F.col("_xb"), (F.col("_yb") - F.col("_ya")) / (F.col("_xb") - F.col("_xa")))
    within = lambda v, a, b: F.greatest(F.least(a, b), F.least(F.greatest(a, b), v))
    at = lambda x: within(F.col("_ya") + (x - F.col("_xa")) * slope, F.col("_ya"), F.col("_yb"))
    e = e.withColumns({"_left": F.col("_xa") < low, "_l": F.greatest("_xa", low), "_r": F.least("_xb", high)})
    e = e.withColumns({"_yl": F.when(F.col("_xa") < low, at(F.col("_l"))).otherwise(F.col("_ya")), "_yr": F.when(F.col("_xb") > high, at(F.col("_r"))).otherwise(F.col("_yb"))})
    # An edge that starts on the border crosses it for what lies to the right.
    e = e.withColumn("_left", F.col("_left") | ((F.col("_xa") == low) & (F.col("_xb") > low)))
    bottom, top = F.least("_yl", "_yr"), F.greatest("_yl", "_yr")
    first, last = F.floor(bottom / t), F.ceil(top / t) - 1
    e = e.withColumn("_ty", F.explode(F.sequence(first, F.greatest(first, last))))
    low, high = F.col("_ty") * t, (F.col("_ty") + 1) * t
    x_at = lambda y: within(F.col("_l") + (y - F.col("_yl")) * (F.col("_r") - F.col("_l")) / (F.col("_yr") - F.col("_yl")), F.col("_l"), F.col("_r"))

    def cut(x, y):
        """An end of the piece, moved to the border of its tile if it lies beyond."""
        return (F.when(F.col(y) < low, x_at(low)).when(F.col(y) > high, x_at(high)).otherwise(F.col(x)), F.least(high, F.greatest(low, F.col(y))))
    (xl, yl), (xr, yr) = cut("_l", "_yl"), cut("_r", "_yr")
    e = e.select(*keys, "_tx", "_ty", "_forward", (F.col("_left") & (F.col("_yl") >= low) & ((F.col("_yl") < high) | ((F.col("_yl") == high) & (F.col("_yr") < high)))).alias("_left"),
                 xl.alias("_l"), yl.alias("_yl"), xr.alias("_r"), yr.alias("_yr"))
    way = lambda a, b: F.when(F.col("_forward"), F.col(a)).otherwise(F.col(b))
    return e.select(*keys, "_tx", "_ty", "_left", way("_l", "_r").alias("xs"), way("_yl", "_yr").alias("ys"), way("_r", "_l").alias("xe"), way("_yr", "_yl").alias("ye"))


def _above() -> Column:
    """What an edge adds to the winding of the points below it: 1 if the polygon is below, which is so for an edge that goes left."""
    return F.signum(F.col("xs") - F.col("xe"))


def corner_windings(pieces: DataFrame, zone: list[str], tiles: DataFrame, tile: float) -> DataFrame:
    """``_corner`` of each of the tiles (zone, _tx, _ty): the winding right of and just below its upper left corner.

    An edge that crosses a column's left border at or above the corner counts; counts are added up by tile first, then down the column.
    """
    y = F.when(F.col("xs") < F.col("xe"), F.col("ys")).otherwise(F.col("ye"))
    # in the tile's own terms, as a border's number of tiles may round either way
    row = F.when(y >= (F.col("_ty") + 1) * F.lit(float(tile)), F.col("_ty")).otherwise(F.col("_ty") - 1)
    events = pieces.where("_left").select(*zone, "_tx", row.alias("_ty"), _above().alias("_n"), F.lit(False).alias("_asked"))
    asked = tiles.select(*zone, "_tx", "_ty").distinct().select("*", F.lit(0.0).alias("_n"), F.lit(True).alias("_asked"))
    each = events.unionByName(asked).groupBy(*zone, "_tx", "_ty").agg(F.sum("_n").alias("_n"), F.bool_or("_asked").alias("_asked"))
    down = Window.partitionBy(*zone, "_tx").orderBy(F.col("_ty").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return each.withColumn("_corner", F.sum("_n").over(down)).where("_asked").select(*zone, "_tx", "_ty", "_corner")


def _crossing(y: Column, closed: bool) -> tuple[Column, Column]:
    """Whether a piece crosses a level, the level being a little above ``y`` (or below it, if not ``closed``); and what walking right across it there adds to the winding."""
    under = (lambda v: F.col(v) <= y) if closed else (lambda v: F.col(v) < y)
    return under("ys") != under("ye"), F.when(F.col("ys") > F.col("ye"), 1.0).otherwise(-1.0)


def _level_x(y: Column) -> Column:
    return F.col("xs") + (y - F.col("ys")) / (F.col("ye") - F.col("ys")) * (F.col("xe") - F.col("xs"))


def _winding_terms(x: Column, y: Column, tile: float) -> Column:
    """What a piece of the tile of a point adds to the corner's winding on the way to the point: along the upper border, then down."""
    t = F.lit(float(tile))
    upper = (F.floor(y / t) + 1) * t
    met, step = _crossing(upper, False)
    end_x = F.when(F.col("ys") > F.col("ye"), F.col("xs")).otherwise(F.col("xe"))  # the upper end, on the border
    on_corner = (F.col("xs") == F.col("xe")) & (end_x == F.floor(x / t) * t)  # the corner lies right of it
    along = F.when(met & (end_x <= x) & ~on_corner, step).otherwise(0.0)
    spans = (F.least("xs", "xe") <= x) & (x < F.greatest("xs", "xe"))
    crosses, _ = _crossing(y, True)
    rising = (F.col("xe") > F.col("xs")) == (F.col("ye") > F.col("ys"))
    k = _level_x(y)
    over = F.when(crosses, F.when(rising, k <= x).otherwise(k > x)).otherwise(F.least("ys", "ye") > y)
    return along + F.when(spans & over, _above()).otherwise(0.0)


def windings(points: DataFrame, edges: DataFrame, point: list[str], zone: list[str], tile: float, x: str = "x", y: str = "y") -> DataFrame:
    """(point, zone, winding) of the points (point, zone, x, y) right of and above each: 1 inside, 0 outside, more where parts overlap."""
    t = F.lit(float(tile))
    pieces = tile_pieces(edges, zone, tile)
    p = points.select(*zone, *point, F.col(x).alias("_px"), F.col(y).alias("_py")).withColumns({"_tx": F.floor(F.col("_px") / t), "_ty": F.floor(F.col("_py") / t)})
    corners = corner_windings(pieces, zone, p, tile)
    own = p.join(pieces.drop("_left"), [*zone, "_tx", "_ty"]).groupBy(*zone, *point).agg(F.sum(_winding_terms(F.col("_px"), F.col("_py"), tile)).alias("_n"))
    out = p.join(corners, [*zone, "_tx", "_ty"]).select(*zone, *point, "_corner").join(own, [*zone, *point], "left")
    return out.select(*point, *zone, (F.col("_corner") + F.coalesce("_n", F.lit(0.0))).cast("int").alias("winding"))


def _positive_part(p: Column, q: Column) -> Column:
    """The integral over [0, 1] of the positive part of what runs straight from p to q."""
    top = F.greatest(p, q)
    return F.when((p >= 0) & (q >= 0), (p + q) / 2).when(top <= 0, 0.0).otherwise(top * top / (2 * F.abs(q - p)))


def rectangle_areas(rects: DataFrame, key: list[str], edges: DataFrame, zone: list[str], tile: float) -> DataFrame:
    """``rects`` with ``inside_area``: the area of each rectangle x0, y0, x1, y1 inside the zone of its row, exact up to rounding.

    ``key`` names one rectangle of a zone; repeated rows have one result each. ``edges`` are those of ``oriented_edges`` in the plane of the
    rectangles. ``tile`` should be a few rectangles wide. Rectangles without area, or with a null, have 0.
    """
    t = F.lit(float(tile))
    pieces = tile_pieces(edges, zone, tile)
    r = rects.select(*zone, *key, *[F.col(c).cast("double").alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")]).where("_x0 < _x1 AND _y0 < _y1").distinct()
    a, c, b, d = (F.col(f"_{n}") for n in ("x0", "y0", "x1", "y1"))
    span = lambda lo, hi: F.explode(F.sequence(F.floor(lo / t), hi))
    placed = r.withColumn("_tx", span(a, F.greatest(F.floor(a / t), F.ceil(b / t) - 1))).withColumn("_ty", span(c, F.floor(d / t)))
    met = placed.join(pieces.drop("_left"), [*zone, "_tx", "_ty"])
    # the part of the piece above the rectangle's base, below its top, between its sides
    left, right = F.least("xs", "xe"), F.greatest("xs", "xe")
    met = met.withColumns({"_l": F.greatest(left, a), "_r": F.least(right, b)})
    met = met.withColumn("_w", F.greatest(F.lit(0.0), F.col("_r") - F.col("_l")))
    low, high = F.least("ys", "ye"), F.greatest("ys", "ye")
    at = lambda v: F.when(right > left, F.greatest(low, F.least(high, F.col("ys") + (F.col(v) - F.col("xs")) / (F.col("xe") - F.col("xs")) * (F.col("ye") - F.col("ys"))))).otherwise(low)
    met = met.withColumns({"_p": at("_l"), "_q": at("_r")})
    over = F.when(low > d, 1.0).when(high <= d, 0.0).otherwise(F.when(F.col("_p") == F.col("_q"), F.when(F.col("_p") > d, 1.0).otherwise(0.0))
                                                              .when(F.greatest("_p", "_q") <= d, 0.0).when(F.least("_p", "_q") > d, 1.0)
                                                              .otherwise((F.greatest("_p", "_q") - d) / F.abs(F.col("_q") - F.col("_p"))))
    under = _positive_part(F.col("_p") - c, F.col("_q") - c) - _positive_part(F.col("_p") - d, F.col("_q") - d) - (d - c) * over
    crosses, step = _crossing(d, True)
    k = F.when(crosses, _level_x(d))
    entered = F.when(crosses & (k > a) & (k < b), step * (b - k)).otherwise(0.0)
    here = (F.floor(a / t) == F.col("_tx")) & (F.floor(d / t) == F.col("_ty"))
    terms = met.select(*zone, *key, "_x0", "_y0", "_x1", "_y1", F.when(F.col("_w") > 0, _above() * F.col("_w") * under).otherwise(0.0).alias("_area"), entered.alias("_top"),
                       F.when(here, _winding_terms(a, d, tile)).otherwise(0.0).alias("_winding"))
    sums = terms.groupBy(*zone, *key, "_x0", "_y0", "_x1", "_y1").agg(F.sum("_area").alias("_area"), F.sum("_top").alias("_top"), F.sum("_winding").alias("_winding"))
    corner = r.withColumns({"_tx": F.floor(a / t), "_ty": F.floor(d / t)})
    known = corner.join(corner_windings(pieces, zone, corner, tile), [*zone, "_tx", "_ty"]).drop("_tx", "_ty")
    full = known.join(sums, [*zone, *key, "_x0", "_y0", "_x1", "_y1"], "left")
    top = (F.col("_corner") + F.coalesce("_winding", F.lit(0.0))) * (b - a) + F.coalesce("_top", F.lit(0.0))
    area = F.greatest(F.lit(0.0), F.least((b - a) * (d - c), (d - c) * top + F.coalesce("_area", F.lit(0.0))))
    found = full.select(*zone, *key, a.alias("x0"), c.alias("y0"), b.alias("x1"), d.alias("y1"), area.alias("inside_area"))
    return join_null_safe(rects, found, [*zone, *key, "x0", "y0", "x1", "y1"], "left").withColumn("inside_area", F.coalesce("inside_area", F.lit(0.0)))
