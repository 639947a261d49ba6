"""Common support, over orders as layer cells: position = (nation, customer number mod 4), model = order
priority, group = (period, scenario), value = lowest price, valid above 20,000."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import consensus as cs, inside, support as sp
from .q_consensus import MODELS, units as five_units
from .registry import query, rnd, rounded, table

ZONE = 1500.0


def model_cells(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    cells = j.groupBy(F.concat_ws("_", F.year("o_orderdate").cast("string"), "o_orderstatus").alias("group_id"),
                      F.col("o_orderpriority").alias("model"), F.col("c_nationkey").alias("row"),
                      (F.col("o_custkey") % 4).alias("column")).agg(F.min("o_totalprice").alias("value"))
    return cells.withColumns({"area": (F.col("row") + 1 + F.col("column")).cast("double"), "valid": F.col("value") > 20000})


CELLS = """WITH m AS (SELECT year(o_orderdate) || '_' || o_orderstatus group_id, o_orderpriority model, c_nationkey "row", o_custkey % 4 "column", min(o_totalprice) v,
   (any_value(c_nationkey) + 1 + any_value(o_custkey % 4))::DOUBLE area, min(o_totalprice) > 20000 valid FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4),
 p AS (SELECT group_id, "row", "column", any_value(area) area, count(*) present, count(*) FILTER (WHERE valid) ok, list(v ORDER BY model) vs FROM m GROUP BY ALL)"""


@query("support_aligned", f"""{CELLS} SELECT group_id, "row", "column", area, 'u' || lpad(row_number() OVER (PARTITION BY group_id ORDER BY "row", "column")::VARCHAR, 5, '0') unit_id,
  vs[1] first_value, vs[5] last_value FROM p WHERE ok = 5""")
def support_aligned(spark, d):
    out = sp.support_aligned(model_cells(spark, d), ["group_id"], "model", MODELS, "value", "valid", "area")
    return out.select("group_id", "row", "column", "area", "unit_id", F.col("values")[0].alias("first_value"), F.col("values")[4].alias("last_value"))


@query("support_report", f"""{CELLS}, g AS (SELECT group_id, coalesce(sum(area) FILTER (WHERE ok = 5), 0) c, coalesce(sum(area) FILTER (WHERE present = 5), 0) f, count(*) FILTER (WHERE ok = 5) n FROM p GROUP BY ALL)
  SELECT group_id, c common_valid_area, n analytical_unit_count, 1500.0::DOUBLE zone_area, round(100 * c / 1500, 6) common_valid_percentage, f - c excluded_masked_area, 1500 - f excluded_outside_footprint_area,
   CASE WHEN n = 0 THEN 'NO_COMMON_VALID_SUPPORT' WHEN n < 5 THEN 'FEW_NATIVE_CELLS' ELSE 'OK' END quality_flag, 'OK' status FROM g""")
def support_report(spark, d):
    out = sp.support_report(model_cells(spark, d), ["group_id"], "model", MODELS, "valid", "area", ZONE)
    return rounded(out, ["common_valid_percentage"], 6)


@query("cells_per_source", f"""{CELLS} SELECT m.group_id, m.model, coalesce(sum(m.area) FILTER (WHERE valid), 0) source_valid_area, count(*) FILTER (WHERE ok = 5) native_cell_count
  FROM m JOIN p USING (group_id, "row", "column") GROUP BY ALL""")
def cells_per_source(spark, d):
    return sp.cells_per_source(model_cells(spark, d), ["group_id"], "model", MODELS, "valid", "area")


@query("grid_alignment", """WITH l AS (SELECT l_linenumber group_id, l_suppkey layer_id, 'EPSG:' || min(l_linenumber % 2) crs, max(l_quantity) width, max(l_discount) height, min(l_tax) x0, min(l_quantity) * 1e-11 y0 FROM lineitem GROUP BY 1, 2)
  SELECT group_id, count(*) layer_count, min(crs) = max(crs) AND min(width) = max(width) AND min(height) = max(height) AND max(x0) - min(x0) <= 1e-10 AND max(y0) - min(y0) <= 1e-10 same_native_grid FROM l GROUP BY 1""")
def grid_alignment(spark, d):
    layers = table(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("group_id"), F.col("l_suppkey").alias("layer_id")).agg(
        F.concat(F.lit("EPSG:"), F.min(F.col("l_linenumber") % 2)).alias("crs"), F.max("l_quantity").alias("width"),
        F.max("l_discount").alias("height"), F.min("l_tax").alias("x0"), (F.min("l_quantity") * 1e-11).alias("y0"))
    return sp.grid_alignment(layers.withColumns({"dx": F.lit(1.0), "dy": F.lit(1.0)}), ["group_id"])


def rectangles(spark, d):
    """Three grids: unit cells, unit cells shifted by half a cell, and two-unit cells."""
    o = table(spark, d, "orders").select((F.col("o_custkey") % 60).alias("x"), (F.col("o_orderkey") % 40).alias("y"),
                                         "o_totalprice", "o_orderpriority", "o_orderstatus")
    grid = lambda name, cond, x, y, size: (o.where(cond).groupBy(x.cast("double").alias("x0"), y.cast("double").alias("y0"))
        .agg(F.min("o_totalprice").alias("value"))
        .select(F.lit("all").alias("group_id"), F.lit(name).alias("layer"), F.concat_ws(":", F.lit(name), (F.col("x0") * 2).cast("int").cast("string"), (F.col("y0") * 2).cast("int").cast("string")).alias("cell_id"),
                "x0", "y0", (F.col("x0") + size).alias("x1"), (F.col("y0") + size).alias("y1"), "value", (F.col("value") > 30000).alias("valid")))
    x, y = F.col("x"), F.col("y")
    return (grid("a", F.col("o_orderstatus") == "F", x, y, 1.0)
            .unionByName(grid("b", F.col("o_orderstatus") == "O", x + 0.5, y + 0.5, 1.0))
            .unionByName(grid("c", F.col("o_orderstatus") == "P", F.floor(x / 2) * 2, F.floor(y / 2) * 2, 2.0)))


@query("support_overlay", """WITH a AS (SELECT (o_custkey % 60)::DOUBLE x0, (o_orderkey % 40)::DOUBLE y0, min(o_totalprice) v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2 HAVING min(o_totalprice) > 30000),
 b AS (SELECT (o_custkey % 60) + .5 x0, (o_orderkey % 40) + .5 y0, min(o_totalprice) v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2 HAVING min(o_totalprice) > 30000),
 c AS (SELECT floor((o_custkey % 60) / 2) * 2 x0, floor((o_orderkey % 40) / 2) * 2 y0, min(o_totalprice) v FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2 HAVING min(o_totalprice) > 30000),
 j AS (SELECT greatest(a.x0, b.x0, c.x0) x0, greatest(a.y0, b.y0, c.y0) y0, least(a.x0 + 1, b.x0 + 1, c.x0 + 2) x1, least(a.y0 + 1, b.y0 + 1, c.y0 + 2) y1, a.v va, b.v vb, c.v vc
   FROM a JOIN b ON a.x0 < b.x0 + 1 AND b.x0 < a.x0 + 1 AND a.y0 < b.y0 + 1 AND b.y0 < a.y0 + 1
     JOIN c ON greatest(a.x0, b.x0) < c.x0 + 2 AND c.x0 < least(a.x0, b.x0) + 1 AND greatest(a.y0, b.y0) < c.y0 + 2 AND c.y0 < least(a.y0, b.y0) + 1)
 SELECT x0::DOUBLE x0, y0::DOUBLE y0, x1::DOUBLE x1, y1::DOUBLE y1, round((x1 - x0) * (y1 - y0), 6)::DOUBLE area, va value_a, vb value_b, vc value_c FROM j""")
def support_overlay(spark, d):
    out = sp.support_overlay(rectangles(spark, d), ["group_id"], "layer", ["a", "b", "c"], "value", "valid", 2400.0, tile=4.0)
    v = F.col("values")
    return out.select("x0", "y0", "x1", "y1", rnd("area", 6).alias("area"), v[0].alias("value_a"), v[1].alias("value_b"), v[2].alias("value_c"))


def overlapping_rects(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("group_id"), (F.col("l_partkey") % 300 * 0.5).alias("x0"), (F.col("l_suppkey") % 200 * 0.5).alias("y0"),
        (F.col("l_partkey") % 300 * 0.5 + 0.5 + F.col("l_linenumber") % 2 * 0.5).alias("x1"), (F.col("l_suppkey") % 200 * 0.5 + 0.5 + F.col("l_linenumber") % 3 * 0.5).alias("y1"))


@query("unit_overlap_check", """WITH r AS (SELECT l_returnflag group_id, l_partkey % 300 x, l_suppkey % 200 y, 1 + l_linenumber % 2 w, 1 + l_linenumber % 3 h FROM lineitem),
 e AS (SELECT group_id, x + unnest(range(w)) x, y, h FROM r), f AS (SELECT group_id, x, y + unnest(range(h)) y FROM e),
 n AS (SELECT group_id, x, y, count(*) k FROM f GROUP BY ALL), o AS (SELECT group_id, count(*) * .25 union_area, sum(k - 1) * .25 overlap_area FROM n GROUP BY 1),
 t AS (SELECT group_id, count(*) unit_count, sum(w * h) * .25 unit_area, sum(w * h - (CASE WHEN x < 280 THEN least(w, 280 - x) ELSE 0 END) * h) * .25 outside_area FROM r GROUP BY 1)
 SELECT group_id, unit_count, unit_area::DOUBLE unit_area, outside_area::DOUBLE outside_area, union_area::DOUBLE union_area, overlap_area::DOUBLE overlap_area,
  CASE WHEN overlap_area > 1.414 THEN 'OVERLAPPING_UNITS' WHEN outside_area > 1.414 THEN 'OUTSIDE_ZONE' ELSE 'OK' END status FROM t JOIN o USING (group_id)""")
def unit_overlap_check(spark, d):
    return sp.unit_overlap_check(overlapping_rects(spark, d), ["group_id"], tile=4.0, zone_box=(0.0, 0.0, 140.0, 101.0))


@query("missing_members", """WITH a AS (SELECT o_custkey group_id, o_orderpriority model, max(o_totalprice) > 250000 ok FROM orders GROUP BY 1, 2),
 g AS (SELECT group_id, count(*) FILTER (WHERE ok)::INT verified_model_count, coalesce(string_agg(model, ',' ORDER BY model) FILTER (WHERE NOT ok), '') missing_models FROM a GROUP BY 1)
 SELECT group_id, verified_model_count, missing_models, CASE WHEN missing_models = '' AND verified_model_count = 5 THEN 'COMPLETE' ELSE 'PENDING_ALL_VERIFIED_MODELS' END status FROM g""")
def missing_members(spark, d):
    a = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("group_id"), F.col("o_orderpriority").alias("model")).agg((F.max("o_totalprice") > 250000).alias("ok"))
    out = sp.missing_members(a, a.where("ok"), ["group_id"], "model", MODELS)
    return out.withColumn("missing_models", F.array_join("missing_models", ","))


@query("group_gate", """WITH a AS (SELECT l_suppkey source_id, l_linenumber asset_key, CASE WHEN max(l_extendedprice) > 94000 THEN 'VERIFIED_INSIDE_AOI' ELSE 'FAILED' END status FROM lineitem GROUP BY 1, 2),
 g AS (SELECT source_id, count(*) = 7 AND count(*) FILTER (WHERE status = 'VERIFIED_INSIDE_AOI') = 7 ok, count(*) FILTER (WHERE status = 'VERIFIED_INSIDE_AOI') n FROM a GROUP BY 1)
 SELECT source_id, ok confirmed, CASE WHEN ok THEN 'VERIFIED_INSIDE_AOI' ELSE 'METADATA_ONLY' END group_status, CASE WHEN ok THEN 'USE_NEXT' ELSE 'REVIEW_VERIFICATION_REPORT' END action,
  n || '/7 selected assets passed' evidence FROM g""")
def group_gate(spark, d):
    a = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("source_id"), F.col("l_linenumber").alias("asset_key")).agg(
        F.when(F.max("l_extendedprice") > 94000, "VERIFIED_INSIDE_AOI").otherwise("FAILED").alias("status"))
    return sp.group_gate(a, ["source_id"], "asset_key", "status", "VERIFIED_INSIDE_AOI", 7)


@query("metric_layer", """WITH m AS (SELECT c_mktsegment group_id, o_custkey unit_id, o_orderpriority model, (floor(min(o_totalprice) / 62500) + 1)::INT k, (any_value(c_nationkey) + 1)::DOUBLE area
   FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3), r AS (SELECT group_id, unit_id, area, k, count(*) n FROM m GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY group_id, unit_id) total FROM r),
  t AS (SELECT group_id, unit_id, area, max(n) top, count(*) FILTER (WHERE n = mx) w FROM (SELECT *, max(n) OVER (PARTITION BY group_id, unit_id) mx FROM c WHERE total = 5) GROUP BY ALL)
  SELECT group_id, metric, count(*) unit_count, sum(area) valid_area, round(100 * sum(area) / 5000, 6) valid_area_percentage
  FROM (SELECT group_id, area, unnest(CASE WHEN w = 1 THEN ['modal_class', 'modal_count', 'unique_class_count'] ELSE ['modal_count', 'unique_class_count'] END) metric FROM t) GROUP BY ALL""")
def metric_layer(spark, d):
    u = cs.model_consensus(five_units(spark, d, "class_code"), list(range(1, 10)), 5)
    out = sp.metric_layer(u, ["group_id"], ["modal_class", "modal_count", "unique_class_count"], "area", 5000.0)
    return rounded(out, ["valid_area_percentage"], 6)


#: A slanted zone with a hole and a second part, directed with the inside on the left; its area is 1,573.
ZONE_RINGS = [(0, 0, [(2, 1), (57, 4), (52, 38), (20, 33), (4, 36)]), (0, 1, [(20, 12), (24, 22), (33, 20), (30, 10)]), (1, 0, [(57, 30), (60, 30), (60, 40), (57, 38)])]
EDGES = [(a[0], a[1], b[0], b[1]) for _, _, ring in ZONE_RINGS for a, b in zip(ring, ring[1:] + ring[:1])]
ZONE_AREA = sum((x2 - x1) * -(y1 + y2) for x1, y1, x2, y2 in EDGES) / 2
# The area of a rectangle inside the zone: for each edge the part of the rectangle below it, added where the edge goes left and subtracted where it goes right.
INSIDE = f"""ed AS (SELECT * FROM (VALUES {", ".join(str(tuple(map(float, e))) for e in EDGES)}) t(ex, ey, fx, fy)),
 sp AS (SELECT r.*, sign(ex - fx) s, greatest(least(ex, fx), x0) l, least(greatest(ex, fx), x1) h, ey, ex, (fy - ey) / nullif(fx - ex, 0) m FROM r LEFT JOIN ed ON least(ex, fx) < x1 AND greatest(ex, fx) > x0),
 pq AS (SELECT *, ey + (l - ex) * m p, ey + (h - ex) * m q FROM sp),
 ia AS (SELECT x0, y0, x1, y1, coalesce(sum(s * (h - l) * (CASE WHEN least(p, q) >= y0 THEN (p + q) / 2 - y0 WHEN greatest(p, q) <= y0 THEN 0 ELSE (greatest(p, q) - y0) ** 2 / (2 * abs(q - p)) END
   - CASE WHEN least(p, q) >= y1 THEN (p + q) / 2 - y1 WHEN greatest(p, q) <= y1 THEN 0 ELSE (greatest(p, q) - y1) ** 2 / (2 * abs(q - p)) END)), 0) a FROM pq GROUP BY ALL)"""
OVERLAY = """WITH a AS (SELECT (o_custkey % 60)::DOUBLE x0, (o_orderkey % 40)::DOUBLE y0, min(o_totalprice) v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
 b AS (SELECT (o_custkey % 60) + .5 x0, (o_orderkey % 40) + .5 y0, min(o_totalprice) v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2),
 c AS (SELECT floor((o_custkey % 60) / 2) * 2 x0, floor((o_orderkey % 40) / 2) * 2 y0, min(o_totalprice) v FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2),
 j AS (SELECT greatest(a.x0, b.x0, c.x0)::DOUBLE x0, greatest(a.y0, b.y0, c.y0)::DOUBLE y0, least(a.x0 + 1, b.x0 + 1, c.x0 + 2)::DOUBLE x1, least(a.y0 + 1, b.y0 + 1, c.y0 + 2)::DOUBLE y1,
   a.v > 30000 AND b.v > 30000 AND c.v > 30000 ok, (a.x0, a.y0)::VARCHAR ai, (b.x0, b.y0)::VARCHAR bi, (c.x0, c.y0)::VARCHAR ci
   FROM a JOIN b ON a.x0 < b.x0 + 1 AND b.x0 < a.x0 + 1 AND a.y0 < b.y0 + 1 AND b.y0 < a.y0 + 1
     JOIN c ON greatest(a.x0, b.x0) < c.x0 + 2 AND c.x0 < least(a.x0, b.x0) + 1 AND greatest(a.y0, b.y0) < c.y0 + 2 AND c.y0 < least(a.y0, b.y0) + 1),
 r AS (SELECT DISTINCT x0, y0, x1, y1 FROM j)"""


def zone_edges(spark):
    """The zone's edges; a zone is a parameter of these queries, as a grid's origin is."""
    rows = [(part, ring, i, float(x), float(y)) for part, ring, points in ZONE_RINGS for i, (x, y) in enumerate(points)]
    return inside.oriented_edges(spark.createDataFrame(rows, "part int, ring int, seq int, x double, y double"), [])


@query("support_overlay_zone", f"""{OVERLAY}, {INSIDE}, u AS (SELECT j.*, a area FROM j JOIN ia USING (x0, y0, x1, y1) WHERE ok AND a > {ZONE_AREA * 1e-14})
  SELECT x0, y0, x1, y1, round(area, 6) area, 'u' || lpad(row_number() OVER (ORDER BY y1 DESC, x0)::VARCHAR, 5, '0') unit_id FROM u""")
def support_overlay_zone(spark, d):
    out = sp.support_overlay(rectangles(spark, d), ["group_id"], "layer", ["a", "b", "c"], "value", "valid", ZONE_AREA, 4.0, zone_edges=zone_edges(spark))
    return rounded(out.select("x0", "y0", "x1", "y1", "area", "unit_id"), ["area"], 6)


@query("overlay_report", f"""{OVERLAY}, {INSIDE}, u AS (SELECT j.*, a area FROM j JOIN ia USING (x0, y0, x1, y1) WHERE a > {ZONE_AREA * 1e-14}),
 g AS (SELECT coalesce(sum(area) FILTER (WHERE ok), 0) c, coalesce(sum(area), 0) f, count(*) FILTER (WHERE ok) n, count(DISTINCT CASE WHEN ok THEN ai END) na, count(DISTINCT CASE WHEN ok THEN bi END) nb, count(DISTINCT CASE WHEN ok THEN ci END) nc FROM u)
 SELECT 'all' group_id, round(c, 6) common_valid_area, n analytical_unit_count, na || ',' || nb || ',' || nc native_cell_counts, {ZONE_AREA}::DOUBLE zone_area, round(100 * c / {ZONE_AREA}, 6) common_valid_percentage,
  round(f - c, 6) excluded_masked_area, round({ZONE_AREA} - f, 6) excluded_outside_footprint_area, CASE WHEN n = 0 THEN 'NO_COMMON_VALID_SUPPORT' WHEN n < 5 THEN 'FEW_NATIVE_CELLS' ELSE 'OK' END quality_flag, 'OK' status FROM g""")
def overlay_report(spark, d):
    out = sp.overlay_report(rectangles(spark, d), ["group_id"], "layer", ["a", "b", "c"], "value", "valid", ZONE_AREA, 4.0, zone_edges(spark))
    out = out.withColumn("native_cell_counts", F.array_join(F.transform("native_cell_counts", lambda n: n.cast("string")), ","))
    return rounded(out, ["common_valid_area", "common_valid_percentage", "excluded_masked_area", "excluded_outside_footprint_area"], 6)


@query("unit_containment", f"""WITH u AS (SELECT l_returnflag group_id, (l_partkey % 120 * 0.5)::DOUBLE x0, (l_suppkey % 80 * 0.5)::DOUBLE y0, (l_partkey % 120 * 0.5 + 0.5 + l_linenumber % 2 * 0.5)::DOUBLE x1, (l_suppkey % 80 * 0.5 + 0.5)::DOUBLE y1 FROM lineitem WHERE l_linenumber < 4),
 r AS (SELECT DISTINCT x0, y0, x1, y1 FROM u), {INSIDE}, t AS (SELECT group_id, count(*) unit_count, sum((x1 - x0) * (y1 - y0)) unit_area, sum((x1 - x0) * (y1 - y0) - a) outside_area FROM u JOIN ia USING (x0, y0, x1, y1) GROUP BY 1),
 e AS (SELECT group_id, y0, unnest(CASE WHEN x1 - x0 > .5 THEN [x0, x0 + .5] ELSE [x0] END) x FROM u), n AS (SELECT group_id, x, y0, count(*) k FROM e GROUP BY ALL), o AS (SELECT group_id, count(*) * .25 union_area, sum(k - 1) * .25 overlap_area FROM n GROUP BY 1)
 SELECT group_id, unit_count, unit_area::DOUBLE unit_area, round(outside_area, 5) outside_area, union_area::DOUBLE union_area, overlap_area::DOUBLE overlap_area,
  CASE WHEN overlap_area > {ZONE_AREA * 1e-4} THEN 'OVERLAPPING_UNITS' WHEN outside_area > {ZONE_AREA * 1e-4} THEN 'OUTSIDE_ZONE' ELSE 'OK' END status FROM t JOIN o USING (group_id)""")
def unit_containment(spark, d):
    """Units against the polygon itself: those in the hole and beyond the slanted borders lie outside."""
    x, y = F.col("l_partkey") % 120 * 0.5, F.col("l_suppkey") % 80 * 0.5
    units = table(spark, d, "lineitem").where("l_linenumber < 4").select(
        F.col("l_returnflag").alias("group_id"), x.alias("x0"), y.alias("y0"), (x + 0.5 + F.col("l_linenumber") % 2 * 0.5).alias("x1"), (y + 0.5).alias("y1"))
    return rounded(sp.unit_overlap_check(units, ["group_id"], 4.0, zone_edges=zone_edges(spark), zone_area=ZONE_AREA), ["outside_area"], 5)
