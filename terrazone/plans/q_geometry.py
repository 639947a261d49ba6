"""Geometry queries. Polygons come from embeddings (32 vertices each), boxes from supplier and part, grids
from orders and lineitem."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.geocols import E2, ECC, EQUAL_AREA_K0, SEMI_MAJOR
from ..operators import geometry as geo, stats
from .q_stats import summary_sql
from .registry import query, rnd, rounded, table

STEP = 2 * math.pi / 32


def polygons(spark, d):
    """Half star-shaped (simple) rings around the origin, half random (mostly self-crossing) ones."""
    e = table(spark, d, "embeddings")
    pairs = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(
        i.alias("seq"), F.get("embedding", i * 2).cast("double").alias("a"), F.get("embedding", i * 2 + 1).cast("double").alias("b")))
    v = e.select(F.col("vec_id").alias("zone_id"), "label", F.explode(pairs).alias("p")).select("zone_id", "label", "p.*")
    star = F.col("label") % 2 == 0
    return v.select("zone_id", F.lit(0).alias("part"), F.lit(0).alias("ring"), "seq",
                    F.when(star, (1 + F.col("a")) * F.cos(F.col("seq") * STEP)).otherwise(F.col("a")).alias("x"),
                    F.when(star, (1 + F.col("a")) * F.sin(F.col("seq") * STEP)).otherwise(F.col("b")).alias("y"))


POLY = f"""WITH v AS (SELECT vec_id zone_id, i::INT seq, CASE WHEN label % 2 = 0 THEN (1 + embedding[2 * i + 1]::DOUBLE) * cos(i * {STEP!r}::DOUBLE) ELSE embedding[2 * i + 1]::DOUBLE END x,
   CASE WHEN label % 2 = 0 THEN (1 + embedding[2 * i + 1]::DOUBLE) * sin(i * {STEP!r}::DOUBLE) ELSE embedding[2 * i + 2]::DOUBLE END y FROM embeddings, range(32) r(i)),
 e AS (SELECT a.zone_id, a.seq, a.x x1, a.y y1, b.x x2, b.y y2 FROM v a JOIN v b ON a.zone_id = b.zone_id AND b.seq = (a.seq + 1) % 32)"""


@query("geo_ring_metrics", f"""{POLY}, m AS (SELECT zone_id, count(*) n, sum(x1 * y2 - x2 * y1) s, sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) p, sum((x1 + x2) * (x1 * y2 - x2 * y1)) mx,
   sum((y1 + y2) * (x1 * y2 - x2 * y1)) my, min(x1) a, min(y1) b, max(x1) c, max(y1) dd FROM e GROUP BY 1)
 SELECT zone_id, n vertex_count, round(s, 6) signed_double_area, round(abs(s) / 2, 6) area, round(p, 6) perimeter, round(mx / (3 * s), 5) centroid_x, round(my / (3 * s), 5) centroid_y,
  CASE WHEN s > 0 THEN 'counterclockwise' ELSE 'clockwise' END ring_orientation, round(a, 6) min_x, round(b, 6) min_y, round(c, 6) max_x, round(dd, 6) max_y, 'OK' status FROM m""")
def geo_ring_metrics(spark, d):
    out = rounded(geo.geo_ring_metrics(polygons(spark, d), ["zone_id"]), ["signed_double_area", "area", "perimeter", "min_x", "min_y", "max_x", "max_y"], 6)
    return rounded(out, ["centroid_x", "centroid_y"], 5)


@query("geo_is_simple", f"""{POLY}, c AS (SELECT a.zone_id, bool_or(((a.x2-a.x1)*(b.y1-a.y1)-(a.y2-a.y1)*(b.x1-a.x1)) * ((a.x2-a.x1)*(b.y2-a.y1)-(a.y2-a.y1)*(b.x2-a.x1)) < 0
    AND ((b.x2-b.x1)*(a.y1-b.y1)-(b.y2-b.y1)*(a.x1-b.x1)) * ((b.x2-b.x1)*(a.y2-b.y1)-(b.y2-b.y1)*(a.x2-b.x1)) < 0) crosses
   FROM e a JOIN e b ON a.zone_id = b.zone_id AND b.seq > a.seq + 1 AND NOT (a.seq = 0 AND b.seq = 31) GROUP BY 1) SELECT zone_id, NOT crosses is_simple FROM c""")
def geo_is_simple(spark, d):
    return geo.geo_is_simple(polygons(spark, d), ["zone_id"])


_N = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
_RECT = SEMI_MAJOR * (1 - E2 / 4 - 3 * E2 ** 2 / 64 - 5 * E2 ** 3 / 256)
_EP = E2 / (1 - E2)


@query("geo_utm_to_wgs84", f"""WITH p AS (SELECT c_custkey point_id, (400000 + c_acctbal * 20) - 500000 x, (500000 + c_custkey * 100)::DOUBLE / 0.9996 / {_RECT!r}::DOUBLE mu FROM customer),
 f AS (SELECT point_id, x, mu + (3 * {_N!r}::DOUBLE / 2 - 27 * {_N ** 3!r}::DOUBLE / 32) * sin(2 * mu) + (21 * {_N ** 2!r}::DOUBLE / 16 - 55 * {_N ** 4!r}::DOUBLE / 32) * sin(4 * mu) + 151 * {_N ** 3!r}::DOUBLE / 96 * sin(6 * mu) + 1097 * {_N ** 4!r}::DOUBLE / 512 * sin(8 * mu) phi FROM p),
 q AS (SELECT *, {_EP!r}::DOUBLE * cos(phi) * cos(phi) c, tan(phi) * tan(phi) t, {SEMI_MAJOR!r}::DOUBLE / sqrt(1 - {E2!r}::DOUBLE * sin(phi) * sin(phi)) nu, {SEMI_MAJOR * (1 - E2)!r}::DOUBLE / pow(1 - {E2!r}::DOUBLE * sin(phi) * sin(phi), 1.5) rho FROM f),
 r AS (SELECT *, x / (nu * 0.9996) d FROM q)
 SELECT point_id, round(15 + degrees((d - (1 + 2 * t + c) * pow(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * {_EP!r}::DOUBLE + 24 * t * t) * pow(d, 5) / 120) / cos(phi)), 8) lon,
  round(degrees(phi - (nu * tan(phi) / rho) * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * {_EP!r}::DOUBLE) * pow(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * {_EP!r}::DOUBLE - 3 * c * c) * pow(d, 6) / 720)), 8) lat FROM r""")
def geo_utm_to_wgs84(spark, d):
    p = table(spark, d, "customer").select(F.col("c_custkey").alias("point_id"), (400000 + F.col("c_acctbal") * 20).alias("e"), (500000 + F.col("c_custkey") * 100).cast("double").alias("n"))
    return rounded(geo.geo_utm_to_wgs84(p, "e", "n", 33).select("point_id", "lon", "lat"), ["lon", "lat"], 8)


def _x_sql(lon):
    return f"(radians({lon}) * {SEMI_MAJOR * EQUAL_AREA_K0!r}::DOUBLE)"


def _y_sql(lat):
    s = f"sin(radians({lat}))"
    return (f"({1 - E2!r}::DOUBLE * ({s} / (1 - {E2!r}::DOUBLE * {s} * {s}) - ln((1 - {ECC!r}::DOUBLE * {s}) / (1 + {ECC!r}::DOUBLE * {s})) / {2 * ECC!r}::DOUBLE)"
            f" * {SEMI_MAJOR / (2 * EQUAL_AREA_K0)!r}::DOUBLE)")


@query("geo_to_equal_area", f"""WITH p AS (SELECT c_custkey point_id, c_acctbal / 100 lon, (c_custkey % 1200) / 10.0::DOUBLE - 60 lat FROM customer)
 SELECT point_id, round({_x_sql('lon')}, 3) x, round({_y_sql('lat')}, 3) y FROM p""")
def geo_to_equal_area(spark, d):
    p = table(spark, d, "customer").select(F.col("c_custkey").alias("point_id"), (F.col("c_acctbal") / 100).alias("lon"), ((F.col("c_custkey") % 1200) / 10.0 - 60).alias("lat"))
    return rounded(geo.geo_to_equal_area(p).select("point_id", "x", "y"), ["x", "y"], 3)


@query("geo_densify", f"""{POLY}, l AS (SELECT zone_id, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) len FROM e)
 SELECT zone_id, sum(greatest(1, ceil(len / .013)))::BIGINT part_count, round(sum(len), 6) total_length, round(max(len / greatest(1, ceil(len / .013))), 6) longest FROM l GROUP BY 1""")
def geo_densify(spark, d):
    e = geo.geo_densify(geo.ring_edges(polygons(spark, d), ["zone_id"]), 0.013)
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return e.groupBy("zone_id").agg(F.count("*").alias("part_count"), rnd(F.sum(length), 6).alias("total_length"), rnd(F.max(length), 6).alias("longest"))


@query("cell_window", """WITH b AS (SELECT c_nationkey zone_id, min(c_acctbal) x0, max(c_acctbal) x1, min(c_custkey) y0, max(c_custkey) y1 FROM customer GROUP BY 1),
 w AS (SELECT zone_id, greatest(0, floor((x0 - 5 + 500) / 7.5)) col0, least(1300, ceil((x1 + 5 + 500) / 7.5)) col1, greatest(0, floor((1000 - y1 - 5) / 3.3)) row0, least(400, ceil((1000 - y0 + 5) / 3.3)) row1 FROM b)
 SELECT zone_id, col0::BIGINT col0, col1::BIGINT col1, row0::BIGINT row0, row1::BIGINT row1, greatest(0, col1 - col0)::BIGINT window_width, greatest(0, row1 - row0)::BIGINT window_height,
  CASE WHEN col1 <= col0 OR row1 <= row0 THEN 'NO_COVERAGE' ELSE 'OK' END window_status FROM w""")
def cell_window(spark, d):
    b = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("zone_id")).agg(
        F.min("c_acctbal").alias("min_x"), F.max("c_acctbal").alias("max_x"), F.min("c_custkey").alias("min_y"), F.max("c_custkey").alias("max_y"))
    return geo.cell_window(b, -500.0, 1000.0, 7.5, 3.3, 1300, 400, buffer=5.0).drop("min_x", "max_x", "min_y", "max_y")


def box_vertices(df, keys, x0, y0, x1, y1):
    corners = F.array(*[F.struct(F.lit(i).alias("seq"), x.alias("x"), y.alias("y")) for i, (x, y) in
                        enumerate([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])])
    return df.select(*keys, F.lit(0).alias("part"), F.lit(0).alias("ring"), F.explode(corners).alias("v")).select(*keys, "part", "ring", "v.*")


def supplier_zones(spark, d):
    s = table(spark, d, "supplier").withColumn("zone_id", F.col("s_suppkey"))
    x0, y0 = F.col("s_suppkey") % 50 + 0.13, F.col("s_nationkey") - 10 + 0.27
    return box_vertices(s, ["zone_id"], x0, y0, x0 + 1 + F.col("s_acctbal") / 5000, y0 + 0.5 + F.col("s_suppkey") % 7 * 0.3)


SZ = """WITH z AS (SELECT s_suppkey zone_id, s_suppkey % 50 + .13::DOUBLE x0, s_nationkey - 10 + .27::DOUBLE y0, s_suppkey % 50 + .13::DOUBLE + 1 + s_acctbal / 5000 x1, s_nationkey - 10 + .27::DOUBLE + .5::DOUBLE + s_suppkey % 7 * .3::DOUBLE y1 FROM supplier)"""


@query("cell_weights", f"""{SZ}, c AS (SELECT *, unnest(range(floor((x0 + 180) / .25)::BIGINT, ceil((x1 + 180) / .25)::BIGINT)) "column" FROM z), r AS (SELECT *, unnest(range(floor((90 - y1) / .25)::BIGINT, ceil((90 - y0) / .25)::BIGINT)) "row" FROM c),
 b AS (SELECT *, greatest(x0, -180 + "column" * .25) l, least(x1, -180 + ("column" + 1) * .25) rr, greatest(y0, 90 - ("row" + 1) * .25) bt, least(y1, 90 - "row" * .25) tp FROM r)
 SELECT zone_id, "row", "column", round(({_x_sql('rr')} - {_x_sql('l')}) * ({_y_sql('tp')} - {_y_sql('bt')}) / 1e4, 4) weight_ha, round(({_x_sql('x1')} - {_x_sql('x0')}) * ({_y_sql('y1')} - {_y_sql('y0')}) / 1e4, 3) zone_area_ha FROM b WHERE rr > l AND tp > bt""")
def cell_weights(spark, d):
    out = geo.cell_weights(supplier_zones(spark, d), ["zone_id"], -180.0, 90.0, 0.25, 0.25, geographic=True)
    return out.select("zone_id", "row", "column", rnd(F.col("weight") / 1e4, 4).alias("weight_ha"), rnd(F.col("zone_area") / 1e4, 3).alias("zone_area_ha"))


WEIGHTS = f"""{SZ}, c AS (SELECT *, unnest(range(floor((x0 + 180) / .25)::BIGINT, ceil((x1 + 180) / .25)::BIGINT)) "column" FROM z), r AS (SELECT *, unnest(range(floor((90 - y1) / .25)::BIGINT, ceil((90 - y0) / .25)::BIGINT)) "row" FROM c),
 b AS (SELECT *, greatest(x0, -180 + "column" * .25) l, least(x1, -180 + ("column" + 1) * .25) rr, greatest(y0, 90 - ("row" + 1) * .25) bt, least(y1, 90 - "row" * .25) tp FROM r),
 w AS (SELECT zone_id, "row", "column", ({_x_sql('rr')} - {_x_sql('l')}) * ({_y_sql('tp')} - {_y_sql('bt')}) / 1e4 weight FROM b WHERE rr > l AND tp > bt)"""


@query("zonal_summary", f"""{WEIGHTS}, g AS (SELECT o_orderstatus layer_id, 300 + o_custkey % 100 "row", 720 + o_orderkey % 210 "column", max(sqrt(o_totalprice)) v FROM orders GROUP BY 1, 2, 3),
 zc AS (SELECT zone_id, layer_id, v, weight FROM w JOIN g USING ("row", "column") WHERE v > 250) SELECT * REPLACE (round("min", 4) AS "min", round("max", 4) AS "max", round(p05, 4) AS p05, round(p25, 4) AS p25,
  round("median", 4) AS "median", round(p75, 4) AS p75, round(p95, 4) AS p95) FROM ({summary_sql('zc', 'zone_id, layer_id', 'v', 'weight')})""")
def zonal_summary(spark, d):
    """The whole raster path: cell weights per zone, joined with every layer, decoded and summarised."""
    w = geo.cell_weights(supplier_zones(spark, d), ["zone_id"], -180.0, 90.0, 0.25, 0.25, geographic=True)
    cells = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("layer_id"), (300 + F.col("o_custkey") % 100).alias("row"), (720 + F.col("o_orderkey") % 210).alias("column")).agg(
        F.max(F.sqrt("o_totalprice")).alias("raw"))
    inside = stats.decode_cells(geo.zone_cells(w.withColumn("weight", F.col("weight") / 1e4), cells), "raw", F.col("raw") > 250, "weight")
    out = stats.weighted_summary(inside.where("valid"), ["zone_id", "layer_id"], "value", "weight")
    return rounded(out, ["min", "max", "mean", "std", "p05", "p25", "median", "p75", "p95"])


@query("touched_cells", f"""{SZ}, c AS (SELECT *, unnest(range(ceil((x0 + 180) / .25)::BIGINT - 1, floor((x1 + 180) / .25)::BIGINT + 1)) "column" FROM z), r AS (SELECT *, unnest(range(ceil((90 - y1) / .25)::BIGINT - 1, floor((90 - y0) / .25)::BIGINT + 1)) "row" FROM c),
 g AS (SELECT 300 + o_custkey % 100 "row", 720 + o_orderkey % 210 "column", max(o_totalprice) > 250000 ok FROM orders GROUP BY 1, 2)
 SELECT zone_id, 'orders' layer_id, count(*) intersecting_cell_count, count(*) FILTER (WHERE ok) valid_cell_count, round(100 * count(*) FILTER (WHERE ok) / count(*), 6) valid_selected_percentage FROM r JOIN g USING ("row", "column") GROUP BY 1""")
def touched_cells(spark, d):
    t = geo.touched_cells(supplier_zones(spark, d), ["zone_id"], -180.0, 90.0, 0.25, 0.25)
    cells = table(spark, d, "orders").groupBy((300 + F.col("o_custkey") % 100).alias("row"), (720 + F.col("o_orderkey") % 210).alias("column")).agg((F.max("o_totalprice") > 250000).alias("ok"))
    return rounded(geo.touched_report(t, cells.withColumn("layer_id", F.lit("orders")), ["zone_id"], ["layer_id"], "ok"), ["valid_selected_percentage"], 6)


@query("point_sample", """WITH g AS (SELECT o_custkey % 200 "row", o_orderkey % 110 "column", max(o_totalprice) v FROM orders GROUP BY 1, 2),
 p AS (SELECT c_custkey point_id, floor((2000 - c_custkey) / 10)::BIGINT "row", floor((c_acctbal + 1000) / 100)::BIGINT "column" FROM customer) SELECT point_id, p."row", p."column", v "sample" FROM p LEFT JOIN g USING ("row", "column")""")
def point_sample(spark, d):
    cells = table(spark, d, "orders").groupBy((F.col("o_custkey") % 200).alias("row"), (F.col("o_orderkey") % 110).alias("column")).agg(F.max("o_totalprice").alias("value"))
    p = table(spark, d, "customer").select(F.col("c_custkey").alias("point_id"), "c_acctbal", "c_custkey")
    return geo.point_sample(p, cells, "c_acctbal", "c_custkey", -1000.0, 2000.0, 100.0, 10.0).select("point_id", "row", "column", "sample")


def part_boxes(spark, d):
    p = table(spark, d, "part")
    x0, y0 = (F.col("p_partkey") % 70).cast("double"), F.col("p_size").cast("double")
    return p.withColumns({"feature_id": F.col("p_partkey"), "x0": x0, "y0": y0, "x1": x0 + F.col("p_retailprice") / 1000, "y1": y0 + 0.7})


def part_edges(spark, d):
    return geo.ring_edges(box_vertices(part_boxes(spark, d), ["feature_id"], *[F.col(c) for c in ("x0", "y0", "x1", "y1")]), ["feature_id", "part", "ring"])


def zone_edges(spark, d):
    s = table(spark, d, "supplier").withColumn("zone_id", F.col("s_suppkey"))
    x0, y0 = F.col("s_suppkey") % 70 + 0.47, F.col("s_nationkey") * 2 + 0.31
    return geo.ring_edges(box_vertices(s, ["zone_id"], x0, y0, x0 + 2.3, y0 + 1.7), ["zone_id", "part", "ring"])


FZ = """WITH f AS (SELECT p_partkey feature_id, p_brand layer_id, (p_partkey % 70)::DOUBLE x0, p_size::DOUBLE y0, (p_partkey % 70) + p_retailprice / 1000 x1, p_size + .7::DOUBLE y1 FROM part),
 z AS (SELECT s_suppkey zone_id, s_suppkey % 70 + .47::DOUBLE x0, s_nationkey * 2 + .31::DOUBLE y0, s_suppkey % 70 + .47::DOUBLE + 2.3 x1, s_nationkey * 2 + .31::DOUBLE + 1.7 y1 FROM supplier)"""


@query("feature_intersects", f"{FZ} SELECT feature_id, zone_id FROM f JOIN z ON f.x0 <= z.x1 AND z.x0 <= f.x1 AND f.y0 <= z.y1 AND z.y0 <= f.y1")
def feature_intersects(spark, d):
    return geo.feature_intersects(part_edges(spark, d), zone_edges(spark, d), ["feature_id"], ["zone_id"], tile=4.0)


@query("features_near", f"{FZ} SELECT feature_id, zone_id FROM f JOIN z ON pow(greatest(0, z.x0 - f.x1, f.x0 - z.x1), 2) + pow(greatest(0, z.y0 - f.y1, f.y0 - z.y1), 2) <= .9 * .9")
def features_near(spark, d):
    return geo.features_near(part_edges(spark, d), zone_edges(spark, d), ["feature_id"], ["zone_id"], 2.0, 0.9)


def part_features(spark, d):
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))])
    return part_boxes(spark, d).select("feature_id", F.col("p_brand").alias("layer_id"), ring.alias("ring"))


@query("feature_clip", f"""{FZ} SELECT feature_id, layer_id, zone_id, round((least(f.x1, z.x1) - greatest(f.x0, z.x0)) * (least(f.y1, z.y1) - greatest(f.y0, z.y0)), 6) clipped_area
  FROM f JOIN z ON f.x0 < z.x1 AND z.x0 < f.x1 AND f.y0 < z.y1 AND z.y0 < f.y1""")
def feature_clip(spark, d):
    out = geo.feature_areas(part_features(spark, d), zone_edges(spark, d), ["feature_id", "layer_id"], ["zone_id"], tile=4.0)
    return rounded(out, ["clipped_area"], 6)


@query("feature_counts", f"""{FZ} SELECT layer_id, zone_id, count(*) feature_count, round(sum((least(f.x1, z.x1) - greatest(f.x0, z.x0)) * (least(f.y1, z.y1) - greatest(f.y0, z.y0))), 6) clipped_area
  FROM f JOIN z ON f.x0 < z.x1 AND z.x0 < f.x1 AND f.y0 < z.y1 AND z.y0 < f.y1 GROUP BY ALL""")
def feature_counts(spark, d):
    out = geo.zone_feature_counts(part_features(spark, d), zone_edges(spark, d), ["layer_id"], ["zone_id"], tile=4.0)
    return rounded(out, ["clipped_area"], 6)


@query("mosaic_latest", """SELECT user_id cell_id, arg_max("value", event_id) FILTER (WHERE "value" > 5) "value", max(event_id) FILTER (WHERE "value" > 5) image_index, count(*) FILTER (WHERE "value" > 5) image_count
  FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE "value" > 5) > 0""")
def mosaic_latest(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("cell_id"), F.when(F.col("value") > 5, F.col("value")).alias("value"), "event_id")
    return geo.mosaic_latest(e, ["cell_id"], "value", "event_id")


@query("modal_composite", """WITH o AS (SELECT user_id cell_id, (json_extract_string(props, '$.k')::INT % 9) label FROM events WHERE greatest("value" / 40, (event_id % 10) / 10) >= .6), c AS (SELECT cell_id, label, count(*) n FROM o GROUP BY ALL)
 SELECT cell_id, arg_max(label, (n, -label)) label, sum(n)::BIGINT observation_count FROM c GROUP BY 1 HAVING sum(n) >= 3""")
def modal_composite(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("cell_id"), (F.get_json_object("props", "$.k").cast("int") % 9).alias("label"),
                                         (F.col("value") / 40).alias("p_a"), (F.col("event_id") % 10 / 10).alias("p_b"))
    return geo.modal_composite(e, ["cell_id"], "label", ["p_a", "p_b"])


@query("bilinear_resample", """WITH s AS (SELECT l_returnflag layer_id, l_orderkey % 100 "row", l_partkey % 80 "column", sqrt(max(CASE WHEN l_discount > .02 THEN l_extendedprice END)) v FROM lineitem GROUP BY 1, 2, 3),
 t AS (SELECT f.layer_id, c_custkey target_id, (c_acctbal + 1000) / 140 - .5 u, (1000 - c_custkey % 1000) / 10.0::DOUBLE - .5 vv FROM customer, (SELECT DISTINCT l_returnflag layer_id FROM lineitem) f),
 n AS (SELECT layer_id, target_id, floor(vv)::BIGINT + dr "row", floor(u)::BIGINT + dc "column", (CASE dr WHEN 1 THEN vv - floor(vv) ELSE 1 - (vv - floor(vv)) END) * (CASE dc WHEN 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) w FROM t, range(2) a(dr), range(2) b(dc))
 SELECT n.layer_id, n.target_id, round(sum(w * v) FILTER (WHERE v IS NOT NULL AND w > 0) / nullif(sum(w) FILTER (WHERE v IS NOT NULL AND w > 0), 0), 3) "value", count(*) FILTER (WHERE v IS NOT NULL AND w > 0) neighbour_count
 FROM n LEFT JOIN s ON s.layer_id = n.layer_id AND s."row" = n."row" AND s."column" = n."column" GROUP BY ALL""")
def bilinear_resample(spark, d):
    s = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("layer_id"), (F.col("l_orderkey") % 100).alias("row"), (F.col("l_partkey") % 80).alias("column")).agg(F.sqrt(F.max(F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")))).alias("value"))
    t = table(spark, d, "customer").select(F.col("c_custkey").alias("target_id"), "c_acctbal", (F.col("c_custkey") % 1000).alias("y"),
                                           F.explode(F.array(*[F.lit(x) for x in "ANR"])).alias("layer_id"))
    return rounded(geo.bilinear_resample(s, t, ["layer_id"], ["target_id"], "c_acctbal", "y", -1000.0, 1000.0, 140.0, 10.0), ["value"], 3)


@query("slope_degrees", """WITH g AS (SELECT o_custkey % 100 r, o_orderkey % 150 c, max(o_totalprice) / 1000 v FROM orders GROUP BY 1, 2),
 n AS (SELECT g.r, g.c, g.v, e.v ev, w.v wv, s.v sv, o.v nv FROM g LEFT JOIN g e ON e.r = g.r AND e.c = g.c + 1 LEFT JOIN g w ON w.r = g.r AND w.c = g.c - 1 LEFT JOIN g s ON s.c = g.c AND s.r = g.r + 1 LEFT JOIN g o ON o.c = g.c AND o.r = g.r - 1),
 d AS (SELECT r, c, CASE WHEN c = 0 THEN (ev - v) / 30 WHEN c = 149 THEN (v - wv) / 30 ELSE (ev - wv) / 60 END gx, CASE WHEN r = 0 THEN (sv - v) / 30 WHEN r = 99 THEN (v - nv) / 30 ELSE (sv - nv) / 60 END gy FROM n)
 SELECT r "row", c "column", round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) slope FROM d""")
def slope_degrees(spark, d):
    g = table(spark, d, "orders").groupBy((F.col("o_custkey") % 100).alias("row"), (F.col("o_orderkey") % 150).alias("column")).agg((F.max("o_totalprice") / 1000).alias("value"))
    out = geo.slope_degrees(g.withColumn("layer_id", F.lit("dem")), ["layer_id"], "value", 30.0, 150, 100)
    return out.select("row", "column", rnd("slope", 6).alias("slope"))
