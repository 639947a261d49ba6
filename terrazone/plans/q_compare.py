"""Scenario comparisons, over orders as layers: product = customer parity, period = year band, scenario =
order status, management = order parity, model = priority (the lowest priority stands for the ensemble),
position = (nation, customer number mod 4), value = lowest price. 1995 is the historical period."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import group_key
from ..operators import compare as cp, consensus as cs, support as sp
from .q_stats import summary_sql
from .registry import query, rnd, rounded, table

MODELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
ROUND_ALL = """* REPLACE (round("min", 4) AS "min", round("max", 4) AS "max", round(p05, 4) AS p05, round(p25, 4) AS p25,
  round("median", 4) AS "median", round(p75, 4) AS p75, round(p95, 4) AS p95)"""
SUMMARY = ["min", "max", "mean", "std", "p05", "p25", "median", "p75", "p95"]


def layer_cells(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select("c_custkey", "c_nationkey")
    y = F.year("o_orderdate")
    past = y == 1995
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(F.col("o_custkey") % 2 == 0, "CLS").otherwise("YLD").alias("map_code"),
        F.when(past, "HP0120").when(y <= 1997, "FP2140").when(y <= 1999, "FP4160").when(y == 2000, "FP6180").otherwise("FP8100").alias("period_code"),
        F.when(past, "HIST").when(F.col("o_orderstatus") == "F", "SSP126").when(F.col("o_orderstatus") == "O", "SSP370").otherwise("SSP585").alias("ssp_code"),
        F.when(F.col("o_orderkey") % 2 == 0, "HRLM").otherwise("HILM").alias("management_code"),
        F.when(past, "AGERA5").when(F.col("o_orderpriority") == "5-LOW", "ENSEMBLE").otherwise(F.col("o_orderpriority")).alias("climate_model_code"),
        F.col("c_nationkey").alias("row"), (F.col("o_custkey") % 4).alias("column"), "o_totalprice")
    cells = j.groupBy("map_code", "period_code", "ssp_code", "management_code", "climate_model_code", "row", "column").agg(F.min("o_totalprice").alias("value"))
    return cells.withColumns({
        "layer_id": F.concat_ws(".", "map_code", "period_code", "climate_model_code", "ssp_code", "management_code"),
        "area": (F.col("row") + 1 + F.col("column")).cast("double"), "class_code": (F.floor(F.col("value") / 62500) + 1).cast("int")})


DIMS = ["layer_id", "map_code", "period_code", "ssp_code", "management_code", "climate_model_code"]
LC = """WITH j AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'CLS' ELSE 'YLD' END map_code, year(o_orderdate) y, o_orderstatus s, o_orderpriority p,
   CASE WHEN o_orderkey % 2 = 0 THEN 'HRLM' ELSE 'HILM' END management_code, c_nationkey "row", o_custkey % 4 "column", o_totalprice t FROM orders JOIN customer ON o_custkey = c_custkey),
 e AS (SELECT map_code, CASE WHEN y = 1995 THEN 'HP0120' WHEN y <= 1997 THEN 'FP2140' WHEN y <= 1999 THEN 'FP4160' WHEN y = 2000 THEN 'FP6180' ELSE 'FP8100' END period_code,
   CASE WHEN y = 1995 THEN 'HIST' WHEN s = 'F' THEN 'SSP126' WHEN s = 'O' THEN 'SSP370' ELSE 'SSP585' END ssp_code, management_code,
   CASE WHEN y = 1995 THEN 'AGERA5' WHEN p = '5-LOW' THEN 'ENSEMBLE' ELSE p END climate_model_code, "row", "column", t FROM j),
 lc AS (SELECT map_code || '.' || period_code || '.' || climate_model_code || '.' || ssp_code || '.' || management_code layer_id, map_code, period_code, ssp_code, management_code, climate_model_code,
   "row", "column", min(t) v, (any_value("row") + 1 + any_value("column"))::DOUBLE area, (floor(min(t) / 62500) + 1)::INT k FROM e
   GROUP BY map_code, period_code, ssp_code, management_code, climate_model_code, "row", "column"),
 ly AS (SELECT DISTINCT layer_id, map_code, period_code, ssp_code, management_code, climate_model_code FROM lc),
 pm AS (SELECT CASE WHEN a.period_code = b.period_code THEN 'cross_ssp' ELSE 'cross_period' END comparison_kind, a.layer_id layer_a, b.layer_id layer_b, a.map_code, a.management_code, a.climate_model_code
   FROM ly a JOIN ly b USING (map_code, management_code, climate_model_code) WHERE a.climate_model_code NOT IN ('ENSEMBLE', 'AGERA5')
   AND ((a.period_code = b.period_code AND a.ssp_code < b.ssp_code) OR (a.ssp_code = b.ssp_code AND a.period_code < b.period_code))),
 ph AS (SELECT 'historical_future' comparison_kind, a.layer_id layer_a, b.layer_id layer_b, a.map_code, a.management_code, b.climate_model_code
   FROM ly a JOIN ly b USING (map_code, management_code) WHERE a.period_code = 'HP0120' AND b.period_code LIKE 'FP%')"""
UNITS = f"""{LC}, pu AS (SELECT p.*, a."row", a."column", a.area, a.v va, b.v vb, a.k ka, b.k kb FROM (SELECT * FROM pm UNION ALL SELECT * FROM ph) p
   JOIN lc a ON a.layer_id = p.layer_a JOIN lc b ON b.layer_id = p.layer_b AND b."row" = a."row" AND b."column" = a."column")"""
KEYS = ["comparison_kind", "layer_a", "layer_b"]


def all_pairs(cells):
    layers = cells.select(*DIMS).distinct()
    past = layers.where("period_code = 'HP0120'")
    return cp.pairs_matched(layers, MODELS).unionByName(cp.pairs_historical(layers, past))


@query("historical_view", """SELECT p_partkey layer_id, p_type map_code, 'HP0120' period_code, 'AGERA5' climate_model_code, 'HIST' ssp_code, p_brand management_code
  FROM part WHERE p_type IN ('ECONOMY', 'SMALL') AND p_size % 3 > 0""")
def historical_view(spark, d):
    layers = table(spark, d, "part").select(F.col("p_partkey").alias("layer_id"), F.col("p_type").alias("comparison_group"),
                                            F.when(F.col("p_size") % 3 > 0, "EXTRACTED").otherwise("EMPTY").alias("extraction_status"),
                                            F.col("p_brand").alias("management_code"))
    return cp.historical_view(layers, ["ECONOMY", "SMALL"]).select("layer_id", "map_code", "period_code", "climate_model_code", "ssp_code", "management_code")


@query("pairs_matched", f"{LC} SELECT * FROM pm")
def pairs_matched(spark, d):
    return cp.pairs_matched(layer_cells(spark, d).select(*DIMS).distinct(), MODELS)


@query("pairs_historical", f"{LC} SELECT * FROM ph")
def pairs_historical(spark, d):
    layers = layer_cells(spark, d).select(*DIMS).distinct()
    return cp.pairs_historical(layers, layers.where("period_code = 'HP0120'"))


@query("pair_units", f"""{UNITS} SELECT comparison_kind, layer_a, layer_b, "row", "column", area, va value_a, vb value_b, round(vb - va, 4) absolute_difference,
  round(100 * (vb - va) / va, 6) percentage_difference, 'DEFINED' percentage_status FROM pu""")
def pair_units(spark, d):
    cells = layer_cells(spark, d)
    out = cp.pair_units(all_pairs(cells), cells, categorical=False)
    out = out.select(*KEYS, "row", "column", "area", "value_a", "value_b", "absolute_difference", "percentage_difference", "percentage_status")
    return rounded(rounded(out, ["absolute_difference"]), ["percentage_difference"], 6)


@query("transition_matrix", f"{UNITS} SELECT comparison_kind, layer_a, layer_b, ka class_a, kb class_b, sum(area) area FROM pu GROUP BY ALL")
def transition_matrix(spark, d):
    cells = layer_cells(spark, d)
    return cp.transition_matrix(cp.pair_units(all_pairs(cells), cells, True, value="class_code"), KEYS)


@query("transition_totals", f"""{UNITS}, t AS (SELECT comparison_kind, layer_a, layer_b, sum(area) c, sum(CASE WHEN ka = kb THEN area ELSE 0 END) u FROM pu GROUP BY ALL)
  SELECT p.comparison_kind, p.layer_a, p.layer_b, coalesce(c, 0)::DOUBLE common_area, coalesce(u, 0)::DOUBLE unchanged_area, round(100 * u / c, 6) agreement_percentage, CASE WHEN c IS NULL THEN 'NO_COMMON_VALID_SUPPORT' ELSE 'OK' END support_status
  FROM (SELECT comparison_kind, layer_a, layer_b FROM pm UNION ALL SELECT comparison_kind, layer_a, layer_b FROM ph) p LEFT JOIN t USING (comparison_kind, layer_a, layer_b)""")
def transition_totals(spark, d):
    cells = layer_cells(spark, d)
    pairs = all_pairs(cells)
    return rounded(cp.transition_totals(cp.pair_units(pairs, cells, True, value="class_code"), KEYS, every=pairs), ["agreement_percentage"], 6)


@query("difference_summary", f"""{UNITS}, z AS (SELECT comparison_kind, layer_a, layer_b, sqrt(area) area, unnest(['value_a', 'value_b', 'absolute_difference', 'percentage_difference']) metric,
  unnest([va, vb, vb - va, 100 * (vb - va) / va]) v FROM pu),
 r AS (SELECT {ROUND_ALL} FROM ({summary_sql('z', 'comparison_kind, layer_a, layer_b, metric', 'v', 'area')}))
 SELECT r.* REPLACE (p.comparison_kind AS comparison_kind, p.layer_a AS layer_a, p.layer_b AS layer_b, p.metric AS metric), CASE WHEN r.metric IS NULL THEN 'NO_COMMON_VALID_SUPPORT' ELSE 'OK' END support_status
 FROM (SELECT comparison_kind, layer_a, layer_b, unnest(['value_a', 'value_b', 'absolute_difference', 'percentage_difference']) metric FROM (SELECT comparison_kind, layer_a, layer_b FROM pm UNION ALL SELECT comparison_kind, layer_a, layer_b FROM ph)) p
 LEFT JOIN r ON r.comparison_kind = p.comparison_kind AND r.layer_a = p.layer_a AND r.layer_b = p.layer_b AND r.metric = p.metric""")
def difference_summary(spark, d):
    cells = layer_cells(spark, d).withColumn("area", F.sqrt("area"))   # weights that avoid exact rounding ties
    pairs = all_pairs(cells)
    return rounded(cp.difference_summary(cp.pair_units(pairs, cells, False), KEYS, every=pairs), SUMMARY)


@query("difference_totals", f"""{UNITS}, z AS (SELECT comparison_kind, layer_a, layer_b, sum(area) w, sum(area * va) / sum(area) ma, sum(area * vb) / sum(area) mb FROM pu GROUP BY ALL)
  SELECT p.comparison_kind, p.layer_a, p.layer_b, coalesce(w, 0)::DOUBLE percentage_defined_area, round(100 * (mb - ma) / ma, 6) percentage_change_of_means, CASE WHEN w IS NULL THEN 'NO_COMMON_VALID_SUPPORT' ELSE 'OK' END support_status
  FROM (SELECT comparison_kind, layer_a, layer_b FROM pm UNION ALL SELECT comparison_kind, layer_a, layer_b FROM ph) p LEFT JOIN z USING (comparison_kind, layer_a, layer_b)""")
def difference_totals(spark, d):
    cells = layer_cells(spark, d)
    pairs = all_pairs(cells)
    return rounded(cp.difference_totals(cp.pair_units(pairs, cells, False), KEYS, every=pairs), ["percentage_change_of_means"], 6)


# Four individual models form a group here; each group's own support comes from support_aligned.
GROUPS = f"""{LC}, s AS (SELECT 'GRP_' || map_code || '_' || period_code || '_' || ssp_code || '_' || management_code group_id, map_code, management_code, period_code, ssp_code, "row", "column", any_value(area) area,
   list(v ORDER BY climate_model_code) vs, list(k ORDER BY climate_model_code) ks FROM lc WHERE climate_model_code NOT IN ('ENSEMBLE', 'AGERA5') GROUP BY ALL HAVING count(*) = 4),
 gr AS (SELECT DISTINCT group_id, map_code, management_code, period_code, ssp_code FROM s),
 gp AS (SELECT CASE WHEN a.period_code = b.period_code THEN 'cross_ssp' ELSE 'cross_period' END comparison_kind, a.group_id group_a, b.group_id group_b, a.map_code, a.management_code FROM gr a JOIN gr b USING (map_code, management_code)
   WHERE (a.period_code = b.period_code AND a.ssp_code < b.ssp_code) OR (a.ssp_code = b.ssp_code AND a.period_code < b.period_code)),
 gu AS (SELECT gp.*, a."row", a."column", a.area, a.vs va, b.vs vb, a.ks ka, b.ks kb FROM gp JOIN s a ON a.group_id = gp.group_a JOIN s b ON b.group_id = gp.group_b AND a."row" = b."row" AND a."column" = b."column")"""
GKEYS = ["comparison_kind", "group_a", "group_b"]


def group_units(spark, d, value="value"):
    cells = layer_cells(spark, d).where(F.col("climate_model_code").isin(*MODELS))
    dims = ["map_code", "period_code", "ssp_code", "management_code"]
    u = sp.support_aligned(cells.withColumn("ok", F.lit(True)), dims, "climate_model_code", MODELS, value, "ok", "area", number=False)
    return u.withColumn("group_id", group_key("GRP", *dims))


def every_group_pair(u):
    return cp.group_pairs(u.select("group_id", "map_code", "management_code", "period_code", "ssp_code").distinct())


def group_pair_units(spark, d, value="value"):
    u = group_units(spark, d, value)
    return cp.group_pair_units(every_group_pair(u), u)


@query("group_pairs", f"{GROUPS} SELECT * FROM gp")
def group_pairs(spark, d):
    return every_group_pair(group_units(spark, d))


@query("group_metric_difference", f"""{GROUPS}, n AS (SELECT comparison_kind, group_a, group_b, sqrt(area) area, list_avg(va) ma, list_avg(vb) mb, list_stddev_pop(va) sa, list_stddev_pop(vb) sb,
   list_aggregate(va, 'quantile_cont', .75) - list_aggregate(va, 'quantile_cont', .25) ia, list_aggregate(vb, 'quantile_cont', .75) - list_aggregate(vb, 'quantile_cont', .25) ib, list_max(va) - list_min(va) ra, list_max(vb) - list_min(vb) rb FROM gu),
 z AS (SELECT comparison_kind, group_a, group_b, area, unnest(['model_mean_difference', 'model_standard_deviation_difference', 'model_iqr_difference', 'model_range_difference', 'model_coefficient_of_variation_difference']) metric,
   unnest([mb - ma, sb - sa, ib - ia, rb - ra, sb / mb - sa / ma]) v FROM n),
 t AS (SELECT {ROUND_ALL} FROM ({summary_sql('z', 'comparison_kind, group_a, group_b, metric', 'v', 'area')}))
 SELECT t.* REPLACE (p.comparison_kind AS comparison_kind, p.group_a AS group_a, p.group_b AS group_b, p.metric AS metric), CASE WHEN t.metric IS NULL THEN 'NO_COMMON_VALID_SUPPORT' ELSE 'OK' END support_status
 FROM (SELECT comparison_kind, group_a, group_b, unnest(['model_mean_difference', 'model_standard_deviation_difference', 'model_iqr_difference', 'model_range_difference', 'model_coefficient_of_variation_difference']) metric FROM gp) p
 LEFT JOIN t ON t.comparison_kind = p.comparison_kind AND t.group_a = p.group_a AND t.group_b = p.group_b AND t.metric = p.metric""")
def group_metric_difference(spark, d):
    every = every_group_pair(group_units(spark, d))
    return rounded(cp.group_metric_difference(group_pair_units(spark, d).withColumn("area", F.sqrt("area")), GKEYS, 4, every=every), SUMMARY)


MODAL = f"""{GROUPS}, cnt AS (SELECT comparison_kind, group_a, group_b, "row", "column", area, side, k, count(*) n FROM (SELECT comparison_kind, group_a, group_b, "row", "column", area, 'a' side, unnest(ka) k FROM gu
   UNION ALL SELECT comparison_kind, group_a, group_b, "row", "column", area, 'b', unnest(kb) FROM gu) GROUP BY ALL),
 top AS (SELECT *, max(n) OVER (PARTITION BY comparison_kind, group_a, group_b, "row", "column", side) m FROM cnt),
 sd AS (SELECT comparison_kind, group_a, group_b, "row", "column", area, side, any_value(m) m, count(*) kinds, CASE WHEN count(*) FILTER (WHERE n = m) = 1 THEN min(k) FILTER (WHERE n = m) END modal FROM top GROUP BY ALL),
 x AS (SELECT a.comparison_kind, a.group_a, a.group_b, a.area, a.modal ma, b.modal mb, a.m ca, b.m cb, a.kinds na, b.kinds nb FROM sd a JOIN sd b USING (comparison_kind, group_a, group_b, "row", "column") WHERE a.side = 'a' AND b.side = 'b')"""


@query("group_modal_comparison", f"""{MODAL}, t AS (SELECT comparison_kind, group_a, group_b, sum(area) common_area, sum(CASE WHEN ma IS NOT NULL AND mb IS NOT NULL THEN area ELSE 0 END) modal_comparable_area,
  sum(CASE WHEN ca = 4 THEN area ELSE 0 END) unanimity_a_area, sum(CASE WHEN cb = 4 THEN area ELSE 0 END) unanimity_b_area, sum(CASE WHEN ca >= 3 THEN area ELSE 0 END) strong_agreement_a_area,
  sum(CASE WHEN cb >= 3 THEN area ELSE 0 END) strong_agreement_b_area, sum(CASE WHEN ma IS NULL OR mb IS NULL THEN area ELSE 0 END) tied_mode_excluded_area FROM x GROUP BY ALL)
 SELECT p.comparison_kind, p.group_a, p.group_b, coalesce(common_area, 0)::DOUBLE common_area, coalesce(modal_comparable_area, 0)::DOUBLE modal_comparable_area, coalesce(unanimity_a_area, 0)::DOUBLE unanimity_a_area, coalesce(unanimity_b_area, 0)::DOUBLE unanimity_b_area,
  coalesce(strong_agreement_a_area, 0)::DOUBLE strong_agreement_a_area, coalesce(strong_agreement_b_area, 0)::DOUBLE strong_agreement_b_area, coalesce(tied_mode_excluded_area, 0)::DOUBLE tied_mode_excluded_area, CASE WHEN common_area IS NULL THEN 'NO_COMMON_VALID_SUPPORT' ELSE 'OK' END support_status
 FROM (SELECT comparison_kind, group_a, group_b FROM gp) p LEFT JOIN t USING (comparison_kind, group_a, group_b)""")
def group_modal_comparison(spark, d):
    every = every_group_pair(group_units(spark, d, "class_code"))
    return cp.group_modal_comparison(group_pair_units(spark, d, "class_code"), GKEYS, 4, every=every)


@query("group_transitions", f"""{MODAL} SELECT comparison_kind, group_a, group_b, 'modal' kind, ma::INT from_code, mb::INT to_code, sum(area) area FROM x WHERE ma IS NOT NULL AND mb IS NOT NULL GROUP BY ALL
  UNION ALL SELECT comparison_kind, group_a, group_b, 'spread', na::INT, nb::INT, sum(area) FROM x GROUP BY ALL""")
def group_transitions(spark, d):
    return cp.group_transitions(group_pair_units(spark, d, "class_code"), GKEYS, 4)


ENS = ["map_code", "period_code", "ssp_code", "management_code", "row", "column"]


@query("ensemble_diagnostic", f"""{GROUPS}, y AS (SELECT s.group_id, sqrt(s.area) area, e.v - list_avg(s.vs) v FROM s JOIN lc e ON e.climate_model_code = 'ENSEMBLE' AND e.map_code = s.map_code AND e.period_code = s.period_code
   AND e.ssp_code = s.ssp_code AND e.management_code = s.management_code AND e."row" = s."row" AND e."column" = s."column"), r AS (SELECT {ROUND_ALL} FROM ({summary_sql('y', 'group_id', 'v', 'area')}))
 SELECT r.* REPLACE (g.group_id AS group_id), CASE WHEN r.group_id IS NULL THEN 'NO_COMMON_VALID_SUPPORT' ELSE 'OK' END support_status FROM gr g LEFT JOIN r ON r.group_id = g.group_id""")
def ensemble_diagnostic(spark, d):
    e = layer_cells(spark, d).where("climate_model_code = 'ENSEMBLE'").select(*ENS, F.col("value").alias("ensemble_value"))
    u = group_units(spark, d).withColumn("area", F.sqrt("area"))
    return rounded(cp.ensemble_diagnostic(u, e, ["group_id"], ENS, 4, categorical=False, every=u), SUMMARY)


@query("ensemble_class_match", f"""{GROUPS}, q AS (SELECT s.group_id, s.area, s."row", s."column", unnest(s.ks) k FROM s), c AS (SELECT group_id, "row", "column", area, k, count(*) n FROM q GROUP BY ALL),
 t AS (SELECT *, max(n) OVER (PARTITION BY group_id, "row", "column") m FROM c), o AS (SELECT group_id, "row", "column", area, CASE WHEN count(*) FILTER (WHERE n = m) = 1 THEN min(k) FILTER (WHERE n = m) END modal FROM t GROUP BY ALL),
 w AS (SELECT o.group_id, o.area, o.modal, e.k FROM o JOIN gr g USING (group_id) JOIN lc e ON e.climate_model_code = 'ENSEMBLE' AND e.map_code = g.map_code AND e.period_code = g.period_code AND e.ssp_code = g.ssp_code
   AND e.management_code = g.management_code AND e."row" = o."row" AND e."column" = o."column")
, f AS (SELECT group_id, sum(CASE WHEN modal IS NOT NULL THEN area ELSE 0 END) u, sum(CASE WHEN modal IS NULL THEN area ELSE 0 END) x, sum(CASE WHEN modal = k THEN area ELSE 0 END) m FROM w GROUP BY ALL)
 SELECT g.group_id, coalesce(u, 0)::DOUBLE unique_mode_comparable_area, coalesce(x, 0)::DOUBLE tied_mode_excluded_area, coalesce(m, 0)::DOUBLE matching_area, round(100 * m / nullif(u, 0), 6) matching_percentage, CASE WHEN f.group_id IS NULL THEN 'NO_COMMON_VALID_SUPPORT' ELSE 'OK' END support_status
 FROM gr g LEFT JOIN f ON f.group_id = g.group_id""")
def ensemble_class_match(spark, d):
    e = layer_cells(spark, d).where("climate_model_code = 'ENSEMBLE'").select(*ENS, F.col("class_code").alias("ensemble_value"))
    u = group_units(spark, d, "class_code")
    out = cp.ensemble_diagnostic(u, e, ["group_id"], ENS, 4, categorical=True, every=u)
    return rounded(out, ["matching_percentage"], 6)


SUPPORT_ZONE = 1500.0
SUPPORT = f"""round(100 * c / {SUPPORT_ZONE}, 6) common_valid_percentage, f - c excluded_masked_area, {SUPPORT_ZONE} - f excluded_outside_footprint_area,
 CASE WHEN n = 0 THEN 'NO_COMMON_VALID_SUPPORT' WHEN n < 5 THEN 'FEW_NATIVE_CELLS' ELSE 'OK' END quality_flag, 'OK' status"""


@query("comparison_support", f"""{LC}, va AS (SELECT layer_id, "row", "column", area, v > 20000 ok, map_code, period_code, ssp_code, management_code FROM lc),
 g AS (SELECT map_code, period_code, ssp_code, management_code, list(layer_id) m FROM ly WHERE climate_model_code NOT IN ('AGERA5', 'ENSEMBLE') GROUP BY ALL HAVING count(*) = 4),
 s AS (SELECT comparison_kind, layer_a left_id, layer_b right_id, [layer_a, layer_b] need FROM (SELECT * FROM pm UNION ALL SELECT * FROM ph)
   UNION ALL SELECT CASE WHEN a.period_code = b.period_code THEN 'group_cross_ssp' ELSE 'group_cross_period' END, array_to_string([a.map_code, a.period_code, a.ssp_code, a.management_code], '_'), array_to_string([b.map_code, b.period_code, b.ssp_code, b.management_code], '_'), list_concat(a.m, b.m)
   FROM g a JOIN g b USING (map_code, management_code) WHERE (a.period_code = b.period_code AND a.ssp_code < b.ssp_code) OR (a.ssp_code = b.ssp_code AND a.period_code < b.period_code)
   UNION ALL SELECT 'ensemble', array_to_string([g.map_code, g.period_code, g.ssp_code, g.management_code], '_'), e.layer_id, list_append(g.m, e.layer_id) FROM g JOIN ly e USING (map_code, period_code, ssp_code, management_code) WHERE e.climate_model_code = 'ENSEMBLE'),
 n AS (SELECT comparison_kind, left_id, right_id, len(need) k, unnest(need) layer_id FROM s),
 p AS (SELECT comparison_kind, left_id, right_id, any_value(k) k, "row", "column", any_value(area) area, count(*) present, count(*) FILTER (WHERE ok) valid FROM n JOIN va USING (layer_id) GROUP BY comparison_kind, left_id, right_id, "row", "column"),
 t AS (SELECT comparison_kind, left_id, right_id, coalesce(sum(area) FILTER (WHERE valid = k), 0) c, coalesce(sum(area) FILTER (WHERE present = k), 0) f, count(*) FILTER (WHERE valid = k) n FROM p GROUP BY ALL)
 SELECT comparison_kind, left_id, right_id, c common_valid_area, n analytical_unit_count, {SUPPORT_ZONE}::DOUBLE zone_area, {SUPPORT} FROM t""")
def comparison_support(spark, d):
    """Areas, share, unit count and flag of every pair, group pair and ensemble comparison, from one table of presence bitmaps."""
    cells = layer_cells(spark, d)
    layers = cells.select(*DIMS).distinct()
    names = [r[0] for r in layers.select("layer_id").orderBy("layer_id").collect()]  # the catalogue of layers
    bitmaps = sp.presence_bitmaps(cells, [], "layer_id", names, F.col("value") > 20000, "area")
    dims = ["map_code", "period_code", "ssp_code", "management_code"]
    groups = (layers.where(~F.col("climate_model_code").isin("AGERA5", "ENSEMBLE")).groupBy(*dims).agg(F.collect_list("layer_id").alias("members"))
              .where(F.size("members") == 4).withColumn("group_id", F.concat_ws("_", *dims)))
    pairs = all_pairs(cells).select("comparison_kind", F.col("layer_a").alias("left_id"), F.col("layer_b").alias("right_id"), F.array("layer_a", "layer_b").alias("need"))
    of = lambda side: groups.select(F.col("group_id").alias(f"group_{side}"), F.col("members").alias(f"members_{side}"))
    both = cp.group_pairs(groups).join(of("a"), "group_a").join(of("b"), "group_b").select(
        F.concat(F.lit("group_"), "comparison_kind").alias("comparison_kind"), F.col("group_a").alias("left_id"), F.col("group_b").alias("right_id"), F.concat("members_a", "members_b").alias("need"))
    sixth = groups.join(layers.where("climate_model_code = 'ENSEMBLE'").select(*dims, "layer_id"), dims).select(
        F.lit("ensemble").alias("comparison_kind"), F.col("group_id").alias("left_id"), F.col("layer_id").alias("right_id"), F.array_append("members", F.col("layer_id")).alias("need"))
    subsets = pairs.unionByName(both).unionByName(sixth).withColumn("need", sp.layer_bits(names, F.col("need")))
    one = lambda t: t.withColumn("grid", F.lit("all"))
    return rounded(sp.subset_support(one(bitmaps), ["grid"], one(subsets), SUPPORT_ZONE).drop("grid"), ["common_valid_percentage"], 6)
