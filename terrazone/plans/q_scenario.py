"""Scenario rows and table views, over five-model customer units (group = market segment and nation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import bin_index, equal_bins
from ..operators import consensus as cs, scenario as sc, tables as tb
from .q_consensus import CLASSES, COUNTS, LABELS, NUMERIC, units as five_units
from .registry import query, rnd, rounded, table


def numeric_units(spark, d):
    return cs.model_numeric(five_units(spark, d), 5)


def class_units(spark, d):
    return cs.model_consensus(five_units(spark, d, "class_code"), CLASSES, 5)


@query("scenario_yield_summary", f"""{NUMERIC}, y AS (SELECT group_id, sum(area) a, count(*) n, sum(area * mean) / sum(area) m, sum(area * (sd / mean)) / sum(area) cv, sum(area * sd) / sum(area) sd, sum(area * iqr) / sum(area) iqr, sum(area * (hi - lo)) / sum(area) rg, min(lo) lo, max(hi) hi FROM x GROUP BY 1)
 SELECT group_id, a common_valid_area, n analytical_unit_count, round(m, 3) whole_mean, a positive_yield_area, round(m, 3) positive_area_mean, 0.0::DOUBLE valid_zero_area, round(cv, 6) inter_model_cv, a cv_valid_area, round(sd, 3) population_sd, round(iqr, 3) iqr,
  round(rg, 3) model_range, lo model_minimum, hi model_maximum, 100.0::DOUBLE positive_yield_percentage, 0.0::DOUBLE valid_zero_percentage, 'DEFINED' positive_area_mean_status, 'OK' partition_status, CASE WHEN lo < 0 THEN 'NEGATIVE_VALUE' ELSE 'OK' END input_status FROM y""")
def scenario_yield_summary(spark, d):
    out = sc.scenario_yield_summary(numeric_units(spark, d), ["group_id"])
    return rounded(rounded(out, ["whole_mean", "positive_area_mean", "population_sd", "iqr", "model_range"], 3), ["inter_model_cv"], 6)


CLASS_SUM = f"""{COUNTS}, ma AS (SELECT group_id, modal, sum(area) a FROM x WHERE modal IS NOT NULL GROUP BY ALL), mx AS (SELECT group_id, max(a) top FROM ma GROUP BY 1),
 dm AS (SELECT ma.group_id, CASE WHEN count(*) FILTER (WHERE abs(a - top) <= 1e-8) = 1 THEN min(modal) FILTER (WHERE abs(a - top) <= 1e-8) END dom, max(top) top FROM ma JOIN mx USING (group_id) GROUP BY 1),
 fl AS (SELECT group_id, sum(area) c, count(*) n, sum(CASE WHEN top = 5 THEN area ELSE 0 END) f5, sum(CASE WHEN top >= 4 THEN area ELSE 0 END) f4, sum(CASE WHEN top = 3 AND winners = 1 THEN area ELSE 0 END) f3, sum(CASE WHEN top < 3 THEN area ELSE 0 END) ft, sum(CASE WHEN winners > 1 THEN area ELSE 0 END) fe,
   {', '.join(f'sum(CASE WHEN kinds = {n} THEN area ELSE 0 END) u{n}' for n in range(1, 6))} FROM x GROUP BY 1)"""


@query("scenario_class_summary", f"""{CLASS_SUM} SELECT group_id, c common_valid_area, n analytical_unit_count, dom dominant_class, CASE WHEN dom IS NOT NULL THEN top END dominant_class_area, round(CASE WHEN dom IS NOT NULL THEN 100 * top / c END, 6) dominant_class_percentage,
  f5 full_agreement_area, f4 strong_agreement_area, f3 majority_agreement_area, ft tied_or_dispersed_area, fe tie_flag_area, round(100 * f5 / c, 6) full_agreement_percentage, round(100 * f4 / c, 6) strong_agreement_percentage, round(100 * f3 / c, 6) majority_agreement_percentage,
  round(100 * ft / c, 6) tied_or_dispersed_percentage, round(100 * fe / c, 6) tie_flag_percentage, {', '.join(f'u{n} unique_class_count_{n}_area' for n in range(1, 6))}, 'OK' input_status FROM fl JOIN dm USING (group_id)""")
def scenario_class_summary(spark, d):
    out = sc.scenario_class_summary(class_units(spark, d), ["group_id"], CLASSES)
    return rounded(out, [c for c in out.columns if c.endswith("percentage")], 6)


@query("stacked_shares", f"""{CLASS_SUM} SELECT group_id, 'all_agree' share, round(100 * f5 / c, 6) percentage FROM fl UNION ALL SELECT group_id, 'exactly_four', round(100 * f4 / c - 100 * f5 / c, 6) FROM fl
  UNION ALL SELECT group_id, 'exactly_three', round(100 * f3 / c, 6) FROM fl UNION ALL SELECT group_id, 'split', round(100 * ft / c, 6) FROM fl""")
def stacked_shares(spark, d):
    return rounded(sc.stacked_shares(sc.scenario_class_summary(class_units(spark, d), ["group_id"], CLASSES), ["group_id"]), ["percentage"], 6)


@query("support_gate", f"""{NUMERIC}, g AS (SELECT group_id, sum(CASE WHEN unit_id % 97 = 5 THEN 0 ELSE area END) ua, min(CASE WHEN unit_id % 97 = 5 THEN 0 ELSE area END) lo, sum(area) c, CASE group_id WHEN 'BUILDING' THEN 100.0::DOUBLE ELSE 5000 END z FROM x GROUP BY 1)
 SELECT group_id, ua unit_area, c common, z zone, CASE WHEN c > z * 1.0001 THEN 'INVALID_DENOMINATOR' WHEN lo <= 0 OR abs(ua - c) > z * .0001 THEN 'AREA_CLOSURE_FAILED' ELSE 'OK' END support_status FROM g""")
def support_gate(spark, d):
    u = five_units(spark, d)
    common = u.groupBy("group_id").agg(F.sum("area").alias("common"))
    u = u.join(common, "group_id").withColumns({"area": F.when(F.col("unit_id") % 97 == 5, 0.0).otherwise(F.col("area")), "zone": F.when(F.col("group_id") == "BUILDING", 100.0).otherwise(5000.0)})
    return sc.support_gate(u, ["group_id"], "area", "common", "zone")


def scenarios(spark, d):
    """One row per (crop = segment, period = year, ssp = status, management = order parity)."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_mktsegment").alias("crop"), F.year("o_orderdate").cast("string").alias("period"), F.col("o_orderstatus").alias("ssp"), F.when(F.col("o_orderkey") % 2 == 0, "HRLM").otherwise("HILM").alias("management")).agg(
        F.max("o_totalprice").alias("top_value"), F.count("*").alias("order_count"), F.min("o_totalprice").alias("low_value"))


SC = """WITH s AS (SELECT c_mktsegment crop, year(o_orderdate)::VARCHAR period, o_orderstatus ssp, CASE WHEN o_orderkey % 2 = 0 THEN 'HRLM' ELSE 'HILM' END management, max(o_totalprice) top_value, count(*) order_count, min(o_totalprice) low_value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4)"""
DIMS = ["crop", "period", "ssp", "management"]


@query("sort_scenarios", f"{SC} SELECT crop, period, ssp, management, top_value FROM s")
def sort_scenarios(spark, d):
    return sc.sort_scenarios(scenarios(spark, d), DIMS).select(*DIMS, "top_value")


@query("period_line_up", f"""{SC}, k AS (SELECT DISTINCT crop, ssp, management FROM s WHERE period IN ('1995', '1999', '2001')) SELECT k.crop, k.ssp, k.management, p.period, s.crop IS NOT NULL available, s.top_value, s.order_count
  FROM k CROSS JOIN (VALUES ('1995'), ('1999'), ('2001'), ('2050')) p(period) LEFT JOIN s ON s.crop = k.crop AND s.ssp = k.ssp AND s.management = k.management AND s.period = p.period""")
def period_line_up(spark, d):
    s = scenarios(spark, d)
    return sc.period_line_up(s, ["crop", "ssp", "management"], "period", ["1995", "1999", "2001", "2050"], ["top_value", "order_count"])


@query("management_side_by_side", f"""{SC} SELECT crop, period, ssp, max(top_value) FILTER (WHERE management = 'HRLM') "HRLM", max(top_value) FILTER (WHERE management = 'HILM') "HILM" FROM s GROUP BY ALL""")
def management_side_by_side(spark, d):
    return sc.management_side_by_side(scenarios(spark, d), ["crop", "period", "ssp"], "management", ["HRLM", "HILM"], "top_value")


@query("follow_up_checks", f"""{SC}, b AS (SELECT crop, period, ssp, management, order_count % 4 <> 0 sv, order_count % 3 <> 0 yv, top_value / 5000 sco, CASE WHEN order_count % 2 = 0 THEN 100.0::DOUBLE ELSE top_value / 4999 END yco, order_count % 5 tied, CASE WHEN low_value < 5000 THEN low_value ELSE 0 END zero FROM s),
 c AS (SELECT crop, period, ssp, management, list_filter([CASE WHEN sv AND yv THEN 'CHECK_LOCALLY' ELSE 'COMPLETE_EVIDENCE' END, CASE WHEN (sv AND sco < 99.99) OR (yv AND yco < 99.99) THEN 'CHECK_UNCOVERED_AREA' WHEN sv AND tied > 0 THEN 'INVESTIGATE_DISAGREEMENT' ELSE 'CHECK_OTHER_FUTURES' END,
   CASE WHEN yv AND zero > 0 THEN 'INVESTIGATE_ZERO_YIELD' END, CASE WHEN management = 'HILM' THEN 'CHECK_IRRIGATION' ELSE 'CHECK_WATER' END], lambda v: v IS NOT NULL) codes FROM b)
 SELECT crop, period, ssp, management, (i - 1)::INT check_order, codes[i] check_code FROM c, range(1, 5) r(i) WHERE codes[i] IS NOT NULL""")
def follow_up_checks(spark, d):
    n = F.col("order_count")
    s = scenarios(spark, d).withColumns({"suitability_valid": n % 4 != 0, "yield_valid": n % 3 != 0, "suitability_coverage": F.col("top_value") / 5000, "yield_coverage": F.when(n % 2 == 0, 100.0).otherwise(F.col("top_value") / 4999),
                                         "tied_or_dispersed_percentage": n % 5, "valid_zero_area": F.when(F.col("low_value") < 5000, F.col("low_value")).otherwise(0.0), "management_code": F.col("management")})
    return sc.follow_up_checks(s, DIMS)


@query("flatten_nested", f"""{SC} SELECT crop, period, ssp, management, top_value yield_mean, order_count yield_units, low_value suitability_share FROM s""")
def flatten_nested(spark, d):
    s = scenarios(spark, d)
    nested = F.struct(F.struct(F.struct(F.col("top_value").alias("mean"), F.col("order_count").alias("units")).alias("summary")).alias("yield"),
                      F.struct(F.struct(F.col("low_value").alias("share")).alias("summary")).alias("suitability"))
    return sc.flatten_nested(s.select(*DIMS, nested.alias("products")))


@query("text_search", """SELECT c_custkey, c_name, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE lower(concat_ws(chr(31), c_name, c_mktsegment, n_name)) LIKE '%nation_1%' AND 'BUILDING' IN (c_name, c_mktsegment, n_name)""")
def text_search(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "c_mktsegment", "n_name")
    return tb.text_search(c, ["c_name", "c_mktsegment", "n_name"], "Nation_1", "BUILDING")


FACETS = ["p_brand", "p_type", "p_name"]


@query("facet_values", """SELECT DISTINCT 'p_brand' facet, p_brand "value" FROM part WHERE p_type = 'SMALL' UNION ALL SELECT DISTINCT 'p_type', p_type FROM part WHERE p_brand = 'Brand#2' UNION ALL SELECT DISTINCT 'p_name', p_name FROM part WHERE p_brand = 'Brand#2' AND p_type = 'SMALL'""")
def facet_values(spark, d):
    return tb.facet_values(table(spark, d, "part"), FACETS, {"p_brand": "Brand#2", "p_type": "SMALL"})


@query("facet_cascade", """SELECT DISTINCT 'p_brand' facet, p_brand "value" FROM part UNION ALL SELECT DISTINCT 'p_type', p_type FROM part WHERE p_brand = 'Brand#2' UNION ALL SELECT DISTINCT 'p_name', p_name FROM part WHERE p_brand = 'Brand#2' AND p_type = 'SMALL'""")
def facet_cascade(spark, d):
    return tb.facet_values(table(spark, d, "part"), FACETS, {"p_brand": "Brand#2", "p_type": "SMALL"}, cascade=True)


@query("sort_page", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 20 OFFSET 40")
def sort_page(spark, d):
    return tb.sort_page(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_acctbal", ["c_custkey"], page=2, descending=True)


@query("head_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def head_limit(spark, d):
    return tb.head_limit(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 100)


@query("union_limitations", """SELECT 'S' || p_size dataset_id, 'L' || p_partkey layer_id, 'source_support' limitation_type, p_name text, 'NOTE' severity FROM part
 UNION ALL SELECT 'S' || s_suppkey, NULL, 'source_disposition', s_name, 'NOTE' FROM supplier UNION ALL SELECT 'R' || r_regionkey, NULL, 'availability', r_name, 'BLOCKED' FROM region""")
def union_limitations(spark, d):
    s = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return tb.union_limitations(table(spark, d, "part").select(s("S", "p_size").alias("dataset_id"), s("L", "p_partkey").alias("layer_id"), F.col("p_name").alias("limitation")),
                                table(spark, d, "supplier").select(s("S", "s_suppkey").alias("dataset_id"), F.col("s_name").alias("reason")),
                                table(spark, d, "region").select(s("R", "r_regionkey").alias("dataset_id"), F.col("r_name").alias("note")))


@query("distinct_texts", "SELECT DISTINCT p_name text FROM part")
def distinct_texts(spark, d):
    return tb.distinct_texts(table(spark, d, "part").select(F.col("p_name").alias("text")), "text")


@query("dedupe_assets", """WITH r AS (SELECT DISTINCT l_partkey object_name, l_suppkey stage, l_linenumber line FROM lineitem) SELECT object_name, count(*) reference_count, (min((stage, line))).stage first_stage, (min((stage, line))).line first_line FROM (SELECT object_name, stage, line FROM r) GROUP BY 1""".replace("(min((stage, line))).stage", "arg_min(stage, (stage, line))").replace("(min((stage, line))).line", "arg_min(line, (stage, line))"))
def dedupe_assets(spark, d):
    r = table(spark, d, "lineitem").select(F.col("l_partkey").alias("object_name"), F.col("l_suppkey").alias("stage"), F.col("l_linenumber").alias("line"))
    return tb.dedupe_assets(r, "object_name", ["stage", "line"])[0]


@query("bin_by_breaks", """SELECT CASE WHEN l_quantity <= 10 THEN 0 WHEN l_quantity <= 20 THEN 1 WHEN l_quantity <= 35 THEN 2 ELSE 3 END bin, least(3, floor((l_quantity - 1) / 49 * 4))::INT equal_bin, count(*) cell_count, min(l_quantity) lo, max(l_quantity) hi FROM lineitem GROUP BY ALL""")
def bin_by_breaks(spark, d):
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").groupBy(bin_index(q, [10, 20, 35]).alias("bin"), equal_bins(q, 1.0, 50.0).alias("equal_bin")).agg(F.count("*").alias("cell_count"), F.min(q).alias("lo"), F.max(q).alias("hi"))
