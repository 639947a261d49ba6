"""Five-model agreement, over orders: unit = customer, model = order priority, value = lowest price,
class = price band, area = nation number + 1, group = market segment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import consensus as cs
from .q_stats import summary_sql
from .registry import query, rnd, rounded, table

MODELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CLASSES = list(range(1, 10))
LABELS = {c: f"band {c}" for c in CLASSES}


def members(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    low = o.groupBy("o_custkey", "o_orderpriority").agg(F.min("o_totalprice").alias("value"))
    return (low.join(c, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_mktsegment").alias("group_id"), F.col("o_custkey").alias("unit_id"),
                    F.col("o_orderpriority").alias("model"), "value",
                    (F.floor(F.col("value") / 62500) + 1).cast("int").alias("class_code"),
                    (F.col("c_nationkey") + 1).cast("double").alias("area")))


def units(spark, d, value="value"):
    wide = cs.unit_values(members(spark, d), ["group_id", "unit_id"], "model", value, MODELS, carry=["area"])
    return wide.where("status = 'COMPLETE'")


MEMBERS = """WITH m AS (SELECT c_mktsegment group_id, o_custkey unit_id, o_orderpriority model, min(o_totalprice) v,
   (floor(min(o_totalprice) / 62500) + 1)::INT k, (any_value(c_nationkey) + 1)::DOUBLE area FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
 full5 AS (SELECT group_id, unit_id FROM m GROUP BY ALL HAVING count(*) = 5), u AS (SELECT m.* FROM m JOIN full5 USING (group_id, unit_id))"""
COUNTS = f"""{MEMBERS}, c AS (SELECT group_id, unit_id, area, k, count(*) n FROM u GROUP BY ALL),
 t AS (SELECT group_id, unit_id, area, max(n) top, count(*) kinds FROM c GROUP BY ALL),
 s AS (SELECT t.group_id, t.unit_id, t.area, t.top, t.kinds, count(*) FILTER (WHERE c.n = t.top) winners, min(c.k) FILTER (WHERE c.n = t.top) first_winner,
   string_agg(c.k::VARCHAR, ',' ORDER BY c.k) FILTER (WHERE c.n = t.top) winner_text, string_agg(c.k || ':' || c.n, ',' ORDER BY c.k) freq
   FROM t JOIN c USING (group_id, unit_id) GROUP BY ALL),
 x AS (SELECT *, CASE WHEN winners = 1 THEN first_winner END modal, CASE WHEN top = 5 THEN '5/5 unanimous' WHEN top = 4 THEN '4/5 strong'
   WHEN top = 3 AND winners = 1 THEN '3/5 majority' ELSE 'Tied / dispersed' END label FROM s)"""
NUMERIC = f"""{MEMBERS}, x AS (SELECT group_id, unit_id, area, avg(v) mean, median(v) med, min(v) lo, max(v) hi, stddev_pop(v) sd,
   quantile_cont(v, .75) - quantile_cont(v, .25) iqr FROM u GROUP BY ALL)"""


@query("unit_values", f"""{MEMBERS.replace('full5 AS', 'a AS (SELECT group_id, unit_id, count(*) n FROM m GROUP BY ALL), full5 AS')}
  SELECT group_id, CASE WHEN n = 5 THEN 'COMPLETE' ELSE 'MISSING_MODEL' END status, n::INT model_count, count(*) unit_count FROM a GROUP BY ALL""")
def unit_values(spark, d):
    wide = cs.unit_values(members(spark, d), ["group_id", "unit_id"], "model", "value", MODELS)
    return wide.groupBy("group_id", "status", "model_count").agg(F.count("*").alias("unit_count"))


@query("model_numeric", f"""{NUMERIC} SELECT group_id, unit_id, round(mean, 4) model_mean, med model_median, lo model_minimum, hi model_maximum,
  round(sd, 4) model_standard_deviation, round(iqr, 4) model_iqr, round(hi - lo, 4) model_range, round(sd / mean, 6) model_coefficient_of_variation,
  'DEFINED' cv_status, 0 zero_model_count, true positive_yield, false valid_zero_yield FROM x""")
def model_numeric(spark, d):
    out = cs.model_numeric(units(spark, d), 5).drop("values", "model_count", "status", "area")
    out = rounded(out, ["model_mean", "model_standard_deviation", "model_iqr", "model_range"])
    return rounded(out, ["model_coefficient_of_variation"], 6)


@query("model_consensus", f"""{COUNTS} SELECT group_id, unit_id, freq class_frequencies, modal modal_class, CASE WHEN winners > 1 THEN winner_text ELSE '' END tied_modal_classes,
  top::INT modal_count, winners = 1 unique_mode, (top = 5)::INT full_agreement, (top >= 4)::INT strong_agreement, (top = 3 AND winners = 1)::INT majority_agreement,
  label agreement_group, kinds::INT unique_class_count, (winners > 1)::INT tie_flag, (top < 3)::INT tied_or_dispersed FROM x""")
def model_consensus(spark, d):
    out = cs.model_consensus(units(spark, d, "class_code"), CLASSES, 5)
    seen = F.filter(F.map_entries("class_frequencies"), lambda e: e["value"] > 0)
    return out.withColumns({
        "class_frequencies": F.array_join(F.transform(seen, lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ","),
        "tied_modal_classes": F.array_join("tied_modal_classes", ",")}).drop("values", "model_count", "status", "area")


@query("class_extremes", f"""{MEMBERS} SELECT group_id, unit_id, 'band ' || min(k) FILTER (WHERE k <> 4) highest_suitability_label,
  'band ' || max(k) FILTER (WHERE k <> 4) lowest_suitability_label, bool_or(k = 4) water_present FROM u GROUP BY ALL""")
def class_extremes(spark, d):
    out = cs.class_extremes(units(spark, d, "class_code"), LABELS, excluded=4)
    return out.select("group_id", "unit_id", "highest_suitability_label", "lowest_suitability_label", "water_present")


@query("class_frequency_dense", f"""{MEMBERS} SELECT f.group_id, f.unit_id, c.class_code::INT class_code, count(u.k)::INT model_count, count(u.k) / 5 model_fraction
  FROM (SELECT group_id, unit_id FROM full5) f CROSS JOIN range(1, 10) c(class_code) LEFT JOIN u ON u.group_id = f.group_id AND u.unit_id = f.unit_id AND u.k = c.class_code GROUP BY ALL""")
def class_frequency_dense(spark, d):
    return cs.class_frequency_dense(units(spark, d, "class_code"), ["group_id", "unit_id"], CLASSES, 5)


@query("model_class_area", f"""{MEMBERS}, g AS (SELECT group_id, model, sum(area) common FROM u GROUP BY ALL)
  SELECT g.group_id, g.model, c.class_code::INT class_code, coalesce(sum(u.area), 0) area, round(100 * coalesce(sum(u.area), 0) / any_value(common), 6) percentage_of_common_area
  FROM g CROSS JOIN range(1, 10) c(class_code) LEFT JOIN u ON u.group_id = g.group_id AND u.model = g.model AND u.k = c.class_code GROUP BY ALL""")
def model_class_area(spark, d):
    out = cs.model_class_area(units(spark, d, "class_code"), ["group_id"], MODELS, CLASSES, "area")
    return rounded(out, ["percentage_of_common_area"], 6)


@query("model_weighted_summary", f"{MEMBERS} {summary_sql('u', 'group_id, model', 'v', 'area')}")
def model_weighted_summary(spark, d):
    return rounded(cs.model_weighted_summary(units(spark, d), ["group_id"], MODELS, "area"), ["mean", "std"])


@query("pairwise_agreement", f"""{MEMBERS} SELECT a.group_id, a.model model_a, b.model model_b, sum(CASE WHEN a.k = b.k THEN a.area ELSE 0 END) agreement_area,
  sum(a.area) common_area, round(100 * sum(CASE WHEN a.k = b.k THEN a.area ELSE 0 END) / sum(a.area), 6) agreement_percentage
  FROM u a JOIN u b ON a.group_id = b.group_id AND a.unit_id = b.unit_id AND a.model < b.model GROUP BY ALL""")
def pairwise_agreement(spark, d):
    out = cs.pairwise_agreement(units(spark, d, "class_code"), ["group_id"], MODELS, "area")
    return rounded(out, ["agreement_percentage"], 6)


PAIRS = f"""{MEMBERS}, p AS (SELECT a.group_id, a.model model_a, b.model model_b, a.unit_id, a.area, b.v - a.v diff
  FROM u a JOIN u b ON a.group_id = b.group_id AND a.unit_id = b.unit_id AND a.model < b.model)"""


@query("pairwise_difference", f"""{PAIRS} SELECT * REPLACE (round("min", 4) AS "min", round("max", 4) AS "max", round(p05, 4) AS p05, round(p25, 4) AS p25,
  round("median", 4) AS "median", round(p75, 4) AS p75, round(p95, 4) AS p95) FROM ({summary_sql('p', 'group_id, model_a, model_b', 'diff', 'area')})""")
def pairwise_difference(spark, d):
    out = cs.pairwise_difference(units(spark, d), ["group_id"], MODELS, "area")
    return rounded(out, ["min", "max", "mean", "std", "p05", "p25", "median", "p75", "p95"])


@query("unit_differences", f"""{PAIRS} SELECT group_id, unit_id, count(*)::INT pair_count, round(min(diff), 4) smallest, round(max(diff), 4) largest,
  round(max(diff) FILTER (WHERE model_a = '1-URGENT' AND model_b = '5-LOW'), 4) low_minus_urgent FROM p GROUP BY ALL""")
def unit_differences(spark, d):
    out = cs.unit_differences(units(spark, d), MODELS)
    values = F.map_values("pairwise_differences")
    return out.select("group_id", "unit_id", F.size(values).alias("pair_count"), rnd(F.array_min(values)).alias("smallest"),
                      rnd(F.array_max(values)).alias("largest"), rnd(F.col("pairwise_differences")["5-LOW minus 1-URGENT"]).alias("low_minus_urgent"))


@query("agreement_area", f"""{COUNTS}, l AS (SELECT DISTINCT group_id FROM x)
  SELECT l.group_id, 'agreement_group' kind, g.label, coalesce(sum(x.area), 0) area FROM l CROSS JOIN (VALUES ('5/5 unanimous'), ('4/5 strong'), ('3/5 majority'), ('Tied / dispersed')) g(label)
    LEFT JOIN x ON x.group_id = l.group_id AND x.label = g.label GROUP BY ALL
  UNION ALL SELECT l.group_id, 'modal_class', c.k::VARCHAR, coalesce(sum(x.area), 0) FROM l CROSS JOIN range(1, 10) c(k) LEFT JOIN x ON x.group_id = l.group_id AND x.modal = c.k GROUP BY ALL
  UNION ALL SELECT l.group_id, 'unanimous_class', c.k::VARCHAR, coalesce(sum(x.area), 0) FROM l CROSS JOIN range(1, 10) c(k) LEFT JOIN x ON x.group_id = l.group_id AND x.modal = c.k AND x.top = 5 GROUP BY ALL
  UNION ALL SELECT group_id, 'tied_mode', 'all', coalesce(sum(area) FILTER (WHERE winners > 1), 0) FROM x GROUP BY ALL""")
def agreement_area(spark, d):
    return cs.agreement_area(cs.model_consensus(units(spark, d, "class_code"), CLASSES, 5), ["group_id"], CLASSES, "area")


@query("metric_spatial_summary", f"""{NUMERIC}, z AS (SELECT group_id, area, unnest(['model_mean', 'model_median', 'model_minimum', 'model_maximum', 'model_standard_deviation',
   'model_iqr', 'model_range', 'model_coefficient_of_variation']) metric, unnest([mean, med, lo, hi, sd, iqr, hi - lo, CASE WHEN mean > 0 THEN sd / mean END]) v FROM x)
  SELECT * REPLACE (round("min", 4) AS "min", round("max", 4) AS "max", round(p05, 4) AS p05, round(p25, 4) AS p25,
  round("median", 4) AS "median", round(p75, 4) AS p75, round(p95, 4) AS p95) FROM ({summary_sql('z', 'group_id, metric', 'v', 'area')})""")
def metric_spatial_summary(spark, d):
    out = cs.metric_spatial_summary(cs.model_numeric(units(spark, d), 5), ["group_id"], cs.NUMERIC_METRICS, "area")
    return rounded(out, ["min", "max", "mean", "std", "p05", "p25", "median", "p75", "p95"])


@query("across_model_means", f"""{MEMBERS}, w AS (SELECT group_id, model, sum(v * area) / sum(area) mean FROM u GROUP BY ALL)
  SELECT group_id, round(avg(mean), 4) model_mean, round(median(mean), 4) model_median, round(min(mean), 4) model_minimum, round(max(mean), 4) model_maximum,
  round(stddev_pop(mean), 4) model_standard_deviation, round(quantile_cont(mean, .75) - quantile_cont(mean, .25), 4) model_iqr, round(max(mean) - min(mean), 4) model_range,
  round(stddev_pop(mean) / avg(mean), 6) model_coefficient_of_variation FROM w GROUP BY ALL HAVING count(*) = 5""")
def across_model_means(spark, d):
    out = cs.across_model_means(cs.model_weighted_summary(units(spark, d), ["group_id"], MODELS, "area"), ["group_id"], MODELS)
    return rounded(rounded(out, cs.NUMERIC_METRICS[:-1]), cs.NUMERIC_METRICS[-1:], 6)
