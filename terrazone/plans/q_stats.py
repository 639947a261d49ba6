"""Weighted statistics and accounting, over lineitem as a cell table.

Cells: layer = return flag, cell value = extended price, area = quantity, class = line number,
valid = discounted.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats
from .registry import query, rnd, rounded, table

CLASSES = range(1, 8)
SUMMARY = ["min", "max", "mean", "std", "p05", "p25", "median", "p75", "p95"]


def cells(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("layer_id"), F.col("l_linestatus").alias("zone_id"),
        F.col("l_orderkey").alias("row"), F.col("l_linenumber").alias("column"),
        F.col("l_extendedprice").alias("value"), F.col("l_quantity").alias("weight"),
        (F.col("l_discount") > 0).alias("valid"), F.col("l_linenumber").alias("class_code"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


CELLS = """WITH cells AS (SELECT l_returnflag layer_id, l_linestatus zone_id, l_orderkey "row", l_linenumber "column",
  l_extendedprice "value", l_quantity weight, l_discount > 0 valid, l_linenumber class_code, l_discount discount, l_tax tax FROM lineitem)"""


def summary_sql(source: str, keys: str, value: str = "value", weight: str = "weight", digits: int = 4) -> str:
    """SELECT of a weighted summary of ``source`` (a table expression) per ``keys``."""
    q = lambda p, name: f"coalesce(min(x) FILTER (WHERE cum >= {p}), max(x)) {name}"
    return f"""SELECT {keys}, min(x) "min", max(x) "max", round(any_value(mean), {digits}) mean,
  round(sqrt(sum(w*(x-mean)*(x-mean))/sum(w)), {digits}) std, {q(.05, 'p05')}, {q(.25, 'p25')}, {q(.5, 'median')},
  {q(.75, 'p75')}, {q(.95, 'p95')}, CASE WHEN count(*) < 5 THEN 'FEW_NATIVE_CELLS' ELSE 'OK' END quality_flag
FROM (SELECT {keys}, x, w, sum(x*w) OVER g / sum(w) OVER g mean,
   sum(w) OVER (PARTITION BY {keys} ORDER BY x ROWS UNBOUNDED PRECEDING) / sum(w) OVER g cum
   FROM (SELECT {keys}, {value} x, {weight} w FROM {source}) WHERE x IS NOT NULL AND w > 0
   WINDOW g AS (PARTITION BY {keys})) GROUP BY {keys}"""


@query("weighted_summary", f"{CELLS} {summary_sql('cells WHERE valid', 'layer_id')}")
def weighted_summary(spark, d):
    out = stats.weighted_summary(cells(spark, d).where("valid"), ["layer_id"], "value", "weight")
    return rounded(out, ["mean", "std"])


@query("weighted_quantile", f"""{CELLS} SELECT layer_id, zone_id, coalesce(min(x) FILTER (WHERE cum >= .1), max(x)) p10,
  coalesce(min(x) FILTER (WHERE cum >= .5), max(x)) p50, coalesce(min(x) FILTER (WHERE cum >= .9), max(x)) p90
  FROM (SELECT layer_id, zone_id, value x, sum(weight) OVER (PARTITION BY layer_id, zone_id ORDER BY value ROWS UNBOUNDED PRECEDING)
        / sum(weight) OVER (PARTITION BY layer_id, zone_id) cum FROM cells) GROUP BY layer_id, zone_id""")
def weighted_quantile(spark, d):
    return stats.weighted_quantile(cells(spark, d), ["layer_id", "zone_id"], "value", "weight", {"p10": .1, "p50": .5, "p90": .9})


@query("area_accounting", f"""{CELLS}, a AS (SELECT layer_id, round(sum(weight) * 1.1, 2) zone_area, sum(weight) FILTER (WHERE valid) va,
   coalesce(sum(weight) FILTER (WHERE NOT valid), 0) ma, count(*) n, count(*) FILTER (WHERE valid) nv FROM cells GROUP BY layer_id)
  SELECT layer_id, zone_area, va valid_area, ma masked_area, round(zone_area - va - ma, 4) outside_area,
   round(100 * va / zone_area, 6) valid_area_percentage, n intersecting_cell_count, nv valid_cell_count, 'OK' status FROM a""")
def area_accounting(spark, d):
    c = cells(spark, d)
    zones = c.groupBy("layer_id").agg(rnd(F.sum("weight") * 1.1, 2).alias("zone_area"))
    # The zone table has one row per layer; the zone area joins after the cells are aggregated.
    per = c.withColumn("zone_area", F.lit(None).cast("double")).unionByName(
        zones.select("layer_id", "zone_area"), allowMissingColumns=True)
    out = stats.area_accounting(per, ["layer_id"], "weight", "valid", "zone_area")
    return rounded(rounded(out, ["outside_area"]), ["valid_area_percentage"], 6)


@query("class_area", f"""{CELLS}, k AS (SELECT layer_id, class_code, sum(weight) area, count(*) cell_count FROM cells WHERE valid GROUP BY ALL)
  SELECT layer_id, class_code, 'line ' || class_code caption, area, cell_count,
   round(100 * area / sum(area) OVER (PARTITION BY layer_id), 6) percentage_of_valid_area,
   round(100 * area / 1e6, 6) percentage_of_zone, 'OK' status FROM k""")
def class_area(spark, d):
    legend = spark.createDataFrame([(c, f"line {c}") for c in CLASSES], "code int, caption string")
    c = cells(spark, d).where("valid").withColumn("zone_area", F.lit(1e6))
    out = stats.class_area(c, ["layer_id"], "class_code", "weight", legend, "zone_area")
    return rounded(out, ["percentage_of_valid_area", "percentage_of_zone"], 6)


@query("caption_join", """SELECT l_returnflag layer_id, l_linenumber class_code, CASE WHEN l_linenumber < 7 THEN 'line ' || l_linenumber END caption,
  CASE WHEN l_linenumber < 7 THEN 'OK' ELSE 'UNKNOWN_CLASS' END status, count(*) cell_count FROM lineitem GROUP BY ALL""")
def caption_join(spark, d):
    legend = spark.createDataFrame([(c, f"line {c}") for c in range(1, 7)], "code int, caption string")
    out = stats.caption_join(cells(spark, d).select("layer_id", "class_code"), "class_code", legend)
    return out.groupBy("layer_id", "class_code", "caption", "status").agg(F.count("*").alias("cell_count"))


@query("raster_stats_unweighted", """SELECT l_returnflag layer_id, min(l_extendedprice) "min", max(l_extendedprice) "max",
  round(avg(l_extendedprice), 4) mean, round(median(l_extendedprice), 4) median, round(stddev_pop(l_extendedprice), 4) std,
  count(*) valid_count FROM lineitem WHERE l_discount > 0 GROUP BY ALL""")
def raster_stats_unweighted(spark, d):
    out = stats.raster_stats_unweighted(cells(spark, d).where("valid"), ["layer_id"], "value")
    return rounded(out, ["mean", "median", "std"])


@query("class_histogram", """WITH k AS (SELECT l_returnflag layer_id, l_linenumber c, count(*) n FROM lineitem GROUP BY ALL)
  SELECT layer_id, string_agg(c || ':' || n, ',' ORDER BY c) observed_classes, first(c ORDER BY n DESC, c) dominant_class FROM k GROUP BY layer_id""")
def class_histogram(spark, d):
    out = stats.class_histogram(cells(spark, d), ["layer_id"], "class_code")
    text = F.array_join(F.transform(F.map_entries("observed_classes"), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ",")
    return out.withColumn("observed_classes", text)


@query("pooled_domain", f"""{CELLS}, d AS (SELECT zone_id, class_code, min(value) lo, max(value) hi FROM cells WHERE valid GROUP BY ALL)
  SELECT zone_id, class_code, lo domain_min, hi domain_max, lo = hi constant, CASE WHEN lo = hi THEN lo - .5 ELSE lo END display_min,
   CASE WHEN lo = hi THEN hi + .5 ELSE hi END display_max FROM d""")
def pooled_domain(spark, d):
    return stats.pooled_domain(cells(spark, d).where("valid"), ["zone_id", "class_code"], "value")


@query("observed_classes", """WITH o AS (SELECT DISTINCT l_returnflag layer_id, CASE WHEN l_quantity > 49 AND l_discount > .09 THEN l_linenumber END c FROM lineitem),
  g AS (SELECT layer_id, class_code::INT class_code FROM (SELECT DISTINCT layer_id FROM o), range(1, 10) r(class_code))
  SELECT g.layer_id, g.class_code, o.c IS NOT NULL present FROM g LEFT JOIN o ON o.layer_id = g.layer_id AND o.c = g.class_code""")
def observed_classes(spark, d):
    c = cells(spark, d).withColumn("class_code", F.expr("CASE WHEN weight > 49 AND discount > 0.09 THEN class_code END"))
    return stats.observed_classes(c, "layer_id", "class_code", list(range(1, 10)))


@query("range_gate", f"""{CELLS} SELECT layer_id, zone_id, count(*) FILTER (WHERE valid AND (value < 1000 OR value > CASE zone_id WHEN 'F' THEN 104000 END)) out_of_range_count,
  CASE WHEN count(*) FILTER (WHERE valid AND (value < 1000 OR value > CASE zone_id WHEN 'F' THEN 104000 END)) > 0 THEN 'QA_FAILED' ELSE 'OK' END status
  FROM cells GROUP BY ALL""")
def range_gate(spark, d):
    hi = F.when(F.col("zone_id") == "F", F.lit(104000.0))   # an open upper bound elsewhere
    return stats.range_gate(cells(spark, d), ["layer_id", "zone_id"], "value", "valid", F.lit(1000.0), hi)


@query("value_rule", f"""{CELLS}, r AS (SELECT layer_id || '_' || zone_id layer_id, CASE layer_id WHEN 'A' THEN 'class_1_9' WHEN 'N' THEN 'share' ELSE 'class' END rule,
   CASE layer_id WHEN 'A' THEN class_code WHEN 'N' THEN discount * 1000 + 1 ELSE weight END v, valid FROM cells)
  SELECT layer_id, rule, count(v) valid_count, bool_and(CASE rule WHEN 'class_1_9' THEN v = floor(v) AND v BETWEEN 1 AND 9 WHEN 'share' THEN v BETWEEN 0 AND 100 ELSE v = floor(v) END) value_rule_passed,
   CASE WHEN bool_and(CASE rule WHEN 'class_1_9' THEN v = floor(v) AND v BETWEEN 1 AND 9 WHEN 'share' THEN v BETWEEN 0 AND 100 ELSE v = floor(v) END) THEN 'VERIFIED' ELSE 'FAILED_VALUE_RULE' END status
  FROM r WHERE valid GROUP BY ALL""")
def value_rule(spark, d):
    layer = F.col("layer_id")
    c = cells(spark, d).where("valid").select(
        F.concat_ws("_", "layer_id", "zone_id").alias("layer_id"),
        F.when(layer == "A", "class_1_9").when(layer == "N", "share").otherwise("class").alias("rule"),
        F.when(layer == "A", F.col("class_code").cast("double")).when(layer == "N", F.col("discount") * 1000 + 1).otherwise(F.col("weight")).alias("v"))
    return stats.value_rule(c, ["layer_id", "rule"], "v", "rule")


@query("decode_cells", """SELECT l_returnflag layer_id, count(*) cell_count, count(*) FILTER (WHERE ok) valid_cell_count, round(sum(v) FILTER (WHERE ok), 2) value_sum,
  round(min(v) FILTER (WHERE ok), 4) value_min FROM (SELECT l_returnflag, l_discount > 0 AND l_quantity <> 7 AND l_tax <> .03 ok,
   CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE l_quantity * 2 + 5 END v FROM lineitem) GROUP BY ALL""")
def decode_cells(spark, d):
    c = cells(spark, d).withColumnsRenamed({"valid": "mask", "value": "price"})
    nodata = F.when(F.col("tax") == 0.03, F.col("weight"))
    out = stats.decode_cells(c, "weight", "mask", "weight", F.lit(2.0), F.lit(5.0), nodata=F.lit(7.0),
                             intrinsic_nodata=nodata, already_scaled=F.col("layer_id") == "N")
    return out.groupBy("layer_id").agg(F.count("*").alias("cell_count"), F.count_if("valid").alias("valid_cell_count"),
                                       rnd(F.sum("value"), 2).alias("value_sum"), rnd(F.min("value")).alias("value_min"))


@query("reject_negative", """SELECT c_mktsegment segment, count(*) FILTER (WHERE c_acctbal < 0) rejected_count, count(*) FILTER (WHERE c_acctbal >= 0) kept_count,
  round(avg(c_acctbal) FILTER (WHERE c_acctbal >= 0), 4) mean FROM customer GROUP BY ALL""")
def reject_negative(spark, d):
    out = stats.reject_negative(table(spark, d, "customer"), "c_acctbal")
    return out.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count_if("rejected").alias("rejected_count"), F.count("c_acctbal").alias("kept_count"), rnd(F.avg("c_acctbal")).alias("mean"))


@query("qa_band_filter", """SELECT l_returnflag layer_id, count(*) cell_count, count(*) FILTER (WHERE l_tax <= .04) kept_count,
  round(sum(l_extendedprice) FILTER (WHERE l_tax <= .04), 2) kept_sum FROM lineitem GROUP BY ALL""")
def qa_band_filter(spark, d):
    out = stats.qa_band_filter(cells(spark, d), "value", "tax", F.lit(0.04))
    return out.groupBy("layer_id").agg(F.count("*").alias("cell_count"), F.count("value").alias("kept_count"),
                                       rnd(F.sum("value"), 2).alias("kept_sum"))


@query("extracted_counts", """WITH l AS (SELECT l_suppkey source_id, l_linenumber || l_returnflag layer_id, CASE WHEN bool_or(l_discount > .09) THEN 'EXTRACTED' ELSE 'EMPTY' END status,
   min(l_shipdate) a, max(l_shipdate) b FROM lineitem GROUP BY 1, 2)
  SELECT source_id, count(*) FILTER (WHERE status = 'EXTRACTED') extracted_layer_count, count(*) layer_count,
   strftime(min(a) FILTER (WHERE status = 'EXTRACTED'), '%Y-%m-%d') first_observation, strftime(max(b) FILTER (WHERE status = 'EXTRACTED'), '%Y-%m-%d') last_observation,
   count(*) FILTER (WHERE status = 'EXTRACTED') > 0 has_data FROM l GROUP BY 1""")
def extracted_counts(spark, d):
    layers = table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").alias("source_id"), F.concat(F.col("l_linenumber").cast("string"), "l_returnflag").alias("layer_id")).agg(
        F.when(F.bool_or(F.col("l_discount") > 0.09), "EXTRACTED").otherwise("EMPTY").alias("status"),
        F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    out = stats.extracted_counts(layers, "source_id", "status", "a", "b")
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_observation", "last_observation")})
