"""Source decisions, over customer as the source inventory, part as the layer catalogue, lineitem as assets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as ru
from .registry import query, rnd, rounded, table

ACCESS = ["AUTOMATED_OPEN", "ACCESS_RESTRICTED", "AUTOMATED_AUTHENTICATION_REQUIRED", "MANUAL_DOWNLOAD_AVAILABLE", "MANUAL_INSPECTION_REQUIRED", "VERIFICATION_FAILED", "UNAVAILABLE"]
COVER = ["FULL_COVERAGE", "PARTIAL_COVERAGE", "NO_COVERAGE", "COVERAGE_UNKNOWN"]
VALID = ["VALID_DATA", "VALID_RECORDS", "NO_VALID_DATA", "INVALID_RANGE", "VERIFICATION_FAILED", "UNKNOWN"]
KIND = ["CATALOGUE_RECORDS", "BBOX_COUNTS", "RENDERED_MAP", "PIXEL_VALUES", "FEATURE_VALUES"]
RELEVANCE = ["CORE", "SUPPORTING", "NOT_RELEVANT", "OPTIONAL"]
GROUPS = ["OWN", "Future climate", "OTHER"]


def pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def pick_sql(values, index):
    return f"[{', '.join(repr(v) for v in values)}][({index}) + 1]"


def inventory(spark, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, d, "customer").select(
        F.concat(F.when(k % 10 == 0, "FUTURE_").when(k % 10 == 1, "OWN_").otherwise("SRC_"), k.cast("string")).alias("dataset_id"), k.alias("num"),
        pick(GROUPS, k % 3).alias("source_group"), pick(ACCESS, n % 7).alias("access_status"), pick(COVER, k % 4).alias("AOI_coverage_status"),
        pick(VALID, F.floor(k / 4) % 6).alias("valid_data_status"), pick(RELEVANCE, F.floor(k / 8) % 4).alias("agricultural_relevance"),
        F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("sample_verified"), F.when(k % 11 == 0, "LOCAL_PROJECT_DATA").otherwise("API").alias("access_type"),
        pick(KIND, F.floor(k / 3) % 5).alias("sample_kind"), F.col("c_name").alias("notes"), F.when(k % 2 == 0, F.lit("NONE")).alias("failure_reason"))


INV = f"""WITH inv0 AS (SELECT (CASE c_custkey % 10 WHEN 0 THEN 'FUTURE_' WHEN 1 THEN 'OWN_' ELSE 'SRC_' END) || c_custkey dataset_id, c_custkey num, {pick_sql(GROUPS, 'c_custkey % 3')} source_group,
   {pick_sql(ACCESS, 'c_nationkey % 7')} access_status, {pick_sql(COVER, 'c_custkey % 4')} cover, {pick_sql(VALID, 'c_custkey // 4 % 6')} valid, {pick_sql(RELEVANCE, 'c_custkey // 8 % 4')} relevance,
   CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END sample_verified, CASE WHEN c_custkey % 11 = 0 THEN 'LOCAL_PROJECT_DATA' ELSE 'API' END access_type, {pick_sql(KIND, 'c_custkey // 3 % 5')} sample_kind,
   c_name notes, CASE WHEN c_custkey % 2 = 0 THEN 'NONE' END failure_reason FROM customer),
 inv AS (SELECT *, CASE WHEN relevance = 'NOT_RELEVANT' THEN 'NOT_SUITABLE' WHEN cover = 'NO_COVERAGE' THEN 'NO_COVERAGE'
   WHEN access_status IN ('ACCESS_RESTRICTED', 'AUTOMATED_AUTHENTICATION_REQUIRED') AND valid <> 'VALID_DATA' THEN 'ACCESS_BLOCKED'
   WHEN access_status IN ('MANUAL_DOWNLOAD_AVAILABLE', 'MANUAL_INSPECTION_REQUIRED') OR cover = 'COVERAGE_UNKNOWN' THEN 'NEEDS_MANUAL_REVIEW'
   WHEN valid IN ('VERIFICATION_FAILED', 'NO_VALID_DATA', 'INVALID_RANGE', 'UNKNOWN') THEN 'NEEDS_MANUAL_REVIEW' WHEN sample_verified = false THEN 'NEEDS_MANUAL_REVIEW'
   WHEN relevance = 'CORE' THEN 'USE_NEXT' WHEN relevance = 'SUPPORTING' THEN 'USE_LATER' ELSE 'OPTIONAL' END priority FROM inv0),
 fin AS (SELECT *, CASE WHEN sample_verified AND access_status = 'AUTOMATED_OPEN' THEN ['VERIFIED_INSIDE_AOI', priority] WHEN access_type = 'LOCAL_PROJECT_DATA' AND access_status = 'UNAVAILABLE' THEN ['INPUT_NOT_SUPPLIED', 'SUPPLY_PROJECT_FILE_IF_AVAILABLE']
   WHEN access_status IN ('ACCESS_RESTRICTED', 'AUTOMATED_AUTHENTICATION_REQUIRED') THEN ['AUTHENTICATION_OR_LICENSE_REQUIRED', 'PROVIDE_AUTHORIZED_ACCESS'] WHEN access_status = 'VERIFICATION_FAILED' THEN ['SERVICE_OR_ENDPOINT_FAILED', 'RETRY_OR_CONFIRM_SOURCE_ENDPOINT']
   WHEN cover = 'NO_COVERAGE' THEN ['NO_COVERAGE', 'RETAIN_COVERAGE_EVIDENCE'] WHEN access_status = 'MANUAL_DOWNLOAD_AVAILABLE' THEN ['MANUAL_DOWNLOAD_REQUIRED', 'DOWNLOAD_SOURCE_FILE_THEN_RUN_AOI_TEST']
   WHEN valid = 'NO_VALID_DATA' THEN ['NO_VALID_SAMPLE', 'TEST_ANOTHER_DATE_OR_LOCATION'] WHEN sample_kind IN ('CATALOGUE_RECORDS', 'BBOX_COUNTS', 'RENDERED_MAP') THEN ['METADATA_ONLY', 'RUN_AOI_DATA_SAMPLE']
   ELSE ['AUTOMATED_VERIFICATION_INCONCLUSIVE', 'CONFIRM_SOURCE_ENDPOINT_AND_SAMPLE'] END sa, concat_ws(' | ', notes, failure_reason) evidence FROM inv),
 dis AS (SELECT *, CASE WHEN dataset_id LIKE 'FUTURE\\_%' ESCAPE '\\' OR dataset_id = 'SRC_42' THEN 'DEFERRED' WHEN sa[1] = 'INPUT_NOT_SUPPLIED' THEN 'INPUT_MISSING' WHEN sa[1] IN ('SERVICE_OR_ENDPOINT_FAILED', 'AUTHENTICATION_OR_LICENSE_REQUIRED') THEN 'BLOCKED' ELSE 'CATALOG_ONLY' END disp,
   CASE WHEN dataset_id LIKE 'FUTURE\\_%' ESCAPE '\\' OR dataset_id = 'SRC_42' THEN 'NEEDS_SEPARATE_PLAN' WHEN sa[1] = 'INPUT_NOT_SUPPLIED' THEN 'NO_FILE_SUPPLIED' ELSE evidence END why FROM fin)"""


def prioritised(spark, d):
    return ru.priority_rule(inventory(spark, d))


def decided(spark, d):
    return ru.disposition_rule(ru.strict_status(prioritised(spark, d)), "FUTURE_", ["SRC_42"])


@query("priority_rule", f"{INV} SELECT dataset_id, priority processing_priority FROM inv")
def priority_rule(spark, d):
    return prioritised(spark, d).select("dataset_id", "processing_priority")


@query("strict_status", f"{INV} SELECT dataset_id, sa[1] final_status, sa[2] final_action, evidence final_evidence FROM fin")
def strict_status(spark, d):
    return ru.strict_status(prioritised(spark, d)).select("dataset_id", "final_status", "final_action", "final_evidence")


@query("disposition_rule", f"{INV} SELECT dataset_id, disp disposition, why disposition_reason FROM dis")
def disposition_rule(spark, d):
    return decided(spark, d).select("dataset_id", "disposition", "disposition_reason")


@query("inventory_summary", f"""{INV} SELECT count(*) registered, count(*) FILTER (WHERE sample_verified) verified, count(*) FILTER (WHERE cover = 'FULL_COVERAGE') full_coverage, count(*) FILTER (WHERE cover = 'PARTIAL_COVERAGE') partial_coverage,
  count(*) FILTER (WHERE cover = 'NO_COVERAGE') no_coverage, count(*) FILTER (WHERE priority = 'NEEDS_MANUAL_REVIEW') manual_review, count(*) FILTER (WHERE priority = 'USE_NEXT') use_next FROM inv""")
def inventory_summary(spark, d):
    return ru.inventory_summary(prioritised(spark, d))


@query("status_counts", f"{INV} SELECT sa[1] final_status, count(*) source_count FROM fin GROUP BY 1")
def status_counts(spark, d):
    return decided(spark, d).groupBy("final_status").agg(F.count("*").alias("source_count"))


@query("report_slices", f"""{INV}, s AS (SELECT dataset_id, unnest([CASE WHEN priority = 'USE_NEXT' THEN 'use_next' END, CASE WHEN dataset_id LIKE 'OWN\\_%' ESCAPE '\\' THEN 'own' END, CASE WHEN source_group NOT IN ('OWN', 'Future climate') THEN 'other' END,
   CASE WHEN source_group = 'Future climate' THEN 'future' END, CASE WHEN priority = 'NEEDS_MANUAL_REVIEW' THEN 'manual_review' END, CASE WHEN cover = 'NO_COVERAGE' THEN 'no_coverage' END,
   CASE WHEN access_status IN ('ACCESS_RESTRICTED', 'AUTOMATED_AUTHENTICATION_REQUIRED', 'VERIFICATION_FAILED') THEN 'access_problems' END, CASE WHEN source_group = 'OWN' THEN 'run_own' END,
   CASE WHEN source_group NOT IN ('OWN', 'Future climate') THEN 'run_other' END, 'all']) slice FROM inv) SELECT slice, dataset_id FROM s WHERE slice IS NOT NULL""")
def report_slices(spark, d):
    return ru.report_slices(prioritised(spark, d), "OWN_", "OWN", "Future climate").select("slice", "dataset_id")


@query("normalize_record", f"""SELECT {', '.join(f"'UNKNOWN' {f}" for f in ru.INVENTORY_FIELDS if f not in ('dataset_id', 'source_name', 'variables', 'evidence_json', 'record_count', 'notes'))},
  'D' || p_partkey dataset_id, CASE WHEN p_size % 5 = 0 THEN 'UNKNOWN' ELSE p_brand END source_name, CASE WHEN p_size % 4 = 0 THEN 'UNKNOWN' ELSE p_type || '; ' || p_size END variables,
  '{{"a":"' || p_brand || '","b":"' || p_type || '"}}' evidence_json, p_size::VARCHAR record_count, CASE WHEN p_size % 3 = 0 THEN 'UNKNOWN' ELSE p_name END notes FROM part""")
def normalize_record(spark, d):
    p = table(spark, d, "part").select(
        F.concat(F.lit("D"), F.col("p_partkey").cast("string")).alias("dataset_id"), F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_brand")).alias("source_name"),
        F.when(F.col("p_size") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("p_type", F.col("p_size").cast("string"))).alias("variables"),
        F.create_map(F.lit("b"), "p_type", F.lit("a"), "p_brand").alias("evidence_json"), F.col("p_size").alias("record_count"), F.when(F.col("p_size") % 3 != 0, F.col("p_name")).alias("notes"))
    return ru.normalize_record(p)


@query("scan_registry", """WITH r AS (SELECT CASE WHEN l_quantity = 13 THEN 'UNKNOWN' ELSE l_orderkey || '-' || l_linenumber END dataset_id, CASE WHEN l_returnflag = 'A' THEN 'UNKNOWN' ELSE l_linestatus END source_name FROM lineitem),
 k AS (SELECT dataset_id, count(*) n FROM r GROUP BY 1) SELECT source_name, CASE WHEN dataset_id = 'UNKNOWN' THEN 'MISSING_ID' WHEN n > 1 THEN 'DUPLICATE_ID' ELSE 'OK' END registry_status, count(*) record_count FROM r JOIN k USING (dataset_id) GROUP BY ALL""")
def scan_registry(spark, d):
    r = table(spark, d, "lineitem").select(F.when(F.col("l_quantity") != 13, F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))).alias("dataset_id"),
                                           F.when(F.col("l_returnflag") == "A", "").otherwise(F.col("l_linestatus")).alias("source_name"))
    return ru.registry_gate(r, "dataset_id", ["dataset_id", "source_name"]).groupBy("source_name", "registry_status").agg(F.count("*").alias("record_count"))


@query("bbox_coverage", """WITH b AS (SELECT c_custkey source_id, c_acctbal / 100 x0, c_nationkey - 10.0::DOUBLE y0, c_acctbal / 100 + (c_custkey % 90) - 3 x1, c_nationkey + c_custkey % 17 - 8.0::DOUBLE y1, c_custkey % 13 = 0 bad FROM customer),
 s AS (SELECT source_id, CASE WHEN bad OR x0 > x1 OR y0 > y1 THEN 'COVERAGE_UNKNOWN' WHEN x1 < 13.87 OR x0 > 33.98 OR y1 < 6.57 OR y0 > 9.66 THEN 'NO_COVERAGE' WHEN x0 <= 13.87 AND y0 <= 6.57 AND x1 >= 33.98 AND y1 >= 9.66 THEN 'FULL_COVERAGE' ELSE 'PARTIAL_COVERAGE' END coverage_status FROM b)
 SELECT source_id, coverage_status, CASE coverage_status WHEN 'FULL_COVERAGE' THEN 100.0::DOUBLE WHEN 'NO_COVERAGE' THEN 0.0 END coverage_percentage FROM s""")
def bbox_coverage(spark, d):
    k, x, y = F.col("c_custkey"), F.col("c_acctbal") / 100, F.col("c_nationkey")
    b = table(spark, d, "customer").select(k.alias("source_id"), F.when(k % 13 == 0, "UNKNOWN").otherwise(x.cast("string")).alias("x0"), (y - 10.0).cast("string").alias("y0"),
                                           (x + k % 90 - 3).cast("string").alias("x1"), (y + k % 17 - 8.0).cast("string").alias("y1"))
    return ru.bbox_coverage(b, ["x0", "y0", "x1", "y1"], [F.lit(v) for v in (13.87, 6.57, 33.98, 9.66)]).select("source_id", "coverage_status", "coverage_percentage")


@query("bbox_union_extent", """SELECT c_nationkey source_id, min(c_acctbal) min_x, min(c_custkey)::DOUBLE min_y, max(c_acctbal + c_custkey % 7) max_x, max(c_custkey + 3)::DOUBLE max_y, count(*) record_count,
  (1990 + min(c_custkey % 9))::VARCHAR "start", CASE WHEN bool_or(c_custkey % 211 = 0) THEN 'PRESENT' ELSE (2000 + max(c_custkey % 9))::VARCHAR END "end" FROM customer GROUP BY 1""")
def bbox_union_extent(spark, d):
    k = F.col("c_custkey")
    b = table(spark, d, "customer").select(F.col("c_nationkey").alias("source_id"), F.col("c_acctbal").alias("x0"), k.alias("y0"), (F.col("c_acctbal") + k % 7).alias("x1"), (k + 3).alias("y1"),
                                           (1990 + k % 9).alias("s"), F.when(k % 211 != 0, 2000 + k % 9).alias("e"))
    return ru.bbox_union_extent(b, ["source_id"], ["x0", "y0", "x1", "y1"], "s", "e")


@query("validate_sample", """WITH s AS (SELECT o_custkey source_id, o_orderstatus layer, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE 90000.0 END ELSE o_totalprice END v FROM orders)
 SELECT source_id, layer, count(v) valid_count, CASE WHEN count(v) = 0 THEN 'NO_VALID_DATA' WHEN bool_and(v < 100000 OR v > 400000) THEN 'INVALID_RANGE' ELSE 'VALID_DATA' END valid_data_status FROM s GROUP BY 1, 2""")
def validate_sample(spark, d):
    p = F.col("o_orderpriority")
    value = F.when(p == "1-URGENT", "metadata").when(p == "2-HIGH", F.when(F.col("o_custkey") % 2 == 0, "-999").otherwise("90000.0")).otherwise(F.col("o_totalprice").cast("string"))
    s = table(spark, d, "orders").select(F.col("o_custkey").alias("source_id"), F.col("o_orderstatus").alias("layer"), value.alias("value"), F.lit("-999").alias("nodata"))
    return ru.validate_sample(s, ["source_id", "layer"], "value", "nodata", 100000.0, 400000.0)


@query("decision_override", f"""{INV}, u AS (SELECT dataset_id, num, CASE WHEN num % 4 < 2 THEN 'VERIFIED_INSIDE_AOI' ELSE 'METADATA_ONLY' END s, CASE WHEN num % 3 = 0 THEN 'USE_NEXT' ELSE 'SELECT_LAYER' END a, num % 8 = 0 ok, notes e FROM inv WHERE source_group = 'OWN'),
 g AS (SELECT dataset_id, e || ' | NONE' e, CASE WHEN num = 120 THEN true ELSE ok END ok, CASE WHEN num = 120 THEN 'VERIFIED_INSIDE_AOI' ELSE s END s, CASE WHEN num = 120 THEN 'USE_NEXT' ELSE a END a FROM u),
 h AS (SELECT dataset_id, e, CASE WHEN s = 'VERIFIED_INSIDE_AOI' AND NOT ok THEN 'LAYER_OR_SAMPLE_SELECTION_REQUIRED' ELSE s END s, CASE WHEN (s = 'VERIFIED_INSIDE_AOI' AND NOT ok) OR (a = 'USE_NEXT' AND NOT ok) THEN 'RUN_AOI_DATA_SAMPLE' ELSE a END a FROM g),
 f AS (SELECT fin.dataset_id, coalesce(h.s, 'NOT_APPLICABLE') override_status, coalesce(h.s, sa[1]) final_status, coalesce(h.a, sa[2]) final_action, coalesce(h.e, evidence) final_evidence FROM fin LEFT JOIN h USING (dataset_id))
 SELECT *, CASE WHEN final_action IN ('USE_NEXT', 'USE_LATER') AND final_status <> 'VERIFIED_INSIDE_AOI' THEN 'UNVERIFIED_MARKED_READY' ELSE 'OK' END gate_status FROM f""")
def decision_override(spark, d):
    base = ru.strict_status(prioritised(spark, d))
    k = F.col("num")
    u = inventory(spark, d).where("source_group = 'OWN'").select(
        "dataset_id", F.when(k % 4 < 2, ru.VERIFIED).otherwise("METADATA_ONLY").alias("status"), F.when(k % 3 == 0, "USE_NEXT").otherwise("SELECT_LAYER").alias("action"),
        (k % 8 == 0).alias("confirmed"), F.col("notes").alias("evidence"), F.lit("NONE").alias("failure_reason"))
    out = ru.decision_override(base, u, group_id="FUTURE_120", group_confirmed=F.lit(True))
    return out.select("dataset_id", "override_status", "final_status", "final_action", "final_evidence", "gate_status")


def catalogue(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select(F.concat(F.lit("L"), k.cast("string")).alias("layer_id"), (k % 1000).alias("num"), (F.col("p_size") % 4 == 0).alias("required"), (F.col("p_size") % 9 != 0).alias("enabled"),
                                          (F.col("p_size") % 2 == 0).alias("enable_later"), (F.col("p_size") == 7).alias("supplemental"))


def planned(spark, d):
    ids = inventory(spark, d).select("num", "dataset_id")
    return ru.layer_plan(catalogue(spark, d).join(ids, "num").drop("num"), decided(spark, d))


PLAN = f"""{INV}, cat AS (SELECT 'L' || p_partkey layer_id, p_partkey % 1000 num, p_size % 4 = 0 required, p_size % 9 <> 0 enabled, p_size % 2 = 0 later, p_size = 7 sup FROM part),
 pl AS (SELECT c.*, dataset_id, disp, why, sa, disp <> 'DEFERRED' AND ((sa[1] = 'VERIFIED_INSIDE_AOI' AND (sa[2] = 'USE_NEXT' OR (sa[2] IN ('USE_LATER', 'OPTIONAL') AND later)) AND enabled) OR sup) chosen FROM cat c JOIN dis USING (num)),
 pq AS (SELECT layer_id, dataset_id, required, CASE WHEN chosen THEN CASE WHEN required THEN 'SELECTED_REQUIRED' ELSE 'SELECTED_OPTIONAL' END ELSE disp END state,
   CASE WHEN chosen AND sup THEN 'SUPPLIED_FILE' WHEN chosen THEN 'SELECTED_PRODUCT' ELSE why END reason, CASE WHEN chosen THEN 'PENDING' ELSE 'NOT_REQUESTED' END es FROM pl)"""


@query("layer_plan", f"""{PLAN} SELECT layer_id, dataset_id, state layer_disposition, reason layer_reason, es extraction_status, CASE WHEN required AND state <> 'SELECTED_REQUIRED' THEN 'REQUIRED_LAYER_NOT_ELIGIBLE' ELSE 'OK' END plan_status FROM pq""")
def layer_plan(spark, d):
    return planned(spark, d).select("layer_id", "dataset_id", "layer_disposition", "layer_reason", "extraction_status", "plan_status")


@query("source_inventory", f"""{PLAN}, n AS (SELECT dataset_id, count(*) FILTER (WHERE es = 'PENDING') n, bool_or(es = 'PENDING' AND required) req FROM pq GROUP BY 1)
 SELECT dis.dataset_id, CASE WHEN n > 0 THEN CASE WHEN req THEN 'SELECTED_REQUIRED' ELSE 'SELECTED_OPTIONAL' END ELSE disp END disposition, coalesce(n, 0) selected_layer_count, 0::BIGINT extracted_layer_count,
  CASE WHEN n > 0 THEN 'SEE_LAYER_INVENTORY' ELSE why END reason, sa[2] next_action FROM dis LEFT JOIN n USING (dataset_id)""")
def source_inventory(spark, d):
    return ru.source_inventory(decided(spark, d), planned(spark, d))


@query("defaults_overrides", """SELECT 'L' || p_partkey layer_id, CASE WHEN p_size % 3 = 0 THEN 'c' || p_size ELSE 'monthly' END cadence, CASE WHEN p_size % 3 = 0 AND p_size % 2 = 0 THEN .5::DOUBLE ELSE .9 END minimum_temporal_coverage, 'sum_amount' aggregation FROM part""")
def defaults_overrides(spark, d):
    over = table(spark, d, "part").where("p_size % 3 = 0").select(F.concat(F.lit("L"), F.col("p_partkey").cast("string")).alias("layer_id"), F.concat(F.lit("c"), F.col("p_size").cast("string")).alias("cadence"),
                                                                  F.when(F.col("p_size") % 2 == 0, 0.5).alias("minimum_temporal_coverage"))
    return ru.defaults_overrides(catalogue(spark, d).select("layer_id"), {"cadence": "monthly", "minimum_temporal_coverage": 0.9, "aggregation": "sum_amount"}, over)


@query("evidence_band_pick", """WITH e AS (SELECT user_id source_id, event_id ord, CASE event_id % 3 WHEN 0 THEN event_type ELSE 'b1' END band, CASE WHEN event_id % 4 = 0 THEN 'n/a' ELSE "value"::VARCHAR END v, event_id % 5 = 0 two, json_extract_string(props, '$.k') k FROM events),
 n AS (SELECT *, (v <> 'n/a')::INT + (two)::INT cnt FROM e), f AS (SELECT source_id, arg_min(band, ord) band, arg_min(two, ord) two, arg_min(cnt, ord) cnt, arg_min(v, ord) v FROM n WHERE cnt > 0 GROUP BY 1),
 l AS (SELECT DISTINCT user_id source_id, event_type variable FROM events), j AS (SELECT l.*, f.band, f.two, f.cnt, f.v, f.source_id IS NULL nof FROM l LEFT JOIN f USING (source_id)),
 r AS (SELECT source_id || '/' || variable layer_id, source_id, variable product_variable, CASE WHEN nof THEN 'NO_VERIFIED_SAMPLE' WHEN band = variable THEN 'DECLARED_BAND' WHEN cnt = 1 THEN 'SINGLE_NUMERIC_BAND' ELSE 'AMBIGUOUS_BANDS' END band_status, CASE WHEN v <> 'n/a' THEN band ELSE 'second' END one FROM j)
 SELECT layer_id, source_id, product_variable, CASE band_status WHEN 'DECLARED_BAND' THEN product_variable WHEN 'SINGLE_NUMERIC_BAND' THEN one END variable, band_status, CASE WHEN band_status IN ('DECLARED_BAND', 'SINGLE_NUMERIC_BAND') THEN 'SELECTED' ELSE 'CATALOG_ONLY' END disposition FROM r""")
def evidence_band_pick(spark, d):
    e = table(spark, d, "events")
    band = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("b1")
    value = F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.col("value").cast("string"))
    sample = F.when(F.col("event_id") % 5 == 0, F.create_map(band, value, F.lit("second"), F.get_json_object("props", "$.k"))).otherwise(F.create_map(band, value))
    evidence = e.select(F.col("user_id").alias("source_id"), F.col("event_id").alias("ord"), sample.alias("sample"))
    layers = e.select(F.col("user_id").alias("source_id"), F.col("event_type").alias("variable")).distinct().withColumn("layer_id", F.concat_ws("/", F.col("source_id").cast("string"), "variable"))
    return ru.evidence_band_pick(layers, evidence)


@query("first_valid_candidate", """WITH c AS (SELECT o_custkey source_id, o_orderkey ord, o_orderpriority candidate, CASE WHEN o_totalprice > 300000 THEN o_totalprice END v FROM orders)
 SELECT source_id, count(v) > 0 confirmed, arg_min(candidate, ord) FILTER (WHERE v IS NOT NULL) candidate, arg_min(v, ord) FILTER (WHERE v IS NOT NULL) "value", min(ord) FILTER (WHERE v IS NOT NULL) chosen_order, count(*) candidate_count FROM c GROUP BY 1""")
def first_valid_candidate(spark, d):
    c = table(spark, d, "orders").select(F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("candidate"), F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice")).alias("value"))
    return ru.first_valid_candidate(c, ["source_id"], "ord", "candidate", "value")


LAYER_STATUS = """WITH l AS (SELECT l_suppkey || '/' || l_linenumber layer_id, bool_or(l_discount > .08) ok, min(CASE WHEN l_quantity = 50 AND l_tax = .08 THEN 'read error ' || l_returnflag END) f, min(CASE WHEN l_extendedprice > 104400 THEN 'out of range' END) q FROM lineitem GROUP BY 1),
 s AS (SELECT layer_id, CASE WHEN q IS NOT NULL THEN 'QA_FAILED' WHEN f IS NOT NULL THEN 'FAILED' WHEN ok THEN 'EXTRACTED' ELSE 'EMPTY' END extraction_status, coalesce(q, f) reason FROM l)"""


def layer_status(spark, d):
    c = table(spark, d, "lineitem").withColumn("layer_id", F.concat_ws("/", F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")))
    return ru.extraction_status(c, ["layer_id"], F.col("l_discount") > 0.08, F.when((F.col("l_quantity") == 50) & (F.col("l_tax") == 0.08), F.concat(F.lit("read error "), "l_returnflag")),
                                F.when(F.col("l_extendedprice") > 104400, "out of range"))


@query("extraction_status", f"{LAYER_STATUS} SELECT * FROM s")
def extraction_status(spark, d):
    return layer_status(spark, d)


@query("extraction_counts", f"""{LAYER_STATUS} SELECT count(*) planned_layers, count(*) FILTER (WHERE extraction_status = 'EXTRACTED') available_layers, count(*) FILTER (WHERE extraction_status = 'EMPTY') empty_layers, count(*) FILTER (WHERE extraction_status IN ('FAILED', 'QA_FAILED')) failed_layers FROM s""")
def extraction_counts(spark, d):
    return ru.extraction_counts(layer_status(spark, d))


@query("required_coverage_gate", """WITH l AS (SELECT l_suppkey layer_id, 100.0 * sum(l_quantity) FILTER (WHERE l_discount > 0) / sum(l_quantity) pct FROM lineitem GROUP BY 1)
 SELECT layer_id, round(pct, 6) percentage, CASE WHEN layer_id % 2 = 0 AND pct < 91 THEN 'QA_FAILED' ELSE 'OK' END coverage_gate FROM l""")
def required_coverage_gate(spark, d):
    l = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("layer_id")).agg((100 * F.sum(F.when(F.col("l_discount") > 0, F.col("l_quantity"))) / F.sum("l_quantity")).alias("percentage"))
    return rounded(ru.required_coverage_gate(l, F.col("layer_id") % 2 == 0, "percentage", 91.0), ["percentage"], 6)


@query("quality_flag_merge", """WITH f AS (SELECT o_custkey group_id, list_distinct(list_filter([CASE WHEN count(*) < 5 THEN 'FEW_NATIVE_CELLS' ELSE 'OK' END, CASE WHEN min(o_totalprice) > 100000 THEN 'NO_VALID_DATA' ELSE '' END, CASE WHEN max(o_totalprice) > 499000 THEN 'SUSPECT' END], lambda x: x <> '')) fl,
   sum(CASE WHEN o_totalprice > 150000 THEN 1.0::DOUBLE ELSE 0 END) c, count(*)::DOUBLE z FROM orders GROUP BY 1)
 SELECT group_id, list_aggregate(list_sort(fl), 'string_agg', ',') source_quality_flags, CASE WHEN list_contains(fl, 'SUSPECT') THEN 'SUSPECT' ELSE '' END unknown_flags, CASE WHEN list_contains(fl, 'SUSPECT') THEN 'BLOCKED' WHEN c = 0 THEN 'ZERO_COMMON_VALID_AREA' WHEN list_contains(fl, 'FEW_NATIVE_CELLS') THEN 'FEW_NATIVE_CELLS'
   WHEN c < z * .9999 THEN 'PARTIAL_COMMON_SUPPORT' ELSE 'COMPLETE_VERIFIED' END quality_flag FROM f""")
def quality_flag_merge(spark, d):
    g = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("group_id")).agg(
        F.count("*").cast("double").alias("zone"), F.sum(F.when(F.col("o_totalprice") > 150000, 1.0).otherwise(0.0)).alias("common"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    g = g.withColumn("flags", F.array(F.when(F.col("zone") < 5, "FEW_NATIVE_CELLS").otherwise("OK"), F.when(F.col("lo") > 100000, "NO_VALID_DATA").otherwise(""), F.when(F.col("hi") > 499000, "SUSPECT")))
    out = ru.quality_flag_merge(g, "flags", ["OK", "FEW_NATIVE_CELLS", "NO_VALID_DATA", "NO_COMMON_VALID_SUPPORT"], "common", "zone")
    return out.select("group_id", F.array_join(F.array_sort("source_quality_flags"), ",").alias("source_quality_flags"), F.array_join("unknown_flags", ",").alias("unknown_flags"), "quality_flag")


PERIODS = ["HP0120", "FP2140", "FP4160", "FP6180", "FP8100"]
MANAGEMENTS = ["HRLM", "HILM", "LRLM", "LILM"]
SSP = ["HIST", "SSP126", "SSP370", "SSP585"]
PRODUCTS = ["CLS-A", "IDX-B", "YLD-C"]


def asset_rows(spark, d):
    k, l = F.col("l_orderkey"), F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        (k * 10 + l).alias("asset_num"), pick(PRODUCTS, k % 3).alias("map_code"), pick(PERIODS, l % 5).alias("period_code"), F.when(F.col("l_suppkey") % 6 == 0, "ENSEMBLE").otherwise(F.concat(F.lit("M-"), (F.col("l_suppkey") % 6).cast("string"))).alias("climate_model_code"),
        pick(SSP, F.col("l_partkey") % 4).alias("ssp_code"), pick(MANAGEMENTS, F.col("l_partkey") % 4).alias("management_code"), F.col("l_returnflag").alias("flag"), F.col("l_tax").alias("tax")).distinct()


ASSETS = f"""WITH a AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber asset_num, {pick_sql(PRODUCTS, 'l_orderkey % 3')} map_code, {pick_sql(PERIODS, 'l_linenumber % 5')} period_code, CASE WHEN l_suppkey % 6 = 0 THEN 'ENSEMBLE' ELSE 'M-' || (l_suppkey % 6) END climate_model_code,
   {pick_sql(SSP, 'l_partkey % 4')} ssp_code, {pick_sql(MANAGEMENTS, 'l_partkey % 4')} management_code, l_returnflag flag, l_tax tax FROM lineitem),
 nm AS (SELECT *, 'SET-1.' || map_code || '.' || period_code || '.' || climate_model_code || '.' || ssp_code || '.CRP.' || management_code nm FROM a)"""


def named_assets(spark, d):
    name = F.concat_ws(".", F.lit("SET-1"), "map_code", "period_code", "climate_model_code", "ssp_code", F.lit("CRP"), "management_code")
    return asset_rows(spark, d).withColumn("nm", name)


@query("identity_check", f"""{ASSETS}, s AS (SELECT CASE WHEN flag = 'A' AND tax > .06 THEN 'URL_DIMENSIONS_DIFFER' WHEN period_code LIKE 'FP%' AND management_code NOT IN ('HRLM', 'HILM') THEN 'MANAGEMENT_OUTSIDE_INVENTORY' WHEN map_code = 'IDX-B' AND period_code <> 'HP0120' THEN 'FUTURE_PRODUCT_BLOCKED' ELSE 'OK' END identity_status, map_code FROM nm)
 SELECT map_code, identity_status, count(*) asset_count FROM s GROUP BY ALL""")
def identity_check(spark, d):
    base = "https://example.org/data/"
    a = named_assets(spark, d)
    broken = (F.col("flag") == "A") & (F.col("tax") > 0.06)
    url = lambda suffix: F.concat(F.lit(base), "map_code", F.lit("/"), "nm", F.when(broken, f"x.{suffix}").otherwise(f".{suffix}"))
    out = ru.identity_check(a.withColumns({"tiff_url": url("tif"), "json_url": url("json")}), base, "SET-1", "CRP", {"tiff_url": "tif", "json_url": "json"}, ["HRLM", "HILM"], ["IDX-B"])
    return out.groupBy("map_code", "identity_status").agg(F.count("*").alias("asset_count"))


@query("sidecar_match", f"""{ASSETS} SELECT flag, CASE WHEN flag = 'A' OR (flag = 'N' AND tax > .05) THEN 'FAILED_METADATA_VALIDATION' ELSE 'OK' END sidecar_status, count(*) asset_count FROM nm GROUP BY ALL""")
def sidecar_match(spark, d):
    member = lambda code, v: F.struct(F.lit(code).alias("code"), (v if not isinstance(v, str) else F.col(v)).alias("value"))
    ssp = F.when((F.col("flag") == "N") & (F.col("tax") > 0.05), "OTHER").otherwise(F.col("ssp_code"))
    five = F.array(member("PERIOD", "period_code"), member("CLIM", "climate_model_code"), member("SSP", ssp), member("CROP", F.lit("CRP")), member("WATER", "management_code"))
    a = named_assets(spark, d).withColumn("members", F.when(F.col("flag") == "A", F.slice(five, 1, 4)).otherwise(five))
    out = ru.sidecar_match(a, "members", {"PERIOD": "period_code", "CLIM": "climate_model_code", "SSP": "ssp_code", "WATER": "management_code"}, {"CROP": "CRP"})
    return out.groupBy("flag", "sidecar_status").agg(F.count("*").alias("asset_count"))


@query("parse_asset_name", f"""{ASSETS}, x AS (SELECT asset_num, nm || CASE WHEN flag = 'A' THEN '.tif' WHEN flag = 'N' THEN '.json' ELSE '.txt' END nm FROM nm)
 SELECT map_code, period_code, climate_model_code, ssp_code, management_code, suffix, count(*) asset_count FROM (SELECT regexp_extract(nm, '^SET-1\\.([A-Z0-9-]+)\\.', 1) map_code, split_part(nm, '.', 3) period_code, split_part(nm, '.', 4) climate_model_code, split_part(nm, '.', 5) ssp_code, split_part(nm, '.', 7) management_code, split_part(nm, '.', 8) suffix FROM x WHERE nm NOT LIKE '%.txt') GROUP BY ALL""")
def parse_asset_name(spark, d):
    a = named_assets(spark, d).select(F.concat("nm", F.when(F.col("flag") == "A", ".tif").when(F.col("flag") == "N", ".json").otherwise(".txt")).alias("nm"))
    out = ru.parse_asset_name(a, "nm", "SET-1", "[A-Z0-9-]+", PERIODS, SSP, "CRP", MANAGEMENTS)
    return out.groupBy("map_code", "period_code", "climate_model_code", "ssp_code", "management_code", "suffix").agg(F.count("*").alias("asset_count"))


@query("asset_dimension_derive", f"""{ASSETS}, y AS (SELECT *, 2000 + substr(period_code, 3, 2)::INT a, 2000 + CASE substr(period_code, 5, 2) WHEN '00' THEN 100 ELSE substr(period_code, 5, 2)::INT END b FROM a)
 SELECT map_code, management_code, climate_model_code = 'ENSEMBLE' is_ensemble, a || '-' || b period, a || '-01-01' period_start, b || '-12-31' period_end, CASE map_code WHEN 'CLS-A' THEN 'categorical' ELSE 'continuous' END data_type, CASE map_code WHEN 'IDX-B' THEN 'Index' WHEN 'CLS-A' THEN 'Class' ELSE 'Kg (DW)/ha' END unit,
  CASE map_code WHEN 'CLS-A' THEN 0.0::DOUBLE ELSE -9.0 END nodata, CASE map_code WHEN 'CLS-A' THEN 1.0::DOUBLE ELSE 0.0 END range_low, CASE map_code WHEN 'CLS-A' THEN 9.0::DOUBLE WHEN 'IDX-B' THEN 10000.0 END range_high, CASE map_code WHEN 'CLS-A' THEN 'uint8' WHEN 'IDX-B' THEN 'int16' ELSE 'float32' END expected_dtype,
  CASE map_code WHEN 'IDX-B' THEN round(1.0::DOUBLE / 120, 9) ELSE round(1.0::DOUBLE / 12, 9) END expected_resolution_degrees, CASE map_code WHEN 'IDX-B' THEN 43200 ELSE 4320 END expected_width, CASE map_code WHEN 'IDX-B' THEN 21600 ELSE 2160 END expected_height,
  NOT (map_code = 'IDX-B' AND management_code IN ('HILM', 'LILM')) required, count(*) asset_count FROM y GROUP BY ALL""")
def asset_dimension_derive(spark, d):
    out = ru.asset_dimension_derive(asset_rows(spark, d), ["CLS-A"], ["IDX-B"])
    out = rounded(out, ["expected_resolution_degrees"], 9).withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("period_start", "period_end")})
    keys = [c for c in out.columns if c not in ("asset_num", "period_code", "climate_model_code", "ssp_code", "flag", "tax")]
    return out.groupBy(*keys).agg(F.count("*").alias("asset_count"))


@query("grid_contract", """WITH o AS (SELECT l_suppkey || '/' || l_linenumber layer_id, max(l_quantity) q, min(l_discount) di, max(l_tax) t, count(*) n FROM lineitem GROUP BY 1)
 SELECT layer_id, CASE WHEN n % 50 = 0 THEN 'CRS_OR_BANDS' WHEN n % 7 = 0 THEN 'PIXEL_SIZE' WHEN n % 11 = 0 THEN 'GRID_ORIGIN' WHEN q < 50 THEN 'GRID_DIMENSIONS' WHEN di > 0 THEN 'DATA_TYPE' WHEN t < .08 THEN 'NODATA' WHEN n % 13 = 0 THEN 'SCALE_OFFSET' WHEN n % 3 = 0 THEN 'UNIT' ELSE 'OK' END grid_status FROM o""")
def grid_contract(spark, d):
    o = table(spark, d, "lineitem").groupBy(F.concat_ws("/", F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")).alias("layer_id")).agg(
        F.max("l_quantity").alias("q"), F.min("l_discount").alias("di"), F.max("l_tax").alias("t"), F.count("*").alias("n"))
    n = F.col("n")
    expected = o.select("layer_id", F.lit("EPSG:4326").alias("crs"), F.lit(1 / 12).alias("dx"), F.lit(1 / 12).alias("dy"), F.lit(-180.0).alias("x0"), F.lit(90.0).alias("y0"), F.lit(50.0).alias("width"), F.lit(2160).alias("height"),
                        F.lit("uint8").alias("dtype"), F.lit(-9.0).alias("nodata"), F.lit(1.0).alias("scale"), F.lit(0.0).alias("offset"), F.lit("Class").alias("unit"))
    seen = o.select("layer_id", F.lit("EPSG:4326").alias("crs"), F.when(n % 7 == 0, 0.1).otherwise(1 / 12 + 1e-12).alias("dx"), F.lit(1 / 12).alias("dy"), F.lit(0.0).alias("rotation"), F.when(n % 11 == 0, -179.0).otherwise(-180.0).alias("x0"), F.lit(90.0).alias("y0"),
                    F.col("q").alias("width"), F.lit(2160).alias("height"), F.when(F.col("di") > 0, "int16").otherwise("uint8").alias("dtype"), F.when(F.col("t") < 0.08, 0.0).when(n % 2 == 0, -9.0).alias("nodata"),
                    F.when(n % 13 == 0, 2.0).otherwise(1.0).alias("scale"), F.lit(0.0).alias("offset"), F.when(n % 3 == 0, "share").otherwise("CLASS").alias("unit"), F.when(n % 50 == 0, 3).otherwise(1).alias("bands"))
    return ru.grid_contract(seen, expected).select("layer_id", "grid_status")


@query("flatten_assets", """WITH o AS (SELECT o_orderkey, 'S' || o_custkey dataset_id, o_orderpriority p, o_custkey % 4 n1, o_orderkey % 3 n2, o_totalprice > 400000 has FROM orders),
 r AS (SELECT dataset_id, 'historical_assets' list, i ord, CASE WHEN i % 2 = 0 THEN p ELSE '' END input_code, NULL code FROM o, range(1, 4) t(i) WHERE i <= n1 UNION ALL SELECT dataset_id, 'assets', i, '', CASE WHEN i = 2 THEN 'c' || o_orderkey END FROM o, range(1, 3) t(i) WHERE i <= n2),
 k AS (SELECT list, dataset_id || '__' || coalesce(nullif(input_code, ''), code, ord::VARCHAR) asset_key FROM r UNION ALL SELECT NULL, dataset_id FROM o WHERE has) SELECT list, asset_key, count(*) asset_count FROM k GROUP BY ALL""")
def flatten_assets(spark, d):
    i32 = lambda n: F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))
    first = F.transform(i32(F.col("o_custkey") % 4), lambda i: F.struct(F.when(i % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("input_code"), F.lit(None).cast("string").alias("code")))
    second = F.transform(i32(F.col("o_orderkey") % 3), lambda i: F.struct(F.lit("").alias("input_code"), F.when(i == 2, F.concat(F.lit("c"), F.col("o_orderkey").cast("string"))).alias("code")))
    src = table(spark, d, "orders").select(F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("dataset_id"), F.when(F.col("o_totalprice") > 400000, "u").alias("url"),
                                           first.alias("historical_assets"), second.alias("assets"))
    out = ru.flatten_assets(src, ["historical_assets", "assets"], ["input_code", "code"])
    return out.groupBy("list", "asset_key").agg(F.count("*").alias("asset_count"))


SERIES = {"cadence": "monthly", "minimum_temporal_coverage": 0.9}


@query("complete_plan", f"""{PLAN}, x AS (SELECT 'L' || p_partkey layer_id, p_partkey % 40 source_id, p_brand variable, p_size % 3 = 0 ask, CASE WHEN p_size % 2 = 0 THEN 'ee_series' ELSE 'static' END adapter,
   TIMESTAMP '2001-03-01' + to_days(p_size::INT) s, TIMESTAMP '2002-01-01' + to_days(p_size::INT) e, CASE WHEN p_partkey % 5 = 0 THEN '16day' END oc FROM part),
 ev AS (SELECT user_id % 40 source_id, event_id ord, CASE WHEN user_id % 3 = 0 THEN (SELECT min(p_brand) FROM part) ELSE 'b1' END band, "value"::VARCHAR v, user_id % 4 = 0 two FROM events WHERE user_id % 40 < 30),
 f AS (SELECT source_id, arg_min(band, ord) band, arg_min(two, ord) two FROM ev WHERE v IS NOT NULL GROUP BY 1),
 j AS (SELECT pq.*, x.source_id, variable, ask, adapter, s, e, oc, CASE WHEN NOT ask THEN NULL WHEN f.source_id IS NULL THEN 'NO_VERIFIED_SAMPLE' WHEN f.band = variable THEN 'DECLARED_BAND' WHEN NOT two THEN 'SINGLE_NUMERIC_BAND' ELSE 'AMBIGUOUS_BANDS' END bs, f.band
   FROM pq JOIN x USING (layer_id) LEFT JOIN f ON ask AND x.source_id = f.source_id),
 k AS (SELECT *, ask AND bs IN ('NO_VERIFIED_SAMPLE', 'AMBIGUOUS_BANDS') miss FROM j), m AS (SELECT *, CASE WHEN miss THEN 'CATALOG_ONLY' ELSE state END st, CASE WHEN adapter = 'ee_series' THEN coalesce(oc, 'monthly') END cad FROM k)
 SELECT layer_id, st layer_disposition, CASE WHEN miss THEN bs ELSE reason END layer_reason, CASE WHEN miss THEN 'NOT_REQUESTED' ELSE es END extraction_status, bs band_status,
  CASE WHEN bs = 'SINGLE_NUMERIC_BAND' THEN band ELSE variable END variable, CASE WHEN bs = 'SINGLE_NUMERIC_BAND' THEN variable END product_variable,
  CASE WHEN required AND st <> 'SELECTED_REQUIRED' THEN 'REQUIRED_LAYER_NOT_ELIGIBLE' ELSE 'OK' END plan_status, cad cadence, CASE WHEN adapter = 'ee_series' THEN .9::DOUBLE END minimum_temporal_coverage,
  strftime(CASE WHEN adapter = 'ee_series' THEN s END, '%Y-%m-%d') period_start, strftime(CASE WHEN adapter = 'ee_series' THEN e END, '%Y-%m-%d') period_end,
  strftime(CASE WHEN adapter = 'ee_series' THEN CASE WHEN cad = '16day' THEN s - INTERVAL 17 DAY ELSE s END END, '%Y-%m-%d') read_from FROM m""")
def complete_plan(spark, d):
    """Plan rows with bands from evidence, series settings, window and the first day to read."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    more = p.select(F.concat(F.lit("L"), k.cast("string")).alias("layer_id"), (k % 40).alias("source_id"), F.col("p_brand").alias("variable"), (F.col("p_size") % 3 == 0).alias("resolve_from_evidence"),
                    F.when(F.col("p_size") % 2 == 0, "ee_series").otherwise("static").alias("adapter"), F.expr("timestampadd(DAY, p_size, TIMESTAMP '2001-03-01')").alias("start"), F.expr("timestampadd(DAY, p_size, TIMESTAMP '2002-01-01')").alias("end"))
    overrides = p.where("p_partkey % 5 = 0").select(F.concat(F.lit("L"), k.cast("string")).alias("layer_id"), F.lit("16day").alias("cadence"))
    u = F.col("user_id")
    e = table(spark, d, "events").where(u % 40 < 30)
    band = F.when(u % 3 == 0, F.lit(p.agg(F.min("p_brand")).first()[0])).otherwise("b1")
    value = F.col("value").cast("string")
    sample = F.when(u % 4 == 0, F.create_map(band, value, F.lit("second"), F.lit("1"))).otherwise(F.create_map(band, value))
    evidence = e.select((u % 40).alias("source_id"), F.col("event_id").alias("ord"), sample.alias("sample"))
    out = ru.complete_plan(planned(spark, d).join(more, "layer_id"), evidence, SERIES, overrides)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return out.select("layer_id", "layer_disposition", "layer_reason", "extraction_status", "band_status", "variable", "product_variable", "plan_status", "cadence", "minimum_temporal_coverage",
                      day("period_start"), day("period_end"), day("read_from"))
