"""Audit and reconciliation, over orders against lineitem and labels against documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import audit as au, consensus as cs
from ..sources.readers import content_manifest
from .q_consensus import CLASSES, COUNTS, MEMBERS, MODELS, NUMERIC, members, units as five_units
from .registry import query, rnd, rounded, table


@query("key_set_equal", """WITH a AS (SELECT l_orderkey k, count(*) n FROM lineitem GROUP BY 1), e AS (SELECT o_orderkey k FROM orders WHERE o_orderstatus <> 'P')
 SELECT e.k, 'MISSING' violation FROM e LEFT JOIN a USING (k) WHERE a.k IS NULL UNION ALL SELECT a.k, 'UNEXPECTED' FROM a LEFT JOIN e USING (k) WHERE e.k IS NULL UNION ALL SELECT k, 'DUPLICATE' FROM a WHERE n > 1""")
def key_set_equal(spark, d):
    a = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))
    return au.key_set_equal(a, table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k")), ["k"])


@query("field_agreement", """WITH l AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN upper(lang) ELSE lang END lang, source, CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 WHEN doc_id % 5 = 1 THEN NULL ELSE n_chars END n_chars FROM documents),
 r AS (SELECT doc_id, lang, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE source END source, n_chars FROM documents WHERE doc_id % 13 <> 0)
 SELECT doc_id, 'lang' field, l.lang left_value, r.lang right_value FROM l JOIN r USING (doc_id) WHERE l.lang <> r.lang UNION ALL SELECT doc_id, 'source', l.source, r.source FROM l JOIN r USING (doc_id) WHERE l.source IS DISTINCT FROM r.source
 UNION ALL SELECT doc_id, 'n_chars', l.n_chars::VARCHAR, r.n_chars::VARCHAR FROM l JOIN r USING (doc_id) WHERE l.n_chars IS NOT NULL AND l.n_chars <> r.n_chars UNION ALL SELECT doc_id, '*', 'present', NULL FROM l WHERE doc_id % 13 = 0""")
def field_agreement(spark, d):
    k, doc = F.col("doc_id"), table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    left = doc.withColumns({"lang": F.when(k % 7 == 0, F.upper("lang")).otherwise(F.col("lang")), "n_chars": F.when(k % 5 == 0, F.col("n_chars") + 1).when(k % 5 != 1, F.col("n_chars"))})
    right = doc.where(k % 13 != 0).withColumn("source", F.when(k % 11 != 0, F.col("source")))
    return au.field_agreement(left, right, ["doc_id"], ["lang", "source"], ["n_chars"])


@query("drop_ambiguous_keys", """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) n, any_value(l_extendedprice) p FROM lineitem GROUP BY 1, 2)
 SELECT l_linenumber, n > 1 ambiguous, count(*) key_count, round(sum(CASE WHEN n = 1 THEN p END), 2) kept_price, sum(n)::BIGINT row_count FROM k GROUP BY ALL""")
def drop_ambiguous_keys(spark, d):
    kept, dropped = au.drop_ambiguous_keys(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey", "l_linenumber"])
    a = kept.groupBy("l_linenumber").agg(F.lit(False).alias("ambiguous"), F.count("*").alias("key_count"), rnd(F.sum("l_extendedprice"), 2).alias("kept_price"), F.count("*").alias("row_count"))
    b = dropped.groupBy("l_linenumber").agg(F.lit(True).alias("ambiguous"), F.count("*").alias("key_count"), F.lit(None).cast("double").alias("kept_price"), F.sum("occurrences").alias("row_count"))
    return a.unionByName(b)


@query("set_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference(spark, d):
    return au.set_difference(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


REC = f"""{MEMBERS}, cell AS (SELECT model layer_id, 'c' || unit_id cell_id, v, unit_id, unit_id % 17 <> 0 OR model <> '3-MEDIUM' valid, area + CASE WHEN unit_id % 29 = 0 AND model = '1-URGENT' THEN -1 ELSE 0 END cell_area FROM m WHERE NOT (unit_id % 23 = 0 AND model = '5-LOW')),
 cc AS (SELECT layer_id, cell_id, count(*) n, any_value(v) v, any_value(valid) valid, any_value(cell_area) cell_area FROM (SELECT * FROM cell UNION ALL SELECT * FROM cell WHERE unit_id % 31 = 0 AND layer_id = '2-HIGH') GROUP BY ALL),
 p AS (SELECT group_id, unit_id, area, model layer_id, 'c' || unit_id cell_id, CASE WHEN unit_id % 19 = 0 AND model = '4-NOT SPECIFIED' THEN v + 1 ELSE v END v FROM u),
 rs AS (SELECT p.*, CASE WHEN c.n IS NULL THEN 'MISSING_SOURCE_CELL' WHEN c.n > 1 THEN 'DUPLICATE_SOURCE_CELL' WHEN NOT c.valid THEN 'SOURCE_CELL_INVALID' WHEN c.v <> p.v THEN 'VALUE_CONFLICT' WHEN p.area > c.cell_area + .1 THEN 'UNIT_EXCEEDS_CELL' END reason FROM p LEFT JOIN cc c USING (layer_id, cell_id))"""


def source_cells(spark, d):
    u, m = F.col("unit_id"), F.col("model")
    c = members(spark, d).where(~((u % 23 == 0) & (m == "5-LOW"))).select(
        m.alias("layer_id"), F.concat(F.lit("c"), u.cast("string")).alias("cell_id"), "value", "unit_id", ((u % 17 != 0) | (m != "3-MEDIUM")).alias("valid"),
        (F.col("area") + F.when((u % 29 == 0) & (m == "1-URGENT"), -1.0).otherwise(0.0)).alias("intersection_area"))
    return c.unionByName(c.where((u % 31 == 0) & (F.col("layer_id") == "2-HIGH"))).drop("unit_id")


def tampered_units(spark, d):
    u = five_units(spark, d)
    wrong = F.transform("values", lambda v, i: F.when((F.col("unit_id") % 19 == 0) & (i == 3), v + 1).otherwise(v))
    ids = F.array(*[F.lit(m) for m in MODELS])
    return u.withColumns({"values": wrong, "layer_ids": ids, "source_cell_ids": F.transform(ids, lambda _: F.concat(F.lit("c"), F.col("unit_id").cast("string")))})


@query("reconcile_units", f"{REC} SELECT group_id, unit_id, layer_id, cell_id, reason FROM rs WHERE reason IS NOT NULL")
def reconcile_units(spark, d):
    return au.reconcile_units(tampered_units(spark, d), source_cells(spark, d), 0.1)


STORED = ["model_mean", "model_range", "model_coefficient_of_variation"]


@query("reconcile_summaries", f"""{NUMERIC} SELECT group_id, unit_id, 'model_mean' metric, round(mean * 1.001, 3) stored, round(mean, 3) recomputed FROM x WHERE unit_id % 37 = 0
  UNION ALL SELECT group_id, unit_id, 'model_coefficient_of_variation', NULL, round(sd / mean, 3) FROM x WHERE unit_id % 41 = 0""")
def reconcile_summaries(spark, d):
    m = cs.model_numeric(five_units(spark, d), 5)
    k = F.col("unit_id")
    stored = m.withColumns({"model_mean": F.when(k % 37 == 0, F.col("model_mean") * 1.001).otherwise(F.col("model_mean")),
                            "model_coefficient_of_variation": F.when(k % 41 != 0, F.col("model_coefficient_of_variation"))})
    return rounded(au.reconcile_summaries(stored, m, ["group_id", "unit_id"], STORED), ["stored", "recomputed"], 3)


@query("contract_resolve", f"""{REC}, ord AS (SELECT unit_id % 400 gid, unit_id, layer_id, reason, CASE reason WHEN 'MISSING_SOURCE_CELL' THEN 1 WHEN 'DUPLICATE_SOURCE_CELL' THEN 2 WHEN 'SOURCE_CELL_INVALID' THEN 3 WHEN 'VALUE_CONFLICT' THEN 4 ELSE 5 END o FROM rs WHERE reason IS NOT NULL),
 f AS (SELECT gid, arg_min(reason, o) reason FROM ord GROUP BY 1), g AS (SELECT DISTINCT unit_id % 400 gid FROM u), h AS (SELECT g.gid, gid % 250 scen, f.reason FROM g LEFT JOIN f USING (gid)),
 c AS (SELECT scen FROM h WHERE reason IS NULL GROUP BY 1 HAVING count(*) > 1), z AS (SELECT h.gid, h.scen, coalesce(h.reason, CASE WHEN c.scen IS NOT NULL THEN 'Duplicate scenario/product' END) reason FROM h LEFT JOIN c USING (scen))
 SELECT 'G' || gid group_id, 'S' || scen scenario, 'yield' product, CASE WHEN reason IS NULL THEN 'RESOLVED' WHEN lower(reason) LIKE '%conflict%' OR reason LIKE '%Duplicate%' THEN 'SOURCE_CONFLICT' ELSE 'MISSING_REQUIRED_METRIC' END status, reason FROM z""")
def contract_resolve(spark, d):
    gid = F.concat(F.lit("G"), (F.col("unit_id") % 400).cast("string"))
    units = tampered_units(spark, d)
    found = au.reconcile_units(units, source_cells(spark, d), 0.1)
    order = {"MISSING_SOURCE_CELL": 1, "DUPLICATE_SOURCE_CELL": 2, "SOURCE_CELL_INVALID": 3, "VALUE_CONFLICT": 4}
    rank = F.coalesce(*[F.when(F.col("reason") == k, F.lit(v)) for k, v in order.items()], F.lit(5))
    v = found.select(gid.alias("group_id"), rank.alias("check_ord"), "reason")
    g = units.select(gid.alias("group_id"), F.concat(F.lit("S"), (F.col("unit_id") % 400 % 250).cast("string")).alias("scenario"), F.lit("yield").alias("product")).distinct()
    return au.contract_resolve(g, v, ["scenario"], "product")


@query("qa_flag_gate", """WITH c AS (SELECT l_suppkey run_id, count(*) > 500 a, max(l_tax) = .08 b, bool_and(l_quantity < 50) c FROM lineitem GROUP BY 1)
 SELECT run_id, unnest(list_filter([CASE WHEN NOT a THEN 'enough_rows' END, CASE WHEN NOT b THEN 'tax' END, CASE WHEN NOT c THEN 'all_sources_verified' END], lambda x: x IS NOT NULL)) check_name, NULL effect FROM c WHERE false
 UNION ALL SELECT run_id, 'enough_rows', 'BLOCKED' FROM c WHERE NOT a UNION ALL SELECT run_id, 'tax', 'BLOCKED' FROM c WHERE NOT b UNION ALL SELECT run_id, 'all_sources_verified', 'GAP' FROM c WHERE NOT c""")
def qa_flag_gate(spark, d):
    c = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("run_id")).agg((F.count("*") > 500).alias("a"), (F.max("l_tax") == 0.08).alias("b"), F.bool_and(F.col("l_quantity") < 50).alias("c"))
    return au.qa_flag_gate(c.withColumn("checks", F.create_map(F.lit("enough_rows"), "a", F.lit("tax"), "b", F.lit("all_sources_verified"), "c")), "run_id", "checks", ["all_sources_verified"])


@query("group_status_gate", """WITH s AS (SELECT o_custkey group_id, count(DISTINCT o_orderpriority) n, count(*) rows FROM orders GROUP BY 1), k AS (SELECT group_id, n, CASE WHEN group_id % 9 = 0 THEN 'PENDING' ELSE 'COMPLETE_ON_COMMON_SUPPORT' END st FROM s WHERE group_id % 14 <> 0)
 SELECT group_id, CASE WHEN group_id % 14 = 0 THEN 'MISSING' WHEN group_id % 15 = 0 THEN 'DUPLICATE' WHEN k.st = 'PENDING' THEN 'INCOMPLETE' WHEN k.n <> 5 THEN 'MODELS_NOT_VERIFIED' ELSE 'OK' END group_gate FROM s LEFT JOIN k USING (group_id)""")
def group_status_gate(spark, d):
    g = F.col("group_id")
    s = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("group_id")).agg(F.count_distinct("o_orderpriority").alias("verified_model_count")).withColumn(
        "status", F.when(g % 9 == 0, "PENDING").otherwise("COMPLETE_ON_COMMON_SUPPORT"))
    some = s.where(g % 14 != 0)
    return au.group_status_gate(s, some.unionByName(some.where(g % 15 == 0)), 5, ["COMPLETE_ON_COMMON_SUPPORT", "NO_COMMON_VALID_SUPPORT"])


@query("verify_manifest", """SELECT url path, CASE WHEN page_id % 10 = 0 THEN 'UNREGISTERED' WHEN page_id % 10 = 1 THEN 'MISSING' WHEN page_id % 10 = 2 THEN 'CHANGED' ELSE 'OK' END file_status FROM (SELECT page_id::VARCHAR url, page_id FROM pages)""")
def verify_manifest(spark, d):
    p, k = table(spark, d, "pages"), F.col("page_id")
    files_ = p.select(k.cast("string").alias("path"), F.sha2("html", 256).alias("sha256"), "page_id")
    return au.verify_manifest(files_.where(k % 10 != 1), files_.where(k % 10 != 0).withColumn("sha256", F.when(k % 10 == 2, F.sha2(F.col("sha256"), 256)).otherwise(F.col("sha256"))))


@query("file_manifest", """SELECT 'documents/' || doc_id || '.txt' path, strlen(coalesce(text, ''))::BIGINT size, sha256(coalesce(text, '')) sha256, 'input' origin, 'OK' status FROM documents""")
def file_manifest(spark, d):
    doc = table(spark, d, "documents")
    return content_manifest(doc, F.concat(F.lit("documents/"), F.col("doc_id").cast("string"), F.lit(".txt")), "text", "input")


@query("pending_work", """SELECT p_partkey layer_id, p_brand, p_size FROM part WHERE p_size % 4 = 0 OR p_partkey % 10 = 3""")
def pending_work(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("layer_id"), "p_brand", "p_size")
    context = {"zone": "abc", "version": "1"}
    finished = p.where("p_size % 4 <> 0").withColumn("p_size", F.when(F.col("layer_id") % 10 == 3, F.col("p_size") + 1).otherwise(F.col("p_size")))
    done = finished.select(au.fingerprint(["layer_id", "p_brand", "p_size"], context).alias("fingerprint"))
    return au.pending_work(p, done, ["layer_id", "p_brand", "p_size"], context).drop("fingerprint")


def layer_outcomes(spark, d):
    return table(spark, d, "lineitem").groupBy(F.concat_ws("/", F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")).alias("layer_id")).agg(
        F.max(F.col("l_suppkey") % 5 == 0).alias("required"), (F.max("l_quantity") > 49).alias("selected"), F.when(F.bool_or(F.col("l_discount") > 0.095), "EXTRACTED").otherwise("EMPTY").alias("extraction_status"),
        F.min("l_returnflag").alias("reason"), F.max("l_tax").alias("tax"))


OUT = """WITH l AS (SELECT l_suppkey || '/' || l_linenumber layer_id, bool_or(l_suppkey % 5 = 0) required, max(l_quantity) > 49 selected, CASE WHEN bool_or(l_discount > .095) THEN 'EXTRACTED' ELSE 'EMPTY' END status, min(l_returnflag) reason, max(l_tax) tax FROM lineitem GROUP BY 1)"""


@query("gap_list", f"{OUT} SELECT layer_id, required, status, reason FROM l WHERE selected AND status <> 'EXTRACTED'")
def gap_list(spark, d):
    return au.gap_list(layer_outcomes(spark, d))


@query("run_outcome", f"""{OUT}, g AS (SELECT count(*) n, count(*) FILTER (WHERE required) r FROM l WHERE selected AND status <> 'EXTRACTED') SELECT n gap_count, r required_gap_count, CASE WHEN r > 0 THEN 'INCOMPLETE' WHEN n > 0 THEN 'COMPLETE_WITH_OPTIONAL_GAPS' ELSE 'COMPLETE' END outcome FROM g""")
def run_outcome(spark, d):
    return au.run_outcome(au.gap_list(layer_outcomes(spark, d)))


@query("check_list", f"""{OUT}, c AS (SELECT count(DISTINCT layer_id) = count(*) a, bool_and(NOT required OR status = 'EXTRACTED') b, max(tax) <= .08 c FROM l)
 SELECT 'unique_layer_ids' check_name, a passed FROM c UNION ALL SELECT 'required_layers_passed', b FROM c UNION ALL SELECT 'tax_in_range', c FROM c UNION ALL SELECT 'all_checks', a AND b AND c FROM c""")
def check_list(spark, d):
    return au.check_list(layer_outcomes(spark, d), {"unique_layer_ids": F.count_distinct("layer_id") == F.count("*"),
                                                    "required_layers_passed": F.bool_and(~F.col("required") | (F.col("extraction_status") == "EXTRACTED")), "tax_in_range": F.max("tax") <= 0.08})


@query("metadata_completeness", """WITH p AS (SELECT p_partkey layer_id, CASE WHEN p_size % 2 = 0 THEN p_brand END brand, CASE WHEN p_size % 3 = 0 THEN p_size END depth FROM part)
 SELECT layer_id, 'brand' field, CASE WHEN brand IS NULL THEN 'NOT_APPLICABLE' ELSE 'RESOLVED' END status FROM p UNION ALL SELECT layer_id, 'depth', CASE WHEN depth IS NULL THEN 'NOT_APPLICABLE' ELSE 'RESOLVED' END FROM p""")
def metadata_completeness(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("layer_id"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("brand"), F.when(F.col("p_size") % 3 == 0, F.col("p_size")).alias("depth"))
    return au.metadata_completeness(p, "layer_id", ["brand", "depth"])


# Product groups: one per (nation, group of units); areas and counts come from the units, and every tenth group is tampered with.
PROD = f"""{MEMBERS}, g AS (SELECT unit_id % 60 gid, sum(area) area, count(*) n FROM (SELECT DISTINCT unit_id, area FROM u) GROUP BY 1),
 h AS (SELECT gid, area, n, CASE WHEN gid % 10 = 1 THEN 4 ELSE 5 END mc, CASE WHEN gid % 10 = 2 THEN 'median > 0' END rule, CASE WHEN gid % 10 = 3 THEN area + 5 ELSE area END common, CASE WHEN gid % 10 = 4 THEN n + 1 ELSE n END units, gid % 10 = 5 ver, gid % 10 = 6 twice, gid % 10 = 7 dup, gid % 10 = 8 lacks FROM g)"""


@query("product_violations", f"""{PROD} SELECT 'G' || gid group_id, r.o check_ord, r.reason FROM h, (VALUES (1, 'Duplicate support key'), (2, 'Expected models not verified'), (3, 'Positive criterion needs a documented adapter'), (7, 'Source verification incomplete'),
   (8, 'Support record missing'), (9, 'Common-support sources conflict'), (10, 'Support area closure failed'), (11, 'Duplicate analytical unit'), (12, 'Unit count conflict'), (14, 'Common-support area closure failed')) r(o, reason)
  WHERE (r.o = 1 AND twice) OR (r.o = 2 AND mc = 4) OR (r.o = 3 AND rule IS NOT NULL) OR (r.o = 7 AND ver) OR (r.o = 8 AND lacks) OR (r.o = 9 AND (common <> area OR units <> n) AND NOT lacks) OR (r.o = 10 AND common <> area) OR (r.o = 11 AND dup) OR (r.o = 12 AND (units <> n OR dup)) OR (r.o = 14 AND common <> area)""")
def product_violations(spark, d):
    u = five_units(spark, d).withColumn("gid", F.col("unit_id") % 60)
    k = F.col("gid") % 10
    name = lambda c: F.concat(F.lit("G"), c.cast("string"))
    base = u.groupBy("gid").agg(F.sum("area").alias("area"), F.count("*").alias("n"))
    zone = 1000000.0
    group = base.select(name(F.col("gid")).alias("group_id"), "gid", F.lit("YLD").alias("map_code"), F.when(k == 1, 4).otherwise(5).alias("model_count"), F.array(*[F.lit(m) for m in MODELS]).alias("model_set"),
                        F.array(*[F.concat_ws("/", name(F.col("gid")), F.lit(m)) for m in MODELS]).alias("layer_ids"), F.when(k == 2, "median > 0").alias("positive_rule"),
                        F.when(k == 3, F.col("area") + 5).otherwise(F.col("area")).alias("common_valid_area"), F.lit(0.0).alias("masked_area"), (zone - F.col("area") + F.when(k == 3, 200.0).otherwise(0.0)).alias("outside_area"),
                        F.when(k == 4, F.col("n") + 1).otherwise(F.col("n")).alias("unit_count"))
    true = base.where(k != 8).select(name(F.col("gid")).alias("group_id"), "gid", F.col("area").alias("common_valid_area"), F.lit(0.0).alias("masked_area"), (zone - F.col("area")).alias("outside_area"), F.col("n").alias("unit_count"))
    support = true.unionByName(true.where(k == 6))
    layers = group.select("gid", "map_code", F.posexplode("layer_ids").alias("pos", "layer_id")).select(
        "layer_id", F.element_at(F.array(*[F.lit(m) for m in MODELS]), F.col("pos") + 1).alias("climate_model_code"), "map_code",
        F.when((k == 5) & (F.col("pos") == 2), "FAILED").otherwise("VERIFIED_INSIDE_AOI").alias("verification_status"))
    mapped = u.select(name(F.col("gid")).alias("group_id"), "gid", F.col("unit_id").cast("string").alias("unit_id"), F.when(k == 3, F.col("area") - 200.0).otherwise(F.col("area")).alias("area"), cs.value_map("values", MODELS).alias("model_values"))
    units = mapped.unionByName(mapped.where(k == 7))
    return au.product_violations(group, support, units, layers, MODELS, zone)


@query("finite_assert", """SELECT event_id, 'score' field FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, 'flag' FROM events""")
def finite_assert(spark, d):
    k = F.col("event_id") % 3
    e = table(spark, d, "events").select("event_id", "value", F.when(k == 0, F.col("value")).when(k == 1, F.lit(float("nan"))).alias("score"), (k == 0).alias("flag"))
    return au.finite_assert(e, ["event_id"], ["value", "score", "flag"])
