"""Readers and sinks: tables are written in a source layout, read back by the reader under test and compared."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..sources import readers as rd, sinks as sk
from .registry import query, rnd, table

#: Records of a JSON list at most.
LIST_ROWS = 2000
BOX = "[[[{x},{y}],[{u},{y}],[{u},{v}],[{x},{v}],[{x},{y}]]]"


@query("scan_csv_evidence", """SELECT doc_id::VARCHAR doc_id, md5(text) text_hash, length(text)::INT text_length, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END lang FROM documents""")
def scan_csv_evidence(spark, d):
    path = sk.work_dir(spark)
    doc = table(spark, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"))
    sk.sink_table(doc, path)
    back = rd.scan_csv_evidence(spark, path)
    return back.select("doc_id", F.md5("text").alias("text_hash"), F.length("text").alias("text_length"), "lang")


@query("scan_csv_blocks", """SELECT doc_id::VARCHAR doc_id, md5(text) text_hash, length(text)::INT text_length, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END lang FROM documents""")
def scan_csv_blocks(spark, d):
    """The same table, its files read in blocks."""
    path = sk.work_dir(spark)
    doc = table(spark, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"))
    sk.sink_table(doc, path)
    back = rd.scan_csv_blocks(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in doc.columns]))
    return back.select("doc_id", F.md5("text").alias("text_hash"), F.length("text").alias("text_length"), "lang")


@query("scan_json_records", "SELECT conv_id, turn, role, md5(text) text_hash FROM conversations")
def scan_json_records(spark, d):
    path = sk.work_dir(spark)
    c = table(spark, d, "conversations")
    # one file per list of at most so many records: rows are numbered inside their partitions, no key holds them together
    number = F.monotonically_increasing_id()
    lists = c.withColumn("part", F.floor(number / LIST_ROWS)).groupBy("part").agg(F.to_json(F.collect_list(F.struct(*c.columns))).alias("value"))
    lists.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return rd.scan_json_records(spark, path, c.schema).select("conv_id", "turn", "role", F.md5("text").alias("text_hash"))


@query("typed_decode", """WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'True' WHEN 2 THEN 'False' WHEN 3 THEN props ELSE ' ' || event_type || ' ' END raw, props FROM events)
 SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'null' WHEN 3 THEN 'json' WHEN 4 THEN 'text' ELSE 'boolean' END kind, CASE raw WHEN 'True' THEN true WHEN 'False' THEN false END flag, nullif(trim(raw), '') as_text, json_extract_string(props, '$.k')::INT k FROM t""")
def typed_decode(spark, d):
    e, k = table(spark, d, "events"), F.col("event_id") % 5
    raw = F.when(k == 0, "").when(k == 1, "True").when(k == 2, "False").when(k == 3, F.col("props")).otherwise(F.concat(F.lit(" "), "event_type", F.lit(" ")))
    t = e.select("event_id", raw.alias("raw"), raw.alias("flag"), raw.alias("as_text"), "props")
    out = rd.typed_decode(t, {"flag": "boolean", "as_text": "text", "props": "k int"})
    return out.select("event_id", rd.decoded_kind("raw").alias("kind"), "flag", "as_text", F.col("props.k").alias("k"))


@query("scan_zone_features", """WITH z AS (SELECT s_suppkey, s_suppkey % 11 = 0 nocrs, s_suppkey % 13 = 0 pt, s_suppkey % 7 = 0 multi FROM supplier),
 v AS (SELECT s_suppkey::VARCHAR zone_id, nocrs, pt, unnest(CASE WHEN pt THEN [NULL] WHEN multi THEN [0, 1] ELSE [0] END) part, s_suppkey k FROM z)
 SELECT zone_id, CASE WHEN nocrs THEN NULL ELSE 'EPSG:4326' END crs, part::INT part, CASE WHEN pt THEN NULL ELSE 0 END ring, CASE WHEN pt THEN NULL ELSE s END::INT seq, CASE WHEN pt THEN NULL WHEN s IN (0, 3) THEN k + 10 * part ELSE k + 2 + 10 * part END::DOUBLE x, CASE WHEN pt THEN NULL WHEN s < 2 THEN k / 2.0 ELSE k / 2.0 + 1 END::DOUBLE y,
  CASE WHEN nocrs THEN 'MISSING_CRS' WHEN pt THEN 'NOT_A_POLYGON' ELSE 'OK' END status FROM v, range(4) r(s) WHERE NOT pt OR s = 0""")
def scan_zone_features(spark, d):
    k = F.col("s_suppkey").cast("double")
    ring = lambda shift: F.format_string("[[[%.1f,%.1f],[%.1f,%.1f],[%.1f,%.1f],[%.1f,%.1f],[%.1f,%.1f]]]", *[c for x, y in (
        (k + shift, k / 2), (k + 2 + shift, k / 2), (k + 2 + shift, k / 2 + 1), (k + shift, k / 2 + 1), (k + shift, k / 2)) for c in (x, y)])
    kind = F.when(k % 13 == 0, "Point").when(k % 7 == 0, "MultiPolygon").otherwise("Polygon")
    coords = F.when(k % 13 == 0, "[1.0,2.0]").when(k % 7 == 0, F.concat(F.lit("["), ring(0.0), F.lit(","), ring(10.0), F.lit("]"))).otherwise(ring(0.0))
    crs = F.when(k % 11 != 0, '"crs":{"properties":{"name":"EPSG:4326"}},').otherwise("")
    doc = F.concat(F.lit('{"type":"FeatureCollection",'), crs, F.lit('"features":[{"type":"Feature","properties":{"id":"'), F.col("s_suppkey").cast("string"), F.lit('"},"geometry":{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}}]}"))
    path = sk.work_dir(spark)
    table(spark, d, "supplier").select(doc.alias("value")).write.text(path)
    return rd.scan_zone_features(spark, path, "id", multi_line=False)


@query("scan_cells", """SELECT vec_id layer_id, (i // 8)::INT "row", (i % 8)::INT "column", embedding[i + 1]::DOUBLE raw FROM embeddings, range(64) r(i)""")
def scan_cells(spark, d):
    return rd.scan_cells(table(spark, d, "embeddings").withColumn("layer_id", F.col("vec_id")), ["layer_id"], "embedding", 8)


@query("scan_power_points", """WITH v AS (SELECT user_id, ts::DATE "day", min("value") mn FROM events GROUP BY 1, 2)
 SELECT user_id::VARCHAR point_id, 'PREC' variable, strftime("day", '%Y-%m-%d') "day", CASE WHEN mn >= 1 THEN mn END "value", CASE WHEN user_id % 4 = 0 THEN 'UNIT_CHANGED' ELSE 'OK' END unit_status FROM v""")
def scan_power_points(spark, d):
    day = F.date_format("ts", "yyyyMMdd")
    daily = table(spark, d, "events").groupBy("user_id", day.alias("k")).agg(F.min("value").alias("v"))
    # Daily values per point are bounded by the calendar, so the nested map is bounded too.
    doc = daily.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("k", F.when(F.col("v") < 1, -999.0).otherwise(F.col("v"))))).alias("m")).select(
        F.col("user_id").cast("string").alias("point_id"), F.struct(F.lit(-999.0).alias("fill_value")).alias("header"),
        F.create_map(F.lit("PREC"), F.struct(F.when(F.col("user_id") % 4 == 0, "in/day").otherwise("mm/day").alias("units"))).alias("parameters"), F.struct(F.create_map(F.lit("PREC"), "m").alias("parameter")).alias("properties"))
    path = sk.work_dir(spark)
    doc.write.json(path)
    out = rd.scan_power_points(rd.scan_json_lines(spark, path, rd.POINT_SERIES), ["mm/day", "mm"])
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("sink_table", """SELECT c_custkey::VARCHAR c_custkey, NULL::VARCHAR extra, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END balance, '["' || c_mktsegment || '","' || c_name || '"]' tags FROM customer""")
def sink_table(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(F.array("c_mktsegment", "c_name").alias("tags"), F.when(k % 8 == 0, F.lit(float("nan"))).when(k % 4 == 0, F.lit(float("inf"))).otherwise(F.col("c_acctbal")).alias("balance"), "c_custkey")
    path = sk.work_dir(spark)
    sk.sink_table(c, path, ["c_custkey", "extra"])
    return rd.scan_csv_evidence(spark, path).withColumn("balance", F.col("balance").cast("double"))


@query("sink_json", """SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN NULL ELSE label END score, len(embedding)::INT size, round(embedding[1]::DOUBLE, 6) first FROM embeddings""")
def sink_json(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.when(F.col("vec_id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("label").cast("double")).alias("score"), F.col("embedding").cast("array<double>").alias("embedding"))
    path = sk.work_dir(spark)
    sk.sink_json(e, path)
    back = rd.scan_json_lines(spark, path, e.schema)
    return back.select("vec_id", F.col("score").cast("int").alias("score"), F.size("embedding").alias("size"), rnd(F.col("embedding")[0], 6).alias("first"))


@query("append_table", """SELECT o_orderkey k, o_totalprice price, NULL::VARCHAR status FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1""")
def append_table(spark, d):
    o, path = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status")), sk.work_dir(spark)
    sk.append_table(spark, path, o.where("k % 2 = 0").drop("status"), append=False)
    return sk.append_table(spark, path, o.where("k % 2 = 1"), append=True).select("k", "price", "status")


@query("split_sink", """SELECT l_returnflag map_code, l_linestatus period_code, count(*) report_count, sum(l_quantity) quantity FROM lineitem GROUP BY ALL""")
def split_sink(spark, d):
    l, path = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("map_code"), F.col("l_linestatus").alias("period_code"), "l_orderkey", "l_quantity"), sk.work_dir(spark)
    sk.split_sink(l, path, ["map_code", "period_code"])
    back = spark.read.schema("l_orderkey bigint, l_quantity double, map_code string, period_code string").json(path)
    return back.groupBy("map_code", "period_code").agg(F.count("*").alias("report_count"), F.sum("l_quantity").alias("quantity"))


@query("explode_references", """SELECT stage, count(*) row_count FROM (SELECT unnest(CASE WHEN p_size % 2 = 0 THEN ['03.' || p_size % 4, p_brand] ELSE [p_brand] END) stage FROM part) GROUP BY 1""")
def explode_references(spark, d):
    refs = F.when(F.col("p_size") % 2 == 0, F.array(F.concat(F.lit("03."), (F.col("p_size") % 4).cast("string")), "p_brand")).otherwise(F.array("p_brand"))
    out = sk.explode_references(table(spark, d, "part").withColumn("refs", refs), "refs", "stage")
    return out.groupBy("stage").agg(F.count("*").alias("row_count"))
