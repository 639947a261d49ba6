import json

from pyspark.sql import functions as F

from terrazone.operators import audit as au, rules as ru, support as sp, tables as tb
from terrazone.sources import readers as rd, sinks as sk

M = ["m1", "m2", "m3", "m4", "m5"]


def test_key_sets_and_ambiguous_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (9,)], "k int")
    got = {(r["k"], r["violation"]) for r in au.key_set_equal(a, spark.createDataFrame([(1,), (2,), (3,)], "k int"), ["k"]).collect()}
    assert got == {(1, "DUPLICATE"), (9, "UNEXPECTED"), (3, "MISSING")}
    kept, dropped = au.drop_ambiguous_keys(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string"), ["id"])
    assert [tuple(r) for r in kept.collect()] == [(2, "c")] and [tuple(r) for r in dropped.collect()] == [(1, 2)]


def test_one_tampered_row_disables_one_group(spark):
    """48 groups of three units: a changed value, a repeated support row and an unknown rule disable one group each."""
    gids = [f"g{i:02d}" for i in range(48)]
    layers = spark.createDataFrame([(f"{g}_{m}", m, "P", "VERIFIED_INSIDE_AOI") for g in gids for m in M], "layer_id string, climate_model_code string, map_code string, verification_status string")
    unit_rows = [(g, f"u{u}", 10.0, {m: float(u + k) for k, m in enumerate(M)}) for g in gids for u in range(3)]
    ddl = "group_id string, unit_id string, area double, model_values map<string,double>"
    group_rows = [(g, f"s{i}", "P", 5, M, [f"{g}_{m}" for m in M], None, 30.0, 10.0, 60.0, 3) for i, g in enumerate(gids)]
    gddl = "group_id string, scenario string, map_code string, model_count int, model_set array<string>, layer_ids array<string>, positive_rule string, common_valid_area double, masked_area double, outside_area double, unit_count int"
    cells = spark.createDataFrame([(f"{g}_{m}", f"c{u}", True, float(u + k), 10.0) for g in gids for u in range(3) for k, m in enumerate(M)], "layer_id string, cell_id string, valid boolean, value double, intersection_area double")

    def resolved(groups=group_rows, units=unit_rows, extra_support=()):
        g, u = spark.createDataFrame(groups, gddl), spark.createDataFrame(units, ddl)
        support = g.select("group_id", "common_valid_area", "masked_area", "outside_area", "unit_count")
        for gid in extra_support:
            support = support.unionByName(support.where(F.col("group_id") == gid))
        v = au.product_violations(g, support, u, layers, M, 100.0)
        wide = u.select("group_id", "unit_id", "area", F.transform(F.array(*[F.lit(m) for m in M]), lambda m: F.concat_ws("_", F.col("group_id"), m)).alias("layer_ids"),
                        F.transform(F.array(*[F.lit(m) for m in M]), lambda m: F.concat(F.lit("c"), F.substring("unit_id", 2, 9))).alias("source_cell_ids"), F.array(*[F.col("model_values")[m] for m in M]).alias("values"))
        v = v.unionByName(au.reconcile_units(wide, cells, 0.01).select("group_id", F.lit(20).alias("check_ord"), "reason"))
        return {r["group_id"]: (r["status"], r["reason"]) for r in au.contract_resolve(g, v, ["scenario"], "map_code").collect()}

    def disabled(result):
        return {k: v for k, v in result.items() if v[0] != "RESOLVED"}
    assert len(resolved()) == 48 and not disabled(resolved())
    changed = [(g, u, a, {**mv, "m3": mv["m3"] + 1}) if (g, u) == ("g05", "u1") else (g, u, a, mv) for g, u, a, mv in unit_rows]
    assert disabled(resolved(units=changed)) == {"g05": ("SOURCE_CONFLICT", "VALUE_CONFLICT")}
    assert disabled(resolved(extra_support=["g07"])) == {"g07": ("SOURCE_CONFLICT", "Duplicate support key")}
    ruled = [(*r[:6], "median > 0", *r[7:]) if r[0] == "g11" else r for r in group_rows]
    assert set(disabled(resolved(groups=ruled))) == {"g11"}
    clash = [(r[0], "s0", *r[2:]) if r[0] == "g01" else r for r in group_rows]
    assert set(disabled(resolved(groups=clash))) == {"g00", "g01"}


def test_fingerprint_changes_with_spec_and_context(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "layer_id string, v int")
    done = df.select(au.fingerprint(["layer_id", "v"], {"zone": "z"}).alias("fingerprint"))
    assert au.pending_work(df, done, ["v", "layer_id"], {"zone": "z"}).count() == 0
    assert au.pending_work(df, done, ["layer_id", "v"], {"zone": "other"}).count() == 2
    assert au.pending_work(df.withColumn("v", F.lit(3)), done, ["layer_id", "v"], {"zone": "z"}).count() == 2


def test_priority_branches(spark):
    data = [("a", "FULL_COVERAGE", "VALID_DATA", "AUTOMATED_OPEN", "CORE", True), ("b", "FULL_COVERAGE", "VALID_DATA", "AUTOMATED_OPEN", "SUPPORTING", None), ("c", "NO_COVERAGE", "VALID_DATA", "AUTOMATED_OPEN", "CORE", True),
            ("d", "FULL_COVERAGE", None, "ACCESS_RESTRICTED", "CORE", None), ("e", "COVERAGE_UNKNOWN", "VALID_DATA", "AUTOMATED_OPEN", "CORE", True), ("f", "FULL_COVERAGE", "VALID_DATA", "AUTOMATED_OPEN", "CORE", False), ("g", "FULL_COVERAGE", "VALID_DATA", "AUTOMATED_OPEN", "NOT_RELEVANT", True), ("h", None, None, None, None, None)]
    df = spark.createDataFrame(data, "dataset_id string, AOI_coverage_status string, valid_data_status string, access_status string, agricultural_relevance string, sample_verified boolean")
    got = {r["dataset_id"]: r["processing_priority"] for r in ru.priority_rule(df).collect()}
    assert got == {"a": "USE_NEXT", "b": "USE_LATER", "c": "NO_COVERAGE", "d": "ACCESS_BLOCKED", "e": "NEEDS_MANUAL_REVIEW", "f": "NEEDS_MANUAL_REVIEW", "g": "NOT_SUITABLE", "h": "OPTIONAL"}


def test_coverage_and_samples(spark):
    df = spark.createDataFrame([("world", "-180", "-90", "180", "90"), ("part", "13.9", "6.6", "14", "6.7"), ("far", "20", "20", "21", "21"), ("text", "UNKNOWN", None, None, None), ("touch", "13.98", "6.66", "15", "8"), ("unordered", "5", "0", "1", "9")], "id string, a string, b string, c string, d string")
    got = {r["id"]: (r["coverage_status"], r["coverage_percentage"]) for r in ru.bbox_coverage(df, ["a", "b", "c", "d"], [13.87, 6.57, 13.98, 6.66]).collect()}
    assert got == {"world": ("FULL_COVERAGE", 100), "part": ("PARTIAL_COVERAGE", None), "far": ("NO_COVERAGE", 0), "text": ("COVERAGE_UNKNOWN", None), "touch": ("PARTIAL_COVERAGE", None), "unordered": ("COVERAGE_UNKNOWN", None)}
    s = spark.createDataFrame([("n", None), ("n", "-999"), ("n", "NaN"), ("n", "Infinity"), ("n", "metadata"), ("o", "500"), ("v", "0"), ("v", "500")], "id string, v string").withColumn("nd", F.lit("-999"))
    got = {r["id"]: (r["valid_data_status"], r["valid_count"]) for r in ru.validate_sample(s, ["id"], "v", "nd", 0.0, 100.0).collect()}
    assert got == {"n": ("NO_VALID_DATA", 0), "o": ("INVALID_RANGE", 1), "v": ("VALID_DATA", 2)}


def test_csv_round_trip_with_bom_and_huge_cells(spark, tmp_path):
    big = 'He said "yes",\n' * 10_000
    (tmp_path / "e.csv").write_bytes("﻿".encode() + ('id,text\r\n1,"' + big.replace('"', '""') + '"\r\n2,plain\r\n').encode())
    got = rd.scan_csv_evidence(spark, str(tmp_path / "e.csv")).collect()
    assert [r["id"] for r in got] == ["1", "2"] and len(got[0]["text"]) == len(big) and got[0].__fields__[0] == "id"


def test_sinks_clean_numbers_and_refuse_replacement(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan"), [1.0, float("inf")])], "k int, v double, a array<double>")
    sk.sink_json(df, str(tmp_path / "j"))
    text = "".join(p.read_text() for p in (tmp_path / "j").glob("part-*"))
    assert json.loads(text) == {"k": 1, "v": None, "a": [1.0, None]}
    path = str(tmp_path / "t")
    sk.append_table(spark, path, df.select("k"), append=False)
    try:
        sk.append_table(spark, path, df.select("k"), append=False)
        raise AssertionError("an existing table was replaced")
    except Exception as error:
        assert "already exists" in str(error).lower()
    wide = sk.append_table(spark, path, df.select("k", "v"), append=True)
    assert set(wide.columns) == {"k", "v"} and wide.count() == 2


def test_zone_features_are_gated(spark):
    docs = ['{"crs":{"properties":{"name":"EPSG:4326"}},"features":[{"properties":{"id":"a"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,1],[1,0],[0,1],[0,0]]]}}]}', '{"features":[]}',
            '{"features":[{"properties":{"id":"open"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1]]]}}]}']
    df = spark.createDataFrame([(x,) for x in docs], "t string").select(F.from_json("t", rd.FEATURES).alias("d")).select("d.*")
    got = {r["zone_id"]: r["status"] for r in rd.zone_vertices(df, "id", "EPSG:4326").select("zone_id", "status").distinct().collect()}
    assert got == {"a": "OK", None: "EMPTY", "open": "UNCLOSED_RING"}
    from terrazone.operators.geometry import geo_is_simple
    assert geo_is_simple(rd.zone_vertices(df, "id", "EPSG:4326").where("zone_id = 'a'"), ["zone_id"]).first()["is_simple"] is False


def test_pages_do_not_overlap(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "id int, v int")
    pages = [[r["id"] for r in tb.sort_page(df, "v", ["id"], p).collect()] for p in range(3)]
    assert [len(p) for p in pages] == [20, 20, 10] and len({x for p in pages for x in p}) == 50


def test_numbering_is_dense_and_ordered(spark):
    df = spark.createDataFrame([("g", r, c) for r in (3, 1, 2) for c in (5, 4)], "g string, row int, column int")
    got = sp.number_in_group(df, ["g"], "row", ["column"], "n").orderBy("row", "column").collect()
    assert [r["n"] for r in got] == [1, 2, 3, 4, 5, 6]
