"""Set equality, agreement, reconciliation and gates. Failures are rows with a reason, never exceptions.

Two-sided comparisons are a union followed by one aggregate per key: keys repeated on both sides are
combined map-side and reported as duplicates, so they cannot multiply in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import close_enough, col, is_finite, join_null_safe, same_or_close
from .rules import decide


def _sides(left: DataFrame, right: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    tag = lambda df, is_left: df.select(*keys, *payload, F.lit(is_left).alias("_left"))
    return tag(left, True).unionByName(tag(right, False))


def key_set_equal(actual: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Violations of "exactly the expected keys, each once": MISSING, UNEXPECTED or DUPLICATE per key."""
    n = _sides(actual, expected, keys, []).groupBy(*keys).agg(F.count_if("_left").alias("_a"), F.count_if(~F.col("_left")).alias("_e"))
    kinds = F.array_compact(F.array(F.when((F.col("_a") == 0), "MISSING"), F.when(F.col("_e") == 0, "UNEXPECTED"), F.when(F.col("_a") > 1, "DUPLICATE")))
    return n.select(*keys, F.explode(kinds).alias("violation"))


def field_agreement(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], scope_fields: list[str] = ()) -> DataFrame:
    """Fields on which two copies of a table differ, one row per (key, field).

    ``scope_fields`` are compared only where the left side has a value. Keys of one side only are reported
    with the field ``*``.
    """
    names = [*fields, *scope_fields]
    as_text = lambda df: df.select(*keys, *[F.col(f).cast("string").alias(f) for f in names])
    side = lambda flag: F.max(F.when(flag, F.struct(*names)))
    g = _sides(as_text(left), as_text(right), keys, names).groupBy(*keys).agg(side(F.col("_left")).alias("_l"), side(~F.col("_left")).alias("_r"))
    differs = lambda f: ~F.col(f"_l.{f}").eqNullSafe(F.col(f"_r.{f}"))
    entry = lambda f, cond: F.when(cond, F.struct(F.lit(f).alias("field"), F.col(f"_l.{f}").alias("left_value"), F.col(f"_r.{f}").alias("right_value")))
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    one_sided = F.when(~both, F.struct(F.lit("*").alias("field"), F.when(F.col("_l").isNotNull(), "present").alias("left_value"), F.when(F.col("_r").isNotNull(), "present").alias("right_value")))
    rows = F.array_compact(F.array(one_sided, *[entry(f, both & differs(f)) for f in fields], *[entry(f, both & F.col(f"_l.{f}").isNotNull() & differs(f)) for f in scope_fields]))
    return g.select(*keys, F.explode(rows).alias("m")).select(*keys, "m.*")


def drop_ambiguous_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is unique, keys that occur more than once with their count).

    Each key keeps one candidate row and a counter, so a heavily repeated key costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(*rest)).alias("_r") if rest else F.lit(None).alias("_r"))
    kept = g.where("_n = 1").select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
    return kept.select(*df.columns), g.where("_n > 1").select(*keys, F.col("_n").alias("occurrences"))


def reconcile_units(units: DataFrame, cells: DataFrame, tolerance_area: float, keys: list[str] = ("group_id", "unit_id"),
                    layer_ids: str = "layer_ids", cell_ids: str = "source_cell_ids", values: str = "values") -> DataFrame:
    """Every (layer, cell, value) of every unit against the source cells: one row per violation.

    ``cells``: layer_id, cell_id, valid, value, intersection_area. A unit may not be larger than any of its cells.
    """
    source = cells.groupBy("layer_id", "cell_id").agg(F.count("*").alias("_n"), F.first(F.struct("valid", "value", "intersection_area")).alias("_c"))
    parts = units.select(*keys, "area", F.explode(F.arrays_zip(F.col(layer_ids).alias("l"), F.col(cell_ids).alias("c"), F.col(values).alias("v"))).alias("z"))
    parts = parts.select(*keys, "area", F.col("z.l").alias("layer_id"), F.col("z.c").alias("cell_id"), F.col("z.v").alias("unit_value"))
    j = parts.join(source, ["layer_id", "cell_id"], "left")
    valid, value = F.col("_c.valid"), F.col("_c.value")
    reason = decide([
        (F.col("_n").isNull(), "MISSING_SOURCE_CELL"), (F.col("_n") > 1, "DUPLICATE_SOURCE_CELL"), (~valid.eqNullSafe(F.lit(True)) | value.isNull(), "SOURCE_CELL_INVALID"),
        (~close_enough(value, "unit_value"), "VALUE_CONFLICT"), (F.col("area") > F.col("_c.intersection_area") + tolerance_area, "UNIT_EXCEEDS_CELL")], F.lit(None).cast("string"))
    return j.withColumn("reason", reason).where("reason IS NOT NULL").select(*keys, "layer_id", "cell_id", "reason")


def reconcile_summaries(stored: DataFrame, recomputed: DataFrame, keys: list[str], metrics: list[str], rel: float = 1e-8, abs_tol: float = 1e-8) -> DataFrame:
    """Stored metrics that differ from the recomputed ones; NULL must meet NULL. Both sides have unique keys."""
    r = recomputed.select(*keys, *[F.col(m).cast("double").alias(f"_{m}") for m in metrics])
    j = join_null_safe(stored.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]), r.withColumn("_hit", F.lit(True)), keys, "left")
    bad = lambda m: F.when(F.col("_hit") & ~same_or_close(m, f"_{m}", rel, abs_tol), F.struct(F.lit(m).alias("metric"), F.col(m).alias("stored"), F.col(f"_{m}").alias("recomputed")))
    missing = F.when(F.col("_hit").isNull(), F.struct(F.lit("*").alias("metric"), F.lit(None).cast("double").alias("stored"), F.lit(None).cast("double").alias("recomputed")))
    return j.select(*keys, F.explode(F.array_compact(F.array(missing, *[bad(m) for m in metrics]))).alias("v")).select(*keys, "v.*")


def contract_resolve(groups: DataFrame, violations: DataFrame, scenario: list[str], product: str) -> DataFrame:
    """Status per product group from ordered violations (group_id, check_ord, reason).

    The first failing check decides; groups sharing a scenario and product disable each other, and each row of a repeated id
    is a duplicate. Other groups stay resolved.
    """
    first = violations.groupBy("group_id").agg(F.min_by("reason", F.struct("check_ord", "reason")).alias("_reason"))
    repeated = groups.groupBy("group_id").agg(F.count("*").alias("_same_id"))
    live = groups.join(first, "group_id", "left").join(repeated, "group_id")
    clash = (live.where("_reason IS NULL AND _same_id = 1").groupBy(*scenario, product).agg(F.count("*").alias("_clash")).where("_clash > 1"))
    j = join_null_safe(live, clash, [*scenario, product], "left")
    reason = decide([(F.col("_same_id") > 1, "Duplicate group_id"), (F.col("_reason").isNotNull(), F.col("_reason")), (F.col("_clash").isNotNull(), "Duplicate scenario/product")], F.lit(None).cast("string"))
    conflict = F.lower("reason").contains("conflict") | F.col("reason").contains("Duplicate")
    return (j.withColumn("reason", reason)
            .withColumn("status", F.when(F.col("reason").isNull(), "RESOLVED").when(conflict, "SOURCE_CONFLICT").otherwise("MISSING_REQUIRED_METRIC"))
            .select("group_id", *scenario, product, "status", "reason"))


def product_violations(groups: DataFrame, support: DataFrame, units: DataFrame, layers: DataFrame, models: list[str], zone_area: float,
                       accepted_rules: list[str] = ("model_mean > 0", "five_model_mean > 0"), tolerance: float = 1e-4) -> DataFrame:
    """Ordered checks of product groups against their support, units and layers: (group_id, check_ord, reason).

    ``groups``: group_id, map_code, model_count, model_set, layer_ids, positive_rule, common_valid_area, masked_area,
    outside_area, unit_count. ``support`` holds the same areas; ``units``: group_id, unit_id, area, model_values
    (map); ``layers``: layer_id, climate_model_code, map_code, verification_status.
    """
    # Every row of a repeated group id is checked; contract_resolve marks each of them as a duplicate.

    def failed(df: DataFrame, checks: list[tuple[int, Column, str]]) -> DataFrame:
        """All failing checks of a row in one pass."""
        found = [F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(o).alias("check_ord"), F.lit(reason).alias("reason"))) for o, cond, reason in checks]
        return df.select("group_id", F.explode(F.array_compact(F.array(*found))).alias("v")).select("group_id", "v.*")
    expected = F.sort_array(F.array(*[F.lit(m) for m in models]))
    s = support.groupBy("group_id").agg(F.count("*").alias("_n"), F.first(F.struct("common_valid_area", "masked_area", "outside_area", "unit_count")).alias("_s"))
    u = units.groupBy("group_id", "unit_id").agg(F.count("*").alias("_k"), F.max(F.size("model_values")).alias("_m"), F.max("area").alias("_a"), F.min("area").alias("_amin"))
    per = u.groupBy("group_id").agg(F.sum("_k").alias("_rows"), F.max("_k").alias("_dup"), F.min("_m").alias("_models"), F.sum("_a").alias("_area"), F.min("_amin").alias("_low"))
    g = groups.join(s, "group_id", "left").join(per, "group_id", "left")
    rule = F.col("positive_rule")
    same = lambda c: close_enough(F.col(c), F.col(f"_s.{c}"))
    total = F.col("common_valid_area") + F.col("masked_area") + F.col("outside_area")
    own = failed(g, [
        (1, F.col("_n") > 1, "Duplicate support key"),
        (2, (F.col("model_count") != len(models)) | ~F.sort_array("model_set").eqNullSafe(expected), "Expected models not verified"),
        (3, rule.isNotNull() & ~rule.isin(*accepted_rules), "Positive criterion needs a documented adapter"),
        (8, F.col("_s").isNull(), "Support record missing"),
        (9, F.col("_s").isNotNull() & ~(same("common_valid_area") & same("masked_area") & same("outside_area") & same("unit_count")), "Common-support sources conflict"),
        (10, F.abs(total - zone_area) > zone_area * tolerance, "Support area closure failed"),
        (11, F.col("_dup") > 1, "Duplicate analytical unit"),
        (12, F.coalesce("_rows", F.lit(0)) != F.col("unit_count"), "Unit count conflict"),
        (13, F.col("_models") != len(models), "Unit without all model values"),
        (14, (F.col("_low") <= 0) | (F.abs(F.coalesce("_area", F.lit(0.0)) - F.col("common_valid_area")) > zone_area * tolerance), "Common-support area closure failed")])
    known = layers.withColumnRenamed("map_code", "_map").groupBy("layer_id").agg(F.count("*").alias("_k"), F.first(F.struct("climate_model_code", "_map", "verification_status")).alias("_l"))
    member = groups.select("group_id", "map_code", F.posexplode("layer_ids").alias("pos", "layer_id")).join(known, "layer_id", "left")
    ordered = F.element_at(F.array(*[F.lit(m) for m in models]), F.least(F.col("pos") + 1, F.lit(len(models))))
    verified = F.coalesce(F.col("_l.verification_status").isin("VERIFIED_INSIDE_AOI", "VERIFIED_BUT_EMPTY_INSIDE_AOI"), F.lit(False))
    parts = failed(member, [
        (4, F.col("_k").isNull() | (F.col("_k") > 1), "Layer record missing or duplicated: conflict"),
        (5, ~F.col("_l.climate_model_code").eqNullSafe(ordered), "Model order conflicts with the layer records"),
        (6, ~F.col("_l._map").eqNullSafe(F.col("map_code")), "Product conflicts with the layer records"),
        (7, ~verified, "Source verification incomplete")]).distinct()
    return own.unionByName(parts)


def qa_flag_gate(checks: DataFrame, key: str, flags: str, tolerated: list[str]) -> DataFrame:
    """Failed boolean checks (map name -> passed): tolerated ones are gaps, the others block."""
    rows = checks.select(key, F.explode(F.map_entries(flags)).alias("e")).where(~F.coalesce(F.col("e.value"), F.lit(False)))
    return rows.select(key, F.col("e.key").alias("check_name"), F.when(F.col("e.key").isin(*tolerated), "GAP").otherwise("BLOCKED").alias("effect"))


def group_status_gate(groups: DataFrame, status: DataFrame, expected_models: int, complete: list[str], key: str = "group_id") -> DataFrame:
    """A group needs one status row, a complete status and all verified models."""
    s = status.groupBy(key).agg(F.count("*").alias("_n"), F.first(F.struct("status", "verified_model_count")).alias("_s"))
    j = groups.select(key).join(s, key, "left")
    return j.select(key, decide([(F.col("_n").isNull(), "MISSING"), (F.col("_n") > 1, "DUPLICATE"), (~F.col("_s.status").isin(*complete), "INCOMPLETE"),
                                 (F.col("_s.verified_model_count") != expected_models, "MODELS_NOT_VERIFIED")], "OK").alias("group_gate"))


def verify_manifest(actual: DataFrame, manifest: DataFrame, path: str = "path", digest: str = "sha256") -> DataFrame:
    """File set and digests against a manifest: UNREGISTERED, MISSING, CHANGED or OK per path."""
    g = _sides(actual, manifest, [path], [digest]).groupBy(path).agg(F.max(F.when(F.col("_left"), F.col(digest))).alias("_a"), F.max(F.when(~F.col("_left"), F.col(digest))).alias("_m"))
    return g.select(path, decide([(F.col("_m").isNull(), "UNREGISTERED"), (F.col("_a").isNull(), "MISSING"), (F.col("_a") != F.col("_m"), "CHANGED")], "OK").alias("file_status"))


def fingerprint(columns: list[str], context: dict[str, str]) -> Column:
    """SHA-256 of the columns in name order together with the run context (zone hash, algorithm version)."""
    parts = [F.col(c).alias(c) for c in sorted(columns)] + [F.lit(v).alias(f"~{k}") for k, v in sorted(context.items())]
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


def pending_work(planned: DataFrame, done: DataFrame, columns: list[str], context: dict[str, str]) -> DataFrame:
    """Planned units whose fingerprint is not among the completed ones: new or changed work only."""
    return planned.withColumn("fingerprint", fingerprint(columns, context)).join(done.select("fingerprint"), "fingerprint", "left_anti")


def gap_list(layers: DataFrame) -> DataFrame:
    """Selected layers that were not extracted, with the reason."""
    return layers.where(F.col("selected") & (F.col("extraction_status") != "EXTRACTED")).select("layer_id", "required", F.col("extraction_status").alias("status"), "reason")


def run_outcome(gaps: DataFrame) -> DataFrame:
    """INCOMPLETE with a required gap, COMPLETE_WITH_OPTIONAL_GAPS with any other, else COMPLETE."""
    return gaps.agg(F.count("*").alias("gap_count"), F.count_if("required").alias("required_gap_count")).withColumn(
        "outcome", decide([(F.col("required_gap_count") > 0, "INCOMPLETE"), (F.col("gap_count") > 0, "COMPLETE_WITH_OPTIONAL_GAPS")], "COMPLETE"))


def check_list(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Named boolean aggregates as one row each, plus the overall row ``all_checks``."""
    agg = df.agg(*[F.coalesce(e, F.lit(False)).alias(f"_c{i}") for i, e in enumerate(checks.values())])
    entry = lambda name, value: F.struct(F.lit(name).alias("check_name"), value.alias("passed"))
    every = F.least(*[F.col(f"_c{i}") for i in range(len(checks))]) if len(checks) > 1 else F.col("_c0")
    return agg.select(F.explode(F.array(*[entry(n, F.col(f"_c{i}")) for i, n in enumerate(checks)], entry("all_checks", every))).alias("r")).select("r.*")


def metadata_completeness(layers: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Layer x field: RESOLVED where a value exists, else NOT_APPLICABLE."""
    text = layers.select(key, *[F.col(f).cast("string").alias(f) for f in fields])
    long = text.unpivot([key], fields, "field", "value")
    return long.select(key, "field", F.when(F.col("value").isNotNull(), "RESOLVED").otherwise("NOT_APPLICABLE").alias("status"))


def set_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct left keys absent on the right; NULL keys compare equal."""
    g = _sides(left, right, keys, []).groupBy(*keys).agg(F.bool_or("_left").alias("_l"), F.bool_or(~F.col("_left")).alias("_r"))
    return g.where("_l AND NOT _r").select(*keys)


def finite_assert(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Values that are no analytical numbers: booleans, NaN, infinities and missing ones, one row per (key, field)."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    bad = [F.when(F.lit(True) if kinds[c] == "boolean" else ~is_finite(c), F.lit(c)) for c in columns]
    return df.select(*keys, F.explode(F.array_compact(F.array(*bad))).alias("field"))
