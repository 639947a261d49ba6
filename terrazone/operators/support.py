"""Common valid support of several layers: same-grid equi form and general rectangle overlay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import col, join_null_safe
from .inside import rectangle_areas

TINY = 1e-14    # pieces below this share of the zone area are dropped


def grid_alignment(layers: DataFrame, group: list[str], tolerance: float = 1e-10) -> DataFrame:
    """Whether all layers of a group share one grid: crs, shape and transform within the tolerance.

    Layer columns: crs, width, height, x0, y0, dx, dy.
    """
    spread = lambda c: (F.max(c) - F.min(c)) <= tolerance
    agg = layers.groupBy(*group).agg(
        F.count("*").alias("layer_count"),
        ((F.min("crs") == F.max("crs")) & (F.min("width") == F.max("width")) & (F.min("height") == F.max("height"))
         & spread("x0") & spread("y0") & spread("dx") & spread("dy")).alias("same_native_grid"))
    return agg


def number_in_group(df: DataFrame, group: list[str], outer: str, inner: list[str], name: str, fmt: str | None = None) -> DataFrame:
    """Deterministic 1..n numbering of a group by (outer, inner), without ordering a whole group in one task.

    Rows are counted per (group, outer); the running count gives each slice its offset, and only a
    slice is ordered at a time.
    """
    slices = df.groupBy(*group, outer).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*group).orderBy(outer).rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(*group, outer, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    ranked = join_null_safe(df, offsets, [*group, outer])
    rank = F.row_number().over(Window.partitionBy(*group, outer).orderBy(*inner)) + F.col("_offset")
    value = F.format_string(fmt, rank) if fmt else rank
    return ranked.withColumn(name, value).drop("_offset")


def support_aligned(cells: DataFrame, group: list[str], model: str, models: list[str], value, valid, area: str,
                    row: str = "row", column: str = "column", number: bool = True) -> DataFrame:
    """Units of the common support on one grid: positions at which all N layers are valid.

    One aggregate over (group, row, column) with a bounded state replaces N chained joins. Output:
    group, row, column, unit_id, area, values (model order).
    """
    ok = F.coalesce(col(valid), F.lit(False)) & col(value).isNotNull()
    m = F.col(model)
    agg = cells.groupBy(*group, row, column).agg(
        F.max(area).alias(area),
        *[F.max(F.when((m == name) & ok, col(value).cast("double"))).alias(f"_v{i}") for i, name in enumerate(models)])
    complete = agg.where(" AND ".join(f"_v{i} IS NOT NULL" for i in range(len(models))))
    units = complete.select(*group, row, column, area, F.array(*[f"_v{i}" for i in range(len(models))]).alias("values"))
    return number_in_group(units, group, row, [column], "unit_id", "u%05d") if number else units


def _positions(cells, group, model, models, valid, area, row, column):
    """Per position: area, number of layers present and number of layers valid, in one aggregate."""
    v, m = F.coalesce(col(valid), F.lit(False)), F.col(model)
    flags = cells.groupBy(*group, row, column).agg(
        F.max(area).alias("_a"), *[F.max(F.when(m == name, v.cast("int"))).alias(f"_f{i}") for i, name in enumerate(models)])
    seen = [F.col(f"_f{i}") for i in range(len(models))]
    return flags.select(*group, row, column, "_a", sum([f.isNotNull().cast("int") for f in seen], F.lit(0)).alias("_present"),
                        sum([F.coalesce(f, F.lit(0)) for f in seen], F.lit(0)).alias("_valid"))


def support_report(cells: DataFrame, group: list[str], model: str, models: list[str], valid, area: str, zone_area: float,
                   row: str = "row", column: str = "column", tolerance: float = 1e-4) -> DataFrame:
    """Common, masked and outside area, share, unit count, flag and closure status per group.

    The footprint of a group on one grid is the set of positions present in all N layers.
    """
    p = _positions(cells, group, model, models, valid, area, row, column)
    common, everywhere = F.col("_valid") == len(models), F.col("_present") == len(models)
    agg = p.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(common, F.col("_a"))), F.lit(0.0)).alias("common_valid_area"),
        F.coalesce(F.sum(F.when(everywhere, F.col("_a"))), F.lit(0.0)).alias("_foot"),
        F.count_if(common).alias("analytical_unit_count"))
    return _accounted(agg, float(zone_area), tolerance)


WORD_BITS = 62


def layer_bits(layers: list[str], held: Column) -> Column:
    """An array of names as bits in the order of ``layers``: one whole number for each 62 of them. Other names have no bit."""
    place = F.transform(held, lambda name: F.array_position(F.array(*[F.lit(x) for x in layers]), name).cast("int") - 1)
    word = lambda k: F.aggregate(F.filter(place, lambda i: (i >= k * WORD_BITS) & (i < (k + 1) * WORD_BITS)), F.lit(0).cast("long"),
                                 lambda bits, i: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i - k * WORD_BITS)))
    return F.array(*[word(k) for k in range(-(-len(layers) // WORD_BITS))])


def presence_bitmaps(cells: DataFrame, group: list[str], layer: str, layers: list[str], valid, area: str, row: str = "row", column: str = "column") -> DataFrame:
    """(group, present, valid, positions, area): positions of one grid at which the same layers are present and the same ones valid, as bits.

    One shuffle by position, at which at most all layers meet, and one by bitmap, of which there are few: layers of one product share their footprints.
    """
    ok = F.coalesce(col(valid), F.lit(False))
    each = cells.groupBy(*group, row, column).agg(F.max(area).alias("_a"), F.collect_set(F.col(layer)).alias("_seen"), F.collect_set(F.when(ok, F.col(layer))).alias("_ok"))
    bits = each.select(*group, "_a", layer_bits(layers, F.col("_seen")).alias("present"), layer_bits(layers, F.col("_ok")).alias("valid"))
    return bits.groupBy(*group, "present", "valid").agg(F.count("*").alias("positions"), F.sum("_a").alias("area"))


def subset_support(bitmaps: DataFrame, group: list[str], subsets: DataFrame, zone_area, tolerance: float = 1e-4) -> DataFrame:
    """The support of any sets of layers: ``subsets`` (group, need, ...) with areas, share, unit count, flag and status.

    ``need`` has the bits of a comparison's layers: those of a pair, of two groups, of a group and its ensemble. They are valid together where the valid bits are
    a superset, and in the footprint where the present bits are. Cells are not looked at again, however many subsets there are.
    """
    held = lambda bits: F.forall(F.zip_with("need", bits, lambda n, b: n.bitwiseAND(b) == n), lambda x: x)
    others = [c for c in subsets.columns if c not in group]
    joined = join_null_safe(subsets, bitmaps, group, "left")
    agg = joined.groupBy(*group, *others).agg(
        F.coalesce(F.sum(F.when(held("valid"), F.col("area"))), F.lit(0.0)).alias("common_valid_area"),
        F.coalesce(F.sum(F.when(held("present"), F.col("area"))), F.lit(0.0)).alias("_foot"),
        F.coalesce(F.sum(F.when(held("valid"), F.col("positions"))), F.lit(0)).alias("analytical_unit_count"))
    return _accounted(agg, zone_area, tolerance).drop("need")


def cells_per_source(cells: DataFrame, group: list[str], model: str, models: list[str], valid, area: str,
                     row: str = "row", column: str = "column") -> DataFrame:
    """Per layer: own valid area and distinct native cells inside the common support."""
    common = (_positions(cells, group, model, models, valid, area, row, column).where(F.col("_valid") == len(models))
              .select(*group, row, column, F.lit(True).alias("_common")))
    v = F.coalesce(col(valid), F.lit(False))
    cell = cells.groupBy(*group, model, row, column).agg(F.max(area).alias("_a"), F.max(v).alias("_ok"))
    joined = join_null_safe(cell, common, [*group, row, column], "left")
    return joined.groupBy(*group, model).agg(
        F.coalesce(F.sum(F.when(F.col("_ok"), F.col("_a"))), F.lit(0.0)).alias("source_valid_area"),
        F.count_if(F.col("_common")).alias("native_cell_count"))


def _tiles(df: DataFrame, tile: float, x0="x0", y0="y0", x1="x1", y1="y1") -> DataFrame:
    """One row per (rectangle, tile it touches); tile ids turn the range join into a hash join."""
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / tile), F.floor(F.col(hi) / tile))
    return df.withColumn("_tx", F.explode(span(x0, x1))).withColumn("_ty", F.explode(span(y0, y1)))


def _owner(x: Column, y: Column, tile: float) -> Column:
    """A pair is emitted only by the tile holding the lower-left corner of its intersection."""
    return (F.floor(x / tile) == F.col("_tx")) & (F.floor(y / tile) == F.col("_ty"))


def overlay_pieces(cells: DataFrame, group: list[str], layer: str, layers: list[str], value, valid, tile: float,
                   boundary: list[str] = ("x0", "y0", "x1", "y1")) -> DataFrame:
    """Intersections of N rectangle layers, those of masked cells included: group, x0, y0, x1, y1, values, cell_ids, valid.

    The rectangles are cells in an equal-area projection. Each step is a tile-keyed hash join followed by an exact overlap test; an intersection of
    axis-aligned rectangles is again a rectangle. ``valid`` says that all N cells are. ``tile`` should be a few cell sizes of the coarser grid.
    """
    x0, y0, x1, y1 = boundary
    ok = F.coalesce(col(valid), F.lit(False)) & col(value).isNotNull()
    good = cells.select(*group, F.col(layer).alias("_layer"), "cell_id", F.when(ok, col(value).cast("double")).alias("_value"), ok.alias("_ok"),
                        F.col(x0).alias("x0"), F.col(y0).alias("y0"), F.col(x1).alias("x1"), F.col(y1).alias("y1"))
    units = good.where(F.col("_layer") == layers[0]).select(
        *group, "x0", "y0", "x1", "y1", F.array("_value").alias("values"), F.array("cell_id").alias("cell_ids"), F.col("_ok").alias("valid"))
    for name in layers[1:]:
        other = good.where(F.col("_layer") == name).select(
            *group, *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")], "_value", "_ok", F.col("cell_id").alias("_id"))
        joined = join_null_safe(_tiles(units, tile), _tiles(other, tile, "_x0", "_y0", "_x1", "_y1"), [*group, "_tx", "_ty"])
        low_x, low_y = F.greatest("x0", "_x0"), F.greatest("y0", "_y0")
        high_x, high_y = F.least("x1", "_x1"), F.least("y1", "_y1")
        units = (joined.where((low_x < high_x) & (low_y < high_y) & _owner(low_x, low_y, tile))
                 .select(*group, low_x.alias("x0"), low_y.alias("y0"), high_x.alias("x1"), high_y.alias("y1"),
                         F.concat("values", F.array("_value")).alias("values"),
                         F.concat("cell_ids", F.array("_id")).alias("cell_ids"), (F.col("valid") & F.col("_ok")).alias("valid")))
    return units


def clip_to_zone(pieces: DataFrame, zone_edges: DataFrame, tile: float, zone: list[str] = ()) -> DataFrame:
    """Add ``area``, that of each rectangle inside the zone. A piece that no edge crosses is in or out as a whole; the others are measured from
    the edges in their tiles. ``zone`` names the columns that say which zone a row belongs to; without, there is one."""
    return rectangle_areas(pieces, [], zone_edges, list(zone), tile).withColumnRenamed("inside_area", "area")


def support_overlay(cells: DataFrame, group: list[str], layer: str, layers: list[str], value, valid, zone_area: float,
                    tile: float, boundary: list[str] = ("x0", "y0", "x1", "y1"), zone_edges: DataFrame | None = None, zone: list[str] = ()) -> DataFrame:
    """Units of the common support on different grids: intersections of N valid cells, numbered from the top and from the left in a group.

    With ``zone_edges`` (see ``inside.oriented_edges``) ``area`` is what lies inside the zone; units with less than 1e-14 of the zone are dropped.
    """
    usable = F.coalesce(col(valid), F.lit(False)) & col(value).isNotNull()
    pieces = overlay_pieces(cells.where(usable), group, layer, layers, value, valid, tile, boundary).drop("valid")
    whole = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    units = pieces.withColumn("area", whole) if zone_edges is None else clip_to_zone(pieces, zone_edges, tile, zone)
    units = units.where(F.col("area") > zone_area * TINY).withColumn("_down", -F.col("y1"))
    return number_in_group(units, group, "_down", ["x0", "cell_ids"], "unit_id", "u%05d").drop("_down")


def overlay_report(cells: DataFrame, group: list[str], layer: str, layers: list[str], value, valid, zone_area: float, tile: float, zone_edges: DataFrame,
                   zone: list[str] = (), boundary: list[str] = ("x0", "y0", "x1", "y1"), tolerance: float = 1e-4) -> DataFrame:
    """Common, masked and outside area inside the zone, share, unit and native cell counts, flag and closure per group, on different grids.

    The footprint is where cells of all layers lie, valid or not; what of it is not common is masked, the rest of the zone is outside.
    """
    pieces = clip_to_zone(overlay_pieces(cells, group, layer, layers, value, valid, tile, boundary), zone_edges, tile, zone).where(F.col("area") > zone_area * TINY)
    common = F.col("valid")
    agg = pieces.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(common, F.col("area"))), F.lit(0.0)).alias("common_valid_area"), F.sum("area").alias("_foot"), F.count_if(common).alias("analytical_unit_count"),
        *[F.count_distinct(F.when(common, F.col("cell_ids")[i])).alias(f"native_cell_count_{i}") for i in range(len(layers))])
    counts = F.array(*[F.coalesce(f"native_cell_count_{i}", F.lit(0)) for i in range(len(layers))]).alias("native_cell_counts")
    groups = cells.select(*group).distinct()
    out = join_null_safe(groups, agg, group, "left").select(
        *group, F.coalesce("common_valid_area", F.lit(0.0)).alias("common_valid_area"), F.coalesce("_foot", F.lit(0.0)).alias("_foot"),
        F.coalesce("analytical_unit_count", F.lit(0)).alias("analytical_unit_count"), counts)
    return _accounted(out, zone_area, tolerance)


def _accounted(agg: DataFrame, zone_area, tolerance: float) -> DataFrame:
    """Shares, excluded areas, flag and closure from common_valid_area, _foot and analytical_unit_count."""
    zone = col(zone_area).cast("double")
    agg = agg.withColumns({
        "zone_area": zone,
        "common_valid_percentage": 100 * F.col("common_valid_area") / zone,
        "excluded_masked_area": F.greatest(F.lit(0.0), F.col("_foot") - F.col("common_valid_area")),
        "excluded_outside_footprint_area": F.greatest(F.lit(0.0), zone - F.col("_foot")),
        "quality_flag": F.when(F.col("analytical_unit_count") == 0, "NO_COMMON_VALID_SUPPORT")
                         .when(F.col("analytical_unit_count") < 5, "FEW_NATIVE_CELLS").otherwise("OK")})
    total = F.col("common_valid_area") + F.col("excluded_masked_area") + F.col("excluded_outside_footprint_area")
    return agg.withColumn("status", F.when(F.abs(total - zone) <= zone * tolerance, "OK").otherwise("AREA_ACCOUNTING_FAILED")).drop("_foot")


def overlap_area(units: DataFrame, group: list[str], tile: float) -> DataFrame:
    """Area covered more than once by a group's rectangles, without comparing rectangles pairwise.

    Rectangles are cut at the tile borders and at the distinct grid lines of their tile; counting the
    resulting elementary pieces gives the union area, and copies collapse in the map-side combine. The
    per-tile line lists are bounded by the grid lines in a tile (``tile`` is a few cell sizes).
    """
    r = _tiles(units.select(*group, "x0", "y0", "x1", "y1"), tile)
    tx, ty = F.col("_tx") * tile, F.col("_ty") * tile
    cut = r.select(*group, "_tx", "_ty", F.greatest("x0", tx).alias("x0"), F.greatest("y0", ty).alias("y0"),
                   F.least("x1", (F.col("_tx") + 1) * tile).alias("x1"), F.least("y1", (F.col("_ty") + 1) * tile).alias("y1"))
    cut = cut.where("x0 < x1 AND y0 < y1").groupBy(*group, "_tx", "_ty", "x0", "y0", "x1", "y1").agg(F.count("*").alias("_copies"))
    key = [*group, "_tx", "_ty"]
    lines = cut.groupBy(*key).agg(F.array_union(F.collect_set("x0"), F.collect_set("x1")).alias("_xs"),
                                  F.array_union(F.collect_set("y0"), F.collect_set("y1")).alias("_ys"))
    within = lambda name, lo, hi: F.sort_array(F.filter(name, lambda v: (v >= F.col(lo)) & (v <= F.col(hi))))
    steps = lambda a: F.transform(F.sequence(F.lit(1), F.size(a) - 1), lambda i: F.struct(a[i - 1].alias("lo"), a[i].alias("hi")))
    parts = (join_null_safe(cut, lines, key)
             .withColumn("_xs", within("_xs", "x0", "x1")).withColumn("_ys", within("_ys", "y0", "y1"))
             .withColumn("_px", F.explode(steps(F.col("_xs")))).withColumn("_py", F.explode(steps(F.col("_ys")))))
    pieces = parts.groupBy(*group, "_px", "_py").agg(F.sum("_copies").alias("_n"))
    area = (F.col("_px.hi") - F.col("_px.lo")) * (F.col("_py.hi") - F.col("_py.lo"))
    return pieces.groupBy(*group).agg(F.sum(area).alias("union_area"), F.sum((F.col("_n") - 1) * area).alias("overlap_area"))


def unit_overlap_check(units: DataFrame, group: list[str], tile: float, zone_box: tuple[float, float, float, float] | None = None,
                       tolerance: float = 1e-4, zone_edges: DataFrame | None = None, zone: list[str] = (), zone_area: float | None = None) -> DataFrame:
    """Units of a group must not overlap and must lie inside the zone: a polygon given by its edges, with ``zone_area``, or a rectangle ``zone_box``."""
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    if zone_edges is None:
        zx0, zy0, zx1, zy1 = zone_box
        zone_area = (zx1 - zx0) * (zy1 - zy0)
        width = F.greatest(F.lit(0.0), F.least("x1", F.lit(zx1)) - F.greatest("x0", F.lit(zx0)))
        height = F.greatest(F.lit(0.0), F.least("y1", F.lit(zy1)) - F.greatest("y0", F.lit(zy0)))
        placed = units.withColumn("inside_area", width * height)
    else:
        placed = rectangle_areas(units, [], zone_edges, list(zone), tile)
    totals = placed.groupBy(*group).agg(F.count("*").alias("unit_count"), F.sum(area).alias("unit_area"),
                                        F.sum(area - F.col("inside_area")).alias("outside_area"))
    out = join_null_safe(totals, overlap_area(units, group, tile), group, "left")
    return out.withColumn("status", F.when(F.col("overlap_area") > zone_area * tolerance, "OVERLAPPING_UNITS")
                          .when(F.col("outside_area") > zone_area * tolerance, "OUTSIDE_ZONE").otherwise("OK"))


def missing_members(planned: DataFrame, verified: DataFrame, group: list[str], model: str, models: list[str]) -> DataFrame:
    """Planned minus verified members per group; incomplete groups are pending with the missing list."""
    has = lambda m: F.coalesce(F.bool_or(F.col("_seen") & (F.col(model) == m)), F.lit(False))
    want = lambda m: F.coalesce(F.bool_or(F.col("_plan") & (F.col(model) == m)), F.lit(False))
    both = (planned.select(*group, model, F.lit(True).alias("_plan"), F.lit(False).alias("_seen"))
            .unionByName(verified.select(*group, model, F.lit(False).alias("_plan"), F.lit(True).alias("_seen"))))
    agg = both.where(F.col(model).isin(*models)).groupBy(*group).agg(
        *[want(m).alias(f"_p{i}") for i, m in enumerate(models)], *[has(m).alias(f"_s{i}") for i, m in enumerate(models)])
    missing = F.array_compact(F.array(*[F.when(F.col(f"_p{i}") & ~F.col(f"_s{i}"), F.lit(m)) for i, m in enumerate(models)]))
    seen = sum([F.col(f"_s{i}").cast("int") for i in range(len(models))], F.lit(0))
    return agg.where(" OR ".join(f"_p{i}" for i in range(len(models)))).select(
        *group, seen.alias("verified_model_count"), F.sort_array(missing).alias("missing_models"),
        F.when((F.size(missing) == 0) & (seen == len(models)), "COMPLETE").otherwise("PENDING_ALL_VERIFIED_MODELS").alias("status"))


def group_gate(assets: DataFrame, group: list[str], asset_key: str, status: str, verified: str, expected: int) -> DataFrame:
    """A group passes only when exactly the expected number of distinct members exist and all are verified."""
    agg = assets.groupBy(*group).agg(
        F.count("*").alias("_rows"), F.count_distinct(asset_key).alias("_keys"), F.count_if(F.col(status) == verified).alias("_ok"))
    complete = (F.col("_rows") == expected) & (F.col("_keys") == expected) & (F.col("_ok") == expected)
    return agg.select(*group, complete.alias("confirmed"),
                      F.when(complete, verified).otherwise("METADATA_ONLY").alias("group_status"),
                      F.when(complete, "USE_NEXT").otherwise("REVIEW_VERIFICATION_REPORT").alias("action"),
                      F.format_string(f"%d/{expected} selected assets passed", F.col("_ok")).alias("evidence"))


def metric_layer(units: DataFrame, group: list[str], metrics: list[str], area: str, zone_area: float) -> DataFrame:
    """Per derived metric: defined units, their area and share of the zone. Undefined metrics are skipped."""
    long = units.select(*group, area, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot([*group, area], metrics, "metric", "value")
    return long.where("value IS NOT NULL").groupBy(*group, "metric").agg(
        F.count("*").alias("unit_count"), F.sum(area).alias("valid_area"),
        (100 * F.sum(area) / zone_area).alias("valid_area_percentage"))
