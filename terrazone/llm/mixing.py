"""Mixing sources to target weights: random keys, ranges of keys, prefix sums, exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import join_null_safe
from .common import WORD, key_slice, remove, stash, uniform_key

WEIGHTS = (1.0, 2.0, 3.0)
EPOCHS = 3
SLICES = 1024


def word_count(text) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ordered_sources(sizes: DataFrame) -> DataFrame:
    """Add ``place``, the number of a source in code point order from 0, null last.

    Sources are sorted over all partitions; only the row counts of partitions are summed in one place.
    """
    spread, path = stash(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("__p", F.spark_partition_id()), "mix-sources")
    counts = spread.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__p").orderBy(F.col("source").asc_nulls_last())
    placed, kept = stash(spread.join(offsets, "__p").withColumn("place", F.col("__before") + F.row_number().over(inside) - 1).drop("__p", "__before"), "mix-places")
    remove(sizes.sparkSession, path)
    return placed


def targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The words to take from each source (source, source_size, target).

    All sizes together are shared by weight. A source whose share is above ``epochs`` times its size stops there, and the excess
    is shared again by weight among the others until none is above. Each round is one sum over the table of sources.
    """
    table = ordered_sources(sizes)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = table.select("source", "source_size", F.get(cycle, (F.col("place") % len(weights)).cast("int")).alias("weight"), (F.col("source_size") * float(epochs)).alias("cap"))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = (F.col("cap") <= F.lit(level) * F.col("weight")) if level else F.lit(False)
        spent, open_weight = table.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        raised = (total - spent) / open_weight if open_weight else level
        if raised <= level:
            break
        level = raised
    return table.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def cuts(keyed: DataFrame, goals: DataFrame, slices: int = SLICES) -> DataFrame:
    """Where each source's budget ends in the order of its keys: whole epochs, then rows below ``cut_key``, then ``cut_words`` of the rows at it.

    ``keyed`` has source, size and key. Sizes are summed by source and range of keys; the prefix sums over the ranges name the
    range in which the budget ends, and only the rows of that range are ordered.
    """
    budget = goals.withColumn("budget", F.floor(F.col("target") + 1e-6).cast("long"))
    budget = budget.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long"))
    budget = budget.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    cells = keyed.withColumn("slice", key_slice(F.col("key"), slices))
    sums = cells.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("slice")) - F.col("words"))
    last = join_null_safe(sums, budget.select("source", "rest"), ["source"]).where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
    rows = join_null_safe(cells, last.select("source", "slice", "before", "rest"), ["source", "slice"])
    ties = rows.groupBy("source", "key", "before", "rest").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
    ties = ties.withColumn("start", F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("key")) - F.col("words"))
    end = ties.where((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("words")))
    end = end.select("source", F.col("key").alias("cut_key"), F.floor((F.col("rest") - F.col("start")) / F.col("rows")).alias("cut_words"))
    return join_null_safe(budget.drop("budget", "rest"), end, ["source"], "left")


def mix(df: DataFrame, source: str = "source", size: Column | None = None, row_key: list[str] = ("doc_id",), text: str = "text",
        weights=WEIGHTS, epochs: int = EPOCHS, seed: str = "mix", slices: int = SLICES) -> DataFrame:
    """Add to each row of ``df`` its size, its source's size and target, the words that the mix takes from it, and its whole copies.

    Columns added: ``size``, ``source_size``, ``target``, ``taken`` (epochs and the exact cut; the sum over a source is its
    target, rounded down) and ``copies`` (the row at the cut counts if at least half of it is taken). Columns of these names are replaced.

    A row's place in its source is its uniform key, the MD5 of seed, row key and text, so reruns agree. Rows equal in key and text
    share what is left at a cut evenly. A null source is a source of its own, the last one; a null text has size 0 and is never
    taken; an empty table stays empty. Texts are not shuffled unless there are too many sources for Spark to broadcast their table.
    """
    clash = [c for c in ("size", "source_size", "target", "taken", "copies") if c in df.columns]
    mark = "__"  # begins the names of columns on the way, and of no column of the input
    while any(c.startswith(mark) for c in df.columns):
        mark += "_"
    col = lambda c: F.col(mark + c)
    size = word_count(F.col(text)) if size is None else size
    rows = df.withColumns({f"{mark}size": size, f"{mark}key": uniform_key(F.lit(seed), *row_key, F.md5(F.coalesce(F.col(text), F.lit("~"))))}).drop(*clash)
    keyed, path = stash(rows.select(F.col(source).alias("source"), col("size").alias("size"), col("key").alias("key")), "mix-keys")
    goals = targets(keyed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
    ends, _ = stash(cuts(keyed, goals, slices), "mix-cuts")
    remove(df.sparkSession, path)
    ends = ends.select(*[F.col(c).alias(mark + c) for c in ends.columns])
    joined = rows.join(ends, rows[source].eqNullSafe(ends[f"{mark}source"]), "left")
    part = F.when(col("key") < col("cut_key"), col("size")).when(col("key") == col("cut_key"), col("cut_words")).otherwise(0)
    out = joined.withColumns({f"{mark}part": F.coalesce(part, F.lit(0)).cast("long")})
    whole = ((col("part") > 0) & (2 * col("part") >= col("size"))).cast("long")
    return out.withColumns({"size": col("size"), "source_size": col("source_size"), "target": col("target"), "taken": col("epochs") * col("size") + col("part"),
                            "copies": F.when(col("size") > 0, col("epochs") + whole).otherwise(0).cast("long")}).drop(*[c for c in out.columns if c.startswith(mark)])
