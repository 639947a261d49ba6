"""Connected components of a table of links, by rounds of joins that connect neighbours to the smallest id they know."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import remove, stash


def connected_components(links: DataFrame, name: str = "components", with_path: bool = False) -> DataFrame | tuple[DataFrame, str]:
    """(node, component) of every node of the links (a, b), and the path of that table if asked for; the component is the smallest node that can be reached.

    Nodes without a link to another node do not appear. Each round first connects the larger neighbours of a node to the smallest id
    in its neighbourhood, then the smaller ones and itself; rounds end when every node has one link, to a node without one. Minima are
    taken inside tasks before they are shuffled, so a node with very many links is no single task's work, and every step
    is a written table, so a lost executor repeats one step at most.
    """
    spark = links.sparkSession
    down = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component")).distinct()
    table, path = stash(down, name)
    while not is_flat(table):
        for step in (connect_larger, connect_smaller):
            lows, low_path = stash(lowest(table, step is connect_larger), f"{name}-low")
            new, new_path = stash(step(table, lows).where("node != component").distinct(), name)
            remove(spark, path, low_path)
            table, path = new, new_path
    return (table, path) if with_path else table


def is_flat(table: DataFrame) -> bool:
    """Whether every node has one link only, and none leads to a node with a link."""
    ends = table.select(F.col("node").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        table.select(F.col("component").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    each = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return each.where("below > 1 OR below + above > 1").isEmpty()


def lowest(table: DataFrame, all_neighbours: bool) -> DataFrame:
    """The smallest id in a node's neighbourhood, itself included; or the smallest of the ids it is linked down to."""
    if all_neighbours:
        table = table.unionByName(table.select(F.col("component").alias("node"), "component"))
    return table.groupBy(F.col("node").alias("x")).agg(F.min("component").alias("low"))


def connect_larger(table: DataFrame, lows: DataFrame) -> DataFrame:
    """Each link (larger, smaller) becomes (larger, lowest of the smaller)."""
    return table.join(lows, table["component"] == lows["x"]).select("node", F.col("low").alias("component"))


def connect_smaller(table: DataFrame, lows: DataFrame) -> DataFrame:
    """The nodes which a node is linked down to, and itself, are linked to the lowest of them."""
    near = table.join(lows, table["node"] == lows["x"])
    return near.select(F.col("component").alias("node"), F.col("low").alias("component")).unionByName(lows.select(F.col("x").alias("node"), F.col("low").alias("component")))
