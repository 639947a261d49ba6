"""Comparing all rows of a group in blocks of bounded size, many groups to a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def blocked(df: DataFrame, keys: list[str], row: str, size: int) -> DataFrame:
    """Each row of a group once for every pair (i, j) of blocks that its block is in; groups of up to ``size`` rows are one block.

    Groups beyond that are found by counting inside tasks; a group with n rows makes n / size copies of each.
    """
    large = df.groupBy(*keys).count().where(F.col("count") > size).select(*keys, F.ceil(F.col("count") / size).cast("int").alias("__blocks"))
    rows = df.join(large, keys, "left").withColumn("__blocks", F.coalesce("__blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(row), F.col("__blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("__other")
    return rows.select("*", other).withColumns({"i": F.least("block", "__other"), "j": F.greatest("block", "__other")}).drop("__blocks", "__other")


def by_groups(df: DataFrame, keys: list[str], compare: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """Apply a function to the rows of each group and pair of blocks: bounded groups, streamed in sorted order."""
    keys = [*keys, "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            starts = np.flatnonzero((batch[keys] != batch[keys].shift()).any(axis=1).to_numpy())
            yield from found(batch, starts[:-1], starts[1:])
            rest = batch.iloc[starts[-1]:] if len(starts) else None
        if rest is not None and len(rest):
            yield from found(rest.reset_index(drop=True), [0], [len(rest)])

    def found(batch, starts, ends):
        out = [r for a, b in zip(starts, ends) if b - a > 1 and (r := compare(batch.iloc[a:b])) is not None]
        if out:
            yield pd.concat(out, ignore_index=True)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def streamed(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each group, from batches sorted by ``keys``."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        values = batch[keys].to_numpy()
        starts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for k, (a, b) in enumerate(zip([0, *starts], [*starts, len(batch)])):
            if b > a:
                if rest and (k or (rest[-1][keys].to_numpy()[-1] != values[a]).any()):
                    yield pd.concat(rest, ignore_index=True)
                    rest = []
                rest.append(batch.iloc[a:b])
    if rest:
        yield pd.concat(rest, ignore_index=True)


def opposite(group: pd.DataFrame) -> np.ndarray:
    """Which pairs of a group belong to it: of two blocks only those across, of one block all but a row with itself."""
    block = group["block"].to_numpy()
    if group["i"].iloc[0] != group["j"].iloc[0]:
        return block[:, None] != block
    return ~np.eye(len(block), dtype=bool)


def near_components(adjacent: np.ndarray) -> np.ndarray:
    """Number of the smallest member of each row's component."""
    label = np.arange(len(adjacent))
    while True:
        low = np.minimum(label, np.where(adjacent, label, len(label)).min(1))
        low = low[low]
        if (low == label).all():
            return label
        label = low
