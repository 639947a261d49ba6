"""Near-duplicate vectors by randomised-rotation binary codes.

A vector of unit length is rotated at random and cut to its signs: a code of one bit a dimension. The inner product of the signs
(scaled to unit length) with the rotated vector is stored as the code's correction factor. Two vectors under two independent
rotations then give an unbiased estimate of their cosine, the product of the codes over the product of the factors, with a
standard deviation that the factors determine; only where the upper confidence bound reaches the threshold is the cosine computed from the vectors.

Codes also choose whom to compare: bands of code bits, so many that a pair at the threshold shares one with the wanted
probability. Buckets of a band are compared in blocks of bounded size; first with codes alone, which drops nearly all rows, then
with the vectors of the rows that remain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import blocked, by_groups, near_components, opposite
from .common import let_workers_import, remove, stash
from .components import connected_components

#: Probability of missing a pair exactly at the threshold; standard deviations of the confidence bound.
MISS, DEVIATIONS = 1e-4, 3.5
#: Vectors of a bucket that are compared in one piece; vectors of a label in one bucket on average.
BLOCK, BUCKET = 1024, 32
BAND = ["label", "band", "part"]


class Codes:
    """Rotations for vectors of one dimension, and the bands of bits drawn from their signs."""

    def __init__(self, dimension: int, threshold: float, rows: int, seed: int = 0):
        self.threshold = threshold
        agree = 1 - math.acos(threshold) / math.pi
        self.width = min(max(round(math.log2(max(rows, 2) / BUCKET)), 6), 30)
        self.bands = math.ceil(math.log(MISS) / math.log(1 - agree**self.width))
        draw = np.random.default_rng([seed, dimension])
        count = max(2, -(-self.bands * self.width // dimension))
        self.rotations = [np.linalg.qr(draw.standard_normal((dimension, dimension)))[0] for _ in range(count)]
        self.bits = draw.permutation(count * dimension)[:self.bands * self.width].reshape(self.bands, self.width)
        self.between = self.rotations[0] @ self.rotations[1].T

    def signs(self, unit: np.ndarray) -> np.ndarray:
        return np.concatenate([unit @ r.T for r in self.rotations], 1) > 0

    def parts(self, signs: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each band."""
        return signs[:, self.bits] @ (1 << np.arange(self.width, dtype=np.int64))

    def coded(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, the first two codes as bytes, and their correction factors."""
        signs, n = self.signs(unit), unit.shape[1]
        factors = np.stack([np.abs(unit @ r.T).sum(1) / math.sqrt(n) for r in self.rotations[:2]], 1)
        return self.parts(signs), np.packbits(signs[:, :2 * n].reshape(-1, 2, n), axis=2), factors

    def may_link(self, codes: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """For all pairs, whether the upper confidence bound of the cosine reaches the threshold."""
        n = len(self.between)
        a, b = (2.0 * np.unpackbits(codes[:, k], axis=1, count=n) - 1 for k in (0, 1))
        both = factors[:, :1] * factors[:, 1]
        estimate = (a @ self.between @ b.T) / n / both
        estimate = (estimate + estimate.T) / 2
        f, g = factors[:, :1] ** 2, factors[:, 1] ** 2
        deviation = np.sqrt((1 - f * g) / (f * g) / (n - 1)) if n > 1 else np.full_like(both, 2.0)
        return estimate + DEVIATIONS * np.maximum(deviation, deviation.T) >= self.threshold


def valid(vector: Column) -> Column:
    """Not null, not empty, not zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def link(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93, seed: int = 0) -> DataFrame:
    """(key, n_links, component_id, kept) of each row: rows of equal label and dimension link at a cosine of ``threshold`` or more.

    Rows of equal vectors are one group to begin with: they link with each other, and a link of one is a link of all. Rows whose
    label or key is null, or whose vector is null, empty, zero or not finite, link with nothing; such a row is its own component. Rows
    repeated under one key count each as a row; different vectors under one key are taken as linked. An empty table stays empty. Other columns are dropped.
    Cosines are computed in double precision from the vectors as they are; no pair below the threshold links.
    """
    spark = df.sparkSession
    let_workers_import(spark)
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("ok", F.col("id").isNotNull() & F.col("label").isNotNull() & valid(F.col("vector")))
    rows = rows.withColumns({"h1": F.when(F.col("ok"), F.xxhash64("label", "vector")),
                             "h2": F.when(F.col("ok"), F.xxhash64(F.lit("second"), "vector", "label"))})
    groups, groups_path = stash(rows.where("ok").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
                                .withColumn("size", F.size("vector")), "vectors")
    sizes = [(r[0], r[1]) for r in groups.groupBy("label", "size").count().groupBy("size").agg(F.max("count")).limit(1000).collect()]
    books = {size: Codes(size, threshold, most, seed) for size, most in sizes}
    shared = spark.sparkContext.broadcast(books)

    def unit(vectors) -> np.ndarray:
        x = np.stack(vectors.to_numpy())
        x = x / np.abs(x).max(1, keepdims=True)  # first to about 1, so that squares neither overflow nor vanish
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, own in batch.groupby("size"):
                book = shared.value[size]
                for at in range(0, len(own), 2000):
                    some = own.iloc[at:at + 2000]
                    parts, codes, factors = book.coded(unit(some["vector"]))
                    n = parts.shape[1]
                    yield pd.DataFrame({"label": np.repeat((some["label"] + f":{size}").to_numpy(), n), "band": np.tile(np.arange(n, dtype=np.int32), len(some)), "part": parts.ravel(),
                                        "rep": np.repeat(some["rep"].to_numpy(), n), "codes": np.repeat(np.array([c.tobytes() for c in codes], object), n),
                                        "f": np.repeat(factors[:, 0], n), "g": np.repeat(factors[:, 1], n), "size": np.int32(size)})

    def by_codes(group: pd.DataFrame) -> pd.DataFrame | None:
        size = int(group["size"].iloc[0])
        codes = np.frombuffer(b"".join(group["codes"]), np.uint8).reshape(len(group), 2, -1)
        some = (shared.value[size].may_link(codes, group[["f", "g"]].to_numpy()) & opposite(group)).any(1)
        return group.loc[some, [*BAND, "rep"]] if some.any() else None

    banded = groups.select("label", "rep", "vector", "size").mapInPandas(bands, "label string, band int, part long, rep long, codes binary, f double, g double, size int")
    near = by_groups(blocked(banded, BAND, "rep", BLOCK), BAND, by_codes, "label string, band int, part long, rep long").distinct()
    with_vectors = near.join(groups.select("rep", "copies", "vector", "size"), "rep")

    def by_vectors(group: pd.DataFrame) -> pd.DataFrame:
        x = unit(group["vector"])
        parts = shared.value[int(group["size"].iloc[0])]
        parts = parts.parts(parts.signs(x))
        own = opposite(group) & (x @ x.T >= threshold)
        for b in range(int(group["band"].iloc[0])):  # a pair counts in the first band that it shares
            own &= parts[:, b][:, None] != parts[:, b]
        reps = group["rep"].to_numpy()
        order = np.argsort(reps, kind="stable")
        low = np.empty(len(reps), np.int64)
        low[order] = reps[order][near_components(own[np.ix_(order, order)])]
        out = pd.DataFrame({"rep": reps, "links": own @ group["copies"].to_numpy(), "low": low})
        return out[(out["links"] > 0)]

    found, found_path = stash(by_groups(blocked(with_vectors, BAND, "rep", BLOCK), BAND, by_vectors, "rep long, links long, low long"), "vector-links")
    parents = connected_components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")), "vector-components")
    links = found.groupBy(F.col("rep").alias("__rep")).agg(F.sum("links").alias("links"))
    each = groups.select("h1", "h2", "rep", "copies").join(links, F.col("rep") == F.col("__rep"), "left").join(parents.withColumnRenamed("node", "__node"), F.col("rep") == F.col("__node"), "left")
    each, _ = stash(each.select("h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("c")), "vector-groups")
    remove(spark, groups_path, found_path)
    out = rows.select("id", "h1", "h2").join(each, ["h1", "h2"], "left")
    component = F.coalesce("c", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
