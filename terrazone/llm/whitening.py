"""Whitening of embeddings: QDWH spectral divide-and-conquer of the covariance, then one broadcast projection.

The covariance of the distinct vectors is summed in tasks. Its eigenvectors come from polar decompositions: the polar factor of the
covariance less a shift is +1 on the eigenspace above the shift and -1 below, so (factor + 1) / 2 projects on the former. The two
invariant subspaces are split again until they are single components. Polar factors are found by the QR-based dynamically weighted
Halley iteration (Nakatsukasa and Higham 2013), which needs neither inverses nor tridiagonal forms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import let_workers_import, remove, stash

#: Components that are returned of each vector; steps of the entries' grid in 1.
COMPONENTS, SCALE = 4, 256
EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its eigenvectors with the signs of its eigenvalues."""
    n = len(a)
    x = a / (np.linalg.norm(a) or 1.0)
    low = min(max(np.linalg.norm(x, -2) * 0.9, EPS / 8), 1.0)  # a bound of the smallest singular value; a rough one costs steps only
    for _ in range(40):
        d = np.cbrt(4 * (1 - low * low) / low**4)
        h = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))[0]
        new = b / c * x + (h - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        new = (new + new.T) / 2
        low = min(low * (h + b * low * low) / (1 + c * low * low), 1.0)
        change, x = np.linalg.norm(new - x), new
        if change <= np.cbrt(4 * EPS) and 1 - low < 1e-8:
            break
    return x


def subspaces(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces, that of the larger eigenvalues first; None where all eigenvalues are equal as rounded."""
    n, middle = len(a), np.trace(a) / len(a)
    size = np.linalg.norm(a)
    if np.linalg.norm(a - middle * np.eye(n)) <= 4 * n * EPS * size:
        return None
    for shift in (np.median(np.diag(a)), middle, middle * (1 + 1e-3) + 1e-3 * np.abs(np.diag(a) - middle).max()):
        projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        # the columns of the projector of the largest norms start the basis; the projector is applied once more to what QR found
        start = projector[:, np.argsort(-np.diag(projector), kind="stable")]
        q = np.linalg.qr(start)[0]
        q = np.linalg.qr(np.hstack([projector @ q[:, :k], (np.eye(n) - projector) @ q[:, k:]]))[0]
        if np.linalg.norm(q[:, :k].T @ a @ q[:, k:]) <= 1e-12 * size:
            return q[:, :k], q[:, k:]
        for _ in range(3):  # a poor start of the basis
            q = np.linalg.qr(np.hstack([projector @ q[:, :k], (np.eye(n) - projector) @ q[:, k:]]))[0]
        return q[:, :k], q[:, k:]
    return None


def components(a: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns, the largest entry of each positive.

    Only subspaces that hold wanted components are split further.
    """
    wanted = len(a) if wanted is None else min(wanted, len(a))
    a = (a + a.T) / 2
    todo, values, vectors = [np.eye(len(a))], [], []
    while todo and len(values) < wanted:
        basis = todo.pop()
        own = basis.T @ a @ basis
        own = (own + own.T) / 2
        halves = subspaces(own) if basis.shape[1] > 1 else None
        if halves is None:
            values += np.diag(own).tolist()
            vectors += list(basis.T)
        else:
            todo += [basis @ halves[1], basis @ halves[0]]
    values, vectors = np.array(values), np.array(vectors).reshape(-1, len(a))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    values = np.einsum("ki,ij,kj->k", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = vectors[order]
    sign = np.sign(vectors[np.arange(len(order)), np.abs(vectors).argmax(1)])
    return values[order], (vectors * sign[:, None]).T


def gridded(vector: Column) -> Column:
    """Entries on a grid of 1/256, as whole numbers; null where the vector is null, empty or holds a null or non-finite entry."""
    v = vector.cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)) & (F.size(v) > 0), F.transform(v, lambda c: F.floor(c * SCALE).cast("long")))


def sums(fit: DataFrame) -> DataFrame:
    """(size, n, s) for each vector length: the number of distinct vectors and their exact sums, each task adding up its own first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for size, own in batch.groupby(batch["x"].map(len)):
                x = np.stack(own["x"].to_numpy())
                if np.abs(x.astype(float)).max() * len(x) >= 2.0**62:  # beyond 64 bits Python's own integers add up
                    x = x.astype(object)
                n, s = held.get(size, (0, 0))
                held[size] = (n + len(x), s + x.sum(0).astype(object))
        for size, (n, s) in held.items():
            yield pd.DataFrame({"size": size, "i": np.arange(size), "n": n, "s": [str(v) for v in s]})

    each = fit.mapInPandas(run, "size int, i int, n long, s string").withColumn("s", F.col("s").cast("decimal(38,0)"))
    each = each.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("string").alias("s"))
    return each.groupBy("size").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda e: e["s"]).alias("s"))


def products(rows: DataFrame, vectors) -> DataFrame:
    """(size, i, j, v) with i <= j: sums of products of the entries of what ``vectors`` makes of a batch's groups, one partial sum a task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for (size, n), own in batch.groupby(["size", "n"]):
                y = vectors(own)
                held[size] = held.get(size, 0.0) + y.T @ y / n
        for size, gram in held.items():
            i, j = np.triu_indices(len(gram))
            yield pd.DataFrame({"size": size, "i": i, "j": j, "v": gram[i, j]})

    return rows.mapInPandas(run, "size int, i int, j int, v double").groupBy("size", "i", "j").agg(F.sum("v").alias("v"))


def centred(own: pd.DataFrame) -> np.ndarray:
    """A batch of vectors of one length less their mean."""
    mean = np.array([int(v) for v in own["s"].iloc[0]], object) / int(own["n"].iloc[0])
    return np.stack(own["x"].to_numpy()).astype(float) - mean.astype(float)


def projected(own: pd.DataFrame) -> np.ndarray:
    """The whitened components of a batch of vectors of one length; NaN where there is no variance."""
    axes = np.array(own["axes"].iloc[0].tolist()).reshape(len(own["values"].iloc[0]), -1)
    with np.errstate(invalid="ignore"):
        return centred(own) @ axes.T / np.sqrt(own["values"].iloc[0])


def deviations(own: pd.DataFrame) -> list[int | None]:
    """The exact sum over dimensions of (n x - S)^2; None beyond 64 bits."""
    x, n, s = np.stack(own["x"].to_numpy()), int(own["n"].iloc[0]), np.array([int(v) for v in own["s"].iloc[0]], object)
    bound = (n * int(np.abs(x.astype(object)).max()) + int(np.abs(s).max())) ** 2 * len(s)
    if bound < 2**63:
        return ((n * x - s.astype(np.int64)) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - s) ** 2).sum(1)
    return [int(v) if v < 2**63 else None for v in exact]


def decompose(grams: DataFrame, wanted: int) -> DataFrame:
    """(size, values, axes, shares): the components of each covariance, from its entries; a covariance is one small matrix."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        size = int(part["size"].iloc[0])
        a = np.zeros((size, size))
        a[part["i"], part["j"]] = a[part["j"], part["i"]] = part["v"]
        values, axes = components(a, wanted)
        total = np.trace(a)
        flat = values <= max(total, 0.0) * size * EPS * 8
        shares = np.where(flat, 0.0, values / (total or 1.0))
        return pd.DataFrame({"size": [size], "values": [np.where(flat, np.nan, values)], "axes": [axes.T.ravel()], "shares": [shares]})

    return grams.groupBy("size").applyInPandas(run, "size int, values array<double>, axes array<double>, shares array<double>")


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Entries c become x = floor(256 c). The covariance is that of the distinct x, with divisor n. ``explained`` is the component's share of the
    trace, ``identity_error`` the largest distance of an entry of the covariance of ``whitened`` over the distinct x from the identity matrix, one value.

    Rows whose vector is null, empty or holds a null or non-finite entry are dropped. Repeated rows have their rows each and count
    once in the fit. Vectors of different lengths are different tables with a fit each; a vector with fewer dimensions than
    ``wanted`` has as many components. A component without variance, as of equal vectors, has null ``whitened``, 0 ``explained`` and no part
    in ``identity_error``. ``deviation`` is null beyond 64 bits. Keys may be null. An empty table gives an empty one. Other columns are dropped.
    """
    spark = df.sparkSession
    let_workers_import(spark)
    rows = df.select(F.col(f"`{key}`").alias("key"), gridded(F.col(f"`{vector}`")).alias("x")).where("x IS NOT NULL")
    fit, fit_path = stash(rows.select("x").distinct(), "whiten-fit")
    means, means_path = stash(sums(fit), "whiten-means")
    sized = lambda t: t.withColumn("size", F.size("x")).join(means, "size")  # noqa: E731  (one row a vector length: Spark broadcasts it)
    axes, axes_path = stash(decompose(products(sized(fit), centred), wanted), "whiten-axes")
    model, model_path = stash(means.join(axes, "size"), "whiten-model")
    placed = lambda t: t.withColumn("size", F.size("x")).join(model, "size")
    white = products(placed(fit), projected).where("NOT isnan(v)")
    error = white.agg(F.max(F.abs(F.col("v") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, own in batch.groupby("size"):
                w, k = projected(own), len(own["shares"].iloc[0])
                found = own["key"].repeat(k).reset_index(drop=True)
                flat = pd.Series(w.ravel())
                yield pd.DataFrame({"key": found, "component": np.tile(np.arange(1, k + 1), len(own)), "n": np.repeat(own["n"].to_numpy(), k),
                                    "deviation": pd.array(deviations(own), "Int64").repeat(k), "whitened": flat.astype(object).where(flat.notna(), None),
                                    "explained": np.tile(own["shares"].iloc[0], len(own))})

    kind = rows.schema["key"].dataType.simpleString()
    out = placed(rows).mapInPandas(run, f"key {kind}, component int, n long, deviation long, whitened double, explained double")
    remove(spark, fit_path, means_path, axes_path)
    return out.select(F.col("key").alias(key), "component", "n", "deviation", "whitened", "explained", F.lit(error).cast("double").alias("identity_error"))
