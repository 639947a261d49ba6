"""General-purpose column expressions: missing values, tolerances, codes and rounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

INF = float("inf")


def col(c) -> Column:
    """A column from a name, an expression, or a plain Python constant."""
    if isinstance(c, str):
        return F.col(c)
    return c if isinstance(c, Column) else F.lit(c)


def finite(c) -> Column:
    """The value as double, or NULL when it is NaN or infinite (missing is always NULL)."""
    d = col(c).cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < F.lit(INF)), d)


def is_finite(c) -> Column:
    return F.coalesce(~F.isnan(col(c).cast("double")) & (F.abs(col(c).cast("double")) < F.lit(INF)), F.lit(False))


def close_enough(a, b, rel: float = 1e-8, abs_tol: float = 1e-8) -> Column:
    """Symmetric relative-or-absolute tolerance test; NULL on either side gives NULL."""
    a, b = col(a), col(b)
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))


def same_or_close(a, b, rel: float = 1e-8, abs_tol: float = 1e-8) -> Column:
    """``close_enough`` with NULL parity: two NULLs agree, one NULL never does."""
    a, b = col(a), col(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(close_enough(a, b, rel, abs_tol))


def ratio(num, den) -> Column:
    """num / den, NULL when the denominator is NULL or zero."""
    n, d = col(num), col(den)
    return F.when(d != 0, n / d)


def blank_to(c, default: str) -> Column:
    """NULL or empty text becomes ``default``."""
    s = col(c).cast("string")
    return F.when(s.isNull() | (s == ""), F.lit(default)).otherwise(s)


def bin_index(value, breaks: list[float]) -> Column:
    """Number of breaks strictly below the value: a value equal to a break stays in the lower bin."""
    v = col(value)
    if not breaks:
        return F.when(v.isNotNull(), F.lit(0))
    return F.when(v.isNotNull(), reduce(lambda a, b: a + b, [(v > F.lit(float(b))).cast("int") for b in breaks]))


def equal_bins(value, lo, hi, bins: int = 4) -> Column:
    """Equal-width bin 0..bins-1 on [lo, hi] with clamping; a constant domain maps to its middle."""
    v, lo, hi = col(value), col(lo), col(hi)
    t = F.when(hi == lo, F.lit(0.5)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio(v - lo, hi - lo))))
    return F.when(v.isNotNull(), F.least(F.lit(bins - 1), F.floor(t * bins)).cast("int"))


def sorted_json(map_col) -> Column:
    """A map as JSON text with its keys in ascending order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(map_col))))


def join_text(*cols, sep: str = " | ") -> Column:
    return F.concat_ws(sep, *[col(c) for c in cols])


def group_key(prefix: str, *dims) -> Column:
    """Group id from dimension codes; dashes become underscores."""
    return F.translate(F.concat_ws("_", F.lit(prefix), *[col(d) for d in dims]), "-", "_")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet (as they do in groupBy); the left key columns are kept."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters and projections cannot inline and evaluate again."""
    return df.withColumn(name, F.explode(F.array(value)))
