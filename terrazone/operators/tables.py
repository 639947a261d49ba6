"""Table views: search, facets, paging, union, distinct references, value bins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import all_of, col


def text_search(df: DataFrame, columns: list[str], text: str | None = None, equals: str | None = None) -> DataFrame:
    """Rows in which any column contains the text (any case) and any column equals the given value."""
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    out = df
    if text:
        out = out.where(F.lower(F.concat_ws("\x1f", *as_text)).contains(text.lower()))
    if equals:
        out = out.where(F.array_contains(F.array(*as_text), F.lit(equals)))
    return out


def facet_values(df: DataFrame, facets: list[str], selected: dict[str, str], cascade: bool = False) -> DataFrame:
    """Values still available per facet, given the other selections (or, cascading, the earlier ones only).

    One scan for all facets: every row emits the facets whose other selections it meets.
    """
    match = {f: F.coalesce(F.col(f).cast("string") == F.lit(selected[f]), F.lit(False)) if selected.get(f) else F.lit(True) for f in facets}
    entries = []
    for i, f in enumerate(facets):
        others = facets[:i] if cascade else [g for g in facets if g != f]
        cond = all_of([match[g] for g in others]) if others else F.lit(True)
        value = F.col(f).cast("string")
        entries.append(F.when(cond & value.isNotNull() & (value != ""), F.struct(F.lit(f).alias("facet"), value.alias("value"))))
    return df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*").distinct()


def sort_page(df: DataFrame, by: str, tie: list[str], page: int, size: int = 20, descending: bool = False) -> DataFrame:
    """One page in the order of a column; ties are broken by key so that pages never overlap."""
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(first, *tie).offset(page * size).limit(size)


def head_limit(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows in a declared order."""
    return df.orderBy(*order).limit(n)


def union_tables(*frames: DataFrame) -> DataFrame:
    """Union by name; the columns are the first table's, then new ones in order of appearance."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_texts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def union_limitations(layers: DataFrame, sources: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
    """Layer limitations, source dispositions and block records in one table."""
    rows = [layers.select("dataset_id", "layer_id", F.lit("source_support").alias("limitation_type"), F.col("limitation").alias("text"), F.lit("NOTE").alias("severity")),
            sources.select("dataset_id", F.lit("source_disposition").alias("limitation_type"), F.col("reason").alias("text"), F.lit("NOTE").alias("severity"))]
    if blocks is not None:
        rows.append(blocks.select("dataset_id", F.lit("availability").alias("limitation_type"), F.col("note").alias("text"), F.lit("BLOCKED").alias("severity")))
    return union_tables(*rows)


def dedupe_assets(references: DataFrame, name: str, ref: list[str]) -> tuple[DataFrame, DataFrame]:
    """(distinct names with their reference count and first reference, every distinct reference as a row).

    References stay rows: a name listed very often is never gathered into one array.
    """
    refs = references.select(name, *ref).distinct()
    names = refs.groupBy(name).agg(F.count("*").alias("reference_count"), F.min(F.struct(*ref)).alias("_f"))
    return names.select(name, "reference_count", *[F.col(f"_f.{r}").alias(f"first_{r}") for r in ref]), refs
