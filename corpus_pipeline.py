"""From raw documents to training pieces, in five stages: quality rules, near-duplicates, personal data, source mixing, sampled pieces.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet below the shared folder and read again as the next
stage's documents, so a lost executor repeats a part of one stage. All stages but the last return the columns of ``docs``, those with
other names included; columns that operators add on the way do not replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrazone.llm import mixing, ngram_join, personal_data, quality, sampled_pieces
from terrazone.llm.common import let_workers_import, remove, stash, without

#: Near-duplicates share this percentage of their n-grams of so many words.
WORDS, PERCENT = 5, 80


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns beside each whole row as one struct, which keeps its columns apart from those of an operator."""
    return docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))


def unpacked(df: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""
    return df.select(*[changed.get(c, F.col("document")[c]).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and reach the threshold of the log-likelihood ratio; those labelled good are the target.

    Null and empty texts have too few words and go. Repeated rows stay or go together.
    """
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col("quality") == 1)
    return unpacked(quality.judge(packed(docs, "doc_id", "text"), trusted).where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id; of rows equal in id and text one stays, always the same.

    Different texts under one id are different documents; of near-duplicates among them that of the smaller hash stays. Documents with an empty text are
    in no group. A row with a null id cannot be named in a group and stays.
    """
    named = docs.where(F.col("doc_id").isNotNull())
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        groups = ngram_join.join(named.select("doc_id", "text"), size=WORDS, percent=PERCENT)
        removed = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
        return without(docs, "doc_id", removed)
    # ids repeat: the different pairs of id and text are numbered in the order of ids
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    each = named.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.xxhash64(F.lit("second"), "text").alias("h2"), "text", row.alias("document"))
    pairs, _ = stash(each.select("id", "h", "h2").distinct().orderBy("id", "h", "h2").withColumn("number", F.monotonically_increasing_id()), "numbered")
    once = each.join(pairs, ["id", "h", "h2"]).groupBy("number").agg(F.min_by("document", F.xxhash64("document")).alias("document"))
    once, _ = stash(once, "once")
    groups = ngram_join.join(once.select("number", F.col("document")["text"].alias("text")), key="number", size=WORDS, percent=PERCENT)
    removed = groups.where(F.col("number") != F.col("component_id")).select("number")
    kept = without(once, "number", removed).select(*[F.col("document")[c].alias(c) for c in docs.columns])
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def personal_data_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind; ``n_chars`` follows the new text. Null texts stay null."""
    let_workers_import(spark)
    clean = personal_data.redact(packed(docs, "doc_id", "text"), personal_data.fit(docs.select("doc_id", "text")))
    changed = {"text": F.col("text")} | ({"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return unpacked(clean, docs, **changed)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes of it, none included. Texts without words are not taken; null is a source."""
    mixed = mixing.mix(packed(docs, "doc_id", "text", "source"))
    copies = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return unpacked(copies, docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces, pieces, lossless): a sampled segmentation of each document. Null and empty texts have no pieces."""
    let_workers_import(spark)
    cut = sampled_pieces.encode(docs.select("doc_id", "lang", "source", "text"), lossless="lossless")
    return cut.select("doc_id", "lang", "source", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "lossless")


STAGES = [("quality rules", quality_rules), ("n-gram join", near_duplicates), ("personal data", personal_data_redacted), ("source mix", source_mix), ("sampled pieces", pieces)]
#: Hashes, trees and draws of the stages are not those of SQL engines; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all documents."""
    let_workers_import(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs, path = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
