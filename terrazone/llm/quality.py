"""Quality rules: counts of words, symbols and repetition, and a hashed n-gram log-likelihood ratio. Built-in functions only.

Words and pairs of neighbouring words are hashed into buckets. One pass counts the buckets over all documents (the raw
corpus) and over four fifths of the trusted ones (the target). The others, a fixed fifth by check sum of their key, are scored by the mean logarithm of
target over raw probability of their n-grams; the threshold is the score that all but a small share of them reach. A last pass scores every
document and keeps it if it reaches the threshold. Both the prior and the smoothing are shares of the totals, so a corpus ten times as large,
with ten times as many trusted documents, gets the same ratios.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import computed_once
from .common import WORD, having, stash

#: Buckets (a power of two) of hashed n-grams; grams which the target is taken to share with the raw corpus beforehand, and which the
#: raw corpus is taken to have in all buckets alike, as shares of their grams.
BUCKETS, PRIOR, SMOOTHING = 1 << 16, 0.1, 0.05
#: One in so many trusted documents is for the threshold; the share of these that may lie below it; steps of scores in 1.
CALIBRATION, BELOW, STEPS = 5, 0.005, 10_000
# fixed values: the base rules
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
SYMBOLS = "[#*$%&|<>]"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_words(df: DataFrame, text: str) -> DataFrame:
    return computed_once(df, "__words", F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD), F.lit(0)))


def first(values: Column, n: Column, begin: int = 1) -> Column:
    """``n`` entries from the ``begin``-th on, none if ``n`` is below 0."""
    return F.slice(values, begin, F.greatest(n, F.lit(0)))


def with_hashes(df: DataFrame) -> DataFrame:
    """Add the 64-bit hashes of the words and of the pairs of neighbours, which all later steps share."""
    words, pairs = F.col("__words"), F.size("__words") - 1
    out = computed_once(df, "__hashes", F.transform(words, lambda w: F.xxhash64(w)))
    return computed_once(out, "__pairs", F.zip_with(first(words, pairs), first(words, pairs, 2), lambda w, x: F.xxhash64(w, x)))


def repeated_words(hashes: Column, pairs: Column) -> Column:
    """Words covered by three-word windows that occur twice or more.

    Windows are 64-bit hashes of a pair's and a word's hash. Where all are distinct nothing else is done; else the windows are sorted, those equal to a neighbour are
    repeated, and each position adds the words up to the next repeated one, three at most.
    """
    n = F.size(hashes) - 2
    windows = F.zip_with(first(pairs, n), first(hashes, n, 3), lambda p, h: F.xxhash64(p, h))

    def positions(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(p, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])

    def counted(ws: Column) -> Column:
        ordered = F.sort_array(F.transform(ws, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0)).otherwise(let(ordered, lambda s: covered(positions(s))))

    return let(windows, counted).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(WORD))), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def base_rules(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the hashes, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed; needs the columns of ``with_words``."""
    whole, words = F.coalesce(F.col(text).cast("string"), F.lit("")), F.col("__words")
    out = with_hashes(df).withColumns({"n_words": F.size(words).cast("long"), "word_chars": F.length(F.array_join(words, "")).cast("long"),
                          "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"), "n_dup_lines": duplicate_lines(whole)})
    out = computed_once(out, "n_repeat_words", repeated_words(F.col("__hashes"), F.col("__pairs")))
    return out.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))


def in_bucket(h: Column, buckets: int) -> Column:
    return h.bitwiseAND(F.lit(buckets - 1)).cast("int")


def bucket(*words: Column | str, buckets: int) -> Column:
    return in_bucket(F.xxhash64(*words), buckets)


def keys_of(trusted: DataFrame, key: str) -> DataFrame:
    """All distinct trusted keys, and whether each is for the threshold."""
    names = trusted.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("__trusted")).distinct()
    return names.withColumn("__held", F.crc32(F.col("__trusted").cast("binary")) % CALIBRATION == 0)


def trusted_rows(df: DataFrame, trusted: DataFrame, text: str, key: str, held: bool) -> DataFrame:
    """(__trusted, __text) of the documents with a trusted key, those for the threshold or the others."""
    names = keys_of(trusted, key).where(F.col("__held") == held)
    return having(df.select(F.col(key).cast("string").alias("__trusted"), F.col(text).alias("__text")), "__trusted", names)


def log_ratios(df: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS, prior: float = PRIOR) -> Column:
    """The logarithm of target over raw probability of each bucket, as an array of ``buckets`` numbers that plans read as a scalar subquery; 0 without a target.

    So no plan spells the numbers out, each of whose descriptions the driver would keep.

    ``trusted`` names trusted documents by ``key``. Bucket counts are summed inside each task before they are shuffled. No texts are
    shuffled but those of trusted documents.
    """
    def counted(rows: DataFrame, n: str) -> DataFrame:
        words = F.col("__words")
        grams = with_words(rows, "__text").select(F.explode(F.arrays_zip(words.alias("w"), first(words, F.size(words) - 1, 2).alias("x"))).alias("g"))
        each = F.array(bucket("g.w", buckets=buckets), F.when(F.col("g.x").isNotNull(), bucket("g.w", "g.x", buckets=buckets)))
        return grams.select(F.explode(each).alias("bucket")).where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.count(F.lit(1)).alias(n))

    target = counted(trusted_rows(df, trusted, text, key, False), "t")
    counts = df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counted(df.select(F.col(text).alias("__text")), "n"), "bucket", "left").join(target, "bucket", "left")
    ordered = F.array_sort(F.collect_list(F.struct("bucket", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("t", F.lit(0)).alias("t"))))
    row = counts.agg(ordered.alias("c"), F.coalesce(F.sum("n"), F.lit(0)).alias("raw"), F.coalesce(F.sum("t"), F.lit(0)).alias("target"))
    p = lambda c: (c["n"] / F.col("raw") + SMOOTHING / buckets) / (1 + SMOOTHING)
    weight = lambda c: F.when(F.col("target") > 0, F.log((c["t"] / F.col("target") + prior * p(c)) / (1 + prior)) - F.log(p(c))).otherwise(0.0)
    ratios, _ = stash(row.select(F.transform("c", lambda c: F.round(weight(c), 5)).alias("ratios")), "ratios")
    return ratios.scalar()


def threshold(df: DataFrame, trusted: DataFrame, ratios: Column, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS, below: float = BELOW) -> float | None:
    """The score that all but a share of the trusted documents left out of the target reach; None if none of them passes the base rules.

    Scores are counted in steps, so the result is exact to a step, the same in every run, and takes no more room for more documents.
    """
    passed = base_rules(with_words(trusted_rows(df, trusted, text, key, True), "__text"), "__text").where("NOT base_failed")
    scored = with_score(passed, ratios, buckets).select(F.floor(F.col("quality_score") * STEPS).alias("step"))
    steps = scored.groupBy("step").agg(F.count(F.lit(1)).alias("n"))
    reached = steps.withColumns({"up_to": F.sum("n").over(Window.orderBy("step")), "all": F.sum("n").over(Window.partitionBy())})
    found = reached.where(F.col("up_to") > F.col("all") * below).agg(F.min("step")).first()[0]
    return None if found is None else found / STEPS


def with_score(df: DataFrame, ratios: Column, buckets: int = BUCKETS) -> DataFrame:
    """Add the mean log-ratio of the n-grams of a document; 0 without words. Needs the columns of ``with_hashes``."""
    out, hashes = df.withColumn("__ratios", ratios), F.concat("__hashes", "__pairs")
    total = F.aggregate(hashes, F.lit(0.0), lambda a, h: a + F.get(F.col("__ratios"), in_bucket(h, buckets)))
    return out.withColumn("quality_score", F.when(F.size("__words") > 0, total / (2 * F.size("__words") - 1)).otherwise(0.0)).drop("__ratios")


def judge(df: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS, least: float | None = None) -> DataFrame:
    """Add the base counts, ``base_failed``, the document's ``quality_score`` and ``kept``; ``least`` is a threshold of the score other than that of the trusted documents.

    A null text has no words and fails the base rules, as does an empty one. Repeated rows get equal verdicts and count as often as they
    stand there. Without trusted documents, or where none of those for the threshold passes the base rules, the base rules decide. An empty table stays
    empty; other columns pass through, and columns of the added names are replaced.
    """
    ratios = log_ratios(df, trusted, text, key, buckets)
    least = threshold(df, trusted, ratios, text, key, buckets) if least is None else least
    out = with_score(base_rules(with_words(df, text), text), ratios, buckets)
    return out.withColumn("kept", ~F.col("base_failed") & (F.lit(least is None) | (F.col("quality_score") >= F.lit(least)))).drop("__words", "__hashes", "__pairs")
