import math
import os
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrazone.llm import quality
from terrazone.llm.common import marked

TEXTS = ["", None, " \t\n", "one", "a b", "a b c a b c", "a b c x a b c a b", "# & | << > $ 100%* é#", "l one\nl one\n\n \n\nl one\nother\r\nother\n", "x x x x x x", "\U0001F600 ab\x0bcd\x0cef\rgh \x00 z",
         "p q r s p q r", "very " * 300 + "end", "w1 w2 w3 w4 w5 w6 w7 w8 w9 " * 6, " ".join(f"u{i}" for i in range(60))]


def base(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed


def test_base_rules(documents):
    rows = quality.base_rules(quality.with_words(documents(TEXTS), "text")).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in rows} == {i: base(t) for i, t in enumerate(TEXTS)}


def test_scores_follow_the_formula(spark, documents):
    """The same numbers from counts of n-grams in Python; only the hash of an n-gram comes from Spark."""
    texts = [" ".join(f"w{(i * k) % 23}" for k in range(60)) for i in range(12)] + ["", None, "a", "a b"]
    docs, trusted = documents(texts), spark.createDataFrame([(i, i % 2) for i in range(10)] + [(3, 1), (6, 1), (None, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r["quality_score"] for r in quality.judge(docs, trusted.where("quality = 1"), buckets=64).collect()}
    words = {i: (t or "").split() for i, t in enumerate(texts)}
    grams = {i: [(w,) for w in ws] + list(zip(ws, ws[1:])) for i, ws in words.items()}
    flat = sorted({g for gs in grams.values() for g in gs})
    one = {r["a"]: r["h"] for r in spark.createDataFrame([g for g in flat if len(g) == 1], "a string").withColumn("h", F.xxhash64("a")).collect()}
    two = {(r["a"], r["b"]): r["h"] for r in spark.createDataFrame([g for g in flat if len(g) == 2], "a string, b string").withColumn("h", F.xxhash64("a", "b")).collect()}
    bucket = lambda g: (one[g[0]] if len(g) == 1 else two[g]) & 63
    raw = Counter(bucket(g) for gs in grams.values() for g in gs)
    held = {i for i in range(10) if zlib.crc32(str(i).encode()) % quality.CALIBRATION == 0}
    assert held & {1, 3, 5, 6, 7, 9}
    target = Counter(bucket(g) for i, gs in grams.items() if i in {1, 3, 5, 6, 7, 9} - held for g in gs)
    n, t, k, s = sum(raw.values()), sum(target.values()), quality.PRIOR, quality.SMOOTHING
    p = {b: (raw[b] / n + s / 64) / (1 + s) for b in range(64)}
    w = {b: math.log((target[b] / t + k * p[b]) / (1 + k)) - math.log(p[b]) for b in range(64)}
    for i, gs in grams.items():
        assert got[i] == pytest.approx(sum(w[bucket(g)] for g in gs) / len(gs) if gs else 0.0, abs=2e-5)
    ratios = quality.log_ratios(docs, trusted.where("quality = 1"), buckets=64)
    assert quality.threshold(docs, trusted.where("quality = 1"), ratios, buckets=64) is None  # the one document for it repeats itself


def clean_and_junk():
    clean = [" ".join(f"{'abcdefgh'[(i * k) % 8]}{'xyz'[k % 3]}{k % 11}" for k in range(80)) for i in range(1, 60)]
    return clean, [" ".join(w.upper() + "!!" for w in t.split()) for t in clean[:20]]


@pytest.mark.parametrize("buckets", [256, quality.BUCKETS])
def test_junk_goes_and_clean_stays(spark, documents, buckets):
    clean, junk = clean_and_junk()
    # trusted documents of every kind: with even numbers alone none of the words of the odd ones would be known
    trusted = spark.createDataFrame([(i,) for i in range(59) if i % 3], "doc_id long")
    docs = documents(clean + junk)
    rows = quality.judge(docs, trusted, buckets=buckets).where("not base_failed").collect()
    least = min(r["quality_score"] for r in rows if r["doc_id"] < 59 and r["doc_id"] % 3 and zlib.crc32(str(r["doc_id"]).encode()) % quality.CALIBRATION == 0)
    found = quality.threshold(docs, trusted, quality.log_ratios(docs, trusted, buckets=buckets), buckets=buckets)
    assert found == pytest.approx(math.floor(least * quality.STEPS) / quality.STEPS)
    assert all(r["kept"] for r in rows if r["doc_id"] < 59)
    assert not any(r["kept"] for r in rows if r["doc_id"] >= 59)


def test_ten_times_the_rows_get_the_same_verdicts(spark, documents):
    clean, junk = clean_and_junk()
    texts = clean + junk
    trusted = lambda times: spark.createDataFrame([(1000 * k + i,) for k in range(times) for i in range(59) if i % 3], "doc_id long")
    one, ten = (quality.judge(documents([(1000 * k + i, t) for k in range(times) for i, t in enumerate(texts)]), trusted(times)).collect() for times in (1, 10))
    verdict = {r["doc_id"]: r["kept"] for r in one}
    assert all(verdict[r["doc_id"] % 1000] == r["kept"] for r in ten) and len(ten) == 10 * len(one) and set(verdict.values()) == {True, False}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="benchmark tables are not available")
def test_labelled_junk_and_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs.select("doc_id", "text"), labels.where("quality = 1")).where("not base_failed").join(labels, "doc_id")
    share = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[0] < 0.05 and share[1] > 0.98


def test_long_texts_and_clashing_columns(spark, documents):
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    docs = documents([long, long + " end", "short"]).withColumns({"__words": F.lit("mine"), "t": F.lit(1), "bucket": F.lit(2), "quality_score": F.lit("old")})
    rows = {r["doc_id"]: r for r in quality.judge(docs, spark.createDataFrame([(0,), (1,)], "doc_id long")).collect()}
    assert [rows[i]["n_words"] for i in range(3)] == [60_000, 60_001, 1] and rows[0]["base_failed"] and isinstance(rows[0]["quality_score"], float)


def test_without_trusted_documents_and_empty_table(spark, documents):
    docs = documents(TEXTS).selectExpr("*", "1 AS kept", "2 AS n_words")
    trusted = spark.createDataFrame([], "doc_id long")
    rows = quality.judge(docs, trusted).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in rows) and len(rows) == len(TEXTS)
    assert quality.judge(docs.limit(0), trusted).collect() == []
    assert not any(x in quality.judge(docs, trusted)._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))


def test_all_trusted_keys_count(spark):
    keys = quality.keys_of(spark.range(25_000).selectExpr("id AS doc_id").union(spark.range(100).selectExpr("id")), "doc_id")
    assert keys.count() == 25_000


def test_texts_without_a_trusted_key_are_not_shuffled(spark, documents):
    """With trusted keys too many for a broadcast, only rows whose key may be trusted go into a shuffle; repeated rows stay, null keys go."""
    docs = documents([(i, f"text {i}") for i in range(2000)] + [(7, "again"), (None, "x")])
    trusted = spark.createDataFrame([(i,) for i in [*range(0, 100), 10**9, None]], "doc_id long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [r for held in (True, False) for r in quality.trusted_rows(docs, trusted, "text", "doc_id", held).collect()]
        moved = marked(docs, "doc_id", trusted).where("__marked").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((int(r["__trusted"]), r["__text"]) for r in rows) == sorted([(i, f"text {i}") for i in range(100)] + [(7, "again")])
    assert moved < 120


def test_plans_do_not_spell_the_ratios_out(spark, documents):
    """Neither in a projection nor in a filter: the driver keeps each description of a plan."""
    clean, junk = clean_and_junk()
    trusted = spark.createDataFrame([(i,) for i in range(59) if i % 3], "doc_id long")
    judged = quality.judge(documents(clean + junk), trusted)
    kept = judged.where("kept").select("doc_id")
    assert all(len(df._jdf.queryExecution().toString()) < 200_000 for df in (judged, kept))
    assert {r[0] for r in kept.collect()} == {r["doc_id"] for r in judged.collect() if r["kept"]} != set()
    assert not [c for c in judged.columns if c.startswith("__")]
