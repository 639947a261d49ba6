import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrazone.llm import spelling


def brute(docs, least=6, often=5, times=5, every=199):
    """(word, form, root, n, n_near, form_n) by trying all edits of all words."""
    found = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            found[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    words = {w: n for w, n in found.items() if len(w) >= least and n >= often}
    letters = {c for w in words for c in w}
    forms, near_of = {}, {}
    for w in words:
        near = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i + k:] for i in range(len(w) + 1) for c in letters for k in (0, 1)}
        near_of[w] = near = [v for v in near if v in words and v != w]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= times * words[w] else None

    def root(w):
        return root(forms[w]) if forms[w] else w
    return sorted((w, forms[w] or "", root(w), words[w], len(near_of[w]), words.get(forms[w], 0)) for w in words)


def got(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


@pytest.mark.parametrize("partitions", [1, 8, 40])
def test_against_all_edits(spark, documents, partitions):
    draw = np.random.default_rng(partitions)
    base = ["".join(draw.choice(list("abcéÿ"), draw.integers(3, 7))) for _ in range(60)]
    texts = []
    for _ in range(300):
        words = [base[i] for i in np.minimum(draw.zipf(1.3, 20) - 1, len(base) - 1)]
        at = draw.integers(0, 20)
        words[at] = words[at][:2] + str(draw.choice(["", "a", "É", "x"])) + words[at][3:]
        texts.append(" ".join(words))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))  # nodes are shared between few and many ranges
    try:
        out = got(spelling.group(documents(texts), least=3, often=2, times=2, every=5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = brute(list(enumerate(texts)), 3, 2, 2, 5)
    assert out == want and any(f and r != f for _, f, r, *_ in want)


def test_counts_cases_and_chains(spark, documents):
    word = "Straße-Übung ABCDEFÀ abcdefÀ abcdefà 12 abc"
    chain = " ".join(["planet"] * 200 + ["planets"] * 40 + ["planetsx"] * 8 + ["aabbcc"] * 30 + ["aabbc"] + ["aabbbc"] * 6 + ["aabbbcc"] * 6)
    rows = [(i, word) for i in range(5)] + [(7, chain), (8, None), (9, ""), (10, " 1 _ "), (None, "nothing nothing"), (None, "nothing nothing nothing")]
    out = got(spelling.group(documents(rows), every=1 << 40))
    assert out == brute(rows, every=1 << 40)
    by_word = {r[0]: r for r in out}
    assert by_word["planetsx"][1:3] == ("planets", "planet") and by_word["nothing"][3] == 5 and "abcdefÀ" in by_word and "straße" in by_word
    assert by_word["aabbbcc"][1:] == ("aabbcc", "aabbcc", 6, 2, 30)  # deleting any of three b is one neighbour


def test_very_long_runs_ties_and_one_common_prefix(spark, documents):
    long = "q" * 30_000
    many = [f"prefix{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    rows = [(i, f"{long} {long}z " + " ".join(many) + " prefixaj prefixja" * (10 * (i > 3))) for i in range(6)] * 2
    out = {r[0]: r for r in got(spelling.group(documents(rows), every=1 << 40))}
    assert len(out) == 102 and out[long][3:5] == (12, 1) and out[long][1] == ""
    assert {out[w][4] for w in many} == {18}
    assert out["prefixaj"][3] == out["prefixja"][3] == 52 and out["prefixjj"][1] == "" and {out[w][1] for w in ("prefixaa", "prefixbj")} == {""}
    tied = {r[0]: r[1] for r in got(spelling.group(documents(rows), times=4, every=1 << 40))}
    assert tied["prefixjj"] == tied["prefixaa"] == "prefixaj" and tied["prefixjb"] == "prefixja"  # of equal counts the first in code points
    with pytest.raises(ValueError):
        spelling.group(documents(rows), times=1)


def test_empty_table_and_clashing_columns(spark, documents):
    assert spelling.group(documents([])).collect() == [] and spelling.group(documents([None, "", "short"])).collect() == []
    df = documents(["variant variant variant", "variants variant variant"]).withColumn("word", F.lit("w")).withColumn("n", F.lit(0)).withColumn("id", F.lit(1))
    assert got(spelling.group(df, every=1 << 40)) == [("variant", "", "variant", 5, 0, 0)]
