import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrazone.llm import queries, toxicity as tx


def random_documents(rng, n, words=400):
    return [np.unique(rng.integers(0, words, rng.integers(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("block,k,sizes", [(32, 20, (150, 90)), (4, 7, (60, 3)), (8, 500, (40, 40)), (8, 5, (0, 30))])
def test_neighbours_are_exact(block, k, sizes, monkeypatch):
    monkeypatch.setattr(tx, "BLOCK", block)
    rng = np.random.default_rng(3)
    weight = np.where(rng.random(400) < 0.1, 0.0, rng.random(400) * 3)
    classes = [random_documents(rng, n) for n in sizes]
    index = tx.Index(classes, weight)
    def unit(d):
        v = np.zeros(400)
        v[d] = weight[d]
        return v / (np.linalg.norm(v) or 1.0)
    for q in random_documents(rng, 40):
        columns, w = index.vector(q)
        found = index.nearest(columns, w, k)
        if not len(columns):
            assert all(len(i) == 0 for i, _ in found)
            continue
        for (ids, cosines), own in zip(found, classes):
            want = np.sort([unit(d) @ unit(q) for d in own])[::-1][:k] if own else np.zeros(0)
            assert np.allclose(cosines, want, atol=1e-12) and len(set(ids.tolist())) == len(want)
            assert all(abs(unit(own[i]) @ unit(q) - c) < 1e-12 for i, c in zip(ids, cosines))


def test_terms_are_of_whole_texts():
    assert set(tx.terms("One two TWO, one!")) == {zlib.crc32(w.encode()) & (tx.TERMS - 1) for w in ("one", "two")}
    assert len(tx.terms(None)) == len(tx.terms("")) == 0
    assert zlib.crc32(b"last") & (tx.TERMS - 1) in tx.terms("word " * 100_000 + "last")


def test_frequencies_count_all_documents(documents):
    df, n = tx.document_frequencies(documents(["a b b", "b c", None, ""], 2), "text")
    at = lambda w: df[zlib.crc32(w.encode()) & (tx.TERMS - 1)]
    assert n == 4 and (at("a"), at("b"), at("c")) == (1, 2, 1) and df.sum() == 4


@pytest.fixture
def labelled(spark, documents):
    rng = np.random.default_rng(5)
    bad = ["vile", "rotten", "nasty"]
    texts = []
    for i in range(600):
        w = [f"w{j}" for j in rng.integers(0, 80, 40)]
        if i % 4 == 0:
            w[3], w[20] = bad[i % 3], bad[(i + 1) % 3]
        texts.append(" ".join(w))
    return documents(texts), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)], "doc_id long, toxic int")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = tx.fit(docs, labels.where("doc_id % 5 != 0"))
    assert not {i for i in model.toxic_ids + model.clean_ids if i % 5 == 0}
    rows = tx.score(docs, model).where("doc_id % 5 = 0").collect()
    right = [(r["toxicity"]["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in rows]
    assert np.mean(right) > 0.93 and all(0 <= r["toxicity"]["score"] <= 1 for r in rows)
    assert all(len(r["toxicity"]["evidence"]) == 3 for r in rows)


def test_rows(labelled, documents, spark):
    docs, labels = labelled
    model = tx.fit(docs, labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (4, 7)], "doc_id long, toxic int")))
    odd = documents([(1, None), (2, ""), (3, "unknown"), (4, "vile w1 w2"), (4, "vile w1 w2"), (None, "w3 " * 50_000)]).withColumn("toxicity", F.lit(1))
    rows = tx.score(odd, model).collect()
    assert len(rows) == 6 and all(r["toxicity"]["score"] == model.prior and r["toxicity"]["evidence"] == [] for r in rows if r["doc_id"] in (1, 2, 3))
    assert len({r["toxicity"]["score"] for r in rows if r["doc_id"] == 4}) == 1
    assert tx.score(odd.limit(0), model).collect() == []


def test_without_labels_or_documents(labelled, documents):
    docs, labels = labelled
    for d, l in ((docs, labels.limit(0)), (docs, labels.where("toxic = 1")), (docs.limit(0), labels)):
        model = tx.fit(d, l)
        assert model.trees is None and all(r["toxicity"]["score"] == model.prior for r in tx.score(documents(["a", None]), model).collect())


def test_toxic_words_of_few_documents_count(spark, documents):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{j}" for j in rng.integers(0, 300, 30)) for _ in range(4000)]
    for i in range(0, 200, 2):
        texts[i] += f" slur{i // 20}"
    for i in range(0, 200, 40):
        texts[i] += " scarce"
    labels = spark.createDataFrame([(i, int(i % 2 == 0 and i < 200)) for i in range(800)], "doc_id long, toxic int")
    df = documents(texts + ["scarce", "slur3", "slur7 scarce"])
    model = tx.fit(df, labels)
    numbers = model.vocabulary.number
    counts, n = tx.document_frequencies(df, "text", model.vocabulary)
    assert n == 4003 and counts[numbers["scarce"]] == 7 < 0.002 * n
    assert all(model.index.weight[numbers[w]] > 0 for w in ("scarce", "slur3", "slur7"))
    for r in tx.score(df.where("doc_id >= 4000"), model).collect():
        assert r["toxicity"]["score"] > 0.5 and [e["label"] for e in r["toxicity"]["evidence"]] == [1, 1, 1]


def test_words_of_one_hash_are_two_terms():
    seen = {}
    for word in (f"{i * 2654435761 % 2**32:x}" for i in range(10_000)):
        other = seen.setdefault(zlib.crc32(word.encode()) & (tx.TERMS - 1), word)
        if other != word:
            break
    assert other != word and tx.terms(other).tolist() == tx.terms(word).tolist()
    known = tx.Vocabulary({other, word})
    assert known.terms(other).tolist() != known.terms(word).tolist() and len(known.terms(f"{word} {other} unknown")) == 2


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="benchmark tables are not available")
def test_held_out_accuracy_on_the_shared_tables(spark):
    rows = queries.QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.03
