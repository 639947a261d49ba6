import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from terrazone.llm import mixing, personal_data, quality
from terrazone.llm.common import shared_path, stash
from test_ngram_join import brute as brute_join
from test_mixing import brute as brute_mix

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not available")


@needs_tables
def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in cp.STAGES:
        tables.append(stash(stage(spark, tables[-1], FOLDER), "stage")[0])
    raw, clean, once, private, mixed, pieces = [[r.asDict() for r in t.collect()] for t in tables]
    assert all(t.columns == columns for t in tables[:-1])
    trusted = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1")
    kept = {r["doc_id"] for r in quality.judge(docs, trusted).where("kept").collect()}
    assert sorted(map(str, clean)) == sorted(str(r) for r in raw if r["doc_id"] in kept)
    groups = brute_join([(r["doc_id"], r["text"]) for r in clean], cp.WORDS, cp.PERCENT)
    assert sorted(map(str, once)) == sorted(str(r) for r in clean if groups[r["doc_id"]][1] == r["doc_id"]) and len(once) < len(clean)
    assert len(private) == len(once) and all(not personal_data.propose(r["text"])[0] and r["n_chars"] == len(r["text"]) for r in private)
    same = {r["doc_id"]: r["text"] for r in private}
    assert all(same[r["doc_id"]] == r["text"] for r in once if not re.search(r"[@0-9]", r["text"]))
    taken = brute_mix([(r["doc_id"], r["text"], r["source"]) for r in private])
    found = {}
    for r in mixed:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + 1
        assert r["text"] == same[r["doc_id"]]
    for k, (size, _, _, words) in taken.items():
        assert found.get(k, 0) in (words // size, words // size + 1)
        assert found.get(k, 0) - words // size == int(2 * (words % size) >= size and words % size > 0) if found.get(k, 0) <= 3 else False
    assert len(pieces) == len(mixed) and all(r["lossless"] and r["n_pieces"] == len(r["pieces"]) for r in pieces)


@needs_tables
def test_run(spark):
    rows = cp.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "lang", "source", "n_pieces", "pieces", "lossless"] and rows.count() > 0


@pytest.fixture
def folder(spark):
    path = shared_path(spark, "labels-test")
    spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, size string, copies int, document string, spans int, component_id int"


def odd_rows():
    text = " ".join(f"word{i}" for i in range(60))
    full = lambda i, t, source="a": (i, t, "en", source, len(t) if t else None, 5, "s", 7, "d", 1, 2)
    return [full(1, text), full(1, text), full(2, text), full(3, None), full(4, ""), full(None, text + " x", None), full(None, None, None), full(5, text.upper() + " mail a@b.cd " * 3, None), full(6, "w " * 30_000), full(7, " ".join(f"v{i}" for i in range(20_000)), "b"),
            (8, text + " more of it here and there", None, None, None, None, None, None, None, None, None)]


def test_odd_rows(spark, folder):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    for name, stage in cp.STAGES[:-1]:
        out = stash(stage(spark, docs, folder), "odd")[0]
        assert out.dtypes == docs.dtypes, name
        before = {(r["doc_id"], r["kept"], r["size"], r["copies"], r["spans"]) for r in docs.collect()}
        assert {(r["doc_id"], r["kept"], r["size"], r["copies"], r["spans"]) for r in out.collect()} <= before
        docs = out
    ids = [r["doc_id"] for r in docs.collect()]
    assert 3 not in ids and 4 not in ids and 6 not in ids
    assert all(r["lossless"] for r in cp.pieces(spark, docs, folder).collect())


def test_every_stage_takes_odd_and_empty_tables(spark, folder):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), folder).collect() == [], name
        stage(spark, docs, folder).collect()
    once = cp.near_duplicates(spark, docs, folder).collect()
    assert sum(r["doc_id"] == 1 for r in once) == 1 and not any(r["doc_id"] == 2 for r in once)
    assert sum(r["doc_id"] is None for r in once) == 2
    assert cp.personal_data_redacted(spark, docs, folder).where(F.col("text").contains("a@b.cd")).count() == 0
    assert mixing.mix(docs).count() == docs.count()


def test_different_texts_under_one_id_stay(spark, folder):
    text = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(60))
    rows = [(7, text, "en"), (7, other, "en"), (7, other, "en"), (7, other + " x", "de"), (8, text, "en"), (9, None, "en"), (9, None, "en"), (9, "", "en"), (None, text, "en"), (None, text, "en")]
    for partitions in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(partitions)
        kept = [(r["doc_id"], (r["text"] or "")[:8]) for r in cp.near_duplicates(spark, docs, folder).collect()]
        assert sorted(kept, key=str) == sorted([(7, "word0 wo"), (7, "other0 o"), (9, ""), (9, ""), (None, "word0 wo"), (None, "word0 wo")], key=str)
