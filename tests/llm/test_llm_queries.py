"""Every query of this part on the small tables: against its SQL where there is one, else its columns and types."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from terrazone.llm import queries

FOLDER = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not available")
COLUMNS = {
    "op1_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op2_vector_duplicates": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op3_rendezvous_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op4_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op5_quality_ratio": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op6_warc_revisits": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op7_source_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_personal_data": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_sampled_pieces": "doc_id bigint, n_pieces bigint",
    "op11_pitman_yor_scores": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op12_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op13_whitened_vectors": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
}
ROWS = {"op13_whitened_vectors": 4}  # rows of each key
KEY = {"op2_vector_duplicates": ("embeddings", "vec_id"), "op13_whitened_vectors": ("embeddings", "vec_id"), "op6_warc_revisits": ("pages", "page_id")}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = driver.queries()[name](spark, FOLDER)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes).startswith(COLUMNS[name])
    rows = df.collect()
    source, key = KEY.get(name, ("documents", "doc_id"))
    if key in df.columns:
        assert sorted(r[key] for r in rows) == sorted(r[key] for r in spark.read.parquet(f"{FOLDER}/{source}.parquet").select(key).collect() for _ in range(ROWS.get(name, 1)))
    if (sql := driver.oracle_sql().get(name)) is None:
        return
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {source} AS SELECT * FROM '{FOLDER}/{source}.parquet'")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    near = lambda a, b: math.isclose(a, b, rel_tol=1e-9) if isinstance(a, float) else a == b
    want = sorted((tuple(x[names.index(c)] for c in df.columns) for x in got.fetchall()), key=lambda r: [str(v) for v in r if not isinstance(v, float)])
    for a, b in zip(sorted((tuple(r) for r in rows), key=lambda r: [str(v) for v in r if not isinstance(v, float)]), want, strict=True):
        assert all(map(near, a, b)), (a, b)


def test_names():
    assert set(COLUMNS) == set(queries.QUERIES) and driver.queries()["pipeline"] is corpus_pipeline.run
