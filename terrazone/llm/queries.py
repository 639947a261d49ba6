"""One query per operator over the shared tables, with SQL where SQL can state its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import table
from . import mixing, near_vectors, ngram_join, personal_data, pitman_yor, quality, sampled_pieces, sharding, spelling, token_count, toxicity, warc, whitening
from .common import let_workers_import, shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, d: str) -> DataFrame:
            let_workers_import(spark)
            return fn(spark, d)
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return register


@query("op1_token_counts")
def op1_token_counts(spark, d):
    """No SQL: a BPE model is no table; the tests compare with the library."""
    counted = token_count.count_tokens(table(spark, d, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


SHARDS = 40
#: The table of CRC-32 and the check sum of the bytes of a text, for SQL.
CRC_TABLE = """c AS (SELECT range n, range c, 0 k FROM range(256) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM c WHERE k < 8),
 crc AS (SELECT list(c ORDER BY n) t FROM c WHERE k = 8)"""


def crc_sql(x: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen({x})), lambda i: ('0x' || substr(hex(encode({x})), 2 * i::INT + 1, 2))::BIGINT)), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295)"


@query("op3_rendezvous_shards", f"""WITH RECURSIVE {CRC_TABLE},
 d AS (SELECT doc_id, strlen(coalesce(text, '')) + 16 size, {crc_sql("coalesce(text, '')")} text_crc32,
  array_to_string(list_transform(range({-(-(SHARDS + 1) // 4)}), lambda b: md5(coalesce(doc_id::VARCHAR, '~') || ':' || b)), '') h FROM documents, crc),
 s AS (SELECT doc_id, size, text_crc32, list_aggregate(list_transform(range({SHARDS}), lambda s: {{'x': ('0x' || substr(h, 8 * s::INT + 1, 8))::BIGINT, 's': -s}}), 'max') a, list_aggregate(list_transform(range({SHARDS + 1}), lambda s: {{'x': ('0x' || substr(h, 8 * s::INT + 1, 8))::BIGINT, 's': -s}}), 'max') b FROM d)
 SELECT doc_id, size::BIGINT size, text_crc32::BIGINT text_crc32, 'key' law, (-a.s)::INT shard, row_number() OVER (PARTITION BY a.s ORDER BY md5(concat_ws(':', coalesce(doc_id::VARCHAR, '~'), text_crc32, size)), doc_id, text_crc32, size) - 1 slot, (-b.s)::INT grown_shard FROM s""")
def op3_rendezvous_shards(spark, d):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, d, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.assign(docs, "doc_id", [1.0] * SHARDS, grown=1.0)
    return sharding.number_slots(placed, "shard", ["doc_id", "text_crc32", "size"]).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op6_warc_revisits", """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) n, sha1(coalesce(html, '')) h FROM pages),
 r AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) first FROM p)
 SELECT page_id, n::BIGINT payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 5 * (i // 4)::INT + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END record_type, CASE WHEN page_id = first THEN NULL ELSE first END refers_to FROM r""")
def op6_warc_revisits(spark, d):
    path = shared_path(spark, "warc")
    warc.write_archives(table(spark, d, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_source_mix", r"""WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) size, md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, '~'), md5(coalesce(text, '~')))) k FROM documents),
 s AS (SELECT source, sum(size)::DOUBLE n, 3.0 * sum(size) cap, 1.0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 w FROM d GROUP BY source),
 o AS (SELECT *, row_number() OVER (ORDER BY cap / w, source) i, sum(n) OVER () - sum(cap) OVER (ORDER BY cap / w, source) + cap l, sum(w) OVER () - sum(w) OVER (ORDER BY cap / w, source) + w r FROM s),
 level AS (SELECT min_by(l / r, i) v FROM o WHERE l / r <= cap / w),
 t AS (SELECT source, n::BIGINT source_size, least(cap, v * w) target, floor(least(cap, v * w) + 1e-6)::BIGINT budget FROM s, level),
 e AS (SELECT d.*, t.source_size, t.target, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END epochs, CASE WHEN source_size > 0 THEN budget % source_size ELSE 0 END rest, sum(size) OVER (PARTITION BY d.source ORDER BY k) - size AS before FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
 SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT taken FROM e""")
def op7_source_mix(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_quality_ratio")
def op5_quality_ratio(spark, d):
    """No SQL: the buckets are xxHash values, which SQL engines do not share."""
    trusted = table(spark, d, "labels").where(F.col("quality") == 1)
    return quality.judge(table(spark, d, "documents").select("doc_id", "text"), trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_score")


@query("op8_personal_data")
def op8_personal_data(spark, d):
    """No SQL: boosted trees select the added spans."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = personal_data.find_spans(docs, personal_data.fit(docs))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


@query("op10_sampled_pieces")
def op10_sampled_pieces(spark, d):
    """No SQL: a segmentation is drawn from a lattice."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    cut = sampled_pieces.encode(docs, lossless="lossless")
    return cut.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "lossless")


@query("op9_toxicity")
def op9_toxicity(spark, d):
    """No SQL: nearest neighbours and trees; the tests measure held-out accuracy and compare the neighbours with brute force."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = toxicity.fit(docs, table(spark, d, "labels").where(fold != 0))
    held_out = F.coalesce(fold == 0, F.lit(False)).alias("held_out")
    found = toxicity.score(docs, model).select("doc_id", held_out, F.col("toxicity.score").alias("score"), F.get("toxicity.evidence", F.lit(0))["key"].alias("nearest_doc_id"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "nearest_doc_id")


@query("op2_vector_duplicates")
def op2_vector_duplicates(spark, d):
    """No SQL: the codes draw rotations at random; the tests compare with all pairs."""
    return near_vectors.link(table(spark, d, "embeddings"))


@query("op4_ngram_join")
def op4_ngram_join(spark, d):
    """No SQL: all pairs of whole tables are too slow there; the tests compare with all pairs of a small one."""
    return ngram_join.join(table(spark, d, "documents"), size=3, percent=90)


@query("op13_whitened_vectors")
def op13_whitened_vectors(spark, d):
    """No SQL: eigenvectors; the tests compare with a dense decomposition of the same covariance."""
    return whitening.whiten(table(spark, d, "embeddings"))


@query("op12_spelling_variants", f"""WITH RECURSIVE {CRC_TABLE},
 r AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' k, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run FROM documents),
 h AS (SELECT run, n, {crc_sql("(k || run)")} h FROM (SELECT k, run, count(*) n FROM r WHERE length(run) >= 6 GROUP BY k, run), crc),
 w AS (SELECT word, sum(n)::BIGINT n FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END word FROM h) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
 d AS (SELECT word, length(word) l, i, substr(word, 1, i) || substr(word, i + 2) d FROM (SELECT word, unnest(range(length(word))) i FROM w)),
 p AS (SELECT a.word, b.word o FROM d a JOIN d b ON a.d = b.d AND a.i = b.i AND a.l = b.l AND a.word <> b.word UNION SELECT d.word, w.word FROM d JOIN w ON d.d = w.word UNION SELECT w.word, d.word FROM d JOIN w ON d.d = w.word),
 f AS (SELECT p.word, count(*) n_near, arg_min(o, {{'n': -w.n, 'o': o}}) best FROM p JOIN w ON p.o = w.word GROUP BY p.word),
 o AS (SELECT w.word, w.n, coalesce(n_near, 0) n_near, CASE WHEN b.n >= 5 * w.n THEN b.word END form, CASE WHEN b.n >= 5 * w.n THEN b.n END form_n FROM w LEFT JOIN f USING (word) LEFT JOIN w b ON f.best = b.word),
 chain AS (SELECT word, word node FROM o UNION ALL SELECT chain.word, o.form FROM chain JOIN o ON chain.node = o.word WHERE o.form IS NOT NULL),
 root AS (SELECT chain.word, node root FROM chain JOIN o ON chain.node = o.word WHERE o.form IS NULL)
 SELECT o.word, form, root, n, n_near, form_n FROM o JOIN root USING (word)""")
def op12_spelling_variants(spark, d):
    return spelling.group(table(spark, d, "documents"))


@query("op11_pitman_yor_scores")
def op11_pitman_yor_scores(spark, d):
    """No SQL: seating is sampled; the tests compare with a plain sampler and the counts with brute force."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    scored = pitman_yor.evaluate(docs, pitman_yor.training(F.col("doc_id")))
    return scored.select("doc_id", (~pitman_yor.training(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
