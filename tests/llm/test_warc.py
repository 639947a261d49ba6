import gzip
import hashlib
import io
from base64 import b32encode

import pytest

from terrazone.llm import warc
from terrazone.llm.common import shared_path

SCHEMA = "page_id long, url string, html string, record_type string"
ROWS = [(1, "http://a/1", "<p>same</p>", "x"), (2, "http://a/2", "<p>same</p>", "x"), (9, None, "<p>same</p>", "x"), (3, "http://b/\r\n3", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n", "x"),
        (4, "http://c", None, "x"), (5, "http://c", "", "x"), (6, "http://d", "é\U0001F600" * 50_000, "x"), (7, "http://e", "once\r\n\r\n", "x"), (7, "http://e", "once\r\n\r\n", "x"), (None, "http://f", "nameless", "x")]


def written(spark, rows, **options):
    path = shared_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), path, **options)
    return path


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip(spark, least):
    got = warc.read_archives(spark, written(spark, ROWS, least_bytes=least, records=3)).collect()
    body = {id(r): (r[2] or "").encode() for r in ROWS}
    want = []
    for r in ROWS:
        same = [x[0] for x in ROWS if body[id(x)] == body[id(r)] and x[0] is not None] if len(body[id(r)]) >= least else [r[0]]
        first = max(same) if same else None
        digest = b32encode(hashlib.sha1(body[id(r)]).digest()).decode()
        kind = "response" if r[0] == first else "revisit"
        want.append((kind, r[0], len(body[id(r)]), digest, None if kind == "response" else first, body[id(r)] if kind == "response" else None))
    key = lambda x: str(x[:5])
    assert sorted([(r["record_type"], r["page_id"], r["payload_bytes"], r["payload_digest"], r["refers_to"], bytes(r["payload"]) if r["payload"] is not None else None) for r in got], key=key) == sorted(want, key=key)
    assert {r["url"] for r in got if r["page_id"] == 3} == {"http://b/3"} and {r["url"] for r in got if r["page_id"] == 9} == {None}
    assert len({r["record_id"] for r in got}) == len({(r[0], r[2] or "") for r in ROWS})


def test_empty_table(spark):
    assert warc.read_archives(spark, written(spark, [])).collect() == []


def test_a_changed_payload_is_found():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nWARC-Payload-Digest: sha1:" + b32encode(hashlib.sha1(b"ab").digest()) + b"\r\nContent-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nab\r\n\r\n"
    good = good.replace(b"Content-Length: 23", b"Content-Length: 21")
    assert [r[3] for r in warc.parsed(io.BytesIO(good))] == [2]
    with pytest.raises(ValueError):
        list(warc.parsed(io.BytesIO(good.replace(b"ab\r\n\r\n", b"aB\r\n\r\n"))))
    assert gzip.decompress(gzip.compress(good)) == good
