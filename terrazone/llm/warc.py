"""WARC archives with identical payloads stored once: later copies become revisit records of one response.

Only headers are shuffled by payload digest; the response of a digest is joined to its revisit records, and payloads are fetched
for responses alone. Spark's text sink writes the records (each ends with the two line ends that close a WARC record), so
that every Hadoop file system and Spark's own commit of tasks serve; an archive is one gzip stream.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from base64 import b32encode
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import computed_once

END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FETCHED = "2024-01-01T00:00:00Z"
#: Records in an archive file at most.
RECORDS = 10_000
# fixed values: the digits of base 32 as Spark writes them and as RFC 4648 does
DIGITS, ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
READ = "record_type string, page_id long, url string, payload_bytes long, payload_digest string, record_id string, refers_to long, payload binary"


def base32(hexes: Column) -> Column:
    """40 hex digits of a SHA-1 in base 32: five hex digits are four base-32 digits."""
    parts = [F.lpad(F.conv(F.substring(hexes, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), DIGITS, ALPHABET)


def record_id(key: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("~")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def headers(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """key, url, n (payload bytes), digest and payload of each page."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.translate(F.col(url).cast("string"), "\r\n", "").alias("url"), F.octet_length(body).cast("long").alias("n"), body.alias("payload"))
    return computed_once(rows, "hexes", F.sha1(F.col("payload").cast("binary"))).withColumn("digest", base32(F.col("hexes"))).drop("hexes")


def resolve(heads: DataFrame, least_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The response of each digest (digest, n, first_key, first_url), and the headers which revisit one.

    Among equal payloads of ``least_bytes`` or more the largest key is the response; smaller payloads are all responses.
    """
    large = heads.where(F.col("n") >= least_bytes)
    first = (large.groupBy("digest", "n").agg(F.max(F.struct("key", "url")).alias("first"))
             .select("digest", "n", F.col("first.key").alias("first_key"), F.col("first.url").alias("first_url")))
    revisits = large.join(first, ["digest", "n"]).where(~F.col("key").eqNullSafe(F.col("first_key")))
    return first, revisits


def field(name: str, value: Column) -> Column:
    """A header line, absent where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def record(kind: str, payload: Column, *more: Column) -> Column:
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("n").cast("string"), F.lit(END + END))
    block = F.concat(http, payload)
    return F.concat(F.lit(f"WARC/1.1{END}WARC-Type: {kind}{END}"), field("WARC-Record-ID", record_id(F.col("key"), F.col("digest"))), field("WARC-Date", F.lit(FETCHED)),
                    field("WARC-Target-URI", F.col("url")), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), *more,
                    field("X-Page-Id", F.col("key")), field("X-Payload-Length", F.col("n")), field("Content-Type", F.lit("application/http;msgtype=response")),
                    field("Content-Length", F.octet_length(block)), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, records: int = RECORDS) -> None:
    """Write a response or a revisit record for each page.

    A null payload is empty, a null url has no target line, a null key no page line. Rows repeated with the same key and payload
    name the same record; each of them is a response. An empty table writes an archive without records. Line ends inside a url are left out; other columns are ignored.
    """
    heads = headers(pages, key, url, payload)
    first, revisits = resolve(heads.drop("payload"), least_bytes)
    chosen = first.select(F.col("first_key").alias("k"), F.col("digest").alias("d"), F.col("n").alias("b"))
    responses = heads.where(F.col("n") >= least_bytes).join(chosen, F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d")) & (F.col("n") == F.col("b")))
    body = F.col("payload")
    small = heads.where(F.col("n") < least_bytes) if least_bytes > 0 else None
    lines = responses.select(record("response", body).alias("value"))
    if small is not None:
        lines = lines.unionByName(small.select(record("response", body).alias("value")))
    again = revisits.select(record("revisit", F.lit(""), field("WARC-Profile", F.lit(PROFILE)), field("WARC-Refers-To", record_id(F.col("first_key"), F.col("digest"))),
                                   field("WARC-Refers-To-Target-URI", F.col("first_url")), field("X-Refers-To-Page-Id", F.col("first_key"))).alias("value"))
    lines.unionByName(again).write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


def parsed(stream) -> Iterator[tuple]:
    """The records of an archive in READ's order; a response's payload must match its digest."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b": ")
            fields[name.decode()] = value.decode()
        block = stream.read(int(fields["Content-Length"]))
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        body = block.partition(b"\r\n\r\n")[2]
        if kind == "response" and b32encode(hashlib.sha1(body).digest()).decode() != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not match its digest")
        number = lambda x: int(fields[x]) if x in fields else None
        yield kind, number("X-Page-Id"), fields.get("WARC-Target-URI"), len(body) if kind == "response" else number("X-Payload-Length"), digest, fields["WARC-Record-ID"], number("X-Refers-To-Page-Id"), body if kind == "response" else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below a folder. A file is unpacked as a stream; payloads are checked against their digests and, unless wanted, dropped."""
    names = [x.split()[0] for x in READ.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for r in parsed(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))):
                    rows.append(r if payloads else (*r[:-1], None))
                    if len(rows) == 500:
                        yield frame(rows)
                        rows = []
                if rows:
                    yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to")})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(read, READ)
