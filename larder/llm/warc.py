"""WARC archives of captures: writing, reading and transaction assembly.

A capture is three records: the request, the response (or a revisit, if a record with an
equal payload is the response) and metadata. Request and metadata name the response's
record id in ``WARC-Concurrent-To``. Archives are gzip files of WARC/1.1 records, written
by Spark's text sink (a record's closing blank lines are the line separator); readers go
by ``Content-Length``, so a payload may hold anything. Assembly joins the records through
their concurrent-to identifiers and emits one nested row for each capture.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import scratch_path
from .common import map_arrow, materialise, quoted, table

CRLF = "\r\n"
#: Payload bytes for one archive file.
ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(hex_digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: five hex digits are four base32 digits."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, k + 1, 5), 16, 32), 4, "0") for k in range(0, 40, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(key: Column, role: str) -> Column:
    h = F.md5(F.concat(key, F.lit(f"/{role}")).cast("binary"))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def _record(kind: Column | str, record_id: Column, headers: list[tuple[str, Column]], block: Column, mime: str) -> Column:
    """One record without its closing blank lines; headers with a null value are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind if isinstance(kind, Column) else F.lit(kind)),
             F.concat(F.lit("WARC-Record-ID: <"), record_id, F.lit(">")), F.lit(f"WARC-Date: {DATE}"),
             *[F.concat(F.lit(f"{name}: "), value) for name, value in headers],
             F.lit(f"Content-Type: {mime}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def write_archives(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write each row of ``pages`` as a capture under ``out``.

    Of rows with equal payloads that with the largest id is the response and the others
    revisit it (a null id is below all; of repeated rows one is the response). A null
    payload is empty, a null url has no target, blanks and controls in urls are escaped. An
    empty table gives no captures.
    """
    body = F.coalesce(quoted(body_col), F.lit(""))
    url = F.regexp_replace(quoted(url_col), r"[\x00-\x20\x7F]", "%20")
    rows = pages.select(quoted(id_col).cast("bigint").alias("id"), url.alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha1(F.col("body").cast("binary")))
    name = F.concat_ws("/", F.coalesce(F.col("id").cast("string"), F.lit("none")), "digest")
    slim = rows.select("id", "digest", name.alias("key"))
    owners = slim.groupBy("digest").agg(F.max("id").alias("owner"))
    chosen = slim.distinct().join(owners, "digest").select("key", "owner")
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    archives = max(1, ceil(total / archive_bytes), min(2 * pages.sparkSession.sparkContext.defaultParallelism, ceil(total / (4 << 20))))
    rows = rows.withColumn("key", name).repartition(archives, "key").withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy("key")))
    rows = rows.join(chosen, "key")

    key = F.concat_ws("/", "key", F.col("copy").cast("string"))
    owner_key = F.concat_ws("/", F.coalesce(F.col("owner").cast("string"), F.lit("none")), "digest", F.lit("1"))
    is_owner = F.col("id").eqNullSafe(F.col("owner")) & (F.col("copy") == 1)
    rid, target, digest = _urn(key, "response"), ("WARC-Target-URI", F.col("url")), F.concat(F.lit("sha1:"), base32_sha1(F.col("digest")))
    size = F.octet_length("body").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF * 2))
    concurrent = ("WARC-Concurrent-To", F.concat(F.lit("<"), rid, F.lit(">")))
    request = _record("request", _urn(key, "request"), [target, concurrent], F.concat(
        F.lit("GET "), F.coalesce(F.regexp_replace("url", "^[a-z]+://[^/]*", ""), F.lit("/")), F.lit(f" HTTP/1.1{CRLF}Host: "),
        F.coalesce(F.regexp_extract("url", "^[a-z]+://([^/]*)", 1), F.lit("")), F.lit(CRLF * 2)), "application/http; msgtype=request")
    refers = F.when(~is_owner, F.concat(F.lit("<"), _urn(owner_key, "response"), F.lit(">")))
    profile = F.when(~is_owner, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    response = _record(F.when(is_owner, "response").otherwise("revisit"), rid,
                       [target, ("WARC-Payload-Digest", digest), ("WARC-Refers-To", refers), ("WARC-Profile", profile)],
                       F.concat(http, F.when(is_owner, F.col("body")).otherwise("")), "application/http; msgtype=response")
    metadata = _record("metadata", _urn(key, "metadata"), [target, concurrent], F.concat(
        F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(CRLF)), "application/warc-fields")
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", CRLF * 2).option("compression", "gzip").text(out)


RECORD_SCHEMA = ("type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
                 "payload_digest string, payload_bytes long, fields map<string,string>, payload binary")


def _records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of the records of one archive, one after another."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is cut short")
        yield headers, block


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives under ``path``.

    Payload digest and size are taken from the payload where the record has one, else the
    digest from the header. A cut or malformed record is an error, not a lost row.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bare = lambda s: s.strip("<>") if s else s
        kinds = [pa.string()] * 6 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            for content in batch.column("content"):
                out, held = [], 0
                for h, block in _records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())))):
                    kind, digest, size, payload, fields = h["warc-type"], None, None, None, None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size = len(payload)
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    elif kind == "revisit":
                        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    elif kind == "metadata":
                        pairs = (x.partition(":") for x in block.decode().split(CRLF) if x)
                        fields = [(n.strip(), v.strip()) for n, _, v in pairs]
                    out.append((kind, bare(h["warc-record-id"]), bare(h.get("warc-concurrent-to")), bare(h.get("warc-refers-to")),
                                h.get("warc-target-uri"), digest, size, fields, payload if payloads else None))
                    held += len(block) if payloads else 400
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return map_arrow(files, work, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One row (capture, target_uri, request, response, metadata) for each capture.

    A capture is a response or revisit with the request and metadata records concurrent to
    it; the three are structs, null where a record is missing. Records concurrent to nothing
    that was read still give a row, with a null response.
    """
    part = lambda kinds, key, name, *fields: (records.where(F.col("type").isin(*kinds)).select(
        F.coalesce(F.col(key), F.col("record_id")).alias("capture"), F.col("target_uri").alias(f"{name}_uri"), F.struct(*fields).alias(name)))
    response = part(("response", "revisit"), "record_id", "response", "record_id", "type", "refers_to", "payload_digest", "payload_bytes", "payload")
    request = part(("request",), "concurrent_to", "request", "record_id")
    metadata = part(("metadata",), "concurrent_to", "metadata", "record_id", "fields")
    return (response.join(request, "capture", "full_outer").join(metadata, "capture", "full_outer")
            .select("capture", F.coalesce("response_uri", "request_uri", "metadata_uri").alias("target_uri"), "request", "response", "metadata"))


def capture_report(captures: DataFrame) -> DataFrame:
    """Per response or revisit: page id, full payload's size and digest, type, and the page id
    of the response that a revisit refers to. A revisit's size is that of its response."""
    flat = captures.where("response IS NOT NULL").select(
        "capture", F.col("metadata.fields")["page-id"].try_cast("bigint").alias("page_id"), "response.payload_bytes", "response.payload_digest",
        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("refers"))
    owners = flat.where("record_type = 'response'").select(
        F.col("capture").alias("refers"), F.col("page_id").alias("owner"), F.col("payload_bytes").alias("owner_bytes"), F.col("payload_digest").alias("owner_digest"))
    return flat.join(owners, "refers", "left").select(
        "page_id", F.coalesce("payload_bytes", "owner_bytes").alias("payload_bytes"), F.coalesce("owner_digest", "payload_digest").alias("payload_digest"),
        "record_type", F.col("owner").alias("refers_to"))


def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), out)
    records = materialise(read_records(spark, out, payloads=False), "warc-records")
    return capture_report(materialise(assemble(records), "warc-captures"))


#: The same rows in SQL. DuckDB has no base32: five hex digits are 20 bits, four base32 digits.
OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
o AS (SELECT d, max(page_id) AS owner FROM p GROUP BY d),
b AS (SELECT d, list_aggregate(list_transform(range(0, 32), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          ((('0x' || substr(d, (k // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (k % 4))::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS b32
      FROM (SELECT DISTINCT d FROM p))
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM p JOIN o USING (d) JOIN b USING (d)
"""
