"""WARC archives with duplicate payloads resolved into revisit records.

Duplicates are found on headers alone: every page's payload digest and length is grouped, the smallest page_id of a group
is its response and the rest revisit it. Grouping keeps one minimum per digest before the shuffle; the join that brings
it back to the pages shuffles their html once. The archives are written with fresh headers by
Spark's text sink: one record per row, records separated by the two line breaks that the format asks for. Reading
streams each archive through the decompressor, parses it by content length, one record in memory at a time, and resolves
revisits against the responses that they name.

Null html is an empty payload. A null url leaves out its header; a record with a null page_id is named after its payload. Rows that repeat the page_id of a group's
response are responses too. Line breaks in a url are percent-encoded. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import arrow_type, map_arrow

BREAK = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORDS_PER_FILE = 2000
BATCH_BYTES = 4 << 20

# Digits of Spark's base 32 and the letters of base32 in the same order.
_DIGITS, _LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 base32 letters: every 5 hex digits are 4 letters."""
    text = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(text, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), _DIGITS, _LETTERS)


def resolve(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type and refers_to of every page.

    Payloads under ``least`` bytes are all responses.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"),
                        base32_sha1(html.cast("binary")).alias("payload_digest"))
    first = (rows.select("payload_digest", "payload_bytes", "page_id").where(F.col("payload_bytes") >= least)
             .groupBy("payload_digest", "payload_bytes")
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    revisit = F.coalesce(F.col("first_id") != F.col("page_id"), F.col("first_id").isNotNull())
    return (rows.join(first, ["payload_digest", "payload_bytes"], "left")
            .select("page_id", "url", "html", "payload_bytes", "payload_digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first_id")).alias("refers_to")))


def _record(page: DataFrame) -> Column:
    response = F.col("record_type") == "response"
    block = F.when(response, F.concat(F.lit(HTTP), F.col("html"))).otherwise(F.lit(HTTP))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat_ws(
        BREAK, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.coalesce(F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.col("page_id").cast("string"), F.lit(">")),
                   F.concat(F.lit("WARC-Record-ID: <urn:payload:"), F.col("payload_digest"), F.lit(">"))),
        F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(~response, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(~response, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(BREAK * 2), block)


def write(resolved: DataFrame, path: str) -> None:
    """One record per row of ``resolve``'s result, in gzip files of at most ``RECORDS_PER_FILE`` records."""
    (resolved.select(_record(resolved).alias("value")).write.option("lineSep", BREAK * 2)
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    while first := archive.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record where {first[:40]!r} stands")
        head = {}
        while (line := archive.readline().rstrip(b"\r\n")):
            name, value = line.decode().split(": ", 1)
            head[name] = value
        size = int(head["Content-Length"])
        block = archive.read(size)
        if len(block) < size:
            raise ValueError("an archive ends inside a record")
        yield head, block
        archive.read(4)


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_digest, payload (null for revisits) and payload_bytes of every
    record. A response's digest is computed anew and must equal the one in its header."""
    schema = ("page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary, "
              "payload_bytes long")

    def page(text: str | None) -> int | None:
        return int(text.removeprefix("<urn:page:").rstrip(">")) if text and text.startswith("<urn:page:") else None

    def record(head: dict[str, str], block: bytes) -> tuple:
        digest, payload = head["WARC-Payload-Digest"].removeprefix("sha1:"), None
        if head["WARC-Type"] == "response":
            payload = block.split(b"\r\n\r\n", 1)[1]
            if b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError("a payload differs from its digest")
        return (page(head.get("WARC-Record-ID")), head.get("WARC-Target-URI"), head["WARC-Type"],
                page(head.get("WARC-Refers-To")), digest, payload, None if payload is None else len(payload))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_type(schema)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(out)],
                                              schema=out)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                with gzip.open(pa.BufferReader(content.as_buffer())) as archive:
                    for head, block in parse(archive):
                        rows.append(record(head, block))
                        size += len(block) + 500
                        if size > BATCH_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return map_arrow(files, run, schema)


def headers(records: DataFrame) -> DataFrame:
    """Records without payloads, revisits completed from the responses that they refer to."""
    slim = records.drop("payload")
    originals = (slim.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"))
                 .agg(F.min("payload_bytes").alias("original_bytes")))
    return (slim.join(originals, "refers_to", "left")
            .select("page_id", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"), "payload_digest",
                    "record_type", "refers_to"))
