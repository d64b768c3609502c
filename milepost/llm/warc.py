"""WARC archives with revisit records: resolve copies, write, read back.

Headers (digest, size, identifier) are resolved first: they are grouped by payload digest
with partial sums before the shuffle, and only digests that occur twice or more come back
to the pages. The archives are written by Spark's own text writer, one record per row with
the record separator as line end, so they land in whatever store the folder names and a
lost task is simply written again. Files are read back whole and unpacked as a stream.

A null payload counts as empty. Payloads below ``MIN_REVISIT_BYTES`` are always responses.
Of equal payloads the largest identifier is the response; repeated rows of that identifier
are responses as well, rows without an identifier refer to it, and if no row has an
identifier all are responses. White space and control characters in an address are
percent-encoded; a null address has no target header. An empty table gives no archive and
an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import datetime as dt
import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.session import stage_folder, staged

MIN_REVISIT_BYTES = 1000
# Spark reads whole files below 2 GiB: an archive of so many pages stays below, however many there are.
ARCHIVE_RECORDS = 20_000
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "record_id string, record_type string, page_id long, url string, date string, refers_to_id string, "
    "refers_to long, payload_digest string, payload_bytes long, payload binary"
)


def headers(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    return pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("n"),
        F.coalesce(F.col(html), F.lit("")).alias("payload"),
    )


def originals(found: DataFrame) -> DataFrame:
    """Per payload that occurs twice or more: the page that holds the response."""
    return (
        found.filter(F.col("n") >= MIN_REVISIT_BYTES)
        .groupBy(F.col("digest").alias("copy"))
        .agg(F.count("*").alias("copies"), F.max(F.struct("page_id", "url")).alias("first"))
        .filter("copies > 1 AND first.page_id IS NOT NULL")
        .select("copy", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    )


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("/", page.cast("string"), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _address(url: Column) -> Column:
    """The address without characters that would end a header line."""
    for sign, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        url = F.replace(url, F.lit(sign), F.lit(code))
    return F.regexp_replace(url, r"\p{Cntrl}", "%7F")


def _line(name: str, value: Column) -> Column:
    """A header line, null (and so left out) where the value is null."""
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def records(pages: DataFrame, first: DataFrame, date: str) -> DataFrame:
    """One text per page: its WARC record without the separator that ends it."""
    # Small payloads have no partner; a key of their own keeps them from meeting in one task.
    own = F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.md5("payload")))
    joined = pages.withColumn(
        "copy", F.when(F.col("n") >= MIN_REVISIT_BYTES, F.col("digest")).otherwise(own)
    ).join(first, "copy", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    response_head = F.concat_ws(
        CRLF,
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        _line("Content-Length", F.col("n")),
        F.lit(""),
        F.lit(""),
    )
    only = lambda value: F.when(revisit, value)
    block_bytes = F.octet_length(response_head) + F.when(revisit, F.lit(0)).otherwise(F.col("n"))
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _address(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        only(_line("WARC-Profile", F.lit(PROFILE))),
        only(_line("WARC-Refers-To", _record_id(F.col("first_id"), F.col("digest")))),
        only(_line("WARC-Refers-To-Target-URI", _address(F.col("first_url")))),
        only(_line("WARC-Refers-To-Date", F.lit(date))),
        _line("Source-Id", F.col("page_id")),
        only(_line("Refers-To-Source-Id", F.col("first_id"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        _line("Content-Length", block_bytes),
    )
    payload = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    return joined.select(F.concat(head, F.lit(CRLF * 2), response_head, payload).alias("value"))


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str | None = None,
) -> None:
    """Write deduplicated archives (gzip) of all pages to ``folder``."""
    date = date or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    found = headers(pages, key, url, html)
    first = originals(staged(found.drop("payload")))
    out = records(found, first, date)
    out.write.option("maxRecordsPerFile", ARCHIVE_RECORDS).text(folder, compression="gzip", lineSep=CRLF * 2)


def parse(stream: io.BufferedIOBase) -> Iterator[dict]:
    """Records of one archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        head = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8").partition(": ")
            head[name.lower()] = value
        block = stream.read(int(head["content-length"]))
        http, _, payload = block.partition(b"\r\n\r\n")
        sent = dict(x.partition(": ")[::2] for x in http.decode("utf-8").split(CRLF)[1:])
        number = lambda name: int(head[name]) if name in head else None
        yield {
            "record_id": head["warc-record-id"],
            "record_type": head["warc-type"],
            "page_id": number("source-id"),
            "url": head.get("warc-target-uri"),
            "date": head["warc-date"],
            "refers_to_id": head.get("warc-refers-to"),
            "refers_to": number("refers-to-source-id"),
            "payload_digest": head["warc-payload-digest"].removeprefix("sha1:"),
            "payload_bytes": int(sent["Content-Length"]),
            "payload": payload if head["warc-type"] == "response" else None,
        }


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all archives of a folder; a revisit has no payload of its own."""
    schema = pa.schema(
        [
            (x.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]])
            for x in RECORDS.split(", ")
        ]
    )

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if size > 8_000_000 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(unpacked, RECORDS)


def archive_folder(spark: SparkSession) -> str:
    """A new shared folder, removed with the stage tables of the application."""
    return stage_folder(spark)
