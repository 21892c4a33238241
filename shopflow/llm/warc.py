"""WARC archives: written with payload revisits, read back and assembled.

A capture is three records: the request, the response (or a revisit, which
keeps the HTTP headers and leaves the payload out) and a metadata record.
Response and metadata name the request in WARC-Concurrent-To; the reader
joins the three through it and gives one nested row per capture.  Files are
written by Spark's text writer (one row is one capture, payloads are UTF-8),
so commits and retries are Spark's own, and gzipped; they are read as whole
files of at most ``captures_per_file`` captures.
"""

from __future__ import annotations

import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 1000
CAPTURES_PER_FILE = 4096
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def _record(kind: str, headers: list, block) -> F.Column:
    """One record without the two line ends that close it."""
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}\r\n")]
    lines += [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))).otherwise(F.lit("")) for k, v in headers]
    return F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_END), block)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  captures_per_file: int = CAPTURES_PER_FILE) -> None:
    """Of equal payloads of at least MIN_REVISIT_BYTES the one with the
    largest id is the response and the others revisit it; smaller ones, and
    rows that repeat that id and payload, are responses.  A null html is
    empty; a null url is left out; control characters of a url are
    percent-encoded; a null id is written as 'null' and revisits like any."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), html.alias("html"),
                        F.octet_length(html).cast("long").alias("bytes"), F.sha1(html.cast("binary")).alias("digest"))
    # small payloads need no partner: they are spread by their id, not gathered by digest
    newest = (rows.filter(F.col("bytes") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.max("id").alias("newest"), F.count("*").alias("c"))
              .filter("c > 1").select("digest", "newest"))
    rows = rows.join(newest, "digest", "left").withColumn(
        "refers", F.when((F.col("bytes") >= MIN_REVISIT_BYTES) & ~F.col("id").eqNullSafe(F.col("newest")), F.col("newest")))
    rows = rows.withColumn("capture", F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")))
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    uri = F.col("url")
    for code in (*range(32), 127):
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}")) if code in (0, 9, 10, 13) else uri
    at = lambda i: F.concat(F.lit("<urn:page:"), i, F.lit(":"), F.col("digest"), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(_END))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    get = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1" + _END))
    request = _record("request", [("WARC-Record-ID", F.col("capture")), ("WARC-Target-URI", uri),
                                  ("Content-Type", F.lit("application/http; msgtype=request"))], get)
    common = [("WARC-Record-ID", at(name)), ("WARC-Concurrent-To", F.col("capture")), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", digest), ("Content-Type", F.lit("application/http; msgtype=response"))]
    answer = F.when(F.col("refers").isNull(), _record("response", common, F.concat(http, F.col("html")))).otherwise(
        _record("revisit", [*common, ("WARC-Profile", F.lit(PROFILE)),
                            ("WARC-Refers-To", at(F.col("refers").cast("string")))], http))
    meta = _record("metadata", [("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))),
                                ("WARC-Concurrent-To", F.col("capture")), ("Content-Type", F.lit("application/warc-fields"))],
                   F.concat(F.lit("page-id: "), name, F.lit("\r\n")))
    (rows.select(F.concat(request, F.lit(_END), answer, F.lit(_END), meta).alias("value")).write
     .option("lineSep", _END).option("maxRecordsPerFile", captures_per_file).option("compression", "gzip").text(path))


_SCHEMA = ("concurrent_to string, kind string, record_id string, target_uri string, refers_to string, "
           "declared_digest string, payload_bytes long, payload_digest string, page_id string, payload string")
_PAGE = re.compile(r"^<urn:page:(-?\d+):")


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}


def _parse(data: bytes):
    """(headers, block) of each record, by Content-Length alone."""
    at, n = 0, len(data)
    while at < n:
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        head = _headers(data[at:end])
        size = int(head["content-length"])
        if end + 4 + size > n:
            raise ValueError(f"record at byte {at} is cut short")
        yield head, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archive's files."""
    kinds = [pa.string()] * 6 + [pa.int64()] + [pa.string()] * 3
    names = [f.split()[0] for f in _SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                data = content.as_py()
                for head, block in _parse(gzip.decompress(data) if data.startswith(b"\x1f\x8b") else data):
                    kind = head["warc-type"]
                    own = head["warc-record-id"]
                    size = digest = page = payload = None
                    if kind in ("response", "revisit"):
                        http, _, body = block.partition(b"\r\n\r\n")
                        if kind == "response":
                            size, digest = len(body), hashlib.sha1(body).hexdigest()
                            payload = body.decode("utf-8", "replace") if with_payload else None
                        else:
                            size = int(_headers(http).get("content-length", 0))
                            digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    elif kind == "metadata":
                        page = next((v for k, v in _headers(b"\r\n" + block).items() if k == "page-id"), None)
                    rows.append((head.get("warc-concurrent-to") or own, kind, own, head.get("warc-target-uri"), head.get("warc-refers-to"),
                                 head.get("warc-payload-digest"), size, digest, page, payload))
                    if len(rows) == 2048:
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, _SCHEMA)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: the request, the response or revisit, and
    the metadata that share a concurrent-to identifier.  The three-way outer
    join is one keyed aggregation, so the records cross the network once; a
    capture that lacks a record has null there."""
    def one(kinds, *fields):
        return F.first(F.when(F.col("kind").isin(*kinds), F.struct(*fields)), ignorenulls=True)

    return records.groupBy("concurrent_to").agg(
        one(["request"], "record_id", "target_uri").alias("request"),
        one(["response", "revisit"], "kind", "record_id", "target_uri", "refers_to", "declared_digest", "payload_bytes",
            "payload_digest", "payload").alias("response"),
        one(["metadata"], "record_id", "page_id").alias("metadata"))


def page_of(record_id):
    """The page id inside a record id of ``write_archive``."""
    return F.regexp_extract(record_id, _PAGE.pattern, 1)
