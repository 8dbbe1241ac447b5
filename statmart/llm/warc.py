"""WARC archives: writing captures with revisit records, reading them back, and assembling transactions.

A capture is three records: the request, the response (or a revisit of an equal payload) and metadata. Request and
metadata name the response by WARC-Concurrent-To. Archives are gzip files of text whose "line end" is the two empty
lines after a WARC record, so Spark's own text sink writes them in parallel and commits them as one. They are read as
lines, one task per file from its beginning, and every record takes as many bytes as its Content-Length says.
"""

from __future__ import annotations

import hashlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import checkpointed
from .shared import as_scan, join_on_hot_key, numbered

# Fixed values of the format.
CRLF, GAP = "\r\n", "\r\n\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"       # what conv() writes

CAPTURES_PER_FILE = 20_000


def base32_sha1(data: Column) -> Column:
    """Upper-case base-32 SHA-1."""
    return base32(F.sha1(data))


def base32(digest: Column) -> Column:
    """40 hexadecimal digits in base 32: ten at a time are a number of eight digits, which then get their letters."""
    digits = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), DIGITS, BASE32)


def _record_id(kind: str) -> Column:
    """The same for the same row in every evaluation; distinct between rows, also repeated ones."""
    h = F.md5(F.concat_ws(":", F.lit(kind), F.col("row").cast("string"), F.col("key").cast("string"), "url"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column | str, record_id: Column, headers: list[tuple[str, Column]], body: Column) -> Column:
    lines = [F.concat(F.lit(f"{n}: "), F.translate(v, "\r\n", "  "), F.lit(CRLF)) for n, v in headers]
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(
        F.lit(f"{VERSION}{CRLF}WARC-Type: "), kind, F.lit(f"{CRLF}WARC-Record-ID: "), record_id, F.lit(CRLF),
        F.concat(*[F.coalesce(line, F.lit("")) for line in lines]), F.lit("Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(GAP), body)


def prepared(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Pages with their digest, and whether an earlier page has the same payload.

    ``row``, ``key``, ``url``, ``payload``, ``payload_bytes``, ``payload_digest``, ``first`` (the key and row of the
    response). Of equal payloads of at least ``min_bytes`` bytes the smallest key is the response (a null key comes last,
    repeated keys go by row). Null html is empty.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    slim = numbered(as_scan(pages).select(
        F.col(key).alias("key"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), payload.alias("payload")), "row")
    known = slim.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    copies = checkpointed(known.groupBy("sha1").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row", "url")).alias("first"), F.count("*").alias("_n")))
    # written on its own, so that the size Catalyst plans the join by is that of the repeated payloads only
    firsts = checkpointed(copies.filter("_n > 1").select("sha1", "first"))
    return join_on_hot_key(known, firsts, "sha1", sizes=copies.select("sha1", "_n")).select(
        "row", "key", "url", "payload", "payload_bytes", base32(F.col("sha1")).alias("payload_digest"),
        F.when(F.col("payload_bytes") >= min_bytes, F.col("first")).alias("first"))


def write_archives(pages: DataFrame, path: str, captures_per_file: int = CAPTURES_PER_FILE, **columns) -> None:
    """Write request, response or revisit, and metadata records of every page below ``path``."""
    p = prepared(pages, **columns)
    repeats = F.coalesce(F.col("first.row") != F.col("row"), F.lit(False))
    target = F.struct(F.col("first.row").alias("row"), F.col("first.key").alias("key"), F.col("first.url").alias("url"))
    own = _record_id("response")
    p = p.withColumn("own", own).withColumn("repeats", repeats)
    referred = p.select("*", target.alias("t")).select(
        "*", F.when(F.col("repeats"), F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
            F.md5(F.concat_ws(":", F.lit("response"), F.col("t.row").cast("string"), F.col("t.key").cast("string"), F.col("t.url"))),
            "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))).alias("refers"))
    uri = ("WARC-Target-URI", F.when(F.col("url") != "", F.col("url")))
    page = ("WARC-Page-Key", F.col("key").cast("string"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest")))
    response = _record(
        F.when(F.col("repeats"), "revisit").otherwise("response"), F.col("own"),
        [uri, page, digest, ("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
         ("WARC-Refers-To", F.col("refers")), ("WARC-Refers-To-Key", F.when(F.col("repeats"), F.col("first.key").cast("string"))),
         ("WARC-Profile", F.when(F.col("repeats"), F.lit(REVISIT_PROFILE))), ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{GAP}"),
                 F.when(F.col("repeats"), "").otherwise(F.col("payload"))))
    concurrent = ("WARC-Concurrent-To", F.col("own"))
    request = _record("request", _record_id("request"), [uri, concurrent, ("Content-Type", F.lit("application/http; msgtype=request"))],
                      F.concat(F.lit("GET "), F.regexp_replace("url", "[\r\n ]", "%20"), F.lit(f" HTTP/1.1{GAP}")))
    metadata = _record("metadata", _record_id("metadata"), [uri, concurrent, ("Content-Type", F.lit("application/warc-fields"))],
                       F.concat(F.lit("pageKey: "), F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(CRLF)))
    referred.select(F.explode(F.array(request, response, metadata)).alias("value")).write.option("lineSep", GAP).option(
        "compression", "gzip").option("maxRecordsPerFile", 3 * captures_per_file).text(path)


RECORD = ("record_id string, record_type string, concurrent_to string, target_uri string, page_key string, refers_to string, "
          "refers_to_key string, declared_digest string, declared_length bigint, payload binary, payload_digest string, "
          "payload_bytes bigint, content_length bigint")
_ARROW = pa.schema([*[(n, pa.string()) for n in ("record_id", "record_type", "concurrent_to", "target_uri", "page_key", "refers_to",
                                                 "refers_to_key", "declared_digest")], ("declared_length", pa.int64()),
                    ("payload", pa.binary()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("content_length", pa.int64())])


def _row(headers: dict[str, str], body: bytes) -> tuple:
    h = headers.get
    payload = body.partition(b"\r\n\r\n")[2] if h("content-type", "").startswith("application/http") else body
    declared = h("warc-payload-digest")
    return (h("warc-record-id"), h("warc-type"), h("warc-concurrent-to"), h("warc-target-uri"), h("warc-page-key"), h("warc-refers-to"),
            h("warc-refers-to-key"), declared.partition(":")[2] if declared else None,
            int(h("warc-payload-length")) if h("warc-payload-length") else None,
            payload, b32encode(hashlib.sha1(payload).digest()).decode(), len(payload), len(body))


class RecordReader:
    """Records of one file from its lines (without their line feeds), one line at a time."""

    def __init__(self):
        self.headers: dict[str, str] | None = None    # of the record being read
        self.body: list[bytes] | None = None
        self.missing = 0

    def line(self, line: bytes) -> tuple | None:
        """Take one line; a row if it completes a record."""
        if self.body is None:
            text = line.rstrip(b"\r")
            if self.headers is None:
                if text.startswith(b"WARC/"):
                    self.headers = {}
            elif text:
                name, _, value = text.partition(b":")
                self.headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
            else:
                self.body, self.missing = [], int(self.headers.get("content-length") or 0)
                return self._done() if not self.missing else None
            return None
        self.body.append(line)
        self.missing -= len(line) + 1
        if self.missing > 0:
            return None
        return self._done()

    def _done(self) -> tuple:
        length = int(self.headers.get("content-length") or 0)
        body = b"\n".join(self.body)
        if len(body) < length:
            body += b"\n"
        row = _row(self.headers, body[:length])
        self.headers = self.body = None
        return row


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all gzip archives below ``path``: identifiers, the payload (the body of an HTTP message, or
    the whole block of other records) and its digest.

    A file is one stream and is read by one task from its beginning, in bounded batches; blocks may hold any bytes.
    Records with an unfinished block at the end of a file are left out; a folder without records gives an empty table.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader, held, size = None, RecordReader(), [], 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*held)) if held else [[] for _ in _ARROW]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

        for batch in batches:
            files = batch.column(1).dictionary_encode()
            names, codes = files.dictionary.to_pylist(), files.indices.to_pylist()
            for line, code in zip(batch.column(0).to_pylist(), codes):
                if names[code] != now:
                    now, reader = names[code], RecordReader()
                row = reader.line(line)
                if row is not None:
                    held.append(row)
                    size += row[-1]
                    if size > 1 << 23 or len(held) >= 2000:
                        yield out()
                        held, size = [], 0
        yield out()

    return lines.mapInArrow(work, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response``, ``request`` and ``metadata`` structs, joined by concurrent-to identifiers.

    A capture is a response or revisit record. Another record belongs to it if it names it, is named by it, or names a
    request that does. Requests and metadata without a capture are left out; of several of one kind the one with the
    smallest record id is taken. Columns of ``records`` other than the two identifiers and the type go into the structs.
    """
    inner = F.struct(*[F.col(c) for c in records.columns])
    kind = F.col("record_type")
    is_head = kind.isin("response", "revisit")
    heads = records.filter(is_head)
    others = records.filter(~is_head & kind.isNotNull())
    named = (
        heads.select(F.col("record_id").alias("alias"), F.col("record_id").alias("capture"))
        .union(heads.filter(F.col("concurrent_to").isNotNull()).select("concurrent_to", "record_id"))
    )
    # what a request belongs to also holds for records that name the request
    requests = others.filter(kind == "request")
    direct = requests.filter(F.col("concurrent_to").isNotNull()).select(F.col("concurrent_to").alias("alias"), "record_id")
    second = named.join(direct, "alias").select(F.col("record_id").alias("alias"), "capture")
    alias = named.union(second).groupBy("alias").agg(F.min("capture").alias("capture"))
    each = others.select("record_id", kind.alias("kind"), inner.alias("record"),
                         F.explode(F.array_distinct(F.array_compact(F.array("concurrent_to", "record_id")))).alias("alias"))
    belongs = each.join(alias, "alias").groupBy("capture").agg(
        *[F.min_by(F.when(F.col("kind") == k, F.col("record")), F.when(F.col("kind") == k, F.col("record_id"))).alias(k)
          for k in ("request", "metadata")])
    return heads.select(F.col("record_id").alias("capture"), inner.alias("response")).join(belongs, "capture", "left")
