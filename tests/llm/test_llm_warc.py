from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode

from conftest import rows
from pyspark.sql import functions as F

from llm_tables import scan  # noqa: F401
from statmart.llm import warc

KIND = "page_id long, url string, html string"
TABLE = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, "http://b", ""), (4, None, None), (5, "http://c\r\nX: y", "a\r\n\r\nWARC/1.1\r\nb\n"),
         (6, "http://d", "line\nline\r\n"), (6, "http://d", "line\nline\r\n"), (7, "u", "x" * 70000), (None, "n", "only"), (None, "n2", "<p>é</p>"),
         (8, "u", "\r\n\r\n"), (9, "v", "\n"), (10, "v", "\r")]


def digest(html):
    return b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def captures(spark, df, path, **options):
    warc.write_archives(df, path, **options)
    done = warc.transactions(warc.read_records(spark, path))
    return done.select("capture", "response", "request", "metadata")


def test_round_trip(spark, scan, tmp_path):
    df = scan([(*r, 1, "k") for r in TABLE], KIND + ", row int, key string")
    done = captures(spark, df, f"{tmp_path}/w").collect()
    assert len(done) == len(TABLE)
    by = {}
    for i, _, h in TABLE:
        if i is not None:
            by[digest(h)] = min(by.get(digest(h), i), i)
    seen = set()
    for r in done:
        x = r["response"]
        key = int(x["page_key"]) if x["page_key"] else None
        declared = x["declared_digest"]
        first = by.get(declared)
        if x["record_type"] == "response":
            assert x["payload_digest"] == declared == digest(bytes(x["payload"]).decode())
            assert declared not in seen and key == first
            seen.add(declared)
        else:
            assert bytes(x["payload"]) == b"" and int(x["refers_to_key"]) == first
        assert r["request"]["concurrent_to"] == r["metadata"]["concurrent_to"] == r["capture"]
    payload = {int(r["response"]["page_key"]): bytes(r["response"]["payload"]).decode() for r in done
               if r["response"]["record_type"] == "response" and r["response"]["page_key"]}
    assert payload[5] == TABLE[4][2] and payload[8] == "\r\n\r\n" and payload[9] == "\n" and payload[7] == "x" * 70000
    assert len(set(r["capture"] for r in done)) == len(TABLE)


def test_small_payloads_need_not_be_revisits(spark, scan, tmp_path):
    df = scan([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], KIND)
    prepared = warc.prepared(df, min_bytes=3).select("key", "first.key").collect()
    assert sorted((a, b) for a, b in prepared) == [(1, None), (2, None), (3, 3), (4, 3)]


def test_base32(scan):
    df = scan([(1, "a", "x"), (2, "b", "")], KIND)
    assert rows(df.select("page_id", warc.base32_sha1(F.col("html")))) == [(1, digest("x")), (2, digest(""))]


def test_many_files_and_few_rows_each(spark, scan, tmp_path):
    df = scan([(i, f"u{i}", f"<p>{i // 2}</p>\n" * (i % 5)) for i in range(200)], KIND, files=5)
    done = captures(spark, df, f"{tmp_path}/w", captures_per_file=7)
    assert done.count() == 200 and done.filter("request is null or metadata is null").count() == 0


def test_foreign_archives(spark, tmp_path):
    def record(kind, id_, body, *more):
        head = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {id_}", *more, f"Content-Length: {len(body)}"])
        return gzip.compress(head.encode() + b"\r\n\r\n" + body + b"\r\n\r\n")      # one member per record

    body = b"HTTP/1.1 200 OK\r\n\r\n\xff\xfe\x00raw\n\n"
    http = "Content-Type: application/http; msgtype=response"
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.warc.gz").write_bytes(
        record("warcinfo", "<i>", b"software: x\r\n") + record("request", "<q>", b"GET / HTTP/1.1\r\n\r\n") +
        record("response", "<r>", body, http, "WARC-Concurrent-To: <q>") + record("metadata", "<m>", b"k: v", "WARC-Concurrent-To: <q>"))
    (tmp_path / "f" / "b.warc.gz").write_bytes(
        record("response", "<r2>", b"", http) + record("request", "<q2>", b"x", "WARC-Concurrent-To: <r2>") +
        record("metadata", "<m2>", b"", "WARC-Concurrent-To: <q2>") + record("response", "<r3>", b"y", http))
    records = warc.read_records(spark, str(tmp_path / "f"))
    assert records.count() == 8
    done = {r["capture"]: r for r in warc.transactions(records).collect()}
    assert set(done) == {"<r>", "<r2>", "<r3>"}
    assert bytes(done["<r>"]["response"]["payload"]) == b"\xff\xfe\x00raw\n\n"
    assert done["<r>"]["request"]["record_id"] == "<q>" and done["<r2>"]["request"]["record_id"] == "<q2>"
    assert done["<r2>"]["metadata"]["record_id"] == "<m2>" and done["<r3>"]["request"] is None


def test_empty_table(spark, scan, tmp_path):
    assert captures(spark, scan([], KIND), f"{tmp_path}/w").count() == 0
