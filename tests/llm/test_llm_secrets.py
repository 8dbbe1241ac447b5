from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from conftest import rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_tables import scan  # noqa: F401
from statmart.llm import secrets

LIVE = "Zk3v9QmW71xTb2Lp"


def plain(text):
    """The contract's patterns, dropped matches included in what is consumed."""
    assign = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(secrets.KINDS[k], s, e) for s, k, e in sorted(out)]


@given(st.lists(st.sampled_from(["token", "=", " ", "TOKEN", "passwd: ", "api_key='", "apikey", "\"", "abc", "abcdef", "AKIA", "ABCD1234", "ſecret",
                                 "f0" * 12, "e", "é", ":", "x\n", "0123456789abcdef", "password=password=", "."]), max_size=14))
@settings(max_examples=500)
def test_scan(parts):
    text = "".join(parts)
    assert [f[:3] for f in secrets.scan(text)] == plain(text)


TABLE = [
    (1, f'a é token = "{LIVE}" b', "r1", "o1"), (2, f"again {LIVE} token={LIVE}", "r2", "o1"),
    (3, "password: example-password-1", "r3", "o1"), (4, "password: example-password-1", "r4", "o2"),
    (5, "password=example-password-1", "r5", "o3"), (6, "secret=aaaaaaaaaaaaaaaaaaaa", "r6", "o4"), (7, None, None, None), (8, "", "r", "o"),
    (9, "nothing here", "r", "o"), (9, f"token={'ab12' * 10}", None, None), (None, "AKIA" + "Q7" * 10 + " " + "9f8e7d6c" * 4, "r9", "o9"),
    (10, "token=" + "x1Y2z3" * 4, "r", "o"), (10, "token=" + "x1Y2z3" * 4, "r", "o"),
]
KIND = "doc_id long, text string, source string, org string"


def test_verdicts_by_ownership(scan):
    df = scan([(*r, 1, 2) for r in TABLE], KIND + ", row int, hash int")
    found = secrets.classified(df, F.col("source"), F.col("org"))
    flat = found.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.hash", "f.verdict", "f.owners", "f.repos")
    owners, repos = defaultdict(set), defaultdict(set)
    for _, t, r, o in TABLE:
        for f in secrets.scan(t):
            owners[f[4]].add(o)
            repos[f[4]].add(r)
    for r in flat.collect():
        n = len(owners[r["hash"]] - {None})
        assert (r["owners"], r["repos"]) == (n, len(repos[r["hash"]] - {None}))
        assert (r["verdict"] == "shared") == (n >= 3)
    verdicts = {(r["doc_id"], r["verdict"]) for r in flat.collect()}
    assert {(1, "live"), (2, "live"), (3, "shared"), (4, "shared"), (5, "shared"), (6, "unclear")} <= verdicts
    assert found.count() == len(TABLE)
    assert found.filter(F.size("found") == 0).count() == 3


def test_spans_and_digest(scan):
    df = scan([(1, f"token={LIVE}", "r", "o"), (2, None, "r", "o")], KIND)
    found = secrets.classified(df, F.col("source"), F.col("org")).select(
        "doc_id", secrets.joined(secrets.spans_of(F.col("found"))).alias("spans"))
    assert rows(found) == [(1, "assign:0:22,live:6:22"), (2, "")]
    empty = F.sha2(F.lit(""), 256)
    assert found.select(empty.alias("x")).first()["x"] == hashlib.sha256(b"").hexdigest()


def test_redaction_hides_live_values_only(scan):
    df = scan([(*r, 1, "w") for r in TABLE], KIND + ", row int, whole string")
    done = secrets.redacted(df, F.col("source"), F.col("org"))
    assert done.columns == df.columns and done.count() == df.count()
    text = {r["doc_id"]: r["text"] for r in done.collect()}
    assert text[1] == 'a é token = "[secret]" b'
    assert text[2] == f"again {LIVE} token=[secret]"
    assert text[3] == TABLE[2][1] and text[6] == TABLE[5][1] and text[7] is None and text[8] == ""
    assert text[None] == "[secret] [secret]" or "[secret]" in text[None]


def test_overlapping_spans_are_one(scan):
    value = "0123456789abcdef01234567"
    done = secrets.redacted(scan([(1, f"x token={value} y", "r", "o")], KIND), F.col("source"), F.col("org"))
    assert done.first()["text"] == "x token=[secret] y"


def test_empty_table(scan):
    df = scan([], KIND)
    assert secrets.classified(df, F.col("source"), F.col("org")).count() == 0
    assert secrets.redacted(df, F.col("source"), F.col("org")).count() == 0


def test_a_value_in_a_third_of_all_documents(scan):
    table = [(i, "token=commonexample1" if i % 3 == 0 else f"token=own{i:04}Xq81Zp{i:04}", f"r{i % 50}", f"o{i % 50}") for i in range(900)]
    found = secrets.classified(scan(table, KIND), F.col("source"), F.col("org"))
    got = found.select("doc_id", F.explode("found").alias("f")).groupBy("f.verdict").count().collect()
    got = {r["verdict"]: r["count"] for r in got}
    assert got["shared"] == 300 and sum(got.values()) == 900 and got["live"] > 300


def test_a_random_value_of_two_owners_is_masked(scan):
    """Two different documents of two owners; a third owner makes an example, and what is not random stays."""
    table = [(1, f"first note token={LIVE} end", "r1", "o1"), (2, f"other words passwd: {LIVE}", "r2", "o2"),
             (3, "secret=aaaaaaaaaaaaaaaaaaaa", "r1", "o1"), (4, "secret=aaaaaaaaaaaaaaaaaaaa", "r2", "o2"),
             *((5 + i, f"{i} token=commonexample1", f"r{i}", f"o{i}") for i in range(3))]
    df = scan(table, KIND)
    found = secrets.classified(df, F.col("source"), F.col("org"))
    verdict = {r["doc_id"]: r["f"]["verdict"] for r in found.select("doc_id", F.explode("found").alias("f")).collect()}
    assert verdict == {1: "few", 2: "few", 3: "unclear", 4: "unclear", 5: "shared", 6: "shared", 7: "shared"}
    spans = dict(rows(found.select("doc_id", secrets.joined(secrets.spans_of(F.col("found"))))))
    assert spans[1] == "assign:11:33,few:17:33"
    text = {r["doc_id"]: r["text"] for r in secrets.redacted(df, F.col("source"), F.col("org")).collect()}
    assert text == {i: t for i, t, *_ in table} | {1: "first note token=[secret] end", 2: "other words passwd: [secret]"}
