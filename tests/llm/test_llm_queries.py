"""Whole rows of the registered queries without SQL, and of two pipeline stages, against plain Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statmart.llm import language, queries, secrets
from statmart.llm.vocabulary import load, tokenizer_path
from test_llm_quality import plain as plain_statistics
from test_llm_secrets import plain as plain_spans
from test_llm_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").collect()]


def answer(spark, name, *columns):
    return sorted(tuple(r) for r in queries.QUERIES[name](spark, FOLDER).select(*columns).collect())


def test_packing(spark, documents):
    found = queries.op2_packing(spark, FOLDER).collect()
    encode = load(tokenizer_path("word_bpe_49k.json")).encode
    want = []
    for d, text, _ in documents:
        ids = np.array(encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(d, i, at, len(cut := ids[at:at + 2048]), zlib.crc32(cut.tobytes())) for i, at in enumerate(range(0, len(ids), 2048))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(want)
    by = defaultdict(list)
    for r in found:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(by) <= -(-sum(w[3] for w in want) // 2048) + 1              # few small pieces to fill the last gaps with


def test_secrets(spark):
    folder = "/root/testdata/sf0.01"
    documents = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    found, want = queries.op3_secrets(spark, folder).collect(), []
    for d, text, _ in documents:
        base = plain_spans(text or "")
        often = [sum(k == kind for k, *_ in base) for kind in ("assign", "access", "hex")]
        want.append((d, *often, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()))
    assert sorted(tuple(r[c] for c in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")) for r in found) == sorted(want)
    assert any(w[1] for w in want)
    spans = {r["doc_id"]: r["spans"].split(",") if r["spans"] else [] for r in found}
    for d, text, _ in documents:
        assert {f"{k}:{s}:{e}" for k, s, e in plain_spans(text or "")} <= set(spans[d])


def test_simhash(spark, documents):
    fps = [(d, plain_fingerprint(text)) for d, text, _ in documents]
    want = [(d, f"{f:016x}", c) for (d, f), c in zip(fps, plain_components(fps, 3))]
    assert answer(spark, "op6_simhash", "doc_id", "fingerprint", "component_id") == sorted(want)


def test_tokens(spark, documents):
    encode = load(tokenizer_path("byte_bpe_50k.json")).encode
    want = [(d, len((text or "").encode()), n := len(encode(text or "", add_special_tokens=False).ids), n > 1024) for d, text, _ in documents]
    assert answer(spark, "op8_tokens", "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want)


def test_quality(spark, documents):
    want = []
    for d, text, _ in documents:
        n, chars, symbols, dup, repeat, *_ = plain_statistics(text)
        want.append((d, n, chars, symbols, dup, repeat, n < 50 or 100 * repeat > 50 * n))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert answer(spark, "op9_quality", *columns) == sorted(want)
    assert not queries.op9_quality(spark, FOLDER).filter("base_failed and kept").count()


def test_languages(spark, documents):
    found = {r["doc_id"]: r for r in queries.op5_language(spark, FOLDER).collect()}
    labels = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert set(found) == {d for d, *_ in documents}
    for d, text, _ in documents:
        assert found[d]["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert found[d]["lang_pred"] in {*labels.values(), "und"} and 0 <= found[d]["score"] <= 1
    held = [found[d]["lang_pred"] == labels[d] for d, *_ in documents if found[d]["held_out"] and labels[d]]
    assert np.mean(held) >= 0.95


def test_the_language_stage_rejects_what_the_model_rejects(spark):
    """Text by text with the model learned from the same sample, without Spark."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.trained(language.labelled_sample(docs, ~language.held_out(), "doc_id", "text", "lang", language.PER_LANGUAGE))

    def rejected(text):
        counts = language.subword_counts(text) if text else None
        if counts is None:
            return True
        one = counts[None].astype(float)
        p = model.probabilities(one)[0]
        k = int(p.argmax())
        return p[k] < model.least or model.excess(one)[0][k] > model.most[k]

    rows = [tuple(r) for r in docs.collect()]
    kept = sorted(tuple(r) for r in corpus_pipeline.language_id(spark, docs, FOLDER).collect())
    assert kept == sorted(r for r in rows if not rejected(r[1]))


def test_the_secret_stage_masks_what_is_owned_by_few(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    owners = defaultdict(set)
    for r in rows:
        for *_, value_hash, _ in secrets.scan(r["text"]):
            owners[value_hash].add(r["source"])
    want = []
    for r in rows:
        text = r["text"]
        hidden = sorted((start, end) for _, _, end, start, h, random in secrets.scan(text) if random and len(owners[h] - {None}) < 3)
        out, at = [], 0
        for start, end in hidden:
            if start > at or not out:
                out += [text[at:start], "[secret]"]
            at = max(at, end)
        text = "".join(out) + text[at:] if hidden else text
        want.append((r["doc_id"], text, r["lang"], r["source"], len(text)))
    got = corpus_pipeline.secret_scan(spark, docs, "")
    assert sorted(tuple(r) for r in got.select("doc_id", "text", "lang", "source", "n_chars").collect()) == sorted(want)
    assert 0 < got.filter(F.contains("text", F.lit("[secret]"))).count() < len(rows)
