"""The stages against plain Python, each on what the one before has kept; the registered queries against their SQL."""

from __future__ import annotations

from collections import Counter

import pytest
from compare import connect, difference

import __spark_entry__ as entry
import corpus_pipeline
from statmart.llm import queries
from test_llm_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_all_but_the_last_keep_the_columns(steps):
    for df in steps[1:-1]:
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in steps[0].schema]


def test_language_keeps_clean_documents(steps):
    before, after = set(plain(steps[0])), set(plain(steps[1]))
    assert after <= before and len(after) >= 0.99 * len(before)


def test_near_dedup_keeps_one_of_each_group(steps):
    before = plain(steps[1])
    groups = plain_components([(r[0], plain_fingerprint(r[1])) for r in before], 3)
    assert sorted(plain(steps[2])) == sorted(r for r, g in zip(before, groups) if r[0] == g)


def test_secret_scan_changes_only_masked_texts(steps):
    before, after = {r[0]: r for r in plain(steps[2])}, {r[0]: r for r in plain(steps[3])}
    assert set(before) == set(after)
    for d, r in after.items():
        assert r[4] == len(r[1])
        assert r == before[d] or "[secret]" in r[1]


def test_mixing_takes_rows_whole(steps):
    before = Counter(plain(steps[3]))
    after = Counter(plain(steps[4]))
    assert set(after) <= set(before) and max(after.values()) <= queries.MIXTURE.max_epochs


def test_packing_takes_every_token(steps):
    by = {}
    for r in steps[5].collect():
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= queries.LIMIT
    pieces = Counter(r["doc_id"] for r in steps[5].filter("piece = 0").collect())
    assert pieces == Counter(r[0] for r in plain(steps[4]))


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, FOLDER).count() == steps[5].count()


def test_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert [f"op{n}" for n in range(1, 14)] == sorted((n.split("_")[0] for n in queries.QUERIES), key=lambda x: int(x[2:]))


class Named:
    def __init__(self, name):
        self.run, self.sql = queries.QUERIES[name], queries.ORACLE_SQL[name]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(name, spark):
    assert difference(spark, connect(FOLDER), Named(name), FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_answers_every_document(name, spark):
    df = queries.QUERIES[name](spark, FOLDER)
    want = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in df.select("doc_id").collect()} == want


ODD = [
    (1, "the of and to in is was for on are with from at by be", "en", "src1", 53), (2, None, None, None, None), (None, "the of and", None, "src0", 10),
    (3, "", "en", "src2", 0), (4, "?? 12 \n", "en", "src2", 7), (5, "x " * 60_000, "en", "src0", 120_000),
    (6, "the of and to in is was for on are with from at by be", "en", "src1", 53), (7, "der die und", "de", "src3", 11),
    (7, "der die und", "de", "src3", 11), (8, "token = Zk3v9QmW71xTb2Lp and the of and to in is", "en", None, 40),
]


def test_odd_rows_go_through_everything(spark, tmp_path):
    """Nulls in any column, empty and long texts, copies, repeated rows, columns with names used inside."""
    folder = str(tmp_path)
    table = ODD + [(100 + i, f"the of and to {i} in is was {i * 7} for on are {i * 3} with from", "en", f"src{i % 9}", 40) for i in range(40)] \
        + [(200 + i, f"der die und {i} das ist nicht {i * 5} ein von mit", "de", f"src{i % 9}", 40) for i in range(40)]
    df = spark.createDataFrame([(*r, 1, "w", 2) for r in table],
                               "doc_id long, text string, lang string, source string, n_chars long, row int, whole string, rank int")
    df.repartition(3).write.parquet(f"{folder}/documents.parquet")
    for name in ("op2_packing", "op3_secrets", "op5_language", "op6_simhash", "op8_tokens", "op9_quality", "op10_mixing"):
        found = queries.QUERIES[name](spark, folder)
        if name in queries.ORACLE_SQL or name == "op2_packing":
            assert found.count() > 0
        else:
            assert found.count() == len(table)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        docs = spark.read.parquet(f"{folder}/{name}")
    assert len({r["doc_id"] for r in docs.select("doc_id").collect()}) > 50


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    kinds = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "pages": "page_id long, url string, html string",
             "embeddings": "vec_id long, embedding array<float>, label int", "labels": "doc_id long, quality int, toxic int", "conversations": "conv_id long, turn long, role string, text string"}
    for name, kind in kinds.items():
        spark.createDataFrame([], kind).write.parquet(f"{folder}/{name}.parquet")
    for name, q in queries.QUERIES.items():
        assert q(spark, folder).count() == (1 if name == "op7_chat" else 0)
    assert corpus_pipeline.run(spark, folder).count() == 0
