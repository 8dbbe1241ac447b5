"""Row numbers do not depend on how a scan is split, which changes with the cores a cluster has at the moment."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from llm_tables import prose, scan  # noqa: F401
from statmart.llm import mixing, secrets, shared, simhash, warc

SPLIT = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture
def later(spark):
    """later(make) -> rows of a frame that is built under one split and read under another."""
    def run(make):
        spark.conf.set(SPLIT, "3")
        try:
            df = make()
            spark.conf.set(SPLIT, "17")
            return rows(df)
        finally:
            spark.conf.unset(SPLIT)
    return run


def test_splits_do_change(spark, scan):
    df = scan([(i,) for i in range(4000)], "n long", files=12)
    found = set()
    for n in ("3", "17"):
        spark.conf.set(SPLIT, n)
        found.add(df.select("n").rdd.getNumPartitions())
        spark.conf.unset(SPLIT)
    assert len(found) == 2


def test_numbers_are_unique_and_stable(spark, scan, later):
    df = scan([(i, "x") for i in range(3000)], "row long, _file string", files=12).select("row")
    one = rows(shared.numbered(df, "n"))
    assert len({n for _, n in one}) == 3000
    assert later(lambda: shared.numbered(df, "n")) == one
    assert later(lambda: shared.numbered(df.filter("row % 2 = 0"), "n")) == [r for r in one if r[0] % 2 == 0]


def test_frames_without_a_place_are_written(spark, scan):
    df = scan([(i,) for i in range(10)], "n long")
    assert shared.as_scan(df) is df
    for other in (df.union(df), df.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))), df.join(df.withColumnRenamed("n", "m")),
                  spark.range(5)):
        assert len({r[-1] for r in rows(shared.numbered(shared.as_scan(other), "row"))}) == other.count()


def test_masking(scan, later):
    rng = random.Random(1)
    key = lambda: "".join(rng.choice("abcdefghijkmnpqrstuvwxyz0123456789") for _ in range(24))
    docs = [(i, f"password={key()} end" if i % 3 == 0 else f"plain {i}", f"s{i}") for i in range(2000)]
    got = later(lambda: secrets.redacted(scan(docs, "doc_id long, text string, source string", files=12), F.col("source"), F.col("source")))
    assert got == sorted([(i, "password=[secret] end" if i % 3 == 0 else t, s) for i, t, s in docs], key=repr)


def test_near_duplicates(scan, later, prose):
    docs = [(i, prose(i // 3, 40)) for i in range(900)]
    got = later(lambda: simhash.without_near_duplicates(scan(docs, "doc_id long, text string", files=12)))
    assert got == sorted([d for d in docs if d[0] % 3 == 0], key=repr)


def test_responses(scan, later):
    pages = [(i, f"u{i}", f"<p>{i % 250}</p>") for i in range(3000)]
    got = later(lambda: warc.prepared(scan(pages, "page_id long, url string, html string", files=12)).select(
        "key", "first.key", (F.col("first.row") == F.col("row")).alias("own")))
    assert got == sorted([(i, i % 250, i < 250) for i in range(3000)], key=repr)


def test_mixing(scan, later):
    docs = [(i, "w " * (i % 5 + 1), "en", f"s{i % 7}") for i in range(2500)]
    mixture = mixing.Mixture(weights={"d/en/s1": 5})
    build = lambda: scan(docs, "doc_id long, text string, lang string, source string", files=12)
    described = mixing.described(build(), F.lit("d")).withColumn("row", F.col("doc").cast("long"))
    plan = rows(mixing.selection(described, mixture).groupBy("row").count())
    got = later(lambda: mixing.mixed(build(), F.lit("d"), mixture).groupBy("doc_id").count())
    assert got == plan
