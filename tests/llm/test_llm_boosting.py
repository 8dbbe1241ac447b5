from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from llm_tables import CLASH, EXTRA, prose, scan  # noqa: F401
from statmart.llm import boosting

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"


def named(text):
    return dict(zip(boosting.STATISTICS, boosting.statistics(text)))


def test_statistics_equal_a_plain_count(prose):
    rng = random.Random(2)
    for text in [prose(1, 300), "One two.\nOne two.\n\nthree ## four!", "a a a b a a a b", " \n\t ", "x", "é Ü 5 *", "no end\n" * 70,
                 " ".join(rng.choice("abc") for _ in range(200))]:
        got = named(text)
        words = re.findall("[^ \t-\r]+", text)
        lines = [s for s in text.split("\n") if s.strip()]
        often = Counter(words)
        triples = Counter(zip(words, words[1:], words[2:]))
        letters = sum(c.isalpha() for c in text)
        want = {
            "log_chars": np.log1p(len(text)), "log_words": np.log1p(len(words)), "log_lines": np.log1p(len(lines)),
            "letters": letters / len(text), "upper_letters": sum(c.isupper() for c in text) / max(1, letters),
            "symbols": sum(c in boosting.SYMBOLS for c in text) / len(text),
            "beyond_ascii": sum(ord(c) > 127 for c in text) / len(text),
            "distinct_words": len(often) / len(words) if words else 0,
            "commonest_word": max(often.values()) / len(words) if words else 0,
            "repeats_previous": sum(a == b for a, b in zip(words, words[1:])) / (len(words) - 1) if len(words) > 1 else 0,
            "repeated_triples": sum(n for n in triples.values() if n > 1) / (len(words) - 2) if len(words) > 2 else 0,
            "wordless_words": sum(not any(c.isalpha() for c in w) for w in words) / len(words) if words else 0,
            "ends_in_symbol": sum(w[-1] in boosting.SYMBOLS for w in words) / len(words) if words else 0,
            "repeated_lines": 1 - len({s.strip() for s in lines}) / len(lines) if lines else 0,
            "longest_word": np.log1p(max(map(len, words))) if words and text.isascii() else got["longest_word"],
        }
        assert {k: got[k] for k in want} == pytest.approx(want), text
    assert not boosting.statistics(None).any() and not boosting.statistics("").any()


def test_flat_arrays_equal_a_walk_from_node_to_node():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (600, len(boosting.STATISTICS)))
    y = ((x[:, 3] > 0) ^ (x[:, 7] > 0.5)).astype(np.int64)
    forest = boosting.trained(x, y)

    def walk(row):
        total = forest.bias
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] if row[forest.statistic[node]] <= forest.edge[node] else forest.right[node]
            total += forest.value[node]
        return total

    assert forest.margin(x) == pytest.approx([walk(r) for r in x])
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.97              # no single split tells an exclusive or


def test_a_split_is_the_best_of_all_edges():
    """The first tree's root against a search over every statistic and edge."""
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(0, 1, (40, len(boosting.STATISTICS))), 1)
    y = (x[:, 5] + rng.normal(0, 0.5, 40) > 0).astype(np.int64)
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = p - y, np.full(len(y), p * (1 - p))

    def gain(s, e):
        low = x[:, s] <= e
        if min(h[low].sum(), h[~low].sum()) < boosting.LEAF_WEIGHT:
            return 0
        return sum(g[m].sum() ** 2 / (h[m].sum() + boosting.SHRINK) for m in (low, ~low))

    best = max(gain(s, e) for s in range(x.shape[1]) for e in np.unique(x[:, s]))
    forest = boosting.trained(x, y)
    assert gain(forest.statistic[0], forest.edge[0]) == pytest.approx(best)


def test_odd_tables(scan, spark, prose):
    docs = [(i, prose(i, 60), *CLASH) for i in range(60)] + [(100 + i, "BUY!! NOW!! ### " * 20, *CLASH) for i in range(60)]
    docs += [(None, prose(1, 60), *CLASH), (500, None, *CLASH), (501, "", *CLASH), (502, "word " * 100_000, *CLASH), (3, prose(3, 60), *CLASH)]
    labels = [(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(60)] + [(None, 0), (7, None), (3, 1), (999, 0)]
    out = boosting.scored(scan(docs, f"{DOCS}, {EXTRA}"), scan(labels, LABELS).withColumn("id", F.lit(1)))
    got = {(r["doc_id"], r["held_out"]): (r["score"], r["predicted"]) for r in out.collect()}
    assert out.count() == len(docs) and out.columns == ["doc_id", "held_out", "score", "predicted"]
    for (i, held), (score, predicted) in got.items():
        assert 0 <= score <= 1 and predicted == int(score >= 0.3)
        assert held == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
        if i is not None and i < 200:
            assert predicted == int(i < 100)
    schema = scan(docs, f"{DOCS}, {EXTRA}")
    none = boosting.scored(schema, spark.createDataFrame([], LABELS))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert boosting.scored(spark.createDataFrame([], DOCS), scan(labels, LABELS)).count() == 0


def test_the_sample_is_bounded_and_an_id_counts_once(scan):
    stats = lambda x: [float(x)] * len(boosting.STATISTICS)
    table = scan([(i, stats(i)) for i in range(4000)] + [(5, stats(9))] * 500, "id long, stats array<double>")
    labels = scan([(i, i % 2) for i in range(4000)] + [(8, 1), (8, 1)], "id long, label int")
    x, y = boosting.labelled_sample(table, labels, sample=400)
    assert 300 < len(y) < 500 and ((x[:, 0] % 2 == y) | (x[:, 0] == 8)).all()
    x, y = boosting.labelled_sample(table, labels)
    assert sorted(x[:, 0]) == list(range(4000)) and y[x[:, 0] == 8] == [1]


def test_held_out_labels_are_told(spark):
    from statmart.llm import queries
    folder = "/root/testdata/sf0.01"
    answers = {r["doc_id"]: r for r in queries.op12_quality_classifier(spark, folder).collect()}
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(answers) == spark.read.parquet(f"{folder}/documents.parquet").count()
    asked = [(answers[i]["predicted"], q) for i, q in truth.items() if answers[i]["held_out"]]
    assert asked and np.mean([p == q for p, q in asked]) > 0.95
    assert all(p == 1 for p, q in asked if q == 1)


def test_labels_of_held_out_rows_change_nothing(spark, scan):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("quality", F.when(boosting.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = (rows(boosting.scored(docs, t).select("doc_id", "score")) for t in (labels, turned))
    assert one == other
