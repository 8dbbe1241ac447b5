from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from conftest import rows
from llm_tables import scan  # noqa: F401
from statmart.llm import topk


def brute(table, k):
    good = {}
    for i, v in table:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(64 * x) for x in v]
            good[i] = min(good.get(i, w), w)
    out = []
    for q in sorted(good):
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q)[:k]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scored, 1)]
    return sorted(out, key=repr)


def found(df, k):
    return rows(topk.top_k(df, F.col("vec_id") % 20 == 0, k), "query_id", "rank", "vec_id", "score")


def test_equals_brute_force_with_ties_and_bad_vectors(scan, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)        # many blocks, so that pruning by length has something to do
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = random.Random(1)
    table = [(i, [rng.gauss(0, 1 + (i % 7)) for _ in range(6)]) for i in range(300)]
    table += [(300 + i, [0.5] * 6) for i in range(100)]                   # one vector a hundred times: ties
    table += [(None, [1.0] * 6), (400, None), (401, [1.0, None] + [0.0] * 4), (402, [math.nan] * 6),
              (403, [math.inf] * 6), (404, [9.0, 9.0]), (405, []), (40, [3.0] * 6), (40, table[40][1])]
    got = found(scan([(i, v) for i, v in table], "vec_id long, embedding array<double>"), 5)
    padded = [(i, v if v is None else list(v) + [0.0] * (6 - len(v))) for i, v in table]
    assert got == brute(padded, 5)


def test_few_and_no_rows(scan, spark):
    kind = "vec_id long, embedding array<float>"
    assert found(spark.createDataFrame([], kind), 3) == []
    assert found(scan([(0, [1.0, 2.0])], kind), 3) == []
    assert found(scan([(0, [1.0]), (1, [1.0]), (2, [1.0])], kind), 20) == [(0, 1, 1, 4096), (0, 2, 2, 4096)]


def test_other_columns_do_not_matter(scan):
    df = scan([(0, [1.0], "x", 1), (3, [2.0], "y", 2)], "vec_id long, embedding array<float>, id string, block int")
    assert found(df, 2) == [(0, 1, 3, 64 * 128)]


def test_wide_numbers_stay_exact(scan):
    big = float(1 << 24)
    df = scan([(0, [big, 1.0]), (1, [big, 2.0]), (2, [big, 1.0])], "vec_id long, embedding array<double>")
    n = (1 << 30) ** 2
    assert found(df, 2) == [(0, 1, 1, n + 64 * 128), (0, 2, 2, n + 64 * 64)]
