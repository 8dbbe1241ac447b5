from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from llm_tables import scan  # noqa: F401
from statmart.llm import hardneg
from statmart.llm.hardneg import Windows

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(table, every=10, windows=Windows()):
    good = {}
    for i, v, label in table:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(256 * x) for x in v]
            good[i] = min(good.get(i, (w, label)), (w, label))
    out = []
    for a in good:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(good[a][0], good[r][0])), r) for r in good if r != a)
        mine = [(-s, r) for s, r in scored if good[r][1] == good[a][1]][:windows.positives]
        for score, p in mine:
            inside = [(-s, r) for s, r in scored if good[r][1] != good[a][1]
                      and windows.low * score <= -100 * s <= windows.high * score][:windows.negatives]
            out += [(a, p, rank, r, score, s) for rank, (s, r) in enumerate(inside, 1)]
    return sorted(out, key=repr)


def found(df, every=10, windows=Windows()):
    return rows(hardneg.mined(df, F.col("vec_id") % every == 0, F.col("label"), windows), *COLUMNS)


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", 8)
    monkeypatch.setattr(hardneg, "SLICE_ROWS", 50)
    monkeypatch.setattr(hardneg, "_STEP", 16)


def test_equals_brute_force_with_ties_and_bad_rows(scan, small_cells):
    rng = random.Random(3)
    table = [(i, [rng.gauss(0.3, 1) for _ in range(6)], rng.choice([0, 0, 1, 2])) for i in range(250)]
    table += [(250 + i, [0.5] * 6, i % 3) for i in range(120)]            # one vector with all labels: ties with positives
    table += [(None, [1.0] * 6, 1), (400, None, 1), (410, [1.0, None] + [0.0] * 4, 1), (420, [math.nan] * 6, 0),
              (430, [math.inf] * 6, 0), (440, [1.0] * 6, None), (450, [9.0, 9.0], 1), (460, [], 2),
              (40, [3.0] * 6, 0), (40, table[40][1], 0), (40, [3.0] * 6, 2), (-10, [0.1] * 6, 1)]
    padded = [(i, v if v is None else list(v) + [0.0] * (6 - len(v)), label) for i, v, label in table]
    schema = "vec_id long, embedding array<double>, label int"
    assert found(scan(table, schema)) == brute(padded)
    other = Windows(positives=2, negatives=9, low=50, high=95)
    assert found(scan(table, schema), windows=other) == brute(padded, windows=other)


def test_no_positive_no_negative_no_rows(scan, spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert found(spark.createDataFrame([], schema)) == []
    assert found(scan([(1, [1.0], 0)], schema)) == []                        # no anchor
    assert found(scan([(0, [1.0], 0)], schema)) == []                        # nothing else
    assert found(scan([(0, [1.0], 0), (1, [1.0], 0)], schema)) == []         # no other label
    assert found(scan([(0, [1.0], 0), (1, [1.0], 1)], schema)) == []         # no positive
    negative = [(0, [1.0], 0), (1, [-1.0], 0), (2, [-1.0], 1)]               # below zero a window is empty
    assert found(scan(negative, schema)) == []
    zero = [(0, [1.0], 0), (1, [0.0], 0), (2, [0.0], 1)]                     # at zero it holds zero
    assert found(scan(zero, schema)) == [(0, 1, 1, 2, 0, 0)]


def test_labels_of_any_kind_and_clashing_columns(scan):
    table = [(0, [1.0], "x", 1, "a"), (1, [2.0], "x", 2, "b"), (2, [1.9], "y", 3, "c"), (3, [1.0], "", 4, "d")]
    df = scan(table, "vec_id long, embedding array<float>, label string, cell int, key string")
    assert found(df) == [(0, 1, 1, 2, 512 * 256, 486 * 256)]


def test_wide_numbers_stay_exact(scan):
    big = float(1 << 20)
    df = scan([(0, [big, 1.0], 0), (1, [big, 2.0], 0), (2, [big, 1.0], 1), (3, [big, 3.0], 1)],
              "vec_id long, embedding array<double>, label int")
    n = (1 << 28) ** 2
    assert found(df) == [(0, 1, 1, 2, n + 512 * 256, n + 256 * 256)]


def test_very_long_vectors(scan):
    wide = 5_000
    rng = np.random.default_rng(0)
    table = [(i, [float(x) for x in rng.normal(0.2, 1, wide)], i % 2) for i in range(12)]
    assert found(scan(table, "vec_id long, embedding array<double>, label int")) == brute(table)


def test_keys_sort_like_their_parts():
    rng = random.Random(0)
    parts = [(rng.choice([-2**63, -1, 0, 7, 2**63 - 1]), rng.choice([-2**62, -5, 0, 5, 2**62]), rng.choice([0, 1]),
              rng.choice([-2**63, -3, 0, 3, 2**63 - 1])) for _ in range(300)]
    keys = [hardneg.packed(np.array([a]), np.array([s]), k, np.array([i]))[0].as_py() for a, s, k, i in parts]
    assert [hardneg.unpacked(k) for k in keys] == parts
    assert [hardneg.unpacked(k) for k in sorted(keys)] == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))


def test_windows_above_their_positive_are_refused():
    with pytest.raises(ValueError):
        Windows(high=120)


def test_registered_query_equals_its_sql(spark):
    from compare import canonical, connect, rows_of_sql
    from statmart.llm import queries
    folder = "/root/testdata/sf0.01"
    got = queries.op11_hard_negatives(spark, folder)
    names, _, want = rows_of_sql(connect(folder), queries.ORACLE_SQL["op11_hard_negatives"])
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(names, want)
    assert want
