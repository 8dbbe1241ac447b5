from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest
import xxhash
from conftest import rows
from hypothesis import given, settings, strategies as st

from statmart.llm import simhash
from llm_tables import prose, scan  # noqa: F401
from statmart.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits):
    """(id, fp) -> component: smallest id reachable."""
    group = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(fps):
            for j, (_, b) in enumerate(fps):
                if bin(a ^ b).count("1") <= bits and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    best = {}
    for g, (d, _) in zip(group, fps):
        if d is not None:
            best[g] = min(best.get(g, d), d)
    return [best.get(g) for g in group]


@given(st.text(alphabet="aAbß É\t\n\x0b\x1c zZ'"))
@settings(max_examples=300)
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_long_texts_are_counted_in_steps(monkeypatch, prose):
    monkeypatch.setattr(simhash, "_STEP", 7)
    assert simhash.fingerprint(prose(3, 500)) % (1 << 64) == plain_fingerprint(prose(3, 500))


def test_any_five_positions_hold_exactly_one_posting_key():
    import itertools
    assert len(simhash.FOURS) == 14
    for five in itertools.combinations(range(8), 5):
        assert sum(set(c) <= set(five) for c in simhash.FOURS) == 1


def test_groups_of_a_posting_equal_all_pairs():
    rng = random.Random(5)
    fps = []
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(40):
            fps.append(base ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randint(0, 4))}))
    fps = np.array(sorted(set(fps)), np.uint64).astype(np.int64)
    a, b = simhash.linked_groups(np.zeros(len(fps), np.int64), fps, 3)
    assert len(a) < len(fps)
    group = {int(f): int(f) for f in fps}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for x, y in zip(a.tolist(), b.tolist()):
        group[max(root(x), root(y))] = min(root(x), root(y))
    want = plain_components([(int(f), int(f) % (1 << 64)) for f in fps], 3)
    by_root = {}
    for f, w in zip(fps.tolist(), want):
        by_root.setdefault(root(f), set()).add(w)
    assert all(len(v) == 1 for v in by_root.values()) and len(by_root) == len(set(want))


def test_near_duplicates_equal_brute_force(scan, prose):
    rng = random.Random(2)
    texts = [None, "", " \n\t ", "one", "one two", "One Two", "one two three"]
    for s in range(12):
        base = prose(s, 60).split()
        for _ in range(6):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    table = [(i, t) for i, t in enumerate(texts)] + [(None, "one two three"), (3, prose(0, 60)), (None, "all alone here and nowhere else")]
    rng.shuffle(table)
    fps = [(d, plain_fingerprint(t)) for d, t in table]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(fps, plain_components(fps, 3))), key=repr)
    df = scan([(d, t, 1, "x", 2) for d, t in table], "doc_id long, text string, row int, fp string, component_id int")
    got = simhash.near_duplicates(df)
    assert sorted([(r["doc_id"], f"{r['fp'] % (1 << 64):016x}", r["component_id"]) for r in got.collect()], key=repr) == want
    assert got.filter("keeper").count() == len(set(c for c in plain_components([(i, f) for i, (_, f) in enumerate(fps)], 3)))
    kept = simhash.without_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == got.filter("keeper").count()


def test_hot_postings_lose_no_link(spark, monkeypatch):
    rng = random.Random(9)
    fps = {sum(1 << b for b in {rng.randrange(24) for _ in range(rng.randint(0, 9))}) for _ in range(400)}   # five bytes in common
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.near_links(df)
    got = {r["node"]: r["root"] for r in components(links).collect()}
    ordered = sorted(fps)
    want = plain_components([(f, f) for f in ordered], 3)
    assert all(got.get(f, f) == w for f, w in zip(ordered, want))


@pytest.mark.parametrize("split", [8, 64])
def test_postings_above_the_bound_equal_brute_force(spark, monkeypatch, split):
    """Several clusters of fingerprints with four or five bytes in common, far more than are compared pair by pair."""
    monkeypatch.setattr(simhash, "SPLIT", split)
    rng = random.Random(split)
    fps = set()
    for free in (24, 32):
        for top in (0, 0xA5):
            for _ in range(150):
                fps.add(top << 56 | sum(1 << b for b in {rng.randrange(free) for _ in range(rng.randint(0, 7))}))
    fps |= {rng.getrandbits(64) for _ in range(40)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3))
    got = {r["node"]: r["root"] for r in components(links).collect()}
    want = plain_components([(f, f % (1 << 64)) for f in sorted(signed)], 3)
    assert all(got.get(f, f) == w for f, w in zip(sorted(signed), want))


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_neighbours_link_what_all_pairs_link(bits):
    rng = np.random.default_rng(bits)
    for five in ((0, 1, 2, 3, 4), (0, 3, 5, 6, 7), (1, 2, 4, 6, 7)):
        fixed = int(rng.integers(0, 2 ** 63)) & sum(0xFF << 8 * p for p in five)
        free = [p for p in range(8) if p not in five]
        codes = np.unique(rng.integers(0, 1 << 24, 900) & 0x3F0F1F)
        fp = np.array([fixed | sum((int(c) >> 8 * k & 0xFF) << 8 * p for k, p in enumerate(free)) for c in codes], np.uint64).view(np.int64)

        def groups(links):
            up = {int(f): int(f) for f in fp}

            def root(x):
                while up[x] != x:
                    x = up[x]
                return x
            for x, y in zip(*(v.tolist() for v in links)):
                up[max(root(x), root(y))] = min(root(x), root(y))
            return [root(int(f)) for f in fp]
        assert groups(simhash.linked_neighbours(fp, five, bits)) == groups(simhash.linked_groups(np.zeros(len(fp), np.int64), fp, bits))


def test_a_full_posting_takes_time_in_proportion():
    """Forty thousand fingerprints with five bytes in common: all pairs took half a minute."""
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 24, 40_000)).astype(np.int64)
    began = time.perf_counter()
    a, _ = simhash.linked_neighbours(fp, (3, 4, 5, 6, 7), 3)
    assert len(a) and time.perf_counter() - began < 15


def test_components_of_a_long_chain_and_of_nothing(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (200, None), (7, 3), (7, 3)]
    got = rows(components(spark.createDataFrame(chain, "a long, b long")))
    assert got == sorted([(i, 0) for i in range(61)] + [(100, 100)], key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(scan, spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
