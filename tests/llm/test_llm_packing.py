from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from statmart.llm import packing
from llm_tables import prose, scan  # noqa: F401
from statmart.llm.vocabulary import load, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
WORDS = ["Hello", "WORLD,", "it's", "<|endoftext|>", "x<|startoftext|>y", "é", "É", "ſ", "Σας", "\x1c", "日本", "a b", "1234", "...",
         "̸=", "İ", " ", "\n", "\t", "\x0b", " "]


def ids_of(text):
    return load(PATH).encode(text, add_special_tokens=False).ids


@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=8).map("".join), max_size=6))
@settings(max_examples=200, deadline=None)
def test_ids_as_the_library(texts):
    encoder = packing.WordEncoder(PATH)
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == [ids_of(t) for t in texts]


def check(found, limit):
    """Sequences are gapless and no longer than the limit."""
    by = defaultdict(list)
    for r in found:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_documents(scan, prose):
    texts = [None, "", "one", prose(1, 3000), prose(2, 4000), prose(3, 900)] + [prose(s, 20 * s) for s in range(4, 60)]
    table = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (2, "one"), (2, "one")]
    df = scan([(*r, 1, "q") for r in table], "doc_id long, text string, sequence_id int, grp string")
    found = packing.packed_documents(df, PATH, 256).collect()
    want = []
    for d, t in table:
        raw = np.array(ids_of(t or "") + [0], "<u4").tobytes()
        want += [(d, j, at // 4, len(raw[at:at + 1024]) // 4, zlib.crc32(raw[at:at + 1024])) for j, at in enumerate(range(0, len(raw), 1024))]
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found], key=repr) == sorted(want, key=repr)
    used = check(found, 256)
    assert used <= -(-sum(w[3] for w in want) // 256) + 2


def test_real_ids_pass_through(scan):
    df = scan([(1, "one two three four five")], "doc_id long, text string")
    found = packing.packed_documents(df, PATH, 4, keep_ids=True).orderBy("piece").collect()
    assert sum([np.frombuffer(r["ids"], "<u4").tolist() for r in found], []) == ids_of("one two three four five") + [0]


def test_many_groups_islands_and_equal_rows(scan, monkeypatch):
    rng = np.random.default_rng(0)
    sizes = [int(x) for x in rng.integers(1, 101, 600)] + [50] * 300
    found = packing.pack(scan([(s, "same") for s in sizes], "length long, note string"), 100, group=150, islands=2, epochs=3).collect()
    assert sorted(r["length"] for r in found) == sorted(sizes)
    assert check(found, 100) <= 1.06 * -(-sum(sizes) // 100) + 6      # many pieces are longer than half a sequence


def test_pooled_groups_come_near_the_bound(scan):
    """Twenty groups would leave twenty part empty sequences; pooled over levels, all but a few are full."""
    rng = np.random.default_rng(5)
    sizes = [int(x) for x in rng.integers(3, 60, 4000)]
    df = scan([(s, i) for i, s in enumerate(sizes)], "length long, id long")
    found = packing.pack(df, 200, group=200).collect()
    assert sorted((r["id"], r["length"]) for r in found) == list(enumerate(sizes))
    least = -(-sum(sizes) // 200)
    assert check(found, 200) <= least + 1
    rows = df.select(F.col("id").alias("row"), F.col("length").cast("int").alias("size"))
    alone = packing._packed_groups(rows, 20, 200, 3, 2, packing.OFFSPRING, 7)
    assert alone.select("grp", "bin").distinct().count() > least + 1


def test_empty_table(spark, scan):
    assert packing.pack(scan([], "length long")).count() == 0


@given(st.lists(st.integers(1, 50), min_size=1, max_size=60), st.integers(0, 99))
@settings(max_examples=150, deadline=None)
def test_crossover_keeps_every_document_once(sizes, seed):
    sizes, rng = np.array(sizes), np.random.default_rng(seed)
    a, b = (packing.packed_in_order(sizes, rng.permutation(len(sizes)), 50) for _ in range(2))
    child = packing.crossover(sizes, a, b, 50, rng)
    filled = np.bincount(child, sizes)
    assert len(child) == len(sizes) and filled.max() <= 50 and filled.min() > 0


def test_evolution_is_no_worse_than_best_fit_and_repeatable():
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(200, 900, 400))[::-1].copy()
    simple = packing.packed_in_order(sizes, np.arange(400), 2048).max() + 1
    one, two = (packing.evolved(sizes, [], 2048, (1, 2)) for _ in range(2))
    assert one[0].max() + 1 <= simple
    assert all((x == y).all() for x, y in zip(one, two))


@pytest.mark.parametrize("seed", range(3))
def test_best_fit_takes_the_fullest_bin(seed):
    bins = packing.Bins(10)
    for i, s in enumerate([6, 7, 3, 4]):
        bins.best_fit(i, s)
    assert bins.members == [[0, 3], [1, 2]]
