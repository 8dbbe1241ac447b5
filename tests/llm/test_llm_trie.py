from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from llm_tables import scan  # noqa: F401
from statmart.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sequences(table):
    """conv -> its own turns, in order."""
    out = {}
    for conv, turn, role, text in table:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, sha(f"{len(role or '')}:{role or ''}{text or ''}"), role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt(table):
    own, out = sequences(table), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    return out


def brute(chats):
    members, ends = {}, {}
    for c, turns in chats.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        mine = children.get(node, [])
        words = len(re.findall("[^ \t-\r]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in mine) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in mine)
    return sorted([(min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n],
                    saved[n], sha(",".join(map(str, sorted(ends.get(n, [])))))) for n, m in members.items()], key=repr)


def found(df, rebuild=False):
    conv = F.col("conv")
    how = {"donor": conv - conv % 20, "borrowed": F.crc32(conv.cast("string").cast("binary")) % 4, "most": 3}
    return rows(trie.prefix_trie(df, **(how if rebuild else {})), *COLUMNS)


def chats(seed, n, longest=9):
    """Conversations that share first turns, copies among them, and a hot first turn."""
    rng = random.Random(seed)
    table = []
    for c in range(n):
        turns = rng.randrange(1, longest)
        for t in range(turns):
            word = "hot" if t == 0 and c % 3 == 0 else rng.choice("ab")
            table.append((c, t, rng.choice(["user", "user", "assistant"]) if t else "user", " ".join([word] * rng.randrange(1, 3))))
    return table


@pytest.fixture
def small_shards(monkeypatch):
    for name, n in (("SHARD_ROWS", 40), ("BLOCK_ROWS", 16), ("CHUNK", 3)):
        monkeypatch.setattr(trie, name, n)


@pytest.mark.parametrize("rebuild", [False, True])
def test_equals_brute_force(scan, small_shards, rebuild):
    table = chats(1, 150)
    build = rebuilt if rebuild else sequences
    assert found(scan(table, SCHEMA), rebuild) == brute(build(table))


def test_one_shard_takes_all_below_the_root(scan):
    table = chats(2, 60)
    assert found(scan(table, SCHEMA), rebuild=True) == brute(rebuilt(table))


def test_odd_rows(scan, small_shards):
    table = [(5, None, "user", "first"), (5, 0, None, None), (5, 0, "user", ""), (5, 0, "user", ""), (5, 3, "a\n", "b"),
             (6, 0, "a", "\nb"), (6, 1, "", "x " * 50_000), (None, 0, "user", "nobody"), (7, 0, "user", "short"),
             (40, 1, "user", "é \u3000 ü"), (41, 0, "user", "é \u3000 ü"), (-3, 0, "user", "below zero")]
    df = scan(table, SCHEMA).withColumns({c: F.lit(1) for c in ("conv", "p0", "depth", "words", "said", "block", "len", "head")})
    assert found(df) == brute(sequences(table))
    above = [r for r in table if r[0] is None or r[0] >= 0]
    assert found(df.filter("conv_id is null or conv_id >= 0"), rebuild=True) == brute(rebuilt(above))


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA), rebuild=True) == []
    assert found(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []


def test_long_conversations_and_copies(scan, small_shards):
    """Deeper than a shard and longer than a block; copies share the whole chain, and one ends early."""
    table = [(c, t, "user", f"t{t}") for c in (1, 2, 3) for t in range(150 if c < 3 else 90)]
    table += [(100 + c, 0, "user", "t0") for c in range(50)]              # a list of ids longer than a chunk
    table += [(200, t, "user", "same") for t in range(120)]
    assert found(scan(table, SCHEMA, files=5)) == brute(sequences(table))


def test_node_table_is_minimal_and_verified():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2 ** 63, (5000, 2), dtype=np.uint64), axis=0)
    table = trie.NodeTable(keys)
    slots = table.slots(keys)
    assert sorted(slots) == list(range(len(keys)))
    assert (table.slots(keys ^ np.uint64(1)) == -1).all()
    assert len(trie.NodeTable(keys[:0]).slots(keys)) == len(keys)
    assert (trie.NodeTable(keys[:1]).slots(keys[1:]) == -1).all()


def test_registered_query_equals_its_sql(spark):
    from compare import canonical, connect, rows_of_sql
    from statmart.llm import queries
    folder = "/root/testdata/sf0.01"
    got = queries.op13_prefix_trie(spark, folder)
    names, _, want = rows_of_sql(connect(folder), queries.ORACLE_SQL["op13_prefix_trie"])
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(names, want)
    assert want
