"""The trie of conversation prefixes, over a minimal-perfect-hash node table.

A prefix is known by a digest of 128 bits: the sum of what its turns hash to at their places. Sums add up in any order, so
a conversation's prefixes are running sums inside blocks of places plus what the blocks before add up to, and a very long
conversation is spread over tasks like any other rows. The parent's digest is the same sum without the last turn.

A shard holds whole subtrees, at most ``SHARD_ROWS`` prefixes each: its distinct digests get the slots of a minimal perfect
hash, each look-up is verified against the digest in the slot, counts are scattered into flat arrays, and sums run through
the array of parent slots from the deepest level up. How many prefixes lie below a digest needs no trie: every member adds
what is left of its length. Digests with more than that below them, such as a first turn that a third of all conversations
share, are the trunk above the shards: they are aggregated before any shuffle, and their sums follow by doubling the
distance to an ancestor, so that the rounds grow with the logarithm of the trunk's depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.keys import contiguous_keys
from ..session import checkpointed
from .shared import whole_text, words_of

SHARD_ROWS = 2048         # prefixes of a subtree that one shard takes whole, and of a shard on average
BLOCK_ROWS = 4096         # places of a conversation that are summed together
CHUNK = 4096              # ids of a chunk of a long list that is hashed
_LANES = ("a", "b", "c", "d")
_MASK = 0xFFFFFFFF
NO_ENDS = hashlib.sha256(b"").hexdigest()


class NodeTable:
    """Minimal perfect hash: distinct digests -> slots 0 to n - 1, verified.

    On each level every digest left takes a place; those alone at theirs are settled, the others go on to the next level
    with another hash. A slot is the number of settled places before it.
    """

    def __init__(self, keys: np.ndarray):
        """``keys``: n x 2 unsigned numbers, distinct."""
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []            # places: settled there, slots before
        self.stored = np.empty_like(keys)
        left, slots = keys, 0
        while len(left):
            size = 2 * len(left) + 1
            at = self._place(left, len(self.levels), size)
            settled = np.bincount(at, minlength=size) == 1
            self.levels.append((settled, slots + np.cumsum(settled) - settled))
            alone = settled[at]
            self.stored[self.levels[-1][1][at[alone]]] = left[alone]
            slots += int(settled.sum())
            left = left[~alone]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        h = keys[:, 0] ^ (keys[:, 1] + np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) % (1 << 64)))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return ((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for one that is not in the table."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (settled, before) in enumerate(self.levels):
            at = self._place(keys[left], level, len(settled))
            here = settled[at]
            slot = before[at[here]]
            same = (self.stored[slot] == keys[left[here]]).all(1)        # another digest may sit where this one would
            out[left[here][same]] = slot[same]
            left = left[~here]
        return out


_NODE = """p0 bigint, p1 bigint, q0 bigint, q1 bigint, conv bigint, depth bigint, parent_conv bigint, inside boolean,
           n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends string"""


def shard_nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """All nodes of a shard from its prefixes (``conv``, ``depth``, ``words``, ``last``, digest ``p``, parent's ``q``)."""
    digest = lambda x: rows[[f"{x}0", f"{x}1"]].to_numpy(np.int64).view(np.uint64)
    own, above = digest("p"), digest("q")
    table = NodeTable(np.unique(own, axis=0))
    n = len(table.stored)
    slot = table.slots(own)
    conv, level, words = (rows[c].to_numpy(np.int64) for c in ("conv", "depth", "words"))

    depth, heard, upper = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, 2), np.uint64)
    depth[slot], heard[slot], upper[slot] = level, words, above
    if (slot < 0).any() or (depth[slot] != level).any() or (heard[slot] != words).any() or (upper[slot] != above).any():
        raise RuntimeError("two different prefixes have one digest")
    parent = table.slots(upper)
    convs = np.bincount(slot, minlength=n)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, slot, conv)
    inside = parent >= 0
    children = np.bincount(parent[inside], minlength=n)
    leaves = (children == 0).astype(np.int64)
    saved = (convs - 1) * heard
    by_depth = np.argsort(-depth, kind="stable")
    for part in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
        part = part[inside[part]]
        np.add.at(leaves, parent[part], leaves[part])
        np.add.at(saved, parent[part], saved[part])

    ends = np.full(n, NO_ENDS, object)
    last = np.flatnonzero(rows["last"].to_numpy(bool))
    last = last[np.lexsort((conv[last], slot[last]))]
    for part in np.split(last, np.flatnonzero(np.diff(slot[last])) + 1):
        if part.size:
            ends[slot[part[0]]] = hashlib.sha256(",".join(map(str, conv[part].tolist())).encode()).hexdigest()
    signed, up = table.stored.view(np.int64), upper.view(np.int64)
    return pd.DataFrame({
        "p0": signed[:, 0], "p1": signed[:, 1], "q0": up[:, 0], "q1": up[:, 1], "conv": least, "depth": depth,
        "parent_conv": pd.Series(least[parent], dtype="Int64").mask(~inside),
        "inside": inside, "n_convs": convs, "n_children": children, "n_leaves": leaves, "saved": saved, "ends": ends})


def _chunks(size: int):
    """Ids sorted by digest and id -> a digest's ids, joined in pieces of at most ``size``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"p0": [now[0]], "p1": [now[1]], "first": [ids[0]], "text": [",".join(map(str, ids))]})

        for batch in batches:
            for key0, key1, conv in zip(*(batch.column(c).to_pylist() for c in ("p0", "p1", "conv"))):
                if ids and (now != (key0, key1) or len(ids) >= size):
                    yield made()
                    ids = []
                now = (key0, key1)
                ids.append(conv)
        if ids:
            yield made()
    return work


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by digest and first id -> the digest's SHA-256; one chunk at a time is held."""
    now, state = None, None
    for batch in batches:
        for key0, key1, text in zip(*(batch.column(c).to_pylist() for c in ("p0", "p1", "text"))):
            if now != (key0, key1):
                if state:
                    yield pa.RecordBatch.from_pydict({"p0": [now[0]], "p1": [now[1]], "ends": [state.hexdigest()]})
                now, state = (key0, key1), hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
    if state:
        yield pa.RecordBatch.from_pydict({"p0": [now[0]], "p1": [now[1]], "ends": [state.hexdigest()]})


def hashed_lists(ids: DataFrame) -> DataFrame:
    """``p0``, ``p1``, ``conv`` -> ``ends``: SHA-256 of the rising ids of each digest, comma-joined.

    Sorted in parallel, a long list over several tasks; what meets in one task is one row for ``CHUNK`` ids.
    """
    pieces = ids.repartitionByRange("p0", "p1", "conv").sortWithinPartitions("p0", "p1", "conv").mapInArrow(
        _chunks(CHUNK), "p0 bigint, p1 bigint, first bigint, text string")
    return pieces.repartition("p0", "p1").sortWithinPartitions("p0", "p1", "first").mapInArrow(
        _hashed, "p0 bigint, p1 bigint, ends string")


def prefixes(df: DataFrame, conv_id: str, turn: str, role: str, text: str, donor: Column | None, borrowed: Column | None,
             most: int) -> tuple[DataFrame, DataFrame]:
    """Two written tables: a row per rebuilt turn (``conv``, ``depth``, ``len``, ``words``, ``p0``, ``p1``, ``q0``, ``q1``),
    and one per conversation (``conv``, ``len``)."""
    body, name = whole_text(text), whole_text(role)
    known = df.filter(F.col(conv_id).cast("long").isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.unhex(F.substring(F.sha2(F.concat(F.length(name).cast("string"), F.lit(":"), name, body), 256), 1, 32)).alias("said"),
        F.size(words_of(body)).cast("long").alias("words"))
    placed = contiguous_keys(known, ["conv", "turn", "said"], "place", spread_copies=True).withColumn(
        "block", F.expr(f"place div {BLOCK_ROWS}"))
    parts = checkpointed(placed.groupBy("conv", "block").agg(F.min("place").alias("first"), F.count("*").alias("n")))
    convs = parts.groupBy("conv").agg(F.min("first").alias("first"), F.sum("n").alias("own"))
    starts = parts.select("conv", "block").join(convs, "conv")
    numbered = placed.join(starts, ["conv", "block"]).withColumn("nth", F.col("place") - F.col("first") + 1)

    none = F.lit(None).cast("long")
    asked = convs.select("conv", "own", (donor if donor is not None else none).alias("donor"),
                         (F.least(borrowed, F.lit(most)) if borrowed is not None else F.lit(0)).cast("long").alias("skip"))
    heads = numbered.filter(F.col("nth") <= most).groupBy(F.col("conv").alias("donor")).agg(
        F.array_sort(F.collect_list(F.struct("nth", "said", "words"))).alias("head"))
    built = checkpointed(
        asked.join(heads, "donor", "left")
        .withColumn("head", F.coalesce(F.filter("head", lambda t: t["nth"] <= F.col("skip")), F.array().cast(dict(heads.dtypes)["head"])))
        .withColumn("taken", F.size("head").cast("long"))
        .withColumn("len", F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("skip")))
        .select("conv", "skip", "taken", "len", "head"))
    lead = built.select("conv", F.lit(-1).cast("long").alias("block"), "len", F.explode("head").alias("t")).select(
        "conv", "block", "len", F.col("t.nth").alias("depth"), "t.said", "t.words")
    follow = numbered.join(parts.select("conv", "block").join(built.drop("head"), "conv"), ["conv", "block"]) \
        .filter(F.col("nth") > F.col("skip")) \
        .select("conv", "block", "len", (F.col("taken") + F.col("nth") - F.col("skip")).alias("depth"), "said", "words")

    hashed = lead.unionByName(follow).withColumns({f"h{i}": F.xxhash64(F.lit(i), "depth", "said") for i in (0, 1)})
    turns = hashed.select("conv", "block", "len", "depth", "words", *[
        half.alias(x) for x, half in zip(_LANES, [w for i in (0, 1) for w in (
            F.shiftrightunsigned(f"h{i}", 32), F.col(f"h{i}").bitwiseAND(F.lit(_MASK)))])])
    inner = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = turns.withColumns({f"s{x}": F.sum(x).over(inner) for x in _LANES})
    # one row for each block of a conversation
    totals = turns.groupBy("conv", "block").agg(*[F.sum(x).alias(x) for x in _LANES])
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv", "block", *[
        F.coalesce(F.sum(F.col(x).bitwiseAND(F.lit(_MASK))).over(before), F.lit(0)).alias(f"b{x}") for x in _LANES])
    here = {x: (F.col(f"s{x}") + F.col(f"b{x}")) for x in _LANES}
    folded = lambda lanes, i: F.shiftleft(lanes[2 * i].bitwiseAND(F.lit(_MASK)), 32).bitwiseOR(
        lanes[2 * i + 1].bitwiseAND(F.lit(_MASK)))
    own, above = [here[x] for x in _LANES], [here[x] - F.col(x) for x in _LANES]
    paths = summed.join(carried, ["conv", "block"]).select(
        "conv", "depth", "len", "words", folded(own, 0).alias("p0"), folded(own, 1).alias("p1"),
        folded(above, 0).alias("q0"), folded(above, 1).alias("q1"))
    return checkpointed(paths), built.select("conv", "len")


def _doubled(trunk: DataFrame, deepest: int) -> DataFrame:
    """``p``, ``q``, ``leaves``, ``saved`` of each trunk node -> the sums over its subtree.

    After round k a node has the sums of its descendants nearer than 2 ** k, and its ancestor at that distance.
    """
    key = ["p0", "p1"]
    state = trunk.select(*key, F.col("q0").alias("j0"), F.col("q1").alias("j1"), "leaves", "saved")
    reach = 1
    while reach <= deepest:
        more = state.filter(F.col("j0").isNotNull()).groupBy(F.col("j0").alias("p0"), F.col("j1").alias("p1")).agg(
            F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        further = state.select(F.col("p0").alias("j0"), F.col("p1").alias("j1"), F.col("j0").alias("k0"), F.col("j1").alias("k1"))
        state = checkpointed(
            state.join(more, key, "left").join(further, ["j0", "j1"], "left").select(
                *key, F.col("k0").alias("j0"), F.col("k1").alias("j1"),
                (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")))
        reach *= 2
    return state.drop("j0", "j1")


def prefix_trie(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                donor: Column | None = None, borrowed: Column | None = None, most: int = 0) -> DataFrame:
    """One row per distinct prefix: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's ``conv_id``,
    null for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of its subtree, itself included),
    ``saved_tokens`` (over its subtree: words of the last text times members but one), ``ends_sha256`` (SHA-256 of the
    rising ids of members that end here, comma-joined).

    With ``donor`` and ``borrowed`` (expressions on ``conv``), a conversation is rebuilt first: its first ``borrowed`` turns
    (``most`` at most) make way for as many turns of the conversation ``donor``, or fewer if that is shorter or absent.

    Turns are ordered by ``turn``, nulls first, equal ones by a digest of role and text; repeated rows are turns of their
    own. A null role or text is empty. Rows without a conversation id take no part. A conversation that is left without
    turns ends at the root. An empty table has no node. Other columns are not read.
    """
    paths, convs = prefixes(df, conv_id, turn, role, text, donor, borrowed, most)
    key = ["p0", "p1"]
    below = paths.groupBy(*key).agg(F.sum(F.col("len") - F.col("depth") + 1).alias("below"))
    heavy = checkpointed(below.filter(F.col("below") > SHARD_ROWS).select(*key))

    light = paths.join(heavy, key, "left_anti")
    top = F.min(F.struct("depth", *key)).over(Window.partitionBy("conv"))       # at most SHARD_ROWS rows each
    shards = max(1, -(-light.count() // SHARD_ROWS))
    dealt = light.withColumn("top", top).select(
        "conv", "depth", "words", (F.col("depth") == F.col("len")).alias("last"), *key, "q0", "q1",
        F.pmod(F.xxhash64("top.p0", "top.p1"), F.lit(shards)).alias("shard"))
    nodes = checkpointed(dealt.groupBy("shard").applyInPandas(shard_nodes, _NODE))

    members = paths.join(heavy, key, "left_semi")
    absent = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("p0"), zero.alias("p1"), absent.alias("q0"), absent.alias("q1"), "conv", zero.alias("depth"), zero.alias("words"), "n_convs")
    stems = members.groupBy(*key).agg(
        F.min("q0").alias("q0"), F.min("q1").alias("q1"), F.min("conv").alias("conv"), F.max("depth").alias("depth"),
        F.max("words").alias("words"), F.count("*").alias("n_convs")).unionByName(root)
    stems = checkpointed(stems)
    grown = nodes.filter("not inside").select("q0", "q1", "n_leaves", "saved").unionByName(
        stems.filter(F.col("q0").isNotNull()).select("q0", "q1", zero.alias("n_leaves"), zero.alias("saved")))
    arms = grown.groupBy(F.col("q0").alias("p0"), F.col("q1").alias("p1")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    of = lambda c: F.coalesce(c, zero)
    trunk = checkpointed(stems.join(arms, key, "left").select(
        *key, "q0", "q1", "conv", "depth", "n_convs", of("n_children").alias("n_children"),
        F.when(of("n_children") == 0, 1).otherwise(of("leaves")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words") + of("saved")).alias("saved")))
    deepest = trunk.agg(F.coalesce(F.max("depth"), zero)).first()[0]
    sums = _doubled(trunk, deepest).select(*key, F.col("leaves").alias("n_leaves"), "saved")
    over = hashed_lists(members.filter("depth = len").select(*key, "conv").unionByName(
        convs.filter("len = 0").select(zero.alias("p0"), zero.alias("p1"), "conv")))
    tall = trunk.drop("leaves", "saved").join(sums, key).join(over, key, "left").withColumn("ends", F.coalesce("ends", F.lit(NO_ENDS)))

    answer = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    names = trunk.select(F.col("p0").alias("q0"), F.col("p1").alias("q1"), F.col("conv").alias("parent_conv"))
    upper = tall.unionByName(nodes.filter("not inside").drop("inside", "parent_conv")).join(names, ["q0", "q1"], "left")
    out = nodes.filter("inside").select(*answer).unionByName(upper.select(*answer))
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
                      "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
