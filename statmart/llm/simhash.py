"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

Two 64-bit fingerprints that differ in at most three bits differ in at most three of their eight bytes, so they share at
least five bytes at equal positions: the guaranteed minimum of matches. Postings for single bytes would be 256 lists per
position and every pair would meet in one of them, so the index holds four positions at once: the fourteen 4-subsets of
{0..7} whose numbers XOR to zero. Any five positions contain exactly one of them, so any pair with five shared bytes
meets in at least one posting, and a posting needs 32 equal bits to collect company. Where two fingerprints meet, the
shared positional bytes are tallied, pairs with fewer than the minimum go, and the rest is verified by its bit distance.
(At most three differing bits leave five equal bytes, so beside the verification the count filter only saves work.)

All pairs of a posting are compared only up to ``SPLIT`` fingerprints. A larger one is dealt by each of its four other
bytes: of those at least one is still shared. In a posting with five given bytes a fingerprint is a number of 24 bits, and
where more than ``SPLIT`` of them meet each looks up its neighbours instead, all numbers up to three bits away, in a table
of all such numbers: the work grows with the posting, not with its square, and a posting has a bound of its own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed
from .components import components
from .shared import as_scan, from_text, join_on_hot_key, numbered

FOURS = [c for c in itertools.combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
SPLIT = 2048              # fingerprints of a posting that are compared pair by pair
BRANCHES = 16             # a group is returned as a tree in which a node has at most so many children
_STEP = 1 << 18           # shingles whose bits are counted at once


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of a whole text, as a signed 64-bit number.

    A-Z are lower-cased, words are what blanks separate, shingles are ``width`` words joined by a space, repeats
    included (fewer words: one shingle of all of them; no word or null: 0). A bit is set if more than half of the
    shingles' XXH64 values have it.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: ASCII letters and ASCII blanks only
    if not words:
        return 0
    width = min(width, len(words))
    shingles = zip(*(itertools.islice(words, i, None) for i in range(width)))
    total, ones = 0, np.zeros(64, np.int64)
    while part := b"".join([xxhash.xxh64_digest(b" ".join(s), seed) for s in itertools.islice(shingles, _STEP)]):
        bits = np.unpackbits(np.frombuffer(part, np.uint8)).reshape(-1, 64)
        total += len(bits)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """``df`` with ``fp`` (bigint) in place of its text."""
    return from_text(df, text, "fp bigint", lambda: lambda texts: [[fingerprint(t, width) for t in texts]])


def _find(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    root = parent[at]
    while not np.array_equal(up := parent[root], root):
        root = up
    return root


def _join(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Make one group of each pair."""
    a, b = _find(parent, left), _find(parent, right)
    while (odd := a != b).any():
        a, b = a[odd], b[odd]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        a, b = _find(parent, a), _find(parent, b)


def _trees(parent: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a tree over each group."""
    n = len(fp)
    root = _find(parent, np.arange(n))
    order = np.argsort(root, kind="stable")
    first = np.r_[True, root[order][1:] != root[order][:-1]] if n else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    place = np.arange(n) - start
    child = np.flatnonzero(~first)
    return fp[order[start[child] + (place[child] - 1) // BRANCHES]], fp[order[child]]


def linked_groups(run: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Trees over the fingerprints that are linked within a posting.

    ``run`` numbers the posting of each row, rows of a posting side by side. Every pair inside a posting is tallied and
    verified, at rising distance in the table, but only a tree per group comes back: never more rows than fingerprints.
    """
    n = len(fp)
    parent = np.arange(n)
    left, apart = np.flatnonzero(run[1:] == run[:-1]), 1
    while left.size:
        x = (fp[left] ^ fp[left + apart]).view(np.uint64)      # signed numbers would be counted by absolute value
        shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1)                      # tally of shared positional bytes
        hit = left[(shared >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits)]    # count filter, then verification
        _join(parent, hit, hit + apart)
        apart += 1
        left = left[left + apart < n]
        left = left[run[left] == run[left + apart]]
    return _trees(parent, fp)


def linked_neighbours(fp: np.ndarray, five: tuple[int, ...], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`linked_groups` for one posting whose fingerprints, all different, have the bytes at ``five`` positions in
    common: links between numbers of the 24 other bits, found by looking up every number up to ``max_bits`` bits away."""
    code = np.zeros(len(fp), np.int64)
    for k, p in enumerate(p for p in range(8) if p not in five):
        code |= (fp.view(np.uint64) >> np.uint64(8 * p)).astype(np.int64) % 256 << 8 * k
    at = np.full(1 << 24, -1, np.int32)
    at[code] = np.arange(len(fp))
    parent = np.arange(len(fp))
    for bits in range(1, max_bits + 1):
        for places in itertools.combinations(range(24), bits):
            other = at[code ^ sum(1 << b for b in places)]
            hit = np.flatnonzero(other > np.arange(len(fp)))           # each pair once
            if hit.size:
                _join(parent, hit, other[hit])
    return _trees(parent, fp)


def _link_postings(max_bits: int, split: int):
    def linked(table: pd.DataFrame) -> pd.DataFrame:
        """Links of whole postings."""
        block, part, fp = (table[c].to_numpy() for c in ("block", "part", "fp"))
        border = (block[1:] != block[:-1]) | (part[1:] != part[:-1])
        run = np.cumsum(np.r_[0, border])
        sizes = np.bincount(run)
        large = np.flatnonzero((sizes > split) & (block[np.r_[0, np.flatnonzero(border) + 1]] >= len(FOURS)))
        inside = np.isin(run, large)
        found = [linked_groups(run[~inside], np.ascontiguousarray(fp[~inside]), max_bits)]
        for r in large:
            mine = np.ascontiguousarray(fp[run == r])
            number = int(block[np.searchsorted(run, r)])
            found.append(linked_neighbours(mine, (*FOURS[number % len(FOURS)], number // len(FOURS) - 1), max_bits))
        return pd.DataFrame({"a": np.concatenate([a for a, _ in found]), "b": np.concatenate([b for _, b in found])})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_rows: list[pd.DataFrame] = []                    # the last posting may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            block, part = batch["block"].to_numpy(), batch["part"].to_numpy()
            begin = len(batch) - int(np.argmin(((block == block[-1]) & (part == part[-1]))[::-1])) if \
                (block != block[-1]).any() or (part != part[-1]).any() else 0
            same = bool(open_rows) and open_rows[-1]["block"].iloc[-1] == block[0] and open_rows[-1]["part"].iloc[-1] == part[0]
            if begin == 0 and (same or not open_rows):
                open_rows.append(batch)
                continue
            yield linked(pd.concat([*open_rows, batch.iloc[:begin]], ignore_index=True))
            open_rows = [batch.iloc[begin:]]
        if open_rows:
            yield linked(pd.concat(open_rows, ignore_index=True))
    return work


def _masks(positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >= 1 << 63 else value


def near_links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Distinct ``fp`` -> links (``a``, ``b``) that connect exactly the fingerprints connected by pairs at ``max_bits``.

    ``max_bits`` may be 0 to 3: beyond that the minimum number of shared bytes is no longer five. A posting of more than
    ``SPLIT`` fingerprints is dealt by a fifth byte: of the four positions left at least one is still shared, so no pair is
    lost.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be from 0 to 3")
    blocks = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(_masks(c))).alias("part"))
                       for i, c in enumerate(FOURS)])
    postings = checkpointed(fps.select("fp", F.explode(blocks).alias("p")).select("fp", "p.block", "p.part"))
    # written: Catalyst sees how many they are and joins accordingly
    hot = checkpointed(postings.groupBy("block", "part").agg(F.count("*").alias("n")).filter(F.col("n") > SPLIT).select("block", "part"))
    fifth = F.lit(None)
    for i, c in enumerate(FOURS):
        more = F.array(*[F.struct((F.lit(len(FOURS) * (p + 1) + i)).alias("block"),
                                  F.col("fp").bitwiseAND(F.lit(_masks((*c, p)))).alias("part"))
                         for p in range(8) if p not in c])
        fifth = F.when(F.col("block") == i, more).otherwise(fifth)
    plain = postings.join(hot, ["block", "part"], "left_anti").select("fp", "block", "part")
    split = (
        postings.join(hot, ["block", "part"], "left_semi")
        .select("fp", F.explode(fifth).alias("p")).select("fp", "p.block", "p.part")
    )
    return (
        plain.union(split).repartition("block", "part").sortWithinPartitions("block", "part", "fp")
        .mapInPandas(_link_postings(max_bits, SPLIT), "a bigint, b bigint").distinct()
    )


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """One row per input row: ``row`` (see :func:`shared.numbered`), the id, ``fp``, ``component_id`` (smallest id
    reachable) and ``keeper`` (the row that stands for its group: smallest id, then first row).

    Null ids take part and are last among a group's ids; a group of null ids only has a null ``component_id``. Rows that
    repeat an id are rows of their own. Null, empty and blank texts have fingerprint 0 and link to each other and to any
    fingerprint of up to ``max_bits`` bits. Columns other than id and text are not read.
    """
    slim = numbered(as_scan(df).select(F.col(id_col).alias("id"), F.col(text).alias("text")), "row")
    marked = checkpointed(fingerprints(slim, "text", width))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least")
    distinct = checkpointed(marked.groupBy("fp").agg(least))
    roots = components(near_links(distinct.select("fp"), max_bits))
    linked = checkpointed(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                          .withColumn("root", F.coalesce("root", "fp")))
    of_root = linked.groupBy("root").agg(F.min("least").alias("best"))
    of_fp = checkpointed(join_on_hot_key(linked.select("fp", "root"), of_root, "root").select("fp", "best"))
    return join_on_hot_key(marked, of_fp, "fp").select(
        "row", F.col("id").alias(id_col), "fp", F.col("best.id").alias("component_id"),
        (F.col("best.row") == F.col("row")).alias("keeper"))


def without_near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3,
                            max_bits: int = 3) -> DataFrame:
    """The rows of ``df`` that stand for their group, with all their columns."""
    df = as_scan(df)
    kept = near_duplicates(df, id_col, text, width, max_bits).filter("keeper").select(F.col("row").alias("kept"))
    whole = numbered(df.select(F.struct("*").alias("whole")), "row")
    return whole.join(kept, F.col("row") == F.col("kept"), "left_semi").select("whole.*")
