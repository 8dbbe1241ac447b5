"""Hard negatives by a secondary-sort shuffle.

Scores of anchors with other rows are packed into keys (anchor, descending score, kind, id) whose bytes sort like the
tuple. ``repartitionAndSortWithinPartitions`` deals keys by anchor and sorts them (spilling where needed); an iterator then
reads each anchor's keys once, from the highest score down. A positive opens a window below its score, negatives that
pass are emitted to every open window, and a window closes when it is full or the score has left it: the state is a
handful of windows, never an anchor's rows. At equal scores positives come first, so that a tie is inside the window.

Only keys that may matter are shuffled. A first pass finds each anchor's first positives (their own secondary sort); a
second one knows the windows and keeps, per task and window, as many negatives as the window can hold. Anchors and rows
are dealt into cells (anchor block, slice of rows); a task streams the slice past the block. Each row meets each anchor,
which is what the exact answer asks for, but what leaves a task is bounded by its anchors, whatever the labels are like.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .topk import scaled

ANCHOR_BLOCK = 4096       # anchors of a cell, on average
SLICE_ROWS = 4096         # rows of a cell, at least
MAX_SLICES = 512          # larger tables have longer slices instead of more of them
_STEP = 1024              # rows multiplied out at once

_SIGN = 1 << 63
_KEY = np.dtype([("anchor", ">u8"), ("below", ">u8"), ("kind", "u1"), ("id", ">u8")])
POSITIVE, NEGATIVE = 0, 1


@dataclass(frozen=True)
class Windows:
    """How many positives open a window, how many negatives one takes, and its edges in percent of the positive's score."""
    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100

    def __post_init__(self):
        if self.high > 100:
            raise ValueError("a window must not begin above its positive: keys are read from the highest score down")

    def bounds(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score inside the window of a positive."""
        return -((-self.low * score) // 100), (self.high * score) // 100


def packed(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.Array:
    """Keys as binary: unsigned big-endian numbers, so that bytes sort by anchor, descending score, kind, id."""
    keys = np.empty(len(anchor), _KEY)
    flipped = lambda x: x.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    keys["anchor"], keys["below"], keys["kind"], keys["id"] = flipped(anchor), ~flipped(score), kind, flipped(ids)
    ends = np.arange(len(keys) + 1, dtype=np.int32) * _KEY.itemsize
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(keys.tobytes())])


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    """anchor, score, kind, id."""
    number = lambda at: int.from_bytes(key[at:at + 8], "big")
    return number(0) - _SIGN, _SIGN - 1 - number(8), key[16], number(17) - _SIGN


def first_positives(keys: Iterable[tuple[bytes, None]], windows: Windows) -> Iterator[tuple[int, int, int]]:
    """Sorted keys of positives -> anchor, id and score of the first of each anchor."""
    anchor, taken = None, 0
    for key, _ in keys:
        a, score, _, i = unpacked(key)
        if a != anchor:
            anchor, taken = a, 0
        if taken < windows.positives:
            taken += 1
            yield a, i, score


def through_windows(keys: Iterable[tuple[bytes, None]], windows: Windows) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Sorted keys -> anchor, positive, rank, negative, positive's score, negative's score."""
    anchor, opened = None, []
    for key, _ in keys:
        a, score, kind, i = unpacked(key)
        if a != anchor:
            anchor, opened = a, []
        if kind == POSITIVE:
            opened.append([i, score, 0])
            continue
        for w in opened:
            if windows.low * w[1] <= 100 * score <= windows.high * w[1]:
                w[2] += 1
                yield a, w[0], w[2], i, w[1], score
        opened = [w for w in opened if w[2] < windows.negatives and windows.low * w[1] <= 100 * score]


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width; a shorter vector counts as ending in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class _Cell:
    """One block of anchors, and the best keys of the rows that have passed so far."""

    def __init__(self, width: int, windows: Windows, wanted: bool, step: int):
        # wanted: windows are known, negatives are sought
        self.width, self.windows, self.wanted, self.step = width, windows, wanted, step
        self.parts: list[tuple] = []
        self.ids = None

    def anchors(self, ids: np.ndarray, vectors: np.ndarray, labels: list, tops: list) -> None:
        self.parts.append((ids, vectors, labels, tops))

    def _begin(self) -> None:
        self.ids = np.concatenate([p[0] for p in self.parts])
        self.matrix = np.concatenate([p[1] for p in self.parts])
        self.labels = pd.Index(sorted({x for p in self.parts for x in p[2]}))
        self.codes = self.labels.get_indexer([x for p in self.parts for x in p[2]])
        slots = self.windows.positives if self.wanted else 1
        keep = self.windows.negatives if self.wanted else self.windows.positives
        if self.wanted:
            # an empty place gets a window that nothing fits
            self.least = np.full((len(self.ids), slots), 1, np.int64)
            self.most = np.full((len(self.ids), slots), 0, np.int64)
            for row, top in enumerate(x for p in self.parts for x in p[3]):
                if top:
                    self.least[row, :len(top)], self.most[row, :len(top)] = self.windows.bounds(np.array(top, np.int64))
        self.low = -np.iinfo(np.int64).max
        self.best = np.full((slots, len(self.ids), keep), self.low)
        self.best_id = np.full((slots, len(self.ids), keep), np.iinfo(np.int64).max)
        self.parts = []

    def rows(self, ids: np.ndarray, vectors: np.ndarray, labels: list) -> None:
        if self.ids is None:
            if not self.parts:
                return
            self._begin()
        codes = self.labels.get_indexer(labels)
        for at in range(0, len(ids), self.step):
            part = at + np.argsort(ids[at:at + self.step], kind="stable")
            self._multiply(ids[part], vectors[part], codes[part])

    def _multiply(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray) -> None:
        largest = float(np.abs(self.matrix).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * self.width
        kind = np.float64 if largest < 2 ** 53 else np.int64               # products of doubles are exact up to there
        score = (self.matrix.astype(kind) @ vectors.astype(kind).T).astype(np.int64)
        same = self.codes[:, None] == codes[None, :]
        if not self.wanted:
            self._keep(0, score, same & (self.ids[:, None] != ids[None, :]), ids)
            return
        for slot in range(self.windows.positives):
            fits = ~same & (score >= self.least[:, slot, None]) & (score <= self.most[:, slot, None])
            self._keep(slot, score, fits, ids)

    def _keep(self, slot: int, score: np.ndarray, fits: np.ndarray, ids: np.ndarray) -> None:
        """Merge the best of these rows into the best so far; ``ids`` rise, so an earlier column wins a tie."""
        hit = np.flatnonzero(fits.any(1))
        if not hit.size:
            return
        keep = self.best.shape[2]
        found = np.where(fits[hit], score[hit], self.low)
        near = ids
        n = found.shape[1]
        if n > keep:
            if float(np.abs(score).max(initial=0)) * n < 2 ** 62:          # one number orders by score, then by place
                rank = np.where(fits[hit], found * n + np.arange(n - 1, -1, -1), self.low)
                pick = np.argpartition(rank, n - keep, axis=1)[:, n - keep:]
            else:
                pick = np.argsort(-found, axis=1, kind="stable")[:, :keep]
            found, near = np.take_along_axis(found, pick, 1), ids[pick]
        else:
            near = np.broadcast_to(near, found.shape)
        scores = np.concatenate([self.best[slot, hit], found], 1)
        places = np.concatenate([self.best_id[slot, hit], near], 1)
        pick = np.lexsort((places, -scores), axis=1)[:, :keep]
        self.best[slot, hit] = np.take_along_axis(scores, pick, 1)
        self.best_id[slot, hit] = np.take_along_axis(places, pick, 1)

    def keys(self) -> pa.Array:
        """What this cell has found; a negative of several windows once."""
        if self.ids is None:
            return pa.array([], pa.binary())
        _, row, _ = at = np.nonzero(self.best > self.low)
        found = np.unique(np.stack([row, self.best[at], self.best_id[at]], 1), axis=0)
        return packed(self.ids[found[:, 0]], found[:, 1], NEGATIVE if self.wanted else POSITIVE, found[:, 2])


def _stream(width: int, windows: Windows, wanted: bool, step: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, now = None, None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])) + 1
            for at, to in zip([0, *edges], [*edges, len(cells)]):
                part = batch.slice(at, to - at)
                if not part.num_rows:
                    continue
                if cells[at] != now:
                    if cell is not None:
                        yield pa.RecordBatch.from_arrays([cell.keys()], names=["key"])
                    cell, now = _Cell(width, windows, wanted, step), cells[at]
                ids, labels = part.column("id").to_numpy(), part.column("label").to_pylist()
                vectors = _vectors(part.column("v"), width)
                if asks[at]:
                    cell.anchors(ids, vectors, labels, part.column("tops").to_pylist())
                else:
                    cell.rows(ids, vectors, labels)
        if cell is not None:
            yield pa.RecordBatch.from_arrays([cell.keys()], names=["key"])
    return work


def _sorted_keys(keys: DataFrame):
    """The secondary sort: an anchor's keys in one partition, in order."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(
        parts, lambda key: zlib.crc32(key[:8]))


def mined(df: DataFrame, is_anchor: Column, label: Column, windows: Windows = Windows(), id_col: str = "vec_id",
          vector: str = "embedding", factor: float = 256.0) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    A row's score is its integer inner product with the anchor; higher ones come first, ties by smaller id. An anchor's
    positives are its first other rows of the same label. Each is returned with the first rows of another label whose
    score lies in its window, ends included; a positive with an empty window has no row.

    Rows without an id or a label, and vectors that are null or hold a null or non-finite component, take no part. Rows
    that repeat an id count once (the smallest vector, then the smallest label). A shorter vector counts as ending in
    zeros, an empty one as zeros only. Components, and scores times 100, must fit 64 bits. An empty table, or one without
    anchors, gives no row. Other columns are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector), factor).alias("v"),
                     label.cast("string").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    good = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.col("label").isNotNull())
    table = checkpointed(good.groupBy("id").agg(F.min(F.struct("v", "label")).alias("least"), F.max("asks").alias("asks"))
                         .select("id", "least.v", "least.label", "asks"))
    total, asking, width = table.agg(F.count("*"), F.count_if("asks"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width = max(1, width)
    slices = max(1, min(MAX_SLICES, -(-total // SLICE_ROWS)))
    blocks = max(1, -(-asking // ANCHOR_BLOCK))
    dealt = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n))
    passing = table.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), dealt(slices, 1).alias("slice"),
        F.lit(False).alias("asks"), "id", "v", "label", F.lit(None).cast("array<bigint>").alias("tops"))

    def keys(anchors: DataFrame, wanted: bool) -> DataFrame:
        """``anchors``: with ``tops``, the scores of their positives, where windows are known."""
        standing = anchors.select(
            dealt(blocks, 2).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
            F.lit(True).alias("asks"), "id", "v", "label", "tops")
        cells = standing.unionByName(passing, allowMissingColumns=True).withColumn(
            "cell", (F.col("block") * slices + F.col("slice")).cast("long")).drop("block", "slice")
        parts = min(blocks * slices, 20_000)
        return (
            cells.repartitionById(parts, F.pmod("cell", F.lit(parts)).cast("int"))
            .sortWithinPartitions("cell", F.col("asks").desc())            # the anchors of a cell come first
            .mapInArrow(_stream(width, windows, wanted, _STEP), "key binary")
        )

    anchors = table.filter("asks").select("id", "v", "label")
    some = checkpointed(keys(anchors.withColumn("tops", F.lit(None).cast("array<bigint>")), wanted=False))
    first = checkpointed(spark.createDataFrame(
        _sorted_keys(some).mapPartitions(lambda part: first_positives(part, windows)), "anchor bigint, id bigint, score bigint"))
    tops = first.groupBy(F.col("anchor").alias("id")).agg(F.collect_list("score").alias("tops"))
    negatives = checkpointed(keys(anchors.join(tops, "id"), wanted=True))

    def opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [packed(*(b.column(c).to_numpy() for c in ("anchor", "score")), POSITIVE, b.column("id").to_numpy())], names=["key"])

    both = first.mapInArrow(opening, "key binary").unionByName(negatives)
    return spark.createDataFrame(
        _sorted_keys(both).mapPartitions(lambda part: through_windows(part, windows)),
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
