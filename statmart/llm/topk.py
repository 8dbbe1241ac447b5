"""Exact top-k search by inner product.

Vectors are cut into blocks by descending length. All are rotated by the singular vectors of the whole table, which
gathers as much of every product as possible in the first few components. A block meets a block of queries: the partial
sum over the leading components plus the product of the residual lengths (Cauchy-Schwarz) bounds a score from above, and
only what may still enter a query's best k is multiplied out. The first block, with the longest vectors, is searched
first; its k-th score then rules out whole blocks by length alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.keys import contiguous_keys
from ..session import checkpointed

BLOCK = 4096              # candidates of a block
QUERY_BLOCK = 4096
LEAD = 0.5                # share of the components in the partial sum
_STEP = 512               # candidates tried at once


def scaled(vector: Column, factor: float = 64.0) -> Column:
    """Each component times ``factor``, in double, rounded down; null if the vector or a component is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(F.coalesce(good, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; a shorter vector counts as ending in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthogonal matrix of the right singular vectors of the whole table, strongest first.

    Tasks add up products of components; the sum of ``width`` squared numbers comes to the driver, whatever the rows.
    """
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for b in batches:
            m = _matrix(b["v"], width).astype(float)
            total += m.T @ m
        i, j = np.indices((width, width))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "x": total.ravel()})

    gram = np.zeros((width, width))
    for r in vectors.select("v").mapInPandas(work, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        gram[r["i"], r["j"]] = r["x"]
    _, axes = np.linalg.eigh(gram)
    return axes[:, ::-1]


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """``id``, ``v`` -> also ``norm2`` and ``block`` (from 0): longest vectors first, ``size`` rows each.

    Places come from a parallel sort, so blocks are the same however the table is partitioned.
    """
    measured = vectors.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    placed = contiguous_keys(measured.withColumn("shorter", -F.col("norm2")), ["shorter", "id"], "place")
    return placed.select("id", "v", "norm2", F.expr(f"(place - 1) div {size}").alias("block"))


def search_cell(query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                axes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best ``k`` of a block for each query of a block: query positions, ids, scores. ``least``: known k-th scores."""
    lead = max(1, int(len(axes) * LEAD))
    order = np.lexsort((ids, -np.einsum("ij,ij->i", vectors.astype(float), vectors.astype(float))))
    ids, vectors = ids[order], vectors[order]
    turned_q, turned_v = queries @ axes, vectors @ axes
    tail_q = np.sqrt((turned_q[:, lead:] ** 2).sum(1))
    tail_v = np.sqrt((turned_v[:, lead:] ** 2).sum(1))
    long_q, long_v = np.sqrt((turned_q ** 2).sum(1)), np.sqrt((turned_v ** 2).sum(1))
    slack = 1e-9 * (1 + long_q * (long_v[0] if len(long_v) else 0))       # for rounding of the bounds, never of scores
    exact = float if float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * len(axes) < 2 ** 53 else np.int64
    q_exact, v_exact = queries.astype(exact), vectors.astype(exact)
    lowest = -np.iinfo(np.int64).max          # its negative is a number, too
    best = np.full((len(queries), k), lowest)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    bar = least.astype(float) if len(least) else least
    for at in range(0, len(vectors), _STEP):
        to = slice(at, at + _STEP)
        rows = np.flatnonzero(long_q * long_v[at] + slack >= bar)         # lengths alone: the rest of the block is shorter
        if not rows.size:
            break
        bound = turned_q[rows, :lead] @ turned_v[to, :lead].T + tail_q[rows, None] * tail_v[None, to]
        maybe = bound + slack[rows, None] >= bar[rows, None]
        some = maybe.any(1)
        rows, maybe = rows[some], maybe[some]
        if not rows.size:
            continue
        score = np.where(maybe, (q_exact[rows] @ v_exact[to].T).astype(np.int64), lowest)
        by_id = np.argsort(ids[to], kind="stable")
        score, near = score[:, by_id], ids[to][by_id]
        score[query_ids[rows, None] == near[None, :]] = lowest
        n = score.shape[1]
        if n > k and exact is float:           # one number orders by score, then by smaller id
            rank = np.where(score > lowest, score * n + np.arange(n - 1, -1, -1), lowest)
            pick = np.argpartition(rank, n - k, axis=1)[:, n - k:]
            score, near = np.take_along_axis(score, pick, 1), near[pick]
        else:
            near = np.broadcast_to(near, score.shape)
        all_scores = np.concatenate([best[rows], score], axis=1)
        all_ids = np.concatenate([best_id[rows], near], axis=1)
        pick = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        best[rows] = np.take_along_axis(all_scores, pick, 1)
        best_id[rows] = np.take_along_axis(all_ids, pick, 1)
        full = best[:, -1] > lowest
        bar = np.where(full, np.maximum(bar, best[:, -1].astype(float)), bar)
    q, place = np.nonzero(best > lowest)
    return q, best_id[q, place], best[q, place]


_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _search(axes: np.ndarray, k: int):
    width = len(axes)

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        q, c = rows[rows["asks"]], rows[~rows["asks"]]
        at, ids, scores = search_cell(q["id"].to_numpy(np.int64), _matrix(q["v"], width), q["least"].to_numpy(float),
                                      c["id"].to_numpy(np.int64), _matrix(c["v"], width), axes, k)
        return pd.DataFrame({"query_id": q["id"].to_numpy(np.int64)[at], "vec_id": ids, "score": scores})

    return work


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector: str = "embedding",
          factor: float = 64.0) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row where ``is_query`` the ``k`` largest integer
    inner products with all other rows, ties to the smaller id; all, if there are fewer.

    Rows without an id, and vectors that are null or hold a null or non-finite component, take no part. Rows that repeat
    an id count once (the smallest vector in array order). A shorter vector counts as ending in zeros, an empty one as
    zeros only. Components and scores must fit 64 bits. Columns other than id, vector and those of ``is_query`` are not
    read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector), factor).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    once = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).groupBy("id").agg(
        F.min("v").alias("v"), F.max("asks").alias("asks"))
    table = checkpointed(once)
    width = max(1, table.agg(F.coalesce(F.max(F.size("v")), F.lit(1))).first()[0])
    axes = rotation(table, width)

    candidates = checkpointed(blocks(table.select("id", "v"), BLOCK))
    asking = checkpointed(blocks(table.filter("asks").select("id", "v"), QUERY_BLOCK)).withColumnRenamed("block", "qb")
    sizes = checkpointed(candidates.groupBy("block").agg(F.max("norm2").alias("longest")))
    work = _search(axes, k)

    def cells(met: DataFrame, query_side: DataFrame) -> DataFrame:
        """``met``: pairs (``qb``, ``block``) to search; both sides go to their cells, each of bounded size."""
        q = query_side.join(met, "qb").select("qb", "block", "id", "v", "least", F.lit(True).alias("asks"))
        c = candidates.join(met, "block").select("qb", "block", "id", "v", F.lit(None).cast("double").alias("least"), F.lit(False).alias("asks"))
        return q.unionByName(c).groupBy("qb", "block").applyInPandas(work, _FOUND)

    query_blocks = asking.select("qb").distinct()
    seeds = query_blocks.withColumn("block", F.lit(0).cast("long"))
    none = F.lit(float("-inf"))
    first = checkpointed(_best(cells(seeds, asking.withColumn("least", none)), k))
    known = first.groupBy("query_id").agg(F.min(F.when(F.col("rank") == k, F.col("score").cast("double"))).alias("least"))
    aware = checkpointed(asking.join(known, asking["id"] == known["query_id"], "left").drop("query_id")
                         .withColumn("least", F.coalesce("least", none)))
    # a block is of use to a query block if its longest vector could still reach the k-th score of one of the queries
    needs = aware.groupBy("qb").agg(F.min(F.when(F.col("norm2") > 0, F.col("least") / F.sqrt("norm2")).otherwise(none)).alias("needs"))
    last = sizes.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0]
    met = (
        needs.select("qb", "needs", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(last), F.lit(1)).cast("long"))).alias("block"))
        .join(sizes, "block").filter(F.sqrt("longest") * (1 + 1e-9) >= F.col("needs")).select("qb", "block")
    )
    found = first.select("query_id", "vec_id", "score").unionByName(cells(checkpointed(met), aware))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
