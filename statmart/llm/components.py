"""Connected components of a graph of integer nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed
from .shared import join_on_hot_key


def components(links: DataFrame) -> DataFrame:
    """(``a``, ``b``) -> (``node``, ``root``): each linked node with the smallest node it can reach.

    Each round takes the smallest label among a node's neighbours, then the label of that label, so that distances
    halve; it ends when nothing changes. Neighbour lists are never collected, only their minimum. Loops and repeated
    links do no harm, links with a null are left out, and an empty table gives an empty one.
    """
    known = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = checkpointed(known.select("a", "b").union(known.select(F.col("b"), F.col("a"))).distinct())
    state = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        heard = (
            both.join(state.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        )
        stepped = checkpointed(
            state.select("node", F.col("label").alias("before")).join(heard, "node", "left")
            .select("node", "before", F.least("before", "heard").alias("label")))
        if stepped.filter("label <> before").isEmpty():
            return state.select("node", F.col("label").alias("root"))
        further = stepped.select(F.col("node").alias("label"), F.col("label").alias("further"))
        state = checkpointed(
            join_on_hot_key(stepped.select("node", "label"), further, "label")
            .select("node", F.least("label", "further").alias("label")))
