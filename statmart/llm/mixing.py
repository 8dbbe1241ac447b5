"""Mixing sources to target weights by hierarchical budgeting, in column expressions only.

Weights go down a tree of domain, language and source: the budget of a node is shared among its children by weight. A
child cannot take more than it has, epochs counted; what it leaves goes to its siblings, and only what a whole family
cannot take is left for the siblings of its parent. Each leaf then takes whole epochs and a prefix of one more, in an
order drawn from the seed, the epoch and the document.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed
from .shared import as_scan, join_on_hot_key, numbered, whole_text, words_of

LEVELS = ("domain", "language", "source")
NONE = "(none)"           # stands for a null level
BUCKETS = 4096            # parts of an epoch's order: three hexadecimal digits


@dataclass(frozen=True)
class Mixture:
    """Integer weights by path; a path that is not named has weight 1. Paths: "web", "web/en", "web/en/src3"."""

    budget: int | None = None                       # tokens; None: as many as there are
    max_epochs: int = 4
    seed: str = "mix"
    weights: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        if self.max_epochs < 1 or any(w < 1 for w in self.weights.values()):
            raise ValueError("weights and max_epochs must be at least 1")

    def weight(self, path: Column) -> Column:
        out = F.lit(1)
        for name, w in sorted(self.weights.items()):
            out = F.when(path == name, w).otherwise(out)
        return out.cast("long")


def _order(seed: str, epoch: Column, doc: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), doc))


def _shared_out(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Rows with ``budget`` (of the parent), ``has`` and ``weight`` -> ``gets``, among the rows of each parent.

    Children that have the least for their weight are served first: child i is short if all that it has is no more than
    its share of what those before it left. All others share the rest by weight, rounded down.
    """
    big = "decimal(38,0)"
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(1))
    poorest = family.orderBy(F.col("has") / F.col("weight"), "node")
    before = poorest.rowsBetween(Window.unboundedPreceding, -1)
    onward = poorest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        nodes.withColumn("left_over", F.col("budget") - F.coalesce(F.sum("has").over(before), F.lit(0)))
        .withColumn("others", F.sum("weight").over(onward))
        .withColumn("short", (F.col("has").cast(big) * F.col("others").cast(big) <= F.col("left_over").cast(big) * F.col("weight").cast(big)))
        # shortness is monotone in this order; rounding must not let it come back after the first child that is not
        .withColumn("short", F.min(F.col("short").cast("int")).over(poorest.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 1)
    )
    rest = F.max(F.when(~F.col("short"), F.struct(F.col("left_over"), F.col("others")))).over(family)
    return (
        ranked.withColumn("rest", rest)
        .withColumn("gets", F.when(F.col("short"), F.col("has")).otherwise(
            F.expr("least(has, cast(greatest(rest.left_over, 0L) as decimal(19,0)) * cast(weight as decimal(18,0)) div cast(rest.others as decimal(18,0)))")))
        .drop("left_over", "others", "short", "rest")
    )


def budgets(leaves: DataFrame, mixture: Mixture) -> DataFrame:
    """``domain``, ``language``, ``source``, ``tokens`` of the leaves -> also ``budget`` in tokens.

    A leaf offers its tokens ``max_epochs`` times. Everything here is one row per node, whatever the corpus.
    """
    sized = leaves.withColumn("has", F.col("tokens") * mixture.max_epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all")).select(
        (F.lit(mixture.budget) if mixture.budget is not None else F.col("all")).cast("long").alias("budget"))
    above = total
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[:depth + 1])
        nodes = sized.groupBy(*path).agg(F.sum("has").alias("has"))
        nodes = nodes.withColumn("weight", mixture.weight(F.concat_ws("/", *path))).withColumn("node", F.col(level))
        nodes = nodes.join(above, path[:-1]) if depth else nodes.withColumn("budget", total.scalar())
        above = _shared_out(nodes, path[:-1]).select(*path, F.col("gets").alias("budget"))
    return leaves.join(above, list(LEVELS))


def selection(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """Rows with ``row``, ``doc`` (the id as text), the three levels and ``tokens`` -> one row per row and epoch taken:
    ``row``, ``epoch`` (from 0), the levels, ``tokens`` and the leaf's ``budget``.

    A leaf's prefix never becomes one sorted partition: an epoch's order is cut into 4,096 parts by the first digits of
    the order key. Sums per part say where the budget ends; only the part it ends in is added up row by row. The document
    in which the budget ends is the last of the prefix if that comes nearer to the budget than leaving it out, so a leaf is
    off by half of that document at most. Ties in the order (a repeated id) go by tokens, then row. A leaf
    without any tokens is taken once.
    """
    leaf = F.to_json(F.struct(*LEVELS))
    keyed = docs.withColumn("leaf", leaf)
    leaves = checkpointed(docs.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")))
    plan = checkpointed(
        budgets(leaves, mixture).withColumn("leaf", leaf)
        .withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).cast("int"))
        .withColumn("whole", F.least("whole", F.lit(mixture.max_epochs)))
        .withColumn("prefix", F.col("budget") - F.col("whole") * F.col("tokens"))
        .select("leaf", "budget", "whole", "prefix"))
    planned = (
        join_on_hot_key(keyed, plan, "leaf")
        .withColumn("place", _order(mixture.seed, F.col("whole"), F.col("doc")))
        .withColumn("part", F.conv(F.substring("place", 1, 3), 16, 10).cast("int"))
    )
    planned = checkpointed(planned)
    sums = planned.groupBy("leaf", "part", "prefix").agg(F.sum("tokens").alias("sum"))
    upto = Window.partitionBy("leaf").orderBy("part")
    reach = sums.withColumn("end", F.sum("sum").over(upto))
    cut = checkpointed(reach.groupBy("leaf").agg(
        F.max(F.when(F.col("end") <= F.col("prefix"), F.col("part"))).alias("last"),
        F.max(F.when(F.col("end") <= F.col("prefix"), F.col("end"))).alias("used"),
        F.min(F.when(F.col("end") > F.col("prefix"), F.col("part"))).alias("cut")))
    marked = join_on_hot_key(planned, cut, "leaf")
    running = Window.partitionBy("leaf").orderBy("place", "tokens", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("end") - F.col("tokens")
    at_cut = (
        marked.filter(F.col("part") == F.col("cut"))
        .withColumn("end", F.coalesce("used", F.lit(0)) + F.sum("tokens").over(running))
        .filter((F.col("end") <= F.col("prefix"))
                | ((before < F.col("prefix")) & (F.col("end") - F.col("prefix") < F.col("prefix") - before)))
    )
    fields = ["row", *LEVELS, "tokens", "budget"]
    more = F.col("whole") < mixture.max_epochs
    within = F.coalesce(F.col("part") < F.col("cut"), F.lit(True)) & more
    taken = marked.withColumn("n", F.col("whole") + within.cast("int")).filter("n > 0").select(
        *fields, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("epoch"))
    return taken.unionByName(at_cut.filter(more).select(*fields, F.col("whole").alias("epoch")))


def described(df: DataFrame, domain: Column, id_col: str = "doc_id", text: str = "text", language: str = "lang",
              source: str = "source") -> DataFrame:
    """The columns :func:`selection` needs. ``tokens`` are words. A null level is ``(none)``, a null id an empty text, a
    null text has no tokens."""
    named = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    return numbered(as_scan(df).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"),
        named(domain).alias("domain"), named(F.col(language)).alias("language"), named(F.col(source)).alias("source"),
        F.size(words_of(whole_text(text))).cast("long").alias("tokens")), "row")


def mixed(df: DataFrame, domain: Column, mixture: Mixture, **columns: str) -> DataFrame:
    """The rows of ``df`` the mixture takes, once per epoch, with all their columns."""
    df = as_scan(df)
    taken = selection(checkpointed(described(df, domain, **columns)), mixture).groupBy("row").agg(F.count("*").cast("int").alias("copies"))
    whole = numbered(df.select(F.struct("*").alias("whole")), "row")
    return (
        whole.join(taken, "row").select("whole", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("whole.*")
    )
