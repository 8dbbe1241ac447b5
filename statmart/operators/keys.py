"""Surrogate keys: contiguous numbering without a single-task sort, and natural -> surrogate resolution."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.strings import fold
from ..session import checkpointed, file_system, is_plain_scan, written

_COPY = "_copy"
_LOOKUP = "_lookup"


def contiguous_keys(df: DataFrame, order: list[str], key: str, after: Column | None = None,
                    spread_copies: bool = False) -> DataFrame:
    """Number rows ``after + 1, after + 2, ...`` in the given order.

    Range-partitioned and sorted in parallel, then written once to the shared folder so that partitions stay as they
    are (boundaries are sampled, so computing them twice could move rows). Each file's row count gives the next one's
    offset, and a row's place in its file the rest. No task ever sees the whole table.

    ``spread_copies`` lets identical rows fall into different partitions. The extra ordering column is a row's
    position in the scan, so use it on frames read straight from files or a checkpoint.
    """
    tail = [c for c in df.columns if c not in order]
    ordered = df
    by = order + tail
    if spread_copies:
        ordered = df.withColumn(_COPY, F.monotonically_increasing_id())
        by = by + [_COPY]
    ordered = ordered.repartitionByRange(*by).sortWithinPartitions(*by).drop(_COPY)
    fixed = checkpointed(ordered)

    # each sorted partition is one file (several if the session limits rows per file), named in partition order
    file, position = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    sizes = fixed.groupBy(file.alias("_file")).agg(F.count("*").alias("_n"))
    number = F.regexp_extract("_file", r"part-(\d+)", 1).cast("bigint")   # names pad to five digits only
    before = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    start = after if after is not None else F.lit(0)
    # one row per file of `fixed`: bounded by the partition count, not by the data
    return (
        fixed.select("*", file.alias("_file"), position.alias("_pos"))
        .join(F.broadcast(offsets), "_file")
        .withColumn(key, (F.col("_before") + F.col("_pos") + 1 + start).cast("bigint"))
        .drop("_file", "_pos", "_before")
    )


def max_key(df: DataFrame, key: str) -> Column:
    """Largest key in use, 0 for an empty table, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()


@dataclass(frozen=True)
class KeyLookup:
    """How one natural key of a fact row becomes a surrogate key."""

    key: str                     # surrogate key column, same name in the dimension
    dimension: DataFrame
    natural: dict[str, Column]   # dimension column -> expression on the fact row
    required: bool = True
    folded: bool = False         # dimension codes are compared stripped and in upper case

    def table(self) -> DataFrame:
        """One row per complete natural key, the smallest surrogate key where a code is repeated: a lookup never
        multiplies fact rows."""
        names = [f"_{self.key}_{c}" for c in self.natural]
        known = self.dimension.select(
            *[(fold(F.col(c)) if self.folded else F.col(c)).alias(n) for c, n in zip(self.natural, names)], F.col(self.key))
        return known.filter(reduce(and_, [F.col(n).isNotNull() for n in names])).groupBy(*names).agg(
            F.min(self.key).alias(self.key))


def left_join(df: DataFrame, table: DataFrame, on: list[tuple[Column, str]]) -> DataFrame:
    return df.join(table, reduce(and_, [k == F.col(c) for k, c in on]), "left")


def left_join_spread(df: DataFrame, table: DataFrame, on: list[tuple[Column, str]], parts: int = 200) -> DataFrame:
    """Left join where many rows of ``df`` may lack the key.

    Rows without a key match nothing, but an ordinary shuffle would send all of them to one task. A second equality
    spreads them: it is 0 on both sides wherever there is a key, and any of ``parts`` numbers where there is none. If
    Catalyst broadcasts ``table`` it costs nothing.
    """
    keyed = df.withColumns({f"_on{i}": k for i, (k, _) in enumerate(on)})
    absent = reduce(or_, [F.col(f"_on{i}").isNull() for i in range(len(on))])
    keyed = keyed.withColumn("_part", F.when(absent, F.pmod(F.monotonically_increasing_id(), F.lit(parts))).otherwise(F.lit(0).cast("bigint")))
    # always 0, but not a constant that the optimizer would fold out of the join keys
    side = table.withColumn("_side", F.pmod(F.xxhash64(*[F.col(c) for _, c in on]), F.lit(1)))
    condition = reduce(and_, [F.col(f"_on{i}") == F.col(c) for i, (_, c) in enumerate(on)]) & (F.col("_part") == F.col("_side"))
    return keyed.join(side, condition, "left").drop("_side", "_part", *[f"_on{i}" for i in range(len(on))])


def _sized(spark: SparkSession, lookups: list[KeyLookup]) -> dict[str, DataFrame]:
    """Key -> lookup table of known size. Dimensions that lie in files already are used as they are; all the others are
    written in one job, as one table with a part for each."""
    tables = {lk.key: lk.table() for lk in lookups}
    derived = [lk.key for lk in lookups if not is_plain_scan(lk.dimension)]
    if derived:
        path = written(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
            tables[k].withColumn(_LOOKUP, F.lit(k)) for k in derived]), by=[_LOOKUP])
        for k in derived:
            part = f"{path}/{_LOOKUP}={k}"
            fs, where = file_system(spark, part)
            tables[k] = spark.read.schema(tables[k].schema).parquet(part) if fs.exists(where) else tables[k].limit(0)
    return tables


def resolve_keys(df: DataFrame, lookups: list[KeyLookup], reason: str = "unresolved_key") -> DataFrame:
    """Attach every surrogate key by left join; ``reason`` names the first required key that was not found.

    Joins carry no hint: Catalyst knows the size in bytes of every lookup (see :func:`_sized`) and broadcasts it if it is
    small; otherwise rows without an optional key are spread and skewed partitions of the fact side are split.
    """
    out = df
    tables = _sized(df.sparkSession, lookups)
    for lk in lookups:
        table = tables[lk.key]
        on = [(expr, f"_{lk.key}_{c}") for c, expr in lk.natural.items()]
        # a required key is absent only from rows on their way to quarantine; an optional one may be from most rows
        join = left_join if lk.required else left_join_spread
        out = join(out, table, on).drop(*[f"_{lk.key}_{c}" for c in lk.natural])
    missing = F.lit(None).cast("string")
    for lk in reversed([x for x in lookups if x.required]):
        missing = F.when(F.col(lk.key).isNull(), F.lit(lk.key)).otherwise(missing)
    return out.withColumn(reason, missing)


def resolved(df: DataFrame, reason: str = "unresolved_key") -> DataFrame:
    return df.filter(F.col(reason).isNull()).drop(reason)
