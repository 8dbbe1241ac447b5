"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.strings import is_blank

_RANK = "_rank"


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], ties: list[str] | None = None) -> DataFrame:
    """The first row of every key group under a total order.

    NULL keys are equal to each other. Remaining columns break ties, so the survivor never depends on chance.
    ``row_number() = 1`` lets Spark drop all but one row per key in each input partition before the shuffle, so a
    key that holds a third of the table sends one row per map task, not a third of the table, to its reducer.
    """
    rest = ties if ties is not None else [c for c in df.columns if c not in keys]
    # text keys share long prefixes (indicator and territory codes): sorting by a hash first settles almost every
    # comparison on eight bytes, and the keys themselves keep the grouping exact
    lead = [F.xxhash64(*keys)] if dict(df.dtypes)[keys[0]] == "string" else []
    w = Window.partitionBy(*lead, *keys).orderBy(*order, *[F.col(c).asc_nulls_first() for c in rest])
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def keep_first(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """First row per key in file order."""
    return first_per_key(df, keys, [F.col(ordinal).asc()])


def keep_last(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Last row per key in file order."""
    return first_per_key(df, keys, [F.col(ordinal).desc()])


def resolve_priority(df: DataFrame, keys: list[str], priority: str, newest: str | None = None,
                     name: str | None = None, value: str | None = None) -> DataFrame:
    """Lowest priority number wins; then dataset name, newest extraction, smallest value, the remaining columns."""
    order = [F.col(priority).asc_nulls_last()]
    if name and name not in keys:
        order.append(F.col(name).asc_nulls_first())
    if newest:
        order.append(F.col(newest).desc_nulls_last())
    if value:
        order.append(F.col(value).asc_nulls_first())
    return first_per_key(df, keys, order)


def resolve_priority_located(df: DataFrame, territory: str, keys: list[str], priority: str,
                             newest: str | None = None, name: str | None = None, value: str | None = None,
                             row_id: str | None = None) -> DataFrame:
    """As :func:`resolve_priority`, but rows without a territory are all kept.

    They only share the absence of a code, so they are not duplicates. With ``row_id`` (a column that identifies a
    row of the source files, dropped here) each of them is a key of its own, spread over all reducers, and the
    input is read once. Without it they are split off and take no part in the shuffle, at the price of a second pass.
    """
    blank = is_blank(F.col(territory))
    if row_id is not None:
        alone = df.withColumn("_alone", F.when(blank, F.col(row_id))).drop(row_id)   # NULL on all other rows
        return resolve_priority(alone, [*keys, "_alone"], priority, newest, name, value).drop("_alone")
    kept = resolve_priority(df.filter(~blank), keys, priority, newest, name, value)
    return kept.unionByName(df.filter(blank))


def collisions(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """What a dedup on ``keys`` would remove: per ``by`` group, key groups with several rows and rows lost."""
    per_key = df.groupBy(*dict.fromkeys(keys + by)).agg(F.count("*").alias("n"))
    groups = per_key.groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.min(c).alias(c) for c in by if c not in keys])
    return (
        groups.filter("n > 1").groupBy(*by)
        .agg(F.count("*").alias("n_groups"), F.sum(F.col("n") - 1).alias("n_lost"))
    )
