"""Comparison of two versions of a table, and runs of consecutive periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def parity(old: DataFrame, new: DataFrame, keys: list[str], value: str, digits: int = 6) -> DataFrame:
    """Key groups whose row count or sum differ between two versions.

    Each side is aggregated on its own before the join, so the join sees one row per group.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias(f"n_{tag}"), F.round(F.sum(value), digits).alias(f"sum_{tag}"))

    a = side(old, "old")
    b = side(new, "new").select(*[F.col(k).alias(f"_b_{k}") for k in keys], "n_new", "sum_new")
    same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    differs = ~F.col("n_old").eqNullSafe(F.col("n_new")) | ~F.col("sum_old").eqNullSafe(F.col("sum_new"))
    return (
        a.join(b, same, "full_outer").filter(differs)
        .select(*[F.coalesce(F.col(k), F.col(f"_b_{k}")).alias(k) for k in keys],
                "n_old", "n_new", "sum_old", "sum_new")
    )


def fingerprints(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per key group an order-free fingerprint of its rows over ``columns``: count, sums of both halves of a row's hash, and
    their exclusive or. Two groups with equal fingerprints hold the same rows, repeats included (but for a chance of one in
    2 to the 64th); each row is hashed where it lies and groups are combined before the shuffle.

    Whether a value is NULL is hashed beside it, as the hash function passes NULLs over.
    """
    h = F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
    return df.select(*keys, h.alias("_h"), low.alias("_low"), high.alias("_high")).groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.sum("_low").alias("low"), F.sum("_high").alias("high"), F.bit_xor("_h").alias("mixed"))


def parity_of_rows(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Key groups whose rows differ between two versions in any of ``columns``, whatever their order: values that changed
    places between rows are found, which counts and sums (:func:`parity`) cannot see. ``n_old`` and ``n_new`` are NULL for a
    group that one side lacks."""
    marks = ["low", "high", "mixed"]
    a = fingerprints(old, keys, columns).withColumnRenamed("n_rows", "n_old")
    b = fingerprints(new, keys, columns).select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col("n_rows").alias("n_new"),
                                                 *[F.col(m).alias(f"_b_{m}") for m in marks])
    same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    equal = F.col("n_old").eqNullSafe(F.col("n_new"))
    for m in marks:
        equal = equal & F.col(m).eqNullSafe(F.col(f"_b_{m}"))
    return a.join(b, same, "full_outer").filter(~equal).select(
        *[F.coalesce(F.col(k), F.col(f"_b_{k}")).alias(k) for k in keys], "n_old", "n_new")


def expected_vs_present(expected: DataFrame, present: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """Every code of either side: missing, extra or present; for missing ones, whether ``known`` lists them."""
    e = expected.select(key).distinct().withColumn("_e", F.lit(True))
    p = present.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_p", F.lit(True))
    out = e.join(p, key, "full_outer").select(
        key,
        F.when(F.col("_p").isNull(), "missing").when(F.col("_e").isNull(), "extra").otherwise("present").alias("status"))
    if known is None:
        return out
    k = known.select(key).distinct().withColumn("in_dimension", F.lit(True))
    return out.join(k, key, "left").withColumn("in_dimension", F.coalesce("in_dimension", F.lit(False)))


def runs(df: DataFrame, group: list[str], ordinal: str) -> DataFrame:
    """Maximal runs of consecutive integers per group: first, last, length.

    Repeats are removed first (with map-side combine), so a group never holds more rows than there are distinct
    periods, however many rows share the group.
    """
    points = df.select(*group, ordinal).filter(F.col(ordinal).isNotNull()).distinct()
    w = Window.partitionBy(*group).orderBy(ordinal)
    return (
        points.withColumn("_island", F.col(ordinal) - F.row_number().over(w))
        .groupBy(*group, "_island")
        .agg(F.min(ordinal).alias("first"), F.max(ordinal).alias("last"), F.count("*").alias("length"))
        .drop("_island")
    )


def orphans(fact: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None) -> DataFrame:
    """Fact keys absent from the dimension, with row counts. NULL keys are not orphans.

    Fact rows are counted per key before the anti join: the join sees distinct keys only.
    """
    return unknown_keys(fact.groupBy(key).agg(F.count("*").alias("n_rows")), dimension, key, dimension_key)


def unknown_keys(used: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None) -> DataFrame:
    """:func:`orphans` of a fact that is counted per key already (``key``, ``n_rows``)."""
    known = dimension.select(F.col(dimension_key or key).alias(key))
    return used.filter(F.col(key).isNotNull()).join(known, key, "left_anti")
