"""Row classification, quarantine and samples of offending codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.strings import blank_to_null
from ..session import checkpointed


def classify(df: DataFrame, reason: Column, name: str = "drop_reason", keep: str = "keep") -> tuple[DataFrame, DataFrame]:
    """(kept rows, quarantined rows with their reason)."""
    tagged = df.withColumn(name, reason)
    return tagged.filter(F.col(name) == keep).drop(name), tagged.filter(F.col(name) != keep)


def counts_by(df: DataFrame, columns: list[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def breakdown(df: DataFrame) -> DataFrame:
    """Rows per source, indicator and unit."""
    return counts_by(df, ["source_id", "indicator_code", "unit"])


def suspicious(quarantined: DataFrame, provider: str, source: str = "source_id",
               name: str = "drop_reason") -> DataFrame:
    """Rows of a home-only provider thrown out as foreign: their codes are probably unmapped."""
    return quarantined.filter((F.col(name) == "foreign_subnational") & (F.lower(source) == provider))


def sample_codes(df: DataFrame, group: list[str], code: str, limit: int) -> DataFrame:
    """The first ``limit`` distinct codes of every group in order, how many there are, and rows behind them.

    Codes are counted first and ranked with a limit, so a group with millions of codes never meets in one task. The
    counts are written once, since both the totals and the ranking read them.
    """
    per_code = checkpointed(df.groupBy(*group, code).agg(F.count("*").alias("_rows")))
    totals = per_code.groupBy(*group).agg(F.count(code).alias("n_codes"), F.sum("_rows").alias("n_rows"))
    w = Window.partitionBy(*group).orderBy(code)
    first = (
        per_code.filter(F.col(code).isNotNull()).withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") <= limit)
        .groupBy(*[F.col(g).alias(f"_g_{g}") for g in group])
        .agg(F.sort_array(F.collect_list(code)).alias("sample"))
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    return totals.join(first, same, "left").drop(*[f"_g_{g}" for g in group])


def required_present(df: DataFrame, columns: list[str]) -> None:
    """Contract on a frame about to be written."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"required columns missing: {absent}")


def filled(c: Column) -> Column:
    return blank_to_null(c.cast("string")).isNotNull()
