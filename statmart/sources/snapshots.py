"""Monthly snapshots: files (or Spark output folders) named ``<name>_<YYYY-MM>.parquet``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.align import column_or_null
from ..registry import inline
from ..session import checkpointed, file_system

NAME = r"([^/]+)_(\d{4}-\d{2})\.parquet"
META_COLUMNS = ["dataset_code", "extracted_at", "period_label", "time"]


def snapshot_path(root: str, name: str, month: str) -> str:
    return f"{root}/{name}_{month}.parquet"


def list_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """(name, month, path) of every snapshot in ``root``; empty if there is no such folder.

    One listing of the folder itself: a snapshot is an entry there, whether file or folder, and its part files are not
    looked at. There is an entry per dataset and month, whatever the tables hold.
    """
    fs, path = file_system(spark, root)
    found = []
    if fs.exists(path):
        for entry in fs.listStatus(path):
            name = re.fullmatch(NAME, entry.getPath().getName())
            if name:
                found.append((name[1], name[2], entry.getPath().toString()))
    return inline(spark, sorted(found), "name string, month string, path string")


def newest(df: DataFrame, by: list[str], month: str, before: str | None = None) -> DataFrame:
    """The latest month per group, optionally strictly before a given one."""
    pool = df.filter(F.col(month) < before) if before is not None else df
    return pool.groupBy(*by).agg(F.max(month).alias(month))


def newest_rows(df: DataFrame, by: list[str], month: str, before: str | None = None) -> DataFrame:
    """All rows of each group's latest snapshot.

    A dataset may hold a third of all rows, so rows should not be shuffled by dataset: the (group, month) table is
    written once, and from its size in bytes Catalyst sees that it can go to the rows.
    """
    pool = df.filter(F.col(month) < before) if before is not None else df
    top = newest(pool, by, month).select(*[F.col(c).alias(f"_{c}") for c in by], F.col(month).alias("_month"))
    top = checkpointed(top)
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col(month) == F.col("_month")]
    return pool.join(top, on, "left_semi")


def latest_paths(spark: SparkSession, root: str, names: list[str] | None = None,
                 before: str | None = None) -> dict[str, str]:
    """Name -> path of the newest snapshot. Names match exactly, so 'x_1' never picks up 'x_11'.

    The result is one entry per dataset of a registry, needed on the driver to open the files.
    """
    snaps = list_snapshots(spark, root)
    if names is not None:
        snaps = snaps.filter(F.col("name").isin(names))
    if before is not None:
        snaps = snaps.filter(F.col("month") < before)
    rows = snaps.groupBy("name").agg(F.max_by("path", "month").alias("path")).collect()
    return {r["name"]: r["path"] for r in rows}


def metadata_columns(df: DataFrame, columns: list[str] = META_COLUMNS) -> DataFrame:
    """Only the listed columns, NULL where the file has none: the scan reads nothing else."""
    return df.select(*[column_or_null(df, c).alias(c) if c not in df.columns else F.col(c) for c in columns])


def open_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table at ``path``, or an empty one with the declared schema when it does not exist yet."""
    try:
        return spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], schema)
        raise
