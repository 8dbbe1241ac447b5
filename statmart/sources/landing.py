"""Writing layers: raw and processed snapshots, manifests, logs, and whole-table replacement."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.scope import counts_by, required_present
from ..schemas import LOAD_LOG, RAW_METADATA
from ..session import file_system
from .snapshots import open_or_empty, snapshot_path


def with_provenance(df: DataFrame, source: str, dataset: str, extracted_at: datetime | Column) -> DataFrame:
    """Tag rows with where and when they came from. The time is passed in, so reruns write the same rows."""
    at = extracted_at if isinstance(extracted_at, Column) else F.lit(extracted_at)
    return df.withColumns({"source_id": F.lit(source), "dataset_code": F.lit(dataset),
                           "extracted_at": at.cast("timestamp")})


def land_snapshot(df: DataFrame, root: str, name: str, month: str, required: list[str] = RAW_METADATA) -> int:
    """Write one month of one dataset and return its row count. The same month is replaced, older months stay;
    nothing is written for an empty result."""
    required_present(df, required)
    return publish(df, snapshot_path(root, name, month), skip_empty=True)


def manifest(landed: DataFrame, **attributes: str) -> DataFrame:
    """Row count and latest extraction time per dataset, plus free attributes."""
    return (
        landed.groupBy("dataset_code")
        .agg(F.count("*").alias("row_count"), F.max("extracted_at").alias("extracted_at"))
        .withColumns({k: F.lit(v) for k, v in attributes.items()})
    )


def missing_datasets(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Registry entries with no landed rows: named after everything else has been written."""
    return expected.join(counts_by(landed, ["dataset_code"]), "dataset_code", "left_anti")


def counted(df: DataFrame, write: Callable[[DataFrameWriter], None]) -> dict[str, Any]:
    """Write ``df`` and return ``n_rows``, and ``extracted_at`` (the newest, if there is such a column), observed by the very
    job that writes.

    The observation is the last step before the files, in the tasks that write them: a task that has to run again is
    counted once.
    """
    seen = Observation()
    newest = [F.max("extracted_at").alias("extracted_at")] if "extracted_at" in df.columns else []
    write(df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *newest).write)
    return {"n_rows": 0, "extracted_at": None} | seen.get


def publish(df: DataFrame, path: str, skip_empty: bool = False) -> int:
    """:func:`publish_counted`, returning just the row count."""
    return publish_counted(df, path, skip_empty)["n_rows"]


def publish_counted(df: DataFrame, path: str, skip_empty: bool = False, by: list[str] | None = None) -> dict[str, Any]:
    """Replace the table at ``path`` (partitioned ``by`` columns) as a whole and return what :func:`counted` has seen.

    The new contents are written in full next to it and moved into place only then: a failed job leaves the old
    table, and a table can be rebuilt from itself. With ``skip_empty`` an empty result leaves the old table too.
    """
    spark = df.sparkSession
    staging, retired = f"{path}.__new", f"{path}.__old"
    fs, target = file_system(spark, path)
    (_, new), (_, old) = file_system(spark, staging), file_system(spark, retired)
    if fs.exists(old) and not fs.exists(target):      # an earlier run was cut off between its two renames
        if not fs.rename(old, target):
            raise OSError(f"could not restore {path} from {retired}")
    seen = counted(df, lambda w: (w.partitionBy(*by) if by else w).mode("overwrite").parquet(staging))
    if skip_empty and seen["n_rows"] == 0:
        fs.delete(new, True)
        return seen
    fs.delete(old, True)
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise OSError(f"could not set {path} aside; the new contents are in {staging}")
    if not fs.rename(new, target):
        if replaced and not fs.rename(old, target):
            raise OSError(f"could not publish {path}; the old table is in {retired}, the new one in {staging}")
        raise OSError(f"could not publish {path}; the old table is in place")
    fs.delete(old, True)
    return seen


def create_if_absent(spark: SparkSession, path: str, schema: StructType) -> None:
    """An empty table with the declared columns where there is none; other columns there are an error."""
    found = open_or_empty(spark, path, schema)
    if found.columns != schema.names:
        raise ValueError(f"{path} does not have its declared columns")
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        found.write.mode("ignore").parquet(path)


def append_load_log(spark: SparkSession, path: str, domain: str, file: str, n_rows: int, at: datetime) -> None:
    """One row per load; rows are only ever added."""
    spark.createDataFrame([(domain, file, n_rows, at)], LOAD_LOG).coalesce(1).write.mode("append").parquet(path)


def write_run_log(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Stage, domain, status, rows, error and times of one run; replaced by the next run."""
    schema = """stage string, domain string, status string, n_rows bigint, error string,
                started_at timestamp, finished_at timestamp"""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").json(path)


def write_lines(lines: DataFrame, path: str, order: list[str], text: str = "line") -> None:
    """A short text document from ordered lines (a report has a line per dataset, not per row)."""
    lines.orderBy(*order).select(text).coalesce(1).write.mode("overwrite").text(path)
