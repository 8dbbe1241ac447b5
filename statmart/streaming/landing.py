"""Incremental landing: new response files are picked up once each, then the query stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..registry import RENAME
from ..sources.cubes import cube_problems, decode_cubes
from ..sources.delimited import CORRUPT, broken_reason, observations


def land_new_cubes(spark: SparkSession, inbox: str, out: str, progress: str, axes: list[str], source: str,
                   dataset: str) -> StreamingQuery:
    """Decode cube slices that arrived since the last run and append them to ``out``.

    ``progress`` records which files are done, so a restarted run neither repeats nor loses a slice.
    """
    rows = decode_cubes(_new_slices(spark, inbox), axes).withColumns({"source_id": F.lit(source), "dataset_code": F.lit(dataset)})
    return (
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )


def _new_slices(spark: SparkSession, inbox: str) -> DataFrame:
    return (
        spark.readStream.format("text").option("wholetext", "true").load(inbox)
        .select(F.col("_metadata.file_path").alias("slice"), F.col("_metadata.file_modification_time")
                .alias("extracted_at"), F.col("value").alias("body"))
    )


def in_batches(rows: DataFrame, out: dict[str, str], split: Callable[[DataFrame], dict[str, DataFrame]], progress: str) -> StreamingQuery:
    """Write what ``split`` makes of each batch below the folders of ``out``, as ``<folder>/batch=<number>``.

    A batch that was cut off runs again with its number and replaces what it had written, in all of its folders; so no
    row is lost or doubled, though several tables are written. The batch is kept while its parts are written.
    """
    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            for name, part in split(kept).items():
                part.write.mode("overwrite").parquet(f"{out[name]}/batch={number}")
        finally:
            kept.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start()


def land_checked_cubes(spark: SparkSession, inbox: str, out: str, quarantine: str, progress: str, axes: list[str], source: str,
                       dataset: str) -> StreamingQuery:
    """:func:`land_new_cubes`, with slices that cannot be decoded as rows of ``quarantine`` (``file``, ``reason``)."""
    def split(batch: DataFrame) -> dict[str, DataFrame]:
        return {"rows": decode_cubes(batch, axes).withColumns({"source_id": F.lit(source), "dataset_code": F.lit(dataset)}),
                "quarantine": cube_problems(batch).select(F.col("slice").alias("file"), F.col("problem").alias("reason"))}

    return in_batches(_new_slices(spark, inbox), {"rows": out, "quarantine": quarantine}, split, progress)


def land_new_delimited(spark: SparkSession, inbox: str, out: str, quarantine: str, progress: str, header: list[str], domain: str,
                       source: str, dataset: str) -> StreamingQuery:
    """Delimited files that arrived since the last run: observations, and broken lines as rows of ``quarantine``.

    The header is declared, as a stream's columns are fixed before its first file; each file's own header line is passed
    over.
    """
    plain = [f"_f{i}" for i in range(len(header))]
    raw = (
        spark.readStream.format("csv").schema(", ".join(f"{c} string" for c in [*plain, CORRUPT])).option("header", "true")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).load(inbox)
        .select(*plain, CORRUPT, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("extracted_at"))
    )

    def split(batch: DataFrame) -> dict[str, DataFrame]:
        sound = batch.filter(F.col(CORRUPT).isNull()).select(*[F.col(c).alias(n) for c, n in zip(plain, header)], "extracted_at")
        broken = batch.filter(F.col(CORRUPT).isNotNull()).select(
            "file", F.col(CORRUPT).alias("line"), broken_reason(F.col(CORRUPT), len(header)).alias("reason"))
        return {"rows": observations(sound, RENAME[domain]).withColumns({"source_id": F.lit(source), "dataset_code": F.lit(dataset)}),
                "quarantine": broken}

    return in_batches(raw, {"rows": out, "quarantine": quarantine}, split, progress)


def land_once(rows: DataFrame, out: str, progress: str, keys: list[str], event_time: str, lateness: str) -> StreamingQuery:
    """Append a stream's rows, each key once, however often and in whichever batch it is delivered again.

    Keys are remembered for ``lateness`` behind the newest event time, so the state is bounded by what arrives in that
    time, not by what has ever arrived; a row older than that counts as late and is dropped.
    """
    unique = rows.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)
    return in_batches(unique, {"rows": out}, lambda batch: {"rows": batch}, progress)
