"""Delimited observation files (SDMX-CSV)."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numbers import to_number
from ..functions.periods import leading_year
from ..registry import BOOKKEEPING, RENAME, Dataset
from ..session import checkpointed, file_system


def standard_names(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Trimmed lower-case headers, then renames. Two headers mapped to one name are coalesced in order."""
    lower = df.toDF(*[c.strip().lower() for c in df.columns])
    sources: dict[str, list[str]] = {}
    for c in lower.columns:
        sources.setdefault(renames.get(c, c), []).append(c)
    return lower.select(*[
        (F.coalesce(*[F.col(c) for c in cs]) if len(cs) > 1 else F.col(cs[0])).alias(name)
        for name, cs in sources.items()
    ])


def observations(df: DataFrame, renames: dict[str, str], drop: list[str] = BOOKKEEPING) -> DataFrame:
    """Standard names, numeric ``value``, no missing values, no bookkeeping columns."""
    named = standard_names(df, renames)
    if "value" in named.columns:
        named = named.withColumn("value", to_number(F.col("value"))).filter(F.col("value").isNotNull())
    return named.drop(*drop)


CORRUPT = "_corrupt"


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Header -> files below ``path`` that begin with it. One line of each file is read: a dataset has a file per slice."""
    found: dict[tuple[str, ...], list[str]] = {}
    fs, where = file_system(spark, path)
    entries = fs.listStatus(where) if fs.getFileStatus(where).isDirectory() else [fs.getFileStatus(where)]
    java = spark._jvm.java.io
    for entry in entries:
        file = entry.getPath()
        if entry.isDirectory() or file.getName()[0] in "._":
            continue
        reader = java.BufferedReader(java.InputStreamReader(fs.open(file), "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        if line is not None:
            names = next(csv.reader([line.lstrip("\ufeff")]), [])
            found.setdefault(tuple(names), []).append(file.toString())
    return found


def broken_reason(line: Column, fields: int) -> Column:
    """Why a line was not parsed; NULL where it was. Separators inside quotes do not count."""
    found = F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ","))
    return F.when(line.isNotNull(), F.when(found < fields, "too few fields").when(found > fields, "too many fields").otherwise("malformed"))


@dataclass(frozen=True)
class Delimited:
    """What was read: ``observations``; lines in ``quarantine`` (``file``, ``line``, ``reason``); and ``tally``, one row that
    adds up: ``n_read`` = ``n_kept`` + ``n_missing`` (a value that is no number) + ``n_quarantined``."""

    observations: DataFrame
    quarantine: DataFrame
    tally: DataFrame


def read_checked(spark: SparkSession, path: str, domain: str, names: list[str] | None = None) -> Delimited:
    """Files with broken lines: a line with more or fewer fields than its header is kept as it stands, with its file, instead
    of losing the fields it lacks to NULL.

    Files with different headers are read apart and stacked by name, so that the order of columns may differ. ``names``
    stands for the header of files that have none. The parsed lines are written once; every part of the result reads that.
    """
    parts = {tuple(names): [path]} if names else headers(spark, path)
    frames = []
    for header, files in parts.items():
        plain = [f"_f{i}" for i in range(len(header))]            # headers may repeat or be blank
        schema = ", ".join(f"{c} string" for c in [*plain, CORRUPT])
        raw = spark.read.schema(schema).option("header", str(names is None).lower()).option("enforceSchema", "true") \
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(files)
        frames.append(standard_names(raw.select(
            *[F.col(c).alias(n) for c, n in zip(plain, _distinct(header))], F.col("_metadata.file_path").alias("_file"),
            CORRUPT, broken_reason(F.col(CORRUPT), len(header)).alias("_reason")), RENAME[domain]))
    if not frames:
        raise ValueError(f"no file with a header in {path}")
    lines = checkpointed(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames))
    broken = F.col("_reason").isNotNull()
    value = to_number(F.col("value")) if "value" in lines.columns else F.lit(None).cast("double")
    sound = lines.filter(~broken).drop("_file", "_reason", CORRUPT)
    return Delimited(
        observations(sound, RENAME[domain]),
        lines.filter(broken).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("line"), F.col("_reason").alias("reason")),
        lines.agg(F.count("*").alias("n_read"), F.count_if(~broken & value.isNotNull()).alias("n_kept"),
                  F.count_if(~broken & value.isNull()).alias("n_missing"), F.count_if(broken).alias("n_quarantined")))


def _distinct(header: tuple[str, ...]) -> list[str]:
    """Names that can stand side by side in a frame: blank and repeated ones get their place."""
    seen: set[str] = set()
    out = []
    for i, name in enumerate(header):
        plain = name.strip()
        out.append(f"_column{i}" if not plain or plain.lower() in seen else name)
        seen.add(plain.lower())
    return out


def read_delimited(spark: SparkSession, path: str | list[str], domain: str) -> DataFrame:
    """All columns are read as text; several files of one dataset may be given at once."""
    raw = spark.read.option("header", "true").option("inferSchema", "false").option("mode", "PERMISSIVE").csv(path)
    return observations(raw, RENAME[domain])


def dataset_rows(df: DataFrame, dataset: Dataset) -> DataFrame:
    """The dataset's own filters: first year, accepted codes, constant columns."""
    out = df
    if dataset.start is not None and "time" in df.columns:
        # a label that begins with a year of at least the first one is not less than it as text either: the second
        # condition follows from the first, and unlike it reaches the file's statistics
        label = F.col("time").cast("string")
        out = out.filter((leading_year(label) >= dataset.start) & (label >= str(dataset.start)))
    for column, codes in dataset.keep.items():
        if column in out.columns:
            out = out.filter(F.col(column).isin(codes))
    return out.drop(*dataset.drop)
