"""From landed response files to raw snapshots: one batch per domain and month.

Responses lie in a folder per dataset, ``<landed>/<domain>/<dataset code>/``: delimited files of a provider with its own
code list, JSON cubes (as many slices as there are) of one with the common list. How they got there is no concern here.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..registry import Dataset, Domain, inline
from ..schemas import RAW_METADATA
from ..session import checkpointed, file_system, scratch
from ..sources.cubes import axes_found, cube_problems, decode_cubes, read_cube_files
from ..sources.delimited import dataset_rows, read_checked
from ..sources.landing import publish, with_provenance
from ..sources.layers import MonthFiles, Months

NAMED = 20      # broken slices of a dataset named in the error
MANIFEST = "dataset_code string, row_count bigint, extracted_at timestamp, source_id string, description string"


def responses(spark: SparkSession, folder: str, dataset: Dataset) -> tuple[DataFrame, DataFrame]:
    """(observations, quarantine) of one dataset's folder. The quarantine has a row for every slice that cannot be decoded
    and every broken line: ``file``, ``line`` (NULL for a whole slice) and ``reason``.

    A dataset without declared axes takes those its cubes have.
    """
    if dataset.provider == "eurostat":
        files = read_cube_files(spark, folder)
        axes = dataset.axes or axes_found(files)
        rows = decode_cubes(files, axes).drop("source").filter(F.col("value").isNotNull())
        broken = cube_problems(files).select(F.col("source").alias("file"), F.lit(None).cast("string").alias("line"), F.col("problem").alias("reason"))
        return dataset_rows(rows, dataset), broken
    found = read_checked(spark, folder, dataset.domain)
    return dataset_rows(found.observations, dataset), found.quarantine


def ingest(spark: SparkSession, landed: str, raw: str, domain: Domain, month: str, extracted_at: datetime,
           layer: Months | None = None) -> dict[str, int]:
    """Write the raw snapshot of every registered dataset of a domain, and the month's manifest beside them.

    Datasets stand alone: one that is absent, empty or unreadable stops no other. They, and slices that could not be
    decoded, are named in one error after everything else has been written. Returns rows per dataset.
    """
    written: dict[str, dict] = {}
    problems: list[str] = []
    root = f"{raw}/{domain.name}"
    layer = layer or MonthFiles(spark, root)
    for dataset in domain.datasets:
        folder = f"{landed}/{domain.name}/{dataset.code}"
        fs, where = file_system(spark, folder)
        if not fs.exists(where):
            problems.append(f"{dataset.code}: nothing landed")
            continue
        try:
            with scratch(spark):
                rows, broken = responses(spark, folder, dataset)
                if "value" not in rows.columns:
                    raise ValueError("no column 'value'")
                stamped = checkpointed(with_provenance(rows, dataset.provider, dataset.code, extracted_at))
                written[dataset.code] = layer.write(stamped, dataset.code, month, RAW_METADATA)
                n_lines = publish(broken.filter("line is not null"), f"{raw}/quarantine/{domain.name}/{dataset.code}_{month}/lines")
                n_slices = publish(broken.filter("line is null"), f"{raw}/quarantine/{domain.name}/{dataset.code}_{month}/slices")
                if n_lines:
                    problems.append(f"{dataset.code}: {n_lines} broken lines in quarantine")
                if n_slices:
                    # the first few by name; all of them are in the quarantine
                    first = spark.read.parquet(f"{raw}/quarantine/{domain.name}/{dataset.code}_{month}/slices").orderBy("file").limit(NAMED)
                    problems += [f"{dataset.code}: {r['file']}: {r['reason']}" for r in first.collect()]
                    problems += [f"{dataset.code}: {n_slices - NAMED} more broken slices in quarantine"] * (n_slices > NAMED)
            if not written[dataset.code]["n_rows"]:
                problems.append(f"{dataset.code}: no observations")
        except Exception as e:  # noqa: BLE001  named below, after the others
            problems.append(f"{dataset.code}: {type(e).__name__}: {e}")
    write_manifest(spark, f"{root}/manifest_{month}.json" if isinstance(layer, MonthFiles) else f"{raw}/manifests/{domain.name}_{month}.json",
                   domain, written)
    if problems:
        raise RuntimeError("; ".join(problems))
    return {code: w["n_rows"] for code, w in written.items()}


def write_manifest(spark: SparkSession, path: str, domain: Domain, written: dict[str, dict]) -> None:
    """Row count and extraction time of every dataset written this month, as the jobs that wrote them have seen them."""
    lines = [(d.code, w["n_rows"], w["extracted_at"], d.provider, d.description)
             for d in domain.datasets if (w := written.get(d.code)) and w["n_rows"]]
    inline(spark, lines, MANIFEST).coalesce(1).write.mode("overwrite").json(path)
