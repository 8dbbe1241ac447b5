"""Mapping tables kept as CSV: every column text, trimmed, with the line order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.align import trimmed

# Expected files in a mappings folder.
CROSSWALK = "nuts_istat.csv"
LEGAL_FORMS = "legal_form_map.csv"
ACTIVITIES = "nace_labels.csv"
SOURCES = "domain_sources.csv"
DATASET_LABELS = "dataset_labels.csv"
CODE_LISTS = "breakdown_codes.csv"


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """No type inference: '001' stays '001'. ``ord`` is the line order, which first/last-wins rules need."""
    raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    if "ord" in raw.columns:
        return trimmed(raw).withColumn("ord", F.col("ord").cast("bigint"))
    return trimmed(raw).withColumn("ord", F.monotonically_increasing_id())
