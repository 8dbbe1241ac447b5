"""Snapshots as one partitioned table, and counts taken by the job that writes."""

from __future__ import annotations

import hashlib
from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statmart.schemas import RAW_METADATA, ddl
from statmart.sources.landing import counted, publish
from statmart.sources.layers import MonthFiles, PartitionedMonths

SCHEMA = "source_id string, dataset_code string, extracted_at timestamp, value double"
AT = datetime(2026, 1, 2, 3)


def frame(table, code, *values):
    return table([("s", code, AT, float(v)) for v in values], SCHEMA)


def contents(root):
    """Every data file below a folder, byte for byte."""
    return {str(p.relative_to(root)): hashlib.md5(p.read_bytes()).hexdigest() for p in Path(root).rglob("*.parquet") if p.is_file()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(params=["files", "partitions"])
def layer(request, spark, tmp_path):
    return (MonthFiles if request.param == "files" else PartitionedMonths)(spark, str(tmp_path / "raw"))


def test_both_kinds_work_alike(layer, table):
    assert layer.newest() == {}
    for name, month, values in [("x_1", "2026-01", [1]), ("x_1", "2026-03", [2, 3]), ("x_11", "2026-09", [4]), ("7", "2025-12", [5])]:
        seen = layer.write(frame(table, name, *values), name, month, RAW_METADATA)
        assert (seen["n_rows"], seen["extracted_at"]) == (len(values), AT)
    assert layer.newest() == {"x_1": "2026-03", "x_11": "2026-09", "7": "2025-12"}
    assert layer.newest(["x_1", "absent"], before="2026-03") == {"x_1": "2026-01"}
    assert layer.latest_two("x_1", "2026-02") == ["2026-01"] and layer.latest_two("x_1", "2026-12") == ["2026-03", "2026-01"]
    assert rows(layer.open("x_1", "2026-03"), "dataset_code", "value") == [("x_1", 2.0), ("x_1", 3.0)]
    assert layer.write(frame(table, "x_1"), "x_1", "2026-03", RAW_METADATA)["n_rows"] == 0      # replaces nothing
    layer.write(frame(table, "x_1", 9), "x_1", "2026-03", RAW_METADATA)
    assert rows(layer.open("x_1", "2026-03"), "value") == [(9.0,)]
    with pytest.raises(ValueError, match="extracted_at"):
        layer.write(table([("s", "d")], "source_id string, dataset_code string"), "d", "2026-03", RAW_METADATA)


def test_one_month_leaves_the_others_byte_for_byte(spark, table, tmp_path):
    root = str(tmp_path / "raw")
    layer = PartitionedMonths(spark, root)
    for name in ("a", "b"):
        for month in ("2026-01", "2026-02"):
            layer.write(frame(table, name, 1, 2), name, month, RAW_METADATA)
    before = contents(root)
    layer.write(frame(table, "a", 3), "a", "2026-02", RAW_METADATA)
    after = contents(root)
    kept = {f: h for f, h in before.items() if not f.startswith("dataset_code=a/month=2026-02/")}
    assert len(kept) < len(before) and all(after[f] == h for f, h in kept.items())
    assert not set(after) & (set(before) - set(kept))
    assert rows(layer.profile()) == [("a", "2026-01", 2), ("a", "2026-02", 1), ("b", "2026-01", 2), ("b", "2026-02", 2)]


def test_a_read_opens_one_partition_and_the_profile_no_column(spark, table, tmp_path):
    layer = PartitionedMonths(spark, str(tmp_path / "raw"))
    for month in ("2026-01", "2026-02", "2026-03"):
        layer.write(frame(table, "a", 1, 2), "a", month, RAW_METADATA)
        layer.write(frame(table, "b/c", 1, 2), "b/c", month, RAW_METADATA)
    one = layer.open("b/c", "2026-02").select("value")
    files = {f.split("/raw/")[1].rsplit("/", 1)[0] for f in one.select(F.col("value"), F.input_file_name().alias("f")).toPandas()["f"]}
    assert len(files) == 1 and "PartitionFilters: [isnotnull(month" in plan(one)
    assert "ReadSchema: struct<>" in plan(layer.profile())
    newest = layer.read_newest(ddl("value double"))
    assert rows(newest.groupBy("dataset_code", "month").count()) == [("a", "2026-03", 2), ("b/c", "2026-03", 2)]
    assert "ReadSchema: struct<value:double>" in plan(newest) and "2026-01" not in plan(newest)


def test_months_keep_their_own_columns(spark, table, tmp_path):
    layer = PartitionedMonths(spark, str(tmp_path / "raw"))
    layer.write(frame(table, "a", 1), "a", "2026-01", RAW_METADATA)
    layer.write(frame(table, "a", 2).withColumn("sex", F.lit("T")), "a", "2026-02", RAW_METADATA)
    assert "sex" in layer.open("a", "2026-02").columns and "sex" not in layer.open("a", "2026-01").columns
    named = PartitionedMonths(spark, str(tmp_path / "processed"), "labour")
    named.write(frame(table, "a", 1, 2), "labour", "2026-01", [])
    assert named.newest() == {"labour": "2026-01"} and named.open("labour", "2026-01").columns == ddl(SCHEMA).names
    with pytest.raises(ValueError):
        named.open("other", "2026-01")


def test_counts_come_from_the_writing_job(spark, tmp_path):
    """The frame is evaluated once: a second evaluation would count twice into the accumulator."""
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b
    df = spark.range(100).mapInArrow(seen, "id bigint")
    assert publish(df, str(tmp_path / "t")) == 100 and calls.value == 100
    assert counted(spark.range(0), lambda w: w.mode("overwrite").parquet(str(tmp_path / "e"))) == {"n_rows": 0, "extracted_at": None}
