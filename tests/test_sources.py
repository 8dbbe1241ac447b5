from __future__ import annotations

import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statmart.catalog.sources import encode_cubes
from statmart.operators import align
from statmart.registry import RENAME
from statmart.schemas import FACTS, LOAD_LOG, ddl
from statmart.sources import cubes, delimited, landing, mappings, snapshots
from statmart.streaming.landing import land_new_cubes

CUBE = {"dimension": {"geo": {"category": {"index": {"IT": 0, "FR": 1}, "label": {"IT": "Italy", "FR": "FR"}}},
                      "Time": {"category": {"index": {"2021": 0, "2022": 1, "2023": 2}}}},
        "value": {"0": 1.5, "4": 2.0, "5": None}}


def bodies(table, *cubes_):
    return table([(i, json.dumps(c) if isinstance(c, dict) else c) for i, c in enumerate(cubes_)], "n bigint, body string")


def test_cube_positions_labels_and_nulls(table):
    out = cubes.decode_cubes(bodies(table, CUBE), ["geo", "time", "sex"])
    assert rows(out, "geo", "geo_label", "time", "sex", "value") == [
        ("FR", None, "2022", None, 2.0), ("FR", None, "2023", None, None), ("IT", "Italy", "2021", None, 1.5)]


def test_cube_unknown_position(table):
    odd = {"dimension": {"geo": {"category": {"index": {"IT": 0, "DE": 2}}}}, "value": {"1": 7.0, "2": 8.0, "9": 9.0}}
    assert rows(cubes.decode_cubes(bodies(table, odd), ["geo"]), "geo", "value") == [
        ("DE", 8.0), ("unknown_1", 7.0), ("unknown_9", 9.0)]


def test_broken_slices_do_not_stop_the_others(table):
    no_value = {"dimension": CUBE["dimension"]}
    empty = {"dimension": CUBE["dimension"], "value": {}}
    files = bodies(table, CUBE, no_value, "not json", empty)
    assert cubes.decode_cubes(files, ["geo", "time"]).count() == 3
    assert rows(cubes.cube_problems(files)) == [(1, "missing key: value"), (2, "missing key: dimension")]
    with pytest.raises(Exception, match="missing key"):
        cubes.decode_cubes(files, ["geo"], strict=True).collect()


def test_encode_then_decode(table):
    cells = table([("x", "a", "p", 1.0), ("x", "b", "q", 2.0), ("y", "a", "q", 3.0)], "id string, u string, v string, value double")
    back = cubes.decode_cubes(encode_cubes(cells, ["id"], ["u", "v"], "value"), ["u", "v"])
    assert rows(back, "id", "u", "v", "value") == rows(cells)


def test_delimited_file(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "FREQ, REF_AREA ,SEX,TIME_PERIOD,OBS_VALUE,OBS_STATUS\nA,001,1,2020,1.5,p\nA,002,2,2020,:,p\nM,003,9,2020-01,2,\n")
    out = delimited.read_delimited(spark, str(tmp_path / "f.csv"), "labour")
    assert out.columns == ["frequency", "geo", "gender", "time", "value"]
    assert rows(out, "geo", "time", "value") == [("001", "2020", 1.5), ("003", "2020-01", 2.0)]


def test_two_headers_for_one_column_are_coalesced(table):
    df = table([("a", None, "1"), (None, "b", "2")], "TIPO_ATTIVITA string, Type_Activity_Performed string, OBS_VALUE string")
    assert rows(delimited.observations(df, RENAME["social_economy"])) == [("a", 1.0), ("b", 2.0)]


def test_mapping_is_text_in_line_order(spark, tmp_path):
    (tmp_path / "m.csv").write_text('code,name\n001, "Torino, città" \n02,x\n,y\n')
    out = mappings.read_mapping(spark, str(tmp_path / "m.csv"))
    assert [tuple(r) for r in out.orderBy("ord").select("code", "name").collect()][1:] == [("02", "x"), (None, "y")]
    assert out.orderBy("ord").first()["code"] == "001"


def test_snapshots_by_exact_name(spark, table, tmp_path):
    root = str(tmp_path / "raw")
    df = table([("s", "d", None, 1.0)], "source_id string, dataset_code string, extracted_at timestamp, value double")
    for name, month in [("x_1", "2026-01"), ("x_1", "2026-03"), ("x_11", "2026-09"), ("y", "2025-12")]:
        landing.land_snapshot(df, root, name, month)
    df.toPandas().to_parquet(f"{root}/z_2026-02.parquet")     # a single file counts like a folder
    paths = snapshots.latest_paths(spark, root, ["x_1", "y", "z", "absent"])
    assert {k: v.rsplit("/", 1)[1] for k, v in paths.items()} == {
        "x_1": "x_1_2026-03.parquet", "y": "y_2025-12.parquet", "z": "z_2026-02.parquet"}
    assert snapshots.latest_paths(spark, root, ["x_1"], before="2026-03")["x_1"].endswith("2026-01.parquet")
    assert snapshots.latest_paths(spark, str(tmp_path / "nowhere")) == {}
    assert rows(snapshots.newest(snapshots.list_snapshots(spark, root), ["name"], "month"))[1] == ("x_11", "2026-09")


def test_same_month_is_replaced_older_months_stay(spark, table, tmp_path):
    root = str(tmp_path / "raw")
    schema = "source_id string, dataset_code string, extracted_at timestamp, value double"
    landing.land_snapshot(table([("s", "d", None, 1.0)], schema), root, "d", "2026-01")
    landing.land_snapshot(table([("s", "d", None, 2.0)], schema), root, "d", "2026-02")
    assert landing.land_snapshot(table([("s", "d", None, 3.0)], schema), root, "d", "2026-02") == 1
    assert landing.land_snapshot(table([], schema), root, "d", "2026-02") == 0      # an empty result replaces nothing
    path = snapshots.snapshot_path(root, "d", "2026-02")
    assert spark.read.parquet(path).first()["value"] == 3.0
    assert spark.read.parquet(snapshots.snapshot_path(root, "d", "2026-01")).first()["value"] == 1.0
    with pytest.raises(ValueError, match="extracted_at"):
        landing.land_snapshot(table([("s", "d")], "source_id string, dataset_code string"), root, "d", "2026-03")


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    landing.publish(spark.range(3).toDF("n"), path)
    landing.publish(spark.read.parquet(path).withColumn("n", F.col("n") + 1), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,), (3,)]
    bad = spark.read.parquet(path).withColumn("n", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception):
        landing.publish(bad, path)
    assert spark.read.parquet(path).count() == 3      # the old table is still there


def test_load_log_only_grows(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in (1, 2):
        landing.append_load_log(spark, path, "labour", f"f{n}", n, datetime(2026, 1, n))
    assert rows(spark.read.schema(LOAD_LOG).parquet(path), "file", "n_rows") == [("f1", 1), ("f2", 2)]


def test_provenance_and_manifest(table):
    df = landing.with_provenance(table([(1.0,), (2.0,)], "value double"), "istat", "d1", datetime(2026, 1, 2, 3))
    assert rows(landing.manifest(df, unit="count"), "dataset_code", "row_count", "unit") == [("d1", 2, "count")]
    registry = table([("d1",), ("d2",)], "dataset_code string")
    assert rows(landing.missing_datasets(registry, df)) == [("d2",)]


def test_typed_and_enforced(table):
    df = table([("1", "x", 5), ("z", "y", 6)], "n string, extra string, code bigint")
    schema = ddl("n bigint, code string, absent double")
    assert rows(align.typed(df, schema)) == [(1, "x", None), (None, "y", None)]
    out = align.enforce_schema(align.typed(df, schema), schema)
    assert out.columns == ["n", "code", "absent"] and out.schema["absent"].dataType.simpleString() == "double"
    assert align.unknown_columns(df, schema) == ["extra"]


def test_declared_tables_open_empty(spark, tmp_path):
    for name, schema in FACTS.items():
        df = snapshots.open_or_empty(spark, str(tmp_path / name), schema)
        assert df.columns == schema.names and df.count() == 0


def test_metadata_scan_reads_only_its_columns(spark, table, tmp_path):
    path = str(tmp_path / "p_2026-01.parquet")
    table([("d", "2020", 1.0)], "dataset_code string, time string, value double").write.parquet(path)
    meta = snapshots.metadata_columns(spark.read.parquet(path))
    assert rows(meta) == [("d", None, None, "2020")]
    assert "value" not in meta._jdf.queryExecution().executedPlan().toString()


def test_new_slices_are_landed_once(spark, tmp_path):
    inbox, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(CUBE))
    (tmp_path / "in" / "bad.json").write_text("{}")

    def land():
        land_new_cubes(spark, inbox, out, progress, ["geo", "time"], "eurostat", "d").awaitTermination(120)

    land()
    land()
    assert spark.read.parquet(out).count() == 3
    (tmp_path / "in" / "b.json").write_text(json.dumps(CUBE))
    land()
    assert spark.read.parquet(out).count() == 6
