"""Broken lines and slices become rows; cubes of any axes; landing in batches; parity of rows."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statmart.operators.diff import parity, parity_of_rows
from statmart.plans.ingest import ingest
from statmart.registry import DOMAINS
from statmart.sources import cubes, delimited
from statmart.streaming import landing

CODE = "150_915_DF_DCCV_TAXOCCU1_5"


def cube(axes, values, labels=None):
    return json.dumps({"dimension": {a: {"category": {"index": index, "label": (labels or {}).get(a, {})}} for a, index in axes.items()}, "value": values})


BODIES = [
    cube({"Geo": {"IT": 0, "FR": 1}, "time": {"2021": 0, "2022": 1, "2023": 2}}, {"0": 1.5, "4": 2.0, "5": None, "9": 3.0}, {"Geo": {"IT": "Italia", "FR": "FR"}}),
    cube({"time": {"2021": 0, "2022": 1}, "sex": {"M": 0, "F": 2}, "zone": {"a": 0}}, {"0": 1.0, "2": 2.0, "3": 4.0}, {"sex": {"M": "male", "F": ""}}),
    cube({"only": {"x": 0, "far": 100}}, {"0": 1.0, "1": 2.0, "100": 3.0}),
    cube({"geo": {"IT": 0}}, {}), '{"dimension": {}}', "not json", None]


def test_cubes_of_any_axes_equal_cubes_of_declared_ones(table):
    files = table([(f"s{i}", b) for i, b in enumerate(BODIES)], "source string, body string")
    axes = cubes.axes_found(files)
    assert axes == ["geo", "only", "sex", "time", "zone"]
    declared = cubes.decode_cubes(files, axes)
    found = cubes.decode_any(files)
    assert rows(cubes.with_axes(found, axes).select(declared.columns)) == rows(declared) and declared.count() == 10
    one = {(r["source"], r["value"]): r for r in found.collect()}
    assert one["s0", 1.5]["coordinates"] == {"geo": "IT", "time": "2021"} and one["s0", 1.5]["labels"] == {"geo": "Italia"}
    assert {tuple(r[0]) for r in found.filter("source = 's1'").select(F.map_keys("coordinates")).collect()} == {("time", "sex", "zone")}
    assert one["s1", 4.0]["coordinates"] == {"time": "2022", "sex": "unknown_1", "zone": "a"}
    assert one["s2", 3.0]["coordinates"] == {"only": "far"}
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_broken_lines_are_kept_and_everything_adds_up(spark, tmp_path):
    (tmp_path / "a.csv").write_text('REF_AREA,TIME_PERIOD,OBS_VALUE\n001,2020,1\n001,2021\n001,2022,3,4\n"a, b",2023,:\n"x,y",2024,5\n\n')
    (tmp_path / "b.csv").write_text("OBS_VALUE,REF_AREA,SEX\n7,002,T\n8,002\n")          # another order, another column
    (tmp_path / "empty.csv").write_text("")
    got = delimited.read_checked(spark, str(tmp_path), "labour")
    assert rows(got.observations, "geo", "time", "value") == [("001", "2020", 1.0), ("002", None, 7.0), ("x,y", "2024", 5.0)]
    assert rows(got.quarantine.withColumn("file", F.substring_index("file", "/", -1))) == [
        ("a.csv", "001,2021", "too few fields"), ("a.csv", "001,2022,3,4", "too many fields"), ("b.csv", "8,002", "too few fields")]
    assert tuple(got.tally.first()) == (7, 3, 1, 3)
    with pytest.raises(ValueError):
        delimited.read_checked(spark, str(tmp_path / "empty.csv"), "labour")
    (tmp_path / "no").mkdir()
    (tmp_path / "no" / "c.csv").write_text("REF_AREA,,REF_AREA\n1,2,3\n4,5\n")             # blank and repeated headers, no value
    odd = delimited.read_checked(spark, str(tmp_path / "no"), "labour")
    assert tuple(odd.tally.first()) == (2, 0, 1, 1) and "value" not in odd.observations.columns


def test_ingest_writes_the_quarantine(spark, tmp_path):
    home = tmp_path / "landed" / "labour"
    (home / CODE).mkdir(parents=True)
    (home / CODE / "a.csv").write_text("FREQ,REF_AREA,SEX,AGE,TIME_PERIOD,OBS_VALUE\nA,001,1,Y15-64,2023,70.5\nA,001,2,Y15-64\n")
    (home / "lfst_r_lfu3rt").mkdir()
    (home / "lfst_r_lfu3rt" / "good.json").write_text(cube({"geo": {"FR": 0}, "time": {"2023": 0}}, {"0": 5.0}))
    for i in range(25):
        (home / "lfst_r_lfu3rt" / f"bad{i:02d}.json").write_text("{}")
    with pytest.raises(RuntimeError) as e:
        ingest(spark, str(tmp_path / "landed"), str(tmp_path / "raw"), DOMAINS["labour"], "2026-02", datetime(2026, 2, 5))
    said = str(e.value)
    assert f"{CODE}: 1 broken lines in quarantine" in said and "bad19.json" in said and "bad20.json" not in said
    assert "lfst_r_lfu3rt: 5 more broken slices in quarantine" in said
    kept = spark.read.parquet(str(tmp_path / "raw" / "quarantine" / "labour" / f"{CODE}_2026-02" / "lines"))
    assert rows(kept, "line", "reason") == [("A,001,2,Y15-64", "too few fields")]
    assert spark.read.parquet(str(tmp_path / "raw" / "quarantine" / "labour" / "lfst_r_lfu3rt_2026-02" / "slices")).count() == 25


def test_delimited_files_land_once_with_their_broken_lines(spark, tmp_path):
    inbox, out, broken, progress = (str(tmp_path / n) for n in ("in", "out", "broken", "progress"))
    (tmp_path / "in").mkdir()

    def land(name, text):
        if name:
            (tmp_path / "in" / name).write_text("REF_AREA,OBS_VALUE\n" + text)
        landing.land_new_delimited(spark, inbox, out, broken, progress, ["REF_AREA", "OBS_VALUE"], "labour", "istat", "d").awaitTermination(120)

    land("a.csv", "1,5\n2\n3,:\n")
    land(None, "")
    land("b.csv", "4,6\n5,6,7\n")
    assert rows(spark.read.parquet(out), "geo", "value", "dataset_code") == [("1", 5.0, "d"), ("4", 6.0, "d")]
    assert rows(spark.read.parquet(broken), "line", "reason") == [("2", "too few fields"), ("5,6,7", "too many fields")]


def test_checked_cubes(spark, tmp_path):
    inbox, out, broken, progress = (str(tmp_path / n) for n in ("in", "out", "broken", "progress"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(BODIES[0])
    (tmp_path / "in" / "bad.json").write_text("{}")
    for _ in range(2):
        landing.land_checked_cubes(spark, inbox, out, broken, progress, ["geo", "time"], "eurostat", "d").awaitTermination(120)
    assert spark.read.parquet(out).count() == 4
    assert rows(spark.read.parquet(broken), "reason") == [("missing key: dimension",)]


def test_a_batch_that_was_cut_off_is_repeated_without_doubling(spark, tmp_path):
    inbox, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "event_id bigint, ts timestamp"
    at = datetime(2026, 1, 1)
    spark.createDataFrame([(i, at) for i in range(50)], schema).write.parquet(inbox)

    def stream():
        return spark.readStream.schema(schema).parquet(inbox)

    fail = [True]

    def split(batch):
        yield_first = {"rows": batch}
        if fail[0]:
            yield_first["other"] = batch.select(F.raise_error(F.lit("power cut")))     # the first table is written by then
        else:
            yield_first["other"] = batch.select("event_id")
        return yield_first

    unique = stream().withWatermark("ts", "1 day").dropDuplicatesWithinWatermark(["event_id"])
    folders = {"rows": out, "other": str(tmp_path / "other")}
    with pytest.raises(Exception, match="power cut"):
        landing.in_batches(unique, folders, split, progress).awaitTermination(120)
    assert spark.read.parquet(out).count() == 50
    fail[0] = False
    landing.in_batches(unique, folders, split, progress).awaitTermination(120)
    assert spark.read.parquet(out).count() == 50 and spark.read.parquet(folders["other"]).count() == 50
    spark.createDataFrame([(i, at) for i in range(40, 60)], schema).write.mode("append").parquet(inbox)
    landing.in_batches(unique, folders, split, progress).awaitTermination(120)      # ten of these have been landed before
    assert rows(spark.read.parquet(out).groupBy().agg(F.count("*"), F.count_distinct("event_id"))) == [(60, 60)]


def test_rows_that_changed_places(table):
    schema = "k string, a int, v double"
    old = table([("x", 1, 1.0), ("x", 2, 2.0), ("y", 1, None), ("y", None, 1.0), ("z", 1, 1.0), ("z", 1, 1.0), (None, 1, 1.0), ("gone", 1, 1.0)], schema)
    new = table([("x", 2, 1.0), ("x", 1, 2.0), ("y", None, 1.0), ("y", 1, None), ("z", 1, 1.0), ("z", 1, 1.0), (None, 1, 2.0), ("new", 1, 1.0)], schema)
    assert rows(parity_of_rows(old, new, ["k"], ["a", "v"])) == [("gone", 1, None), ("new", None, 1), ("x", 2, 2), (None, 1, 1)]
    assert rows(parity(old, new, ["k"], "v"), "k") == [("gone",), ("new",), (None,)]       # counts and sums of x agree
    thrice = table([("z", 1, 1.0), ("z", 2, 2.0), ("z", 2, 2.0)], schema)
    other = table([("z", 1, 1.0), ("z", 3, 3.0), ("z", 3, 3.0)], schema)                    # repeats do not cancel out
    assert parity_of_rows(thrice, other, ["k"], ["a", "v"]).count() == 1
    swapped = table([("n", None, 1.0)], schema), table([("n", 1, None)], schema)
    assert parity_of_rows(*swapped, ["k"], ["a", "v"]).count() == 1
