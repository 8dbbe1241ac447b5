"""Deduplication, numbering and upserts, including skewed inputs."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statmart.operators import dedup, diff, keys, upsert
from statmart.plans import warehouse
from statmart.schemas import DIMENSIONS, ddl
from statmart.session import is_plain_scan


def test_priority_and_null_keys(table):
    df = table([("a", None, 2, 1.0), ("a", None, 1, 2.0), ("a", "x", 2, 3.0), (None, None, 1, 4.0), (None, None, 3, 5.0)],
               "k string, l string, priority int, value double")
    out = dedup.resolve_priority(df, ["k", "l"], "priority", value="value")
    assert rows(out, "k", "l", "value") == [("a", "x", 3.0), ("a", None, 2.0), (None, None, 4.0)]


def test_ties_do_not_depend_on_input_order(table):
    data = [("a", 1, float(v), f"t{v}") for v in range(50)]
    schema = "k string, priority int, value double, tag string"
    first = rows(dedup.resolve_priority(table(data, schema).repartition(7), ["k"], "priority", value="value"))
    again = rows(dedup.resolve_priority(table(data[::-1], schema).repartition(3), ["k"], "priority", value="value"))
    assert first == again == [("a", 1, 0.0, "t0")]


@pytest.mark.parametrize("row_id", [None, "row"])
def test_rows_without_territory_are_all_kept(table, row_id):
    df = table([("", "k", 1, "r1"), (" ", "k", 1, "r2"), (None, "k", 2, "r3"), ("IT", "k", 1, "r4"), ("IT", "k", 2, "r5")],
               "nuts_code string, k string, priority int, id string").withColumn("row", F.col("id"))
    out = dedup.resolve_priority_located(df, "nuts_code", ["nuts_code", "k"], "priority", row_id=row_id)
    assert [r[0] for r in rows(out, "id")] == ["r1", "r2", "r3", "r4"]


def test_hot_key_sends_one_row_per_input_partition(spark):
    """A third of the rows share one key: the plan limits each partition before the shuffle."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = dedup.keep_first(df, ["k"], "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and before > after   # printed bottom-up: partial limit feeds the exchange
    assert out.count() == 200_001
    assert out.filter("k = -1").first()["v"] == 0


def test_collisions(table):
    df = table([("a", "d1", 1), ("a", "d1", 2), ("a", "d2", 3), ("b", "d2", 4)], "k string, d string, v int")
    assert rows(dedup.collisions(df, ["k"], ["d"])) == [("d1", 1, 2)]


@pytest.mark.parametrize("n", [0, 1, 5, 20_000])
def test_contiguous_keys(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 20_011).alias("k"))
    out = keys.contiguous_keys(df, ["k"], "key", after=F.lit(100))
    got = sorted(out.collect(), key=lambda r: r["key"])
    assert [r["key"] for r in got] == list(range(101, 101 + n))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)
    assert dict(out.dtypes)["key"] == "bigint"


def test_copies_are_spread_and_numbered(spark, tmp_path):
    """A third of the table is copies of one row: they must not all meet in one partition."""
    path = str(tmp_path / "copies")
    spark.range(0, 60_000, 1, 6).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k")).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # 60,000 numbers are tiny
    try:
        out = keys.contiguous_keys(spark.read.parquet(path), ["k"], "key", spread_copies=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    written = spark.read.parquet(*[f for f in out.inputFiles()])
    per = written.filter("k = 5").select(F.col("_metadata.file_name").alias("f")).distinct().collect()
    assert len(per) > 1          # several sorted files hold copies
    assert out.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first() == (1, 60_000, 60_000)


SCHEMA = ddl("key bigint, code string, name string, note string")


def test_upsert_keeps_keys_and_is_repeatable(table):
    existing = table([(1, "A", "a", "n"), (2, "B", "b", "n")], "key bigint, code string, name string, note string")
    incoming = table([("B", "draft", 0), ("D", "d", 1), ("B", "b2", 2), ("C", "c", 3), (None, "x", 4)],
                     "code string, name string, ord bigint")
    once = upsert.upsert_dimension(existing, incoming, SCHEMA, "key", ["code"], "ord")
    expected = [(1, "A", "a", "n"), (2, "B", "b2", None), (3, "C", "c", None), (4, "D", "d", None)]
    assert rows(once) == expected
    assert rows(upsert.upsert_dimension(once, incoming, SCHEMA, "key", ["code"], "ord")) == expected
    counted = upsert.upsert_dimension(existing, incoming, SCHEMA, "key", ["code"], "ord", action="action")
    assert tuple(upsert.change_counts(counted, "action").first()) == (2, 1, 4)


def test_upsert_into_an_empty_table(spark, table):
    incoming = table([("B", "b"), ("A", "a")], "code string, name string")
    out = upsert.upsert_dimension(spark.createDataFrame([], SCHEMA), incoming, SCHEMA, "key", ["code"])
    assert rows(out, "key", "code") == [(1, "A"), (2, "B")]


def test_geography_life_cycle(spark, crosswalk, table):
    empty = spark.createDataFrame([], DIMENSIONS["dim_geography"])
    dim = warehouse.refresh_geography(empty, crosswalk)
    by_code = {r["nuts_code"]: r for r in dim.collect()}
    assert by_code["ITC;ITH"]["nuts_level"] is None and by_code["ITC;ITH"]["geo_source"] == "istat_aggregate"
    assert by_code["ITF"]["nuts_name_it"] == "Sud"             # code taken from the local code column
    assert by_code["ITC4C"]["nuts_name_it"] == "Milano (old)"  # the last line wins in the dimension
    assert "ITZ" not in by_code
    grown = warehouse.add_unseen_territories(dim, table([("FR",), ("ITC99",), ("X",), (None,), ("ITC",)], "nuts_code string"))
    new = {r["nuts_code"]: r for r in grown.filter("geo_source = 'eurostat_auto'").collect()}
    assert set(new) == {"FR", "ITC99"}
    assert (new["FR"]["nuts_level"], new["ITC99"]["nuts_level"], new["FR"]["country_code"]) == (0, 3, "FR")
    assert sorted(r["geo_key"] for r in grown.collect()) == list(range(1, grown.count() + 1))
    shorter = crosswalk.filter("nuts_code <> 'ITI14'")
    again = {r["nuts_code"]: r for r in warehouse.refresh_geography(grown, shorter).collect()}
    assert again["ITI14"]["is_active"] is False and again["FR"]["is_active"] is True
    assert again["ITC1"]["geo_key"] == by_code["ITC1"]["geo_key"]


def test_resolve_keys_names_the_first_missing(table):
    geo = table([(1, "IT")], "geo_key bigint, nuts_code string")
    time = table([(5, 2020)], "time_key bigint, year bigint")
    df = table([("IT", 2020), ("FR", 1999), ("IT", 1999), (None, 2020)], "nuts_code string, year bigint")
    out = keys.resolve_keys(df, [keys.KeyLookup("geo_key", geo, {"nuts_code": F.col("nuts_code")}),
                                 keys.KeyLookup("time_key", time, {"year": F.col("year")})])
    assert rows(out, "unresolved_key") == [("geo_key",), ("geo_key",), ("time_key",), (None,)]


def test_runs(table):
    df = table([("a", 5), ("a", 6), ("a", 6), ("a", 7), ("a", 9), ("b", 1), ("b", None)], "g string, o bigint")
    assert rows(diff.runs(df, ["g"], "o")) == [("a", 5, 7, 3), ("a", 9, 9, 1), ("b", 1, 1, 1)]


def test_parity_sees_lost_and_changed_groups(table):
    old = table([("a", 1.0), ("a", 2.0), ("b", 1.0), (None, 1.0)], "k string, v double")
    new = table([("a", 3.0), ("b", 1.0), ("c", 9.0), (None, 1.0)], "k string, v double")
    assert rows(diff.parity(old, new, ["k"], "v")) == [("a", 2, 1, 3.0, 3.0), ("c", None, 1, None, 9.0)]


def test_expected_vs_present(table):
    out = diff.expected_vs_present(table([("a",), ("b",)], "c string"), table([("b",), ("x",), (None,)], "c string"), "c",
                                   table([("b",)], "c string"))
    assert rows(out) == [("a", "missing", False), ("b", "present", True), ("x", "extra", False)]


def test_repeated_codes_never_multiply_rows(table):
    dim = table([(1, "A"), (2, "A"), (3, " b "), (None, "C")], "key bigint, code string")
    df = table([("A",), ("a",), ("B",), (None,), ("x",)], "c string")
    plain = keys.resolve_keys(df, [keys.KeyLookup("key", dim, {"code": F.col("c")})])
    assert rows(plain, "c", "key") == sorted([("A", 1), ("a", None), ("B", None), (None, None), ("x", None)], key=repr)
    folded = keys.resolve_keys(df, [keys.KeyLookup("key", dim, {"code": F.upper("c")}, folded=True)])
    assert rows(folded, "c", "key") == sorted([("A", 1), ("a", 1), ("B", 3), (None, None), ("x", None)], key=repr)


def test_rows_without_a_key_are_spread(spark, table):
    """A third of all rows without a key must not meet in one task when the dimension is too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), "id")
        side = spark.range(0, 50).select(F.col("id").alias("code"), (F.col("id") * 2).alias("twice"))
        out = keys.left_join_spread(df, side, [(F.col("k"), "code")])
        assert out.filter("k is not null and twice is null or twice <> 2 * k").count() == 0 and out.count() == 3000
        per = out.filter("k is null").groupBy(F.spark_partition_id()).count().collect()
        assert len(per) > 4 and max(r["count"] for r in per) < 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookups_of_known_size_are_not_written_again(spark, table, tmp_path):
    """A dimension in files is used as it is; the others are written together, an empty one included."""
    spark.createDataFrame([(1, "a"), (2, "b")], "geo_key bigint, code string").write.parquet(str(tmp_path / "dim"))
    filed = spark.read.parquet(str(tmp_path / "dim"))
    assert is_plain_scan(filed) and is_plain_scan(filed.filter("geo_key > 1").select("code"))
    assert not is_plain_scan(filed.distinct()) and not is_plain_scan(filed.union(filed)) and not is_plain_scan(spark.range(1))
    df = table([("a", 2020), ("b", 2021), ("c", 2020)], "code string, year int")
    years = table([(2020, 7)], "year bigint, time_key bigint")
    lookups = [keys.KeyLookup("geo_key", filed, {"code": F.col("code")}), keys.KeyLookup("time_key", years, {"year": F.col("year")}),
               keys.KeyLookup("form_key", table([], "code string, form_key bigint"), {"code": F.col("code")}, required=False)]
    tables = keys._sized(spark, lookups)
    places = {k: {f.rsplit("/", 2)[1] for f in t.inputFiles()} for k, t in tables.items()}
    assert places == {"geo_key": {"dim"}, "time_key": {"_lookup=time_key"}, "form_key": set()}
    out = keys.resolve_keys(df, lookups)
    assert rows(out, "code", "geo_key", "time_key", "form_key", "unresolved_key") == [
        ("a", 1, 7, None, None), ("b", 2, None, None, "time_key"), ("c", None, 7, None, "geo_key")]
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
