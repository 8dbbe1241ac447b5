"""Several groupings from one scan, and the details behind the texts of checks."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from statmart.operators.groupings import grouped_once
from statmart.plans import quality as q


def test_groupings_equal_one_by_one(spark, table):
    data = [(1, "a", 1.0), (1, "a", 2.0), (1, None, 3.0), (None, None, 4.0), (None, None, 5.0), (2, "b", None), (None, "a", 7.0)]
    df = table(data, "k bigint, n string, v double")
    sets = {"k": ["k"], "n": ["n"], "both": ["n", "k"], "again": ["k", "n"], "all": []}
    got = grouped_once(df, sets, {"total": F.sum("v")})
    for name, columns in sets.items():
        want = df.groupBy(*columns).agg(F.count("*").alias("n_rows"), F.sum("v").alias("total"))
        assert rows(got[name], *columns, "n_rows", "total") == rows(want, *columns, "n_rows", "total"), name
    kept = grouped_once(df, {"k": ["k"], "n": ["n"]}, repeated=("k",))
    assert rows(kept["k"]) == [(1, 3), (None, 3)] and kept["n"].count() == 3


def test_one_scan_and_one_shuffle(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"), "id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    grouped = df.groupingSets([[F.col("a")], [F.col("b")]], "a", "b").agg(F.count("*"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    found = grouped_once(df, {"a": ["a"], "b": ["b"], "id": ["id"]}, repeated=("id",))
    assert found["id"].count() == 0 and dict(rows(found["a"])) == dict(Counter(i % 7 for i in range(1000)))


def test_duplicates_of_a_table_in_one_check(table):
    df = table([(1, "d", "x", 1.0), (1, "d", "x", 2.0), (3, "e", None, 2.0), (4, "e", None, 9.0)],
               "fact_key bigint, dataset_code string, gender string, value double")
    found = {r["check"]: (r["status"], r["observed"], r["detail"]) for r in q.duplicate_checks(df, [["fact_key"]]).collect()}
    for name, alone in (("key uniqueness", q.key_uniqueness(df, "fact_key", [])), ("duplicate rows at grain", q.grain(df))):
        r = alone.first()
        assert found[name] == (r["status"], r["observed"], r["detail"])
    assert found["duplicate rows at grain"][1] == "2"


def test_long_lists_are_cut_in_the_text_and_whole_in_the_details(spark, table):
    many = table([(f"c{i:04d}", float(-i)) for i in range(1, 201)], "c string, v double")
    found = q.violations(many, "c", "v", {"*": (0, None)})
    detail = q.values_within_bounds(found, {"*": (0, None)}).first()["detail"]
    assert detail.count(" rows outside ") == q.LISTED and detail.endswith(" and 150 more")
    extra = q.expected_codes(many, "c", ["c0001", "nope"]).first()
    assert extra["observed"] == "1/2" and extra["detail"].startswith("missing: nope; present but not in expected list: c0002, ")
    assert extra["detail"].endswith("c0051 and 149 more")
    stale = table([(f"d{i:03d}", datetime(2026, 1, 1)) for i in range(60)], "dataset_code string, extracted_at timestamp")
    assert q.datasets_fresh(stale, [], F.lit(datetime(2026, 3, 1))).first()["detail"].endswith("d049 (59 days) and 10 more")
    frequencies = table([(f"f{i:03d}", "x") for i in range(70)], "frequency string, period_label string")
    assert q.frequencies(frequencies, ["A"]).first()["detail"].endswith("f049: 1 and 20 more")
    checks = [
        q.Check("t", "bounds", lambda: q.values_within_bounds(found, {}), lambda: q.bounds_details(found)),
        q.Check("t", "codes", lambda: found, lambda: q.extra_code_details(many, "c", ["c0001"])),
        q.Check("t", "stale", lambda: found, lambda: q.stale_details(stale, F.lit(datetime(2026, 3, 1)))),
        q.Check("t", "frequencies", lambda: found, lambda: q.frequency_details(frequencies)),
        q.Check("t", "broken", lambda: found, lambda: many.select("nope"))]
    assert dict(rows(q.check_details(spark, checks).groupBy("check").count())) == {"bounds": 200, "codes": 199, "stale": 60, "frequencies": 70}
