"""Joins of the star: what their plans look like when tables are large, and the rows they give."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statmart.plans.marts import Star, flatten, labour, marts, social_economy
from statmart.session import checkpointed


@contextmanager
def broadcast_up_to(spark, size: int):
    """Small tables behave as large ones do: nothing above ``size`` bytes is broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark):
    """Rows that years can be derived from, in files."""
    return checkpointed(spark.range(20_000).select(
        (F.col("id") % 3 + 2020).alias("year"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text")))


def test_a_derived_dimension_counts_with_its_own_size(spark, landed):
    """Three years out of a large table are broadcast; by the size of that table all facts would go to three tasks."""
    years = landed.select(F.col("year").alias("time_key"), F.concat(F.lit("y"), F.col("year").cast("string")).alias("label")).distinct()
    fact = landed.select((F.when(F.col("id") % 5 > 0, F.col("id") % 5 + 2019)).alias("time_key"), F.col("id").alias("value"))
    with broadcast_up_to(spark, 20_000):
        out = flatten(fact, [Star(years, "time_key", {"label": "label"})], ["value", "time_key", "label"])
        assert "SortMergeJoin" not in plan(out) and "Exchange hashpartitioning" not in plan(out)
        want = [(i, k, f"y{k}" if k in (2020, 2021, 2022) else None) for i in range(20_000) for k in [i % 5 + 2019 if i % 5 else None]]
        assert rows(out) == sorted(want, key=repr)


def star(table, spark):
    dims = {
        "dim_geography": table([(1, "IT", 0, "IT"), (2, "ITC1", 2, "IT"), (3, "FR", 0, "FR")],
                               "geo_key bigint, nuts_code string, nuts_level bigint, country_code string"),
        "dim_time": table([(1, 2020), (2, 2021)], "time_key bigint, year bigint"),
        "dim_source": table([(1, "a", "istat"), (2, "b", "eurostat")], "source_key bigint, source_id string, provider string"),
        "dim_indicator": table([(1, "volunteering_rate"), (2, "association_membership_rate"), (3, "n_employed")],
                               "indicator_key bigint, indicator_code string"),
        "dim_legal_form": table([(1, "assoc"), (2, "coop")], "legal_form_key bigint, unified_category string"),
    }
    text = {"dim_geography": ["nuts_name_it", "nuts_name_en", "region_name", "macro_area", "municipality_type"], "dim_time": ["reference_period"],
            "dim_source": ["source_name", "priority", "access_type"], "dim_indicator": ["label_it", "label_en"],
            "dim_legal_form": ["unified_category_en", "ets_classification"]}
    dims = {n: checkpointed(d.withColumns({c: F.concat(F.lit(f"{c} "), F.col(d.columns[0]).cast("string")) for c in text[n]})) for n, d in dims.items()}
    ids = spark.range(480)
    key = lambda n, every: F.when(F.col("id") % every != 0, F.col("id") % n + 1)
    absent = ["nace_code", "nace_label_en", "age_group", "volunteering_form", "activity_type", "years_active", "education", "labour_status",
              "household_size", "econ_resources", "org_sector", "org_type", "motivation", "personal_impact", "multi_membership",
              "association_type", "dataset_code", "extracted_at", "unit", "frequency", "period_label", "citizenship", "adjustment",
              "unemployment_duration", "municipality_type", "ets_classification"]
    fact = checkpointed(ids.select(
        key(4, 7).alias("geo_key"), key(3, 11).alias("time_key"), key(3, 13).alias("source_key"), key(5, 17).alias("indicator_key"),
        key(3, 2).alias("legal_form_key"), F.col("id").cast("double").alias("value"), F.lit("total").alias("gender"),
        *[F.lit(None).cast("string").alias(c) for c in absent]))
    return fact, dims


def test_every_fact_is_in_the_flat_mart_once(spark, table):
    fact, dims = star(table, spark)
    number = lambda i, n, every: i % n + 1 if i % every else None
    geo, year, form = {1: "IT", 2: "ITC1", 3: "FR"}, {1: 2020, 2: 2021}, {1: "assoc", 2: "coop"}
    provider = {1: "istat", 2: "eurostat"}
    code = {1: "volunteering_rate", 2: "association_membership_rate", 3: "n_employed"}
    flat = social_economy(fact, dims).select("value", "nuts_code", "year", "provider", "indicator_code", "legal_form")
    want = [(float(i), geo.get(number(i, 4, 7)), year.get(number(i, 3, 11)), provider.get(number(i, 3, 13)), code.get(number(i, 5, 17)),
             form.get(number(i, 3, 2))) for i in range(480)]
    assert rows(flat) == sorted(want, key=repr)
    assert rows(labour(fact, dims).select("value", "nuts_code", "year", "provider", "indicator_code")) == sorted([w[:-1] for w in want], key=repr)
    assert rows(flat.filter("ets_classification is not null").select("value", "legal_form")) == sorted([(w[0], w[5]) for w in want if w[5]], key=repr)


@pytest.mark.parametrize("name", ["se_volunteering_national", "se_associationism_national", "se_employment_eu"])
def test_a_mart_selects_before_the_facts_are_shuffled(spark, table, name):
    """Its filters reach the dimensions, whatever the optional key needs, so that only matching facts are shuffled."""
    fact, dims = star(table, spark)
    with broadcast_up_to(spark, -1):
        mart = marts()[name].of(social_economy(fact, dims))
        joins = [line for line in plan(mart).splitlines() if "SortMergeJoin" in line]
        inner = [line for line in joins if "Inner" in line]
        assert any("indicator_key" in line for line in inner), joins
        assert any(("source_key" if name == "se_employment_eu" else "geo_key") in line for line in inner), joins
    assert rows(mart) == rows(marts()[name].of(checkpointed(social_economy(fact, dims)))) and mart.count() > 0


def test_what_is_shuffled_for_the_indicators_has_no_columns_of_later_dimensions(spark, table):
    fact, dims = star(table, spark)
    with broadcast_up_to(spark, -1):
        text = plan(social_economy(fact, dims))
    order = [k for line in text.splitlines() if "SortMergeJoin" in line
             for k in ("time_key", "source_key", "indicator_key", "geo_key", "legal_form_key") if f"[{k}#" in line or (k == "legal_form_key" and "_on0#" in line)]
    assert order == ["time_key", "source_key", "indicator_key", "geo_key", "legal_form_key"]
