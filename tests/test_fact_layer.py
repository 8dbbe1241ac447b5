"""A fact is built from its written processed table, not from the landed rows over and over."""

from __future__ import annotations

import statmart.catalog.facts as facts
from statmart.catalog.base import Tables
from statmart.session import is_plain_scan


def test_the_landed_rows_are_merged_once(spark, monkeypatch, table, tmp_path):
    nation = table([(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int")
    region = table([(0, "AFRICA"), (1, "ASIA"), (2, "EUROPE")], "r_regionkey int, r_name string")
    customer = table([(1, 0), (2, 1)], "c_custkey bigint, c_nationkey int")
    orders = table([(6, 1, "O", 100.0, "1-URGENT", "1995-01-02"), (1, 2, "F", 50.0, "2-HIGH", "1996-01-02"), (7, 2, "F", 40.0, "2-HIGH", "1996-01-02")],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string, o_orderdate string")
    part = table([("ECONOMY", 10.0)], "p_type string, p_retailprice double")
    lineitem = table([(2, 1, 4, 5.0, "1996-01-01"), (2, 2, 8, 7.0, "1996-01-01")],
                     "l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_shipdate string")
    for name, df in {"nation": nation, "region": region, "customer": customer, "orders": orders, "part": part, "lineitem": lineitem}.items():
        for c in ("o_orderdate", "l_shipdate"):
            if c in df.columns:
                df = df.withColumn(c, df[c].cast("timestamp_ntz"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    given = []
    build = facts.build_fact
    monkeypatch.setattr(facts, "build_fact", lambda domain, processed, dims: given.append(processed) or build(domain, processed, dims))
    fact = facts.fact_build_social_economy(Tables(spark, str(tmp_path)))
    assert is_plain_scan(given[0])
    got = sorted((r["value"], r["time_key"], r["indicator_key"], r["legal_form_key"], r["gender"]) for r in fact.collect())
    assert got == [(5.0, 2021, 3, None, None), (7.0, 2021, 3, None, None), (10.0, 2020, 2, None, None), (40.0, 2021, 1, 2, "female"), (100.0, 2020, 1, 1, "male")]
