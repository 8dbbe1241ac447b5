"""Dimension maintenance and surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.keys import contiguous_keys, max_key
from ..operators.upsert import change_counts, delete_where, insert_unseen, retire_missing, upsert_dimension
from ..plans.marts import period_dimension
from ..plans.warehouse import geography_rows, source_rows
from ..schemas import DIMENSIONS, ddl
from .base import Tables, query
from .lookups import supplier_crosswalk, XWALK_SQL

CUSTOMERS = ddl("customer_key bigint, c_name string, c_mktsegment string, c_acctbal double, c_nationkey int")


def existing_customers(t: Tables):
    """Customers of the later nations are already keyed, with an older segment."""
    return t.customer.filter("c_nationkey >= 8").select(
        (F.col("c_custkey") + 1).alias("customer_key"), "c_name", F.lit("OLD").alias("c_mktsegment"), "c_acctbal",
        "c_nationkey")


def incoming_customers(t: Tables):
    """Customers with a fair balance are listed, each twice; the later line is the one that counts. The richest have
    lost their name, so they have no natural key."""
    rows = t.customer.filter("c_acctbal > 4000")
    name = F.when(F.col("c_acctbal") <= 9800, F.col("c_name"))
    one = rows.select(name.alias("c_name"), F.lit("DRAFT").alias("c_mktsegment"), "c_acctbal", F.col("c_custkey").alias("ord"))
    two = rows.select(name.alias("c_name"), "c_mktsegment", (F.col("c_acctbal") + 1).alias("c_acctbal"),
                      (F.col("c_custkey") + 1_000_000_000).alias("ord"))
    return one.unionByName(two)


UPSERT_SQL = """ex AS (SELECT c_custkey + 1 AS customer_key, c_name, 'OLD' AS c_mktsegment, c_acctbal, c_nationkey
        FROM customer WHERE c_nationkey >= 8),
    inc AS (SELECT c_name, c_mktsegment, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_acctbal > 4000 AND c_acctbal <= 9800),
    up AS (SELECT customer_key, ex.c_name, CASE WHEN inc.c_name IS NULL THEN ex.c_mktsegment ELSE inc.c_mktsegment END AS c_mktsegment,
             CASE WHEN inc.c_name IS NULL THEN ex.c_acctbal ELSE inc.c_acctbal END AS c_acctbal,
             CASE WHEN inc.c_name IS NULL THEN ex.c_nationkey END AS c_nationkey,
             CASE WHEN inc.c_name IS NULL THEN 'kept' ELSE 'updated' END AS action
           FROM ex LEFT JOIN inc USING (c_name)
           UNION ALL
           SELECT (SELECT max(customer_key) FROM ex) + row_number() OVER (ORDER BY inc.c_name), inc.c_name, inc.c_mktsegment,
                  inc.c_acctbal, NULL, 'inserted'
           FROM inc WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.c_name = inc.c_name))"""


def upserted(t: Tables):
    return upsert_dimension(existing_customers(t), incoming_customers(t), CUSTOMERS, "customer_key", ["c_name"], "ord",
                            action="action")


@query("dim_upsert", f"WITH {UPSERT_SQL} SELECT * FROM up")
def dim_upsert(t):
    return upserted(t)


@query("dim_upsert_counts", f"""
    WITH {UPSERT_SQL} SELECT count(*) FILTER (action = 'inserted') AS n_inserted, count(*) FILTER (action = 'updated') AS n_updated,
        count(*) AS n_rows FROM up""")
def dim_upsert_counts(t):
    return change_counts(upserted(t), "action")


GEO_SQL = """geo AS (SELECT n_nationkey + 1 AS geo_key, 'A' || CAST(n_nationkey AS VARCHAR) AS nuts_code FROM nation),
    used AS (SELECT DISTINCT CASE WHEN l_suppkey % 9 = 0 THEN 'Z' ELSE 'A' || CAST(l_suppkey AS VARCHAR) END AS nuts_code FROM lineitem),
    fresh AS (SELECT nuts_code FROM used WHERE length(nuts_code) >= 2 AND nuts_code NOT IN (SELECT nuts_code FROM geo))"""


def nation_geography(t: Tables):
    text = [F.lit(None).cast(f.dataType).alias(f.name) for f in DIMENSIONS["dim_geography"]
            if f.name not in ("geo_key", "nuts_code")]
    return t.nation.select((F.col("n_nationkey") + 1).cast("bigint").alias("geo_key"),
                           F.concat(F.lit("A"), F.col("n_nationkey").cast("string")).alias("nuts_code"), *text)


@query("dim_insert_unseen", f"""
    WITH {GEO_SQL}
    SELECT geo_key, nuts_code, CAST(NULL AS BIGINT) AS nuts_level, CAST(NULL AS VARCHAR) AS country_code,
           CAST(NULL AS VARCHAR) AS geo_source, CAST(NULL AS BOOLEAN) AS is_active FROM geo
    UNION ALL
    SELECT (SELECT max(geo_key) FROM geo) + row_number() OVER (ORDER BY nuts_code), nuts_code,
           CASE WHEN length(nuts_code) <= 5 THEN length(nuts_code) - 2 END, substring(nuts_code, 1, 2), 'eurostat_auto', true
    FROM fresh""")
def dim_insert_unseen(t):
    from ..plans.warehouse import add_unseen_territories
    code = F.when(F.col("l_suppkey") % 9 == 0, F.lit("Z")).otherwise(F.concat(F.lit("A"), F.col("l_suppkey").cast("string")))
    dim = add_unseen_territories(nation_geography(t), t.lineitem.select(code.alias("nuts_code")))
    return dim.select("geo_key", "nuts_code", "nuts_level", "country_code", "geo_source", "is_active")


@query("dim_retire", """
    SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') AND NOT EXISTS
        (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN false ELSE c_acctbal > 0 END AS is_active FROM customer""")
def dim_retire(t):
    dim = t.customer.select("c_custkey", "c_mktsegment", (F.col("c_acctbal") > 0).alias("is_active"))
    listed = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return retire_missing(dim, listed, "c_custkey", "c_mktsegment", ["BUILDING", "FURNITURE"])


@query("dim_delete", """
    SELECT p_partkey, code FROM (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'IT' || repeat('Z', 1 + p_size % 3)
        WHEN p_size % 5 = 1 THEN NULL ELSE 'ITC' || CAST(p_size AS VARCHAR) END AS code FROM part)
    WHERE code IS NULL OR NOT regexp_matches(code, '^[A-Z]{2}Z+$')""")
def dim_delete(t):
    code = F.expr("""case when p_size % 5 = 0 then 'IT' || repeat('Z', 1 + p_size % 3) when p_size % 5 = 1 then null
                          else 'ITC' || cast(p_size as string) end""")
    return delete_where(t.part.select("p_partkey", code.alias("code")), F.col("code").rlike("^[A-Z]{2}Z+$"))


@query("surrogate_keys", """
    SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name) AS supplier_key, c_name
    FROM customer""")
def surrogate_keys(t):
    fresh = t.customer.select("c_name")
    return contiguous_keys(fresh, ["c_name"], "supplier_key", after=max_key(t.supplier, "s_suppkey"))


@query("fact_key", """
    SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
        l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS fact_key FROM lineitem""")
def fact_key(t):
    return contiguous_keys(t.lineitem, ["l_orderkey", "l_linenumber"], "fact_key", spread_copies=True)


@query("geography_rows", f"""
    WITH {XWALK_SQL} SELECT ord, nuts_code, CASE WHEN NOT contains(nuts_code, ';') THEN CAST(nuts_level AS BIGINT) END AS nuts_level,
        istat_code, 'IT' AS country_code, CASE WHEN contains(nuts_code, ';') THEN 'istat_aggregate' ELSE 'nuts_istat_csv' END AS geo_source,
        true AS is_active
    FROM xwalk WHERE nuts_code IS NOT NULL""")
def geography(t):
    crosswalk = supplier_crosswalk(t).withColumns({c: F.lit("") for c in ("nuts_name_en", "region_name", "macro_area")})
    return geography_rows(crosswalk).select("ord", "nuts_code", "nuts_level", "istat_code", "country_code", "geo_source",
                                            "is_active")


@query("source_rows", """
    SELECT s_suppkey, lower(split_part(s_name, '#', 1)) || '_' || CAST(s_nationkey AS VARCHAR) AS source_id,
           lower(split_part(s_name, '#', 1)) AS provider, CASE WHEN s_nationkey < 10 THEN CAST(s_nationkey AS BIGINT) END AS priority
    FROM supplier""")
def sources(t):
    rows = t.supplier.select(
        "s_suppkey", F.concat(F.lower(F.split_part("s_name", F.lit("#"), F.lit(1))), F.lit("_"),
                              F.col("s_nationkey").cast("string")).alias("source_id"),
        F.when(F.col("s_nationkey") < 10, F.col("s_nationkey").cast("string")).otherwise("n.d.").alias("priority"))
    return source_rows(rows).select("s_suppkey", "source_id", "provider", "priority")


@query("period_dimension", """
    WITH l AS (SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y')
        WHEN 1 THEN strftime(o_orderdate, '%Y') || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR)
        ELSE strftime(o_orderdate, '%Y-%m') END AS c, o_orderkey % 3 AS f,
        CASE o_orderkey % 3 WHEN 0 THEN date_trunc('year', o_orderdate) WHEN 1 THEN date_trunc('quarter', o_orderdate)
        ELSE date_trunc('month', o_orderdate) END::DATE AS s FROM orders)
    SELECT c AS period_code, CASE f WHEN 0 THEN 'A' WHEN 1 THEN 'Q' ELSE 'M' END AS frequency, year(s) AS year,
        CASE WHEN f = 1 THEN CAST(quarter(s) AS INTEGER) END AS quarter, CASE WHEN f = 2 THEN CAST(month(s) AS INTEGER) END AS month,
        s AS start_date, CAST(s + CASE f WHEN 0 THEN INTERVAL 1 YEAR WHEN 1 THEN INTERVAL 3 MONTH ELSE INTERVAL 1 MONTH END
            - INTERVAL 1 DAY AS DATE) AS end_date
    FROM l""")
def periods(t):
    n = F.col("o_orderkey") % 3
    year = F.date_format("o_orderdate", "yyyy")
    label = F.when(n == 0, year).when(n == 1, F.concat(year, F.lit("-Q"), F.quarter("o_orderdate").cast("string"))) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    return period_dimension(t.orders.select(label.alias("label")), "label").drop("ordinal")
