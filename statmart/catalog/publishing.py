"""What is written and read again: mapping files, published tables, logs, reports, declared tables, expected datasets."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from ..operators.align import enforce_schema, typed
from ..operators.scope import counts_by
from ..registry import dataset_table, select_domains
from ..schemas import FACTS, LOAD_LOG
from ..session import shared_dir
from ..sources.landing import append_load_log, create_if_absent, publish, write_lines, write_run_log
from ..sources.mappings import read_mapping
from ..sources.snapshots import open_or_empty
from .base import Tables, query

AT = datetime(2026, 2, 1, 8, 30)


def place(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("mapping_csv", """
    SELECT lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS code, p_name || ', "' || p_brand || '"' AS name, CASE WHEN p_size > 10 THEN p_type END AS kind FROM part""")
def mapping_csv(t):
    """Parts as a mapping file: codes with leading zeros, names with blanks around them, commas and quotes, empty fields."""
    path = place(t, "mapping")
    rows = t.part.select(
        F.lpad(F.col("p_partkey").cast("string"), 7, "0").alias("code"),
        F.concat(F.lit("  "), "p_name", F.lit(', "'), "p_brand", F.lit('" ')).alias("name"), F.when(F.col("p_size") > 10, F.col("p_type")).alias("kind"))
    rows.write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false") \
        .option("ignoreTrailingWhiteSpace", "false").csv(path)
    return read_mapping(t.spark, path).drop("ord")


@query("published_table", "SELECT s_suppkey, s_name, s_nationkey + 2 AS s_nationkey FROM supplier WHERE s_nationkey < 15")
def published_table(t):
    """A table that is replaced from itself, and kept where the replacement is empty."""
    path = place(t, "published")
    publish(t.supplier.filter("s_nationkey < 15").select("s_suppkey", "s_name", "s_nationkey"), path)
    for _ in range(2):
        publish(t.spark.read.parquet(path).withColumn("s_nationkey", F.col("s_nationkey") + 1), path)
    publish(t.spark.read.parquet(path).filter("s_suppkey < 0"), path, skip_empty=True)
    return t.spark.read.parquet(path)


def customers_by_region(t: Tables) -> list:
    """One row per region."""
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return counts_by(rows, ["r_name"]).orderBy("r_name").collect()


_REGIONS = """(SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)"""


@query("load_log", f"SELECT r_name AS domain, 'file of ' || r_name AS file, n AS n_rows, '2026-02-01 08:30' AS loaded FROM {_REGIONS}")
def load_log(t):
    path = place(t, "load_log")
    for r in customers_by_region(t):
        append_load_log(t.spark, path, r["r_name"], f"file of {r['r_name']}", r["n_rows"], AT)
    return t.spark.read.schema(LOAD_LOG).parquet(path).select("domain", "file", "n_rows", F.date_format("loaded_at", "yyyy-MM-dd HH:mm").alias("loaded"))


@query("run_log", f"""
    SELECT 'process' AS stage, r_name AS domain, CASE WHEN n % 2 = 0 THEN 'ok' ELSE 'failed' END AS status, n AS n_rows, CASE WHEN n % 2 = 1 THEN 'odd: ' || n END AS error
    FROM {_REGIONS}""")
def run_log(t):
    """The log of the second run; that of the first is gone."""
    path = place(t, "run_log")
    found = customers_by_region(t)
    write_run_log(t.spark, path, [("ingest", "*", "ok", 1, None, AT, AT)])
    write_run_log(t.spark, path, [("process", r["r_name"], "failed" if r["n_rows"] % 2 else "ok", r["n_rows"],
                                   f"odd: {r['n_rows']}" if r["n_rows"] % 2 else None, AT, AT) for r in found])
    return t.spark.read.schema("stage string, domain string, status string, n_rows bigint, error string").json(path)


@query("report_text", """
    SELECT CAST(row_number() OVER (ORDER BY r_name, n_name) - 1 AS BIGINT) AS position, '- ' || n_name || ' (' || r_name || ')' AS line
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
def report_text(t):
    """Lines of a report in the order they are written."""
    path = place(t, "report")
    lines = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "r_name", "n_name", F.concat(F.lit("- "), "n_name", F.lit(" ("), "r_name", F.lit(")")).alias("line"))
    write_lines(lines, path, ["r_name", "n_name"])
    # a report is one small file, so the position in the scan is the line
    return t.spark.read.text(path).select(F.monotonically_increasing_id().alias("position"), F.col("value").alias("line"))


_DECLARED = sorted(n for n in FACTS if n not in ("fact_labour", "fact_social_economy"))


@query("declared_facts", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", {'count(*)' if n == 'fact_housing' else 'CAST(0 AS BIGINT)'} AS n_rows, "
    f"{'count(DISTINCT o_orderpriority)' if n == 'fact_housing' else 'CAST(0 AS BIGINT)'} AS n_kinds, '{','.join(FACTS[n].names)}' AS columns"
    + (" FROM orders WHERE o_orderstatus = 'P'" if n == "fact_housing" else "") for n in _DECLARED))
def declared_facts(t):
    """The facts of domains without a loader: created empty as declared, one of them then filled."""
    out = None
    rows = t.orders.filter("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("fact_key"), F.col("o_totalprice").cast("string").alias("value"), F.col("o_orderpriority").alias("tenure_type"),
        F.lit("not declared").alias("other"))
    for name in _DECLARED:
        path = place(t, name)
        create_if_absent(t.spark, path, FACTS[name])
        if name == "fact_housing":
            publish(enforce_schema(typed(rows, FACTS[name]), FACTS[name]), path)
        create_if_absent(t.spark, path, FACTS[name])               # there is one: nothing happens
        table = open_or_empty(t.spark, path, FACTS[name])
        kind = F.count_distinct("tenure_type") if "tenure_type" in table.columns else F.lit(0).cast("bigint")
        found = table.agg(F.count("*").alias("n_rows"), kind.alias("n_kinds")).select(
            F.lit(name).alias("table"), "n_rows", "n_kinds", F.lit(",".join(table.columns)).alias("columns"))
        out = found if out is None else out.unionByName(found)
    return out


_LABOUR = [d for d in select_domains(["labour", "no such domain"])[0].datasets]
_VALUES = ", ".join(f"({i}, '{d.code}', '{d.indicator}', '{d.provider}')" for i, d in enumerate(sorted(_LABOUR, key=lambda d: d.code)))


@query("expected_datasets", f"""
    WITH reg AS (SELECT * FROM (VALUES {_VALUES}) v(i, dataset_code, indicator_code, provider)),
    got AS (SELECT o_custkey % {len(_LABOUR) + 2} AS i, count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F' AND o_custkey % {len(_LABOUR) + 2} > 1 GROUP BY 1)
    SELECT dataset_code, indicator_code, provider, coalesce(n_rows, 0) AS n_rows, n_rows IS NULL AS missing FROM reg LEFT JOIN got USING (i)""")
def expected_datasets(t):
    """The registry's datasets of the selected domains against what was delivered: orders dealt to them by customer."""
    domain = select_domains(["labour", "no such domain"])[0].name
    codes = sorted(d.code for d in _LABOUR)
    spot = F.col("o_custkey") % (len(codes) + 2)
    delivered = t.orders.filter("o_orderstatus = 'F'").filter(spot > 1).select(
        F.get(F.array(*[F.lit(c) for c in codes]), spot.cast("int")).alias("dataset_code"))
    counts = counts_by(delivered.filter("dataset_code is not null"), ["dataset_code"])
    return dataset_table(t.spark, domain).join(counts, "dataset_code", "left").select(
        "dataset_code", "indicator_code", "provider", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.col("n_rows").isNull().alias("missing"))
