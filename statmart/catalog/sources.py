"""Snapshot choice, decoding and landing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..functions.periods import any_year
from ..operators.align import stack, typed
from ..registry import Dataset, RENAME
from ..schemas import ddl
from ..sources.cubes import axes_found, cube_problems, decode_any, decode_cubes
from ..sources.delimited import dataset_rows, observations, read_checked
from ..session import checkpointed, shared_dir
from ..sources.landing import manifest, missing_datasets, with_provenance
from ..sources.layers import PartitionedMonths
from ..sources.snapshots import metadata_columns, newest, newest_rows
from ..streaming.landing import land_once
from .base import Tables, query



def monthly_orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))


@query("snapshot_latest", """
    WITH o AS (SELECT o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month FROM orders)
    SELECT o.* FROM o JOIN (SELECT o_orderpriority, max(month) AS month FROM o GROUP BY 1) m
      ON o.o_orderpriority = m.o_orderpriority AND o.month = m.month""")
def snapshot_latest(t):
    return newest_rows(monthly_orders(t), ["o_orderpriority"], "month").select("o_orderkey", "o_orderpriority", "month")


@query("snapshot_previous", """
    SELECT o_custkey, max(strftime(o_orderdate, '%Y-%m')) AS month FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') < '1998-06' GROUP BY 1""")
def snapshot_previous(t):
    return newest(monthly_orders(t), ["o_custkey"], "month", before="1998-06")


@query("metadata_scan", """
    SELECT event_type AS dataset_code, CAST(NULL AS VARCHAR) AS extracted_at, CAST(NULL AS VARCHAR) AS period_label,
           strftime(ts, '%Y-%m-%d') AS time, count(*) AS n_rows
    FROM events GROUP BY 1, 4""")
def metadata_scan(t):
    snapshot = t.events.withColumnRenamed("event_type", "dataset_code") \
        .withColumn("time", F.date_format("ts", "yyyy-MM-dd"))
    meta = metadata_columns(snapshot)
    return meta.groupBy(*meta.columns).agg(F.count("*").alias("n_rows"))


def order_layer(t: Tables) -> PartitionedMonths:
    """Orders as a layer of datasets (priorities) and months; then one month of two datasets is delivered again, dearer."""
    layer = PartitionedMonths(t.spark, f"{shared_dir(t.spark).rstrip('/')}/layer-{uuid.uuid4().hex}")
    rows = monthly_orders(t).select("o_orderkey", F.col("o_orderpriority").alias("dataset_code"), "o_totalprice", "month")
    layer.write_all(rows)
    again = rows.filter("month = '1998-03' AND o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for name in ("1-URGENT", "5-LOW"):
        layer.write(again.filter(F.col("dataset_code") == name).drop("month"), name, "1998-03", [])
    return layer


_LAYER_SQL = """WITH o AS (SELECT o_orderkey, o_orderpriority AS name, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders),
    now AS (SELECT o_orderkey, name, month, CASE WHEN month = '1998-03' AND name IN ('1-URGENT', '5-LOW') AND o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price
        FROM o WHERE NOT (month = '1998-03' AND name IN ('1-URGENT', '5-LOW') AND o_orderkey % 3 <> 0
            AND EXISTS (SELECT 1 FROM o p WHERE p.name = o.name AND p.month = '1998-03' AND p.o_orderkey % 3 = 0)))"""


@query("layer_profile", f"{_LAYER_SQL} SELECT name, month, count(*) AS n_rows FROM now GROUP BY 1, 2")
def layer_profile(t):
    return order_layer(t).profile()


@query("layer_newest", f"""{_LAYER_SQL} SELECT o_orderkey, name AS dataset_code, month, price AS o_totalprice FROM now
    WHERE (name, month) IN (SELECT (name, max(month)) FROM now WHERE month < '1998-04' GROUP BY name)""")
def layer_newest(t):
    return order_layer(t).read_newest(ddl("o_orderkey bigint, o_totalprice double"), before="1998-04")


def delimited_lines(t: Tables) -> DataFrame:
    """Line items as a delimited file would give them: odd headers, all text, some values that are not numbers."""
    value = F.expr("""case when l_linenumber = 1 then '-' when l_linenumber = 2 then '1d'
                           else cast(cast(l_quantity as int) as string) end""")
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("REF_AREA"), F.date_format("l_shipdate", "yyyy-MM").alias(" TIME_PERIOD"),
        F.col("l_returnflag").alias("SEX"), F.when(F.col("l_linestatus") == "O", F.col("l_linestatus"))
        .alias("TYPE_ACTIVITY_PERFORMED"), F.lit("x").alias("TIPO_ATTIVITA"), F.lit("p").alias("OBS_STATUS"),
        value.alias("Obs_Value "))


@query("delimited_observations", r"""
    SELECT CAST(l_orderkey AS VARCHAR) AS geo, strftime(l_shipdate, '%Y-%m') AS time, l_returnflag AS gender,
           CASE WHEN l_linestatus = 'O' THEN 'O' ELSE 'x' END AS activity_type,
           CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS value
    FROM lineitem WHERE l_linenumber NOT IN (1, 2)""")
def delimited_observations(t):
    return observations(delimited_lines(t), RENAME["social_economy"])


@query("delimited_quarantine", """
    SELECT CASE WHEN l_linenumber = 1 AND l_suppkey % 5 = 0 THEN 'too few fields' WHEN l_linenumber = 2 AND l_suppkey % 5 = 1 THEN 'too many fields'
        WHEN l_linenumber = 3 THEN 'missing' ELSE 'kept' END AS outcome, count(*) AS n_lines,
        CAST(sum(CASE WHEN (l_linenumber <> 1 OR l_suppkey % 5 <> 0) AND (l_linenumber <> 2 OR l_suppkey % 5 <> 1) AND l_linenumber <> 3
            THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS quantity
    FROM lineitem GROUP BY 1""")
def delimited_quarantine(t):
    """Line items as delimited text, some lines with a field too few or too many, some values no numbers."""
    few, many, missing = "l_linenumber = 1 and l_suppkey % 5 = 0", "l_linenumber = 2 and l_suppkey % 5 = 1", "l_linenumber = 3"
    value = F.when(F.expr(missing), ":").otherwise(F.col("l_quantity").cast("int").cast("string"))
    fields = [F.col("l_orderkey").cast("string"), F.concat(F.lit('"a, b '), F.col("l_returnflag"), F.lit('"')), value]
    line = F.when(F.expr(few), F.concat_ws(",", *fields[:2])).when(F.expr(many), F.concat_ws(",", *fields, F.lit("more"))) \
        .otherwise(F.concat_ws(",", *fields))
    path = f"{shared_dir(t.spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    t.lineitem.select(line.alias("value")).write.text(path)
    found = read_checked(t.spark, path, "labour", ["REF_AREA", "NOTE", "OBS_VALUE"])
    none = F.lit(None).cast("bigint")
    kept = found.observations.agg(F.lit("kept").alias("outcome"), F.count("*").alias("n_lines"), F.sum("value").cast("bigint").alias("quantity"))
    missed = found.tally.select(F.lit("missing").alias("outcome"), F.col("n_missing").alias("n_lines"), none.alias("quantity"))
    return kept.unionByName(missed.filter("n_lines > 0")).unionByName(
        found.quarantine.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("n_lines"), none.alias("quantity")))


@query("dataset_filters", """
    SELECT o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS time FROM orders
    WHERE year(o_orderdate) >= 1998 AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def dataset_filters(t):
    rule = Dataset("orders", "istat", "labour", "n", "count", start=1998,
                   keep={"o_orderpriority": ["1-URGENT", "2-HIGH"]}, drop=["o_orderstatus"])
    rows = monthly_orders(t).select("o_orderkey", "o_orderpriority", "o_orderstatus", F.col("month").alias("time"))
    return dataset_rows(rows, rule)


CELLS_SQL = """
    SELECT l_suppkey AS cube_id, l_returnflag AS flag, l_linestatus AS status, CAST(year(l_shipdate) AS VARCHAR) AS time,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS value
    FROM lineitem GROUP BY 1, 2, 3, 4"""


def encode_cubes(df: DataFrame, by: list[str], axes: list[str], value: str) -> DataFrame:
    """Test input: one JSON cube per ``by`` group, the inverse of decoding. Cells must be unique in a group.

    A cube holds one value per cell, so a group is as large as the product of its axes, whatever the fact table's
    size; aggregate to cells first.
    """
    sets = df.groupBy(*by).agg(*[F.sort_array(F.collect_set(a)).alias(f"_set_{a}") for a in axes])
    keyed = df.join(sets.select(*[F.col(b).alias(f"_{b}") for b in by], *[f"_set_{a}" for a in axes]),
                    [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by])
    flat = F.lit(0).cast("bigint")
    for a in axes:
        flat = flat * F.size(f"_set_{a}") + F.array_position(f"_set_{a}", F.col(a)) - 1
    cells = keyed.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct(flat.cast("string"), F.col(value)))).alias("value"),
        *[F.first(f"_set_{a}").alias(f"_set_{a}") for a in axes])
    axis = [
        F.struct(F.struct(F.map_from_entries(F.transform(
            F.col(f"_set_{a}"), lambda x, i: F.struct(x.cast("string"), i))).alias("index")).alias("category")).alias(a)
        for a in axes
    ]
    return cells.select(*by, F.to_json(F.struct(F.struct(*axis).alias("dimension"), F.col("value"))).alias("body"))


def line_cubes(t: Tables) -> DataFrame:
    """One JSON cube per supplier: return flag x line status x year."""
    cells = t.lineitem.groupBy(
        F.col("l_suppkey").alias("cube_id"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        F.year("l_shipdate").cast("string").alias("time")
    ).agg(F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("value"))
    return encode_cubes(cells, ["cube_id"], ["flag", "status", "time"], "value")


@query("cube_decode", CELLS_SQL)
def cube_decode(t):
    return decode_cubes(line_cubes(t), ["flag", "status", "time"]).select("cube_id", "flag", "status", "time", "value")


@query("cubes_of_any_axes", """
    SELECT l_suppkey AS cube_id, 'flag=' || l_returnflag || CASE WHEN l_suppkey % 2 = 0 THEN ';status=' || l_linestatus ELSE '' END
        || ';time=' || year(l_shipdate) AS place, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS value
    FROM lineitem GROUP BY 1, 2""")
def cubes_of_any_axes(t):
    """Two shapes of cubes in one scan, none of them declared."""
    rows = decode_any(mixed_cubes(t))
    place = F.array_join(F.transform(F.array_sort(F.map_entries("coordinates")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return rows.select("cube_id", place.alias("place"), "value")


def mixed_cubes(t: Tables) -> DataFrame:
    """Cubes with three axes for some suppliers and with two for the others."""
    cells = t.lineitem.select(
        F.col("l_suppkey").alias("cube_id"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        F.year("l_shipdate").cast("string").alias("time"), F.col("l_quantity").cast("bigint").alias("n"))
    even, odd = cells.filter("cube_id % 2 = 0"), cells.filter("cube_id % 2 <> 0")
    return encode_cubes(even.groupBy("cube_id", "flag", "status", "time").agg(F.sum("n").cast("double").alias("value")),
                        ["cube_id"], ["flag", "status", "time"], "value").unionByName(
        encode_cubes(odd.groupBy("cube_id", "flag", "time").agg(F.sum("n").cast("double").alias("value")),
                     ["cube_id"], ["time", "flag"], "value"))


@query("cubes_with_found_axes", """
    SELECT l_suppkey AS cube_id, l_returnflag AS flag, CASE WHEN l_suppkey % 2 = 0 THEN l_linestatus END AS status,
        CAST(year(l_shipdate) AS VARCHAR) AS time, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS value
    FROM lineitem GROUP BY 1, 2, 3, 4""")
def cubes_with_found_axes(t):
    cubes = checkpointed(mixed_cubes(t))
    return decode_cubes(cubes, axes_found(cubes)).select("cube_id", "flag", "status", "time", "value")


@query("cube_problems", "SELECT s_suppkey AS cube_id, 'missing key: value' AS problem FROM supplier WHERE s_nationkey = 3")
def cube_problem_rows(t):
    good = '{"dimension": {"geo": {"category": {"index": {"IT": 0}}}}, "value": {"0": 1.5}}'
    bad = '{"dimension": {"geo": {"category": {"index": {"IT": 0}}}}}'
    files = t.supplier.select(F.col("s_suppkey").alias("cube_id"),
                              F.when(F.col("s_nationkey") == 3, bad).otherwise(good).alias("body"))
    return cube_problems(files)


@query("slice_union", """
    SELECT 'A' AS slice, l_orderkey, l_quantity AS value, l_linestatus AS status, CAST(NULL AS VARCHAR) AS mode
      FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL
    SELECT 'R', l_orderkey, l_extendedprice, CAST(NULL AS VARCHAR), 'price' FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL
    SELECT l_returnflag, l_orderkey, l_discount, l_linestatus, 'discount' FROM lineitem
    WHERE l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'R')""")
def slice_union(t):
    a = t.lineitem.filter("l_returnflag = 'A'").select(
        F.lit("A").alias("slice"), "l_orderkey", F.col("l_quantity").alias("value"), F.col("l_linestatus").alias("status"))
    r = t.lineitem.filter("l_returnflag = 'R'").select(
        F.lit("R").alias("slice"), "l_orderkey", F.col("l_extendedprice").alias("value"), F.lit("price").alias("mode"))
    n = t.lineitem.filter("l_returnflag is null or l_returnflag not in ('A', 'R')").select(
        F.col("l_returnflag").alias("slice"), "l_orderkey", F.col("l_discount").alias("value"),
        F.col("l_linestatus").alias("status"), F.lit("discount").alias("mode"))
    return stack([a, r, n])


@query("events_in_batches", """
    SELECT event_type, count(*) AS n_events, min(event_id) AS first_event, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1""")
def events_in_batches(t):
    """Events delivered in several files, a third of them twice, landed by a stream that stops in between."""
    home = f"{shared_dir(t.spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    delivered = t.events.unionByName(t.events.filter("event_id % 3 = 0")).withColumn("ts", F.col("ts").cast("timestamp"))
    for part in (0, 1):
        delivered.filter(F.col("event_id") % 2 == part).repartition(3).write.mode("append").parquet(f"{home}/inbox")
        stream = t.spark.readStream.schema(delivered.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/inbox")
        land_once(stream, f"{home}/out", f"{home}/progress", ["event_id"], "ts", "365 days").awaitTermination()
    return t.spark.read.parquet(f"{home}/out").groupBy("event_type").agg(
        F.count("*").alias("n_events"), F.min("event_id").alias("first_event"), F.sum("user_id").alias("users"))


@query("provenance_manifest", """
    SELECT event_type AS dataset_code, count(*) AS row_count, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS extracted_at,
           'events' AS description
    FROM events GROUP BY 1""")
def provenance_manifest(t):
    parts = t.events.withColumn("dataset_code", F.col("event_type"))
    tagged = with_provenance(parts, "istat", "", F.col("ts")).withColumn("dataset_code", F.col("event_type"))
    return manifest(tagged, description="events").withColumn(
        "extracted_at", F.date_format("extracted_at", "yyyy-MM-dd HH:mm:ss"))


@query("missing_datasets", """
    SELECT c_custkey AS dataset_code, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""")
def missing(t):
    expected = t.customer.select(F.col("c_custkey").alias("dataset_code"), "c_name")
    landed = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("dataset_code"))
    return missing_datasets(expected, landed)


@query("typed_load", r"""
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value, CAST(NULL AS VARCHAR) AS note,
           event_type
    FROM events""")
def typed_load(t):
    loose = t.events.select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), F.col("value").cast("string").alias("value"),
        F.col("user_id").alias("note"), "event_type")
    return typed(loose, ddl("event_id bigint, k bigint, value double, note string, event_type string"))


@query("year_from_label", r"""
    SELECT event_id, CAST(regexp_extract(label, '\d{4}') AS BIGINT) AS year FROM (
      SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m') WHEN 1 THEN 'Q1/' || strftime(ts, '%Y')
                       ELSE strftime(ts, '%d.%m.%Y') END AS label FROM events)""")
def year_from_label(t):
    label = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM")) \
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit("Q1/"), F.date_format("ts", "yyyy"))) \
        .otherwise(F.date_format("ts", "dd.MM.yyyy"))
    return t.events.select("event_id", any_year(label).alias("year"))
