"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes, numbers, periods, strings
from ..operators.align import column_or_null, enforce_schema, first_present, stack
from ..operators.scope import breakdown, classify, counts_by, sample_codes, suspicious
from ..plans.merge import tagged
from ..registry import GEO_COLUMNS, TIME_COLUMNS, inline
from ..schemas import ddl
from .base import Tables, query


@query("schema_align", """
    SELECT o_orderkey AS key, CAST(NULL AS VARCHAR) AS event_type, o_totalprice AS value, CAST(NULL AS BIGINT) AS year
      FROM orders
    UNION ALL SELECT event_id, event_type, value, CAST(NULL AS BIGINT) FROM events""")
def schema_align(t):
    schema = ddl("key bigint, event_type string, value double, year bigint")
    o = t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"), "o_orderstatus")
    e = t.events.select(F.col("event_id").alias("key"), "event_type", "value", "props")
    return enforce_schema(stack([o, e]), schema)


@query("numeric_coerce", r"""
    WITH v AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN json_extract_string(props, '$.k')
                 WHEN 1 THEN json_extract_string(props, '$.k') || 'd' WHEN 2 THEN ' -1.5e3 ' WHEN 3 THEN 'NaN'
                 WHEN 4 THEN ':' ELSE '.' || json_extract_string(props, '$.k') END AS raw FROM events)
    SELECT event_id, CAST(trim(raw) AS DOUBLE) AS value FROM v
    WHERE regexp_matches(trim(raw), '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$')""")
def numeric_coerce(t):
    k = F.get_json_object("props", "$.k")
    n = F.col("event_id") % 6
    raw = F.when(n == 0, k).when(n == 1, F.concat(k, F.lit("d"))).when(n == 2, F.lit(" -1.5e3 ")) \
        .when(n == 3, F.lit("NaN")).when(n == 4, F.lit(":")).otherwise(F.concat(F.lit("."), k))
    return t.events.select("event_id", numbers.to_number(raw).alias("value")).filter("value is not null")


@query("column_fallback", """
    SELECT o_orderkey, o_custkey::VARCHAR AS geo, CAST(year(o_orderdate) AS VARCHAR) AS time FROM orders""")
def column_fallback(t):
    raw = t.orders.select("o_orderkey", F.col("o_custkey").alias("ref_area"), F.col("o_orderstatus").alias("other"),
                          F.year("o_orderdate").alias("anno"))
    geo, time = first_present(raw, GEO_COLUMNS["labour"]), first_present(raw, TIME_COLUMNS)
    return raw.select("o_orderkey", column_or_null(raw, geo).alias("geo"), column_or_null(raw, time).alias("time"))


@query("pad_codes", """
    SELECT p_partkey, CASE WHEN length(c) < 2 THEN lpad(c, 2, '0') ELSE c END AS code
    FROM (SELECT p_partkey, CAST(p_size AS VARCHAR) || CASE WHEN p_partkey % 4 = 0 THEN 'XYZ' ELSE '' END AS c FROM part)""")
def pad_codes(t):
    c = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 4 == 0, F.lit("XYZ")).otherwise(F.lit("")))
    return t.part.select("p_partkey", strings.pad_to_two(c).alias("code"))


@query("tag_indicators", """
    SELECT event_id,
      CASE event_type WHEN 'click' THEN 'neet_rate' WHEN 'view' THEN 'employment_rate' WHEN 'purchase' THEN 'n_employed'
           ELSE 'unknown_indicator' END AS indicator_code,
      CASE event_type WHEN 'click' THEN 'percentage' WHEN 'view' THEN 'percentage' WHEN 'purchase' THEN 'thousands_persons'
           ELSE 'unknown_unit' END AS unit,
      CAST(CASE WHEN event_type = 'purchase' THEN 2 WHEN event_type = 'error' THEN NULL ELSE 1 END AS BIGINT) AS priority
    FROM events""")
def tag_indicators(t):
    code = {"click": "172_931_DF_DCCV_NEET1_9", "view": "150_915_DF_DCCV_TAXOCCU1_5", "purchase": "lfsa_egan22d",
            "signup": "not_registered", "error": "not_registered"}
    provider = {"click": "istat", "view": "istat", "purchase": "eurostat", "signup": "istat", "error": "other"}
    rows = t.events.select(
        "event_id", strings.map_literal(code, F.col("event_type")).alias("dataset_code"),
        strings.map_literal(provider, F.col("event_type")).alias("provider"))
    return tagged(rows, "labour").select("event_id", "indicator_code", "unit", "priority")


NATION_CODE = """CASE WHEN n_nationkey % 5 = 0 THEN ' it' || CAST(n_nationkey AS VARCHAR)
    WHEN n_nationkey % 5 = 1 THEN CASE WHEN n_nationkey < 10 THEN 'EU27_2020 ' ELSE 'EA19' END
    WHEN n_nationkey % 5 = 2 THEN 'FR' WHEN n_nationkey % 5 = 3 THEN 'DEZZ' ELSE 'FR1' || CAST(n_nationkey AS VARCHAR) END"""


def coded_orders(t: Tables):
    """Orders with a territory code spelled from the customer's nation; some are blank."""
    code = F.when(F.col("o_orderkey") % 7 == 0, F.lit("nan")).when(F.col("o_orderkey") % 11 == 0, F.lit(" ")) \
        .otherwise(F.upper(F.expr(NATION_CODE.replace("VARCHAR", "STRING"))))
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("dataset_code"),
                F.when(F.col("o_orderstatus") == "O", "istat").otherwise("eurostat").alias("source_id"),
                code.alias("nuts_code"))
    )


CODED_SQL = f"""coded AS (
    SELECT o_orderkey, o_totalprice, o_orderpriority AS dataset_code,
           CASE WHEN o_orderstatus = 'O' THEN 'istat' ELSE 'eurostat' END AS source_id,
           CASE WHEN o_orderkey % 7 = 0 THEN 'nan' WHEN o_orderkey % 11 = 0 THEN ' ' ELSE upper({NATION_CODE}) END AS nuts_code
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
reasons AS (
    SELECT *, trim(nuts_code) AS code, CASE WHEN trim(nuts_code) IN ('', 'nan', 'None', '<NA>') THEN 'unmatched'
        WHEN regexp_matches(trim(nuts_code), '^[A-Z]{{2}}Z+$') THEN 'extra_regio'
        WHEN length(trim(nuts_code)) = 2 OR trim(nuts_code) LIKE 'IT%' THEN 'keep'
        ELSE 'foreign_subnational' END AS drop_reason FROM coded)"""


@query("drop_supranational", f"""
    WITH {CODED_SQL} SELECT o_orderkey, nuts_code FROM coded
    WHERE trim(nuts_code) NOT IN ('EU27_2020', 'EU27', 'EA', 'EA19', 'EA20')""")
def drop_supranational(t):
    return coded_orders(t).filter(~codes.is_supranational(F.col("nuts_code"))).select("o_orderkey", "nuts_code")


@query("scope_filter", f"""
    WITH {CODED_SQL} SELECT o_orderkey, nuts_code FROM coded WHERE length(nuts_code) = 2 OR nuts_code LIKE 'IT%'""")
def scope_filter(t):
    return coded_orders(t).filter(codes.in_scope(F.col("nuts_code"))).select("o_orderkey", "nuts_code")


@query("classify_kept", f"WITH {CODED_SQL} SELECT o_orderkey, code AS nuts_code FROM reasons WHERE drop_reason = 'keep'")
def classify_kept(t):
    kept, _ = classify(coded_orders(t), codes.scope_reason(F.col("nuts_code")))
    return kept.select("o_orderkey", strings.strip(F.col("nuts_code")).alias("nuts_code"))


@query("classify_report", f"""
    WITH {CODED_SQL} SELECT drop_reason, dataset_code, count(*) AS n_rows FROM reasons WHERE drop_reason <> 'keep'
    GROUP BY 1, 2""")
def classify_report(t):
    _, dropped = classify(coded_orders(t), codes.scope_reason(F.col("nuts_code")))
    return counts_by(dropped, ["drop_reason", "dataset_code"])


@query("suspicious_codes", f"""
    WITH {CODED_SQL}, s AS (SELECT dataset_code, code, count(*) AS n FROM reasons
        WHERE drop_reason = 'foreign_subnational' AND source_id = 'istat' GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY dataset_code ORDER BY code) AS rn FROM s)
    SELECT dataset_code, count(*) AS n_codes, CAST(sum(n) AS BIGINT) AS n_rows,
           string_agg(code, ', ' ORDER BY code) FILTER (rn <= 3) AS sample
    FROM r GROUP BY 1""")
def suspicious_codes(t):
    _, dropped = classify(coded_orders(t), codes.scope_reason(F.col("nuts_code")))
    rows = suspicious(dropped, "istat").withColumn("code", strings.strip(F.col("nuts_code")))
    return sample_codes(rows, ["dataset_code"], "code", 3).withColumn("sample", F.array_join("sample", ", "))


@query("code_level", """
    SELECT DISTINCT c AS code, CAST(CASE length(c) WHEN 2 THEN 0 WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 3 END AS BIGINT)
           AS nuts_level, substring(c, 1, 2) AS country_code, coalesce(regexp_matches(c, '^[A-Z]{2}Z+$'), false) AS extra_regio
    FROM (SELECT CASE WHEN p_size % 10 = 0 THEN 'ITZZ' ELSE upper(substring(p_brand, 1, 2 + p_size % 6)) END AS c FROM part)""")
def code_level(t):
    c = F.col("code")
    raw = F.expr("case when p_size % 10 = 0 then 'ITZZ' else upper(substring(p_brand, 1, 2 + p_size % 6)) end")
    return t.part.select(raw.alias("code")).distinct().select(
        c, codes.level_of(c).alias("nuts_level"), codes.country_of(c).alias("country_code"),
        codes.is_extra_regio(c).alias("extra_regio"))


PERIOD_SQL = """p AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y')
        WHEN 1 THEN strftime(o_orderdate, '%Y') || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR)
        WHEN 2 THEN 'n.d.' ELSE strftime(o_orderdate, '%Y-%m') END AS time,
      CASE WHEN o_orderkey % 2 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN 'label' END AS label FROM orders)"""


def labelled_orders(t: Tables):
    n = F.col("o_orderkey") % 5
    time = F.when(n == 0, F.date_format("o_orderdate", "yyyy")) \
        .when(n == 1, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-Q"), F.quarter("o_orderdate").cast("string"))) \
        .when(n == 2, F.lit("n.d.")).otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    label = F.when(F.col("o_orderkey") % 2 == 0, F.lit("")).when(F.col("o_orderkey") % 3 == 0, F.lit("label"))
    return t.orders.select("o_orderkey", time.alias("time"), label.alias("label"))


@query("period_parse", rf"""
    WITH {PERIOD_SQL}
    SELECT o_orderkey, coalesce(nullif(label, ''), time) AS period_label,
      CASE WHEN regexp_matches(time, '^\d{{4}}') THEN CAST(substring(time, 1, 4) AS BIGINT) END AS year,
      CASE WHEN regexp_matches(time, '^\d{{4}}-\d{{2}}$') THEN 'M' WHEN regexp_matches(time, '^\d{{4}}-Q[1-4]$') THEN 'Q'
           WHEN regexp_matches(time, '^\d{{4}}$') THEN 'A' ELSE '?' END AS frequency,
      CASE WHEN regexp_matches(time, '^\d{{4}}-\d{{2}}$')
             THEN CAST(substring(time, 1, 4) AS BIGINT) * 12 + CAST(substring(time, 6, 2) AS BIGINT) - 1
           WHEN regexp_matches(time, '^\d{{4}}-Q[1-4]$')
             THEN CAST(substring(time, 1, 4) AS BIGINT) * 4 + CAST(substring(time, 7, 1) AS BIGINT) - 1
           WHEN regexp_matches(time, '^\d{{4}}$') THEN CAST(time AS BIGINT) END AS ordinal
    FROM p""")
def period_parse(t):
    time = F.col("time")
    return labelled_orders(t).select(
        "o_orderkey", periods.period_label(F.col("label"), time).alias("period_label"),
        periods.leading_year(time).alias("year"), periods.frequency_of(time).alias("frequency"),
        periods.ordinal_of(time).alias("ordinal"))


@query("period_round_trip", rf"WITH {PERIOD_SQL} SELECT DISTINCT time FROM p WHERE time <> 'n.d.'")
def period_round_trip(t):
    time = F.col("time")
    back = periods.label_of(periods.frequency_of(time), periods.ordinal_of(time))
    return labelled_orders(t).select(back.alias("time")).filter("time is not null").distinct()


@query("periods_in_words", rf"""
    WITH {PERIOD_SQL}, names AS (SELECT ['gennaio','febbraio','marzo','aprile','maggio','giugno','luglio','agosto',
        'settembre','ottobre','novembre','dicembre'] AS m, ['I','II','III','IV'] AS q)
    SELECT DISTINCT time, CASE
        WHEN regexp_matches(time, '^\d{{4}}-\d{{2}}$')
          THEN m[CAST(substring(time, 6, 2) AS INTEGER)] || ' ' || substring(time, 1, 4)
        WHEN regexp_matches(time, '^\d{{4}}-Q[1-4]$')
          THEN q[CAST(substring(time, 7, 1) AS INTEGER)] || ' trimestre ' || substring(time, 1, 4)
        ELSE time END AS words
    FROM p, names""")
def period_words(t):
    return labelled_orders(t).select("time").distinct().withColumn("words", periods.period_it(F.col("time")))


@query("dates_in_words", """
    WITH names AS (SELECT ['gennaio','febbraio','marzo','aprile','maggio','giugno','luglio','agosto','settembre','ottobre',
        'novembre','dicembre'] AS m)
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CASE WHEN day(o_orderdate) = 1 THEN '1º'
        ELSE CAST(day(o_orderdate) AS VARCHAR) END || ' ' || m[month(o_orderdate)] || ' ' || CAST(year(o_orderdate) AS VARCHAR)
        AS words
    FROM orders, names""")
def date_words(t):
    return t.orders.select(F.to_date("o_orderdate").alias("day")).distinct() \
        .withColumn("words", periods.date_it(F.col("day")))


@query("number_formats", """
    SELECT c_custkey, replace(format('{:,}', n), ',', '.') AS plain,
      CASE WHEN d = 0 THEN 'nessuna' WHEN d > 0 THEN '+' || replace(format('{:,}', d), ',', '.')
           ELSE '−' || replace(format('{:,}', -d), ',', '.') END AS change,
      format('{:g}', c_acctbal) AS general
    FROM (SELECT c_custkey, c_acctbal, c_custkey * 1234 AS n, (c_custkey - 700) * 97 AS d FROM customer)""")
def number_formats(t):
    n, d = F.col("c_custkey") * 1234, (F.col("c_custkey") - 700) * 97
    return t.customer.select("c_custkey", numbers.thousands_it(n).alias("plain"), numbers.signed_it(d).alias("change"),
                             numbers.six_digits(F.col("c_acctbal")).alias("general"))


@query("blank_and_packed", """
    WITH c AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN ' ITC;ITH ' WHEN 2 THEN 'ITC1' END AS nuts_code,
                      CASE WHEN s_suppkey % 3 = 0 THEN 'ITF' ELSE '07' END AS istat_code FROM supplier)
    SELECT s_suppkey, coalesce(nullif(trim(nuts_code), ''), CASE WHEN istat_code LIKE 'IT%' THEN istat_code END) AS code,
           coalesce(contains(nuts_code, ';'), false) AS packed,
           CASE WHEN contains(nuts_code, ';') THEN 2 WHEN nullif(trim(nuts_code), '') IS NOT NULL THEN 1 END AS n_units
    FROM c""")
def blank_and_packed(t):
    n = F.col("s_suppkey") % 4
    rows = t.supplier.select(
        "s_suppkey", F.when(n == 0, F.lit("  ")).when(n == 1, F.lit(" ITC;ITH ")).when(n == 2, F.lit("ITC1")).alias("nuts_code"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("ITF")).otherwise(F.lit("07")).alias("istat_code"))
    own = strings.blank_to_null(F.col("nuts_code"))
    code = F.coalesce(own, F.when(F.col("istat_code").startswith("IT"), F.col("istat_code")))
    return rows.select("s_suppkey", code.alias("code"), strings.has_many(F.col("nuts_code")).alias("packed"),
                       F.when(own.isNotNull(), F.size(strings.unpack(own))).alias("n_units"))


@query("row_breakdown", """
    SELECT CASE WHEN l_returnflag = 'A' THEN 'istat' ELSE 'eurostat' END AS source_id, l_linestatus AS indicator_code,
           l_returnflag AS unit, count(*) AS n_rows FROM lineitem GROUP BY 1, 2, 3""")
def row_breakdown(t):
    return breakdown(t.lineitem.select(
        F.when(F.col("l_returnflag") == "A", "istat").otherwise("eurostat").alias("source_id"),
        F.col("l_linestatus").alias("indicator_code"), F.col("l_returnflag").alias("unit")))


@query("phrase_list", """
    WITH b AS (SELECT p_size, list_sort(list(DISTINCT p_brand)) AS xs FROM part GROUP BY 1)
    SELECT p_size, CASE WHEN len(xs) = 1 THEN xs[1]
      ELSE array_to_string(xs[1:len(xs) - 1], ', ') || ' e ' || xs[len(xs)] END AS phrase FROM b""")
def phrase_list(t):
    lists = t.part.select("p_size", "p_brand").distinct().groupBy("p_size").agg(
        F.sort_array(F.collect_list("p_brand")).alias("xs"))
    return lists.select("p_size", strings.all_but_last(F.col("xs")).alias("phrase"))


@query("filled_values", """
    SELECT p_type, count(*) AS n_rows, count(*) FILTER (v IS NOT NULL AND trim(v) <> '') AS n_filled,
           count(*) FILTER (coalesce(v = 'x', true)) AS n_x_or_absent
    FROM (SELECT p_type, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' ELSE 'x' END AS v FROM part)
    GROUP BY 1""")
def filled_values(t):
    from ..operators.scope import filled
    from ..plans.marts import total_or_absent
    n = F.col("p_size") % 4
    v = F.when(n == 1, F.lit("")).when(n == 2, F.lit(" ")).when(n == 3, F.lit("x"))
    return t.part.withColumn("v", v).groupBy("p_type").agg(
        F.count("*").alias("n_rows"), F.count_if(filled(F.col("v"))).alias("n_filled"),
        F.count_if(total_or_absent("v", "x")).alias("n_x_or_absent"))


@query("ordered_units", """
    SELECT n_name, CAST(n_regionkey AS BIGINT) AS nuts_level FROM nation WHERE n_name IN ('NATION_3', 'NATION_7', 'NATION_12')
    ORDER BY n_name""")
def ordered_units(t):
    wanted = inline(t.spark, [("NATION_3",), ("NATION_7",), ("NATION_12",)], "n_name string")
    return t.nation.join(wanted, "n_name", "left_semi").select(
        "n_name", F.col("n_regionkey").cast("bigint").alias("nuts_level")).orderBy("n_name")
