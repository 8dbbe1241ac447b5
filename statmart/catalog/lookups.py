"""Code lookups, deduplication and comparisons."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions.strings import fold, map_literal
from ..operators.dedup import collisions, keep_first, keep_last, resolve_priority, resolve_priority_located
from ..operators.diff import expected_vs_present, orphans, parity, parity_of_rows, runs
from ..operators.lookups import (ambiguous_keys, code_list, crosswalk_index, legal_forms, local_territory,
                                 standard_territory, territory, with_label)
from ..plans.warehouse import year_rows
from ..registry import GENDER, indicator_table, inline, slice_codes
from .base import Tables, query

# ---- three-pass territory lookup ----
# Crosswalk of suppliers: a numeric local code (every tenth one repeated under two targets), a target code, a name.
# Targets: ITH<k> for every supplier; a supplier of nation 4 has a packed target and can only be found locally.
XWALK_SQL = """xwalk AS (
    SELECT s_suppkey AS ord, lpad(CAST(s_suppkey % 90 AS VARCHAR), 3, '0') AS istat_code,
           CASE WHEN s_nationkey = 4 THEN 'ITH' || CAST(s_suppkey % 40 AS VARCHAR) || ';ITI' WHEN s_nationkey = 7 THEN NULL
                ELSE 'ITH' || CAST(s_suppkey % 40 AS VARCHAR) END AS nuts_code,
           CAST(s_suppkey % 4 AS VARCHAR) AS nuts_level, s_name AS nuts_name_it FROM supplier)"""
GEO_EXPR = """CASE l_linenumber WHEN 1 THEN lpad(CAST(l_suppkey % 100 AS VARCHAR), 3, '0')
    WHEN 2 THEN ' ith' || CAST(l_suppkey % 45 AS VARCHAR) || ' ' WHEN 3 THEN 'ITD' || CAST(l_suppkey % 45 AS VARCHAR)
    WHEN 4 THEN 'IT' || lpad(CAST(l_suppkey % 100 AS VARCHAR), 3, '0') WHEN 5 THEN 'ITE' || CAST(l_suppkey % 9 AS VARCHAR)
    WHEN 6 THEN 'XX9' END"""


def supplier_crosswalk(t: Tables):
    target = F.concat(F.lit("ITH"), (F.col("s_suppkey") % 40).cast("string"))
    return t.supplier.select(
        F.col("s_suppkey").alias("ord"), F.lpad((F.col("s_suppkey") % 90).cast("string"), 3, "0").alias("istat_code"),
        F.when(F.col("s_nationkey") == 4, F.concat(target, F.lit(";ITI"))).when(F.col("s_nationkey") != 7, target)
        .alias("nuts_code"),
        (F.col("s_suppkey") % 4).cast("string").alias("nuts_level"), F.col("s_name").alias("nuts_name_it"))


def coded_lines(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey",
                             F.expr(GEO_EXPR.replace("VARCHAR", "STRING")).alias("geo"))


@query("three_pass_lookup", rf"""
    WITH {XWALK_SQL},
    loc AS (SELECT upper(istat_code) AS key, arg_max(struct_pack(c := nuts_code, l := nuts_level, n := nuts_name_it), ord) AS u
            FROM xwalk GROUP BY 1),
    cod AS (SELECT upper(nuts_code) AS key, arg_min(struct_pack(c := nuts_code, l := nuts_level, n := nuts_name_it), ord) AS u
            FROM xwalk WHERE nuts_code IS NOT NULL AND NOT contains(nuts_code, ';') GROUP BY 1),
    k AS (SELECT l_orderkey, l_linenumber, geo, upper(trim(geo)) AS key,
            CASE WHEN regexp_full_match(upper(trim(geo)), 'IT[DE][0-9A-Z]{{0,2}}')
              THEN CASE substring(upper(trim(geo)), 3, 1) WHEN 'D' THEN 'ITH' ELSE 'ITI' END || substring(upper(trim(geo)), 4) END AS by_code,
            CASE WHEN regexp_full_match(upper(trim(geo)), 'IT[0-9]{{3}}') THEN substring(upper(trim(geo)), 3) END AS by_loc
          FROM (SELECT l_orderkey, l_linenumber, {GEO_EXPR} AS geo FROM lineitem)),
    j AS (SELECT k.*, CASE WHEN a.u.c IS NOT NULL THEN a.u WHEN b.u.c IS NOT NULL THEN b.u WHEN by_code IS NOT NULL THEN c.u
            ELSE d.u END AS u
          FROM k LEFT JOIN loc a ON a.key = k.key LEFT JOIN cod b ON b.key = k.key
          LEFT JOIN cod c ON c.key = k.by_code LEFT JOIN loc d ON d.key = k.by_loc)
    SELECT geo, u.c AS nuts_code, CAST(u.l AS BIGINT) AS nuts_level, u.n AS nuts_name_it, 'IT' AS country_code,
           u.c IS NULL AS geo_unmatched, count(*) AS n_rows
    FROM j GROUP BY ALL""")
def three_pass_lookup(t):
    found = local_territory(coded_lines(t), crosswalk_index(supplier_crosswalk(t)), F.col("geo"))
    return found.groupBy("geo", "nuts_code", "nuts_level", "nuts_name_it", "country_code", "geo_unmatched").agg(
        F.count("*").alias("n_rows"))


@query("standard_territory", f"""
    SELECT l_orderkey, l_linenumber, l_suppkey, upper(trim(geo)) AS nuts_code,
      CAST(CASE WHEN length(trim(geo)) BETWEEN 2 AND 5 THEN length(trim(geo)) - 2 END AS BIGINT) AS nuts_level,
      substring(upper(trim(geo)), 1, 2) AS country_code
    FROM (SELECT l_orderkey, l_linenumber, l_suppkey, {GEO_EXPR} AS geo FROM lineitem) WHERE geo IS NOT NULL""")
def standard(t):
    return standard_territory(coded_lines(t).filter("geo is not null"), F.col("geo")).drop("geo")


@query("ambiguous_keys", """
    SELECT p_brand, count(DISTINCT p_type) + max(CAST(p_type IS NULL AS INTEGER)) AS n_values
    FROM (SELECT p_brand, CASE WHEN p_size > 45 THEN NULL ELSE p_type END AS p_type FROM part) GROUP BY 1
    HAVING count(DISTINCT p_type) + max(CAST(p_type IS NULL AS INTEGER)) > 1""")
def ambiguous(t):
    rows = t.part.select("p_brand", F.when(F.col("p_size") <= 45, F.col("p_type")).alias("p_type"))
    return ambiguous_keys(rows, "p_brand", "p_type")


@query("legal_forms", """
    WITH m AS (SELECT CASE s_nationkey % 2 WHEN 0 THEN 'istat' ELSE 'runts' END AS sys, 'F' || CAST(s_suppkey % 30 AS VARCHAR) AS code,
                      s_name AS cat, CAST(s_nationkey AS VARCHAR) AS nace, s_suppkey AS ord FROM supplier),
    u AS (SELECT sys, code, arg_max(cat, ord) AS cat, arg_max(nace, ord) AS nace FROM m GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, l_suppkey, u.cat AS legal_form_unified, u.nace AS nace_primary,
           l_linestatus = 'F' AND u.cat IS NULL AS legal_form_unmatched
    FROM lineitem LEFT JOIN u ON u.sys = CASE l_returnflag WHEN 'A' THEN 'istat' WHEN 'R' THEN 'runts' ELSE 'other' END
      AND u.code = 'F' || CAST(l_suppkey % 35 AS VARCHAR) AND l_linestatus = 'F'""")
def legal_form_lookup(t):
    mapping = t.supplier.select(
        F.when(F.col("s_nationkey") % 2 == 0, "istat").otherwise("runts").alias("source_system"),
        F.concat(F.lit("f"), (F.col("s_suppkey") % 30).cast("string")).alias("source_code"),
        F.col("s_name").alias("unified_category"), F.col("s_name").alias("unified_category_en"),
        F.col("s_nationkey").cast("string").alias("nace_primary"), F.lit("ets").alias("ets_classification"),
        F.col("s_suppkey").alias("ord"))
    provider = F.when(F.col("l_returnflag") == "A", "istat").when(F.col("l_returnflag") == "R", "runts").otherwise("other")
    code = F.concat(F.lit(" f"), (F.col("l_suppkey") % 35).cast("string"))
    found = legal_forms(t.lineitem, mapping, provider, code, F.col("l_linestatus") == "F")
    return found.select("l_orderkey", "l_linenumber", "l_suppkey", "legal_form_unified", "nace_primary",
                        "legal_form_unmatched")


@query("sex_codes", """
    SELECT event_id, CASE raw WHEN '1' THEN 'male' WHEN '2' THEN 'female' WHEN '9' THEN 'total' WHEN 'MF' THEN 'total'
        WHEN 'FEMALES' THEN 'female' END AS gender
    FROM (SELECT event_id, upper(trim(CASE user_id % 6 WHEN 0 THEN '1' WHEN 1 THEN ' 2' WHEN 2 THEN '9' WHEN 3 THEN 'mf'
          WHEN 4 THEN 'females ' ELSE 'x' END)) AS raw FROM events)""")
def sex_codes(t):
    n = F.col("user_id") % 6
    raw = F.when(n == 0, "1").when(n == 1, " 2").when(n == 2, "9").when(n == 3, "mf").when(n == 4, "females ").otherwise("x")
    return t.events.select("event_id", map_literal(GENDER, fold(raw)).alias("gender"))


@query("labels_with_fallback", """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS code, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0""")
def labels_with_fallback(t):
    labels = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("code"), "c_name")
    rows = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("code"))
    return with_label(rows, labels, "code", "c_name", "name")


CODES_SQL = """codes AS (
    SELECT DISTINCT 'size' AS breakdown, CASE WHEN p_partkey % 2 = 0 THEN 'istat' ELSE 'eurostat' END AS provider,
      'S' || CAST(p_size AS VARCHAR) AS code, 'Y' || CAST(p_size AS VARCHAR) AS harmonised_code,
      p_size = 50 AS is_total, p_size AS lower_bound, p_size + 4 AS upper_bound FROM part WHERE p_size > 5)"""


def size_codes(t: Tables):
    size = F.col("p_size").cast("string")
    return t.part.filter("p_size > 5").select(
        F.lit("size").alias("breakdown"), F.when(F.col("p_partkey") % 2 == 0, "istat").otherwise("eurostat").alias("provider"),
        F.concat(F.lit("S"), size).alias("code"), F.concat(F.lit("Y"), size).alias("harmonised_code"),
        F.concat(F.lit("size "), size).alias("label"), (F.col("p_size") == 50).alias("is_total"),
        F.col("p_size").alias("lower_bound"), (F.col("p_size") + 4).alias("upper_bound")).distinct()


def sized_codes(lines):
    """Lines, or their groups, with a size code and the provider it is from."""
    code = F.when(F.col("l_quantity") <= 48, F.concat(F.lit("s"), F.col("l_quantity").cast("int").cast("string")))
    return lines.withColumns({"size": code, "provider": F.when(F.col("l_linestatus") == "O", "istat").otherwise("eurostat")})


def sized_lines(t: Tables):
    return sized_codes(t.lineitem).select("l_orderkey", "l_linenumber", "l_suppkey", "size", "provider")


@query("code_list", f"""
    WITH {CODES_SQL}, li AS (SELECT l_orderkey, l_linenumber, l_suppkey,
        CASE WHEN l_quantity <= 48 THEN 's' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS size,
        CASE WHEN l_linestatus = 'O' THEN 'istat' ELSE 'eurostat' END AS provider FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_suppkey, harmonised_code AS size_code,
           CASE WHEN size IS NULL THEN true ELSE is_total END AS size_is_total, lower_bound AS size_from,
           upper_bound AS size_to, size IS NOT NULL AND harmonised_code IS NULL AS size_unlisted
    FROM li LEFT JOIN codes ON codes.provider = li.provider AND codes.code = upper(li.size)""")
def code_list_join(t):
    return code_list(sized_lines(t), size_codes(t), "size", "size").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "size_code", "size_is_total", "size_from", "size_to", "size_unlisted")


# ---- one row per key ----
RANK = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END"
TIES = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_shipdate"


def ranked_lines(t: Tables):
    return t.lineitem.withColumn("priority", F.expr(RANK))


@query("priority_dedup", f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, {RANK} AS priority, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {RANK}, {TIES}) AS rn FROM lineitem) WHERE rn = 1""")
def priority_dedup(t):
    return resolve_priority(ranked_lines(t), ["l_orderkey", "l_linenumber"], "priority")


LOCATED_SQL = f"""
    WITH li AS (SELECT l_orderkey, l_suppkey, l_quantity, l_shipdate, {RANK} AS priority,
        CASE WHEN l_suppkey % 3 = 0 THEN '  ' WHEN l_suppkey % 10 = 1 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS geo
        FROM lineitem)
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY geo, l_quantity ORDER BY priority,
        l_shipdate DESC, l_orderkey, l_suppkey) AS rn FROM li WHERE coalesce(trim(geo), '') <> '') WHERE rn = 1
    UNION ALL SELECT * FROM li WHERE coalesce(trim(geo), '') = ''"""


def located_lines(t: Tables, *more):
    geo = F.when(F.col("l_suppkey") % 3 == 0, F.lit("  ")) \
        .when(F.col("l_suppkey") % 10 != 1, F.col("l_suppkey").cast("string"))
    return t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_shipdate", F.expr(RANK).alias("priority"), geo.alias("geo"), *more)


@query("priority_dedup_located", LOCATED_SQL)
def priority_dedup_located(t):
    return resolve_priority_located(located_lines(t), "geo", ["geo", "l_quantity"], "priority", newest="l_shipdate")


@query("priority_dedup_row_ids", LOCATED_SQL)
def priority_dedup_row_ids(t):
    """The same with the position of each row: rows without a territory are keys of their own, and the input is read once."""
    position = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("row_id")
    return resolve_priority_located(located_lines(t, position), "geo", ["geo", "l_quantity"], "priority", newest="l_shipdate", row_id="row_id")


@query("dedup_collisions", """
    WITH g AS (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT l_returnflag, count(*) AS n_groups, CAST(sum(n - 1) AS BIGINT) AS n_lost FROM g WHERE n > 1 GROUP BY 1""")
def dedup_collisions(t):
    return collisions(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_returnflag"])


@query("keep_first", """
    SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
        ORDER BY event_id) AS rn FROM events) WHERE rn = 1""")
def first_events(t):
    return keep_first(t.events.select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query("keep_last", """
    SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
        ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def last_events(t):
    return keep_last(t.events.select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


# ---- comparisons ----

@query("orphan_keys", """
    SELECT l_partkey, count(*) AS n_rows FROM lineitem WHERE NOT EXISTS
        (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10) GROUP BY 1""")
def orphan_parts(t):
    return orphans(t.lineitem, t.part.filter("p_size > 10"), "l_partkey", "p_partkey")


@query("expected_vs_present", """
    WITH e AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0), p AS (SELECT DISTINCT o_custkey AS k FROM orders),
    d AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey < 12)
    SELECT coalesce(e.k, p.k) AS code, CASE WHEN p.k IS NULL THEN 'missing' WHEN e.k IS NULL THEN 'extra' ELSE 'present' END AS status,
           d.k IS NOT NULL AS in_dimension
    FROM e FULL JOIN p ON e.k = p.k LEFT JOIN d ON d.k = coalesce(e.k, p.k)""")
def expected_present(t):
    code = F.col("c_custkey").alias("code")
    return expected_vs_present(
        t.customer.filter("c_acctbal > 0").select(code), t.orders.select(F.col("o_custkey").alias("code")), "code",
        t.customer.filter("c_nationkey < 12").select(code))


_TURNED = """turned AS (SELECT l_orderkey, l_returnflag, l_linenumber, CASE WHEN l_orderkey % 10 = 0
        THEN coalesce(lead(l_quantity) OVER w, first_value(l_quantity) OVER w) ELSE l_quantity END AS l_quantity FROM lineitem
        WINDOW w AS (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_quantity, l_extendedprice, l_partkey, l_suppkey, l_shipdate, l_discount, l_tax))"""


@query("parity_of_rows", f"""
    WITH {_TURNED}, a AS (SELECT l_orderkey, l_returnflag, count(*) AS n, list_sort(list(l_linenumber || ':' || l_quantity)) AS rows FROM lineitem GROUP BY 1, 2),
    b AS (SELECT l_orderkey, l_returnflag, count(*) AS n, list_sort(list(l_linenumber || ':' || l_quantity)) AS rows FROM turned GROUP BY 1, 2)
    SELECT a.l_orderkey, a.l_returnflag, a.n AS n_old, b.n AS n_new FROM a JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = b.l_returnflag
    WHERE a.rows <> b.rows""")
def parity_of_rows_report(t):
    """Quantities that changed places inside an order: counts and sums agree, the rows do not."""
    w = Window.partitionBy("l_orderkey", "l_returnflag").orderBy(
        "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey", "l_suppkey", "l_shipdate", "l_discount", "l_tax")
    turned = t.lineitem.withColumn("l_quantity", F.when(F.col("l_orderkey") % 10 == 0, F.coalesce(
        F.lead("l_quantity").over(w), F.first("l_quantity").over(w))).otherwise(F.col("l_quantity")))
    return parity_of_rows(t.lineitem, turned, ["l_orderkey", "l_returnflag"], ["l_linenumber", "l_quantity"])


@query("parity", f"""
    WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {RANK}, {TIES}) AS rn
        FROM lineitem) WHERE rn = 1),
    a AS (SELECT l_returnflag, year(l_shipdate) AS y, count(*) AS n, round(sum(l_quantity), 6) AS s FROM lineitem GROUP BY 1, 2),
    b AS (SELECT l_returnflag, year(l_shipdate) AS y, count(*) AS n, round(sum(l_quantity), 6) AS s FROM d
          WHERE l_returnflag <> 'N' OR l_linestatus = 'O' GROUP BY 1, 2)
    SELECT coalesce(a.l_returnflag, b.l_returnflag) AS l_returnflag, CAST(coalesce(a.y, b.y) AS INTEGER) AS year,
           a.n AS n_old, b.n AS n_new, a.s AS sum_old, b.s AS sum_new
    FROM a FULL JOIN b ON a.l_returnflag = b.l_returnflag AND a.y = b.y
    WHERE a.n IS DISTINCT FROM b.n OR a.s IS DISTINCT FROM b.s""")
def parity_report(t):
    rows = ranked_lines(t).withColumn("year", F.year("l_shipdate"))
    new = resolve_priority(ranked_lines(t), ["l_orderkey", "l_linenumber"], "priority") \
        .filter("l_returnflag <> 'N' or l_linestatus = 'O'").withColumn("year", F.year("l_shipdate"))
    return parity(rows, new, ["l_returnflag", "year"], "l_quantity")


@query("period_runs", """
    WITH d AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS BIGINT) * 12 + month(o_orderdate) - 1 AS m FROM orders),
    g AS (SELECT *, m - row_number() OVER (PARTITION BY o_custkey ORDER BY m) AS island FROM d)
    SELECT o_custkey, min(m) AS first, max(m) AS last, count(*) AS length FROM g GROUP BY o_custkey, island""")
def period_runs(t):
    months = t.orders.select("o_custkey", (F.year("o_orderdate").cast("bigint") * 12 + F.month("o_orderdate") - 1).alias("m"))
    return runs(months, ["o_custkey"], "m")


# ---- registries joined to the tables ----

@query("provider_dispatch", f"""
    WITH {XWALK_SQL}, lines AS (SELECT l_orderkey, l_linenumber, 'IT' || CAST(l_suppkey % 9 AS VARCHAR) AS geo, lpad(CAST(l_suppkey % 100 AS VARCHAR), 3, '0') AS own,
        l_returnflag FROM lineitem),
    last AS (SELECT istat_code, max_by(coalesce(nuts_code, '?'), ord) AS nuts_code, max_by(nuts_level, ord) AS nuts_level FROM xwalk GROUP BY 1)
    SELECT 'eurostat' AS provider, l_orderkey, l_linenumber, geo AS nuts_code, CAST(length(geo) - 2 AS BIGINT) AS nuts_level FROM lines WHERE l_returnflag = 'A'
    UNION ALL SELECT 'istat', l_orderkey, l_linenumber, CASE WHEN last.nuts_code <> '?' THEN last.nuts_code END,
        CASE WHEN last.nuts_code <> '?' THEN CAST(last.nuts_level AS BIGINT) END
    FROM lines LEFT JOIN last ON own = istat_code WHERE l_returnflag IS DISTINCT FROM 'A'""")
def provider_dispatch(t):
    """Each provider's territory rule, chosen by its name."""
    common = t.lineitem.filter("l_returnflag = 'A'").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("IT"), (F.col("l_suppkey") % 9).cast("string")).alias("geo"))
    own = t.lineitem.filter("l_returnflag is null or l_returnflag <> 'A'").select(
        "l_orderkey", "l_linenumber", F.lpad((F.col("l_suppkey") % 100).cast("string"), 3, "0").alias("geo"))
    index = crosswalk_index(supplier_crosswalk(t))
    out = [territory(df, p, F.col("geo"), index).select(F.lit(p).alias("provider"), "l_orderkey", "l_linenumber", "nuts_code", "nuts_level")
           for p, df in (("eurostat", common), ("istat", own))]
    return out[0].unionByName(out[1])


@query("year_dimension", """
    SELECT y AS year, 'A' AS period_type, CAST(y AS VARCHAR) AS period_label, CAST(y AS VARCHAR) AS reference_period, count(o_orderkey) AS n_orders
    FROM generate_series(1990, 2030) g(y) LEFT JOIN orders ON year(o_orderdate) = y GROUP BY 1""")
def year_dimension(t):
    """The generated year dimension with the orders of each year."""
    used = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(F.count("*").alias("n_orders"))
    return year_rows(t.spark).join(used, "year", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


_ACTIVITY = "['D35', 'E38', 'L68', 'M72', 'R90', 'T97', 'A02', 'TOTAL', 'C33', 'X00']"


@query("activity_slices", f"""
    SELECT CASE left(code, 1) WHEN 'D' THEN 'D_E' WHEN 'E' THEN 'D_E' WHEN 'L' THEN 'L_M_N' WHEN 'M' THEN 'L_M_N' WHEN 'R' THEN 'R_S_T_U'
        WHEN 'T' THEN CASE code WHEN 'TOTAL' THEN 'TOTAL' ELSE 'R_S_T_U' END WHEN 'A' THEN 'A' WHEN 'C' THEN 'C' END AS slice, code, count(*) AS n_parts
    FROM (SELECT {_ACTIVITY}[p_size % 10 + 1] AS code FROM part) GROUP BY 1, 2""")
def activity_slices(t):
    """In which slice each activity code is delivered."""
    table = inline(t.spark, [(s, c) for s, codes in slice_codes().items() for c in codes], "slice string, code string")
    code = F.get(F.expr(f"array({_ACTIVITY[1:-1]})"), (F.col("p_size") % 10).cast("int"))
    return t.part.groupBy(code.alias("code")).agg(F.count("*").alias("n_parts")).join(table, "code", "left")


@query("indicator_use", """
    SELECT i.code AS indicator_code, i.label AS label_en, i.unit AS unit_default, i.domain, count(p_partkey) AS n_parts
    FROM (VALUES ('n_employed', 'Employed persons', 'thousands_persons', 'social_economy', 0), ('labour_force', 'Labour force', 'thousands_persons', 'labour', 1),
        ('neet_rate', 'NEET rate', 'percentage', 'labour', 2)) i(code, label, unit, domain, k) JOIN part ON p_size % 4 = k GROUP BY ALL""")
def indicator_use(t):
    """The registered indicators that rows name; rows with a code that is not registered fall out."""
    code = F.get(F.array(*[F.lit(c) for c in ("n_employed", "labour_force", "neet_rate", "not_registered")]), (F.col("p_size") % 4).cast("int"))
    used = t.part.groupBy(code.alias("indicator_code")).agg(F.count("*").alias("n_parts"))
    return used.join(indicator_table(t.spark), "indicator_code").select("indicator_code", "label_en", "unit_default", "domain", "n_parts")
