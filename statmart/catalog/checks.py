"""Data-quality checks over the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.groupings import grouped_once
from ..operators.lookups import code_list
from ..plans import quality as q
from ..session import checkpointed
from .base import Tables, query
from .lookups import CODES_SQL, size_codes, sized_codes, sized_lines

NOW = datetime(2024, 3, 1, 12, 0, 0)
NOW_SQL = "TIMESTAMP '2024-03-01 12:00:00'"


def num(x: str) -> str:
    return f"format('{{:,}}', {x})"


def labelled(df, table: str, check: str):
    name = F.col("check") if "check" in df.columns else F.lit(check)
    return df.select(F.lit(table).alias("table"), name.alias("check"), "status", "observed", "expected", "detail")


# ---- scan: row count, nulls, populated ----
SCAN_SQL = f"""scan AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey IS NULL) AS k,
        count(*) FILTER (priority IS NULL AND NOT coalesce(o_orderstatus = 'P', false)) AS p,
        count(*) FILTER (note IS NOT NULL AND note <> '') AS some_note, count(*) FILTER (day IS NOT NULL) AS some_day
      FROM (SELECT *, CASE WHEN o_orderkey % 9 > 0 THEN o_orderpriority END AS priority, '' AS note, o_orderdate AS day FROM orders)),
    dq_scan AS (
    SELECT 'orders' AS "table", 'row count' AS "check", CASE WHEN n < 1000 THEN 'FAIL' ELSE 'PASS' END AS status,
           {num('n')} AS observed, '>= 1,000' AS expected, '' AS detail FROM scan
    UNION ALL
    SELECT 'orders', 'nulls in required columns', 'FAIL', {num('k + p')}, '0',
           CASE WHEN k > 0 THEN 'o_orderkey: ' || {num('k')} || ' nulls; ' ELSE '' END ||
           CASE WHEN p > 0 THEN 'priority: ' || {num('p')} || ' nulls; ' ELSE '' END || 'region_key: column missing from table' FROM scan
    UNION ALL
    SELECT 'orders', 'optional columns populated', 'FAIL',
           CAST((some_note > 0)::INT + (some_day > 0)::INT AS VARCHAR) || '/2', '2/2',
           'note: ' || {num('some_note')} || ' rows; day: ' || {num('some_day')} || ' rows' FROM scan)"""


def dq_scan_frame(t: Tables):
    orders = t.orders.withColumns({
        "priority": F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderpriority")), "note": F.lit(""),
        "day": F.col("o_orderdate")})
    return labelled(q.scan_checks(orders, 1000, ["o_orderkey", "priority", "region_key"],
                                  {"priority": "o_orderstatus = 'P'"}, ["note", "day"]), "orders", "")


@query("dq_scan", f"WITH {SCAN_SQL} SELECT * FROM dq_scan")
def dq_scan(t):
    return dq_scan_frame(t)


# ---- uniqueness ----
def dup_cte(name: str, table: str, cols: str, by: str) -> str:
    return f"""{name}_g AS (SELECT {cols}, count(*) AS n FROM {table} GROUP BY {cols} HAVING count(*) > 1),
    {name}_s AS (SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess FROM {name}_g),
    {name}_t AS (SELECT string_agg(k || ' (+' || {num('e')} || ')', ', ' ORDER BY e DESC, k) AS top FROM (
        SELECT coalesce(CAST({by} AS VARCHAR), 'NULL') AS k, CAST(sum(n - 1) AS BIGINT) AS e FROM {name}_g GROUP BY 1
        ORDER BY e DESC, k LIMIT 5))"""


KEYS_SQL = f"""{dup_cte('ka', 'lineitem', 'l_orderkey', 'l_orderkey')}, {dup_cte('kb', 'lineitem', 'l_orderkey, l_linenumber', 'l_orderkey')},
    dq_keys AS (SELECT 'lineitem' AS "table", 'key uniqueness' AS "check",
        CASE WHEN a.groups + b.groups > 0 THEN 'FAIL' ELSE 'PASS' END AS status, {num('a.excess + b.excess')} AS observed, '0' AS expected,
        concat_ws('; ', CASE WHEN a.groups > 0 THEN 'l_orderkey: ' || {num('a.groups')} || ' values duplicated (' || {num('a.excess')}
            || ' excess rows), top: ' || ta.top END,
          CASE WHEN b.groups > 0 THEN 'l_orderkey+l_linenumber: ' || {num('b.groups')} || ' values duplicated (' || {num('b.excess')}
            || ' excess rows), top: ' || tb.top END) AS detail
      FROM ka_s a, kb_s b, ka_t ta, kb_t tb)"""


def dq_keys_frame(t: Tables):
    return labelled(q.key_uniqueness(t.lineitem, "l_orderkey", ["l_orderkey", "l_linenumber"]), "lineitem", "key uniqueness")


@query("dq_key_uniqueness", f"WITH {KEYS_SQL} SELECT * FROM dq_keys")
def dq_key_uniqueness(t):
    return dq_keys_frame(t)


GRAIN_SQL = f"""{dup_cte('gr', '(SELECT user_id, event_type, hour(ts) AS hour FROM events)', 'user_id, event_type, hour', 'event_type')},
    dq_grain AS (SELECT 'events' AS "table", 'duplicate rows at grain' AS "check", CASE WHEN groups > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
        {num('excess')} AS observed, '0' AS expected, CASE WHEN groups > 0 THEN {num('groups')} ||
        ' dimension combinations occur more than once. Excess rows by event_type: ' || top ELSE '' END AS detail FROM gr_s, gr_t)"""


def dq_grain_frame(t: Tables):
    rows = t.events.select("event_id", "user_id", "event_type", F.hour("ts").alias("hour"), "value")
    return labelled(q.grain(rows, ["event_id", "value"], "event_type"), "events", "duplicate rows at grain")


@query("dq_grain", f"WITH {GRAIN_SQL} SELECT * FROM dq_grain")
def dq_grain(t):
    return dq_grain_frame(t)


# ---- orphans ----
def orphan_cte(name: str, fk: str, dim: str, cond: str, label: str) -> str:
    return f"""{name}_k AS (SELECT {fk} AS k, count(*) AS n FROM lineitem WHERE {fk} IS NOT NULL AND {fk} NOT IN
        (SELECT {cond}) GROUP BY 1),
    {name}_d AS (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS r, count(*) AS ks,
        (SELECT string_agg(CAST(k AS VARCHAR), ', ' ORDER BY n DESC, k) FROM (SELECT * FROM {name}_k ORDER BY n DESC, k LIMIT 5)) AS ex
        FROM {name}_k),
    {name} AS (SELECT r, CASE WHEN r > 0 THEN '{fk} -> {label}: ' || {num('r')} || ' rows, ' || {num('ks')}
        || ' unknown keys (e.g. ' || ex || ')' END AS d FROM {name}_d)"""


ORPHAN_SQL = f"""{orphan_cte('oa', 'l_partkey', 'part', 'p_partkey FROM part WHERE p_size <> 13', 'part')},
    {orphan_cte('ob', 'l_suppkey', 'supplier', 's_suppkey FROM supplier WHERE s_nationkey <> 5', 'supplier')},
    dq_orphans AS (SELECT 'lineitem' AS "table", 'orphan foreign keys' AS "check", CASE WHEN oa.r + ob.r > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
        {num('oa.r + ob.r')} AS observed, '0' AS expected, concat_ws('; ', oa.d, ob.d) AS detail FROM oa, ob)"""


def dq_orphans_frame(t: Tables):
    return labelled(q.orphan_keys(t.lineitem, {
        "l_partkey": ("part", t.part.filter("p_size <> 13"), "p_partkey"),
        "l_suppkey": ("supplier", t.supplier.filter("s_nationkey <> 5"), "s_suppkey"),
    }), "lineitem", "orphan foreign keys")


@query("dq_orphans", f"WITH {ORPHAN_SQL} SELECT * FROM dq_orphans")
def dq_orphans(t):
    return dq_orphans_frame(t)


# ---- bounds ----
BOUNDS = {"*": (0, None), "ECONOMY": (5, 45), "PROMO": (None, 40)}
VIOLATION_SQL = """viol AS (SELECT p_type AS code, count(*) AS n_out, min(l_quantity) AS min_out, max(l_quantity) AS max_out
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE CASE p_type WHEN 'ECONOMY' THEN l_quantity < 5 OR l_quantity > 45 WHEN 'PROMO' THEN l_quantity > 40 ELSE l_quantity < 0 END
    GROUP BY 1)"""
BOUNDS_SQL = f"""{VIOLATION_SQL},
    dq_bounds AS (SELECT 'lineitem' AS "table", 'values within bounds' AS "check", CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
        {num('CAST(coalesce(sum(n_out), 0) AS BIGINT)')} AS observed, '0' AS expected,
        coalesce(string_agg(code || ': ' || {num('n_out')} || ' rows outside ' || CASE code WHEN 'ECONOMY' THEN '[5, 45]'
            WHEN 'PROMO' THEN '<= 40' ELSE '>= 0' END || ' (observed ' || format('{{:g}}', min_out) || ' to ' || format('{{:g}}', max_out) || ')',
            '; ' ORDER BY n_out DESC, code), '') AS detail FROM viol)"""


def typed_lines(t: Tables):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_type", "l_quantity")


@query("dq_violations", f"WITH {VIOLATION_SQL} SELECT * FROM viol")
def dq_violations(t):
    return q.violations(typed_lines(t), "p_type", "l_quantity", BOUNDS)


def dq_bounds_frame(t: Tables):
    return labelled(q.values_within_bounds(dq_violations(t), BOUNDS), "lineitem", "values within bounds")


@query("dq_bounds", f"WITH {BOUNDS_SQL} SELECT * FROM dq_bounds")
def dq_bounds(t):
    return dq_bounds_frame(t)


# ---- coverage ----
PROVIDER_SQL = f"""pr AS (SELECT count(*) FILTER (lower(p_type) = 'economy' OR contains(lower(p_brand), 'economy')) AS a,
        count(*) FILTER (lower(p_type) = 'brand#2' OR contains(lower(p_brand), 'brand#2')) AS b, CAST(0 AS BIGINT) AS c
      FROM lineitem JOIN part ON l_partkey = p_partkey),
    dq_providers AS (SELECT 'lineitem' AS "table", 'providers present' AS "check", 'FAIL' AS status,
        CAST((a > 0)::INT + (b > 0)::INT AS VARCHAR) || '/3' AS observed, '3/3' AS expected,
        'no rows from ' || concat_ws(', ', CASE WHEN a = 0 THEN 'economy' END, CASE WHEN b = 0 THEN 'brand#2' END, 'nobody') || ' (economy: ' ||
        {num('a')} || ' rows, brand#2: ' || {num('b')} || ' rows, nobody: 0 rows)' AS detail FROM pr)"""


def dq_providers_frame(t: Tables):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_type", "p_brand")
    return labelled(q.providers_present(rows, ["economy", "brand#2", "nobody"], "p_type", "p_brand"), "lineitem",
                    "providers present")


@query("dq_providers", f"WITH {PROVIDER_SQL} SELECT * FROM dq_providers")
def dq_providers(t):
    return dq_providers_frame(t)


def unit_geography(t: Tables):
    """Customers as territories: level from the nation, country from the region."""
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("c_name").alias("nuts_code"), (F.col("n_nationkey") % 4).cast("bigint").alias("nuts_level"),
        F.when(F.col("n_regionkey") == 0, "IT").when(F.col("n_regionkey") < 4, F.concat(F.lit("C"), F.col("n_nationkey").cast("string")))
        .alias("country_code"))


UNIT_SQL = f"""units AS (SELECT c_custkey, c_name AS nuts_code, CAST(n_nationkey % 4 AS BIGINT) AS nuts_level,
        CASE WHEN n_regionkey = 0 THEN 'IT' WHEN n_regionkey < 4 THEN 'C' || CAST(n_nationkey AS VARCHAR) END AS country_code
      FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey IN (SELECT o_custkey FROM orders)),
    lv AS (SELECT count(DISTINCT nuts_code) FILTER (nuts_level = 0) AS a, count(DISTINCT nuts_code) FILTER (nuts_level = 2) AS b,
        count(DISTINCT nuts_code) FILTER (nuts_level = 3) AS c FROM units WHERE country_code = 'IT'),
    dq_units AS (SELECT 'orders' AS "table", 'home units by level' AS "check", CASE WHEN a < 1 OR b < 21 OR c < 100000 THEN 'FAIL' ELSE 'PASS' END AS status,
        concat_ws('/', a, b, c) AS observed, '>= 1/21/100000' AS expected,
        CASE WHEN a < 1 OR b < 21 OR c < 100000 THEN 'short at ' || concat_ws('; ', CASE WHEN a < 1 THEN 'NUTS0: ' || a || ' of 1' END,
            CASE WHEN b < 21 THEN 'NUTS2: ' || b || ' of 21' END, CASE WHEN c < 100000 THEN 'NUTS3: ' || c || ' of 100000' END)
        ELSE '' END AS detail FROM lv),
    ct AS (SELECT count(DISTINCT country_code) AS n FROM units WHERE nuts_level = 0 AND country_code <> 'IT'),
    dq_countries AS (SELECT 'orders' AS "table", 'other countries at level 0' AS "check", CASE WHEN n < 30 THEN 'FAIL' ELSE 'PASS' END AS status,
        CAST(n AS VARCHAR) AS observed, '>= 30' AS expected, '' AS detail FROM ct)"""


def ordering_customers(t: Tables):
    return t.orders.select(F.col("o_custkey").alias("c_custkey"))


def dq_units_frame(t: Tables):
    units = q.used_units(ordering_customers(t), unit_geography(t), "c_custkey")
    return labelled(q.units_by_level(units, {0: 1, 2: 21, 3: 100000}), "orders", "home units by level")


def dq_countries_frame(t: Tables):
    units = q.used_units(ordering_customers(t), unit_geography(t), "c_custkey", home=None)
    return labelled(q.other_countries(units, 30, "IT"), "orders", "other countries at level 0")


@query("dq_units", f"WITH {UNIT_SQL} SELECT * FROM dq_units")
def dq_units(t):
    return dq_units_frame(t)


@query("dq_countries", f"WITH {UNIT_SQL} SELECT * FROM dq_countries")
def dq_countries(t):
    return dq_countries_frame(t)


INDICATOR_SQL = """ind AS (SELECT DISTINCT p_type FROM lineitem JOIN part ON l_partkey = p_partkey),
    ex AS (SELECT * FROM (VALUES (0, 'PROMO'), (1, 'SMALL'), (2, 'COPPER'), (3, 'STEEL')) v(i, code)),
    miss AS (SELECT coalesce(string_agg(code || CASE WHEN code NOT IN (SELECT p_type FROM part) THEN ' [not in dimension]' ELSE '' END,
        ', ' ORDER BY i), '') AS m, count(*) AS n FROM ex WHERE code NOT IN (SELECT p_type FROM ind)),
    extra AS (SELECT coalesce(string_agg(p_type, ', ' ORDER BY p_type), '') AS x FROM ind WHERE p_type NOT IN (SELECT code FROM ex)),
    dq_indicators AS (SELECT 'lineitem' AS "table", 'indicator coverage' AS "check", CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
        CAST(4 - n AS VARCHAR) || '/4' AS observed, '4/4' AS expected,
        concat_ws('; ', CASE WHEN m <> '' THEN 'missing: ' || m END, CASE WHEN x <> '' THEN 'present but not in expected list: ' || x END) AS detail
      FROM miss, extra)"""


def dq_indicators_frame(t: Tables):
    return labelled(q.expected_codes(typed_lines(t), "p_type", ["PROMO", "SMALL", "COPPER", "STEEL"],
                                     t.part.select("p_type")), "lineitem", "indicator coverage")


@query("dq_indicators", f"WITH {INDICATOR_SQL} SELECT * FROM dq_indicators")
def dq_indicators(t):
    return dq_indicators_frame(t)


FREQUENCY_SQL = rf"""fr AS (SELECT CASE event_type WHEN 'click' THEN 'M' WHEN 'view' THEN 'Q' WHEN 'error' THEN '' WHEN 'signup' THEN NULL ELSE 'M' END AS f,
        CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN '2024-1' ELSE strftime(ts, '%Y-%m') END AS l FROM events),
    fc AS (SELECT f, count(*) AS n, count(*) FILTER (f = 'M' AND (l IS NULL OR NOT regexp_matches(l, '^\d{{4}}-\d{{2}}$'))) AS bad FROM fr GROUP BY 1),
    dq_frequencies AS (SELECT 'events' AS "table", 'frequencies and period labels' AS "check", 'FAIL' AS status,
        'Q, M' AS observed, 'A, Q, M' AS expected, 'missing: A; ' || {num('CAST(sum(bad) AS BIGINT)')} ||
        ' monthly rows with period_label not in YYYY-MM format; rows by frequency: ' || string_agg(CASE WHEN coalesce(f, '') = '' THEN '(blank)' ELSE f END
        || ': ' || {num('n')}, ', ' ORDER BY coalesce(f, 'None')) AS detail FROM fc)"""


def frequency_columns() -> dict[str, Column]:
    kind, n = F.col("event_type"), F.col("user_id") % 10
    return {"frequency": F.when(kind == "click", "M").when(kind == "view", "Q").when(kind == "error", "").when(kind == "purchase", "M"),
            "period_label": F.when(n == 1, "2024-1").when(n > 1, F.date_format("ts", "yyyy-MM"))}


def dq_frequencies_frame(t: Tables):
    rows = t.events.withColumns(frequency_columns())
    return labelled(q.frequencies(rows, ["A", "Q", "M"]), "events", "frequencies and period labels")


@query("dq_frequencies", f"WITH {FREQUENCY_SQL} SELECT * FROM dq_frequencies")
def dq_frequencies(t):
    return dq_frequencies_frame(t)


DATASET_SQL = f"""ds AS (SELECT event_type AS c, date_sub('day', max(seen), {NOW_SQL}) AS age FROM (SELECT event_type,
        CASE event_type WHEN 'click' THEN ts - INTERVAL 40 DAY WHEN 'error' THEN NULL ELSE ts END AS seen FROM events) GROUP BY 1),
    dq_datasets AS (SELECT 'events' AS "table", 'datasets present and fresh' AS "check", 'WARN' AS status, {num('count(*)')} AS observed,
        '3 present, <= 45d old' AS expected, 'missing: refund, chargeback; older than 45 days: ' ||
        string_agg(c || ' (' || CASE WHEN age IS NULL THEN 'no timestamp' ELSE age || ' days' END || ')', ', ' ORDER BY c)
          FILTER (age IS NULL OR age > 45) AS detail FROM ds)"""


def extraction_time() -> Column:
    kind, ts = F.col("event_type"), F.col("ts")
    return F.when(kind == "click", ts - F.expr("interval 40 days")).when(kind != "error", ts)


def event_facts(t: Tables) -> DataFrame:
    """What the checks of events look at, in one frame."""
    rows = t.events.withColumns(frequency_columns())
    return rows.select("user_id", "event_type", F.hour("ts").alias("hour"), "frequency", F.col("event_type").alias("dataset_code"),
                       q.bad_month_label("frequency", "period_label").cast("bigint").alias("bad"), extraction_time().alias("at"))


def dq_datasets_frame(t: Tables):
    rows = t.events.select(F.col("event_type").alias("dataset_code"), extraction_time().alias("extracted_at"))
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    return labelled(q.datasets_fresh(rows, ["view", "refund", "chargeback"], now), "events", "datasets present and fresh")


@query("dq_datasets", f"WITH {DATASET_SQL} SELECT * FROM dq_datasets")
def dq_datasets(t):
    return dq_datasets_frame(t)


@query("freshness", f"""
    SELECT event_type, date_sub('day', max(ts), {NOW_SQL}) AS age_days, date_sub('day', max(ts), {NOW_SQL}) > 45 AS stale
    FROM events GROUP BY 1""")
def freshness(t):
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.timestamp_diff("DAY", F.max("ts"), now)
    return t.events.groupBy("event_type").agg(age.alias("age_days"), (age > 45).alias("stale"))


VIEWS_SQL = """dq_views AS (SELECT 'marts' AS "table", 'views return rows' AS "check", 'FAIL' AS status,
        CAST((SELECT count(*) FROM (SELECT 1 FROM orders WHERE o_totalprice > 100 LIMIT 1)) AS VARCHAR) || '/3' AS observed, '3/3' AS expected,
        'negative: returns 0 rows; planned: missing' AS detail)"""


def dq_views_frame(t: Tables):
    return labelled(q.views_return_rows({
        "large": t.orders.filter("o_totalprice > 100"), "negative": t.orders.filter("o_totalprice < 0"), "planned": None,
    }), "marts", "views return rows")


@query("dq_views", f"WITH {VIEWS_SQL} SELECT * FROM dq_views")
def dq_views(t):
    return dq_views_frame(t)


UNMANAGED_SQL = f"""st AS (SELECT c_name FROM customer WHERE c_nationkey = 3 AND c_mktsegment NOT IN ('BUILDING', 'FURNITURE')),
    dq_unmanaged AS (SELECT 'customer' AS "table", 'auto-inserted home codes' AS "check", CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
        {num('count(*)')} AS observed, '0' AS expected, CASE WHEN count(*) = 0 THEN '' ELSE 'not in reference list, auto-inserted without names: ' ||
        (SELECT string_agg(c_name, ', ' ORDER BY c_name) FROM (SELECT c_name FROM st ORDER BY c_name LIMIT 15)) ||
        CASE WHEN count(*) > 15 THEN ' and ' || (count(*) - 15) || ' more' ELSE '' END END AS detail FROM st)"""


def dq_unmanaged_frame(t: Tables):
    rows = t.customer.withColumn("country_code", F.col("c_nationkey").cast("string"))
    return labelled(q.unmanaged_codes(rows, "3", ["BUILDING", "FURNITURE"], "c_name", "c_mktsegment"), "customer",
                    "auto-inserted home codes")


@query("dq_unmanaged", f"WITH {UNMANAGED_SQL} SELECT * FROM dq_unmanaged")
def dq_unmanaged(t):
    return dq_unmanaged_frame(t)


LISTED_SQL = f"""{CODES_SQL}, cl AS (SELECT size, count(*) AS n FROM (SELECT
        CASE WHEN l_quantity <= 48 THEN 's' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS size,
        CASE WHEN l_linestatus = 'O' THEN 'istat' ELSE 'eurostat' END AS provider FROM lineitem) li
        WHERE size IS NOT NULL AND NOT EXISTS (SELECT 1 FROM codes WHERE codes.provider = li.provider AND codes.code = upper(li.size)) GROUP BY 1),
    dq_code_list AS (SELECT 'lineitem' AS "table", 'codes listed' AS "check", CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
        {num('CAST(coalesce(sum(n), 0) AS BIGINT)')} AS observed, '0' AS expected, coalesce((SELECT string_agg(size || ' (+' || {num('n')} || ')', ', ' ORDER BY n DESC, size)
        FROM (SELECT * FROM cl ORDER BY n DESC, size LIMIT 5)), '') AS detail FROM cl)"""


def dq_code_list_frame(t: Tables):
    return labelled(q.code_list_complete(code_list(sized_lines(t), size_codes(t), "size", "size"), "size"), "lineitem",
                    "codes listed")


@query("dq_code_list", f"WITH {LISTED_SQL} SELECT * FROM dq_code_list")
def dq_code_list(t):
    return dq_code_list_frame(t)


ACCEPTED_SQL = f"""av AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1),
    dq_accepted AS (SELECT 'orders' AS "table", 'accepted values' AS "check", CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
        {num('CAST(coalesce(sum(n), 0) AS BIGINT)')} AS observed, '0' AS expected,
        coalesce(string_agg(v || ' (+' || {num('n')} || ')', ', ' ORDER BY n DESC, v), '') AS detail FROM av)"""


def dq_accepted_frame(t: Tables):
    return labelled(q.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]), "orders",
                    "accepted values")


@query("dq_accepted_values", f"WITH {ACCEPTED_SQL} SELECT * FROM dq_accepted")
def dq_accepted(t):
    return dq_accepted_frame(t)


# ---- report over all checks ----
REPORT_SQL = ", ".join([SCAN_SQL, KEYS_SQL, GRAIN_SQL, ORPHAN_SQL, BOUNDS_SQL, PROVIDER_SQL, UNIT_SQL, INDICATOR_SQL, FREQUENCY_SQL,
                        DATASET_SQL, VIEWS_SQL, UNMANAGED_SQL, LISTED_SQL, ACCEPTED_SQL])
ALL_CHECKS = " UNION ALL ".join(f"SELECT * FROM {n}" for n in [
    "dq_scan", "dq_keys", "dq_grain", "dq_orphans", "dq_bounds", "dq_providers", "dq_units", "dq_countries", "dq_indicators",
    "dq_frequencies", "dq_datasets", "dq_views", "dq_unmanaged", "dq_code_list", "dq_accepted"]) \
    + """ UNION ALL SELECT 'orders', 'broken check', 'ERROR', '-', '', 'ValueError: no such rule'"""


def broken_rule() -> DataFrame:
    raise ValueError("no such rule")


def suite(t: Tables) -> list[q.Check]:
    """All checks, and one that cannot be evaluated: it must not stop the others.

    The checks of a table share what one scan of it has counted, as those of a domain do: line items and events are read
    once, orders once for the row checks and once for the rest.
    """
    n = F.col("n_rows")
    lines = grouped_once(t.lineitem, {
        "order": ["l_orderkey"], "line": ["l_orderkey", "l_linenumber"], "part": ["l_partkey"], "supplier": ["l_suppkey"],
        "size": ["l_quantity", "l_linestatus"], "quantity": ["l_partkey", "l_quantity"]}, repeated=("order", "line"))
    typed = checkpointed(lines["quantity"].join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type", "p_brand", "l_quantity").agg(
        F.sum("n_rows").alias("n_rows")))
    sized = sized_codes(lines["size"])
    ordered = grouped_once(t.orders, {"customer": ["o_custkey"], "priority": ["o_orderpriority"]})
    events = grouped_once(event_facts(t), {"grain": ["user_id", "event_type", "hour"], "frequency": ["frequency"], "dataset": ["dataset_code"]}, {
        "n_bad": F.sum("bad"), "extracted_at": F.max("at")}, repeated=("grain",))
    units = checkpointed(q.used_units(ordered["customer"].withColumnRenamed("o_custkey", "c_custkey"), unit_geography(t), "c_custkey", home=None))
    keys = [["l_orderkey"], ["l_orderkey", "l_linenumber"]]
    known = {"l_partkey": ("part", t.part.filter("p_size <> 13"), "p_partkey"),
             "l_suppkey": ("supplier", t.supplier.filter("s_nationkey <> 5"), "s_suppkey")}
    at = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    violating = checkpointed(q.violations(typed, "p_type", "l_quantity", BOUNDS, n))
    expected = ["PROMO", "SMALL", "COPPER", "STEEL"]
    return [
        q.Check("orders", "table scan", lambda: dq_scan_frame(t)),
        q.Check("lineitem", "key uniqueness", lambda: q.unique_outcome(list(zip(keys, (lines["order"], lines["line"]))))),
        q.Check("events", "duplicate rows at grain", lambda: q.grain_outcome(events["grain"], "event_type")),
        q.Check("lineitem", "orphan foreign keys", lambda: q.orphan_keys(
            t.lineitem, known, {"l_partkey": lines["part"], "l_suppkey": lines["supplier"]})),
        q.Check("lineitem", "values within bounds", lambda: q.values_within_bounds(violating, BOUNDS), lambda: q.bounds_details(violating)),
        q.Check("lineitem", "providers present", lambda: q.providers_present(
            typed, ["economy", "brand#2", "nobody"], "p_type", "p_brand", n)),
        q.Check("orders", "home units by level", lambda: q.units_by_level(
            units.filter("country_code = 'IT'"), {0: 1, 2: 21, 3: 100000})),
        q.Check("orders", "other countries at level 0", lambda: q.other_countries(units, 30, "IT")),
        q.Check("lineitem", "indicator coverage", lambda: q.expected_codes(typed, "p_type", expected, t.part.select("p_type")),
                lambda: q.extra_code_details(typed, "p_type", expected, n)),
        q.Check("events", "frequencies and period labels", lambda: q.frequencies(
            events["frequency"], ["A", "Q", "M"], weight=n, bad=F.col("n_bad")), lambda: q.frequency_details(events["frequency"], weight=n)),
        q.Check("events", "datasets present and fresh", lambda: q.datasets_fresh(
            events["dataset"], ["view", "refund", "chargeback"], at), lambda: q.stale_details(events["dataset"], at)),
        q.Check("marts", "views return rows", lambda: dq_views_frame(t)),
        q.Check("customer", "auto-inserted home codes", lambda: dq_unmanaged_frame(t)),
        q.Check("lineitem", "codes listed", lambda: q.code_list_complete(code_list(sized, size_codes(t), "size", "size"), "size", n)),
        q.Check("orders", "accepted values", lambda: q.accepted_values(
            ordered["priority"], "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"], n)),
        q.Check("orders", "broken check", broken_rule),
    ]


@query("dq_details", f"""
    WITH {VIOLATION_SQL}, {FREQUENCY_SQL}, {INDICATOR_SQL}, ds AS (SELECT event_type AS c, date_sub('day', max(seen), {NOW_SQL}) AS age
        FROM (SELECT event_type, CASE event_type WHEN 'click' THEN ts - INTERVAL 40 DAY WHEN 'error' THEN NULL ELSE ts END AS seen FROM events) GROUP BY 1)
    SELECT 'lineitem' AS "table", 'values within bounds' AS "check", code, n_out AS n_rows,
        'observed ' || format('{{:g}}', min_out) || ' to ' || format('{{:g}}', max_out) AS note FROM viol
    UNION ALL SELECT 'lineitem', 'indicator coverage', p_type, count(*), 'not in expected list' FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE p_type NOT IN (SELECT code FROM ex) GROUP BY 3
    UNION ALL SELECT 'events', 'frequencies and period labels', f, n, 'rows by frequency' FROM fc
    UNION ALL SELECT 'events', 'datasets present and fresh', c, age, 'days since extraction' FROM ds WHERE age IS NULL OR age > 45""")
def dq_details(t):
    return q.check_details(t.spark, suite(t))


@query("dq_report", f"WITH {REPORT_SQL} {ALL_CHECKS}")
def dq_report(t):
    return q.problems_first(q.run_checks(t.spark, suite(t)))


@query("dq_tally", f"""
    WITH {REPORT_SQL}, r AS ({ALL_CHECKS})
    SELECT count(*) FILTER (status = 'PASS') AS n_pass, count(*) FILTER (status = 'WARN') AS n_warn,
        count(*) FILTER (status = 'FAIL') AS n_fail, count(*) FILTER (status = 'ERROR') AS n_error,
        count(*) FILTER (status IN ('FAIL', 'ERROR')) > 0 AS failed FROM r""")
def dq_tally(t):
    return q.tally(q.run_checks(t.spark, suite(t)))
