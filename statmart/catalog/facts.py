"""Key resolution, fact building and the merge of a domain, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.strings import strip
from ..operators.keys import KeyLookup, resolve_keys, resolved
from ..operators.scope import counts_by, sample_codes
from ..plans.merge import ROW_ID, aligned, merge_domain, with_activity_labels
from ..plans.warehouse import build_fact
from ..registry import DOMAINS
from ..schemas import DIMENSIONS
from ..session import checkpointed
from .base import Tables, query

# ---- key resolution on line items ----
KEYED_SQL = """keyed AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, p.p_partkey AS part_key, s.s_suppkey AS supplier_key,
        o.o_custkey AS customer_key, CASE WHEN p.p_partkey IS NULL THEN 'part_key' WHEN s.s_suppkey IS NULL THEN 'supplier_key' END AS unresolved_key
      FROM lineitem LEFT JOIN part p ON p.p_partkey = l_partkey AND p_size > 3 LEFT JOIN supplier s ON s_name = 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')
        AND s_nationkey <> 2 LEFT JOIN orders o ON o_orderkey = l_orderkey AND o_orderstatus = 'P')"""


def keyed_lines(t: Tables) -> DataFrame:
    parts = t.part.filter("p_size > 3").select("p_partkey", F.col("p_partkey").alias("part_key"))
    suppliers = t.supplier.filter("s_nationkey <> 2").select("s_name", F.col("s_suppkey").alias("supplier_key"))
    open_orders = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", F.col("o_custkey").alias("customer_key"))
    name = F.concat_ws("#", F.lit("Supplier"), strip(F.lpad(F.col("l_suppkey").cast("string"), 9, "0")))
    return resolve_keys(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"), [
        KeyLookup("part_key", parts, {"p_partkey": F.col("l_partkey")}),
        KeyLookup("supplier_key", suppliers, {"s_name": name}),
        KeyLookup("customer_key", open_orders, {"o_orderkey": F.col("l_orderkey")}, required=False),
    ])


@query("resolve_keys", f"WITH {KEYED_SQL} SELECT * EXCLUDE (unresolved_key) FROM keyed WHERE unresolved_key IS NULL")
def resolve(t):
    return resolved(keyed_lines(t))


@query("unresolved_report", f"""
    WITH {KEYED_SQL}, c AS (SELECT unresolved_key, CASE unresolved_key WHEN 'part_key' THEN l_partkey ELSE l_suppkey END AS code, count(*) AS n
        FROM keyed WHERE unresolved_key IS NOT NULL GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY unresolved_key ORDER BY code) AS i FROM c)
    SELECT unresolved_key, count(*) AS n_codes, CAST(sum(n) AS BIGINT) AS n_rows,
        string_agg(CAST(code AS VARCHAR), ',' ORDER BY code) FILTER (i <= 10) AS sample FROM r GROUP BY 1""")
def unresolved_report(t):
    lost = keyed_lines(t).filter("unresolved_key is not null").withColumn(
        "code", F.when(F.col("unresolved_key") == "part_key", F.col("l_partkey")).otherwise(F.col("l_suppkey")))
    return sample_codes(lost, ["unresolved_key"], "code", 10).withColumn("sample", F.array_join("sample", ","))


# ---- a processed table and its star, derived from line items ----
PROC_SQL = """proc AS (SELECT l_orderkey, CASE WHEN l_orderkey % 11 = 0 THEN '' WHEN l_orderkey % 13 = 0 THEN 'ITZZ' WHEN l_orderkey % 17 = 0 THEN 'FR10'
          WHEN l_orderkey % 3 = 0 THEN 'ITC' || CAST(l_suppkey % 40 AS VARCHAR) ELSE chr(CAST(65 + l_suppkey % 20 AS INTEGER)) || 'Q' END AS nuts_code,
        CASE WHEN l_linenumber = 7 THEN 'n.d.' ELSE strftime(l_shipdate, '%Y') END AS time, l_linenumber,
        CASE l_returnflag WHEN 'A' THEN 'istat' ELSE 'eurostat' END AS source_id, l_linestatus AS dataset_code,
        CASE WHEN p_type = 'LARGE' THEN 'not_listed' ELSE p_type END AS indicator_code, l_quantity AS value, l_tax, l_shipdate
      FROM lineitem JOIN part ON l_partkey = p_partkey),
    kept AS (SELECT * FROM proc WHERE nuts_code <> '' AND nuts_code NOT LIKE 'ITZ%' AND (length(nuts_code) = 2 OR nuts_code LIKE 'IT%')),
    geo0 AS (SELECT 'ITC' || CAST(n_nationkey AS VARCHAR) AS nuts_code, CAST(n_nationkey + 1 AS BIGINT) AS geo_key FROM nation),
    geo AS (SELECT * FROM geo0 UNION ALL SELECT nuts_code, (SELECT max(geo_key) FROM geo0) + row_number() OVER (ORDER BY nuts_code)
        FROM (SELECT DISTINCT nuts_code FROM kept WHERE nuts_code NOT IN (SELECT nuts_code FROM geo0))),
    times AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders),
    srcs AS (SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'istat' ELSE 'eurostat' END || '_' || l_linestatus AS source_id,
        CAST(ascii(l_linestatus) + CASE l_returnflag WHEN 'A' THEN 0 ELSE 1 END AS BIGINT) AS source_key FROM lineitem),
    inds AS (SELECT p_type AS indicator_code, min(p_partkey) AS indicator_key FROM part WHERE p_type <> 'LARGE' GROUP BY 1),
    keyed AS (SELECT kept.*, geo_key, times.year AS time_key, source_key, indicator_key,
        CASE WHEN geo_key IS NULL THEN 'geo_key' WHEN times.year IS NULL THEN 'time_key' WHEN source_key IS NULL THEN 'source_key'
             WHEN indicator_key IS NULL THEN 'indicator_key' END AS unresolved_key
      FROM kept LEFT JOIN geo USING (nuts_code) LEFT JOIN times ON CAST(times.year AS VARCHAR) = time
        LEFT JOIN srcs ON srcs.source_id = kept.source_id || '_' || dataset_code LEFT JOIN inds USING (indicator_code))"""


def processed_lines(t: Tables) -> DataFrame:
    key = F.col("l_orderkey")
    code = F.when(key % 11 == 0, "").when(key % 13 == 0, "ITZZ").when(key % 17 == 0, "FR10") \
        .when(key % 3 == 0, F.concat(F.lit("ITC"), (F.col("l_suppkey") % 40).cast("string"))) \
        .otherwise(F.concat(F.char((F.lit(65) + F.col("l_suppkey") % 20)), F.lit("Q")))
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        code.alias("nuts_code"), F.when(F.col("l_linenumber") == 7, "n.d.").otherwise(F.date_format("l_shipdate", "yyyy")).alias("time"),
        F.when(F.col("l_returnflag") == "A", "istat").otherwise("eurostat").alias("source_id"),
        F.col("l_linestatus").alias("dataset_code"),
        F.when(F.col("p_type") == "LARGE", "not_listed").otherwise(F.col("p_type")).alias("indicator_code"),
        F.col("l_quantity").alias("value"), F.lit("count").alias("unit"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("period_label"), key.cast("string").alias("age_group"),
        F.col("l_linenumber").cast("string").alias("education"), F.col("l_tax").cast("string").alias("citizenship"))


def processed_dimensions(t: Tables) -> dict[str, DataFrame]:
    geo = {f.name: F.lit(None).cast(f.dataType) for f in DIMENSIONS["dim_geography"]}
    geo["geo_key"] = (F.col("n_nationkey") + 1).cast("bigint")
    geo["nuts_code"] = F.concat(F.lit("ITC"), F.col("n_nationkey").cast("string"))
    provider = F.when(F.col("l_returnflag") == "A", "istat").otherwise("eurostat")
    number = F.ascii("l_linestatus") + F.when(F.col("l_returnflag") == "A", 0).otherwise(1)
    return {
        "dim_geography": t.nation.select(*[c.alias(n) for n, c in geo.items()]),
        "dim_time": t.orders.select(F.year("o_orderdate").cast("bigint").alias("year")).distinct()
                    .select("year", F.col("year").alias("time_key")),
        "dim_source": t.lineitem.select(F.concat_ws("_", provider, "l_linestatus").alias("source_id"),
                                        number.cast("bigint").alias("source_key")).distinct(),
        "dim_indicator": t.part.filter("p_type <> 'LARGE'").groupBy(F.col("p_type").alias("indicator_code"))
                         .agg(F.min("p_partkey").alias("indicator_key")),
        "dim_legal_form": None,
    }


def built(t: Tables):
    return build_fact(DOMAINS["labour"], processed_lines(t), processed_dimensions(t))


@query("fact_build", f"""
    WITH {PROC_SQL}
    SELECT row_number() OVER (ORDER BY geo_key, time_key, source_key, indicator_key, strftime(l_shipdate, '%Y-%m-%d'), CAST(l_orderkey AS VARCHAR),
        CAST(l_linenumber AS VARCHAR), CAST(l_tax AS VARCHAR), dataset_code, value) AS fact_key, geo_key, time_key, source_key, indicator_key, value,
        'count' AS unit, strftime(l_shipdate, '%Y-%m-%d') AS period_label, CAST(l_orderkey AS VARCHAR) AS age_group,
        CAST(l_linenumber AS VARCHAR) AS education, CAST(l_tax AS VARCHAR) AS citizenship, dataset_code
    FROM keyed WHERE unresolved_key IS NULL""")
def fact_build(t):
    fact, _, _, _ = built(t)
    return fact.select("fact_key", "geo_key", "time_key", "source_key", "indicator_key", "value", "unit", "period_label",
                       "age_group", "education", "citizenship", "dataset_code")


@query("fact_build_quarantine", f"""
    WITH {PROC_SQL}
    SELECT 'scope' AS stage, CASE WHEN nuts_code = '' THEN 'unmatched' WHEN nuts_code LIKE 'ITZ%' THEN 'extra_regio' ELSE 'foreign_subnational' END AS reason,
        dataset_code, count(*) AS n_rows FROM proc WHERE nuts_code = '' OR nuts_code IN ('ITZZ', 'FR10') GROUP BY ALL
    UNION ALL SELECT 'keys', unresolved_key, dataset_code, count(*) FROM keyed WHERE unresolved_key IS NOT NULL GROUP BY ALL""")
def fact_build_quarantine(t):
    _, _, scope, keys = built(t)
    return (
        counts_by(scope.select(F.lit("scope").alias("stage"), F.col("drop_reason").alias("reason"), "dataset_code"),
                  ["stage", "reason", "dataset_code"])
        .unionByName(counts_by(keys.select(F.lit("keys").alias("stage"), F.col("unresolved_key").alias("reason"), "dataset_code"),
                               ["stage", "reason", "dataset_code"]))
    )


# ---- merge of the labour domain from two made-up landings of orders and line items ----
MERGE_SQL = r"""
    WITH xw AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS istat_code, 'ITH' || CAST(n_nationkey AS VARCHAR) AS nuts_code,
            CAST(n_regionkey AS BIGINT) AS lvl, n_name FROM nation),
    a AS (SELECT 'employment_rate' AS indicator_code, '150_915_DF_DCCV_TAXOCCU1_5' AS dataset_code, 'istat' AS source_id, 1 AS priority,
            o_totalprice AS value, CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m') END AS time,
            CASE WHEN o_orderkey % 9 = 0 THEN 'XX9' WHEN o_orderkey % 2 = 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 3, '0')
                 WHEN o_orderkey % 3 = 0 THEN 'ITD' || CAST(c_nationkey AS VARCHAR) ELSE ' ith' || CAST(c_nationkey AS VARCHAR) END AS geo,
            CASE o_orderstatus WHEN 'O' THEN 'male' WHEN 'F' THEN 'female' END AS gender, o_orderpriority AS age_group, o_orderdate AS seen,
            CASE WHEN o_orderkey % 4 = 0 THEN 'A' ELSE 'M' END AS frequency, CAST(NULL AS VARCHAR) AS education, CAST(NULL AS VARCHAR) AS nace_code
          FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 5 <> 0 AND year(o_orderdate) >= 2015 - 18),
    ah AS (SELECT a.*, coalesce(x.nuts_code, y.nuts_code, z.nuts_code) AS nuts_code, coalesce(x.lvl, y.lvl, z.lvl) AS nuts_level, 'IT' AS country_code,
            coalesce(x.n_name, y.n_name, z.n_name) AS nuts_name_it, coalesce(x.nuts_code, y.nuts_code, z.nuts_code) IS NULL AS geo_unmatched
          FROM a LEFT JOIN xw x ON upper(trim(a.geo)) = x.istat_code LEFT JOIN xw y ON upper(trim(a.geo)) = y.nuts_code
            LEFT JOIN xw z ON CASE WHEN upper(trim(a.geo)) LIKE 'ITD%' THEN 'ITH' || substring(trim(a.geo), 4) END = z.nuts_code),
    b AS (SELECT 'unemployment_rate' AS indicator_code, 'lfst_r_lfu3rt' AS dataset_code, 'eurostat' AS source_id, 2 AS priority, l_quantity AS value,
            CAST(2021 + l_linenumber % 4 AS VARCHAR) AS time, CASE WHEN l_suppkey % 5 = 0 THEN 'EA19' WHEN l_suppkey % 5 = 1 THEN 'FR10'
              WHEN l_suppkey % 5 = 2 THEN 'it' || CAST(l_suppkey % 7 AS VARCHAR) WHEN l_suppkey % 5 = 3 THEN 'DE' ELSE 'ITC' || CAST(l_suppkey % 3 AS VARCHAR) END AS geo,
            l_returnflag AS gender, 'Y15-74' AS age_group, l_shipdate AS seen, 'A' AS frequency, CASE l_linestatus WHEN 'O' THEN 'TOTAL' ELSE 'ED5-8' END AS education,
            'C' || CAST(l_partkey % 50 AS VARCHAR) AS nace_code FROM lineitem WHERE l_returnflag <> 'N'),
    bh AS (SELECT b.*, upper(geo) AS nuts_code, CASE WHEN length(geo) BETWEEN 2 AND 5 THEN length(geo) - 2 END AS nuts_level, upper(substring(geo, 1, 2)) AS country_code,
            CAST(NULL AS VARCHAR) AS nuts_name_it, CAST(NULL AS BOOLEAN) AS geo_unmatched FROM b
          WHERE (length(geo) = 2 OR geo LIKE 'IT%')),
    u AS MATERIALIZED (SELECT * FROM ah UNION ALL SELECT * FROM bh),
    k AS (SELECT *, row_number() OVER (PARTITION BY indicator_code, nuts_code, time, nace_code, gender, age_group, education, frequency
            ORDER BY priority, dataset_code, seen DESC, value) AS rn FROM u),
    f AS MATERIALIZED (SELECT * EXCLUDE (rn) FROM k WHERE rn = 1 OR nuts_code IS NULL)
    SELECT indicator_code, dataset_code, source_id, CAST(priority AS BIGINT) AS priority, value, 'percentage' AS unit, CAST(substring(time, 1, 4) AS BIGINT) AS time,
        frequency, time AS period_label, nuts_code, CAST(nuts_level AS BIGINT) AS nuts_level, country_code, nuts_name_it, gender, age_group, education, nace_code,
        strftime(seen, '%Y-%m-%d') AS extracted_on, geo_unmatched
    FROM f WHERE coalesce(nuts_code, '') NOT IN ('EU27_2020', 'EU27', 'EA', 'EA19', 'EA20')"""


def landings(t: Tables) -> dict[str, DataFrame]:
    """Two raw datasets as they would be landed, with spelled codes, text values and some missing values."""
    key, nation = F.col("o_orderkey"), F.col("c_nationkey").cast("string")
    geo = F.when(key % 9 == 0, "XX9").when(key % 2 == 0, F.lpad(nation, 3, "0")) \
        .when(key % 3 == 0, F.concat(F.lit("ITD"), nation)).otherwise(F.concat(F.lit(" ith"), nation))
    annual = key % 4 == 0
    position = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(ROW_ID)
    a = t.orders.select("*", position).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        geo.alias("geo"),
        # dates are moved on by 18 years so that they pass the dataset's first year
        F.when(annual, F.date_format("o_orderdate", "yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("_t"),
        F.when(annual, "A").otherwise("M").alias("frequency"),
        F.when(F.col("o_orderstatus") == "O", "1").when(F.col("o_orderstatus") == "F", " females").otherwise("x").alias("gender"),
        F.col("o_orderpriority").alias("age_group"),
        F.when(key % 5 == 0, ":").otherwise(F.col("o_totalprice").cast("string")).alias("value"),
        F.col("o_orderdate").alias("extracted_at"), ROW_ID)
    a = a.withColumn("time", F.concat((F.substring("_t", 1, 4).cast("int") + 18).cast("string"), F.substring("_t", 5, 3))).drop("_t")
    n = F.col("l_suppkey") % 5
    place = F.when(n == 0, "EA19").when(n == 1, "FR10").when(n == 2, F.concat(F.lit("it"), (F.col("l_suppkey") % 7).cast("string"))) \
        .when(n == 3, "DE").otherwise(F.concat(F.lit("ITC"), (F.col("l_suppkey") % 3).cast("string")))
    b = t.lineitem.select("*", position).select(
        place.alias("geo"), (F.lit(2021) + F.col("l_linenumber") % 4).cast("string").alias("time"),
        F.when(F.col("l_returnflag") == "N", "X").otherwise(
            F.when(F.col("l_returnflag") == "A", "T").otherwise("F")).alias("sex"),
        F.lit("Y15-74").alias("age"), F.lit("A").alias("freq"), F.lit("PC").alias("unit"),
        F.when(F.col("l_linestatus") == "O", "TOTAL").otherwise("ED5-8").alias("isced11"),
        F.concat(F.lit(" c"), (F.col("l_partkey") % 50).cast("string")).alias("nace_r2"),
        F.col("l_quantity").cast("string").alias("value"), F.col("l_shipdate").alias("extracted_at"), ROW_ID)
    return {"150_915_DF_DCCV_TAXOCCU1_5": a, "lfst_r_lfu3rt": b}


_MERGE_SQL = MERGE_SQL.replace("strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m') END AS time",
                               "CAST(year(o_orderdate) + 18 AS VARCHAR) ELSE CAST(year(o_orderdate) + 18 AS VARCHAR) || strftime(o_orderdate, '-%m') END AS time") \
    .replace("l_returnflag AS gender", "CASE l_returnflag WHEN 'A' THEN 'T' ELSE 'F' END AS gender")


@query("merge_labour", _MERGE_SQL)
def merge_labour(t):
    crosswalk = t.nation.select(
        F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("istat_code"),
        F.concat(F.lit("ITH"), F.col("n_nationkey").cast("string")).alias("nuts_code"),
        F.col("n_regionkey").cast("string").alias("nuts_level"), F.col("n_name").alias("nuts_name_it"),
        F.lower("n_name").alias("nuts_name_en"), F.lit("r").alias("region_name"), F.lit("m").alias("macro_area"),
        F.col("n_nationkey").cast("bigint").alias("ord"))
    forms = t.region.select(
        F.lit("istat").alias("source_system"), F.col("r_name").alias("source_code"), F.lit("").alias("unified_category"),
        F.lit("").alias("unified_category_en"), F.lit("").alias("nace_primary"), F.lit("").alias("ets_classification"),
        F.col("r_regionkey").cast("bigint").alias("ord"))
    merged = merge_domain(DOMAINS["labour"], landings(t), crosswalk, forms, activity_names(t))
    return merged.select(
        "indicator_code", "dataset_code", "source_id", "priority", "value", "unit", "time", "frequency", "period_label",
        "nuts_code", "nuts_level", "country_code", "nuts_name_it", "gender", "age_group", "education", "nace_code",
        F.date_format("extracted_at", "yyyy-MM-dd").alias("extracted_on"), "geo_unmatched")


# ---- the parts of a merge on their own ----
@query("canonical_axes", """
    SELECT CASE l_returnflag WHEN 'A' THEN 'T' ELSE 'F' END AS gender, 'Y15-74' AS age_group, CASE l_linestatus WHEN 'O' THEN 'TOTAL' ELSE 'ED5-8' END AS education,
        'A' AS frequency, 'C' || CAST(l_partkey % 50 AS VARCHAR) AS nace_code, n_name AS nace_label_en, count(*) AS n_rows, CAST(sum(l_quantity) AS BIGINT) AS quantity
    FROM lineitem LEFT JOIN nation ON n_nationkey = l_partkey % 50
    WHERE l_returnflag <> 'N' AND l_suppkey % 5 IN (3, 4) GROUP BY ALL""")
def canonical_axes(t):
    """Axes of a cube under the names all datasets share, with the label of the activity."""
    cube = landings(t)["lfst_r_lfu3rt"]
    registered = next(d for d in DOMAINS["labour"].datasets if d.code == "lfst_r_lfu3rt")
    rows = with_activity_labels(aligned(cube, registered, DOMAINS["labour"]).withColumnRenamed("_nace", "nace_code"), activity_names(t))
    return rows.groupBy("gender", "age_group", "education", "frequency", "nace_code", "nace_label_en").agg(
        F.count("*").alias("n_rows"), F.sum("value").cast("bigint").alias("quantity"))


def activity_names(t: Tables) -> DataFrame:
    return t.nation.select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("nace_code"),
                           F.col("n_name").alias("label_en"), F.col("n_nationkey").cast("bigint").alias("ord"))


# ---- merge of the social-economy domain: short codes to pad, legal forms, a dataset without territory ----
SE_SQL = r"""
    xw AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS istat_code, 'ITF' || CAST(n_nationkey AS VARCHAR) AS nuts_code,
            CAST(n_regionkey AS BIGINT) AS lvl, n_name FROM nation),
    fm AS (SELECT upper(r_name) AS code, lower(r_name) AS unified, r_regionkey AS key FROM region),
    nl AS (SELECT CASE n_nationkey WHEN 3 THEN 'O-U' ELSE 'C' || CAST(n_nationkey AS VARCHAR) END AS nace_code, n_name AS label FROM nation),
    a AS (SELECT 'volunteering_rate' AS indicator_code, 'mixed' AS unit, '85_84_DF_DCSA_VOLON1_1' AS dataset_code, 'istat' AS source_id, 1 AS priority,
            o_totalprice AS value, CAST(year(o_orderdate) + 25 AS VARCHAR) AS time, CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 2
              THEN '0' || CAST(c_nationkey AS VARCHAR) ELSE CAST(c_nationkey AS VARCHAR) END AS geo, true AS has_geo,
            CASE o_orderkey % 6 WHEN 5 THEN 'NOSUCH' ELSE (SELECT upper(r_name) FROM region WHERE r_regionkey = o_orderkey % 6) END AS form,
            CASE o_orderstatus WHEN 'O' THEN 'male' WHEN 'F' THEN 'female' END AS gender, o_orderpriority AS age_group, o_orderdate AS seen,
            CAST(NULL AS VARCHAR) AS nace_code
          FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) + 25 >= 2015),
    n AS (SELECT 'association_membership_rate' AS indicator_code, 'percentage' AS unit, '83_63_DF_DCCV_AVQ_PERSONE_129' AS dataset_code, 'istat' AS source_id,
            1 AS priority, p_retailprice AS value, '2020' AS time, CAST(NULL AS VARCHAR) AS geo, false AS has_geo, CAST(NULL AS VARCHAR) AS form,
            CAST(NULL AS VARCHAR) AS gender, p_type AS age_group, TIMESTAMP '2024-01-01' AS seen, CAST(NULL AS VARCHAR) AS nace_code FROM part),
    e AS (SELECT 'n_employed' AS indicator_code, 'thousands_persons' AS unit, 'nama_10r_3empers' AS dataset_code, 'eurostat' AS source_id, 2 AS priority,
            l_quantity AS value, CAST(2021 + l_linenumber % 4 AS VARCHAR) AS time, CASE WHEN l_suppkey % 4 = 0 THEN 'EU27_2020' WHEN l_suppkey % 4 = 1 THEN 'ITC' || CAST(l_suppkey % 9 AS VARCHAR)
              ELSE 'FR' END AS geo, true AS has_geo, CAST(NULL AS VARCHAR) AS form, CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS age_group,
            l_shipdate AS seen, 'O-U' AS nace_code FROM lineitem WHERE l_partkey % 2 = 0),
    u AS (SELECT * FROM a UNION ALL SELECT * FROM n UNION ALL SELECT * FROM e),
    h AS MATERIALIZED (SELECT u.*, CASE WHEN NOT has_geo THEN 'IT' WHEN source_id = 'istat' THEN xw.nuts_code ELSE upper(trim(geo)) END AS nuts_code,
            CASE WHEN NOT has_geo THEN 0 WHEN source_id = 'istat' THEN xw.lvl WHEN length(trim(geo)) BETWEEN 2 AND 5 THEN length(trim(geo)) - 2 END AS nuts_level,
            CASE WHEN NOT has_geo THEN 'Italia' WHEN source_id = 'istat' THEN xw.n_name END AS nuts_name_it,
            fm.unified AS legal_form_unified, CASE WHEN form IS NOT NULL THEN fm.unified IS NULL WHEN source_id = 'istat' THEN false END AS legal_form_unmatched,
            nl.label AS nace_label_en
          FROM u LEFT JOIN xw ON xw.istat_code = u.geo LEFT JOIN fm ON fm.code = u.form LEFT JOIN nl USING (nace_code)),
    k AS (SELECT *, row_number() OVER (PARTITION BY indicator_code, nuts_code, time, legal_form_unified, nace_code, gender, age_group
            ORDER BY priority, dataset_code, seen DESC, value, form) AS rn FROM h),
    se AS MATERIALIZED (SELECT * EXCLUDE (rn) FROM k WHERE rn = 1 OR nuts_code IS NULL),
    merged AS (SELECT * FROM se WHERE coalesce(nuts_code, '') <> 'EU27_2020')"""


def social_landings(t: Tables) -> dict[str, DataFrame]:
    """Three raw datasets: local codes without their leading zero and with legal forms, no territory, common codes."""
    position = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(ROW_ID)
    key = F.col("o_orderkey") % 6
    names = t.region.select(F.col("r_regionkey").alias("_r"), F.col("r_name").alias("_name"))
    a = t.orders.select("*", position).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(names, key == F.col("_r"), "left").select(
        F.col("c_nationkey").cast("string").alias("ref_area"), F.when(key == 5, "nosuch").otherwise(F.lower("_name")).alias("tipoente"),
        F.when(F.col("o_orderstatus") == "O", "1").when(F.col("o_orderstatus") == "F", " females").otherwise("x").alias("gender"),
        F.col("o_orderpriority").alias("age_group"), (F.year("o_orderdate") + 25).cast("string").alias("time"),
        F.col("o_totalprice").cast("string").alias("value"), F.col("o_orderdate").alias("extracted_at"), ROW_ID)
    n = t.part.select(F.col("p_type").alias("age_group"), F.lit("2020").alias("time"), F.col("p_retailprice").cast("string").alias("value"),
                      F.lit("2024-01-01").alias("extracted_at"), position)
    place = F.col("l_suppkey") % 4
    e = t.lineitem.select(
        F.when(place == 0, "EU27_2020").when(place == 1, F.concat(F.lit("ITC"), (F.col("l_suppkey") % 9).cast("string"))).otherwise("FR").alias("geo"),
        F.when(F.col("l_partkey") % 2 == 0, "O-U").otherwise("A").alias("nace_r2"), (F.lit(2021) + F.col("l_linenumber") % 4).cast("string").alias("time"), F.lit("THS").alias("unit"),
        F.lit("EMP").alias("wstatus"), F.col("l_quantity").cast("string").alias("value"), F.col("l_shipdate").alias("extracted_at"), position)
    return {"85_84_DF_DCSA_VOLON1_1": a, "83_63_DF_DCCV_AVQ_PERSONE_129": n, "nama_10r_3empers": e}


def social_merged(t: Tables) -> DataFrame:
    crosswalk = t.nation.select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("istat_code"),
        F.concat(F.lit("ITF"), F.col("n_nationkey").cast("string")).alias("nuts_code"),
        F.col("n_regionkey").cast("string").alias("nuts_level"), F.col("n_name").alias("nuts_name_it"),
        F.lower("n_name").alias("nuts_name_en"), F.lit("r").alias("region_name"), F.lit("m").alias("macro_area"),
        F.col("n_nationkey").cast("bigint").alias("ord"))
    forms = t.region.select(
        F.lit("istat").alias("source_system"), F.lower("r_name").alias("source_code"), F.lower("r_name").alias("unified_category"),
        F.col("r_name").alias("unified_category_en"), F.lit("").alias("nace_primary"), F.lit("").alias("ets_classification"),
        F.col("r_regionkey").cast("bigint").alias("ord"))
    activity = F.when(F.col("n_nationkey") == 3, "O-U").otherwise(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")))
    activities = t.nation.select(activity.alias("nace_code"),
                                 F.col("n_name").alias("label_en"), F.col("n_nationkey").cast("bigint").alias("ord"))
    return merge_domain(DOMAINS["social_economy"], social_landings(t), crosswalk, forms, activities)


@query("merge_social_economy", f"""
    WITH {SE_SQL}
    SELECT indicator_code, dataset_code, source_id, value, unit, CAST(time AS BIGINT) AS time, nuts_code, CAST(nuts_level AS BIGINT) AS nuts_level, nuts_name_it,
        legal_form_unified, form AS legal_form_code, legal_form_unmatched, gender, age_group, nace_code, nace_label_en, strftime(seen, '%Y-%m-%d') AS extracted_on
    FROM merged""")
def merge_social_economy(t):
    return social_merged(t).select(
        "indicator_code", "dataset_code", "source_id", "value", "unit", "time", "nuts_code", "nuts_level", "nuts_name_it",
        "legal_form_unified", "legal_form_code", "legal_form_unmatched", "gender", "age_group", "nace_code", "nace_label_en",
        F.date_format("extracted_at", "yyyy-MM-dd").alias("extracted_on"))


def social_dimensions(t: Tables) -> dict[str, DataFrame]:
    geo = {f.name: F.lit(None).cast(f.dataType) for f in DIMENSIONS["dim_geography"]}
    geo["geo_key"] = (F.col("n_nationkey") + 1).cast("bigint")
    geo["nuts_code"] = F.concat(F.lit("ITF"), F.col("n_nationkey").cast("string"))
    codes = ["volunteering_rate", "association_membership_rate", "n_employed"]
    names = ["istat_85_84_DF_DCSA_VOLON1_1", "istat_83_63_DF_DCCV_AVQ_PERSONE_129", "eurostat_nama_10r_3empers"]
    # codes in the dimension are spelled as their publishers do, some twice
    forms = t.region.select(F.lit(" istat").alias("source_system"), F.lower("r_name").alias("source_code"),
                            (F.col("r_regionkey") + 1).cast("bigint").alias("legal_form_key"))
    return {
        "dim_geography": t.nation.select(*[c.alias(n) for n, c in geo.items()]),
        "dim_time": t.orders.select((F.year("o_orderdate") + 25).cast("bigint").alias("year")).distinct().select("year", F.col("year").alias("time_key")),
        "dim_source": t.region.filter(F.col("r_regionkey") < 3).select(
            F.get(F.array(*[F.lit(n) for n in names]), F.col("r_regionkey").cast("int")).alias("source_id"),
            (F.col("r_regionkey") + 1).cast("bigint").alias("source_key")),
        "dim_indicator": t.region.filter(F.col("r_regionkey") < 3).select(
            F.get(F.array(*[F.lit(c) for c in codes]), F.col("r_regionkey").cast("int")).alias("indicator_code"),
            (F.col("r_regionkey") + 1).cast("bigint").alias("indicator_key")),
        "dim_legal_form": forms.union(forms.select("source_system", F.upper("source_code"), F.col("legal_form_key") + 100)),
    }


@query("fact_build_social_economy", f"""
    WITH {SE_SQL},
    kept AS (SELECT * FROM merged WHERE nuts_code IS NOT NULL AND (length(nuts_code) = 2 OR nuts_code LIKE 'IT%')),
    geo0 AS (SELECT 'ITF' || CAST(n_nationkey AS VARCHAR) AS nuts_code, CAST(n_nationkey + 1 AS BIGINT) AS geo_key FROM nation),
    geo AS (SELECT * FROM geo0 UNION ALL SELECT nuts_code, (SELECT max(geo_key) FROM geo0) + row_number() OVER (ORDER BY nuts_code)
        FROM (SELECT DISTINCT nuts_code FROM kept WHERE nuts_code NOT IN (SELECT nuts_code FROM geo0))),
    times AS (SELECT DISTINCT CAST(year(o_orderdate) + 25 AS BIGINT) AS year FROM orders)
    SELECT geo_key, times.year AS time_key, CASE indicator_code WHEN 'volunteering_rate' THEN 1 WHEN 'association_membership_rate' THEN 2 ELSE 3 END AS indicator_key,
        CASE WHEN form IS NOT NULL THEN CAST(fm.key + 1 AS BIGINT) END AS legal_form_key, value, unit, gender, age_group, nace_code, dataset_code
    FROM kept JOIN geo USING (nuts_code) JOIN times ON times.year = CAST(time AS BIGINT) LEFT JOIN fm ON fm.code = form""")
def fact_build_social_economy(t):
    # the processed table is a layer of its own, written before the fact is built from it: unseen territories, keys and
    # quarantine each read it, and would each merge the landed rows anew
    fact, _, _, _ = build_fact(DOMAINS["social_economy"], checkpointed(social_merged(t)), social_dimensions(t))
    return fact.select("geo_key", "time_key", F.col("indicator_key").cast("int").alias("indicator_key"), "legal_form_key", "value", "unit",
                       "gender", "age_group", "nace_code", "dataset_code")
