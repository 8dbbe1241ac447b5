"""Star flattening and the marts built on it. The star is made of the test tables:
line items are the facts, nations the territories, suppliers the sources, parts the indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.marts import Star, flatten, headline, headline_rates, labelled, labour, mart_of, marts, paired, social_economy, spread
from ..plans.quality import spec_rows
from ..registry import DOMAINS
from ..session import checkpointed
from .base import Tables, query

INDICATOR = """CASE p_type WHEN 'ECONOMY' THEN {0} WHEN 'SMALL' THEN {1} WHEN 'MEDIUM' THEN {2} WHEN 'PROMO' THEN {3}
    WHEN 'STANDARD' THEN {4} ELSE {5} END"""
SE_CODES = INDICATOR.format("'volunteering_rate'", "'association_membership_rate'", "'n_employed'", "'n_local_units'",
                            "'volunteering_years_share'", "'volunteering_activity_share'")
LABOUR_CODES = INDICATOR.format("'employment_rate'", "'unemployment_rate'", "'n_employed'", "'neet_rate'",
                                "'labour_force'", "'inactivity_rate'")
NUTS = """CASE WHEN n_nationkey = 0 THEN 'IT' WHEN n_regionkey = 0 THEN 'ITC' || CAST(n_nationkey AS VARCHAR)
    WHEN n_regionkey = 1 THEN 'ITF3' || CAST(n_nationkey AS VARCHAR) ELSE 'X' || CAST(n_nationkey AS VARCHAR) END"""
LEVEL = "CASE WHEN n_nationkey = 0 THEN 0 WHEN n_regionkey = 0 THEN 2 WHEN n_regionkey = 1 THEN 3 ELSE 0 END"
GENDER = "CASE l_linenumber % 4 WHEN 0 THEN 'total' WHEN 1 THEN 'male' WHEN 2 THEN 'female' END"
EDUCATION = "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'ED' || CAST(l_linenumber AS VARCHAR) END"
CITIZENSHIP = "CASE WHEN l_quantity < 10 THEN NULL WHEN l_quantity < 20 THEN ' ' WHEN l_quantity < 35 THEN 'NAT' ELSE 'FOR' END"
AGE = "CASE WHEN l_discount < 0.04 THEN 'Y15-64' WHEN l_discount < 0.07 THEN 'Y15-74' ELSE 'Y15-29' END"
FREQ = "CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'Q' ELSE 'M' END"
ADJUST = "CASE l_linestatus WHEN 'O' THEN 'N' ELSE 'Y' END"


def expr(sql: str):
    return F.expr(sql.replace("VARCHAR", "STRING"))


def dimensions(t: Tables, indicator: str) -> dict[str, DataFrame]:
    years = t.orders.select(F.year("o_orderdate").cast("bigint").alias("year")).distinct()
    return {
        "dim_geography": t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("geo_key"), expr(NUTS).alias("nuts_code"),
            expr(LEVEL).cast("bigint").alias("nuts_level"), F.col("n_name").alias("nuts_name_it"),
            F.lower("n_name").alias("nuts_name_en"),
            expr(f"substring({NUTS}, 1, 2)").alias("country_code"), F.col("r_name").alias("region_name"),
            F.col("r_name").alias("macro_area"), F.lit(None).cast("string").alias("municipality_type")),
        "dim_time": years.select(F.col("year").alias("time_key"), "year", F.col("year").cast("string").alias("reference_period")),
        "dim_source": t.supplier.select(
            F.col("s_suppkey").alias("source_key"), F.col("s_name").alias("source_id"),
            expr("CASE s_nationkey % 2 WHEN 0 THEN 'istat' ELSE 'eurostat' END").alias("provider"),
            F.lower("s_name").alias("source_name"), F.col("s_nationkey").cast("bigint").alias("priority"),
            F.lit("api").alias("access_type")),
        "dim_indicator": t.part.select(
            F.col("p_partkey").alias("indicator_key"), expr(indicator).alias("indicator_code"), F.col("p_name").alias("label_it"),
            F.upper("p_name").alias("label_en")),
        "dim_legal_form": t.customer.select(
            F.col("c_custkey").alias("legal_form_key"), F.col("c_name").alias("unified_category"),
            F.lower("c_name").alias("unified_category_en"), F.col("c_mktsegment").alias("ets_classification")),
    }


def facts(t: Tables) -> DataFrame:
    """Line items with the key and breakdown columns of both fact tables."""
    text = {"gender": GENDER, "education": EDUCATION, "citizenship": CITIZENSHIP, "age_group": AGE, "frequency": FREQ,
            "adjustment": ADJUST}
    absent = ["volunteering_form", "activity_type", "years_active", "labour_status", "household_size", "econ_resources",
              "municipality_type", "org_sector", "org_type", "motivation", "personal_impact", "multi_membership",
              "association_type", "unemployment_duration", "nace_label_en"]
    return t.lineitem.select(
        (F.col("l_orderkey") % 26).alias("geo_key"), F.year("l_shipdate").cast("bigint").alias("time_key"),
        F.col("l_suppkey").alias("source_key"), F.col("l_partkey").alias("indicator_key"),
        F.when(F.col("l_linenumber") > 4, F.col("l_orderkey") % 2000).alias("legal_form_key"),
        F.col("l_quantity").alias("value"), F.col("l_linestatus").alias("unit"),
        F.date_format("l_shipdate", "yyyy-MM").alias("period_label"), F.col("l_linestatus").alias("nace_code"),
        *[expr(sql).alias(n) for n, sql in text.items()], F.lit("old").alias("ets_classification"),
        *[F.lit(None).cast("string").alias(n) for n in absent],
        F.concat(F.lit("ds"), F.col("l_linenumber").cast("string")).alias("dataset_code"),
        F.col("l_shipdate").alias("extracted_at"))


def star_sql(indicator: str) -> str:
    """The joined star as a CTE body with every column the marts use."""
    return f"""
    SELECT {indicator} AS indicator_code, p_name AS indicator_label_it, upper(p_name) AS indicator_label_en,
        l_quantity AS value, l_linestatus AS unit, y.year, CAST(y.year AS VARCHAR) AS reference_period, {FREQ} AS frequency,
        strftime(l_shipdate, '%Y-%m') AS period_label, {NUTS} AS nuts_code, CAST({LEVEL} AS BIGINT) AS nuts_level,
        n_name AS nuts_name_it, lower(n_name) AS nuts_name_en, substring({NUTS}, 1, 2) AS country_code, r_name AS region_name,
        r_name AS macro_area, CAST(NULL AS VARCHAR) AS municipality_type, c_name AS legal_form, lower(c_name) AS legal_form_en,
        c_mktsegment AS ets_classification, l_linestatus AS nace_code, CAST(NULL AS VARCHAR) AS nace_label_en,
        {GENDER} AS gender, {AGE} AS age_group, CAST(NULL AS VARCHAR) AS volunteering_form, CAST(NULL AS VARCHAR) AS activity_type,
        CAST(NULL AS VARCHAR) AS years_active, {EDUCATION} AS education, CAST(NULL AS VARCHAR) AS labour_status,
        CAST(NULL AS VARCHAR) AS household_size, CAST(NULL AS VARCHAR) AS econ_resources, CAST(NULL AS VARCHAR) AS org_sector,
        CAST(NULL AS VARCHAR) AS org_type, CAST(NULL AS VARCHAR) AS motivation, CAST(NULL AS VARCHAR) AS personal_impact,
        CAST(NULL AS VARCHAR) AS multi_membership, CAST(NULL AS VARCHAR) AS association_type, {CITIZENSHIP} AS citizenship,
        {ADJUST} AS adjustment, CAST(NULL AS VARCHAR) AS unemployment_duration, s_name AS source_id,
        CASE s_nationkey % 2 WHEN 0 THEN 'istat' WHEN 1 THEN 'eurostat' END AS provider, lower(s_name) AS source_name,
        CAST(s_nationkey AS BIGINT) AS source_priority, CASE WHEN s_name IS NOT NULL THEN 'api' END AS access_type,
        'ds' || CAST(l_linenumber AS VARCHAR) AS dataset_code, l_shipdate AS extracted_at
    FROM lineitem
    LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON n_nationkey = l_orderkey % 26
    LEFT JOIN (SELECT DISTINCT year(o_orderdate) AS year FROM orders) y ON y.year = year(l_shipdate)
    LEFT JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN part ON p_partkey = l_partkey
    LEFT JOIN customer ON c_custkey = CASE WHEN l_linenumber > 4 THEN l_orderkey % 2000 END"""


NO_NATION = "CASE WHEN n_nationkey IS NULL THEN NULL ELSE {} END"
_STAR = {"social_economy": star_sql(SE_CODES), "labour": star_sql(LABOUR_CODES)}
for _k, _v in _STAR.items():   # unmatched territories have no attributes at all
    _v = _v.replace(f"{NUTS} AS nuts_code", f"{NO_NATION.format(NUTS)} AS nuts_code")
    _v = _v.replace(f"CAST({LEVEL} AS BIGINT)", f"CAST({NO_NATION.format(LEVEL)} AS BIGINT)")
    _STAR[_k] = _v.replace(f"substring({NUTS}, 1, 2)", NO_NATION.format(f"substring({NUTS}, 1, 2)"))


def flat(t: Tables, base: str) -> DataFrame:
    if base == "labour":
        return labour(facts(t), dimensions(t, LABOUR_CODES))
    return social_economy(facts(t), dimensions(t, SE_CODES))


@query("star_flatten", """
    SELECT l_orderkey, l_linenumber, l_quantity, o_orderdate, c_name, c_mktsegment, n_name, r_name, p_brand AS brand, p_type
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN part ON l_partkey = p_partkey""")
def star_flatten(t):
    def same(*names):
        return {n: n for n in names}

    def keyed(df: DataFrame, old: str, new: str):
        return df.withColumnRenamed(old, new)

    return flatten(t.lineitem, [
        Star(keyed(t.orders, "o_orderkey", "l_orderkey"), "l_orderkey", same("o_orderdate", "o_custkey")),
        Star(keyed(t.customer, "c_custkey", "o_custkey"), "o_custkey", same("c_name", "c_mktsegment", "c_nationkey")),
        Star(keyed(t.nation, "n_nationkey", "c_nationkey"), "c_nationkey", same("n_name", "n_regionkey")),
        Star(keyed(t.region, "r_regionkey", "n_regionkey"), "n_regionkey", same("r_name")),
        Star(keyed(t.part, "p_partkey", "l_partkey"), "l_partkey", {"p_brand": "brand", "p_type": "p_type"}),
    ], ["l_orderkey", "l_linenumber", "l_quantity", "o_orderdate", "c_name", "c_mktsegment", "n_name", "r_name", "brand",
        "p_type"])


_LABOUR_COLUMNS = """indicator_code, indicator_label_it, indicator_label_en, value, unit, year, frequency, period_label,
    nuts_code, nuts_level, nuts_name_it, nuts_name_en, country_code, region_name, macro_area, gender, age_group, education,
    citizenship, adjustment, unemployment_duration, nace_code, nace_label_en, source_id, provider, source_name,
    source_priority, dataset_code, extracted_at"""


@query("mart_social_economy", f"WITH flat AS ({_STAR['social_economy']}) SELECT * EXCLUDE (frequency, period_label, citizenship, adjustment, unemployment_duration) FROM flat")
def mart_social_economy(t):
    return flat(t, "social_economy")


@query("mart_labour", f"WITH flat AS ({_STAR['labour']}) SELECT {_LABOUR_COLUMNS} FROM flat")
def mart_labour(t):
    return flat(t, "labour")


_RATES = "indicator_code IN ('employment_rate', 'unemployment_rate', 'inactivity_rate')"
# Plain SQL of every filtered mart: (base, columns, condition). The conditions are fixed values, as in plans/marts.py.
MART_SQL = {
    "se_volunteering_national": ("social_economy", "year, indicator_code, indicator_label_it, volunteering_form, gender, value, unit, source_id, dataset_code",
        "nuts_code = 'IT' AND nuts_level = 0 AND indicator_code = 'volunteering_rate'"),
    "se_volunteering_regional": ("social_economy", "year, nuts_code, nuts_name_it, nuts_name_en, macro_area, indicator_code, volunteering_form, value, unit, source_id, dataset_code",
        "nuts_level = 2 AND country_code = 'IT' AND indicator_code = 'volunteering_rate' AND (gender = 'total' OR gender IS NULL)"),
    "se_associationism_national": ("social_economy", "year, indicator_code, indicator_label_it, association_type, age_group, gender, education, labour_status, value, unit, dataset_code",
        "nuts_level = 0 AND country_code = 'IT' AND indicator_code = 'association_membership_rate'"),
    "se_employment_eu": ("social_economy", "year, nuts_code, nuts_name_en, country_code, nuts_level, nace_code, nace_label_en, indicator_code, value, unit, dataset_code, source_id",
        "indicator_code = 'n_employed' AND provider = 'eurostat'"),
    "se_local_units_regional": ("social_economy", "year, nuts_code, nuts_name_it, nuts_name_en, country_code, macro_area, nace_code, nace_label_en, value AS n_local_units, dataset_code",
        "indicator_code = 'n_local_units' AND nuts_level = 2"),
    "labour_rates_italy": ("labour", "year, indicator_code, indicator_label_it, indicator_label_en, age_group, gender, value, unit, source_id, dataset_code",
        f"nuts_code = 'IT' AND frequency = 'A' AND {_RATES}"),
    "labour_rates_regional": ("labour", "year, nuts_code, nuts_name_it, nuts_name_en, macro_area, nuts_level, indicator_code, indicator_label_it, age_group, gender, value, unit, source_id, dataset_code",
        f"country_code = 'IT' AND nuts_level IN (2, 3) AND frequency = 'A' AND {_RATES}"),
    "labour_neet": ("labour", "year, nuts_code, nuts_name_it, nuts_name_en, country_code, nuts_level, macro_area, gender, age_group, citizenship, value, unit, source_id, dataset_code",
        "indicator_code = 'neet_rate' AND frequency = 'A'"),
    "labour_employment_by_nace": ("labour", "year, nuts_code, nuts_name_en, country_code, nace_code, nace_label_en, gender, age_group, value AS employed_thousands, unit, dataset_code",
        "indicator_code = 'n_employed' AND nuts_level = 0"),
    "labour_unemployment_by_education": ("labour", "year, nuts_code, nuts_name_en, country_code, nuts_level, macro_area, gender, age_group, education, value AS unemployment_rate, unit, source_id, dataset_code",
        "indicator_code = 'unemployment_rate' AND nullif(trim(education), '') IS NOT NULL AND frequency = 'A'"),
    "labour_employment_edu_citizenship": ("labour", "year, nuts_code, nuts_name_en, country_code, nuts_level, macro_area, gender, education, citizenship, value AS employment_rate, unit, dataset_code",
        "indicator_code = 'employment_rate' AND nullif(trim(education), '') IS NOT NULL AND nullif(trim(citizenship), '') IS NOT NULL AND frequency = 'A'"),
    "labour_force_monthly": ("labour", "year, period_label, gender, age_group, value AS labour_force_thousands, dataset_code",
        "indicator_code = 'labour_force' AND frequency = 'M' AND adjustment = 'N' AND nuts_code = 'IT'"),
}


def _register_marts() -> None:
    for name, (base, columns, where) in MART_SQL.items():
        sql = f"WITH flat AS ({_STAR[base]}) SELECT {columns} FROM flat WHERE {where}"
        query(f"mart_{name}", sql)(lambda t, name=name, base=base: marts()[name].of(flat(t, base)))


_register_marts()

_COUNT_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS mart, count(*) AS n_rows, count(DISTINCT {columns.split(',')[1].strip()}) AS n_second FROM flat_{base} WHERE {where} HAVING count(*) > 0"
    for name, (base, columns, where) in MART_SQL.items())


@query("marts_in_one_pass", f"""
    WITH flat_labour AS MATERIALIZED ({_STAR['labour']}), flat_social_economy AS MATERIALIZED ({_STAR['social_economy']}) {_COUNT_SQL}""")
def marts_in_one_pass(t):
    """Every mart of both domains from one written table each; its second column counted."""
    tables = {base: checkpointed(spread(flat(t, base), base), by=["mart"]) for base in ("labour", "social_economy")}
    frames = []
    for base, table in tables.items():
        second = F.lit(None).cast("string")
        for name, mart in marts().items():
            if mart.base == base:
                second = F.when(F.col("mart") == name, F.col(mart.columns[1]).cast("string")).otherwise(second)
        frames.append(table.groupBy("mart").agg(F.count("*").alias("n_rows"), F.count_distinct(second).alias("n_second")))
    return frames[0].unionByName(frames[1])


@query("mart_from_partition", f"""
    WITH flat AS ({_STAR['labour']}) SELECT {MART_SQL['labour_unemployment_by_education'][1]} FROM flat
    WHERE {MART_SQL['labour_unemployment_by_education'][2]}""")
def mart_from_partition(t):
    return mart_of(checkpointed(spread(flat(t, "labour"), "labour"), by=["mart"]), "labour_unemployment_by_education")


@query("mart_labour_labelled", f"""
    WITH flat AS ({_STAR['labour']}),
    codes AS (SELECT DISTINCT CASE l_linestatus WHEN 'O' THEN 'istat' ELSE 'eurostat' END AS p, 'ED' || l_linenumber AS code, 'education ' || l_linenumber AS label
        FROM lineitem WHERE l_linenumber <> 5)
    SELECT flat.*, coalesce(gender = 'total', true) AS gender_is_total, coalesce(education = 'TOTAL', true) AS education_is_total,
        coalesce(citizenship = 'TOTAL', true) AS citizenship_is_total,
        coalesce(gender = 'total', true) AND coalesce(education = 'TOTAL', true) AND coalesce(citizenship = 'TOTAL', true)
            AND coalesce(age_group = CASE indicator_code WHEN 'employment_rate' THEN 'Y15-64' WHEN 'unemployment_rate' THEN 'Y15-74'
                WHEN 'inactivity_rate' THEN 'Y15-64' WHEN 'neet_rate' THEN 'Y15-29' END, false) AS is_headline,
        gender AS gender_label, coalesce(codes.label, education) AS education_label, citizenship AS citizenship_label
    FROM (SELECT {_LABOUR_COLUMNS} FROM flat) flat LEFT JOIN codes ON codes.p = flat.provider AND codes.code = flat.education""")
def mart_labour_labelled(t):
    codes = t.lineitem.filter("l_linenumber <> 5").select(
        F.lit("education").alias("breakdown"), F.when(F.col("l_linestatus") == "O", "istat").otherwise("eurostat").alias("provider"),
        F.concat(F.lit("ED"), F.col("l_linenumber").cast("string")).alias("code"),
        F.concat(F.lit("education "), F.col("l_linenumber").cast("string")).alias("label")).distinct()
    return labelled(flat(t, "labour"), "labour", codes)


_TOTAL = "coalesce(gender = 'total', true) AND coalesce(education = 'ED7', true)"
_BAND = """CASE indicator_code WHEN 'employment_rate' THEN 'Y15-64' WHEN 'unemployment_rate' THEN 'Y15-74'
    WHEN 'inactivity_rate' THEN 'Y15-64' WHEN 'neet_rate' THEN 'Y15-29' END"""


@query("mart_headline_flags", f"""
    WITH flat AS ({_STAR['labour']})
    SELECT indicator_code, coalesce(gender = 'total', true) AS gender_is_total, coalesce(education = 'ED7', true) AS education_is_total,
        {_TOTAL} AND coalesce(age_group = {_BAND}, false) AS is_headline, count(*) AS n_rows
    FROM flat GROUP BY ALL""")
def mart_headline_flags(t):
    keys = ["indicator_code", "gender_is_total", "education_is_total", "is_headline"]
    return headline(flat(t, "labour"), {"gender": "total", "education": "ED7"}).groupBy(*keys).agg(
        F.count("*").alias("n_rows"))


@query("mart_headline_rates", f"""
    WITH flat AS ({_STAR['labour']})
    SELECT year, nuts_code, nuts_level, nuts_name_it, macro_area, indicator_code, value, unit, dataset_code FROM flat
    WHERE provider = 'istat' AND country_code = 'IT' AND frequency = 'A' AND {_TOTAL} AND coalesce(age_group = {_BAND}, false)""")
def mart_headline_rates(t):
    return headline_rates(flat(t, "labour"), {"gender": "total", "education": "ED7"})


_SPECS = ", ".join(
    f"('fact_{d}', '{code}', {'NULL' if low is None else low}, {'NULL' if high is None else high})"
    for d in ("labour", "social_economy") for code, (low, high) in DOMAINS[d].checks["value_bounds"].items())


@query("check_specs", f"""
    WITH flat_labour AS MATERIALIZED ({_STAR['labour']}), flat_social_economy AS MATERIALIZED ({_STAR['social_economy']}),
    spec AS (SELECT * FROM (VALUES {_SPECS}) v("table", code, low, high)),
    used AS (SELECT 'fact_labour' AS "table", indicator_code AS code, value FROM flat_labour
        UNION ALL SELECT 'fact_social_economy', indicator_code, value FROM flat_social_economy)
    SELECT spec."table", spec.code, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, count(value) AS n_rows,
        count(*) FILTER (value * 3 < low OR value * 3 > high) AS n_out
    FROM spec LEFT JOIN used ON used."table" = spec."table" AND used.code = spec.code GROUP BY ALL""")
def check_specs(t):
    """The registry's bounds as rows, next to the rows of both flat marts they apply to."""
    specs = spec_rows(t.spark, [DOMAINS["labour"], DOMAINS["social_economy"]]).filter("setting = 'value_bounds'")
    used = None
    for base in ("labour", "social_economy"):
        rows = flat(t, base).groupBy(F.lit(f"fact_{base}").alias("table"), F.col("indicator_code").alias("code"), (F.col("value") * 3).alias("v")).agg(
            F.count("value").alias("n"))
        used = rows if used is None else used.unionByName(rows)
    joined = specs.join(checkpointed(used.filter("code is not null")), ["table", "code"], "left")
    outside = F.coalesce((F.col("v") < F.col("low")) | (F.col("v") > F.col("high")), F.lit(False))
    return joined.groupBy("table", "code", "low", "high").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("n_out"))


@query("cross_domain", """
    WITH s AS (SELECT s_nationkey AS territory, year(l_shipdate) AS year, round(sum(l_quantity), 2) AS v FROM lineitem
               JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
    c AS (SELECT c_nationkey AS territory, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS v FROM orders
          JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    SELECT s.territory, CAST(s.year AS INTEGER) AS year, s.v AS quantity, c.v AS revenue
    FROM s JOIN c ON s.territory = c.territory AND s.year = c.year""")
def cross_domain(t):
    left = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(
        F.col("s_nationkey").alias("territory"), F.year("l_shipdate").alias("year")).agg(F.round(F.sum("l_quantity"), 2).alias("value"))
    right = t.orders.filter("o_orderstatus = 'F'").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_nationkey").alias("territory"), F.year("o_orderdate").alias("year")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("value"))
    return paired(left, right, ["territory", "year"], "quantity", "revenue")


@query("mart_ordered", f"""
    WITH flat AS ({_STAR['labour']}) SELECT year, period_label, gender, age_group, value AS labour_force_thousands, dataset_code
    FROM flat WHERE {MART_SQL['labour_force_monthly'][2]} ORDER BY period_label, gender, age_group""")
def mart_ordered(t):
    return marts()["labour_force_monthly"].ordered(flat(t, "labour"))
