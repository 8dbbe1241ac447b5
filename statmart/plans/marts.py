"""Flat marts over the star, and the filtered marts built on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.periods import frequency_of, ordinal_of
from ..functions.strings import blank_to_null, fold
from ..operators.keys import left_join, left_join_spread
from ..registry import HEADLINE_AGE
from ..session import checkpointed, is_plain_scan


@dataclass(frozen=True)
class Star:
    """A dimension attached to a fact: key shared by both sides, columns taken from it (name -> name in the mart)."""

    dimension: DataFrame
    key: str
    columns: dict[str, str]
    optional: bool = False      # most facts may have no such key


def flatten(fact: DataFrame, stars: list[Star], output: list[str]) -> DataFrame:
    """Left-join every dimension on its key and select the output columns.

    Only the key and the columns in use leave a dimension, and no join is hinted: dimensions Catalyst knows to be
    small are broadcast, the others are shuffled once, with facts that lack an optional key spread over all tasks.
    A dimension that does not lie in files is written first: guessed from what it is derived from, a handful of years
    would count as large, and all facts would be shuffled to as few tasks as there are years.
    """
    out = fact
    for s in stars:
        side = s.dimension.select(F.col(s.key).alias(f"_{s.key}"),
                                  *[F.col(c).alias(n) for c, n in s.columns.items()])
        if not is_plain_scan(s.dimension):
            side = checkpointed(side)
        clash = [n for n in s.columns.values() if n in out.columns]
        join = left_join_spread if s.optional else left_join
        out = join(out.drop(*clash), side, [(F.col(s.key), f"_{s.key}")]).drop(f"_{s.key}")
    return out.select(*output)


# ---- fixed values: column lists of the marts ----
_INDICATOR = {"indicator_code": "indicator_code", "label_it": "indicator_label_it", "label_en": "indicator_label_en"}
_SOURCE = {"source_id": "source_id", "provider": "provider", "source_name": "source_name",
           "priority": "source_priority"}
_PLACE = {c: c for c in ["nuts_code", "nuts_level", "nuts_name_it", "nuts_name_en", "country_code", "region_name",
                         "macro_area"]}
SOCIAL_ECONOMY = [
    "indicator_code", "indicator_label_it", "indicator_label_en", "value", "unit", "year", "reference_period",
    "nuts_code", "nuts_level", "nuts_name_it", "nuts_name_en", "country_code", "region_name", "macro_area",
    "municipality_type", "legal_form", "legal_form_en", "ets_classification", "nace_code", "nace_label_en", "gender",
    "age_group", "volunteering_form", "activity_type", "years_active", "education", "labour_status",
    "household_size", "econ_resources", "org_sector", "org_type", "motivation", "personal_impact",
    "multi_membership", "association_type", "source_id", "provider", "source_name", "source_priority",
    "access_type", "dataset_code", "extracted_at"]
LABOUR = [
    "indicator_code", "indicator_label_it", "indicator_label_en", "value", "unit", "year", "frequency",
    "period_label", "nuts_code", "nuts_level", "nuts_name_it", "nuts_name_en", "country_code", "region_name",
    "macro_area", "gender", "age_group", "education", "citizenship", "adjustment", "unemployment_duration",
    "nace_code", "nace_label_en", "source_id", "provider", "source_name", "source_priority", "dataset_code",
    "extracted_at"]


# Order of the joins. The optional key comes first: its join numbers rows, which no filter of a mart passes, and so the
# other dimensions can be filtered before they are joined. Territories, which most marts select by, come before the
# indicators; dimensions that only widen the rows come last, as what is shuffled then has not got their columns yet.
def social_economy(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return flatten(fact, [
        Star(dims["dim_legal_form"], "legal_form_key", {
            "unified_category": "legal_form", "unified_category_en": "legal_form_en",
            "ets_classification": "ets_classification"}, optional=True),
        Star(dims["dim_geography"], "geo_key", {**_PLACE, "municipality_type": "municipality_type"}),
        Star(dims["dim_indicator"], "indicator_key", _INDICATOR),
        Star(dims["dim_source"], "source_key", {**_SOURCE, "access_type": "access_type"}),
        Star(dims["dim_time"], "time_key", {"year": "year", "reference_period": "reference_period"}),
    ], SOCIAL_ECONOMY)


def labour(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return flatten(fact, [
        Star(dims["dim_geography"], "geo_key", _PLACE),
        Star(dims["dim_indicator"], "indicator_key", _INDICATOR),
        Star(dims["dim_source"], "source_key", _SOURCE),
        Star(dims["dim_time"], "time_key", {"year": "year"}),
    ], LABOUR)


def filled(name: str) -> Column:
    return blank_to_null(F.col(name)).isNotNull()


def total_or_absent(name: str, total: str = "total") -> Column:
    """True for the total and for rows without this breakdown (``IN (total, NULL)`` would miss the latter)."""
    return F.coalesce(F.col(name) == total, F.lit(True))


@dataclass(frozen=True)
class Mart:
    """A filtered mart: rows, columns (old name -> new name where renamed), and the order a reader would want."""

    base: str
    where: Column
    columns: list[str]
    renamed: dict[str, str]
    order: list[str]

    def of(self, flat: DataFrame) -> DataFrame:
        return flat.filter(self.where).select(
            *[F.col(c).alias(self.renamed.get(c, c)) for c in self.columns])

    def ordered(self, flat: DataFrame) -> DataFrame:
        return self.of(flat).orderBy(*self.order)


# ---- fixed values: filters, columns and orders of the marts ----
def marts() -> dict[str, Mart]:
    """Every filtered mart by name."""
    indicator, level, home = F.col("indicator_code"), F.col("nuts_level"), F.col("country_code") == "IT"
    national = (F.col("nuts_code") == "IT")
    annual = F.col("frequency") == "A"
    rates = indicator.isin("employment_rate", "unemployment_rate", "inactivity_rate")
    return {
        "se_volunteering_national": Mart(
            "social_economy", national & (level == 0) & (indicator == "volunteering_rate"),
            ["year", "indicator_code", "indicator_label_it", "volunteering_form", "gender", "value", "unit",
             "source_id", "dataset_code"], {}, ["year", "volunteering_form", "gender"]),
        "se_volunteering_regional": Mart(
            "social_economy", (level == 2) & home & (indicator == "volunteering_rate") & total_or_absent("gender"),
            ["year", "nuts_code", "nuts_name_it", "nuts_name_en", "macro_area", "indicator_code",
             "volunteering_form", "value", "unit", "source_id", "dataset_code"], {}, ["year", "nuts_code"]),
        "se_associationism_national": Mart(
            "social_economy", (level == 0) & home & (indicator == "association_membership_rate"),
            ["year", "indicator_code", "indicator_label_it", "association_type", "age_group", "gender", "education",
             "labour_status", "value", "unit", "dataset_code"], {}, ["year", "association_type", "age_group"]),
        "se_employment_eu": Mart(
            "social_economy", (indicator == "n_employed") & (F.col("provider") == "eurostat"),
            ["year", "nuts_code", "nuts_name_en", "country_code", "nuts_level", "nace_code", "nace_label_en",
             "indicator_code", "value", "unit", "dataset_code", "source_id"], {},
            ["year", "country_code", "nace_code"]),
        "se_local_units_regional": Mart(
            "social_economy", (indicator == "n_local_units") & (level == 2),
            ["year", "nuts_code", "nuts_name_it", "nuts_name_en", "country_code", "macro_area", "nace_code",
             "nace_label_en", "value", "dataset_code"], {"value": "n_local_units"},
            ["year", "nuts_code", "nace_code"]),
        "labour_rates_italy": Mart(
            "labour", national & annual & rates,
            ["year", "indicator_code", "indicator_label_it", "indicator_label_en", "age_group", "gender", "value",
             "unit", "source_id", "dataset_code"], {}, ["indicator_code", "age_group", "gender", "year"]),
        "labour_rates_regional": Mart(
            "labour", home & level.isin(2, 3) & annual & rates,
            ["year", "nuts_code", "nuts_name_it", "nuts_name_en", "macro_area", "nuts_level", "indicator_code",
             "indicator_label_it", "age_group", "gender", "value", "unit", "source_id", "dataset_code"], {},
            ["indicator_code", "year", "nuts_code"]),
        "labour_neet": Mart(
            "labour", (indicator == "neet_rate") & annual,
            ["year", "nuts_code", "nuts_name_it", "nuts_name_en", "country_code", "nuts_level", "macro_area",
             "gender", "age_group", "citizenship", "value", "unit", "source_id", "dataset_code"], {},
            ["year", "nuts_code", "gender", "age_group", "citizenship"]),
        "labour_employment_by_nace": Mart(
            "labour", (indicator == "n_employed") & (level == 0),
            ["year", "nuts_code", "nuts_name_en", "country_code", "nace_code", "nace_label_en", "gender",
             "age_group", "value", "unit", "dataset_code"], {"value": "employed_thousands"},
            ["year", "country_code", "nace_code"]),
        "labour_unemployment_by_education": Mart(
            "labour", (indicator == "unemployment_rate") & filled("education") & annual,
            ["year", "nuts_code", "nuts_name_en", "country_code", "nuts_level", "macro_area", "gender", "age_group",
             "education", "value", "unit", "source_id", "dataset_code"], {"value": "unemployment_rate"},
            ["year", "nuts_code", "education", "gender"]),
        "labour_employment_edu_citizenship": Mart(
            "labour", (indicator == "employment_rate") & filled("education") & filled("citizenship") & annual,
            ["year", "nuts_code", "nuts_name_en", "country_code", "nuts_level", "macro_area", "gender", "education",
             "citizenship", "value", "unit", "dataset_code"], {"value": "employment_rate"},
            ["year", "nuts_code", "education", "citizenship"]),
        "labour_force_monthly": Mart(
            "labour", (indicator == "labour_force") & (F.col("frequency") == "M") & (F.col("adjustment") == "N")
            & national,
            ["year", "period_label", "gender", "age_group", "value", "dataset_code"],
            {"value": "labour_force_thousands"}, ["period_label", "gender", "age_group"]),
    }


NAME = "mart"


def spread(flat: DataFrame, base: str) -> DataFrame:
    """All filtered marts over one flat mart in one frame: a row once for every mart it belongs to, with the mart's name.

    The flat mart is read once, whatever the number of marts. Columns that a mart does not have are NULL in its rows, and
    what it renames is renamed by :func:`mart_of`.
    """
    mine = {name: mart for name, mart in marts().items() if mart.base == base}
    columns = [c for c in flat.columns if any(c in m.columns for m in mine.values())]
    belongs = F.array_compact(F.array(*[F.when(m.where, F.lit(name)) for name, m in mine.items()]))
    rows = flat.withColumn(NAME, F.explode(belongs))
    return rows.select(*[F.when(F.col(NAME).isin([n for n, m in mine.items() if c in m.columns]), F.col(c)).alias(c) for c in columns], NAME)


def mart_of(table: DataFrame, name: str) -> DataFrame:
    """One mart of a table that :func:`spread` has made."""
    mart = marts()[name]
    return table.filter(F.col(NAME) == name).select(*[F.col(c).alias(mart.renamed.get(c, c)) for c in mart.columns])


def register(flats: dict[str, DataFrame]) -> list[str]:
    """Expose the flat and filtered marts of the given domains as temporary views; returns their names."""
    names = []
    for name, flat in flats.items():
        flat.createOrReplaceTempView(f"vw_{name}")
        names.append(f"vw_{name}")
    for name, mart in marts().items():
        if mart.base in flats:
            mart.of(flats[mart.base]).createOrReplaceTempView(f"vw_{name}")
            names.append(f"vw_{name}")
    return names


def paired(left: DataFrame, right: DataFrame, keys: list[str], left_value: str, right_value: str) -> DataFrame:
    """Two indicators of different domains side by side on territory and year."""
    r = right.select(*keys, F.col("value").alias(right_value))
    return left.withColumnRenamed("value", left_value).join(r, keys)


def period_dimension(labels: DataFrame, column: str) -> DataFrame:
    """One row per period: frequency, year, quarter, month, first and last day."""
    label = F.col("period_code")
    periods = labels.select(F.col(column).alias("period_code")).filter(label.isNotNull()).distinct()
    freq, ordinal = frequency_of(label), ordinal_of(label)
    year = F.substring(label, 1, 4).try_cast("int")
    month = F.when(freq == "M", F.substring(label, 6, 2).try_cast("int"))
    quarter = F.when(freq == "Q", F.substring(label, 7, 1).try_cast("int"))
    first_month = F.coalesce(month, quarter * 3 - 2, F.lit(1))
    months = F.when(freq == "M", F.lit(1)).when(freq == "Q", F.lit(3)).otherwise(F.lit(12))
    start = F.make_date(year, first_month, F.lit(1))
    return periods.filter(freq != "?").select(
        label, freq.alias("frequency"), year.cast("bigint").alias("year"), quarter.alias("quarter"),
        month.alias("month"), start.alias("start_date"),
        F.date_sub(F.add_months(start, months), 1).alias("end_date"), ordinal.alias("ordinal"))


def headline(flat: DataFrame, breakdowns: dict[str, str], age: str = "age_group",
             bands: dict[str, str] = HEADLINE_AGE) -> DataFrame:
    """``<breakdown>_is_total`` per breakdown and ``is_headline``: all at their total and the indicator's own age
    band. A breakdown that is absent counts as a total."""
    band = F.create_map(*[F.lit(x) for kv in bands.items() for x in kv])
    flags = {f"{b}_is_total": total_or_absent(b, t) for b, t in breakdowns.items()}
    everything = F.lit(True)
    for b in breakdowns:
        everything = everything & F.col(f"{b}_is_total")
    own_band = F.coalesce(F.col(age) == F.try_element_at(band, F.col("indicator_code")), F.lit(False))
    return flat.withColumns(flags).withColumn("is_headline", everything & own_band)


def headline_rates(flat: DataFrame, breakdowns: dict[str, str], provider: str = "istat", home: str = "IT"
                   ) -> DataFrame:
    """Annual headline rates of the home country at every territorial level, from one provider."""
    rows = headline(flat, breakdowns).filter(
        (F.col("provider") == provider) & (F.col("country_code") == home) & (F.col("frequency") == "A")
        & F.col("is_headline"))
    return rows.select("year", "nuts_code", "nuts_level", "nuts_name_it", "macro_area", "indicator_code", "value",
                       "unit", "dataset_code")


# ---- fixed values: total code of each breakdown ----
TOTALS = {
    "social_economy": {"gender": "total", "education": "TOTAL", "labour_status": "TOTAL", "volunteering_form": "TOTAL"},
    "labour": {"gender": "total", "education": "TOTAL", "citizenship": "TOTAL"},
}


def labelled(flat: DataFrame, name: str, codes: DataFrame | None = None) -> DataFrame:
    """A flat mart with ``<breakdown>_is_total`` per breakdown, ``is_headline``, and ``<breakdown>_label``.

    ``codes`` is a code list (breakdown, provider, code, label); without one, or for a code it does not name, the code
    itself is the label.
    """
    out = headline(flat, TOTALS[name])
    for b in TOTALS[name]:
        label = F.col(b)
        if codes is not None:
            table = codes.filter(F.col("breakdown") == b).groupBy(
                fold(F.col("provider")).alias("_label_provider"), fold(F.col("code")).alias("_label_code")).agg(F.min("label").alias("_label"))
            out = left_join_spread(out, table, [(fold(F.col("provider")), "_label_provider"), (fold(F.col(b)), "_label_code")])
            label = F.coalesce("_label", F.col(b))
        out = out.withColumn(f"{b}_label", label).drop("_label_provider", "_label_code", "_label")
    return out
