"""Declared schemas. The column lists are the contract with readers of the tables (fixed values)."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType(),
         "boolean": BooleanType(), "timestamp": TimestampType()}


def ddl(text: str) -> StructType:
    """'a string, b bigint' as a schema. Unlike ``StructType.fromDDL`` it needs no running session."""
    fields = [part.split() for part in text.split(",")]
    return StructType([StructField(name, TYPES[type_]) for name, type_ in fields])


RAW_METADATA = ["source_id", "dataset_code", "extracted_at"]

# ---- processed layer; legal_form_code is what the legal-form key is resolved on ----
PROCESSED = {
    "social_economy": ddl("""
        source_id string, dataset_code string, indicator_code string, value double, unit string, time bigint,
        nuts_code string, nuts_level bigint, country_code string, nuts_name_it string, nuts_name_en string,
        macro_area string, legal_form_unified string, legal_form_unified_en string, ets_classification string,
        nace_code string, nace_label_en string, gender string, age_group string, volunteering_form string,
        activity_type string, years_active string, education string, labour_status string, household_size string,
        econ_resources string, municipality_type string, org_sector string, org_type string, motivation string,
        personal_impact string, multi_membership string, association_type string, priority bigint,
        extracted_at timestamp, geo_unmatched boolean, legal_form_unmatched boolean, legal_form_code string"""),
    "labour": ddl("""
        source_id string, dataset_code string, indicator_code string, value double, unit string, time bigint,
        frequency string, period_label string, nuts_code string, nuts_level bigint, country_code string,
        nuts_name_it string, nuts_name_en string, macro_area string, legal_form_unified string,
        legal_form_unified_en string, ets_classification string, nace_code string, nace_label_en string,
        gender string, age_group string, education string, citizenship string, adjustment string,
        unemployment_duration string, priority bigint, extracted_at timestamp, geo_unmatched boolean,
        legal_form_unmatched boolean"""),
}

# ---- dimensions ----
DIMENSIONS = {
    "dim_geography": ddl("""
        geo_key bigint, nuts_code string, nuts_level bigint, nuts_name_it string, nuts_name_en string,
        istat_code string, country_code string, region_name string, macro_area string, municipality_type string,
        geo_source string, is_active boolean"""),
    "dim_time": ddl("""
        time_key bigint, year bigint, period_type string, period_label string, reference_period string"""),
    "dim_source": ddl("""
        source_key bigint, source_id string, provider string, source_name string, source_name_it string,
        domain string, access_type string, priority bigint, update_frequency string, territorial_levels string,
        temporal_coverage string, notes string"""),
    "dim_legal_form": ddl("""
        legal_form_key bigint, unified_category string, unified_category_en string, nace_primary string,
        ets_classification string, source_system string, source_code string, source_label_it string"""),
    "dim_indicator": ddl("""
        indicator_key bigint, indicator_code string, label_it string, label_en string, unit_default string,
        domain string, notes string"""),
}
SURROGATE_KEY = {
    "dim_geography": "geo_key", "dim_time": "time_key", "dim_source": "source_key",
    "dim_legal_form": "legal_form_key", "dim_indicator": "indicator_key",
}
NATURAL_KEY = {
    "dim_geography": ["nuts_code"], "dim_time": ["year"], "dim_source": ["source_id"],
    "dim_legal_form": ["source_system", "source_code"], "dim_indicator": ["indicator_code"],
}

# ---- facts ----
_KEYS = """fact_key bigint, geo_key bigint, time_key bigint, source_key bigint, indicator_key bigint,
           value double, unit string, """
_TAIL = ", dataset_code string, extracted_at timestamp"

FACTS = {
    "fact_social_economy": ddl(_KEYS + """
        legal_form_key bigint, ets_classification string, nace_code string, nace_label_en string, gender string,
        age_group string, volunteering_form string, activity_type string, years_active string, education string,
        labour_status string, household_size string, econ_resources string, municipality_type string,
        org_sector string, org_type string, motivation string, personal_impact string, multi_membership string,
        association_type string""" + _TAIL),
    "fact_labour": ddl(_KEYS + """
        frequency string, period_label string, gender string, age_group string, education string,
        citizenship string, adjustment string, unemployment_duration string, nace_code string,
        nace_label_en string""" + _TAIL),
    # declared, not yet loaded
    "fact_immigration": ddl(_KEYS + "gender string, age_group string" + _TAIL),
    "fact_welfare": ddl(_KEYS + "gender string, age_group string" + _TAIL),
    "fact_poverty": ddl(_KEYS + "gender string, age_group string" + _TAIL),
    "fact_sdg": ddl(_KEYS + "sdg_goal string, sdg_target string" + _TAIL),
    "fact_civil_society": ddl(_KEYS + "gender string" + _TAIL),
    "fact_housing": ddl(_KEYS + "tenure_type string, gender string, age_group string" + _TAIL),
}

LOAD_LOG = ddl("domain string, file string, n_rows bigint, loaded_at timestamp")
CHECK_RESULT = ddl("table string, check string, status string, observed string, expected string, detail string")
