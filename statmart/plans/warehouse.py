"""Dimensions and fact tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.codes import EXTRA_REGIO, HOME, country_of, scope_reason
from ..functions.numbers import to_whole
from ..functions.periods import any_year
from ..functions.strings import blank_to_null, fold, has_many, strip
from ..operators.align import enforce_schema, typed, unknown_columns
from ..operators.keys import KeyLookup, contiguous_keys, resolve_keys, resolved
from ..operators.scope import classify
from ..operators.upsert import delete_where, insert_unseen, retire_missing, upsert_dimension
from ..registry import YEAR_RANGE, Domain, indicator_table
from ..schemas import DIMENSIONS, FACTS, NATURAL_KEY, SURROGATE_KEY
from ..session import checkpointed

log = logging.getLogger("statmart")

# ---- fixed values: origin of a territory row ----
FROM_CROSSWALK, FROM_AGGREGATE, FROM_DATA = "nuts_istat_csv", "istat_aggregate", "eurostat_auto"
MANAGED = [FROM_CROSSWALK, FROM_AGGREGATE]


def geography_rows(crosswalk: DataFrame) -> DataFrame:
    """Territory rows from the crosswalk. Packed codes are published aggregates without a level, so that no sum over
    a level counts them twice."""
    code = F.coalesce(
        blank_to_null(F.col("nuts_code")),
        F.when(strip(F.col("istat_code")).startswith(HOME), strip(F.col("istat_code"))))
    rows = crosswalk.withColumn("nuts_code", code).filter(F.col("nuts_code").isNotNull())
    packed = has_many(F.col("nuts_code"))
    text = ["nuts_name_it", "nuts_name_en", "istat_code", "region_name", "macro_area"]
    return rows.filter(~F.col("nuts_code").rlike(EXTRA_REGIO)).withColumns({
        **{c: blank_to_null(F.col(c)) for c in text},
        "nuts_level": F.when(~packed, to_whole(F.col("nuts_level"))),
        "country_code": F.lit(HOME),
        "geo_source": F.when(packed, FROM_AGGREGATE).otherwise(FROM_CROSSWALK),
        "is_active": F.lit(True),
    })


def refresh_geography(dim: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Upsert from the crosswalk, retire codes it no longer lists, remove codes that are no territory."""
    rows = geography_rows(crosswalk)
    new = upsert_dimension(dim, rows, DIMENSIONS["dim_geography"], "geo_key", ["nuts_code"], "ord")
    new = retire_missing(new, rows, "nuts_code", "geo_source", MANAGED)
    return delete_where(new, F.col("nuts_code").rlike(EXTRA_REGIO)).select(*DIMENSIONS["dim_geography"].names)


def year_rows(spark: SparkSession, years: tuple[int, int] = YEAR_RANGE) -> DataFrame:
    label = F.col("id").cast("string")
    return spark.range(years[0], years[1] + 1).select(
        F.col("id").alias("year"), F.lit("A").alias("period_type"), label.alias("period_label"),
        label.alias("reference_period"))


def source_rows(sources: DataFrame) -> DataFrame:
    """Source rows with a numeric priority; the provider is the text before the first underscore if not given."""
    rows = sources.withColumn("priority", to_whole(F.col("priority")))
    if "provider" not in rows.columns:
        rows = rows.withColumn("provider", F.substring_index("source_id", "_", 1))
    return rows


def refresh_dimension(name: str, dim: DataFrame, rows: DataFrame, ordinal: str | None = None) -> DataFrame:
    return upsert_dimension(dim, rows, DIMENSIONS[name], SURROGATE_KEY[name], NATURAL_KEY[name], ordinal)


def refresh_dimensions(dims: dict[str, DataFrame], crosswalk: DataFrame, sources: DataFrame,
                       forms: DataFrame) -> dict[str, DataFrame]:
    """All five shared dimensions after an upsert from their reference data."""
    spark = crosswalk.sparkSession
    return {
        "dim_geography": refresh_geography(dims["dim_geography"], crosswalk),
        "dim_time": refresh_dimension("dim_time", dims["dim_time"], year_rows(spark)),
        "dim_source": refresh_dimension("dim_source", dims["dim_source"], source_rows(sources), "ord"),
        "dim_legal_form": refresh_dimension("dim_legal_form", dims["dim_legal_form"], forms, "ord"),
        "dim_indicator": refresh_dimension("dim_indicator", dims["dim_indicator"], indicator_table(spark)),
    }


def add_unseen_territories(dim: DataFrame, codes: DataFrame) -> DataFrame:
    """Codes that occur in the data but not in the dimension: level and country follow from the code."""
    code = F.col("nuts_code")
    derive = {
        "nuts_level": F.when(F.length(code) <= 5, (F.length(code) - 2).cast("bigint")),
        "country_code": country_of(code),
        "geo_source": F.lit(FROM_DATA),
        "is_active": F.lit(True),
    }
    return insert_unseen(dim, codes, derive, DIMENSIONS["dim_geography"], "geo_key", "nuts_code")


def in_scope_rows(processed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows for the fact table, quarantined rows with a reason), codes stripped."""
    stripped = processed.withColumn("nuts_code", strip(F.col("nuts_code")))
    return classify(stripped, scope_reason(F.col("nuts_code")))


def fact_lookups(dims: dict[str, DataFrame], by_form_code: bool = False) -> list[KeyLookup]:
    """Territory, time, source and indicator are required, the legal form is not."""
    source = F.concat_ws("_", strip(F.col("source_id")), strip(F.col("dataset_code")))
    lookups = [
        KeyLookup("geo_key", dims["dim_geography"], {"nuts_code": F.col("nuts_code")}),
        KeyLookup("time_key", dims["dim_time"], {"year": any_year(F.col("time"))}),
        KeyLookup("source_key", dims["dim_source"], {"source_id": source}),
        KeyLookup("indicator_key", dims["dim_indicator"], {"indicator_code": F.col("indicator_code")}),
    ]
    if by_form_code:
        lookups.append(KeyLookup(
            "legal_form_key", dims["dim_legal_form"],
            {"source_system": fold(F.col("source_id")), "source_code": fold(F.col("legal_form_code"))},
            required=False, folded=True))
    return lookups


def with_keys(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """All rows with their surrogate keys and, where a required one was not found, which."""
    by_code = "legal_form_code" in rows.columns
    out = resolve_keys(rows, fact_lookups(dims, by_code))
    return out if by_code else out.withColumn("legal_form_key", F.lit(None).cast("bigint"))


def fact_table(keyed: DataFrame, name: str) -> DataFrame:
    """The table's declared columns, numbered 1..n along its grain."""
    schema = FACTS[name]
    consumed = ["source_id", "indicator_code", "nuts_code", "time", "unresolved_key"]   # replaced by keys
    unknown = [c for c in unknown_columns(keyed, schema) if c not in consumed]
    if unknown:
        log.warning("%s: columns not in the table schema, not loaded: %s", name, unknown)
    body = enforce_schema(typed(resolved(keyed), schema), schema).drop("fact_key")
    grain = [c for c in body.columns if c not in ("value", "extracted_at", "nace_label_en")]
    return contiguous_keys(body, grain, "fact_key").select(*schema.names)


def build_fact(domain: Domain, processed: DataFrame, dims: dict[str, DataFrame]
               ) -> tuple[DataFrame, dict[str, DataFrame], DataFrame, DataFrame]:
    """(fact table, dimensions with unseen territories added, out-of-scope rows, rows with unresolved keys)."""
    kept, out_of_scope = in_scope_rows(processed.drop("geo_unmatched", "legal_form_unmatched"))
    dims = {**dims, "dim_geography": add_unseen_territories(dims["dim_geography"], kept)}
    keyed = checkpointed(with_keys(kept, dims))   # read by the numbering, which samples it first, and by the quarantine
    return fact_table(keyed, domain.fact), dims, out_of_scope, keyed.filter(F.col("unresolved_key").isNotNull())
