"""Code lookups against mapping tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import HOME, country_of, level_of
from ..functions.strings import fold, has_many
from .keys import left_join_spread

CROSSWALK_FIELDS = ["nuts_code", "nuts_level", "nuts_name_it", "nuts_name_en", "region_name", "macro_area"]

# ---- fixed values: territory codes of older editions ----
OLD_LETTERS = r"^IT[DE][0-9A-Z]{0,2}$"     # third letter D became H, E became I
OLD_DIGITS = r"^IT\d{3}$"                   # country + three-digit province number
# ---------------------------------------------------------


def crosswalk_index(crosswalk: DataFrame, local: str = "istat_code", code: str = "nuts_code",
                    fields: list[str] = CROSSWALK_FIELDS, ordinal: str = "ord") -> DataFrame:
    """One row per lookup key with what it means as a local code and as a target code.

    A repeated local code takes its last row, a repeated target code its first. Packed codes ('A;B') cannot be
    looked up as target codes. Both readings sit in one table, so each lookup pass is one join to the same relation.
    """
    fields = [f for f in fields if f in crosswalk.columns]
    unit = F.struct(*[F.col(f) for f in fields])
    as_local = crosswalk.select(fold(F.col(local)).alias("key"), F.col(ordinal), unit.alias("unit"),
                                F.lit("local").alias("reading"))
    as_code = (
        crosswalk.filter(~has_many(F.col(code)))
        .select(fold(F.col(code)).alias("key"), F.col(ordinal), unit.alias("unit"), F.lit("code").alias("reading"))
    )
    both = as_local.unionByName(as_code).filter(F.coalesce(F.col("key") != "", F.lit(False)))
    return both.groupBy("key").agg(
        F.max_by(F.when(F.col("reading") == "local", F.col("unit")),
                 F.when(F.col("reading") == "local", F.col(ordinal))).alias("local_unit"),
        F.min_by(F.when(F.col("reading") == "code", F.col("unit")),
                 F.when(F.col("reading") == "code", F.col(ordinal))).alias("code_unit"),
    )


def modern_code(code: Column) -> Column:
    """Key under which a code of an older edition is found today; NULL when it is not such a code."""
    letters = F.concat(F.lit("IT"), F.translate(F.substring(code, 3, 1), "DE", "HI"), F.substring(code, 4, 2))
    return F.when(code.rlike(OLD_LETTERS), letters).when(code.rlike(OLD_DIGITS), F.substring(code, 3, 3))


def territory_lookup(df: DataFrame, index: DataFrame, geo: Column, code: str = "nuts_code",
                     prefix: str = "_unit") -> DataFrame:
    """Add struct column ``prefix``: the unit found by local code, else by target code, else by modernised code.

    The whole struct comes from the first pass whose target code is present, so names never mix between passes.
    """
    key = fold(geo.cast("string"))
    now = index.select(F.col("key").alias("_k1"), F.col("local_unit").alias("_local"), F.col("code_unit").alias("_code"))
    old = index.select(F.col("key").alias("_k2"), F.col("local_unit").alias("_old_local"),
                       F.col("code_unit").alias("_old_code"))
    joined = (
        df.withColumn("_key", key).withColumn("_modern", modern_code(F.col("_key")))
        .join(now, F.col("_key") == F.col("_k1"), "left")
    )
    joined = left_join_spread(joined, old, [(F.col("_modern"), "_k2")])
    old_unit = F.when(F.col("_key").rlike(OLD_LETTERS), F.col("_old_code")).otherwise(F.col("_old_local"))
    unit = (
        F.when(F.col(f"_local.{code}").isNotNull(), F.col("_local"))
        .when(F.col(f"_code.{code}").isNotNull(), F.col("_code"))
        .otherwise(old_unit)
    )
    return joined.withColumn(prefix, unit).drop(
        "_key", "_modern", "_k1", "_k2", "_local", "_code", "_old_local", "_old_code")


def local_territory(df: DataFrame, index: DataFrame, geo: Column, home: str = HOME) -> DataFrame:
    """Territory columns for a source with its own code list."""
    found = territory_lookup(df, index, geo)
    fields = [f for f in CROSSWALK_FIELDS if f in found.schema["_unit"].dataType.names]
    return (
        found.withColumns({
            **{f: F.col(f"_unit.{f}") for f in fields if f != "nuts_level"},
            "nuts_level": F.col("_unit.nuts_level").try_cast("bigint"),
            "country_code": F.lit(home),
            "geo_unmatched": F.col("_unit.nuts_code").isNull(),
        }).drop("_unit")
    )


def standard_territory(df: DataFrame, geo: Column) -> DataFrame:
    """Territory columns for a source that already uses the target code list: no lookup."""
    code = fold(geo)
    return df.withColumns({"nuts_code": code, "nuts_level": level_of(code), "country_code": country_of(code)})


def territory(df: DataFrame, provider: str, geo: Column, index: DataFrame | None = None) -> DataFrame:
    """The right territory rule for a provider; an unknown provider is an error."""
    rules = {"istat": lambda: local_territory(df, index, geo), "eurostat": lambda: standard_territory(df, geo)}
    if provider not in rules:
        raise ValueError(f"no territory rule for provider '{provider}'")
    return rules[provider]()


def ambiguous_keys(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys mapped to more than one value; NULL counts as a value of its own."""
    n = F.count_distinct(F.col(value)) + F.max(F.col(value).isNull().cast("int"))
    return df.groupBy(key).agg(n.cast("bigint").alias("n_values")).filter("n_values > 1")


LEGAL_FORM_FIELDS = {
    "unified_category": "legal_form_unified", "unified_category_en": "legal_form_unified_en",
    "nace_primary": "nace_primary", "ets_classification": "ets_classification",
}


def legal_forms(df: DataFrame, mapping: DataFrame, provider: Column, code: Column, present: Column,
                ordinal: str = "ord") -> DataFrame:
    """Unified legal form attributes, looked up among the codes of the row's own source system.

    Rows of a dataset without a legal form column (``present`` false) get NULLs and are not counted as unmatched.
    """
    names = list(LEGAL_FORM_FIELDS)
    lookup = (
        mapping.groupBy(F.col("source_system").alias("_lk_system"), fold(F.col("source_code")).alias("_lk_form"))
        .agg(F.max_by(F.struct(*names), F.col(ordinal)).alias("_found"))
    )
    keyed = df.withColumns({"_own_system": provider, "_own_form": F.when(present, fold(code.cast("string")))})
    on = (F.col("_own_system") == F.col("_lk_system")) & (F.col("_own_form") == F.col("_lk_form"))
    return (
        keyed.join(lookup, on, "left")
        .withColumns({
            **{out: F.col(f"_found.{c}") for c, out in LEGAL_FORM_FIELDS.items()},
            "legal_form_unmatched": present & F.col("_found.unified_category").isNull(),
        })
        .drop("_own_system", "_own_form", "_lk_system", "_lk_form", "_found")
    )


def with_label(df: DataFrame, labels: DataFrame, on: str, label: str, out: str) -> DataFrame:
    """Label of a code, the code itself when it has none."""
    table = labels.select(F.col(on).alias("_on"), F.col(label).alias("_label"))
    return (
        df.join(table, F.col(on) == F.col("_on"), "left")
        .withColumn(out, F.coalesce(F.col("_label"), F.col(on))).drop("_on", "_label")
    )


def code_list(df: DataFrame, codes: DataFrame, breakdown: str, column: str, provider: str = "provider",
              strict: bool = False) -> DataFrame:
    """Harmonised code, label, total flag and bounds of a breakdown code.

    A NULL code means the dataset has no such breakdown and counts as a total. ``strict`` makes an unlisted code an
    error at run time; otherwise ``<column>_unlisted`` marks it. The list is an input of known size, so Catalyst decides
    by bytes whether it is broadcast, and AQE splits a code with a third of all rows where it is not.
    """
    rows = codes.filter(F.col("breakdown") == breakdown).select(
        F.col("provider").alias("_p"), fold(F.col("code")).alias("_c"),
        F.struct("harmonised_code", "label", "is_total", "lower_bound", "upper_bound").alias("_entry"))
    on = (F.col(provider) == F.col("_p")) & (fold(F.col(column)) == F.col("_c"))
    out = df.join(rows, on, "left")
    unlisted = F.col(column).isNotNull() & F.col("_entry").isNull()
    harmonised = F.col("_entry.harmonised_code")
    if strict:
        harmonised = F.when(unlisted, F.raise_error(F.concat(F.lit(f"{breakdown}: unlisted code "), F.col(column)))) \
            .otherwise(harmonised)
    return out.withColumns({
        f"{column}_code": harmonised,
        f"{column}_label": F.col("_entry.label"),
        f"{column}_is_total": F.when(F.col(column).isNull(), F.lit(True)).otherwise(F.col("_entry.is_total")),
        f"{column}_from": F.col("_entry.lower_bound"),
        f"{column}_to": F.col("_entry.upper_bound"),
        f"{column}_unlisted": unlisted,
    }).drop("_p", "_c", "_entry")
