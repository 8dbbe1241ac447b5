"""One domain's landed datasets -> one processed table.

Schema choices (which column holds the territory, the time, ...) are made per dataset on its columns. From there on
all datasets travel in one union through one harmonisation pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.codes import HOME, in_scope, is_supranational, level_of, country_of
from ..functions.numbers import measured, to_number
from ..functions.periods import leading_year, period_label
from ..functions.strings import blank_to_null, fold, is_blank, map_literal, pad_to_two, strip
from ..operators.align import column_or_null, enforce_schema, first_present, stack
from ..operators.dedup import collisions, resolve_priority_located
from ..operators.lookups import ambiguous_keys, crosswalk_index, legal_forms, territory_lookup
from ..operators.scope import breakdown, sample_codes
from ..registry import (GENDER, GENDER_COLUMNS, GEO_COLUMNS, LEGAL_FORM_COLUMNS, PRIORITY, TIME_COLUMNS,
                        UNKNOWN_INDICATOR, UNKNOWN_UNIT, Dataset, Domain, dataset_table)
from ..schemas import PROCESSED
from ..sources.delimited import dataset_rows
from ..sources.layers import MonthFiles, Months

ROW_ID = "_row"   # file and position of a landed row

def aligned(df: DataFrame, dataset: Dataset, domain: Domain) -> DataFrame:
    """One raw dataset in the shared shape: chosen source columns under fixed names, breakdowns as text."""
    if "value" not in df.columns:
        raise ValueError(f"{dataset.code}: no column 'value'")
    df = dataset_rows(df, dataset)
    cube = dataset.provider == "eurostat"
    geo = ("geo" if "geo" in df.columns else None) if cube else first_present(df, GEO_COLUMNS[domain.name])
    time = first_present(df, TIME_COLUMNS)
    form = None if cube else first_present(df, LEGAL_FORM_COLUMNS)
    gender = None if cube else first_present(df, GENDER_COLUMNS)

    territory = strip(column_or_null(df, geo))
    if domain.pad_codes and not cube:
        territory = pad_to_two(territory)
    if dataset.home_detail_only and geo:
        df = df.filter(in_scope(F.col(geo)))
    chosen: dict[str, Column] = {
        "dataset_code": F.lit(dataset.code),
        "provider": F.lit(dataset.provider),
        "_geo": territory,
        "_has_geo": F.lit(geo is not None or cube),
        "_form": column_or_null(df, form),
        "_has_form": F.lit(form is not None),
        "_gender": column_or_null(df, gender),
        "_nace": fold(column_or_null(df, "nace_r2")) if cube else F.lit(None).cast("string"),
        "time": column_or_null(df, time),
        "value": measured(to_number(F.col("value"))),
        "extracted_at": column_or_null(df, "extracted_at").try_cast("timestamp"),
    }
    if ROW_ID in df.columns:
        chosen[ROW_ID] = F.col(ROW_ID)
    axis_of = {out: axis for axis, out in domain.cube_axes.items()} if cube else {}
    for name in breakdowns(domain):
        source = axis_of.get(name, name)
        chosen[name] = column_or_null(df, source if source in df.columns else name)
    if cube and domain.cube_axes:
        sex = next(a for a, out in domain.cube_axes.items() if out == "gender")
        chosen["gender"] = column_or_null(df, sex)
    else:
        chosen["gender"] = F.lit(None).cast("string")
    return df.select(*[c.alias(n) for n, c in chosen.items()]).filter(F.col("value").isNotNull())


def breakdowns(domain: Domain) -> list[str]:
    """Processed columns that are copied from the raw data as they are."""
    derived = {
        "source_id", "dataset_code", "indicator_code", "value", "unit", "time", "nuts_code", "nuts_level",
        "country_code", "nuts_name_it", "nuts_name_en", "macro_area", "legal_form_unified", "legal_form_unified_en",
        "ets_classification", "nace_code", "nace_label_en", "gender", "priority", "extracted_at", "geo_unmatched",
        "legal_form_unmatched", "legal_form_code"}
    return [c for c in PROCESSED[domain.name].names if c not in derived]


def harmonised(df: DataFrame, crosswalk: DataFrame, forms: DataFrame, activities: DataFrame) -> DataFrame:
    """Territory, legal form, sex and activity codes of all datasets at once."""
    known = df.withColumn("provider", F.when(
        F.col("provider").isin("istat", "eurostat"), F.col("provider")
    ).otherwise(F.raise_error(F.concat(F.lit("no territory rule for provider "), F.col("provider")))))
    local = F.col("provider") == "istat"
    found = territory_lookup(known, crosswalk_index(crosswalk), F.when(local & F.col("_has_geo"), F.col("_geo")))
    code = fold(F.col("_geo"))
    national = ~F.col("_has_geo")

    def unit(name: str) -> Column:
        return F.col(f"_unit.{name}")

    located = found.withColumns({
        "nuts_code": F.when(national, HOME).when(local, unit("nuts_code")).otherwise(code),
        "nuts_level": F.when(national, F.lit(0)).when(local, unit("nuts_level").try_cast("bigint"))
                       .otherwise(level_of(code)),
        "country_code": F.when(national | local, F.lit(HOME)).otherwise(country_of(code)),
        "nuts_name_it": F.when(national, F.lit("Italia")).when(local, unit("nuts_name_it")),
        "nuts_name_en": F.when(national, F.lit("Italy")).when(local, unit("nuts_name_en")),
        "macro_area": F.when(local & ~national, unit("macro_area")),
        "geo_unmatched": F.when(national, F.lit(False)).when(local, unit("nuts_code").isNull()),
    }).drop("_unit")
    located = located.withColumn("legal_form_code", F.when(F.col("_has_form"), fold(F.col("_form"))))
    formed = legal_forms(located, forms, F.col("provider"), F.col("_form"), F.col("_has_form"))
    named = formed.withColumn("gender", F.when(local, map_literal(GENDER, fold(F.col("_gender")))).otherwise(F.col("gender")))
    return with_activity_labels(named.withColumnRenamed("_nace", "nace_code"), activities) \
        .withColumn("legal_form_unmatched", F.when(local, F.col("legal_form_unmatched")))


def with_activity_labels(df: DataFrame, activities: DataFrame) -> DataFrame:
    """``nace_label_en`` of each row's ``nace_code``; of a code listed twice the last line counts."""
    labels = activities.groupBy(F.col("nace_code").alias("_code")).agg(
        F.max_by("label_en", "ord").alias("nace_label_en"))
    return df.join(labels, F.col("nace_code") == F.col("_code"), "left").drop("_code")


def tagged(df: DataFrame, domain: str, providers: dict[str, int] = PRIORITY) -> DataFrame:
    """Indicator, unit and source priority of every row's dataset; unregistered datasets get the unknown pair."""
    registry = dataset_table(df.sparkSession, domain).select(
        F.col("dataset_code").alias("_code"), "indicator_code", "unit")
    return (
        df.join(registry, F.col("dataset_code") == F.col("_code"), "left").drop("_code")
        .withColumns({
            "indicator_code": F.coalesce("indicator_code", F.lit(UNKNOWN_INDICATOR)),
            "unit": F.coalesce("unit", F.lit(UNKNOWN_UNIT)),
            "source_id": F.col("provider"),
            "priority": map_literal(providers, F.col("provider")).cast("bigint"),
        })
    )


def unify_sex_codes(df: DataFrame, column: str = "gender") -> DataFrame:
    """One list of sex codes for all providers, so that priority also works between them (optional)."""
    return df.withColumn(column, F.coalesce(map_literal(GENDER, fold(F.col(column))), F.col(column)))


def merge_domain(domain: Domain, raw: dict[str, DataFrame], crosswalk: DataFrame, forms: DataFrame,
                 activities: DataFrame, full_grain: bool = False, same_sex_codes: bool = False) -> DataFrame:
    """The processed table of one domain from its landed datasets (dataset code -> rows)."""
    registered = {d.code: d for d in domain.datasets}
    frames = [aligned(df, registered[code], domain) for code, df in raw.items() if code in registered]
    if not frames:
        spark = crosswalk.sparkSession
        return spark.createDataFrame([], PROCESSED[domain.name])
    rows = tagged(harmonised(stack(frames), crosswalk, forms, activities), domain.name)
    if same_sex_codes:
        rows = unify_sex_codes(rows)
    identified = all(ROW_ID in f.columns for f in frames)
    # only what the processed table holds goes through the shuffle, without supranational totals
    wanted = [c for c in PROCESSED[domain.name].names if c in rows.columns] + [ROW_ID] * identified
    keys = domain.full_grain if full_grain else domain.dedup_keys
    rows = resolve_priority_located(
        rows.select(*wanted).filter(~is_supranational(F.col("nuts_code"))), "nuts_code", keys, "priority", "extracted_at", "dataset_code", "value",
        row_id=ROW_ID if identified else None)
    return finished(rows, domain)


def finished(rows: DataFrame, domain: Domain) -> DataFrame:
    """Full period label kept where the domain has one, time cut to the year."""
    full = F.col("time")
    if domain.sub_annual:
        rows = rows.withColumn("period_label", period_label(F.col("period_label"), full))
    rows = rows.withColumns({"time": leading_year(full), "nuts_code": blank_to_null(F.col("nuts_code"))})
    return enforce_schema(rows, PROCESSED[domain.name])


def read_raw(spark: SparkSession, root: str, domain: Domain, before: str | None = None,
             failed: dict[str, str] | None = None, layer: Months | None = None) -> dict[str, DataFrame]:
    """Newest landed snapshot of every registered dataset of a domain, each row with its file and position.

    A snapshot that cannot be opened is noted in ``failed`` and left out, so that the other datasets go on.
    """
    layer = layer or MonthFiles(spark, f"{root}/{domain.name}")
    months = layer.newest([d.code for d in domain.datasets], before)
    position = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    frames = {}
    for code, month in sorted(months.items()):
        try:
            found = layer.open(code, month)
            if "value" not in found.columns:
                raise ValueError("no column 'value'")
            frames[code] = found.withColumn(ROW_ID, position)
        except Exception as e:  # noqa: BLE001  named after the rest has been written
            if failed is None:
                raise
            failed[code] = f"{type(e).__name__}: {e}"
    return frames


def merge_reports(domain: Domain, raw: dict[str, DataFrame], processed: DataFrame, crosswalk: DataFrame,
                  forms: DataFrame) -> dict[str, DataFrame]:
    """What a merge leaves to be looked at, one small table each.

    ``breakdown``: processed rows per source, indicator and unit. ``unmatched_territories`` and ``unmatched_forms``: the
    first codes without a match per dataset, with counts. ``ambiguous_territories`` and ``ambiguous_forms``: mapping keys
    with several meanings. ``collisions``: what the dedup keys merged although a breakdown outside of them differs.
    """
    registered = {d.code: d for d in domain.datasets}
    landed = stack([aligned(df, registered[code], domain) for code, df in raw.items() if code in registered])
    local = landed.filter((F.col("provider") == "istat") & F.col("_has_geo"))
    found = territory_lookup(local.select("dataset_code", "_geo"), crosswalk_index(crosswalk), F.col("_geo"))
    formed = legal_forms(landed.filter((F.col("provider") == "istat") & F.col("_has_form")).select("dataset_code", "provider", "_form"),
                         forms, F.col("provider"), F.col("_form"), F.lit(True))
    keyed = tagged(landed, domain.name).withColumns({"nuts_code": fold(F.col("_geo")), "nace_code": F.col("_nace")})
    keys = [k for k in domain.dedup_keys if k in keyed.columns]
    return {
        "breakdown": breakdown(processed),
        "unmatched_territories": sample_codes(found.filter("_unit.nuts_code is null"), ["dataset_code"], "_geo", 10),
        "unmatched_forms": sample_codes(formed.filter("legal_form_unmatched"), ["dataset_code"], "_form", 10),
        "ambiguous_territories": ambiguous_keys(crosswalk.withColumn("key", fold(F.col("istat_code"))).filter("key <> ''"), "key", "nuts_code"),
        "ambiguous_forms": ambiguous_keys(
            forms.withColumn("key", F.concat_ws("/", "source_system", fold(F.col("source_code")))), "key", "unified_category"),
        "collisions": collisions(keyed.filter(~is_blank(F.col("nuts_code"))), keys, ["indicator_code", "dataset_code"]),
    }
