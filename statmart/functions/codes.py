"""Territory code rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .strings import strip

# ---- fixed values ----
HOME = "IT"
EXTRA_REGIO = r"^[A-Z]{2}Z+$"          # activity that belongs to no region: ITZ, ITZZ, DEZ
SUPRANATIONAL = ["EU27_2020", "EU27", "EA", "EA19", "EA20"]
NOT_A_CODE = ["", "nan", "None", "<NA>"]
# ----------------------


def level_of(code: Column) -> Column:
    """Territorial level from the code length: 2 characters = country ... 5 = province. NULL otherwise."""
    n = F.length(code)
    return F.when(n.between(2, 5), (n - 2).cast("bigint"))


def country_of(code: Column) -> Column:
    return F.substring(code, 1, 2)


def is_extra_regio(code: Column) -> Column:
    return F.coalesce(code.rlike(EXTRA_REGIO), F.lit(False))


def is_supranational(code: Column, codes: list[str] = SUPRANATIONAL) -> Column:
    return F.coalesce(strip(code).isin(codes), F.lit(False))


def in_scope(code: Column, home: str = HOME) -> Column:
    """Country totals of every country, and every unit of the home country."""
    return (F.length(code) == 2) | code.startswith(home)


def scope_reason(code: Column, home: str = HOME, not_codes: list[str] = NOT_A_CODE) -> Column:
    """Why a row is kept or dropped: unmatched, extra_regio, foreign_subnational or keep."""
    c = strip(code)
    return (
        F.when(c.isNull() | c.isin(not_codes), F.lit("unmatched"))
        .when(c.rlike(EXTRA_REGIO), F.lit("extra_regio"))
        .when(in_scope(c, home), F.lit("keep"))
        .otherwise(F.lit("foreign_subnational"))
    )
