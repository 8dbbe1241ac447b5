"""Bring frames to a declared schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StringType, StructType

from ..functions.strings import strip


def first_present(df: DataFrame, names: list[str]) -> str | None:
    """First of ``names`` that is a column. A choice on the schema, so the plan holds no CASE for it."""
    return next((n for n in names if n in df.columns), None)


def column_or_null(df: DataFrame, name: str | None, type_: str | DataType = "string") -> Column:
    return F.col(name).cast(type_) if name and name in df.columns else F.lit(None).cast(type_)


def enforce_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Add absent columns as NULL, put them in order, drop the rest. Types are cast strictly."""
    return df.select(*[column_or_null(df, f.name, f.dataType).alias(f.name) for f in schema])


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the declared types, NULL where a value does not fit; undeclared columns keep their own type."""
    declared = {f.name: f.dataType for f in schema}
    out = []
    for f in df.schema:
        target = declared.get(f.name)
        if target is None or target == f.dataType:
            out.append(F.col(f.name))
        elif isinstance(target, StringType):
            out.append(F.lit(None).cast("string").alias(f.name))   # only text may fill a text column
        else:
            out.append(F.col(f.name).try_cast(target).alias(f.name))
    return df.select(*out)


def unknown_columns(df: DataFrame, schema: StructType) -> list[str]:
    return [c for c in df.columns if c not in schema.names]


def stack(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; columns missing from one are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def trimmed(df: DataFrame) -> DataFrame:
    """Strip every string column."""
    return df.select(*[
        strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema
    ])
