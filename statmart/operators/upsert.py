"""Dimension maintenance without a row-level table format: build the new contents, then publish them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import checkpointed
from .align import column_or_null, enforce_schema
from .dedup import keep_last
from .keys import contiguous_keys, max_key


def clean_incoming(incoming: DataFrame, natural: list[str], ordinal: str | None = None) -> DataFrame:
    """Drop rows with an incomplete natural key; of repeated keys keep the last."""
    complete = incoming.filter(reduce(and_, [F.col(c).isNotNull() for c in natural]))
    return keep_last(complete, natural, ordinal) if ordinal else complete.dropDuplicates(natural)


def upsert_dimension(existing: DataFrame, incoming: DataFrame, schema: StructType, key: str, natural: list[str],
                     ordinal: str | None = None, action: str | None = None) -> DataFrame:
    """Matched rows keep their key and take every other attribute from ``incoming``; new rows get the next keys,
    in natural key order; rows only in ``existing`` stay as they are.

    ``action`` adds a column saying kept, updated or inserted for each row.
    """
    fresh = clean_incoming(incoming, natural, ordinal)
    attributes = [f for f in schema if f.name != key and f.name not in natural]
    new_side = fresh.select(
        *[F.col(c).alias(f"_n_{c}") for c in natural],
        F.struct(F.lit(True).alias("_hit"),
                 *[column_or_null(fresh, f.name, f.dataType).alias(f.name) for f in attributes]).alias("_new"))
    on = reduce(and_, [F.col(c) == F.col(f"_n_{c}") for c in natural])
    hit = F.col("_new").isNotNull()
    current = existing.join(new_side, on, "left").select(
        F.col(key), *[F.col(c) for c in natural],
        *[F.when(hit, F.col(f"_new.{f.name}")).otherwise(F.col(f.name)).alias(f.name) for f in attributes],
        F.when(hit, "updated").otherwise("kept").alias("_action"))
    inserted = numbered_inserts(existing, fresh, schema, key, natural).withColumn("_action", F.lit("inserted"))
    out = current.unionByName(inserted)
    columns = [F.col(f.name) for f in schema]
    return out.select(*columns, F.col("_action").alias(action)) if action else out.select(*columns)


def numbered_inserts(existing: DataFrame, fresh: DataFrame, schema: StructType, key: str,
                     natural: list[str]) -> DataFrame:
    """Rows of ``fresh`` whose natural key is not known yet, numbered after the largest key in use."""
    unknown = fresh.join(existing.select(*natural), natural, "left_anti")
    body = checkpointed(enforce_schema(unknown, StructType([f for f in schema if f.name != key])))   # the sort samples it
    return contiguous_keys(body, natural, key, after=max_key(existing, key)).select(*schema.names)


def insert_unseen(existing: DataFrame, codes: DataFrame, derive: dict[str, Column], schema: StructType, key: str,
                  natural: str) -> DataFrame:
    """Add codes that occur in data but not in the dimension, with attributes derived from the code alone."""
    seen = codes.select(natural).filter(F.length(natural) >= 2).distinct()
    fresh = seen.withColumns(derive)
    return existing.select(*schema.names).unionByName(numbered_inserts(existing, fresh, schema, key, [natural]))


def retire_missing(dimension: DataFrame, listed: DataFrame, natural: str, origin: str, managed: list[str],
                   active: str = "is_active") -> DataFrame:
    """Mark rows of managed origin inactive when their code is no longer listed; nothing is deleted."""
    codes = listed.select(F.col(natural).alias("_listed")).distinct()
    gone = F.col(origin).isin(managed) & F.col("_listed").isNull()
    return (
        dimension.join(codes, F.col(natural) == F.col("_listed"), "left")
        .withColumn(active, F.when(F.coalesce(gone, F.lit(False)), F.lit(False)).otherwise(F.col(active)))
        .drop("_listed")
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (NULL keeps the row)."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def change_counts(upserted: DataFrame, action: str) -> DataFrame:
    """Inserted and updated row counts, and the table's size."""
    return upserted.agg(
        F.count_if(F.col(action) == "inserted").alias("n_inserted"),
        F.count_if(F.col(action) == "updated").alias("n_updated"),
        F.count("*").alias("n_rows"),
    )
