"""Helpers of this package: reading columns that may be missing, and joins on keys that may be hot."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import checkpointed, is_plain_scan

BLANKS = r"\x20\x09-\x0D"            # what separates words, for a regular expression's character class
WORDS = f"[^{BLANKS}]+"


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """All words of a text, in order (a native array)."""
    return F.array_remove(F.split(text, f"[{BLANKS}]+"), "")


def as_scan(df: DataFrame) -> DataFrame:
    """``df`` itself if each of its rows has a place in a file, else a written copy."""
    if is_plain_scan(df):
        try:
            df.select(df.metadataColumn("_metadata")["row_index"])
            return df
        except AnalysisException:      # files whose rows have no number, such as lines of text
            pass
    return checkpointed(df)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, a scan (see :func:`as_scan`), with a row number that is unique but has gaps.

    It is made of the number of the row's file, files in order of their paths, and the row's place in the file. So it is
    the same in every evaluation, however the scan is split, which follows from the cores there are at that moment and
    the columns read. The table of files has one row per file and is broadcast.
    """
    place = df.metadataColumn("_metadata")
    files = checkpointed(df.select(place["file_path"].alias("_file")).distinct()
                         .withColumn("_number", F.row_number().over(Window.orderBy("_file"))))
    return (
        df.select("*", place["file_path"].alias("_file"), place["row_index"].alias("_at"))
        .join(F.broadcast(files), "_file")
        .withColumn(name, F.shiftleft(F.col("_number").cast("long"), 40).bitwiseOR(F.col("_at")))
        .drop("_file", "_at", "_number")
    )


def join_on_hot_key(left: DataFrame, right: DataFrame, key: str, share: int = 1000, sizes: DataFrame | None = None) -> DataFrame:
    """Left join on one key of which any value may hold a third of ``left``; ``right`` has a key at most once.

    Keys with more than one ``share``-th of the left rows are at most ``share`` - 1 by counting, whatever the size: they
    are joined by broadcast. Every other key holds too few rows to burden a task and goes through an ordinary shuffle
    join; rows without a key skip the join. ``left`` is evaluated more than once: pass something written, or a scan.
    ``sizes``: rows of ``left`` per key (``key``, ``_n``) where they are known already.
    """
    if sizes is None:
        sizes = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    counts = checkpointed(sizes)
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = counts.filter(F.col("_n") * share > total).select(key)
    extra = [c for c in right.columns if c != key]
    hot_right = checkpointed(right.join(F.broadcast(hot), key, "left_semi"))
    by_broadcast = left.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(hot_right), key, "left")
    by_shuffle = left.join(F.broadcast(hot), key, "left_anti").filter(F.col(key).isNotNull()).join(right, key, "left")
    kinds = dict(right.dtypes)
    without = left.filter(F.col(key).isNull()).withColumns({c: F.lit(None).cast(kinds[c]) for c in extra})
    columns = [*left.columns, *extra]
    return by_broadcast.select(columns).unionByName(by_shuffle.select(columns)).unionByName(without.select(columns))


def from_text(df: DataFrame, text: str, added: str, make: Callable[[], Callable[[list], list[list]]],
              rows: int = 512) -> DataFrame:
    """``df`` without its text, with columns made of it in Python.

    ``make`` runs once per task and gives a function from texts to one list per added column. All other columns pass
    through as Arrow data, whatever they are, nulls included; only ``rows`` texts at a time become Python strings.
    """
    kept = df.drop(text)
    extra = StructType.fromDDL(added)
    source = df.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(text).cast("string").alias("_text"))
    kinds = [f.type for f in to_arrow_schema(extra)]
    names = [*kept.columns, *extra.names]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answer = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = answer(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *(pa.array(c, k) for c, k in zip(made, kinds))], names=names)

    return source.mapInArrow(work, StructType([*kept.schema.fields, *extra.fields]))
