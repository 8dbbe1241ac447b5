"""Several groupings of one table in one scan and one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed

_SET = "_set"


def grouped_once(df: DataFrame, sets: dict[str, list[str]], measures: dict[str, Column] | None = None,
                 repeated: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Name -> the groups of its columns with ``n_rows`` and the measures.

    All groupings are grouping sets of one aggregate: the table is scanned once, rows are combined before the one shuffle,
    and ``grouping_id`` tells the sets apart, so that a NULL in a column is not taken for a column left out. The result is
    written with the set as a partition, and each frame reads its own. Of the sets in ``repeated`` only groups of more
    than one row are kept: a unique key leaves nothing behind.
    """
    columns = list(dict.fromkeys(c for wanted in sets.values() for c in wanted))
    short = {c: f"_c{i}" for i, c in enumerate(columns)}
    ids = {name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in wanted) for name, wanted in sets.items()}
    measures = measures or {}
    rows = df.withColumns({short[c]: F.col(c) for c in columns})      # measures see the columns that grouping would blank out
    distinct = list(dict.fromkeys(ids.values()))
    by_id = {ids[name]: wanted for name, wanted in sets.items()}
    grouped = rows.groupingSets([[F.col(short[c]) for c in by_id[i]] for i in distinct], *[F.col(short[c]) for c in columns]).agg(
        F.count(F.lit(1)).alias("n_rows"), *[m.alias(n) for n, m in measures.items()], F.grouping_id().alias(_SET))
    whole = {ids[n] for n in sets if n not in repeated}
    kept = grouped.filter(F.col(_SET).isin(list(whole)) | (F.col("n_rows") > 1)) if whole else grouped.filter("n_rows > 1")
    written = checkpointed(kept.withColumn(_SET, F.col(_SET).cast("string")), by=[_SET])
    out = {}
    for name, wanted in sets.items():
        mine = written.filter(F.col(_SET) == str(ids[name]))
        if name in repeated:
            mine = mine.filter("n_rows > 1")
        out[name] = mine.select(*[F.col(short[c]).alias(c) for c in wanted], "n_rows", *measures)
    return out
