"""String expressions with the whitespace and blank rules used everywhere."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

BLANKS = " \t\n\r\x0b\x0c "


def strip(c: Column) -> Column:
    """Remove surrounding whitespace of every kind, not only spaces."""
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    s = strip(c)
    return F.when(s != "", s)


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def fold(c: Column) -> Column:
    """Lookup form of a code: stripped, upper case."""
    return F.upper(strip(c))


def pad_to_two(c: Column) -> Column:
    """Left-pad with zeros to width two; longer codes are left whole (``lpad`` alone would cut them)."""
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def map_literal(mapping: Mapping[str, object], key: Column) -> Column:
    """Look ``key`` up in a small fixed mapping, NULL when absent. No join, no UDF."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def has_many(c: Column) -> Column:
    """Codes packed with ``;`` stand for several units at once."""
    return F.coalesce(F.contains(c, F.lit(";")), F.lit(False))


def unpack(c: Column) -> Column:
    return F.split(c, ";")


def all_but_last(xs: Column, sep: str = ", ", last: str = " e ") -> Column:
    """'a, b e c' from an array of strings; one element stays alone; NULL for an empty array."""
    n = F.size(xs)
    head = F.array_join(F.slice(xs, F.lit(1), F.greatest(n - 1, F.lit(0))), sep)
    return (
        F.when(n == 1, F.get(xs, F.lit(0)))
        .when(n > 1, F.concat(head, F.lit(last), F.get(xs, n - 1)))
    )
