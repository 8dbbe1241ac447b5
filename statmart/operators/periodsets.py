"""Sets of calendar periods as bitmaps, and the free labels beside them as rows.

A period of a known frequency has an ordinal (:func:`periods.ordinal_of`). Sixty of them share a word, one bit each, so a
set is a few rows (key, frequency, word, bits) however many rows of data it comes from: ``bit_or`` builds it with map-side
combine, ``&``, ``|`` and ``~`` on the words compare two sets, and ``bit_count`` counts. Sixty rather than 64 bits keep the
sign out of it. (The built-in bitmaps of 4 KB have no AND NOT.) Labels of no known frequency have no ordinal; they stay
rows and are never gathered into a list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.periods import frequency_of, label_of, ordinal_of

WORD = 60
FREE = "?"


def period_sets(periods: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``period`` -> ``frequency``, ``word`` and ``bits`` per key; free labels are left out (see
    :func:`free_labels`)."""
    ordinal = ordinal_of(F.col("period"))
    known = periods.select(*keys, frequency_of(F.col("period")).alias("frequency"), ordinal.alias("_o")).filter("_o is not null")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_o") % WORD).cast("int"))
    return known.groupBy(*keys, "frequency", F.expr(f"_o div {WORD}").alias("word")).agg(F.bit_or(bit).alias("bits"))


def free_labels(periods: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct labels of no known frequency per key."""
    return periods.filter(F.col("period").isNotNull() & (frequency_of(F.col("period")) == FREE)).select(*keys, "period").distinct()


def _first_bit(bits: Column) -> Column:
    return F.bit_count(bits.bitwiseAND(-bits) - 1)


def _last_bit(bits: Column) -> Column:
    return F.length(F.bin(bits)) - 1


def summary(sets: DataFrame, free: DataFrame, keys: list[str]) -> DataFrame:
    """``n_periods``, ``first_period`` and ``latest_period`` per key and frequency, free labels as frequency ``?``."""
    in_words = sets.filter("bits <> 0").groupBy(*keys, "frequency").agg(
        F.sum(F.bit_count("bits")).cast("bigint").alias("n_periods"),
        F.min(F.col("word") * WORD + _first_bit(F.col("bits"))).alias("_first"),
        F.max(F.col("word") * WORD + _last_bit(F.col("bits"))).alias("_last"))
    known = in_words.select(*keys, "frequency", "n_periods", label_of(F.col("frequency"), F.col("_first")).alias("first_period"),
                            label_of(F.col("frequency"), F.col("_last")).alias("latest_period"))
    other = free.groupBy(*keys).agg(F.count("*").alias("n_periods"), F.min("period").alias("first_period"), F.max("period").alias("latest_period"))
    return known.unionByName(other.withColumn("frequency", F.lit(FREE)))


def paired(current: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """Words of two sets side by side: ``now`` and ``then``, 0 where a set has none of that word."""
    on = [*keys, "frequency", "word"]
    sides = [current.select(*on, F.col("bits").alias("now")), previous.select(*on, F.col("bits").alias("then"))]
    # words are few and keyed alike: stacked and added up, which treats a null key like any other
    stacked = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return stacked.groupBy(*on).agg(*[F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(c) for c in ("now", "then")])


def differences(pairs: DataFrame) -> DataFrame:
    """``added`` (now and not then) and ``gone`` (then and not now) of :func:`paired`, as words."""
    now, then = F.col("now"), F.col("then")
    return pairs.withColumns({"added": now.bitwiseAND(F.bitwise_not(then)), "gone": then.bitwiseAND(F.bitwise_not(now))})


def members(bits: Column, word: Column, frequency: Column) -> Column:
    """Labels of the periods of one word, in order: at most ``WORD``."""
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(bits, i) == 1)
    return F.transform(places, lambda i: label_of(frequency, word * WORD + i))


def unpacked(sets: DataFrame, keys: list[str], bits: str = "bits") -> DataFrame:
    """A set as rows again: ``period`` and ``frequency`` per key."""
    some = sets.filter(F.col(bits) != 0)
    return some.select(*keys, "frequency", F.explode(members(F.col(bits), F.col("word"), F.col("frequency"))).alias("period"))


def shared(sets: list[DataFrame], keys: list[str]) -> DataFrame:
    """Periods that all of the sets have, as a set."""
    on = [*keys, "frequency", "word"]
    renamed = [s.select(*on, F.col("bits").alias(f"_{i}")) for i, s in enumerate(sets)]
    joined = reduce(lambda a, b: a.join(b, on), renamed)
    both = reduce(lambda a, b: a.bitwiseAND(b), [F.col(f"_{i}") for i in range(len(sets))])
    return joined.select(*on, both.alias("bits")).filter("bits <> 0")
