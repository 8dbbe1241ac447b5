"""Period labels of mixed grain: '2023', '2023-Q2', '2023-04'."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .strings import blank_to_null, strip

# ---- fixed values ----
MONTH = r"^\d{4}-\d{2}$"
QUARTER = r"^\d{4}-Q[1-4]$"
YEAR = r"^\d{4}$"
FREQUENCY_ORDER = ["M", "Q", "A", "?"]
MONTH_NAMES = ["gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno",
               "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre"]
QUARTER_NAMES = ["I", "II", "III", "IV"]
# ----------------------


def frequency_of(label: Column) -> Column:
    return (
        F.when(label.rlike(MONTH), F.lit("M"))
        .when(label.rlike(QUARTER), F.lit("Q"))
        .when(label.rlike(YEAR), F.lit("A"))
        .otherwise(F.lit("?"))
    )


def frequency_rank(freq: Column) -> Column:
    return F.array_position(F.array(*[F.lit(f) for f in FREQUENCY_ORDER]), freq).cast("int")


def ordinal_of(label: Column) -> Column:
    """Consecutive periods of one frequency get consecutive integers; NULL for free labels."""
    year = F.substring(label, 1, 4).try_cast("bigint")
    freq = frequency_of(label)
    return (
        F.when(freq == "M", year * 12 + F.substring(label, 6, 2).try_cast("bigint") - 1)
        .when(freq == "Q", year * 4 + F.substring(label, 7, 1).try_cast("bigint") - 1)
        .when(freq == "A", year)
    )


def label_of(freq: Column, ordinal: Column) -> Column:
    """Inverse of :func:`ordinal_of`."""
    return (
        F.when(freq == "M", F.format_string("%04d-%02d", F.floor(ordinal / 12), ordinal % 12 + 1))
        .when(freq == "Q", F.format_string("%04d-Q%d", F.floor(ordinal / 4), ordinal % 4 + 1))
        .when(freq == "A", F.format_string("%04d", ordinal))
    )


def leading_year(label: Column) -> Column:
    """Year when the label starts with four digits."""
    return F.regexp_substr(label, F.lit(r"^\d{4}")).try_cast("bigint")


def any_year(label: Column) -> Column:
    """Year from the first four digits found anywhere in the label."""
    return F.regexp_substr(label.cast("string"), F.lit(r"\d{4}")).try_cast("bigint")


def period_label(label: Column, time: Column) -> Column:
    """The full label, taken from the time column when the label is absent or empty."""
    return F.coalesce(F.nullif(label, F.lit("")), time)


def reference_period(label: Column, time: Column) -> Column:
    return strip(F.coalesce(label.cast("string"), time.cast("string")))


def month_name(month: Column) -> Column:
    return F.get(F.array(*[F.lit(m) for m in MONTH_NAMES]), (month - 1).cast("int"))


def month_year_it(label: Column) -> Column:
    """'2026-11' -> 'novembre 2026'."""
    return F.concat_ws(" ", month_name(F.substring(label, 6, 2).try_cast("int")), F.substring(label, 1, 4))


def date_it(day: Column) -> Column:
    """A date as '1º giugno 2026'."""
    number = F.when(F.dayofmonth(day) == 1, F.lit("1º")).otherwise(F.dayofmonth(day).cast("string"))
    return F.concat_ws(" ", number, month_name(F.month(day)), F.year(day).cast("string"))


def period_it(label: Column) -> Column:
    """One period in words: 'novembre 2026', 'II trimestre 2026', or the label itself."""
    quarter = F.get(F.array(*[F.lit(q) for q in QUARTER_NAMES]), F.substring(label, 7, 1).try_cast("int") - 1)
    freq = frequency_of(label)
    return (
        F.when(freq == "M", month_year_it(label))
        .when(freq == "Q", F.concat(quarter, F.lit(" trimestre "), F.substring(label, 1, 4)))
        .otherwise(label)
    )


def run_it(freq: Column, first: Column, last: Column) -> Column:
    """A run of consecutive ordinals in words, e.g. 'da maggio a settembre 2026'."""
    first_label, last_label = label_of(freq, first), label_of(freq, last)
    same_year = F.substring(first_label, 1, 4) == F.substring(last_label, 1, 4)
    opening = F.element_at(F.split(period_it(first_label), " "), 1)
    adjacent, single = last == first + 1, last == first

    def words(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    months = (
        F.when(single, period_it(first_label))
        .when(same_year, words("da ", opening, " a ", period_it(last_label)))
        .otherwise(words("da ", period_it(first_label), " a ", period_it(last_label)))
    )
    quarters = (
        F.when(single, period_it(first_label))
        .when(same_year & adjacent, words(opening, " e ", period_it(last_label)))
        .when(same_year, words("dal ", opening, " al ", period_it(last_label)))
        .otherwise(words("dal ", period_it(first_label), " al ", period_it(last_label)))
    )
    years = (
        F.when(single, words("anno ", first_label))
        .when(adjacent, words("anni ", first_label, " e ", last_label))
        .otherwise(words("dal ", first_label, " al ", last_label))
    )
    return F.when(freq == "M", months).when(freq == "Q", quarters).when(freq == "A", years)
