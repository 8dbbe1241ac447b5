"""Rules a written paragraph must pass before it may open a report, over a table of candidate texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import thousands_it
from ..functions.periods import MONTH_NAMES, month_year_it
from ..functions.strings import all_but_last, strip

# ---- fixed values: words a paragraph may not contain ----
NUMBER_WORDS = ["due", "tre", "quattro", "cinque", "sei", "sette", "otto", "nove", "dieci", "undici", "dodici",
                "tredici", "quattordici", "quindici", "sedici", "diciassette", "diciotto", "diciannove", "venti",
                "trenta", "quaranta", "cinquanta", "cento", "mille", "mila", "milion[ei]", "dozzin[ae]", "decin[ae]",
                "centinai[oa]"]
QUANTIFIERS = ["tutt[ie]", "nessun[oa]?", "metà", "maggioranza", "maggior parte", "entramb[ie]", "totalità"]
TREND_WORDS = [r"aument\w*", r"diminu\w*", r"cresc\w*", "cal[oi]", r"riduzion\w*", r"ridott\w*", r"miglior\w*",
               r"peggior\w*", "record"]
BANNED = {"number word": NUMBER_WORDS, "quantifier": QUANTIFIERS, "trend word": TREND_WORDS,
          "month name": MONTH_NAMES}
PLACEHOLDER = r"\{([a-z_]+)\}"
FORMATTING = r"[\n\r#*|`\[\]<>]"
MIN_CHARS, MAX_CHARS = 80, 700
OFFERED_COUNTS = ["n_aggiornati", "n_nuovi_periodi", "n_non_aggiornati", "n_mancanti", "n_nuovi_dataset"]
# ---------------------------------------------------------


def word_pattern(words: list[str]) -> str:
    """Whole words, any case, with Unicode word boundaries ('metà' ends in a letter).

    The look-ahead on first letters rejects most positions before the costlier boundary test.
    """
    initials = "".join(sorted({w[0] for w in words}))
    return rf"(?iU)(?=[{initials}])\b(?:" + "|".join(words) + r")\b"


def first_match(text: Column, pattern: str) -> Column:
    return F.regexp_substr(text, F.lit(pattern))


def placeholders(text: Column) -> Column:
    """Distinct placeholder names in the text, sorted."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(text, F.lit(PLACEHOLDER), F.lit(1))))


def substitute(text: Column, values: Column) -> Column:
    """Put the values in place of their placeholders; names without a value stay as they are."""
    return F.aggregate(
        F.map_entries(values), text,
        lambda t, e: F.replace(t, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]))


def name_list(names: Column) -> Column:
    """['a', 'b'] as text."""
    return F.concat(F.lit("["), F.array_join(F.transform(
        names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", "), F.lit("]"))


def flags(text: Column) -> dict[str, Column]:
    """The first offending word per rule (NULL when none), and the character rules."""
    t = strip(text)
    return {
        "is_empty": F.coalesce(t, F.lit("")) == "",
        "has_digits": t.rlike(r"\d"),
        **{name.replace(" ", "_"): first_match(t, word_pattern(words)) for name, words in BANNED.items()},
        "has_formatting": t.rlike(FORMATTING),
    }


def _staged(texts: DataFrame, text: str, values: Column) -> DataFrame:
    """Stripped text, the placeholders in it and its final wording, computed once per row for the rules below."""
    return texts.withColumn("_text", F.coalesce(strip(F.col(text)), F.lit(""))).withColumns({
        "_found": placeholders(F.col("_text")), "_offered": F.map_keys(values),
        "_final": substitute(F.col("_text"), values)})


def _rules(max_chars: int) -> Column:
    t, found, offered = F.col("_text"), F.col("_found"), F.col("_offered")
    unknown = F.sort_array(F.array_except(found, offered))
    missing = F.sort_array(F.array_except(offered, found))
    n = F.length("_final")
    rules = [F.when(t.rlike(r"\d"), F.lit("contains digits"))]
    # concat is NULL when there is no offending word
    rules += [F.concat(F.lit(f"{name}: '"), first_match(t, word_pattern(words)), F.lit("'"))
              for name, words in BANNED.items()]
    rules += [
        F.when(t.rlike(FORMATTING), F.lit("formatting characters")),
        F.when(F.size(unknown) > 0, F.concat(F.lit("unknown placeholders: "), name_list(unknown))),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing placeholders: "), name_list(missing))),
        F.when(F.regexp_replace(t, PLACEHOLDER, "").rlike("[{}]"), F.lit("stray braces")),
        F.when((F.size(unknown) == 0) & (n > max_chars),
               F.concat(F.lit("too long: "), n.cast("string"), F.lit(" characters")))
        .when((F.size(unknown) == 0) & (n < MIN_CHARS),
              F.concat(F.lit("too short: "), n.cast("string"), F.lit(" characters"))),
    ]
    return F.array_compact(F.array(*rules))


def checked(texts: DataFrame, text: str, values: Column, max_chars: int = MAX_CHARS) -> DataFrame:
    """Every candidate with the reasons to reject it (an empty array means none) and, when accepted, its final
    wording."""
    out = _staged(texts, text, values).withColumn("problems", _rules(max_chars))
    out = out.withColumn("problems", F.when(F.col("_text") == "", F.array(F.lit("empty response")))
                         .otherwise(F.col("problems")))
    ok = F.size("problems") == 0
    return out.withColumns({"accepted": ok, "final_text": F.when(ok, F.col("_final"))}).drop(
        "_text", "_found", "_offered", "_final")


def first_accepted(attempts: DataFrame, group: list[str], rank: str, template: Column | None = None) -> DataFrame:
    """Per group: the accepted text of lowest rank, else the template; the number of attempts.

    An aggregate, so a group with any number of candidates is reduced before the shuffle.
    """
    best = F.min_by("final_text", F.when(F.col("accepted"), F.col(rank)))
    used = F.min(F.when(F.col("accepted"), F.col(rank)))
    out = attempts.groupBy(*group).agg(best.alias("_best"), used.alias("chosen_rank"), F.count("*").alias("n_attempts"))
    fallback = template if template is not None else F.lit(None).cast("string")
    chosen = F.col("chosen_rank").isNotNull()
    return out.select(
        *group, F.when(chosen, F.col("_best")).otherwise(fallback).alias("text"),
        F.when(chosen, F.lit("candidate")).otherwise(F.lit("template")).alias("source"), "chosen_rank", "n_attempts")


def offered_values(totals: DataFrame, facts: DataFrame, labels: DataFrame, limit: int = 3) -> DataFrame:
    """One row with ``values``: the placeholders a paragraph may use. NULL for a first release.

    Counts that are zero are not offered; the datasets with new periods are named when there are one to three names.
    """
    fresh = facts.filter(F.coalesce(F.size("new_periods") > 0, F.lit(False))).select("domain", "dataset_code")
    shown = labels.select(F.col("dataset_code").alias("_code"), F.col("label_it").alias("_label"))
    per_name = (
        fresh.join(shown, F.col("dataset_code") == F.col("_code"), "left")
        .groupBy(F.coalesce("_label", "dataset_code").alias("name"))
        .agg(F.min(F.struct("domain", "dataset_code")).alias("_first"))
    )
    # one more than the limit is enough to know that there are too many to name
    top = per_name.orderBy("_first").limit(limit + 1).withColumn("_i", F.row_number().over(Window.orderBy("_first")))
    names = top.agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "name"))), lambda s: s["name"])).scalar()
    row = totals.withColumn("_names", names)
    few = F.size("_names").between(1, limit)
    offers = {
        "mese": month_year_it(F.col("month")),
        "n_dataset": thousands_it(F.col("n_dataset")),
        "mese_precedente": F.when(F.col("previous_month").isNotNull(), month_year_it(F.col("previous_month"))),
        **{c: F.when(F.col(c) > 0, thousands_it(F.col(c))) for c in OFFERED_COUNTS},
        "elenco_nuovi_periodi": F.when(few, all_but_last(F.col("_names"))),
    }
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in offers.items()])
    kept = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return row.select(F.when(~F.col("prima_rilevazione"), kept).alias("values"))
