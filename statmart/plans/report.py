"""The release report: Italian lines built from release facts (one row per dataset).

The Italian texts are fixed values: readers and tests know them word for word.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import signed_it, thousands_it
from ..functions.periods import FREQUENCY_ORDER, date_it, frequency_of, frequency_rank, month_year_it, ordinal_of, \
    period_it, run_it
from ..functions.strings import all_but_last, map_literal
from ..operators.diff import runs
from ..registry import DOMAINS, inline
from ..session import checkpointed
from .release import has_new

DOMAIN_LABELS = {name: d.label_it for name, d in DOMAINS.items() if d.enabled}


def domain_label(domain: Column) -> Column:
    return F.coalesce(map_literal(DOMAIN_LABELS, domain), domain)


def dataset_name(code: Column, label: Column, publisher: Column, domain: Column | None = None) -> Column:
    """'**Label** (Lavoro, ISTAT, `code`)'; the code alone when it has no label."""
    quoted = F.concat(F.lit("`"), code, F.lit("`"))
    inside = F.concat_ws(", ", *([domain] if domain is not None else []), F.when(label.isNotNull(), publisher), quoted)
    title = F.when(label.isNotNull(), F.concat(F.lit("**"), label, F.lit("**"))).otherwise(quoted)
    return F.concat(title, F.lit(" ("), inside, F.lit(")"))


def ordered_by_frequency(entries: DataFrame, keys: list[str], text: str, out: str, sep: str) -> DataFrame:
    """One text per key from one text per frequency, monthly first."""
    packed = F.sort_array(F.collect_list(F.struct(frequency_rank(F.col("frequency")).alias("r"), F.col(text).alias("t"))))
    return entries.groupBy(*keys).agg(F.array_join(F.transform(packed, lambda s: s["t"]), sep).alias(out))


def periods_in_words(periods: DataFrame, keys: list[str], out: str = "periods_it") -> DataFrame:
    """Periods of each key in words: consecutive ones become runs ('da maggio a settembre 2026 (5 mesi)')."""
    rows = periods.select(*keys, "period").withColumn("frequency", frequency_of(F.col("period")))
    known = rows.filter("frequency != '?'").withColumn("ordinal", ordinal_of(F.col("period")))
    grouped = runs(known, [*keys, "frequency"], "ordinal").groupBy(*keys, "frequency").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_runs"), F.sum("length").alias("_n"))
    words = F.array_join(F.transform("_runs", lambda r: run_it(F.col("frequency"), r["first"], r["last"])), ", ")
    suffix = F.when((F.col("frequency") == "M") & (F.col("_n") > 1),
                    F.concat(F.lit(" ("), F.col("_n").cast("string"), F.lit(" mesi)"))).otherwise(F.lit(""))
    texts = grouped.select(*keys, "frequency", F.concat(words, suffix).alias("_t"))
    free = rows.filter("frequency = '?'").distinct().groupBy(*keys, "frequency").agg(
        F.array_join(F.sort_array(F.collect_list("period")), ", ").alias("_t"))
    return ordered_by_frequency(texts.unionByName(free), keys, "_t", out, "; ")


def latest_in_words(latest: Column) -> Column:
    """'II trimestre 2026 / 2025' from the latest period of each frequency."""
    return F.array_join(F.array_compact(F.array(*[
        period_it(F.try_element_at(latest, F.lit(f))) for f in FREQUENCY_ORDER])), " / ")


def _plural(n: Column, one: str, many: str) -> Column:
    return F.when(n == 1, F.lit(one)).otherwise(F.lit(many))


def summary_sentence(totals: DataFrame) -> DataFrame:
    """The opening paragraph from the one-row release totals."""
    month, previous = month_year_it(F.col("month")), month_year_it(F.col("previous_month"))
    total, updated, fresh = (F.col(c) for c in ("n_dataset", "n_aggiornati", "n_nuovi_periodi"))
    n_total = thousands_it(total)
    compared = F.when(F.col("previous_month").isNotNull(), F.concat(F.lit("rispetto a "), previous)) \
        .otherwise(F.lit("rispetto all'elaborazione precedente"))
    opening = F.concat(F.lit("Riepilogo dell'aggiornamento dati di "), month, F.lit(", "), compared, F.lit("."))
    none_updated = F.concat(F.lit("Nessuno dei "), n_total, F.lit(
        " dataset monitorati è stato scaricato di nuovo dalla fonte."))
    some_updated = F.concat(
        F.lit("Dei "), n_total, F.lit(" dataset monitorati, "), thousands_it(updated), F.lit(" "),
        _plural(updated, "è stato scaricato", "sono stati scaricati"), F.lit(" di nuovo dalla fonte"),
        F.when(fresh > 0, F.concat(F.lit(" e "), thousands_it(fresh), F.lit(" "),
                                   _plural(fresh, "contiene", "contengono"), F.lit(" periodi nuovi.")))
        .otherwise(F.lit(", ma nessuno contiene periodi nuovi.")))
    only_new = F.when((updated == 0) & (fresh > 0), F.concat(
        F.lit("Periodi nuovi in "), thousands_it(fresh), F.lit(" dataset.")))

    def issue(column: str, before: str, one: str, many: str) -> Column:
        n = F.col(column)
        return F.when(n > 0, F.concat(thousands_it(n), F.lit(before), _plural(n, one, many)))

    issues = F.array_compact(F.array(
        issue("n_non_aggiornati", " dataset non ", "aggiornato", "aggiornati"),
        issue("n_mancanti", " ", "mancante", "mancanti"),
        issue("n_nuovi_dataset", " ", "nuovo", "nuovi")))
    to_check = F.when(F.size(issues) > 0, F.concat(F.lit("Da verificare: "), all_but_last(issues), F.lit(".")))
    first = F.concat(
        F.lit("Questo è il primo riepilogo per "), month, F.lit(
            ": non esiste un'elaborazione precedente con cui confrontare i "), n_total, F.lit(" dataset monitorati."))
    regular = F.concat_ws(" ", opening, F.when(updated == 0, none_updated).otherwise(some_updated), only_new, to_check)
    return totals.select("*", F.when(F.col("prima_rilevazione"), first).otherwise(regular).alias("sentence"))


def new_period_lines(facts: DataFrame) -> DataFrame:
    """Section 'new periods': one line per dataset that has some."""
    keys = ["domain", "dataset_code"]
    exploded = facts.filter(has_new()).select(
        *keys, F.explode("new_periods").alias("frequency", "_p")).select(*keys, F.explode("_p").alias("period"))
    words = periods_in_words(exploded, keys)
    unnamed = F.col("n_new_periods") - F.size(F.flatten(F.map_values("new_periods")))     # free labels beyond those in the map
    more = F.when(unnamed > 0, F.concat(F.lit(" e altri "), thousands_it(unnamed))).otherwise("")
    return facts.filter(has_new()).join(words, keys).withColumn(
        "line", F.concat(F.lit("- "), F.col("name"), F.lit(": "), F.col("periods_it"), more, F.lit(".")))


def issue_lines(facts: DataFrame, month: str) -> DataFrame:
    """Section 'to verify': datasets not updated, missing or new."""
    latest = latest_in_words(F.col("latest_period"))
    when = (
        F.when(F.col("last_extracted_on").isNotNull(),
               F.concat(F.lit("ultima estrazione disponibile: "), date_it(F.col("last_extracted_on"))))
        .when(F.col("previous_month").isNotNull(), F.lit("assente anche nell'elaborazione precedente"))
        .otherwise(F.lit("nessuna elaborazione precedente")))
    status, name = F.col("status"), F.concat(F.lit("- "), F.col("name"))
    line = (
        F.when(status == "not_updated", F.concat(
            name, F.lit(": non aggiornato. I dati risalgono all'estrazione del "), date_it(F.col("extracted_on")),
            F.lit(" (ultimo periodo: "), latest, F.lit(").")))
        .when(status == "missing", F.concat(name, F.lit(": assente dal file elaborato ("), when, F.lit(").")))
        .when(status == "new_dataset", F.concat(
            name, F.lit(": nuovo dataset, assente nell'elaborazione precedente."))))
    return facts.withColumn("line", line).filter(F.col("line").isNotNull())


def unprocessed_lines(facts: DataFrame, month: str) -> DataFrame:
    """One line per domain that was not processed this month."""
    reference = month_year_it(F.lit(month))
    return facts.filter("domain_status = 'not_processed'").select("domain").distinct().withColumn(
        "line", F.concat(F.lit("- Il dominio "), domain_label(F.col("domain")), F.lit(" non è stato elaborato in "),
                         reference, F.lit(".")))


def other_lines(facts: DataFrame) -> DataFrame:
    """Table rows of the datasets with nothing new."""
    change = F.coalesce(signed_it(F.col("rows_change")), F.lit("n.d."))
    return facts.filter(F.col("status").isin("updated", "baseline") & ~has_new()).withColumn("line", F.concat(
        F.lit("| "), domain_label(F.col("domain")), F.lit(" | "), F.col("plain_name"), F.lit(" | "),
        latest_in_words(F.col("latest_period")), F.lit(" | "), change, F.lit(" |")))


def named(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """Facts with the display name of each dataset; ``labels`` has dataset_code, fonte and label_it."""
    lookup = labels.select(F.col("dataset_code").alias("_code"), F.col("label_it").alias("_label"),
                           F.col("fonte").alias("_publisher")).dropDuplicates(["_code"])
    joined = facts.join(lookup, F.col("dataset_code") == F.col("_code"), "left")
    parts = (F.col("dataset_code"), F.col("_label"), F.col("_publisher"))
    return joined.withColumns({
        "name": dataset_name(*parts, domain_label(F.col("domain"))),
        "plain_name": dataset_name(*parts)}).drop("_code", "_label", "_publisher")


SECTIONS = {
    "new": (20, "## Nuovi periodi disponibili"),
    "issues": (30, "## Da verificare"),
    "others": (40, "## Altri dataset"),
}
TABLE_HEAD = ["| Dominio | Dataset | Ultimo periodo | Variazione righe |", "|---|---|---|---|"]
TABLE_NOTE = ("Le variazioni nel numero di righe possono derivare da dati arrivati in ritardo alla fonte oppure da "
              "modifiche alla pipeline.")


def report_lines(facts: DataFrame, labels: DataFrame, totals: DataFrame, month: str, generated_on: date,
                 title: str = "Aggiornamento dati", paragraph: str | None = None, origin: str = "esecuzione locale",
                 domain_order: list[str] | None = None) -> DataFrame:
    """(section, position, domain, dataset_code, line): the whole report, in the order of the first four columns.

    A section without rows has no heading either. ``paragraph`` replaces the built sentence when given.
    """
    order = domain_order or list(DOMAINS)
    rank = F.coalesce(F.array_position(F.array(*[F.lit(d) for d in order]), F.col("domain")), F.lit(0)).cast("int")
    rows = checkpointed(named(facts, labels))   # one row per dataset, read by every section

    def body(df: DataFrame, section: int, position: int = 10) -> DataFrame:
        code = F.col("dataset_code") if "dataset_code" in df.columns else F.lit("")
        return df.select(F.lit(section).alias("section"), (F.lit(position) + rank).alias("position"),
                         code.alias("dataset_code"), "line")

    # one line per dataset or domain: written once, since the headings depend on which sections have any
    lines = checkpointed(reduce(DataFrame.unionByName, [
        body(new_period_lines(rows), 20), body(unprocessed_lines(rows, month), 30, 10), body(issue_lines(rows, month), 30, 1000),
        body(other_lines(rows), 40)]))
    headings = inline(facts.sparkSession, [
        (section, place, "", line) for section, top, bottom in (
            (20, [SECTIONS["new"][1], ""], [""]), (30, [SECTIONS["issues"][1], ""], [""]),
            (40, [SECTIONS["others"][1], "", *TABLE_HEAD], ["", TABLE_NOTE, ""]))
        for start, texts in ((0, top), (9000, bottom)) for place, line in enumerate(texts, start)],
        "section int, position int, dataset_code string, line string")
    sentence = summary_sentence(totals)
    text = F.lit(paragraph) if paragraph is not None else F.col("sentence")
    frame = sentence.select(F.explode(F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(place).alias("position"), F.lit("").alias("dataset_code"), line.alias("line"))
        for section, texts in (
            (10, [F.concat(F.lit(f"# {title}: "), month_year_it(F.col("month"))), F.lit(""), text, F.lit("")]),
            (90, [F.lit("---"), F.lit(""), F.concat(
                F.lit("_Generato automaticamente il "), date_it(F.lit(generated_on)),
                F.lit(f" ({origin}). Il riepilogo descrive quali dati sono stati aggiornati e non riporta valori statistici._"))]))
        for place, line in enumerate(texts)])).alias("l")).select("l.*")
    return frame.unionByName(headings.join(lines.select("section").distinct(), "section", "left_semi").select(lines.columns)) \
        .unionByName(lines)


ORDER = ["section", "position", "dataset_code"]
