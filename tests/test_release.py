from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statmart.plans import release, report

SNAPSHOT = "dataset_code string, period_label string, time string, extracted_at string"
JAN, FEB = "2026-01-05T10:00:00+00:00", "2026-02-05T10:00:00+00:00"


@pytest.fixture(scope="module")
def facts(table):
    previous = table([("upd", None, "2024", JAN), ("same", "2024-Q1", "2024", JAN), ("gone", None, "2024", JAN),
                      ("upd", None, "2023", JAN)], SNAPSHOT)
    current = table([("upd", None, "2024", FEB), ("upd", "2025-01", "2025", FEB), ("upd", " 2025-02 ", "2025", FEB),
                     ("same", "2024-Q1", "2024", JAN), ("new", None, "2025", FEB), (None, None, "2025", FEB)], SNAPSHOT)
    expected = table([("upd",), ("same",), ("gone",), ("never",)], "dataset_code string")
    return release.domain_facts("labour", "2026-02", {"2026-02": current, "2026-01": previous}, expected).cache()


@pytest.fixture(scope="module")
def labels(table):
    return table([("upd", "ISTAT", "Tasso"), ("same", "Eurostat", "Occupati")], "dataset_code string, fonte string, label_it string")


def test_status(facts):
    assert rows(facts, "dataset_code", "status", "expected") == [
        ("gone", "missing", True), ("never", "missing", True), ("new", "new_dataset", False), ("same", "not_updated", True),
        ("upd", "updated", True)]


def test_changes(facts):
    r = {x["dataset_code"]: x for x in facts.collect()}
    assert r["upd"]["new_periods"] == {"M": ["2025-01", "2025-02"]} and r["upd"]["removed_periods"] == {"A": ["2023"]}
    assert r["upd"]["rows_change"] == 1 and r["upd"]["latest_period"] == {"A": "2024", "M": "2025-02"}
    assert r["same"]["new_periods"] == {} and r["new"]["new_periods"] is None
    assert r["gone"]["last_extracted_on"] == date(2026, 1, 5) and r["never"]["last_extracted_on"] is None


def test_first_release_is_a_baseline(table):
    current = table([("a", None, "2024", JAN)], SNAPSHOT)
    expected = table([("a",), ("b",)], "dataset_code string")
    got = release.domain_facts("labour", "2026-01", {"2026-01": current}, expected)
    assert rows(got, "dataset_code", "status") == [("a", "baseline"), ("b", "missing")]
    text = report.summary_sentence(release.totals(got, "2026-01")).first()["sentence"]
    assert text.startswith("Questo è il primo riepilogo per gennaio 2026") and " 2 dataset" in text


def test_month_without_a_file(table):
    older = table([("a", None, "2024", JAN)], SNAPSHOT)
    got = release.domain_facts("labour", "2026-02", {"2026-01": older}, table([("a",)], "dataset_code string"))
    assert rows(got, "dataset_code", "status", "domain_status") == [("a", "not_processed", "not_processed")]
    assert release.totals(got, "2026-02").first()["n_mancanti"] == 1


def test_snapshot_without_label_or_time_columns(table):
    df = table([("a", JAN)], "dataset_code string, extracted_at string")
    profile = release.snapshot_profile(df)
    assert release.dataset_summary(profile).first()["n_rows"] == 1
    assert release.dataset_periods(profile).count() == 0


@pytest.mark.parametrize("periods, words", [
    (["2026-05", "2026-06", "2026-07", "2026-09"], "da maggio a luglio 2026, settembre 2026 (4 mesi)"),
    (["2026-04"], "aprile 2026"),
    (["2025-12", "2026-01"], "da dicembre 2025 a gennaio 2026 (2 mesi)"),
    (["2026-Q1", "2026-Q2"], "I e II trimestre 2026"),
    (["2026-Q1", "2026-Q2", "2026-Q3"], "dal I al III trimestre 2026"),
    (["2025-Q4", "2026-Q1"], "dal IV trimestre 2025 al I trimestre 2026"),
    (["2024", "2025", "2020"], "anno 2020, anni 2024 e 2025"),
    (["2021", "2022", "2023"], "dal 2021 al 2023"),
    (["2023", "2023-02", "x", "2023-Q4"], "febbraio 2023; IV trimestre 2023; anno 2023; x"),
])
def test_periods_in_words(table, periods, words):
    df = table([("k", p) for p in periods], "k string, period string")
    assert report.periods_in_words(df, ["k"]).first()["periods_it"] == words


def test_report(facts, labels):
    totals = release.totals(facts, "2026-02")
    lines = report.report_lines(facts, labels, totals, "2026-02", date(2026, 2, 1))
    text = [r["line"] for r in lines.orderBy(*report.ORDER).collect()]
    assert text[0] == "# Aggiornamento dati: febbraio 2026"
    assert text[2] == ("Riepilogo dell'aggiornamento dati di febbraio 2026, rispetto a gennaio 2026. Dei 5 dataset "
                       "monitorati, 1 è stato scaricato di nuovo dalla fonte e 1 contiene periodi nuovi. Da verificare: "
                       "1 dataset non aggiornato, 2 mancanti e 1 nuovo.")
    assert "- **Tasso** (Lavoro, ISTAT, `upd`): da gennaio a febbraio 2025 (2 mesi)." in text
    issues = text[text.index("## Da verificare") + 2:text.index("---")]
    assert issues[:4] == [
        "- `gone` (Lavoro, `gone`): assente dal file elaborato (ultima estrazione disponibile: 5 gennaio 2026).",
        "- `never` (Lavoro, `never`): assente dal file elaborato (assente anche nell'elaborazione precedente).",
        "- `new` (Lavoro, `new`): nuovo dataset, assente nell'elaborazione precedente.",
        "- **Occupati** (Lavoro, Eurostat, `same`): non aggiornato. I dati risalgono all'estrazione del 5 gennaio 2026 "
        "(ultimo periodo: I trimestre 2024)."]
    assert "## Altri dataset" not in text          # a section without rows has no heading
    assert text[-1].startswith("_Generato automaticamente il 1º febbraio 2026")


def test_headline_counts(facts):
    r = release.totals(facts, "2026-02").first()
    assert (r["n_dataset"], r["n_aggiornati"], r["n_nuovi_periodi"], r["n_non_aggiornati"], r["n_mancanti"],
            r["n_nuovi_dataset"], r["previous_month"]) == (5, 1, 1, 1, 2, 1, "2026-01")


def test_previous_month_only_when_unique(facts):
    other = facts.withColumn("previous_month", F.lit("2025-12"))
    assert release.totals(facts.unionByName(other), "2026-02").first()["previous_month"] is None


def test_generated_dates(spark):
    from statmart.functions.periods import date_it
    r = spark.range(1).select(date_it(F.lit(datetime(2026, 6, 1)).cast("date")).alias("d")).first()
    assert r["d"] == "1º giugno 2026"
