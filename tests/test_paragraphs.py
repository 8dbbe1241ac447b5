from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from statmart.plans import paragraphs as p

VALUES = {"mese": "novembre 2026", "n_dataset": "29", "n_mancanti": "2"}
FINE = ("Nel riepilogo di {mese} la banca dati osserva {n_dataset} dataset in totale. Tra questi, {n_mancanti} dataset "
        "risultano assenti e restano da verificare con calma.")


def values():
    return F.create_map(*[F.lit(x) for kv in VALUES.items() for x in kv])


def check(table, text):
    return p.checked(table([(text,)], "text string"), "text", values()).first()


def test_accepted_and_substituted(table):
    r = check(table, f"  {FINE} ")
    assert r["problems"] == [] and r["accepted"]
    assert r["final_text"].startswith("Nel riepilogo di novembre 2026") and "{" not in r["final_text"]


@pytest.mark.parametrize("text, problems", [
    (None, ["empty response"]),
    (" \n ", ["empty response"]),
    (FINE.replace("{n_dataset}", "29"), ["contains digits", "missing placeholders: ['n_dataset']"]),
    (FINE + " Due serie.", ["number word: 'Due'"]),
    (FINE + " La metà è pronta, TUTTI i dati.", ["quantifier: 'metà'"]),
    (FINE + " Cresceranno.", ["trend word: 'Cresceranno'"]),
    (FINE + " A Maggio.", ["month name: 'Maggio'"]),
    (FINE + "\nAltro.", ["formatting characters"]),
    (FINE + " {zeta} {altro} {zeta}", ["unknown placeholders: ['altro', 'zeta']"]),
    (FINE + " {Mese", ["stray braces"]),
    (FINE.replace("Tra questi, {n_mancanti} dataset ", ""), ["missing placeholders: ['n_mancanti']"]),
    ("{mese} {n_dataset} {n_mancanti}", ["too short: 18 characters"]),
    (FINE + "a" * 700, [f"too long: {len(FINE) - 25 + 16 + 700} characters"]),
    (FINE + " Duello e sedie, trentino.", []),          # whole words only
])
def test_reasons(table, text, problems):
    if problems and problems[0].startswith("too long"):
        full = text.replace("{mese}", "novembre 2026").replace("{n_dataset}", "29").replace("{n_mancanti}", "2")
        problems = [f"too long: {len(full)} characters"]
    assert check(table, text)["problems"] == problems


def test_first_acceptable_candidate_else_template(table):
    df = table([("a", 1, "Ci sono 3 dataset."), ("a", 2, FINE), ("a", 3, FINE + " Ancora."), ("b", 1, "No."), ("b", 2, None)],
               "grp string, rank bigint, text string")
    out = {r["grp"]: r for r in p.first_accepted(p.checked(df, "text", values()), ["grp"], "rank", F.lit("modello")).collect()}
    assert out["a"]["source"] == "candidate" and out["a"]["chosen_rank"] == 2 and out["a"]["n_attempts"] == 3
    assert (out["b"]["text"], out["b"]["source"], out["b"]["chosen_rank"]) == ("modello", "template", None)


@pytest.mark.parametrize("n_new, names", [(1, "Serie 0"), (3, "Serie 0, Serie 1 e c2"), (4, None), (0, None)])
def test_offered_values(spark, table, n_new, names):
    facts = table([("labour", f"c{i}") for i in range(5)], "domain string, dataset_code string").withColumn(
        "new_periods", F.when(F.substring("dataset_code", 2, 1).cast("int") < n_new,
                              F.expr("map('A', array('2020'))")).otherwise(F.expr("map()").cast("map<string, array<string>>")))
    labels = table([("c0", "Serie 0"), ("c1", "Serie 1")], "dataset_code string, label_it string")
    totals = table([("2026-11", "2026-10", 5, 1200, n_new, 0, 0, 0, False)], """month string, previous_month string,
        n_dataset bigint, n_aggiornati bigint, n_nuovi_periodi bigint, n_non_aggiornati bigint, n_mancanti bigint,
        n_nuovi_dataset bigint, prima_rilevazione boolean""")
    got = p.offered_values(totals, facts, labels).first()["values"]
    assert got.get("elenco_nuovi_periodi") == names
    assert got["n_aggiornati"] == "1.200" and "n_mancanti" not in got and got["mese"] == "novembre 2026"
    first = p.offered_values(totals.withColumn("prima_rilevazione", F.lit(True)), facts, labels).first()
    assert first["values"] is None
