from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statmart.functions import codes, numbers, periods, strings
from statmart.operators import lookups
from statmart.registry import GENDER, slice_codes


def one(spark, value, f):
    return spark.range(1).select(f(F.lit(value).cast("string")).alias("v")).first()["v"]


@pytest.mark.parametrize("geo, code", [
    ("001", "ITC11"), (" ita ", "IT"), ("ITC11", "ITC11"), ("ITH55", "ITH55"), ("ITD55", "ITH55"), ("ITE14", "ITI14"),
    ("IT108", "ITC4D"), ("ITC45", "ITC4C"), ("XX9", None), (None, None), ("ITCD", "ITC;ITH"), ("04", "ITH1;ITH2"),
    ("dup", "ITF2"), ("ITD99", None), ("", None), ("ITF1", "ITF1"),
])
def test_three_passes(spark, table, crosswalk, geo, code):
    df = lookups.local_territory(table([(geo,)], "geo string"), lookups.crosswalk_index(crosswalk), F.col("geo"))
    r = df.first()
    assert r["nuts_code"] == code
    assert r["geo_unmatched"] is (code is None)
    assert r["country_code"] == "IT"


def test_names_come_from_the_pass_that_matched(table, crosswalk):
    df = table([("ITC45",), ("ITC4C",), ("015",)], "geo string")
    out = lookups.local_territory(df, lookups.crosswalk_index(crosswalk), F.col("geo"))
    assert rows(out, "geo", "nuts_name_it", "nuts_level") == [
        ("015", "Milano", 3), ("ITC45", "Milano (old)", 3), ("ITC4C", "Milano", 3)]


def test_dispatch(table, crosswalk):
    df = table([(" fr10 ",), ("EU27_2020",), ("DE",)], "geo string")
    out = lookups.territory(df, "eurostat", F.col("geo"))
    assert rows(out, "nuts_code", "nuts_level", "country_code") == [
        ("DE", 0, "DE"), ("EU27_2020", None, "EU"), ("FR10", 2, "FR")]
    assert "geo_unmatched" in lookups.territory(df, "istat", F.col("geo"), lookups.crosswalk_index(crosswalk)).columns
    with pytest.raises(ValueError):
        lookups.territory(df, "runts", F.col("geo"))


def test_ambiguous_keys_count_null_as_a_value(table):
    df = table([("a", "x"), ("a", None), ("b", "x"), ("b", "x"), ("c", None)], "k string, v string")
    assert rows(lookups.ambiguous_keys(df, "k", "v")) == [("a", 2)]


FORMS = [("istat", "ODV", "odv", "Voluntary", "Q88", "ets", 0), ("istat", "ODV", "odv2", "Voluntary", "Q88", "ets", 1),
         ("runts", "APS", "aps", "Promotion", "S94", "ets", 2)]
FORM_SCHEMA = """source_system string, source_code string, unified_category string, unified_category_en string,
                 nace_primary string, ets_classification string, ord bigint"""


@pytest.mark.parametrize("provider, code, present, category, unmatched", [
    ("istat", " odv ", True, "odv2", False),       # repeated code: the last line counts
    ("istat", "aps", True, None, True),            # listed for another source system only
    ("ag_entrate", "odv", True, None, True),       # source system without any rows
    ("istat", None, False, None, False),           # dataset without a legal form column
    ("istat", None, True, None, True),
])
def test_legal_forms(table, provider, code, present, category, unmatched):
    df = table([(provider, code, present)], "provider string, code string, present boolean")
    out = lookups.legal_forms(df, table(FORMS, FORM_SCHEMA), F.col("provider"), F.col("code"), F.col("present")).first()
    assert (out["legal_form_unified"], out["legal_form_unmatched"]) == (category, unmatched)


@pytest.mark.parametrize("raw, sex", [("1", "male"), ("F", "female"), (" mf ", "total"), ("9", "total"), ("x", None),
                                      (None, None)])
def test_sex_codes(spark, raw, sex):
    assert one(spark, raw, lambda c: strings.map_literal(GENDER, strings.fold(c))) == sex


@pytest.mark.parametrize("raw, padded", [("1", "01"), ("ITC45", "ITC45"), ("12", "12"), ("", "00"), (None, None)])
def test_padding_never_cuts(spark, raw, padded):
    assert one(spark, raw, strings.pad_to_two) == padded


@pytest.mark.parametrize("code, reason", [
    ("IT", "keep"), ("ITC1", "keep"), ("FR", "keep"), ("FR10", "foreign_subnational"), ("ITZZ", "extra_regio"),
    ("CZ", "keep"), ("DEZ", "extra_regio"), (" ", "unmatched"), (None, "unmatched"), ("nan", "unmatched"),
    ("<NA>", "unmatched"), ("\tIT ", "keep")])
def test_scope(spark, code, reason):
    assert one(spark, code, codes.scope_reason) == reason


@pytest.mark.parametrize("raw, value", [
    ("1", 1.0), (" -1.5e3 ", -1500.0), (".5", 0.5), ("1d", None), ("1f", None), ("NaN", None), ("inf", None), (":", None),
    ("", None), (None, None), ("1,5", None), ("+7.", 7.0), ("\t3\n", 3.0)])
def test_numbers(spark, raw, value):
    assert one(spark, raw, numbers.to_number) == value


@pytest.mark.parametrize("label, freq, year", [
    ("2023", "A", 2023), ("2023-04", "M", 2023), ("2023-Q2", "Q", 2023), ("2023-Q5", "?", 2023), ("abc", "?", None),
    ("Q1 2020", "?", None)])
def test_periods(spark, label, freq, year):
    assert one(spark, label, periods.frequency_of) == freq
    assert one(spark, label, periods.leading_year) == year
    if freq != "?":
        assert one(spark, label, lambda c: periods.label_of(periods.frequency_of(c), periods.ordinal_of(c))) == label


def test_any_year_is_not_anchored(spark):
    assert one(spark, "Q1 2020", periods.any_year) == 2020
    assert one(spark, "n.d.", periods.any_year) is None


@pytest.mark.parametrize("x", [0.0, 0.5, 4500.0, 45.0, 1e6, 999999.4, 999999.6, 1234567.0, 0.0001, 0.00001, -2.25,
                               123456.0, 100.0, 0.1234567, 1e10, 3.14159265])
def test_six_digits_is_general_format(spark, x):
    got = spark.range(1).select(numbers.six_digits(F.lit(x)).alias("v")).first()["v"]
    assert got == f"{x:g}"


def test_italian_numbers(spark):
    r = spark.range(1).select(numbers.thousands_it(F.lit(40906)).alias("n"), numbers.signed_it(F.lit(1200)).alias("up"),
                              numbers.signed_it(F.lit(-35)).alias("down"), numbers.signed_it(F.lit(0)).alias("same")).first()
    assert tuple(r) == ("40.906", "+1.200", "−35", "nessuna")


def test_slices_cover_every_division():
    by_slice = slice_codes()
    flat = [c for codes_ in by_slice.values() for c in codes_]
    assert len(by_slice) == 14 and len(flat) == len(set(flat)) == 89
    assert by_slice["D_E"] == ["D35", "E36", "E37", "E38", "E39"] and by_slice["A"][0] == "A01"


def test_code_list(table):
    code_rows = [("sex", "istat", "1", "M", "Males", False, None, None), ("sex", "istat", "9", "T", "Total", True, None, None)]
    schema = """breakdown string, provider string, code string, harmonised_code string, label string, is_total boolean,
                lower_bound int, upper_bound int"""
    df = table([("istat", "1"), ("istat", "9"), ("istat", None), ("istat", "7")], "provider string, sex string")
    listed = table(code_rows, schema)
    out = lookups.code_list(df, listed, "sex", "sex")
    assert rows(out, "sex", "sex_code", "sex_is_total", "sex_unlisted") == [
        ("1", "M", False, False), ("7", None, None, True), ("9", "T", True, False), (None, None, True, False)]
    with pytest.raises(Exception, match="unlisted code 7"):
        lookups.code_list(df, listed, "sex", "sex", strict=True).collect()
