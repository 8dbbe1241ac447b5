"""The monthly run end to end on a handful of landed rows."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statmart.plans import marts, run
from statmart.plans.merge import merge_domain, read_raw
from statmart.registry import DOMAINS, inline, select_domains
from statmart.schemas import DIMENSIONS, FACTS, PROCESSED
from statmart.sources.landing import land_snapshot

NOW = datetime(2026, 3, 1, 8)
META = "source_id string, dataset_code string, extracted_at string"


@pytest.fixture(scope="module")
def layout(spark, crosswalk, tmp_path_factory):
    root = tmp_path_factory.mktemp("statmart")
    seeds = root / "seeds"
    seeds.mkdir()
    crosswalk.drop("ord").toPandas().to_csv(seeds / "nuts_istat.csv", index=False)
    (seeds / "legal_form_map.csv").write_text(
        "source_system,source_code,source_label_it,unified_category,unified_category_en,nace_primary,ets_classification\n"
        "istat,ODV,Organizzazione,odv,Voluntary organisation,Q88,ets\n")
    (seeds / "nace_labels.csv").write_text("nace_code,label_en\nP85,Education\nO-U,Services\n")
    sources = [("istat", "85_84_DF_DCSA_VOLON1_1"), ("eurostat", "nama_10r_3empers"), ("istat", "150_873_DF_DCCV_FORZLVMENS1_1"),
               ("istat", "150_915_DF_DCCV_TAXOCCU1_5"), ("eurostat", "lfst_r_lfu3rt")]
    (seeds / "domain_sources.csv").write_text("source_id,source_name,domain,priority\n" + "".join(
        f"{p}_{c},name of {c},any,{1 if p == 'istat' else 2}\n" for p, c in sources))
    (seeds / "dataset_labels.csv").write_text("dataset_code,fonte,label_it\n150_915_DF_DCCV_TAXOCCU1_5,ISTAT,Tasso di occupazione\n")
    return run.Layout(str(root / "data"), str(seeds))


def land(spark, layout, domain, code, provider, columns, data, month, at):
    schema = ", ".join(f"{c} string" for c in columns)
    df = inline(spark, data, schema).withColumns({
        "source_id": F.lit(provider), "dataset_code": F.lit(code), "extracted_at": F.lit(at)})
    land_snapshot(df, f"{layout.raw}/{domain}", code, month)


def land_month(spark, layout, month, at, extra):
    land(spark, layout, "social_economy", "85_84_DF_DCSA_VOLON1_1", "istat",
         ["geo", "gender", "age_group", "volunteering_form", "time", "value", "tipoente"],
         [("ITA", "9", "Y_GE15", "TOTAL", "2023", "12.5", "odv"), ("1", "9", "Y_GE15", "TOTAL", "2023", "13", "zzz"),
          ("1", "9", "Y_GE15", "TOTAL", "2014", "1", None), ("99", "1", "Y_GE15", "TOTAL", "2023", "7", None),
          ("98", "1", "Y_GE15", "TOTAL", "2023", "8", None)], month, at)
    land(spark, layout, "social_economy", "nama_10r_3empers", "eurostat", ["geo", "nace_r2", "unit", "time", "value", "wstatus"],
         [("FR", "O-U", "THS", "2022", "100.5", "EMP"), ("FR10", "O-U", "THS", "2022", "9", "EMP"), ("ITC1", "O-U", "THS", "2022", "3", "EMP"),
          ("EU27_2020", "O-U", "THS", "2022", "9", "EMP"), ("ITZZ", "O-U", "THS", "2022", "9", "EMP"), ("DE", "O-U", "PC", "2022", "9", "EMP"),
          ("ES", "O-U", "THS", "2022", ":", "EMP")], month, at)
    land(spark, layout, "labour", "150_873_DF_DCCV_FORZLVMENS1_1", "istat", ["frequency", "gender", "age_group", "adjustment", "time", "value"],
         [("M", "9", "Y15-89", "N", "2023-04", "25000"), ("M", "9", "Y15-89", "Y", "2023-04", "25100")] + extra, month, at)
    land(spark, layout, "labour", "150_915_DF_DCCV_TAXOCCU1_5", "istat", ["frequency", "ref_area", "gender", "age_group", "time", "value"],
         [("A", "ITD55", "1", "Y15-64", "2023", "70.5"), ("A", "IT108", "1", "Y15-64", "2023", "71"), ("A", "NOPE1", "1", "Y15-64", "2023", "60"),
          ("A", "NOPE2", "1", "Y15-64", "2023", "61"), ("Q", "ITA", "9", "Y15-64", "2023-Q2", "61")], month, at)
    land(spark, layout, "labour", "lfst_r_lfu3rt", "eurostat", ["freq", "isced11", "unit", "sex", "age", "geo", "time", "value"],
         [("A", "ED5-8", "PC", "T", "Y15-74", "FR", "2023", "5.5"), ("A", "ED5-8", "PC", "T", "Y15-74", "FR10", "2023", "5.5"),
          ("A", "ED5-8", "PC", "T", "Y15-74", "ITC1", "2023", "6.5"), ("A", "TOTAL", "PC", "T", "Y15-74", "ITC1", "2019", "6.5")], month, at)


@pytest.fixture(scope="module")
def finished(spark, layout):
    land_month(spark, layout, "2026-02", "2026-02-05T10:00:00", [])
    for domain in select_domains():
        assert run.process(spark, layout, domain, "2026-02") > 0
    run.build(spark, layout, select_domains(), datetime(2026, 2, 6))
    first = rows(spark.read.parquet(layout.table("fact_labour")))
    land_month(spark, layout, "2026-03", "2026-03-01T07:00:00", [("M", "9", "Y15-89", "N", "2023-05", "25050")])
    assert run.run(spark, layout, "2026-03", now=NOW)
    return first


def read(spark, layout, name):
    return spark.read.parquet(layout.table(name))


def test_processed_layer(spark, layout, finished):
    df = spark.read.parquet(f"{layout.processed}/labour/labour_2026-03.parquet")
    assert df.columns == PROCESSED["labour"].names
    assert rows(df.filter("dataset_code like '150_873%'"), "nuts_code", "time", "period_label", "adjustment", "value", "gender") == [
        ("IT", 2023, "2023-04", "N", 25000.0, "total"), ("IT", 2023, "2023-05", "N", 25050.0, "total")]
    occupied = df.filter("dataset_code like '150_915%'")
    assert rows(occupied, "nuts_code", "geo_unmatched") == [("IT", False), ("ITC4D", False), ("ITH55", False), (None, True), (None, True)]
    assert rows(df.filter("source_id = 'eurostat'"), "nuts_code", "education", "gender") == [("FR", "ED5-8", "T"), ("ITC1", "ED5-8", "T")]
    se = spark.read.parquet(f"{layout.processed}/social_economy/social_economy_2026-03.parquet")
    assert se.columns == PROCESSED["social_economy"].names
    istat = se.filter("source_id = 'istat'")
    assert rows(istat, "nuts_code", "legal_form_unified", "legal_form_unmatched", "value") == [
        ("IT", "odv", False, 12.5), ("ITC1", None, True, 13.0), (None, None, True, 7.0), (None, None, True, 8.0)]
    assert rows(se.filter("source_id = 'eurostat'"), "nuts_code", "nace_code", "nace_label_en") == [
        ("FR", "O-U", "Services"), ("FR10", "O-U", "Services"), ("ITC1", "O-U", "Services"), ("ITZZ", "O-U", "Services")]


def test_star(spark, layout, finished):
    for name, schema in {**DIMENSIONS, **{k: FACTS[k] for k in ("fact_labour", "fact_social_economy")}}.items():
        assert read(spark, layout, name).columns == schema.names
    labour = read(spark, layout, "fact_labour")
    assert sorted(r["fact_key"] for r in labour.collect()) == list(range(1, 8))
    assert read(spark, layout, "dim_time").count() == 41 and read(spark, layout, "dim_indicator").count() == 18
    geo = {r["nuts_code"]: r for r in read(spark, layout, "dim_geography").collect()}
    assert geo["FR"]["geo_source"] == "eurostat_auto" and "FR10" not in geo and "ITZZ" not in geo
    assert len({r["geo_key"] for r in geo.values()}) == len(geo)
    assert rows(read(spark, layout, "quarantine_scope_social_economy"), "nuts_code", "drop_reason") == [
        ("FR10", "foreign_subnational"), ("ITZZ", "extra_regio"), (None, "unmatched"), (None, "unmatched")]
    assert read(spark, layout, "quarantine_keys_labour").count() == 0
    assert rows(read(spark, layout, "load_log"), "domain", "n_rows") == [
        ("labour", 6), ("labour", 7), ("social_economy", 4), ("social_economy", 4)]


def test_legal_form_key(spark, layout, finished):
    fact = read(spark, layout, "fact_social_economy").join(read(spark, layout, "dim_legal_form"), "legal_form_key")
    assert rows(fact, "value", "source_code", "unified_category") == [(12.5, "ODV", "odv")]


def test_declared_tables_exist_empty(spark, layout, finished):
    for name in ("fact_housing", "fact_sdg", "fact_poverty", "fact_welfare", "fact_immigration", "fact_civil_society"):
        assert read(spark, layout, name).columns == FACTS[name].names and read(spark, layout, name).count() == 0


def test_unreadable_snapshot_is_named_after_the_rest_is_written(spark, layout, finished, tmp_path):
    import shutil
    root = tmp_path / "copy"
    shutil.copytree(f"{layout.root}/raw/labour", root / "raw" / "labour")
    bad = root / "raw" / "labour" / "lfst_r_lfur2gan_2026-03.parquet"
    bad.write_text("not parquet")
    other = run.Layout(str(root), layout.seeds)
    with pytest.raises(RuntimeError, match="lfst_r_lfur2gan"):
        run.process(spark, other, DOMAINS["labour"], "2026-03")
    assert spark.read.parquet(f"{other.processed}/labour/labour_2026-03.parquet").count() == 9


def test_one_list_of_sex_codes(spark, layout, finished):
    args = [layout.seed(spark, n) for n in ("nuts_istat.csv", "legal_form_map.csv", "nace_labels.csv")]
    out = merge_domain(DOMAINS["labour"], read_raw(spark, layout.raw, DOMAINS["labour"]), *args, same_sex_codes=True)
    assert rows(out.filter("source_id = 'eurostat'").select("gender").distinct()) == [("total",)]


def test_second_build_of_the_same_month_changes_nothing(spark, layout, finished):
    before = {n: rows(read(spark, layout, n)) for n in ("fact_labour", "fact_social_economy", "dim_geography", "dim_source")}
    run.build(spark, layout, [DOMAINS["labour"], DOMAINS["social_economy"]], NOW)
    assert {n: rows(read(spark, layout, n)) for n in before} == before


def test_marts(spark, layout, finished):
    flats = run.flat_marts(spark, layout)
    assert flats["labour"].columns == marts.LABOUR and flats["social_economy"].columns == marts.SOCIAL_ECONOMY
    assert set(marts.register(flats)) == {"vw_labour", "vw_social_economy"} | {f"vw_{n}" for n in marts.marts()}
    assert rows(spark.table("vw_labour_force_monthly"), "period_label", "labour_force_thousands") == [
        ("2023-04", 25000.0), ("2023-05", 25050.0)]
    assert rows(spark.table("vw_se_volunteering_regional"), "nuts_code", "value") == [("ITC1", 13.0)]
    assert rows(spark.table("vw_labour_unemployment_by_education"), "nuts_code", "unemployment_rate") == [("FR", 5.5), ("ITC1", 6.5)]
    assert rows(spark.table("vw_se_employment_eu"), "nuts_code", "nuts_level") == [("FR", 0), ("ITC1", 2)]


def test_checks(spark, layout, finished):
    found = {(r["table"], r["check"]): r for r in read(spark, layout, "check_results").collect()}
    assert found["fact_labour", "row count"]["status"] == "FAIL"
    assert found["fact_labour", "values within bounds"]["status"] == "PASS"
    assert found["fact_labour", "duplicate rows at grain"]["status"] == "PASS"
    assert found["fact_labour", "orphan foreign keys"]["status"] == "PASS"
    assert found["fact_labour", "providers present"]["observed"] == "2/2"
    assert found["fact_labour", "frequencies and period labels"]["status"] == "PASS"
    assert found["fact_labour", "datasets present and fresh"]["status"] == "WARN"
    assert found["dim_geography", "key uniqueness"]["status"] == "PASS"
    assert not [r for r in found.values() if r["status"] == "ERROR"]


def test_digest_and_run_log(spark, layout, finished):
    text = [r["value"] for r in spark.read.text(f"{layout.root}/summaries/2026-03.md").collect()]
    assert text[0] == "# Aggiornamento dati: marzo 2026"
    assert any("`150_873_DF_DCCV_FORZLVMENS1_1`" in x and "maggio 2023" in x for x in text)
    assert any(x.startswith("| Lavoro | **Tasso di occupazione** (ISTAT, `150_915_DF_DCCV_TAXOCCU1_5`) | II trimestre 2023 / 2023 | nessuna |")
               for x in text)
    log = spark.read.json(f"{layout.root}/logs/run_log")
    assert rows(log, "stage", "status") == [("checks", "ok"), ("database", "ok"), ("digest", "ok"), ("marts", "ok"), ("process", "ok"), ("process", "ok")]


def test_a_failing_stage_is_logged_and_the_rest_runs(spark, layout, tmp_path):
    broken = run.Layout(str(tmp_path / "d"), str(tmp_path / "no_seeds"))
    assert run.run(spark, broken, "2026-03", ["labour"], NOW) is False
    log = {r["stage"]: r for r in spark.read.json(f"{broken.root}/logs/run_log").collect()}
    assert log["process"]["status"] == "failed" and log["database"]["status"] == "failed"


def test_full_grain_keeps_what_the_short_key_merges(spark, layout, finished):
    raw = read_raw(spark, layout.raw, DOMAINS["labour"])
    code = "150_873_DF_DCCV_FORZLVMENS1_1"
    doubled = {code: raw[code].unionByName(raw[code].withColumn("unemployment_duration", F.lit("M_GE12"))
                                           .withColumn("value", F.lit("1")), allowMissingColumns=True)}
    args = [layout.seed(spark, n) for n in ("nuts_istat.csv", "legal_form_map.csv", "nace_labels.csv")]
    assert merge_domain(DOMAINS["labour"], doubled, *args).count() == 2
    assert merge_domain(DOMAINS["labour"], doubled, *args, full_grain=True).count() == 4


def test_nothing_landed(spark, layout):
    args = [layout.seed(spark, n) for n in ("nuts_istat.csv", "legal_form_map.csv", "nace_labels.csv")]
    out = merge_domain(DOMAINS["labour"], {}, *args)
    assert out.count() == 0 and out.columns == PROCESSED["labour"].names


def test_marts_are_written_in_one_pass(spark, layout, finished):
    """Each published mart has the rows and columns it has over the star itself, and none is evaluated on the star again."""
    flats = run.flat_marts(spark, layout)
    for domain, flat in flats.items():
        found = run.published_marts(spark, layout, domain)
        assert set(found) == {f"mart_{domain}", f"mart_{domain}_labelled", *(f"mart_{n}" for n, m in marts.marts().items() if m.base == domain)}
        for name, mart in marts.marts().items():
            if mart.base == domain:
                got, want = found[f"mart_{name}"], mart.of(flat)
                assert got.columns == want.columns and rows(got) == rows(want), name
                plan = got._jdf.queryExecution().executedPlan().toString()
                assert plan.count("FileScan") == 1 and f"mart#" in plan and "Join" not in plan
    spread = marts.spread(spark.read.parquet(layout.table("mart_labour")), "labour")
    assert spread._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_the_fact_is_scanned_once_and_never_exchanged(spark, layout, finished):
    plan = run.flat_marts(spark, layout)["labour"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("fact_labour") == 1 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_partitioned_layers_give_the_same_run(spark, layout, finished, tmp_path):
    """The same landed rows through one table per layer instead of a file per snapshot."""
    other = run.Layout(str(tmp_path / "data"), layout.seeds, partitioned=True)
    for domain in select_domains():
        for code, df in read_raw(spark, layout.raw, DOMAINS[domain.name]).items():
            other.raw_layer(spark, domain).write(df.drop("_row"), code, "2026-03", ["dataset_code"])
    assert run.run(spark, other, "2026-03", now=NOW)
    for table in ("fact_labour", "fact_social_economy"):
        columns = [c for c in FACTS[table].names if not c.endswith("_key")]
        assert rows(read(spark, other, table), *columns) == rows(read(spark, layout, table), *columns)
    assert other.processed_layer(spark, DOMAINS["labour"]).newest() == {"labour": "2026-03"}
    assert read(spark, other, "load_log").filter("file like '%month=2026-03'").count() == 2
