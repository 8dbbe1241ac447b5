"""Response files to raw snapshots, and the run that begins with them."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from conftest import rows

from statmart.plans import run
from statmart.plans.ingest import ingest
from statmart.registry import DOMAINS
from statmart.session import build_session, checkpointed, scratch, shared_dir
from statmart.sources.snapshots import latest_paths

AT = datetime(2026, 2, 5, 10)
RATE, CUBE = "150_915_DF_DCCV_TAXOCCU1_5", "lfst_r_lfu3rt"


def cube(values, geo, sex=("T",)):
    axes = {"freq": ["A"], "isced11": ["TOTAL"], "unit": ["PC"], "sex": list(sex), "age": ["Y15-74"], "geo": geo, "time": ["2022", "2023"]}
    return json.dumps({"dimension": {a: {"category": {"index": {c: i for i, c in enumerate(cs)}}} for a, cs in axes.items()},
                       "value": {str(i): v for i, v in enumerate(values)}})


@pytest.fixture
def landed(tmp_path):
    root = tmp_path / "landed" / "labour"
    (root / RATE).mkdir(parents=True)
    (root / RATE / "a.csv").write_text("FREQ,REF_AREA,SEX,AGE,TIME_PERIOD,OBS_VALUE\nA,001,1,Y15-64,2023,70.5\nA,001,2,Y15-64,2010,60\n")
    (root / RATE / "b.csv").write_text("FREQ,REF_AREA,SEX,AGE,TIME_PERIOD,OBS_VALUE\nA,037,1,Y15-64,2023,:\nA,037,2,Y15-64,2023,61\n")
    (root / CUBE).mkdir()
    (root / CUBE / "s1.json").write_text(cube([5.5, 5.6, None, 6.5], ["FR", "ITC1"]))
    (root / CUBE / "s2.json").write_text(cube([4.0, 4.1], ["DE"]))
    (root / CUBE / "s3.json").write_text('{"dimension": {}}')
    (root / "172_931_DF_DCCV_NEET1_9").mkdir()
    (root / "172_931_DF_DCCV_NEET1_9" / "empty.csv").write_text("FREQ,REF_AREA,TIME_PERIOD,OBS_VALUE\n")
    (root / "172_931_DF_DCCV_NEET1_11").mkdir()
    (root / "172_931_DF_DCCV_NEET1_11" / "odd.csv").write_text("FREQ,REF_AREA,TIME_PERIOD\nA,001,2023\n")
    return str(tmp_path / "landed")


def test_every_dataset_on_its_own_and_problems_last(spark, landed, tmp_path):
    raw = str(tmp_path / "raw")
    with pytest.raises(RuntimeError) as e:
        ingest(spark, landed, raw, DOMAINS["labour"], "2026-02", AT)
    said = str(e.value)
    assert "172_931_DF_DCCV_NEET1_9: no observations" in said
    assert "172_931_DF_DCCV_NEET1_11: ValueError: no column 'value'" in said
    assert "s3.json: missing key: value" in said
    assert "150_873_DF_DCCV_FORZLVMENS1_1: nothing landed" in said
    found = latest_paths(spark, f"{raw}/labour")
    assert set(found) == {RATE, CUBE}
    a = spark.read.parquet(found[RATE])
    assert {"source_id", "dataset_code", "extracted_at"} <= set(a.columns)
    assert rows(a, "geo", "time", "value") == [("001", "2023", 70.5), ("037", "2023", 61.0)]
    assert rows(spark.read.parquet(found[CUBE]), "geo", "time", "value") == [
        ("DE", "2022", 4.0), ("DE", "2023", 4.1), ("FR", "2022", 5.5), ("FR", "2023", 5.6), ("ITC1", "2023", 6.5)]
    listed = spark.read.json(f"{raw}/labour/manifest_2026-02.json")
    assert rows(listed, "dataset_code", "row_count", "source_id") == [(RATE, 2, "istat"), (CUBE, 5, "eurostat")]


def test_run_begins_with_landed_files(spark, landed, tmp_path, crosswalk):
    seeds = tmp_path / "seeds"
    seeds.mkdir()
    crosswalk.drop("ord").toPandas().to_csv(seeds / "nuts_istat.csv", index=False)
    (seeds / "legal_form_map.csv").write_text(
        "source_system,source_code,source_label_it,unified_category,unified_category_en,nace_primary,ets_classification\n")
    (seeds / "nace_labels.csv").write_text("nace_code,label_en\n")
    (seeds / "domain_sources.csv").write_text(f"source_id,source_name,domain,priority\nistat_{RATE},n,any,1\neurostat_{CUBE},m,any,2\n")
    layout = run.Layout(str(tmp_path / "data"), str(seeds))
    assert not run.run(spark, layout, "2026-02", ["labour"], AT, landed)      # the problems above are failures of the stage
    assert spark.read.parquet(layout.table("fact_labour")).count() == 7
    log = {r["stage"]: r for r in spark.read.json(f"{layout.root}/logs/run_log").collect()}
    assert log["ingest"]["status"] == "failed" and "s3.json" in log["ingest"]["error"]
    assert {s: log[s]["status"] for s in ("process", "database", "marts", "checks", "digest")} == dict.fromkeys(
        ("process", "database", "marts", "checks", "digest"), "ok")
    found = spark.read.parquet(layout.table("check_results")).filter("check = 'views return rows'").collect()
    assert len(found) == 1 and "missing" not in found[0]["detail"] and "mart_labour_neet: returns 0 rows" in found[0]["detail"]
    labelled = spark.read.parquet(layout.table("mart_labour_labelled"))
    assert {"gender_is_total", "education_label", "is_headline"} <= set(labelled.columns) and labelled.count() == 7
    assert spark.read.parquet(f"{layout.root}/reports/labour_collisions_2026-02").count() == 0
    assert rows(spark.read.parquet(f"{layout.root}/reports/labour_breakdown_2026-02"), "indicator_code", "n_rows") == [
        ("employment_rate", 2), ("unemployment_rate", 5)]


def test_scratch_deletes_its_own_tables_only(spark):
    from statmart.session import file_system

    def there(path):
        fs, where = file_system(spark, path)
        return fs.exists(where)

    def place(df):
        return df.inputFiles()[0].rsplit("/", 1)[0]
    outside = place(checkpointed(spark.range(3)))
    with scratch(spark):
        inside = place(checkpointed(spark.range(3)))
        assert there(inside)
    assert there(outside) and not there(inside)
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert build_session("again") is not None
