"""Period sets as bitmaps against plain sets."""

from __future__ import annotations

import random

from conftest import rows
from pyspark.sql import functions as F

from statmart.operators import periodsets as ps
from statmart.plans import release, report

KEYS = ["k"]


def some_periods(seed):
    rng = random.Random(seed)
    out = {(rng.choice("ab"), f"{rng.randint(0, 9999):04d}") for _ in range(60)}
    out |= {(rng.choice("abc"), f"{rng.randint(1960, 2040)}-{rng.randint(1, 12):02d}") for _ in range(300)}
    out |= {(None if rng.random() < 0.2 else "a", f"{rng.randint(1990, 2030)}-Q{rng.randint(1, 4)}") for _ in range(90)}
    return out | {("a", "0000"), ("a", "9999"), ("b", "9999-12"), ("b", "0000-01"), ("c", "9999-Q4")}


def test_sets_and_differences_equal_plain_sets(table):
    now, then = some_periods(1), some_periods(2)
    frames = [table(sorted(s, key=repr) * 3, "k string, period string") for s in (now, then)]
    a, b = (ps.period_sets(f, KEYS) for f in frames)
    assert set(rows(ps.unpacked(a, KEYS).select("k", "period"))) == now
    words = ps.differences(ps.paired(a, b, KEYS))
    assert set(rows(ps.unpacked(words, KEYS, "added").select("k", "period"))) == now - then
    assert set(rows(ps.unpacked(words, KEYS, "gone").select("k", "period"))) == then - now
    named = {x for x in now & then if x[0] is not None}
    assert set(rows(ps.unpacked(ps.shared([a, b], KEYS), KEYS).select("k", "period"))) == named
    assert a.filter("bits < 0").count() == 0


def test_summary_equals_plain_counts(table):
    periods = some_periods(3) | {("a", "n.d."), ("a", "2020-13x"), ("c", "")}
    df = table(sorted(periods, key=repr), "k string, period string")
    got = rows(ps.summary(ps.period_sets(df, KEYS), ps.free_labels(df, KEYS), KEYS), "k", "frequency", "n_periods", "first_period", "latest_period")
    kind = lambda p: "A" if len(p) == 4 and p.isdigit() else "Q" if "Q" in p else "M" if len(p) == 7 and p[:4].isdigit() else "?"
    want = {}
    for k, p in periods:
        want.setdefault((k, kind(p)), []).append(p)
    assert got == sorted([(k, f, len(p), min(p), max(p)) for (k, f), p in want.items()], key=repr)


def test_many_rows_make_few_words(table, spark):
    df = spark.range(100_000).select(F.lit("k").alias("k"), F.concat((F.lit(2000) + F.col("id") % 20).cast("string"), F.lit("-"),
                                     F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")).alias("period"))
    assert ps.period_sets(df, KEYS).count() <= 5


def test_free_labels_are_rows_and_only_the_first_are_named(table):
    schema = "dataset_code string, period_label string, time string, extracted_at string"
    then = table([("d", None, "2020", "2026-01-01")], schema)
    now = table([("d", None, f"wave {i:04d}", "2026-02-01") for i in range(200)] + [("d", None, "2020", "2026-02-01")], schema)
    details = []
    facts = release.compare(now, then, table([("d",)], "dataset_code string"), details).first()
    assert facts["n_new_periods"] == 200 and facts["n_removed_periods"] == 0
    assert facts["new_periods"] == {"?": [f"wave {i:04d}" for i in range(release.FREE_SHOWN)]}
    assert facts["latest_period"] == {"?": "wave 0199", "A": "2020"}
    assert details[0].filter("change = 'new'").count() == 200
    line = report.new_period_lines(release.compare(now, then, table([("d",)], "dataset_code string")).withColumns(
        {"domain": F.lit("labour"), "name": F.lit("D")})).first()["line"]
    assert line.endswith("wave 0048, wave 0049 e altri 150.")
