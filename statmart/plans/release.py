"""What changed since the previous snapshot, per dataset."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.periods import frequency_of, reference_period
from ..operators import periodsets
from ..operators.periodsets import FREE
from ..session import checkpointed
from ..sources.snapshots import metadata_columns

FREE_SHOWN = 50     # free labels named in the facts of a release
STATUSES = ["updated", "not_updated", "new_dataset", "missing", "baseline", "not_processed"]


def observed(snapshot: DataFrame) -> DataFrame:
    """Dataset, period and extraction time of every row; only four columns leave the scan."""
    df = metadata_columns(snapshot)
    return df.select(
        F.col("dataset_code").cast("string").alias("dataset_code"),
        reference_period(F.col("period_label"), F.col("time")).alias("period"),
        F.col("extracted_at").try_cast("timestamp").alias("extracted_at"))


def snapshot_profile(snapshot: DataFrame) -> DataFrame:
    """Rows and newest extraction per dataset and period.

    Everything a comparison needs follows from this small table, so a snapshot is scanned once; it is written to the
    shared folder because several steps read it.
    """
    rows = observed(snapshot).filter(F.col("dataset_code").isNotNull())
    return checkpointed(rows.groupBy("dataset_code", "period").agg(
        F.count("*").alias("n_rows"), F.max("extracted_at").alias("extracted_at")))


def dataset_summary(profile: DataFrame) -> DataFrame:
    """Rows and newest extraction per dataset."""
    return profile.groupBy("dataset_code").agg(
        F.sum("n_rows").alias("n_rows"), F.max("extracted_at").alias("extracted_at"))


def dataset_periods(profile: DataFrame) -> DataFrame:
    """Periods per dataset with their frequency."""
    return profile.filter(F.col("period").isNotNull()).select(
        "dataset_code", "period", frequency_of(F.col("period")).alias("frequency"))


def by_frequency(periods: DataFrame, name: str, keys: list[str] | None = None) -> DataFrame:
    """Frequency -> sorted calendar periods, one map per dataset: labels of twelve months a year at most.

    Free labels have no such bound: the map holds the first ``FREE_SHOWN`` of them; all are rows of ``periods``.
    """
    keys = keys or ["dataset_code"]
    known = periods.filter(F.col("frequency") != FREE)
    order = Window.partitionBy(*keys).orderBy("period")
    some = periods.filter(F.col("frequency") == FREE).withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= FREE_SHOWN).drop("_at")
    lists = known.unionByName(some).groupBy(*keys, "frequency").agg(F.sort_array(F.collect_list("period")).alias("_p"))
    return lists.groupBy(*keys).agg(F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("frequency", "_p")))).alias(name))


def frequency_map(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Frequency -> value, one map of at most four entries per dataset."""
    return rows.groupBy("dataset_code").agg(F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("frequency", value)))).alias(name))


@dataclass(frozen=True)
class Periods:
    """The periods of one snapshot per dataset: calendar periods as bitmaps, free labels as rows."""

    sets: DataFrame
    free: DataFrame

    @staticmethod
    def of(profile: DataFrame) -> Periods:
        keys = ["dataset_code"]
        return Periods(checkpointed(periodsets.period_sets(profile, keys)), checkpointed(periodsets.free_labels(profile, keys)))

    def summary(self) -> DataFrame:
        return periodsets.summary(self.sets, self.free, ["dataset_code"])


def changes_of(current: Periods, previous: Periods, compared: DataFrame) -> DataFrame:
    """(dataset, period, frequency, change) of the datasets in ``compared``: ``new`` periods are only in the current,
    ``removed`` ones only in the previous snapshot. Bit operations on words, an anti join for free labels."""
    words = periodsets.differences(periodsets.paired(current.sets, previous.sets, ["dataset_code"]))
    parts = [periodsets.unpacked(words, ["dataset_code"], bits).withColumn("change", F.lit(change))
             for bits, change in (("added", "new"), ("gone", "removed"))]
    on = ["dataset_code", "period"]
    for a, b, change in ((current.free, previous.free, "new"), (previous.free, current.free, "removed")):
        parts.append(a.join(b, on, "left_anti").withColumns({"frequency": F.lit(FREE), "change": F.lit(change)}))
    return reduce(DataFrame.unionByName, parts).join(compared.select("dataset_code").distinct(), "dataset_code", "left_semi") \
        .select("dataset_code", "period", "frequency", "change")


def period_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """:func:`changes_of` for two tables of (dataset, period), for datasets that are in both."""
    both = current.select("dataset_code").distinct().join(previous.select("dataset_code").distinct(), "dataset_code")
    return changes_of(Periods.of(current), Periods.of(previous), both)


def compare(current: DataFrame | None, previous: DataFrame | None, expected: DataFrame,
            details: list[DataFrame] | None = None) -> DataFrame:
    """One row per dataset that is expected, present now or was present before.

    ``current`` / ``previous`` are snapshots or None when that month has no file; ``expected`` has dataset_code. The
    numbers ``n_new_periods`` and ``n_removed_periods`` count all changes, and their rows are added to ``details``; the maps
    beside them name at most ``FREE_SHOWN`` free labels.
    """
    want = expected.select("dataset_code").distinct().withColumn("expected", F.lit(True))
    if current is None:
        return want.select("dataset_code", "expected", F.lit("not_processed").alias("status"), *_empty_facts())
    now = snapshot_profile(current)
    then = snapshot_profile(previous) if previous is not None else now.filter(F.lit(False))
    has_previous = F.lit(previous is not None)
    c = dataset_summary(now).select("dataset_code", F.col("n_rows").alias("_n"), F.col("extracted_at").alias("_at"))
    p = dataset_summary(then).select("dataset_code", F.col("n_rows").alias("_pn"), F.col("extracted_at").alias("_pat"))
    joined = want.join(c, "dataset_code", "full_outer").join(p, "dataset_code", "full_outer")
    status = (
        F.when(F.col("_n").isNull(), "missing")
        .when(~has_previous, "baseline")
        .when(F.col("_pn").isNull(), "new_dataset")
        .when(F.col("_at") > F.col("_pat"), "updated")
        .otherwise("not_updated")
    )
    present, compared = F.col("_n").isNotNull(), F.col("_pn").isNotNull() & F.col("_n").isNotNull()
    base = joined.select(
        "dataset_code", F.coalesce("expected", F.lit(False)).alias("expected"), status.alias("status"),
        F.col("_n").alias("n_rows"), F.to_date("_at").alias("extracted_on"),
        F.when(~present, F.to_date("_pat")).alias("last_extracted_on"),
        F.when(compared, F.col("_n") - F.col("_pn")).alias("rows_change"))
    periods, earlier = Periods.of(now), Periods.of(then)
    # datasets with periods on both sides; one that is wholly new or gone has no changes but a status
    compared_codes = periods.summary().select("dataset_code").distinct().join(
        earlier.summary().select("dataset_code").distinct(), "dataset_code")
    changes = checkpointed(changes_of(periods, earlier, compared_codes))
    if details is not None:
        details.append(changes)
    counts = changes.groupBy("dataset_code").agg(*[
        F.count_if(F.col("change") == c).alias(f"n_{c}_periods") for c in ("new", "removed")])
    out = base.join(frequency_map(periods.summary(), "latest_period", "latest_period"), "dataset_code", "left") \
        .join(counts, "dataset_code", "left")
    for name, change in [("new_periods", "new"), ("removed_periods", "removed")]:
        mine = changes.filter(F.col("change") == change)
        out = out.join(by_frequency(mine.drop("change"), name), "dataset_code", "left")
    none = F.map_from_entries(F.array().cast("array<struct<k: string, v: array<string>>>"))
    return out.withColumns({n: F.when(F.col("rows_change").isNotNull(), F.coalesce(F.col(n), empty))
                            for n, empty in (("new_periods", none), ("removed_periods", none),
                                             ("n_new_periods", F.lit(0)), ("n_removed_periods", F.lit(0)))})


def _empty_facts() -> list[Column]:
    empty = {"n_rows": "bigint", "extracted_on": "date", "last_extracted_on": "date", "rows_change": "bigint",
             "latest_period": "map<string, string>", "new_periods": "map<string, array<string>>",
             "removed_periods": "map<string, array<string>>", "n_new_periods": "bigint", "n_removed_periods": "bigint"}
    return [F.lit(None).cast(t).alias(n) for n, t in empty.items()]


def domain_facts(domain: str, month: str, months: dict[str, DataFrame], expected: DataFrame,
                 details: list[DataFrame] | None = None) -> DataFrame:
    """Compare one domain's snapshot of ``month`` with the newest earlier one."""
    earlier = [m for m in months if m < month]
    before = max(earlier) if earlier else None
    facts = compare(months.get(month), months.get(before) if before else None, expected, details)
    return facts.withColumns({
        "domain": F.lit(domain), "previous_month": F.lit(before).cast("string"),
        "domain_status": F.lit("processed" if month in months else "not_processed")})


def has_new(facts: DataFrame | None = None) -> Column:
    return F.coalesce(F.size("new_periods") > 0, F.lit(False))


def totals(facts: DataFrame, month: str) -> DataFrame:
    """The headline numbers of a release, one row."""
    counts = {s: F.count_if(F.col("status") == s) for s in STATUSES}
    return facts.agg(
        F.lit(month).alias("month"),
        F.when(F.count_distinct("previous_month") == 1, F.max("previous_month")).alias("previous_month"),
        F.count("*").alias("n_dataset"),
        counts["updated"].alias("n_aggiornati"),
        F.count_if(has_new()).alias("n_nuovi_periodi"),
        counts["not_updated"].alias("n_non_aggiornati"),
        (counts["missing"] + counts["not_processed"]).alias("n_mancanti"),
        counts["new_dataset"].alias("n_nuovi_dataset"),
        (counts["baseline"] > 0).alias("prima_rilevazione"))


def status_counts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("status").agg(F.count("*").alias("n_datasets"))
