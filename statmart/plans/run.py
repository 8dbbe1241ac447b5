"""The monthly run: merge each domain, build the star, check it, report the release."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..registry import DOMAINS, MIN_DIMENSION_ROWS, Domain, dataset_table, inline, select_domains
from ..schemas import DIMENSIONS, FACTS, RAW_METADATA
from ..session import checkpointed, file_system, scratch
from ..sources import mappings
from ..sources.landing import append_load_log, create_if_absent, publish, publish_counted, write_lines, write_run_log
from ..sources.layers import MonthFiles, Months, PartitionedMonths
from ..sources.snapshots import open_or_empty
from . import marts, quality, release, report, warehouse
from .ingest import ingest
from .merge import merge_domain, merge_reports, read_raw

log = logging.getLogger("statmart")


class Layout:
    """Where the layers live below one root. ``partitioned``: the raw and the processed layer are one table per domain,
    partitioned by dataset and month, or by month; otherwise there is a file (or folder) per snapshot."""

    def __init__(self, root: str, seeds: str, partitioned: bool = False):
        self.root, self.seeds, self.partitioned = root.rstrip("/"), seeds.rstrip("/"), partitioned
        self.raw, self.processed = f"{self.root}/raw", f"{self.root}/processed"

    def raw_layer(self, spark: SparkSession, domain: Domain) -> Months:
        root = f"{self.raw}/{domain.name}"
        return PartitionedMonths(spark, root) if self.partitioned else MonthFiles(spark, root)

    def processed_layer(self, spark: SparkSession, domain: Domain) -> Months:
        root = f"{self.processed}/{domain.name}"
        return PartitionedMonths(spark, root, domain.name) if self.partitioned else MonthFiles(spark, root)

    def table(self, name: str) -> str:
        return f"{self.root}/warehouse/{name}"

    def seed(self, spark: SparkSession, name: str) -> DataFrame:
        return mappings.read_mapping(spark, f"{self.seeds}/{name}")


def process(spark: SparkSession, layout: Layout, domain: Domain, month: str) -> int:
    """Merge a domain's newest landed datasets into this month's processed snapshot. Nothing is written if empty.

    Datasets that could not be opened are raised by name after the others have been written.
    """
    failed: dict[str, str] = {}
    raw = read_raw(spark, layout.raw, domain, failed=failed, layer=layout.raw_layer(spark, domain))
    absent = [d.code for d in domain.datasets if d.code not in raw and d.code not in failed]
    if absent:
        log.warning("%s: no landed snapshot of %s", domain.name, ", ".join(absent))
    merged = merge_domain(
        domain, raw, layout.seed(spark, mappings.CROSSWALK),
        layout.seed(spark, mappings.LEGAL_FORMS), layout.seed(spark, mappings.ACTIVITIES))
    layer = layout.processed_layer(spark, domain)
    n = layer.write(merged, domain.name, month, RAW_METADATA)["n_rows"]
    if n:
        for name, df in merge_reports(
                domain, raw, layer.open(domain.name, month),
                layout.seed(spark, mappings.CROSSWALK), layout.seed(spark, mappings.LEGAL_FORMS)).items():
            publish(df, f"{layout.root}/reports/{domain.name}_{name}_{month}")
    if failed:
        raise RuntimeError("unreadable snapshots: " + ", ".join(f"{c} ({e})" for c, e in failed.items()))
    return n


def load_dimensions(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {name: open_or_empty(spark, layout.table(name), schema) for name, schema in DIMENSIONS.items()}


def build(spark: SparkSession, layout: Layout, domains: list[Domain], at: datetime) -> dict[str, int]:
    """Refresh the dimensions, then replace each domain's fact table with its newest processed snapshot."""
    for name, schema in {**DIMENSIONS, **FACTS}.items():
        create_if_absent(spark, layout.table(name), schema)
    dims = warehouse.refresh_dimensions(
        load_dimensions(spark, layout), layout.seed(spark, mappings.CROSSWALK),
        layout.seed(spark, mappings.SOURCES), layout.seed(spark, mappings.LEGAL_FORMS))
    for name, df in dims.items():
        publish(df, layout.table(name))
    counts = {}
    for domain in domains:
        layer = layout.processed_layer(spark, domain)
        month = layer.newest([domain.name]).get(domain.name)
        if month is None:
            counts[domain.name] = 0
            continue
        # the dimension goes first and is read back: facts never point at keys that are not published yet, and
        # Catalyst knows the real size of every dimension when it plans the joins
        kept, out_of_scope = warehouse.in_scope_rows(layer.open(domain.name, month))
        geography = load_dimensions(spark, layout)["dim_geography"]
        publish(warehouse.add_unseen_territories(geography, kept), layout.table("dim_geography"))
        keyed = checkpointed(warehouse.with_keys(kept, load_dimensions(spark, layout)))   # the joins run once
        counts[domain.name] = publish(warehouse.fact_table(keyed, domain.fact), layout.table(domain.fact))
        publish(out_of_scope, layout.table(f"quarantine_scope_{domain.name}"))
        publish(keyed.filter(F.col("unresolved_key").isNotNull()), layout.table(f"quarantine_keys_{domain.name}"))
        append_load_log(spark, layout.table("load_log"), domain.name, layer.place(domain.name, month), counts[domain.name], at)
    return counts


def flat_marts(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    dims = load_dimensions(spark, layout)
    fact = {n: open_or_empty(spark, layout.table(n), FACTS[n]) for n in ("fact_social_economy", "fact_labour")}
    return {"social_economy": marts.social_economy(fact["fact_social_economy"], dims),
            "labour": marts.labour(fact["fact_labour"], dims)}


def code_lists(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """The code lists of the mappings folder, if there are any."""
    fs, where = file_system(spark, f"{layout.seeds}/{mappings.CODE_LISTS}")
    return layout.seed(spark, mappings.CODE_LISTS) if fs.exists(where) else None


def publish_marts(spark: SparkSession, layout: Layout) -> int:
    """Write every mart; the number of marts.

    The star of a domain is joined once, for its flat mart. The labelled mart and, in one job, all filtered marts (one
    table, partitioned by mart) are made from the flat mart as published.
    """
    n = 0
    for name, df in flat_marts(spark, layout).items():
        publish(df, layout.table(f"mart_{name}"))
        flat = spark.read.parquet(layout.table(f"mart_{name}"))
        publish(marts.labelled(flat, name, code_lists(spark, layout)), layout.table(f"mart_{name}_labelled"))
        publish_counted(marts.spread(flat, name), layout.table(f"marts_{name}"), by=[marts.NAME])
        n += 2 + sum(m.base == name for m in marts.marts().values())
    return n


def published_marts(spark: SparkSession, layout: Layout, domain: str) -> dict[str, DataFrame | None]:
    """The marts of a domain as they lie there; None for one that is missing."""
    def table(name: str, columns: StructType | None = None) -> DataFrame | None:
        fs, where = file_system(spark, layout.table(name))
        reader = spark.read.schema(columns) if columns else spark.read
        return reader.parquet(layout.table(name)) if fs.exists(where) else None

    out = {f"mart_{name}": table(f"mart_{name}") for name in (domain, f"{domain}_labelled")}
    flat = out[f"mart_{domain}"]
    # a table without any row has no file to tell its columns
    spread = table(f"marts_{domain}", marts.spread(flat, domain).schema) if flat is not None else None
    return out | {f"mart_{n}": marts.mart_of(spread, n) if spread is not None else None
                  for n, m in marts.marts().items() if m.base == domain}


def check(spark: SparkSession, layout: Layout, domains: list[Domain], now: datetime) -> DataFrame:
    dims = load_dimensions(spark, layout)
    # a dimension must hold at least what its mapping table lists
    minimums = {
        **MIN_DIMENSION_ROWS,
        "dim_source": layout.seed(spark, mappings.SOURCES).select("source_id").dropna().distinct().count(),
        "dim_legal_form": layout.seed(spark, mappings.LEGAL_FORMS).count(),
    }
    checks = quality.dimension_checks(dims, minimums) + quality.geography_checks(dims["dim_geography"], {0: 1, 2: 21, 3: 107})
    checks += quality.unregistered(spark, [d.name for d in domains], DOMAINS, requested=False)
    for domain in domains:
        if domain.checks:
            fact = open_or_empty(spark, layout.table(domain.fact), FACTS[domain.fact])
            checks += quality.fact_checks(domain, fact, dims, F.lit(now), published_marts(spark, layout, domain.name))
    publish(quality.check_details(spark, checks), layout.table("check_details"))
    return quality.run_checks(spark, checks)


def compare_release(spark: SparkSession, layout: Layout, domains: list[Domain], month: str,
                    details: list[DataFrame] | None = None) -> DataFrame:
    """Release facts of all domains for one month."""
    frames = []
    for domain in domains:
        layer = layout.processed_layer(spark, domain)
        months = {m: layer.open(domain.name, m) for m in layer.latest_two(domain.name, month)}
        frames.append(release.domain_facts(domain.name, month, months, dataset_table(spark, domain.name), details))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def digest(spark: SparkSession, layout: Layout, domains: list[Domain], month: str, today: date) -> str:
    """Write the audit record first, then the report, so that a report never exists without its facts. Every period that is
    new or gone is a row of a table beside them."""
    details: list[DataFrame] = []
    facts = compare_release(spark, layout, domains, month, details)
    facts.write.mode("overwrite").json(f"{layout.root}/summaries/{month}.json")
    if details:
        publish(reduce(DataFrame.unionByName, details), f"{layout.root}/summaries/{month}_periods")
    facts = spark.read.schema(facts.schema).json(f"{layout.root}/summaries/{month}.json")
    try:
        labels = layout.seed(spark, mappings.DATASET_LABELS)
    except Exception:  # noqa: BLE001  labels are optional: codes are shown instead
        labels = inline(spark, [], "dataset_code string, fonte string, label_it string")
    lines = report.report_lines(facts, labels, release.totals(facts, month), month, today,
                                domain_order=[d.name for d in domains])
    path = f"{layout.root}/summaries/{month}.md"
    write_lines(lines, path, report.ORDER)
    return path


def run(spark: SparkSession, layout: Layout, month: str, requested: list[str] | None = None,
        now: datetime | None = None, landed: str | None = None) -> bool:
    """All stages in order, beginning with the response files below ``landed`` if there are any. A failing domain or stage is logged and does not stop the others; False if any failed."""
    at = now or datetime.now(timezone.utc).replace(tzinfo=None)
    domains = select_domains(requested)
    rows: list[tuple] = []

    def stage(name: str, domain: str, work: Callable[[], int | None]) -> None:
        started = datetime.now(timezone.utc).replace(tzinfo=None)
        status, n, error = "ok", None, None
        try:
            with scratch(spark):
                n = work()
        except Exception as e:  # noqa: BLE001
            status, error = "failed", f"{type(e).__name__}: {e}"
        rows.append((name, domain, status, n, error, started, datetime.now(timezone.utc).replace(tzinfo=None)))

    if landed:
        for d in domains:
            stage("ingest", d.name, lambda d=d: sum(ingest(
                spark, landed, layout.raw, d, month, at, layout.raw_layer(spark, d)).values()))
    for d in domains:
        stage("process", d.name, lambda d=d: process(spark, layout, d, month))
    stage("database", "*", lambda: sum(build(spark, layout, domains, at).values()))

    stage("marts", "*", lambda: publish_marts(spark, layout))

    def checks() -> int:
        found = check(spark, layout, domains, at)
        found.write.mode("overwrite").parquet(layout.table("check_results"))
        return found.count()

    stage("checks", "*", checks)
    stage("digest", "*", lambda: len(digest(spark, layout, domains, month, at.date())) and None)
    write_run_log(spark, f"{layout.root}/logs/run_log", rows)
    return all(r[2] == "ok" for r in rows)
