"""Release comparison: line items shipped by the end of 2000 are the previous snapshot, all but one mode the current."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import periodsets
from ..plans import release, report
from ..registry import inline
from ..session import checkpointed
from .base import Tables, query

MONTH = "2001-11"
# Datasets are 'brand x return flag'; periods are months, quarters, years or free labels depending on the supplier.
_CODE = "p_brand || '/' || l_returnflag"
_TIME = """CASE WHEN l_suppkey % 50 = 7 THEN 'n.d.' WHEN l_suppkey % 4 = 0 THEN {y} WHEN l_suppkey % 4 = 1 THEN {y} || '-Q' || CAST(quarter(l_shipdate) AS VARCHAR)
    ELSE {m} END"""
SNAP_SQL = f"""src AS (SELECT {_CODE} AS dataset_code, {_TIME.format(y="strftime(l_shipdate, '%Y')", m="strftime(l_shipdate, '%Y-%m')")} AS time,
        CASE WHEN p_size % 2 = 0 THEN l_shipdate ELSE least(l_shipdate, TIMESTAMP '2000-06-30') END AS seen, l_shipdate, p_brand, l_returnflag
        FROM lineitem JOIN part ON l_partkey = p_partkey),
    prev AS (SELECT * FROM src WHERE l_shipdate < TIMESTAMP '2000-07-01' AND dataset_code <> 'Brand#3/N'),
    cur AS (SELECT * FROM src WHERE dataset_code <> 'Brand#5/A' AND NOT (p_brand = 'Brand#7' AND l_shipdate >= TIMESTAMP '2000-07-01')
        AND NOT (p_brand = 'Brand#9' AND year(l_shipdate) = 1996)),
    want AS (SELECT DISTINCT dataset_code FROM src WHERE p_brand <> 'Brand#11' UNION ALL SELECT 'Brand#0/X'),
    cs AS (SELECT dataset_code, count(*) AS n, max(seen) AS seen FROM cur GROUP BY 1),
    ps AS (SELECT dataset_code, count(*) AS n, max(seen) AS seen FROM prev GROUP BY 1),
    cp AS (SELECT DISTINCT dataset_code, time AS period FROM cur), pp AS (SELECT DISTINCT dataset_code, time AS period FROM prev),
    fq AS (SELECT period, CASE WHEN length(period) = 4 AND period <> 'n.d.' THEN 'A' WHEN contains(period, 'Q') THEN 'Q' WHEN period = 'n.d.' THEN '?' ELSE 'M' END AS f
        FROM (SELECT period FROM cp UNION SELECT period FROM pp)),
    chg AS (SELECT coalesce(cp.dataset_code, pp.dataset_code) AS dataset_code, coalesce(cp.period, pp.period) AS period,
        CASE WHEN pp.period IS NULL THEN 'new' ELSE 'removed' END AS change FROM cp FULL JOIN pp ON cp.dataset_code = pp.dataset_code
        AND cp.period = pp.period WHERE (cp.period IS NULL OR pp.period IS NULL)),
    both_sides AS (SELECT chg.*, f AS frequency FROM chg JOIN fq USING (period) WHERE dataset_code IN (SELECT dataset_code FROM cs)
        AND dataset_code IN (SELECT dataset_code FROM ps)),
    codes AS (SELECT dataset_code FROM want UNION SELECT dataset_code FROM cs UNION SELECT dataset_code FROM ps),
    facts AS (SELECT codes.dataset_code, want.dataset_code IS NOT NULL AS expected,
        CASE WHEN cs.n IS NULL THEN 'missing' WHEN ps.n IS NULL THEN 'new_dataset' WHEN cs.seen > ps.seen THEN 'updated' ELSE 'not_updated' END AS status,
        cs.n AS n_rows, CAST(cs.seen AS DATE) AS extracted_on, CASE WHEN cs.n IS NULL THEN CAST(ps.seen AS DATE) END AS last_extracted_on,
        cs.n - ps.n AS rows_change,
        (SELECT string_agg(period, ',' ORDER BY period) FROM both_sides b WHERE b.dataset_code = codes.dataset_code AND change = 'new') AS new_periods,
        (SELECT string_agg(period, ',' ORDER BY period) FROM both_sides b WHERE b.dataset_code = codes.dataset_code AND change = 'removed') AS removed_periods,
        (SELECT string_agg(f || '=' || p, ',' ORDER BY f) FROM (SELECT f, max(cp.period) AS p FROM cp JOIN fq USING (period)
            WHERE cp.dataset_code = codes.dataset_code GROUP BY f)) AS latest
      FROM codes LEFT JOIN want USING (dataset_code) LEFT JOIN cs USING (dataset_code) LEFT JOIN ps USING (dataset_code))"""


def snapshots(t: Tables):
    y, m = "date_format(l_shipdate, 'yyyy')", "date_format(l_shipdate, 'yyyy-MM')"
    src = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.expr(_CODE).alias("dataset_code"), F.expr(_TIME.format(y=y, m=m).replace("VARCHAR", "STRING")).alias("time"),
        F.when(F.col("p_size") % 2 == 0, F.col("l_shipdate"))
        .otherwise(F.least("l_shipdate", F.lit("2000-06-30").cast("timestamp_ntz"))).alias("extracted_at"),
        "l_shipdate", "p_brand")
    cut = F.lit("2000-07-01").cast("timestamp_ntz")
    previous = src.filter((F.col("l_shipdate") < cut) & (F.col("dataset_code") != "Brand#3/N"))
    current = src.filter(
        (F.col("dataset_code") != "Brand#5/A") & ~((F.col("p_brand") == "Brand#7") & (F.col("l_shipdate") >= cut))
        & ~((F.col("p_brand") == "Brand#9") & (F.year("l_shipdate") == 1996)))
    expected = src.filter("p_brand <> 'Brand#11'").select("dataset_code").distinct() \
        .union(inline(t.spark, [("Brand#0/X",)], "dataset_code string"))
    return current, previous, expected


def release_facts(t: Tables):
    current, previous, expected = snapshots(t)
    return release.domain_facts("labour", MONTH, {MONTH: current, "2001-10": previous}, expected)


def flat_periods(c: str):
    joined = F.array_join(F.array_sort(F.flatten(F.map_values(c))), ",")
    return F.when(joined != "", joined)


@query("release_diff", f"""WITH {SNAP_SQL} SELECT * FROM facts""")
def release_diff(t):
    latest = F.transform(F.array_sort(F.map_entries("latest_period")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return release_facts(t).select(
        "dataset_code", "expected", "status", "n_rows", "extracted_on", "last_extracted_on", "rows_change",
        flat_periods("new_periods").alias("new_periods"), flat_periods("removed_periods").alias("removed_periods"),
        F.array_join(latest, ",").alias("latest"))


@query("release_not_processed", f"""
    WITH {SNAP_SQL} SELECT dataset_code, true AS expected, 'not_processed' AS status, CAST(NULL AS BIGINT) AS n_rows FROM want""")
def release_not_processed(t):
    _, previous, expected = snapshots(t)
    return release.domain_facts("labour", MONTH, {"2001-10": previous}, expected).select(
        "dataset_code", "expected", "status", "n_rows")


@query("release_baseline", f"""
    WITH {SNAP_SQL} SELECT codes.dataset_code, CASE WHEN cs.n IS NULL THEN 'missing' ELSE 'baseline' END AS status, cs.n AS n_rows
    FROM (SELECT dataset_code FROM want UNION SELECT dataset_code FROM cs) codes LEFT JOIN cs USING (dataset_code)""")
def release_baseline(t):
    current, _, expected = snapshots(t)
    return release.domain_facts("labour", MONTH, {MONTH: current}, expected).select("dataset_code", "status", "n_rows")


@query("dataset_summary", f"""
    WITH {SNAP_SQL} SELECT dataset_code, count(*) AS n_rows, CAST(max(seen) AS DATE) AS extracted_on FROM cur GROUP BY 1""")
def dataset_summary(t):
    current, _, _ = snapshots(t)
    return release.dataset_summary(release.snapshot_profile(current)).select(
        "dataset_code", "n_rows", F.to_date("extracted_at").alias("extracted_on"))


@query("periods_by_frequency", f"""
    WITH {SNAP_SQL} SELECT dataset_code, f AS frequency, count(*) AS n_periods, min(period) AS first_period, max(period) AS latest_period
    FROM cp JOIN fq USING (period) GROUP BY 1, 2""")
def periods_by_frequency(t):
    current, _, _ = snapshots(t)
    return release.Periods.of(release.snapshot_profile(current)).summary()


@query("period_sets", f"""
    WITH {SNAP_SQL} SELECT coalesce(cp.dataset_code, pp.dataset_code) AS dataset_code, f AS frequency,
        count(*) FILTER (cp.period IS NOT NULL) AS n_now, count(*) FILTER (pp.period IS NOT NULL) AS n_then,
        count(*) FILTER (cp.period IS NOT NULL AND pp.period IS NOT NULL) AS n_both,
        count(*) FILTER (pp.period IS NULL) AS n_added, count(*) FILTER (cp.period IS NULL) AS n_gone
    FROM cp FULL JOIN pp ON cp.dataset_code = pp.dataset_code AND cp.period = pp.period
    JOIN fq ON fq.period = coalesce(cp.period, pp.period) WHERE f <> '?' GROUP BY 1, 2""")
def period_sets(t):
    current, previous, _ = snapshots(t)
    sets = [release.Periods.of(release.snapshot_profile(s)).sets for s in (current, previous)]
    words = periodsets.differences(periodsets.paired(*sets, ["dataset_code"]))
    counts = {"n_now": F.col("now"), "n_then": F.col("then"), "n_both": F.col("now").bitwiseAND(F.col("then")),
              "n_added": F.col("added"), "n_gone": F.col("gone")}
    return words.groupBy("dataset_code", "frequency").agg(*[F.sum(F.bit_count(c)).cast("bigint").alias(n) for n, c in counts.items()])


@query("release_change_counts", f"""
    WITH {SNAP_SQL} SELECT dataset_code, n_rows, CASE WHEN rows_change IS NOT NULL THEN
        (SELECT count(*) FROM both_sides b WHERE b.dataset_code = facts.dataset_code AND change = 'new') END AS n_new_periods,
        CASE WHEN rows_change IS NOT NULL THEN
        (SELECT count(*) FROM both_sides b WHERE b.dataset_code = facts.dataset_code AND change = 'removed') END AS n_removed_periods
    FROM facts""")
def release_change_counts(t):
    return release_facts(t).select("dataset_code", "n_rows", "n_new_periods", "n_removed_periods")


@query("period_changes", f"WITH {SNAP_SQL} SELECT dataset_code, period, frequency, change FROM both_sides")
def period_changes(t):
    current, previous, _ = snapshots(t)
    return release.period_changes(release.dataset_periods(release.snapshot_profile(current)),
                                  release.dataset_periods(release.snapshot_profile(previous)))


TOTALS_SQL = f"""{SNAP_SQL}, tot AS (SELECT '{MONTH}' AS month, '2001-10' AS previous_month, count(*) AS n_dataset,
        count(*) FILTER (status = 'updated') AS n_aggiornati, count(*) FILTER (new_periods IS NOT NULL) AS n_nuovi_periodi,
        count(*) FILTER (status = 'not_updated') AS n_non_aggiornati, count(*) FILTER (status = 'missing') AS n_mancanti,
        count(*) FILTER (status = 'new_dataset') AS n_nuovi_dataset, false AS prima_rilevazione FROM facts)"""


@query("release_totals", f"WITH {TOTALS_SQL} SELECT * FROM tot")
def release_totals(t):
    return release.totals(release_facts(t), MONTH)


@query("release_status_counts", f"WITH {SNAP_SQL} SELECT status, count(*) AS n_datasets FROM facts GROUP BY 1")
def release_status_counts(t):
    return release.status_counts(release_facts(t))


def _it(n: str) -> str:
    return f"replace(format('{{:,}}', {n}), ',', '.')"


SENTENCE_SQL = f"""issues AS (SELECT *, list_filter([
        CASE WHEN n_non_aggiornati > 0 THEN {_it('n_non_aggiornati')} || ' dataset non ' || CASE n_non_aggiornati WHEN 1 THEN 'aggiornato' ELSE 'aggiornati' END END,
        CASE WHEN n_mancanti > 0 THEN {_it('n_mancanti')} || ' ' || CASE n_mancanti WHEN 1 THEN 'mancante' ELSE 'mancanti' END END,
        CASE WHEN n_nuovi_dataset > 0 THEN {_it('n_nuovi_dataset')} || ' ' || CASE n_nuovi_dataset WHEN 1 THEN 'nuovo' ELSE 'nuovi' END END],
        lambda x: x IS NOT NULL) AS p FROM tot),
    sentence AS (SELECT 'Riepilogo dell''aggiornamento dati di novembre 2001, rispetto a ottobre 2001. Dei ' || {_it('n_dataset')} || ' dataset monitorati, '
        || {_it('n_aggiornati')} || CASE n_aggiornati WHEN 1 THEN ' è stato scaricato' ELSE ' sono stati scaricati' END || ' di nuovo dalla fonte'
        || CASE WHEN n_nuovi_periodi > 0 THEN ' e ' || {_it('n_nuovi_periodi')} || CASE n_nuovi_periodi WHEN 1 THEN ' contiene' ELSE ' contengono' END
        || ' periodi nuovi.' ELSE ', ma nessuno contiene periodi nuovi.' END || CASE WHEN len(p) = 0 THEN '' ELSE ' Da verificare: ' ||
        CASE WHEN len(p) = 1 THEN p[1] ELSE array_to_string(p[1:len(p) - 1], ', ') || ' e ' || p[len(p)] END || '.' END AS sentence
    FROM issues)"""


@query("release_sentence", f"WITH {TOTALS_SQL}, {SENTENCE_SQL} SELECT sentence FROM sentence")
def release_sentence(t):
    return report.summary_sentence(release.totals(release_facts(t), MONTH)).select("sentence")


_MONTHS = "['gennaio','febbraio','marzo','aprile','maggio','giugno','luglio','agosto','settembre','ottobre','novembre','dicembre']"
_RUNS_SQL = f"""ordn AS (SELECT dataset_code, frequency, period, CASE frequency WHEN 'M' THEN CAST(substring(period, 1, 4) AS BIGINT) * 12 + CAST(substring(period, 6, 2) AS BIGINT) - 1
        WHEN 'Q' THEN CAST(substring(period, 1, 4) AS BIGINT) * 4 + CAST(substring(period, 7, 1) AS BIGINT) - 1
        WHEN 'A' THEN CAST(period AS BIGINT) END AS o FROM both_sides WHERE change = 'new'),
    isl AS (SELECT *, o - row_number() OVER (PARTITION BY dataset_code, frequency ORDER BY o) AS g FROM ordn WHERE frequency <> '?'),
    rn AS (SELECT dataset_code, frequency, min(o) AS a, max(o) AS b, count(*) AS n FROM isl GROUP BY dataset_code, frequency, g),
    parts AS (SELECT *, {_MONTHS} AS mm, ['I','II','III','IV'] AS qq, CASE frequency WHEN 'M' THEN a // 12 WHEN 'Q' THEN a // 4 ELSE a END AS ya,
        CASE frequency WHEN 'M' THEN b // 12 WHEN 'Q' THEN b // 4 ELSE b END AS yb FROM rn),
    txt AS (SELECT dataset_code, frequency, a, n, CASE frequency
        WHEN 'M' THEN CASE WHEN a = b THEN mm[a % 12 + 1] || ' ' || ya WHEN ya = yb THEN 'da ' || mm[a % 12 + 1] || ' a ' || mm[b % 12 + 1] || ' ' || yb
            ELSE 'da ' || mm[a % 12 + 1] || ' ' || ya || ' a ' || mm[b % 12 + 1] || ' ' || yb END
        WHEN 'Q' THEN CASE WHEN a = b THEN qq[a % 4 + 1] || ' trimestre ' || ya
            WHEN ya = yb AND b = a + 1 THEN qq[a % 4 + 1] || ' e ' || qq[b % 4 + 1] || ' trimestre ' || yb
            WHEN ya = yb THEN 'dal ' || qq[a % 4 + 1] || ' al ' || qq[b % 4 + 1] || ' trimestre ' || yb
            ELSE 'dal ' || qq[a % 4 + 1] || ' trimestre ' || ya || ' al ' || qq[b % 4 + 1] || ' trimestre ' || yb END
        ELSE CASE WHEN a = b THEN 'anno ' || a WHEN b = a + 1 THEN 'anni ' || a || ' e ' || b ELSE 'dal ' || a || ' al ' || b END END AS t FROM parts),
    per AS (SELECT dataset_code, frequency, CASE frequency WHEN 'M' THEN 1 WHEN 'Q' THEN 2 ELSE 3 END AS r, string_agg(t, ', ' ORDER BY a)
        || CASE WHEN frequency = 'M' AND sum(n) > 1 THEN ' (' || CAST(sum(n) AS BIGINT) || ' mesi)' ELSE '' END AS t FROM txt GROUP BY 1, 2
        UNION ALL SELECT dataset_code, '?', 4, string_agg(period, ', ' ORDER BY period) FROM ordn WHERE frequency = '?' GROUP BY 1),
    words AS (SELECT dataset_code, string_agg(t, '; ' ORDER BY r) AS periods_it FROM per GROUP BY 1)"""


@query("new_periods_in_words", f"WITH {SNAP_SQL}, {_RUNS_SQL} SELECT * FROM words")
def new_periods_in_words(t):
    changes = period_changes(t).filter("change = 'new'")
    return report.periods_in_words(changes, ["dataset_code"])


def labels(t: Tables):
    """A label for most datasets."""
    return t.part.filter("p_brand <> 'Brand#2'").select("p_brand").distinct().withColumn(
        "_flag", F.explode(F.array(*[F.lit(f) for f in "ANR"]))).select(
        F.concat("p_brand", F.lit("/"), F.col("_flag")).alias("dataset_code"), F.lit("ISTAT").alias("fonte"),
        F.concat(F.lit("Serie "), F.col("p_brand")).alias("label_it"))


_DAY = f"(CASE WHEN day({{0}}) = 1 THEN '1º' ELSE CAST(day({{0}}) AS VARCHAR) END || ' ' || {_MONTHS}[month({{0}})] || ' ' || year({{0}}))"
_LATEST = f"""(SELECT string_agg(CASE f WHEN 'M' THEN {_MONTHS}[CAST(substring(p, 6, 2) AS INTEGER)] || ' ' || substring(p, 1, 4)
        WHEN 'Q' THEN ['I','II','III','IV'][CAST(substring(p, 7, 1) AS INTEGER)] || ' trimestre ' || substring(p, 1, 4) ELSE p END, ' / '
        ORDER BY CASE f WHEN 'M' THEN 1 WHEN 'Q' THEN 2 WHEN 'A' THEN 3 ELSE 4 END)
    FROM (SELECT f, max(cp.period) AS p FROM cp JOIN fq USING (period) WHERE cp.dataset_code = facts.dataset_code GROUP BY f))"""


@query("report_lines", f"""
    WITH {TOTALS_SQL}, {SENTENCE_SQL}, {_RUNS_SQL},
    nm AS (SELECT dataset_code, p_brand <> 'Brand#2' AS has, 'Serie ' || p_brand AS label FROM (SELECT dataset_code, split_part(dataset_code, '/', 1) AS p_brand FROM codes)
        WHERE p_brand IN (SELECT p_brand FROM part)),
    named AS (SELECT facts.*, words.periods_it, CASE WHEN coalesce(has, false) THEN '**' || label || '** (Lavoro, ISTAT, `' || dataset_code || '`)'
            ELSE '`' || dataset_code || '` (Lavoro, `' || dataset_code || '`)' END AS name,
        CASE WHEN coalesce(has, false) THEN '**' || label || '** (ISTAT, `' || dataset_code || '`)' ELSE '`' || dataset_code || '` (`' || dataset_code || '`)' END AS plain,
        {_LATEST} AS last_words
      FROM facts LEFT JOIN nm USING (dataset_code) LEFT JOIN words USING (dataset_code)),
    body AS (SELECT 20 AS section, 12 AS position, dataset_code, '- ' || name || ': ' || periods_it || '.' AS line FROM named WHERE new_periods IS NOT NULL
    UNION ALL
    SELECT 30, 1002, dataset_code, '- ' || name || CASE status
        WHEN 'not_updated' THEN ': non aggiornato. I dati risalgono all''estrazione del ' || {_DAY.format('extracted_on')} || ' (ultimo periodo: ' || last_words || ').'
        WHEN 'missing' THEN ': assente dal file elaborato (' || CASE WHEN last_extracted_on IS NOT NULL THEN 'ultima estrazione disponibile: ' || {_DAY.format('last_extracted_on')}
            ELSE 'assente anche nell''elaborazione precedente' END || ').'
        ELSE ': nuovo dataset, assente nell''elaborazione precedente.' END
    FROM named WHERE status IN ('not_updated', 'missing', 'new_dataset')
    UNION ALL
    SELECT 40, 12, dataset_code, '| Lavoro | ' || plain || ' | ' || last_words || ' | ' || CASE WHEN rows_change = 0 THEN 'nessuna'
        WHEN rows_change > 0 THEN '+' || {_it('rows_change')} ELSE '−' || {_it('-rows_change')} END || ' |'
    FROM named WHERE status = 'updated' AND new_periods IS NULL),
    fixed AS (
        SELECT 10 AS section, unnest([0, 1, 2, 3]) AS position, unnest(['# Aggiornamento dati: novembre 2001', '', sentence, '']) AS line FROM sentence
        UNION ALL SELECT 20, unnest([0, 1, 9000]), unnest(['## Nuovi periodi disponibili', '', '']) FROM (SELECT 1 FROM body WHERE section = 20 LIMIT 1)
        UNION ALL SELECT 30, unnest([0, 1, 9000]), unnest(['## Da verificare', '', '']) FROM (SELECT 1 FROM body WHERE section = 30 LIMIT 1)
        UNION ALL SELECT 40, unnest([0, 1, 2, 3, 9000, 9001, 9002]), unnest(['## Altri dataset', '', '| Dominio | Dataset | Ultimo periodo | Variazione righe |',
            '|---|---|---|---|', '', 'Le variazioni nel numero di righe possono derivare da dati arrivati in ritardo alla fonte oppure da modifiche alla pipeline.', ''])
            FROM (SELECT 1 FROM body WHERE section = 40 LIMIT 1)
        UNION ALL SELECT 90, unnest([0, 1, 2]), unnest(['---', '', '_Generato automaticamente il 1º dicembre 2001 (esecuzione locale). '
            || 'Il riepilogo descrive quali dati sono stati aggiornati e non riporta valori statistici._']))
    SELECT section, position, dataset_code, line FROM body UNION ALL SELECT section, position, '', line FROM fixed""")
def report_lines(t):
    facts = checkpointed(release_facts(t))
    lines = report.report_lines(facts, labels(t), release.totals(facts, MONTH), MONTH, date(2001, 12, 1))
    return lines.select("section", "position", "dataset_code", "line")
