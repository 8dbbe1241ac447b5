"""Paragraph rules over the document and conversation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import paragraphs as p
from ..plans import release
from ..session import checkpointed
from .base import Tables, query
from .releases import MONTH, SNAP_SQL, TOTALS_SQL, labels, release_facts

# RE2 has ASCII word boundaries only, so the plain SQL spells them out.
_L, _R = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def _alternatives(words: list[str]) -> str:
    return "|".join(w.replace(r"\w*", r"[\p{L}\p{N}_]*") for w in words)


def _hit(text: str, words: list[str]) -> str:
    return f"nullif(regexp_extract({text}, '(?i){_L}({_alternatives(words)}){_R}', 1), '')"


_STRIP = r"trim({0}, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160))"


@query("text_flags", f"""
    WITH d AS (SELECT doc_id, {_STRIP.format('text')} AS t FROM documents)
    SELECT doc_id, coalesce(t, '') = '' AS is_empty, regexp_matches(t, '[0-9]') AS has_digits, {_hit('t', p.NUMBER_WORDS)} AS number_word,
        {_hit('t', p.QUANTIFIERS)} AS quantifier, {_hit('t', p.TREND_WORDS)} AS trend_word, {_hit('t', p.MONTH_NAMES)} AS month_name,
        regexp_matches(t, '[\\n\\r#*|`\\[\\]<>]') AS has_formatting FROM d""")
def text_flags(t):
    return t.documents.select("doc_id", *[c.alias(n) for n, c in p.flags(F.col("text")).items()])


# Candidates: the turns of conversations and whole documents, with placeholders in place of a few words.
_SWAP = "replace(replace(replace(text, ' the ', ' {{mese}} '), ' la ', ' {{n_dataset}} '), ' un ', ' {{altro_dato}} ')"
CAND_SQL = f"""cand AS (SELECT source AS grp, doc_id AS rank, {_SWAP.format()} AS text FROM documents
    UNION ALL SELECT 'c' || CAST(conv_id % 20 AS VARCHAR), 1000000000 + conv_id * 1000 + turn, {_SWAP.format()} FROM conversations)"""


def candidates(t: Tables):
    swapped = F.expr(_SWAP.format()).alias("text")
    docs = t.documents.select(F.col("source").alias("grp"), F.col("doc_id").alias("rank"), swapped)
    turns = t.conversations.select(F.concat(F.lit("c"), (F.col("conv_id") % 20).cast("string")).alias("grp"),
                                   (F.lit(1000000000) + F.col("conv_id") * 1000 + F.col("turn")).alias("rank"), swapped)
    return docs.unionByName(turns)


VALUES = {"mese": "novembre 2026", "n_dataset": "29"}


def values_map():
    return F.create_map(*[F.lit(x) for kv in VALUES.items() for x in kv])


@query("text_placeholders", rf"""
    WITH {CAND_SQL}, f AS (SELECT rank, list_sort(list_distinct(regexp_extract_all(text, '\{{([a-z_]+)\}}', 1))) AS xs, text FROM cand)
    SELECT rank, array_to_string(xs, ',') AS found, array_to_string(list_filter(xs, lambda x: x NOT IN ('mese', 'n_dataset')), ',') AS unknown,
        concat_ws(',', CASE WHEN NOT list_contains(xs, 'mese') THEN 'mese' END, CASE WHEN NOT list_contains(xs, 'n_dataset') THEN 'n_dataset' END) AS missing
    FROM f""")
def text_placeholders(t):
    found, offered = p.placeholders(F.col("text")), F.array(*[F.lit(k) for k in VALUES])
    return candidates(t).select(
        "rank", F.array_join(found, ",").alias("found"),
        F.array_join(F.sort_array(F.array_except(found, offered)), ",").alias("unknown"),
        F.array_join(F.sort_array(F.array_except(offered, found)), ",").alias("missing"))


@query("text_substitute", f"""
    WITH {CAND_SQL} SELECT rank, replace(replace(text, '{{mese}}', 'novembre 2026'), '{{n_dataset}}', '29') AS text FROM cand""")
def text_substitute(t):
    return candidates(t).select("rank", p.substitute(F.col("text"), values_map()).alias("text"))


PROBLEM_SQL = rf"""{CAND_SQL},
    tr AS (SELECT grp, rank, {_STRIP.format('text')} AS t FROM cand),
    f AS (SELECT *, list_sort(list_distinct(regexp_extract_all(t, '\{{([a-z_]+)\}}', 1))) AS xs,
        replace(replace(t, '{{mese}}', 'novembre 2026'), '{{n_dataset}}', '29') AS filled FROM tr),
    g AS (SELECT *, list_filter(xs, lambda x: x NOT IN ('mese', 'n_dataset')) AS unk,
        list_filter(['mese', 'n_dataset'], lambda x: NOT list_contains(xs, x)) AS mis FROM f),
    pb AS (SELECT *, CASE WHEN coalesce(t, '') = '' THEN ['empty response'] ELSE list_filter([
        CASE WHEN regexp_matches(t, '[0-9]') THEN 'contains digits' END,
        'number word: ''' || {_hit('t', p.NUMBER_WORDS)} || '''', 'quantifier: ''' || {_hit('t', p.QUANTIFIERS)} || '''',
        'trend word: ''' || {_hit('t', p.TREND_WORDS)} || '''', 'month name: ''' || {_hit('t', p.MONTH_NAMES)} || '''',
        CASE WHEN regexp_matches(t, '[\n\r#*|`\[\]<>]') THEN 'formatting characters' END,
        CASE WHEN len(unk) > 0 THEN 'unknown placeholders: [''' || array_to_string(unk, ''', ''') || ''']' END,
        CASE WHEN len(mis) > 0 THEN 'missing placeholders: [''' || array_to_string(mis, ''', ''') || ''']' END,
        CASE WHEN regexp_matches(regexp_replace(t, '\{{[a-z_]+\}}', '', 'g'), '[{{}}]') THEN 'stray braces' END,
        CASE WHEN len(unk) = 0 AND length(filled) > 700 THEN 'too long: ' || length(filled) || ' characters'
             WHEN len(unk) = 0 AND length(filled) < 80 THEN 'too short: ' || length(filled) || ' characters' END],
        lambda x: x IS NOT NULL) END AS ps FROM g)"""


@query("text_problems", f"WITH {PROBLEM_SQL} SELECT grp, rank, array_to_string(ps, '; ') AS problems, len(ps) = 0 AS accepted FROM pb")
def text_problems(t):
    out = p.checked(candidates(t), "text", values_map())
    return out.select("grp", "rank", F.array_join("problems", "; ").alias("problems"), "accepted")


@query("text_pick", f"""
    WITH {PROBLEM_SQL}, a AS (SELECT grp, arg_min(filled, rank) FILTER (len(ps) = 0) AS best, min(rank) FILTER (len(ps) = 0) AS chosen_rank,
        count(*) AS n_attempts FROM pb GROUP BY 1)
    SELECT grp, CASE WHEN chosen_rank IS NULL THEN 'template' ELSE best END AS text,
        CASE WHEN chosen_rank IS NULL THEN 'template' ELSE 'candidate' END AS source, chosen_rank, n_attempts FROM a""")
def text_pick(t):
    return p.first_accepted(p.checked(candidates(t), "text", values_map()), ["grp"], "rank", F.lit("template"))


def _it(n: str) -> str:
    return f"replace(format('{{:,}}', {n}), ',', '.')"


@query("offered_values", f"""
    WITH {TOTALS_SQL}, few AS (SELECT name, d FROM (SELECT CASE WHEN split_part(dataset_code, '/', 1) <> 'Brand#2' THEN 'Serie ' || split_part(dataset_code, '/', 1)
        ELSE dataset_code END AS name, min(dataset_code) AS d FROM facts WHERE new_periods IS NOT NULL GROUP BY 1))
    SELECT * FROM (
      SELECT 'mese' AS name, 'novembre 2001' AS value UNION ALL SELECT 'mese_precedente', 'ottobre 2001'
      UNION ALL SELECT 'n_dataset', {_it('n_dataset')} FROM tot
      UNION ALL SELECT 'n_aggiornati', {_it('n_aggiornati')} FROM tot WHERE n_aggiornati > 0
      UNION ALL SELECT 'n_nuovi_periodi', {_it('n_nuovi_periodi')} FROM tot WHERE n_nuovi_periodi > 0
      UNION ALL SELECT 'n_non_aggiornati', {_it('n_non_aggiornati')} FROM tot WHERE n_non_aggiornati > 0
      UNION ALL SELECT 'n_mancanti', {_it('n_mancanti')} FROM tot WHERE n_mancanti > 0
      UNION ALL SELECT 'n_nuovi_dataset', {_it('n_nuovi_dataset')} FROM tot WHERE n_nuovi_dataset > 0
      UNION ALL SELECT 'elenco_nuovi_periodi', CASE len(l) WHEN 1 THEN l[1] ELSE array_to_string(l[1:len(l) - 1], ', ') || ' e ' || l[len(l)] END
        FROM (SELECT list(name ORDER BY d) AS l FROM few) WHERE len(l) BETWEEN 1 AND 3)""")
def offered_values(t):
    facts = checkpointed(release_facts(t))
    totals = release.totals(facts, MONTH)
    return p.offered_values(totals, facts, labels(t)).select(F.explode("values").alias("name", "value"))
