"""Quality by weak supervision, in column expressions only.

Rules vote good, bad or abstain. What the rules are worth is not set by hand: expectation-maximisation estimates how
often each rule is right from how the rules agree over the whole corpus, and a document is kept by its posterior
probability of being good. With so many rules and three votes there are only so many different vote patterns, so the
corpus is reduced to one count per pattern and every round of the estimation runs on that table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .shared import BLANKS, WORDS, whole_text, words_of

GOOD, BAD, ABSTAIN = 1, -1, 0


@dataclass(frozen=True)
class Rule:
    name: str
    good: str      # SQL conditions on the columns of text_statistics; neither: the rule abstains
    bad: str


# Documented settings of the vote, on shares of words, characters and lines.
RULES = (
    Rule("length", "n_words >= 50", "n_words < 20"),
    Rule("word_length", "word_chars between 3 * n_words and 10 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("symbols", "100 * n_symbols < n_words", "10 * n_symbols > n_words"),
    Rule("lines", "10 * n_dup_lines < n_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("repeats", "100 * n_repeat_words < 20 * n_words", "100 * n_repeat_words > 40 * n_words"),
    Rule("letters", "10 * n_letters > 7 * word_chars", "2 * n_letters < word_chars"),
    # markup, tables and shouting, which the base does not look at
    Rule("marked_words", "50 * n_marked < n_words", "10 * n_marked > n_words"),
    Rule("symbol_share", "200 * n_symbols < n_letters", "25 * n_symbols > n_letters"),
    Rule("capitals", "10 * n_upper < n_letters", "5 * n_upper > 2 * n_letters"),
    Rule("sentences", "2 * n_ended > n_lines", "n_lines >= 3 and 10 * n_ended < n_lines"),
)


def text_statistics(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``n_lines``
    (with a word), ``n_letters``, ``n_upper`` (upper-case letters), ``n_marked`` (words with a symbol) and ``n_ended`` (lines
    that end like a sentence).

    Null text: all zero. Ids may be null or repeated. Windows of three words are compared by their 64-bit hash within
    their own document. Columns other than id and text are not read.
    """
    base = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    parts = base.select(
        "id", "text", words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORDS)).alias("lines"))
    counted = parts.select(
        "id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("text", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("text", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        # from a word's first symbol to its end: one match for each word that has one
        F.regexp_count("text", F.lit(f"[#*$%&|<>][^{BLANKS}]*")).cast("long").alias("n_marked"),
        F.size(F.filter("lines", lambda line: F.substring(F.rtrim(line), -1, 1).isin(*".!?:;\"'"))).cast("long").alias("n_ended"),
        F.when(F.size("words") >= 3, F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))).alias("windows"))
    # most texts repeat no window: a hash set of their numbers tells
    several = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = counted.withColumn("sorted", F.when(several, F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = placed.withColumn("at", F.expr(
        "sort_array(transform(filter(sorted, (x, i) -> get(sorted, i - 1).h <=> x.h or get(sorted, i + 1).h <=> x.h),"
        " x -> x.i))"))
    # a repeated window covers three words, less where the next one begins earlier
    covered = F.expr("aggregate(at, named_struct('n', 0L, 'upto', 0), (a, i) -> "
                     "named_struct('n', a.n + (i + 3 - greatest(i, a.upto)), 'upto', i + 3), a -> a.n)")
    return twice.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "n_lines", "n_letters",
                        "n_upper", "n_marked", "n_ended")


def votes(stats: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One column ``vote_<rule>`` per rule; where both conditions hold the rule votes bad."""
    return stats.withColumns({
        f"vote_{r.name}": F.when(F.expr(r.bad), BAD).when(F.expr(r.good), GOOD).otherwise(ABSTAIN) for r in rules})


@dataclass(frozen=True)
class Model:
    """Share of good documents, and per rule how probable each vote is on good and on bad documents."""

    prior: float
    given_good: dict[str, dict[int, float]]
    given_bad: dict[str, dict[int, float]]

    def posterior(self) -> Column:
        """Probability of being good, from the vote columns; abstaining tells nothing."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, good in self.given_good.items():
            bad = self.given_bad[name]
            odds = odds + (F.when(F.col(name) == GOOD, math.log(good[GOOD] / bad[GOOD]))
                           .when(F.col(name) == BAD, math.log(good[BAD] / bad[BAD])).otherwise(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fitted(voted: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = 15, least_right: float = 0.55) -> Model:
    """Accuracies by expectation-maximisation over all documents.

    Rules start as right in seven of ten votes; a rule's estimate stays between ``least_right`` and 0.99, so that no
    rule turns into its opposite; counts are smoothed by one. The table of patterns has at most 3 ** rules rows. An empty
    table leaves the starting model.
    """
    names = [f"vote_{r.name}" for r in rules]
    patterns = checkpointed(voted.groupBy(*names).agg(F.count("*").alias("n")))
    right = {n: {GOOD: 0.7, BAD: 0.7} for n in names}      # accuracy by the true class
    prior = 0.5

    def model() -> Model:
        return Model(prior, {n: {GOOD: a[GOOD], BAD: 1 - a[GOOD]} for n, a in right.items()},
                     {n: {BAD: a[BAD], GOOD: 1 - a[BAD]} for n, a in right.items()})

    for _ in range(rounds):
        p = patterns.select("*", (F.col("n") * model().posterior()).alias("g")).withColumn("b", F.col("n") - F.col("g"))
        sums = [F.sum("n").alias("n"), F.sum("g").alias("g")]
        for n in names:
            sums += [F.sum(F.when(F.col(n) == v, F.col(c)).otherwise(0.0)).alias(f"{n}_{c}_{v}")
                     for c in "gb" for v in (GOOD, BAD)]
        s = p.agg(*sums).first().asDict()
        if not s["n"]:
            break
        hold = lambda x: min(0.99, max(least_right, x))
        before = (prior, {n: dict(a) for n, a in right.items()})
        prior = min(0.99, max(0.01, (s["g"] + 1) / (s["n"] + 2)))
        for n in names:
            right[n] = {
                GOOD: hold((s[f"{n}_g_{GOOD}"] + 1) / (s[f"{n}_g_{GOOD}"] + s[f"{n}_g_{BAD}"] + 2)),
                BAD: hold((s[f"{n}_b_{BAD}"] + 1) / (s[f"{n}_b_{GOOD}"] + s[f"{n}_b_{BAD}"] + 2))}
        moved = max([abs(prior - before[0]), *(abs(right[n][v] - before[1][n][v]) for n in names for v in (GOOD, BAD))])
        if moved < 1e-4:
            break
    return model()


def judged(df: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES,
           least: float = 0.5) -> DataFrame:
    """Statistics, ``base_failed`` (under 50 words, or more than half of them in repeated windows), the posterior
    ``quality`` and ``kept``: not failed and at least ``least`` probable to be good.

    A null or empty text has no words and fails; an empty table gives an empty result.
    """
    stats = checkpointed(votes(text_statistics(df, id_col, text), rules))
    model = fitted(stats, rules)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        stats.withColumn("base_failed", failed).withColumn("quality", model.posterior())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )
