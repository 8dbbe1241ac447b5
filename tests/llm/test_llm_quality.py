from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from llm_tables import prose  # noqa: F401
from statmart.llm import quality

BLANK = "[\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = [w for w in re.split(BLANK, text) if w]
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if [w for w in re.split(BLANK, line) if w]:
            lines += 1
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    ended = sum(line.rstrip(" ")[-1:] in list(".!?:;\"'") for line in text.split("\n") if [w for w in re.split(BLANK, line) if w])
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), lines,
            sum(c.isalpha() for c in text), sum(c.isupper() for c in text), sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words), ended)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_marked", "n_ended")


def texts():
    rng = random.Random(1)
    out = [None, "", " \n\t", "a", "a b", "a b c", "a a a", "a a a a", "a b c a b c", "a b a b a b a b", "x\nx\n\nx \nx", "é ß # é ß # é ß",
           "\x0bq\x0cq\rq q q q", "\x1ca\x1ca\x1c", "  nb  nb ", "w " * 3000, "l i n e\n" * 400]
    for _ in range(40):
        out.append("".join(rng.choice(["a", "b", "C", "dd.", "#", "é", " ", " ", " ", "\n", "\t", "<|"]) for _ in range(rng.randint(0, 400))))
    return out


def test_statistics_equal_plain_python(spark):
    table = list(enumerate(texts()))
    df = spark.createDataFrame([(*r, 1, "w") for r in table], "doc_id long, text string, n_words int, words string")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in quality.text_statistics(df).collect()}
    assert got == {i: plain(t) for i, t in table}


def plain_em(patterns, rounds=15, least=0.55):
    """Expectation-maximisation over (votes, count) in numpy."""
    votes = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    right = np.full((votes.shape[1], 2), 0.7)
    prior = 0.5
    for _ in range(rounds):
        odds = np.full(len(n), np.log(prior / (1 - prior)))
        for j in range(votes.shape[1]):
            odds += np.where(votes[:, j] == 1, np.log(right[j, 0] / (1 - right[j, 1])),
                             np.where(votes[:, j] == -1, np.log((1 - right[j, 0]) / right[j, 1]), 0))
        g = n / (1 + np.exp(-odds))
        b = n - g
        old = (prior, right.copy())
        prior = min(0.99, max(0.01, (g.sum() + 1) / (n.sum() + 2)))
        for j in range(votes.shape[1]):
            up, down = votes[:, j] == 1, votes[:, j] == -1
            right[j, 0] = np.clip((g[up].sum() + 1) / (g[up].sum() + g[down].sum() + 2), least, 0.99)
            right[j, 1] = np.clip((b[down].sum() + 1) / (b[up].sum() + b[down].sum() + 2), least, 0.99)
        if max(abs(prior - old[0]), np.abs(right - old[1]).max()) < 1e-4:
            break
    return prior, right


def test_estimates_equal_plain_python(spark):
    rng = random.Random(4)
    names = [f"vote_{r.name}" for r in quality.RULES]
    table = []
    for _ in range(800):
        good = rng.random() < 0.7
        table.append([rng.choice([0, (1 if good else -1) if rng.random() < 0.8 else (-1 if good else 1)]) for _ in names])
    model = quality.fitted(spark.createDataFrame(table, ", ".join(f"{n} int" for n in names)))
    prior, right = plain_em([(p, c) for p, c in sorted(collections.Counter(map(tuple, table)).items())])
    assert model.prior == pytest.approx(prior, abs=1e-6)
    assert model.prior == pytest.approx(0.7, abs=0.1)
    for j, n in enumerate(names):
        assert model.given_good[n][1] == pytest.approx(right[j, 0], abs=1e-6)
        assert model.given_bad[n][-1] == pytest.approx(right[j, 1], abs=1e-6)


def test_clean_texts_stay_and_junk_goes(spark, prose):
    table = [(i, prose(i, 80 + i)) for i in range(60)]
    table += [(100 + i, "# $ % & " * 40 + f"{i} x y") for i in range(10)]                      # symbols, repeated
    table += [(200 + i, "\n".join([prose(i, 12)] * 30)) for i in range(10)]                     # repeated lines
    table += [(300, None), (301, ""), (302, "short text"), (None, prose(5, 90)), (1, prose(1, 81))]
    df = spark.createDataFrame([(*r, True) for r in table], "doc_id long, text string, kept boolean")
    got = quality.judged(df).collect()
    assert len(got) == len(table)
    for r in got:
        if r["doc_id"] is None or r["doc_id"] < 100:
            assert r["kept"] and not r["base_failed"]
        else:
            assert not r["kept"]
    assert all(0 <= r["quality"] <= 1 for r in got)


def test_the_posterior_rejects_what_the_base_lets_pass(spark):
    """On the labelled documents: markup that is long and does not repeat itself goes, clean documents all stay."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    found = quality.judged(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id", "left")
    by = {(r["base_failed"], r["kept"], r["label"]): r["count"] for r in found.groupBy("base_failed", "kept", "label").count().collect()}
    assert by.get((False, False, 0), 0) > 0.9 * (by.get((False, False, 0), 0) + by.get((False, True, 0), 0)) > 0
    assert by.get((False, False, 1), 0) == 0


def test_empty_table(spark):
    assert rows(quality.judged(spark.createDataFrame([], "doc_id long, text string"))) == []
