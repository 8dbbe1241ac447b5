from __future__ import annotations

import random
import time

import pytest
from conftest import rows
from hypothesis import given, settings, strategies as st

from statmart.llm import tokens
from llm_tables import prose, scan  # noqa: F401
from statmart.llm.vocabulary import load, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
PIECES = ["a", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "\x1c", "\x85", "　", "​", " ", "́", "é", "ß", "1",
          "23", "?!", "<|endoftext|>", "<|endof", "=", "{", "ing", "日本", "😀", "\r\n", "I'VE", " would"]


def library(text):
    return len(load(PATH).encode(text, add_special_tokens=False).ids)


@given(st.lists(st.sampled_from(PIECES), max_size=14))
@settings(max_examples=400, deadline=None)
def test_every_prefix_as_the_library(parts):
    text = "".join(parts)
    count = tokens.counter(PATH)
    want = [library(text[:i]) for i in range(len(text) + 1)]
    assert count.total(text) == want[-1]
    assert count.table(text).tolist() == want
    for budget in (0, 1, 3, 6):
        assert count.longest_prefix(text, budget) == max(i for i, n in enumerate(want) if n <= budget)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert tokens.counter(PATH).total(text) == library(text)


def test_long_words():
    rng = random.Random(4)
    for text in ("a" * 3000, " " * 700 + "x", "".join(rng.choice("ab01/+=") for _ in range(4000)), "\n" * 300):
        assert tokens.counter(PATH).total(text) == library(text)


@pytest.mark.parametrize("blank", ["\n", " ", "\u3000", "\u200b", " \u00a0", "\u200b ", "\x1c\t"])
def test_runs_of_blanks(blank):
    """Every prefix of a run, before a word and before a special string, as the library has it."""
    count = tokens.counter(PATH)
    for text in ("a b " + blank * 60 + "c d", "x" + blank * 40 + "<|endoftext|> y", blank * 50, "é" + blank * 30 + "'s"):
        want = [library(text[:i]) for i in range(len(text) + 1)]
        assert count.total(text) == want[-1] and count.table(text).tolist() == want
        for budget in (3, 7, 20):
            assert count.longest_prefix(text, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_a_million_blanks_take_seconds():
    count = tokens.PrefixCounter(PATH)
    began = time.perf_counter()
    for blank in ("\n", "\u3000"):
        text = "a b " + blank * 1_000_000 + " c"
        fits = count.longest_prefix(text, 1024)
        assert count.total(text) > 1024 and library(text[:fits]) <= 1024 < library(text[:fits + 1])
    assert time.perf_counter() - began < 60


def test_query_rows(scan, prose):
    table = [(1, None), (2, ""), (3, "it's <|endoftext|> here"), (None, "x y"), (3, "again"), (4, prose(1, 3000)), (5, "日本" * 900)]
    df = scan([(*r, 0, "z") for r in table], "doc_id long, text string, n_tokens int, id string")
    got = {(r["doc_id"], r["n_bytes"]): r for r in tokens.count_tokens(df, PATH, 1024).collect()}
    assert len(got) == len(table)
    for d, t in table:
        r, t = got[(d, len((t or "").encode()))], t or ""
        n = library(t)
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 1024)
        assert r["fits_chars"] == (len(t) if n <= 1024 else r["fits_chars"]) and library(t[:r["fits_chars"]]) <= 1024
        assert n <= 1024 or library(t[:r["fits_chars"] + 1]) > 1024


def test_stored_tables_answer_budgets(scan, prose):
    df = scan([(1, prose(2, 40)), (2, None)], "doc_id long, text string")
    stored = tokens.prefix_tables(df, PATH).withColumn("cut", tokens.prefix_within("counts", 9))
    count = tokens.counter(PATH)
    assert rows(stored, "doc_id", "cut") == [(1, count.longest_prefix(prose(2, 40), 9)), (2, 0)]


def test_empty_table(spark):
    assert tokens.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH, 5).count() == 0


@pytest.mark.parametrize("size", [1, 3])
def test_small_caches_change_nothing(monkeypatch, size, prose):
    monkeypatch.setattr(tokens, "CACHE", size)
    count = tokens.PrefixCounter(PATH)
    assert count.total(prose(6, 400)) == library(prose(6, 400))
