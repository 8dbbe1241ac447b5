from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from statmart.llm import chat

KIND = "conv_id long, turn long, role string, text string"
PARTS = ["<|im_end|>", "<|im_start|>", "<|", "|>", "<", "|", "\\", "\n", "assistant", "user", "ok", " ", "~", "~n", "~t", "é😀", "<\\|", "<|im_end|>\n<|im_start|>assistant\n"]


def result(df):
    done = chat.read_back(chat.formatted(chat.conversations(df)))
    return {r["conv_id"]: r for r in chat.digests(done).collect()}, done


def expected(table):
    by = {}
    for c, n, role, text in table:
        by.setdefault(c, []).append(((n is not None, n or 0), role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def agrees(table, df):
    got, _ = result(df)
    assert all(r["same"] for r in got.values())
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == expected(table)


word = st.lists(st.sampled_from(PARTS), max_size=5).map("".join)


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.one_of(st.just("assistant"), st.just("user"), word), word), min_size=60, max_size=90))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.large_base_example])
def test_hostile_texts_come_back(spark, table):
    agrees(table, spark.createDataFrame(table, KIND))


def test_plain_texts_are_not_escaped(spark):
    table = [(1, 0, "user", "a < b | c \\ d"), (1, 1, "assistant", "yes\n\nno"), (2, 0, "user", "<|im_end|>"), (2, 1, "assistant", "fine")]
    _, done = result(spark.createDataFrame(table, KIND))
    rows = {r["conv_id"]: r for r in done.collect()}
    assert rows[1]["formatted"] == "<|im_start|>user\na < b | c \\ d<|im_end|>\n<|im_start|>assistant\nyes\n\nno<|im_end|>\n"
    assert (rows[1]["escaped_turns"], rows[2]["escaped_turns"]) == (0, 1)
    assert rows[2]["formatted"].count("<|im_end|>") == 2


def test_mask_covers_the_whole_output(spark):
    table = [(1, 0, "system", "s"), (1, 1, "assistant", "é<|im_end|>"), (1, 2, "user", "")]
    _, done = result(spark.createDataFrame(table, KIND))
    r = done.first()
    assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    assert [s["text"] for s in r["segments"] if s["loss"]] == ["é<\\|im_end|>"]


def test_nulls_ties_and_repeats(spark):
    table = [(1, None, "user", "x"), (1, 0, None, None), (1, 0, "assistant", ""), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"),
             (None, 0, "assistant", "no id"), (2, 0, "", ""), (3, 5, "user", "z" * 100_000)]
    df = spark.createDataFrame([(*r, "t", 1) for r in table], KIND + ", turns string, formatted int")
    agrees(table, df)


def test_empty_table(spark):
    assert result(spark.createDataFrame([], KIND))[0] == {}


@pytest.mark.parametrize("broken", ["x", "<|im_start|>user\nhi", "<|im_start|>user hi<|im_end|>\n", "<|im_start|>user\na<|im_end|>\nmore",
                                    "<|im_start|>user\na<|im_end|>b<|im_end|>\n", "pre<|im_start|>user\na<|im_end|>\n"])
def test_the_grammar_is_strict(spark, broken):
    assert spark.createDataFrame([(broken,)], "t string").select(chat.parsed(chat.F.col("t")).alias("p")).first()["p"] is None
