from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_tables import scan  # noqa: F401
from statmart.llm import language

SYLLABLES = {"xx": ["ba", "do", "ki"], "yy": ["été", "ça", "ou"], "zz": ["sch", "ung", "ei"]}


def text(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [(i, text(k, rng.randint(5, 80), rng), k) for i in range(n) for k in [rng.choice(list(SYLLABLES))]]


def plain_counts(s):
    """n-grams of border-marked words, in plain Python; only their number is comparable."""
    padded = "|" + "".join(c if c.isalpha() else "|" for c in s.lower()) + "|"
    total = 0
    for n in language.GRAMS:
        for i in range(len(padded) - n + 1):
            g = padded[i:i + n]
            total += "|" not in g[1:-1] and not (g[0] == "|" and g[-1] == "|")
    return total


@given(st.text(alphabet="abÉ 1.\n", max_size=40))
@settings(max_examples=200)
def test_subwords(s):
    counts = language.subword_counts(s)
    assert (counts is None) == (not any(c.isalpha() for c in s))
    if counts is not None:
        assert counts.sum() == plain_counts(s)


def test_long_texts_in_steps(monkeypatch):
    s = text("yy", 300, random.Random(2))
    whole = language.subword_counts(s)
    monkeypatch.setattr(language, "_STEP", 10)
    assert (language.subword_counts(s) == whole).all()


def test_held_out_accuracy(scan):
    table = corpus(400)
    df = scan([(*r, 0.5, "a") for r in table], "doc_id long, text string, lang string, score double, lang_pred string")
    got = {r["doc_id"]: r for r in language.identified(df).collect()}
    assert len(got) == 400
    held = [i for i, _, _ in table if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"]} == set(held)
    right = [got[i]["lang_pred"] == k for i, _, k in table if i in set(held)]
    assert np.mean(right) >= 0.99
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_labels_of_held_out_rows_are_not_learned(scan):
    table = [(i, t, k if zlib.crc32(str(i).encode()) % 4 != 2 else "wrong") for i, t, k in corpus(300)]
    got = language.identified(scan(table, "doc_id long, text string, lang string")).collect()
    assert "wrong" not in {r["lang_pred"] for r in got}


def test_nulls_blanks_and_repeats(scan):
    table = corpus(200) + [(900, None, "xx"), (901, "", "xx"), (902, " 12 .. \n", "yy"), (None, "ba do", None), (7, "ba do", None), (7, "ba do", None)]
    got = [(r["doc_id"], r["lang_pred"], r["score"], r["rejected"]) for r in language.identified(scan(table, "doc_id long, text string, lang string")).collect()]
    assert len(got) == len(table)
    assert {g[:3] for g in got if g[0] in (900, 901, 902)} == {(900, "und", 0.0), (901, "und", 0.0), (902, "und", 0.0)}
    assert Counter(g[0] for g in got)[7] == 3


def test_rejected_rows_go_and_clean_ones_stay(scan):
    table = corpus(300) + [(900, None, "xx"), (901, "?? 1", "yy")]
    df = scan([(*r, 5, "c") for r in table], "doc_id long, text string, lang string, n_chars int, whole string")
    kept = language.accepted(df)
    assert kept.columns == df.columns
    assert kept.count() >= 298 and kept.filter("doc_id >= 900").count() == 0


def test_without_labels_nothing_is_known(scan, spark):
    got = language.identified(scan([(1, "ba", None)], "doc_id long, text string, lang string")).collect()
    assert [(r["lang_pred"], r["rejected"]) for r in got] == [("und", True)]
    assert language.identified(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_one_language_only(scan):
    table = [(i, text("xx", 9, random.Random(i)), "xx") for i in range(40)]
    got = language.identified(scan(table, "doc_id long, text string, lang string")).collect()
    assert {r["lang_pred"] for r in got} == {"xx"}


def test_unlearned_languages_are_rejected_and_clean_held_back_texts_stay(scan):
    """Two of three languages have labels, so a winning score is never below one half."""
    table = corpus(600)
    df = scan([(i, t, k if k != "zz" else None) for i, t, k in table], "doc_id long, text string, lang string")
    rejected = {r["doc_id"]: r["rejected"] for r in language.identified(df).collect()}
    strange = [i for i, _, k in table if k == "zz"]
    clean = [i for i, _, k in table if k != "zz" and zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([rejected[i] for i in strange]) >= 0.98
    assert np.mean([rejected[i] for i in clean]) <= 0.02
    kept = {r["doc_id"] for r in language.accepted(df).collect()}
    assert kept == {i for i, _, _ in table if not rejected[i]}


def sample_of(table):
    counts = [language.subword_counts(t) for _, t, _ in table]
    at = [np.flatnonzero(c) for c in counts]
    return pd.DataFrame({"label": [k for *_, k in table], "at": [a.astype("<u2").tobytes() for a in at],
                         "n": [c[a].astype("<f4").tobytes() for a, c in zip(at, counts)]})


def test_levels_stay_off_saturation_and_one_unsure_text_does_not_set_them():
    table = corpus(600)
    model = language.trained(sample_of(table))
    scores = model.probabilities(np.stack([language.subword_counts(t) for _, t, _ in table]).astype(float)).max(1)
    assert model.temperature > 0.02 and scores.max() < 1 - 1e-9
    mixed = [(1000 + i, " ".join(text(k, 9, random.Random(i)) for k in ("xx", "yy")), "xx") for i in range(2)]
    again = language.trained(sample_of(table + mixed))
    assert again.least > 0.6 and np.isfinite(again.most).all() and (again.most < 2 * model.most).all()


def test_a_language_with_few_texts_is_not_rejected_for_that():
    table = corpus(900)
    rare = [(2000 + i, " ".join("".join(random.Random(i * 99 + j).choice(["pö", "lū", "ŋa"]) for _ in range(3)) for j in range(30)), "ww") for i in range(12)]
    model = language.trained(sample_of(table + rare))
    counts = np.stack([language.subword_counts(t) for _, t, _ in rare]).astype(float)
    k = model.languages.index("ww")
    assert (model.probabilities(counts).argmax(1) == k).all()
    assert (model.excess(counts)[:, k] <= model.most[k]).mean() >= 0.8


def test_the_draw_is_bounded_and_never_rounds_to_nothing(spark):
    table = spark.range(200_000).select(F.xxhash64("id").alias("draw"))
    for n, most in ((200_000, 2.2 * 1500 + 200), (10_000_000_000, 10), (100, 200_000)):
        drawn = table.filter(language.share_drawn(F.col("draw"), F.lit(1500), F.lit(n))).count()
        assert min(1500, 200_000 * 1500 / n) * 1.5 - 10 < drawn <= most
    # of ten billion rows the share drawn is still more than what is wanted
    smallest = spark.range(1).select(F.lit(int(2 ** 64 * 1500 / 10 ** 10)).cast("long").alias("draw"))
    assert smallest.filter(language.share_drawn(F.col("draw"), F.lit(1500), F.lit(10_000_000_000))).count() == 1


def test_many_labels_are_all_learned(scan):
    table = [(i, text("xx", 5, random.Random(i)), f"l{i % 300}") for i in range(2000)] + [(1, "ba ba", "l1")] * 300
    sample = language.labelled_sample(scan(table, "doc_id long, text string, lang string"), F.lit(True), "doc_id", "text", "lang", 1500)
    often = Counter(sample["label"])
    assert len(often) == 300 and max(often.values()) <= language.MAX_TEXTS // 300
    few = language.labelled_sample(scan(table, "doc_id long, text string, lang string"), F.lit(True), "doc_id", "text", "lang", 2)
    assert set(Counter(few["label"]).values()) == {2}
    rare = sample_of([(0, "ba do", "a"), *[(i, text("yy", 9, random.Random(i)), "b") for i in range(1, 9)]])
    assert language.trained(rare).languages == ["a", "b"]
