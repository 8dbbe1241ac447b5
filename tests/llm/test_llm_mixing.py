from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from statmart.llm import mixing
from llm_tables import scan  # noqa: F401
from statmart.llm.mixing import Mixture


def shares(budget, children):
    """children: name -> (has, weight). Serve the poorest first, as long as all that it has is within its share."""
    order = sorted(children, key=lambda c: (children[c][0] / children[c][1], c))
    out, left = {}, budget
    while order:
        has, weight = children[order[0]]
        total = sum(children[c][1] for c in order)
        if has * total > left * weight:
            break
        out[order.pop(0)] = has
        left -= has
    total = sum(children[c][1] for c in order)
    for c in order:
        out[c] = min(children[c][0], max(left, 0) * children[c][1] // total)
    return out


def plain(table, mixture):
    """(row, doc, domain, language, source, tokens) -> Counter of (row, epoch)."""
    leaves = defaultdict(int)
    for _, _, *path, n in table:
        leaves[tuple(path)] += n
    budget = {(): mixture.budget if mixture.budget is not None else sum(leaves.values())}
    for depth in (1, 2, 3):
        for parent in [p for p in budget if len(p) == depth - 1]:
            kids = defaultdict(int)
            for leaf, n in leaves.items():
                if leaf[:depth - 1] == parent:
                    kids[leaf[:depth]] += n * mixture.max_epochs
            budget |= shares(budget[parent], {k: (n, mixture.weights.get("/".join(k), 1)) for k, n in kids.items()})
    out = Counter()
    for leaf, total in leaves.items():
        whole = min(budget[leaf] // total, mixture.max_epochs) if total else 0
        members = [r for r in table if tuple(r[2:5]) == leaf]
        for r in members:
            for e in range(whole):
                out[r[0], e] += 1
        if whole < mixture.max_epochs:
            rest = budget[leaf] - whole * total
            for r in sorted(members, key=lambda r: (hashlib.md5(f"{mixture.seed}:{whole}:{r[1]}".encode()).hexdigest(), r[5], r[0])):
                if rest - r[5] < 0:                    # the budget ends in this document: in or out, whichever is nearer
                    out[r[0], whole] += rest > 0 and r[5] - rest < rest
                    break
                rest -= r[5]
                out[r[0], whole] += 1
    return out


def table_of(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hot = rng.random() < 0.35
        path = ("web", "en", "big") if hot else (rng.choice(["web", "book", "code"]), rng.choice(["en", "de"]), rng.choice(["s1", "s2", "s3"]))
        out.append((i, str(rng.choice([i, 5])), *path, rng.choice([0, 1, 7, 30, 200])))
    return out


@pytest.mark.parametrize("mixture", [
    Mixture(), Mixture(budget=3000, weights={"web": 1, "book": 5, "code/de": 9}), Mixture(budget=10 ** 7, max_epochs=3), Mixture(budget=0),
    Mixture(budget=50_000, max_epochs=2, seed="other", weights={"web/en/big": 7})])
def test_selection_equals_plain_python(scan, mixture):
    table = table_of(500, 3)
    df = scan(table, "row long, doc string, domain string, language string, source string, tokens long")
    got = Counter((r["row"], r["epoch"]) for r in mixing.selection(df, mixture).collect())
    assert got == +plain(table, mixture)


def test_a_leaf_comes_as_near_to_its_budget_as_one_document_allows(scan):
    table = table_of(600, 8)
    df = scan(table, "row long, doc string, domain string, language string, source string, tokens long")
    taken, sizes = defaultdict(int), defaultdict(list)
    budget = {}
    for r in mixing.selection(df, Mixture(weights={"web": 3, "book/de": 4})).collect():
        leaf = tuple(r[c] for c in mixing.LEVELS)
        taken[leaf] += r["tokens"]
        budget[leaf] = r["budget"]
    for r in table:
        sizes[r[2:5]].append(r[5])
    assert all(abs(taken[k] - budget[k]) <= max(sizes[k]) / 2 for k in taken if budget[k])


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000), ("b", "x", "s4", 5)],
                                   "domain string, language string, source string, tokens long")
    got = {r["source"]: r["budget"] for r in mixing.budgets(leaves, Mixture(budget=400, max_epochs=1)).collect()}
    # b has 5 of its 200, so a gets 395: 197 each language; s1 has only 10, so s2 gets the rest of its language
    assert got == {"s4": 5, "s1": 10, "s2": 187, "s3": 197}


def test_documents_with_nulls_and_clashing_columns(scan):
    table = [(1, "a b c", "en", "s1"), (2, None, None, None), (None, "x y", "en", None), (3, "", "de", "s2"), (3, "q", "de", "s2")]
    df = scan([(*r, 1, "w") for r in table], "doc_id long, text string, lang string, source string, row int, whole string")
    d = mixing.described(df, F.lit(None))
    assert rows(d, "doc", "domain", "language", "source", "tokens") == sorted([
        ("1", "(none)", "en", "s1", 3), ("2", "(none)", "(none)", "(none)", 0), ("", "(none)", "en", "(none)", 2),
        ("3", "(none)", "de", "s2", 0), ("3", "(none)", "de", "s2", 1)], key=repr)
    out = mixing.mixed(df, F.lit(None), Mixture(budget=1000, max_epochs=2))
    assert out.columns == df.columns
    assert Counter(r["text"] for r in out.collect()) == {"a b c": 2, None: 1, "x y": 2, "": 2, "q": 2}


def test_words_are_counted_as_blanks_separate_them(scan):
    texts = ["", " ", "a", "a\x0bb\x0cc\r\nd", "\x1ca\x1cb", " x  y "]
    df = scan([(i, t, "l", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r["doc"]: r["tokens"] for r in mixing.described(df, F.lit("d")).collect()}
    assert got == {str(i): len([w for w in re.split("[\x20\x09-\x0D]+", t) if w]) for i, t in enumerate(texts)}


def test_weights_must_count():
    with pytest.raises(ValueError):
        Mixture(weights={"a": 0})


def test_empty_table(scan):
    df = scan([], "doc_id long, text string, lang string, source string")
    assert mixing.mixed(df, F.lit("d"), Mixture()).count() == 0
