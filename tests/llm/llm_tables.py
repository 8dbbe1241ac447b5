from __future__ import annotations

import random

import pytest

WORDS = "the of and to in is was for on are with from at by be this that alpha beta gamma delta epsilon".split()


@pytest.fixture
def scan(spark, tmp_path):
    """scan(rows, schema) -> a table read from files, so that rows keep their places."""
    def make(rows, schema, files=3):
        path = f"{tmp_path}/t{random.random()}"
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.parquet(path)
    return make


@pytest.fixture
def prose():
    """prose(seed, n) -> n words."""
    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", f"{rng.randint(0, 99)}"]) for _ in range(n))
    return make


# columns that clash with names the operators use inside
EXTRA = "row long, whole string, key string, _text string, id string, rank int, n long, block long, sequence_id long"
CLASH = (7, "w", "k", "t", "i", 1, 2, 3, 4)
