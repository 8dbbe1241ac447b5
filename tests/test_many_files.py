"""Queries give the same over tables of several files as over one."""

from __future__ import annotations

import pytest
from compare import connect, difference

from statmart.catalog import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("split"))
    for name in ("nation", "region", "customer", "part", "supplier", "orders", "lineitem"):
        n = 7 if name in ("orders", "lineitem") else 1
        spark.read.parquet(f"{FOLDER}/{name}.parquet").repartition(n).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["merge_labour", "merge_social_economy", "fact_key", "surrogate_keys"])
def test_same_as_sql(name, spark, split):
    assert difference(spark, connect(FOLDER), REGISTRY[name], split) is None
