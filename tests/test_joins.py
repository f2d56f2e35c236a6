"""The salted join gives the plain join's rows, with one key holding a third of the table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewlab.operators.joins import attach, hot_keys


def frames(spark):
    n = 3000
    key = F.when(F.col("id") < n // 3, F.lit(7)).when(F.col("id") % 10 == 0, F.lit(None))
    detail = spark.range(n).select(
        F.col("id").alias("row"), key.otherwise(F.col("id") % 50).cast("long").alias("k")
    )
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return detail, lookup


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [100, 1_000_000])
def test_same_rows_as_plain_join(spark, how, hot_rows):
    detail, lookup = frames(spark)
    got = attach(detail, lookup, "k", ["row"], how=how, hot_rows=hot_rows)
    want = detail.join(lookup, "k", how)
    assert got.columns == ["k", "row", "v"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_key_is_found_and_spread(spark):
    detail, _ = frames(spark)
    counts = detail.groupBy("k").agg(F.count("row").alias("n"))
    found = {r["k"]: r["_salts"] for r in hot_keys(counts, "k", "n", hot_rows=100).collect()}
    assert found == {7: 12}


def test_counts_may_be_given(spark):
    detail, lookup = frames(spark)
    counts = detail.groupBy("k").agg(F.count("row").alias("n"))
    got = attach(detail, lookup, "k", ["row"], counts=counts, n="n", hot_rows=100)
    assert got.count() == detail.count()
