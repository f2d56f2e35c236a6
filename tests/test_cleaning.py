from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewlab.operators import cleaning as cl

NAN = float("nan")


def test_drop_nulls_equals_na_drop(spark):
    rows = [(1, 1.0, "a"), (2, NAN, "b"), (3, None, "c"), (4, 4.0, None), (None, None, None)]
    df = spark.createDataFrame(rows, "i int, x double, s string")
    for how in ("any", "all"):
        ours = cl.drop_nulls(df, how).collect()
        assert sorted(map(str, ours)) == sorted(map(str, df.na.drop(how).collect()))
    assert cl.drop_nulls(df, subset=["x"]).count() == 2
    with pytest.raises(ValueError):
        cl.drop_nulls(df, "some")


def test_drop_nulls_turns_left_join_into_inner(spark):
    a = spark.range(10).withColumnRenamed("id", "k")
    b = spark.range(5).select(F.col("id").alias("k"), F.col("id").alias("v"))
    joined = cl.drop_nulls(a.join(b, "k", "left"))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner" in plan and "LeftOuter" not in plan


def test_parse_timestamps(spark):
    df = spark.createDataFrame([("2024-02-29 23:59:59",), ("bad",), ("",), (None,)], "t string")
    got = [r[0] for r in cl.parse_timestamps(df, ["t"]).collect()]
    assert got == [datetime(2024, 2, 29, 23, 59, 59), None, None, None]
    already = cl.parse_timestamps(df, ["t"])
    assert cl.parse_timestamps(already, ["t"]).schema == already.schema


def test_drop_duplicates_and_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "i int, s string")
    assert cl.drop_duplicates(df).count() == 2
    assert cl.drop_columns(df, ["s", "no_such"]).columns == ["i"]
    assert cl.project(df, {"j": "i"}).columns == ["j"]


def test_distinct_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "s string")
    assert [r[0] for r in cl.distinct_values(df, "s").collect()] == ["a", "b"]


def test_latest_per_key_ties_and_nulls(spark):
    rows = [
        (1, 10, "r1", 5),
        (1, 20, "r2", 1),
        (1, 20, "r3", 2),
        (2, 5, "r4", 3),
        (2, None, "r5", 4),
        (3, None, "r6", 4),
    ]
    df = spark.createDataFrame(rows, "k int, t int, id string, score int")
    got = {r["k"]: r["id"] for r in cl.latest_per_key(df, "k", "t", "id").collect()}
    assert got == {1: "r3", 2: "r4"}
    assert cl.latest_per_key(df, "k", "t", "id").columns == df.columns
