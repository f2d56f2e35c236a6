from __future__ import annotations

import pytest

from reviewlab.operators import profiling as pr

NAN = float("nan")


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, 1.0, "a"), (1, NAN, "b"), (2, None, "a"), (3, 4.0, None)]
    return spark.createDataFrame(rows, "i int, x double, s string")


def one(frame):
    return frame.head().asDict()


def test_merged_sketches(spark):
    rows = [(g, float(v), v) for g in "ab" for v in range(300)] + [("c", NAN, None), ("c", -0.0, 0)]
    df = spark.createDataFrame(rows, "g string, x double, v int")
    parts = pr.distinct_sketches(df, ["x", "v"], by=["g"])
    assert parts.count() == 3
    found = one(pr.merged_distinct(parts, ["x", "v"]))
    assert abs(found["x"] - 301) <= 15 and abs(found["v"] - 300) <= 15
    assert one(pr.distinct_count(df, ["x", "v"])) == {"x": 301, "v": 300}
    empty = df.filter("false")
    assert one(pr.distinct_count(empty, ["x"])) == {"x": 0}


def test_exact_counts_multiply_no_rows(df):
    plan = pr.distinct_count(df, ["i", "s"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_counts(df):
    assert one(pr.null_counts(df)) == {"i": 0, "x": 1, "s": 1}
    assert one(pr.null_nan_counts(df)) == {"i": 0, "x": 2, "s": 1}
    assert one(pr.distinct_count(df, ["i", "s"])) == {"i": 3, "s": 2}
    assert one(pr.distinct_count(df, ["i"], approximate=True)) == {"i": 3}
    assert one(pr.row_count(df)) == {"rows": 4}


def test_schema_report(df):
    got = [tuple(r) for r in pr.schema_report(df).collect()]
    assert got == [(0, "i", "int", 4, 4), (1, "x", "double", 4, 3), (2, "s", "string", 4, 3)]


def test_grain(df):
    assert one(pr.grain_check(df, "i")) == {"rows": 4, "keys": 3, "repeated_keys": 1}
    assert [tuple(r) for r in pr.key_repeats(df, "i").collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        pr.assert_unique_key(df, "i")
    assert pr.assert_unique_key(df, ["i", "x"]) is df


def test_frequencies(df):
    assert {r["s"]: r["n"] for r in pr.value_counts(df, "s").collect()} == {"a": 2, "b": 1, None: 1}
    shares = {r["s"]: r["percent"] for r in pr.share_of_total(df, "s").collect()}
    assert shares == {"a": 50.0, "b": 25.0, None: 25.0}
    pivot = {r["i"]: (r["a"], r["b"]) for r in pr.pivot_counts(df, "i", "s", ["a", "b"]).collect()}
    assert pivot == {1: (1, 1), 2: (1, 0), 3: (0, 0)}


def test_histogram(spark):
    values = spark.createDataFrame([(v,) for v in (1, 1, 2, 5, 5, 5, None)], "v int")
    got = [(r["bin"], r["n"]) for r in pr.histogram(values, "v", 4).orderBy("bin").collect()]
    assert got == [(0, 2), (1, 1), (2, 0), (3, 3)]
    fixed = pr.histogram(values, "v", 2, low=0, high=4).orderBy("bin").collect()
    assert [(r["low"], r["high"], r["n"]) for r in fixed] == [(0.0, 2.0, 2), (2.0, 4.0, 1)]
    same = spark.createDataFrame([(3,), (3,)], "v int")
    assert sum(r["n"] for r in pr.histogram(same, "v", 3).collect()) == 2


def test_describe(spark, df):
    got = {r["column"]: r.asDict() for r in pr.describe(spark.range(1, 5).toDF("v")).collect()}
    assert got["v"]["mean"] == 2.5 and got["v"]["count"] == 4
    assert got["v"]["stddev"] == pytest.approx(1.2909944487)
    text = pr.describe_text(df, ["s"]).head()
    assert (text["count"], text["min"], text["max"]) == (3, "a", "b")


def test_order(df):
    assert [r["i"] for r in pr.preview(df, 2, "i").collect()] == [1, 1]
    assert [r["i"] for r in pr.top_k(df, "i", 2).collect()] == [3, 2]
    assert [r["i"] for r in pr.sorted_report(df, "i", ["s"]).collect()] == [3, 2, 1, 1]
