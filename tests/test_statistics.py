"""Distributed statistics against numpy on the same values."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from reviewlab.operators import statistics as st
from reviewlab.operators.ranking import bucketed, cut_points, running_totals


def frame(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def test_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.full(700, 3.25), rng.normal(3, 2, 1301)])
    df = frame(spark, [*values, None, float("nan")])
    probabilities = [0.0, 0.1, 0.25, 0.333, 0.5, 0.9, 1.0]
    for buckets in (2, 7, 256):
        got = {r["p"]: r["value"] for r in st.quantiles(df, ["x"], probabilities, buckets).collect()}
        for p in probabilities:
            assert got[p] == pytest.approx(np.quantile(values, p), abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(hs.lists(hs.integers(-4, 4), min_size=1, max_size=30))
def test_quartiles_of_any_list(spark, values):
    got = st.quartiles(frame(spark, values), ["x"], error=0.0)["x"]
    assert got == pytest.approx(list(np.quantile(values, [0.25, 0.75])))


def test_approximate_quartiles_keep_their_error(spark):
    df = frame(spark, range(1000))
    q1, q3 = st.quartiles(df, ["x"], 0.05)["x"]
    assert 200 <= q1 <= 300 and 700 <= q3 <= 800


def test_outliers(spark):
    values = [*range(1, 10), 100]
    df = frame(spark, values)
    q1, q3 = np.quantile(values, [0.25, 0.75])
    row = st.outlier_counts(df, ["x"], error=0.0).head()
    assert (row["q1"], row["q3"], row["outliers"]) == (q1, q3, sum(v < q1 or v > q3 for v in values))
    assert st.outlier_counts(df, ["x"], error=0.0, k=1.5).head()["outliers"] == 1
    assert [r["x"] for r in st.iqr_outliers(df, "x", k=1.5).collect()] == [100.0]
    box = st.box_stats(df, ["x"]).head()
    assert (box["min"], box["median"], box["max"]) == (1.0, 5.5, 100.0)


def test_empty_column(spark):
    df = frame(spark, [None, None])
    assert st.quantiles(df, ["x"], [0.5]).collect() == []
    assert st.iqr_outliers(df, "x").count() == 0


def test_running_totals_match_a_plain_loop(spark):
    rng = np.random.default_rng(1)
    values = [*rng.integers(0, 40, 300).tolist(), *[7] * 200]
    df = frame(spark, values)
    for buckets in (2, 5, 64):
        cells = bucketed(df, "x", cut_points(df, ["x"], buckets)[0])
        for descending in (False, True):
            got = running_totals(cells, "x", {"n": F.count(F.lit(1))}, descending=descending)
            for r in got.collect():
                before = [v for v in values if (v > r["x"] if descending else v < r["x"])]
                assert (r["n"], r["n_before"], r["n_all"]) == (
                    values.count(r["x"]), len(before), len(values)
                )


def matrix(spark, data, names):
    return spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"{n} double" for n in names))


def test_correlation(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(200, 3))
    data[:, 2] += data[:, 0]
    names = ["a", "b", "c"]
    got = {(r["row"], r["col"]): r["r"] for r in st.correlation_matrix(matrix(spark, data, names), names).collect()}
    want = np.corrcoef(data.T)
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            assert got[a, b] == pytest.approx(want[i, j], abs=1e-12)


@pytest.mark.parametrize("center", [False, True])
def test_vif_is_one_over_one_minus_r_squared(spark, center):
    rng = np.random.default_rng(3)
    data = rng.normal(loc=2, size=(300, 4))
    data[:, 3] = data[:, 0] + 0.3 * data[:, 3]
    names = list("abcd")
    got = {r["feature"]: r["vif"] for r in st.vif(matrix(spark, data, names), names, center).collect()}
    used = data - data.mean(axis=0) if center else data
    for i, n in enumerate(names):
        others = np.delete(used, i, axis=1)
        beta, *_ = np.linalg.lstsq(others, used[:, i], rcond=None)
        rest = ((used[:, i] - others @ beta) ** 2).sum()
        assert got[n] == pytest.approx((used[:, i] ** 2).sum() / rest, rel=1e-8)


def test_vif_of_dependent_columns_is_huge(spark):
    data = [(i, 2 * i, (i * 7) % 5) for i in range(1, 30)]
    got = {r["feature"]: r["vif"] for r in st.vif(matrix(spark, data, "abc"), list("abc")).collect()}
    assert abs(got["a"]) > 1e8 or np.isinf(got["a"])


@pytest.mark.parametrize("first", [2, 5])
def test_buckets_stay_bounded(spark, first):
    """Skew, one very frequent value, infinities: no bucket to be ordered has more rows than asked."""
    n = 6000
    x = F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.exp(F.col("id") % 1999 / 100.0))
    x = F.when(F.col("id") == 1, F.lit(float("inf"))).when(F.col("id") == 2, F.lit(-1e300)).otherwise(x)
    df = spark.range(n).select(x.alias("x"), (F.col("id") % 5).cast("double").alias("y"))
    for rows in (1000, 50):
        edges = cut_points(df, ["x", "y"], first, bucket_rows=rows)
        for name, own in zip(("x", "y"), edges):
            sizes = bucketed(df, name, own).groupBy("bucket").agg(
                F.count(F.lit(1)).alias("n"), F.count_distinct(name).alias("values")
            )
            assert sizes.filter((F.col("n") > rows) & (F.col("values") > 1)).isEmpty()
    assert cut_points(df, ["x"], first, bucket_rows=n) == cut_points(df, ["x"], first)


def test_refined_buckets_give_the_same_numbers(spark, monkeypatch):
    from reviewlab.operators import evaluation as ev
    from reviewlab.operators import ranking
    from reviewlab.operators import statistics as stats

    df = spark.range(3000).select(
        (F.pmod(F.xxhash64("id"), F.lit(700)) / 7).alias("score"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int").alias("label"),
    )
    whole = sorted(stats.quantiles(df, ["score"], [0.1, 0.5, 0.93]).collect()), ev.auc_roc(df).first()
    plain = cut_points(df, ["score"], 3)
    monkeypatch.setattr(ranking.cut_points, "__defaults__", (None, 40))
    assert len(cut_points(df, ["score"], 3)[0]) > len(plain[0])
    fine = sorted(stats.quantiles(df, ["score"], [0.1, 0.5, 0.93], 3).collect()), ev.auc_roc(df, buckets=3).first()
    assert fine[0] == whole[0] and fine[1].auc == pytest.approx(whole[1].auc, abs=1e-12)
