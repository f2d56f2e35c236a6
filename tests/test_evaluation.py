from __future__ import annotations

import math
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from reviewlab.operators import evaluation as ev

SCHEMA = "score double, label double, prediction double"


def frame(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], SCHEMA)


def brute_auc(rows):
    pos = [s for s, y, _ in rows if y == 1]
    neg = [s for s, y, _ in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    out = []
    for _ in range(400):
        y = int(rng.random() < 0.3)
        s = round(min(max(rng.normal(0.4 + 0.2 * y, 0.2), 0), 1), 2)
        out.append((s, y, int(s > 0.5)))
    return out + [(0.5, i % 2, 0) for i in range(200)]


@pytest.mark.parametrize("buckets", [2, 9, 256])
def test_auc_is_exact(spark, rows, buckets):
    got = ev.auc_roc(frame(spark, rows), buckets=buckets).head()["auc"]
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_equals_spark_without_bins(spark, rows):
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    got = ev.auc_roc(frame(spark, rows)).head()["auc"]
    assert got == pytest.approx(evaluator.evaluate(frame(spark, rows)), abs=1e-9)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(hs.lists(hs.tuples(hs.integers(0, 5), hs.integers(0, 1)), min_size=2, max_size=25))
def test_auc_of_any_list(spark, pairs):
    data = [(s, y, 0) for s, y in pairs]
    got = ev.auc_roc(frame(spark, data)).head()["auc"]
    if len({y for _, y in pairs}) < 2:
        assert got is None
    else:
        assert got == pytest.approx(brute_auc(data))


def test_roc_curve(spark, rows):
    points = ev.roc_curve(frame(spark, rows)).collect()
    assert len(points) == len({s for s, _, _ in rows})
    for p in points:
        above = [y for s, y, _ in rows if s >= p["threshold"]]
        assert p["tpr"] == pytest.approx(sum(above) / sum(y for _, y, _ in rows))
        assert p["fpr"] == pytest.approx(above.count(0) / sum(1 - y for _, y, _ in rows))


def test_rates_and_weighted_measures(spark, rows):
    df = frame(spark, rows)
    cells = ev.confusion_matrix(df).head()
    assert sum(cells) == len(rows)
    got = ev.classification_rates(df).head()
    assert got["sensitivity"] == pytest.approx(cells["tp"] / (cells["tp"] + cells["fn"]))
    prf = ev.weighted_prf(df).head()
    for name, metric in {
        "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "f1": "f1"
    }.items():
        evaluator = MulticlassClassificationEvaluator(metricName=metric)
        assert prf[name] == pytest.approx(evaluator.evaluate(df), abs=1e-12)
    assert got["accuracy"] == pytest.approx(prf["weighted_recall"])


def test_one_class_predicted(spark):
    df = frame(spark, [(0.1, 1, 1), (0.2, 0, 1), (0.3, 1, 1)])
    assert tuple(ev.confusion_matrix(df).head()) == (2, 1, 0, 0)
    got = ev.classification_rates(df).head()
    assert (got["sensitivity"], got["specificity"]) == (1.0, 0.0)
    nothing = ev.classification_rates(frame(spark, [(0.1, 1, 0)])).head()
    assert nothing["precision"] is None and nothing["specificity"] is None


def test_log_loss_clips(spark):
    df = frame(spark, [(0.0, 1, 0), (1.0, 1, 1), (0.25, 0, 0)])
    want = (-math.log(1e-15) - math.log(1 - 1e-15) - math.log(0.75)) / 3
    assert ev.log_loss(df).head()["log_loss"] == pytest.approx(want)


def test_measures_are_taken_from_written_scores(spark, monkeypatch):
    """No pass after the first is sent the model, and nothing stays in the scratch folder."""
    seen, area = [], ev.auc_roc

    def asked(rows, *rest):
        seen.extend(rows.inputFiles())
        return area(rows, *rest)

    monkeypatch.setattr(ev, "auc_roc", asked)
    pair = F.array(1 - F.col("p"), F.col("p"))
    scored = spark.range(0, 40, 1, 4).select(
        (F.col("id") % 2).cast("double").alias("label"),
        ((F.col("id") % 3) / 2).cast("double").alias("p"),
        (F.col("id") % 3 > 1).cast("double").alias("prediction"),
    )
    scored = scored.withColumn("probability", array_to_vector(pair))
    found = {r.metric: r.value for r in ev.evaluate(scored).collect()}
    assert seen and not any(Path(urlparse(file).path).exists() for file in seen)
    assert found["rows"] == 40 and 0 < found["auc"] < 1
