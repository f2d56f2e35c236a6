"""Trees grown on binned rows are Spark's, also where their tops are counted on many tasks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlab.operators import forest as fo
from reviewlab.operators import models as md
from reviewlab.operators import staged
from reviewlab.plans import scoring as sc
from reviewlab.plans import training as tr


@pytest.fixture(scope="module")
def base(spark):
    h = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000)) / 1000
    good = ((h(1) < 0.5) != (h(2) < 0.3)).cast("int")
    return spark.range(3000).select(
        F.col("id").alias("order_id"),
        F.when(h(2) < 0.3, "toys").when(h(2) < 0.6, "art").otherwise("books").alias("category"),
        (h(1) * 10).alias("delay"),
        h(3).alias("noise"),
        F.when(h(4) < 0.1, 1 - good).otherwise(good).alias("review"),
    )


@pytest.fixture(scope="module")
def data(base):
    prepared = tr.prepare(base)
    yield prepared
    prepared.release()


@pytest.mark.parametrize("most", [1_000_000, 300])
def test_a_tree_is_the_one_spark_fits(data, monkeypatch, most):
    spark = data.train.sparkSession
    monkeypatch.setattr(fo, "GROUP_ROWS", most)
    monkeypatch.setattr(fo, "BLOCK_ROWS", 500)
    cut = fo.binned(data.train, "features", 16)
    assert cut.rows == data.train.count() and cut.bins.width == 16
    found = fo.fit(cut, fo.Draw(1, 7, len(cut.bins.sizes), False, 5))
    assert (len(found.tops[0].left) > 1) == (most == 300)
    depths = [0, 1, 3, 7]
    scores = fo.point_scores(found, F.col("features"), spark, depths, [1], share=False)
    rows = data.test.withColumn("scores", scores)
    for i, depth in enumerate(depths):
        own = md.classifier("dt", maxDepth=depth, maxBins=16).fit(data.train)
        raw = vector_to_array("rawPrediction")[1]
        assert own.transform(rows).filter(F.abs(F.col("scores")[i] - raw) > 1e-9).isEmpty()
    assert found.importances == pytest.approx(own.featureImportances.toArray())


def test_a_forest_on_many_rows_is_written(spark, base, data, monkeypatch, tmp_path):
    """Grown apart from Spark's fit, whole, the same on every run, scored and saved as a model."""
    monkeypatch.setattr(staged, "WALKED_ROWS", 1000)
    monkeypatch.setattr(fo, "GROUP_ROWS", 500)
    model = md.fit(data.train, "rf", numTrees=12, maxDepth=8)
    assert isinstance(model, fo.ForestModel) and len(model.trees) == model.getNumTrees == 12
    assert len({t.left.tobytes() + t.cut.tobytes() for t in model.trees}) == 12
    assert model.getMaxDepth() == 8 and model.getSeed() == md.PRESETS["rf"]["seed"]
    assert model.featureImportances.toArray().sum() == pytest.approx(1)
    report = md.feature_importances(model, data.train).collect()
    assert {r.feature for r in report[:2]} == {"category_toys", "delay"}
    done = tr.train_and_evaluate(data, "rf", numTrees=12, maxDepth=8)
    got = {r["metric"]: r["value"] for r in done.metrics.collect()}
    assert got["auc"] > 0.8 and got["rows"] == data.test.count()
    path = str(tmp_path / "model")
    sc.save_model(data.encoder, model, path)
    again = sc.load_model(path).transform(base).select("order_id", "probability")
    same = again.withColumnRenamed("probability", "p").join(done.scored, "order_id")
    assert same.count() == data.test.count()
    assert same.filter(F.col("p").cast("string") != F.col("probability").cast("string")).isEmpty()
    sums = [vector_to_array(c)[0] + vector_to_array(c)[1] for c in ("probability", "rawPrediction")]
    assert done.scored.filter((F.abs(sums[0] - 1) > 1e-9) | (F.abs(sums[1] - 12) > 1e-9)).isEmpty()


def test_other_forests_are_left_to_spark(data, monkeypatch):
    monkeypatch.setattr(staged, "WALKED_ROWS", 10)
    model = md.fit(data.train, "rf", numTrees=3, maxDepth=3, minInstancesPerNode=5)
    assert not isinstance(model, fo.ForestModel)
    assert not isinstance(md.fit(data.train, "dt", maxDepth=3), fo.ForestModel)


def test_cuts_are_at_even_steps_of_the_rows():
    few = fo.cuts(np.array([1.0, 2.0, 4.0]), np.array([5.0, 1.0, 1.0]), 3)
    assert few.tolist() == [1.5, 3.0]
    many = fo.cuts(np.arange(100.0), np.ones(100), 3)
    assert many.tolist() == [24.5, 49.5, 74.5]
    values, n = fo.thinned(np.arange(100_000.0), np.ones(100_000))
    assert len(values) <= fo.VALUES and n.sum() == 100_000


def test_packed_rows_come_back():
    bins = fo.Bins([np.zeros(0), np.zeros(1), np.arange(5.0), np.zeros(1), np.arange(200.0)])
    x = np.stack([np.arange(50) % s for s in bins.sizes], axis=1).astype(bins.kind)
    assert (bins.unpack(bins.pack(x)) == x).all()


def test_boosting_in_a_task_is_sparks(data):
    """Scores of held-out rows after some rounds, for two points that share their bins."""
    used, names = F.col("fold") != 0, ["maxDepth", "stepSize"]
    points = [(3, 0.5), (5, 0.1)]
    cut = fo.binned(data.train, "features", 32, used)
    scored = fo.boosted(cut, points, [1, 4])
    for fit, point in enumerate(points):
        got = scored.filter(F.col("fit") == fit)
        for k, rounds in enumerate((1, 4)):
            model = md.classifier("gbt", maxIter=rounds, **dict(zip(names, point)))
            own = model.fit(data.train.filter(used)).transform(data.train.filter(~used))
            raw = own.select(vector_to_array("rawPrediction")[1], "label").collect()
            mine = got.select(F.col("scores")[k], "label").collect()
            assert len(mine) == len(raw) > 0
            a, b = (sorted((round(r[0], 6), r[1]) for r in rows) for rows in (mine, raw))
            assert np.allclose(a, b, atol=1e-5)


@pytest.mark.parametrize("name", ["dt", "rf", "gbt"])
def test_searches_fit_no_tree_with_spark(data, monkeypatch, name):
    def refused(*args, **kwargs):
        raise AssertionError("fitted level by level")

    monkeypatch.setattr(staged, "fit_trees", refused)
    monkeypatch.setitem(staged.BINNED_FROM, name, 0)
    values = {"maxDepth": [2, 4], "maxBins": [8, 16]}
    values |= {"rf": {"numTrees": [2, 5]}, "gbt": {"maxIter": [1, 3]}}.get(name, {})
    found = md.tune(data.train, name, values, folds=2)
    assert len(found.avgMetrics) == len(found.points) and min(found.avgMetrics) > 0.6
