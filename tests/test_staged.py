"""Searches with shared fits give what separate fits of every point give."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlab.operators import models as md
from reviewlab.operators import staged
from reviewlab.plans import training as tr


@pytest.fixture(scope="module")
def data(spark):
    h = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000)) / 1000
    good = ((h(1) < 0.5) != (h(2) < 0.3)).cast("int")
    base = spark.range(1500).select(
        F.col("id").alias("order_id"),
        F.when(h(2) < 0.3, "toys").when(h(2) < 0.6, "art").otherwise("books").alias("category"),
        (h(1) * 10).alias("delay"),
        h(3).alias("noise"),
        F.when(h(4) < 0.1, 1 - good).otherwise(good).alias("review"),
    )
    prepared = tr.prepare(base)
    yield prepared
    prepared.release()


def both(data, name, values, **fixed):
    one = md.tune(data.train, name, values, folds=2, **fixed)
    each = md.tune(data.train, name, values, folds=2, staged=False, **fixed)
    names = [{p.name: v for p, v in point.items()} for point in one.getEstimatorParamMaps()]
    others = [{p.name: v for p, v in point.items()} for point in each.getEstimatorParamMaps()]
    at = [others.index(point) for point in names]
    return one, one.avgMetrics, [each.avgMetrics[i] for i in at]


def test_boosting_rounds_are_prefixes(data):
    values = {"maxDepth": [2, 4], "maxIter": [1, 3, 5], "stepSize": [0.1, 0.5]}
    found, got, wanted = both(data, "gbt", values)
    assert len(got) == 12 and got == pytest.approx(wanted, abs=1e-9)
    assert found.bestModel.getNumTrees == found.bestModel.getOrDefault("maxIter")


def test_depths_of_a_tree_are_cuts(data):
    found, got, wanted = both(data, "dt", {"maxDepth": [1, 3, 6], "maxBins": [8, 32]})
    assert len(got) == 6 and got == pytest.approx(wanted, abs=1e-9)
    assert found.bestModel.depth <= 6


def test_forest_points(data):
    """Cut and counted by hand: the trees of one forest, fewer of them and less deep."""
    values = {"numTrees": [3, 7], "maxDepth": [2, 5]}
    found = md.tune(data.train, "rf", values, folds=2)
    assert len(found.avgMetrics) == 4 and min(found.avgMetrics) > 0.7
    model = md.classifier("rf", numTrees=7, maxDepth=5, seed=3).fit(data.train)
    spark = data.train.sparkSession
    scores = staged.point_scores(
        staged.trees(model, spark), F.col("features"), spark, [5], list(range(1, 8))
    )
    rows = model.transform(data.test).withColumn("scores", scores)
    raw = vector_to_array("rawPrediction")[1]
    seven = rows.filter(F.abs(F.col("scores")[6] - raw) > 1e-9)
    assert seven.isEmpty() and not rows.isEmpty()
    for k in (0, 4):
        only = model.trees[: k + 1]
        total = F.lit(0.0)
        for i, tree in enumerate(only):
            tree.setPredictionCol(f"p{i}").setProbabilityCol(f"q{i}").setRawPredictionCol(f"r{i}")
            rows = tree.transform(rows)
            total = total + vector_to_array(f"q{i}")[1]
        assert rows.filter(F.abs(F.col("scores")[k] - total) > 1e-9).isEmpty()
        rows = rows.select("order_id", "features", "label", "scores")


def test_one_tree_cut_at_any_depth(data):
    spark = data.train.sparkSession
    deep = md.classifier("dt", maxDepth=8).fit(data.train)
    found = staged.trees(deep, spark)
    rows = data.test.withColumn(
        "scores", staged.point_scores(found, F.col("features"), spark, [0, 1, 2, 4, 8], [1])
    )
    for i, depth in enumerate([0, 1, 2, 4, 8]):
        own = md.classifier("dt", maxDepth=depth).fit(data.train).transform(rows)
        raw = vector_to_array("rawPrediction")[1]
        assert own.filter(F.abs(F.col("scores")[i] - raw) > 1e-9).isEmpty()


def test_unknown_parameter_is_refused(data):
    with pytest.raises(ValueError):
        md.tune(data.train, "gbt", {"numTrees": [3]})


def test_a_fit_has_no_more_partitions_than_it_needs(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 1000, 1, 64)
    assert staged.tree_rows(rows).rdd.getNumPartitions() == 1
    monkeypatch.setattr(staged, "PARTITION_ROWS", 5)
    assert staged.tree_rows(rows).rdd.getNumPartitions() == cores
    monkeypatch.setattr(staged, "MOST_ROWS", 30)
    assert staged.tree_rows(rows).rdd.getNumPartitions() == 1000 // 30 + 1


def test_a_large_forest_is_fitted_in_parts(data, monkeypatch):
    """All trees, drawn apart, in one model that is scored, saved and reported as any other."""
    spark = data.train.sparkSession
    monkeypatch.setattr(staged, "PART_TREES", 3)
    model = md.fit(data.train, "rf", numTrees=7, maxDepth=5)
    assert model.getNumTrees == len(model.trees) == len(model.treeWeights) == 7
    assert len({tree.toDebugString.split("\n", 1)[1] for tree in model.trees}) == 7
    assert model.getOrDefault("maxDepth") == 5 and model.getSeed() == md.PRESETS["rf"]["seed"]
    assert model.featureImportances.toArray().sum() == pytest.approx(1)
    parts = [tree.featureImportances.toArray() for tree in model.trees]
    assert model.featureImportances.toArray() == pytest.approx(sum(parts) / 7)
    score = staged.point_scores(staged.trees(model, spark), F.col("features"), spark, [None], [7])
    rows = model.transform(data.test).withColumn("score", score[0])
    raw = vector_to_array("rawPrediction")[1]
    assert rows.filter(F.abs(F.col("score") - raw) > 1e-9).isEmpty() and not rows.isEmpty()
    again = md.fit(data.train, "rf", numTrees=7, maxDepth=5)
    assert again.toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]
    monkeypatch.setattr(staged, "WALKED_ROWS", 10)
    whole = md.fit(data.train, "rf", numTrees=7, maxDepth=5)
    assert whole.getNumTrees == 7 and len(whole.trees) == 7


def test_fits_on_many_rows_run_two_at_a_time():
    assert staged.side_by_side(8, 1_000) == 8 and staged.side_by_side(8, 0) == 8
    assert staged.side_by_side(8, 4_000_000) == staged.side_by_side(8, 10**9) == 2
    assert staged.side_by_side(1, 10**9) == 1


def test_only_the_unscaled_vectors_are_kept(data):
    base = data.train.select("order_id", F.col("label").alias("review"))
    base = base.withColumn("delay", F.pmod("order_id", F.lit(7)))
    own = tr.prepare(base)
    names = ["order_id", "features", "scaledFeatures", "label"]
    assert own.train.columns == [*names, "fold"] and own.test.columns == names
    assert [side.columns for side in own.kept] == [
        ["order_id", "features", "label", "fold"],
        ["order_id", "features", "label"],
    ]
    assert all(side.storageLevel.useMemory for side in own.kept)
    whole = own.encoder.transform(base).select("order_id", F.col("scaledFeatures").alias("wanted"))
    found = own.train.drop("fold").union(own.test).join(whole, "order_id")
    assert found.count() == base.count()
    differ = F.col("scaledFeatures").cast("string") != F.col("wanted").cast("string")
    assert found.filter(differ).isEmpty()
    own.release()
    assert not any(side.storageLevel.useMemory for side in own.kept)
