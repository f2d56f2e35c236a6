"""Properties of fitted models: a planted signal is found, noise is not, nothing gets lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewlab.operators import encoding as en
from reviewlab.operators import models as md
from reviewlab.operators.evaluation import evaluate
from reviewlab.plans import scoring as sc
from reviewlab.plans import training as tr

SMALL = {
    "lr": {},
    "dt": {"maxDepth": 4},
    "rf": {"numTrees": 10, "maxDepth": 4},
    "svm": {},
    "gbt": {"maxIter": 4, "maxDepth": 3},
}


@pytest.fixture(scope="module")
def base(spark):
    """Label from the delay and the category, with one order in ten turned round."""
    h = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000)) / 1000
    delay = h(1) * 10
    category = F.when(h(2) < 0.3, "toys").when(h(2) < 0.6, "art").otherwise("books")
    good = (delay < 5).cast("int")
    return spark.range(2500).select(
        F.col("id").alias("order_id"),
        category.alias("category"),
        delay.alias("delay"),
        h(3).alias("noise"),
        F.when(h(4) < 0.1, 1 - good).otherwise(good).alias("review"),
    )


@pytest.fixture(scope="module")
def data(base):
    prepared = tr.prepare(base)
    yield prepared
    prepared.release()


@pytest.mark.parametrize("name", list(md.CLASSIFIERS))
def test_planted_signal_is_found(data, name):
    done = tr.train_and_evaluate(data, name, **SMALL[name])
    got = {r["metric"]: r["value"] for r in done.metrics.collect()}
    assert got["auc"] > 0.8 and got["accuracy"] > 0.8
    assert got["rows"] == data.test.count() == done.scored.count()
    assert ("log_loss" in got) == (name != "svm")
    column = "rawPrediction" if name == "svm" else "probability"
    assert md.evaluator(column).evaluate(done.scored) == pytest.approx(got["auc"], abs=0.01)


def test_random_label_is_not_learnt(base):
    noise = base.withColumn("review", F.pmod(F.xxhash64("order_id", F.lit(99)), F.lit(2)).cast("int"))
    prepared = tr.prepare(noise, durable=False)
    got = {r["metric"]: r["value"] for r in tr.train_and_evaluate(prepared, "lr").metrics.collect()}
    prepared.release()
    assert 0.4 < got["auc"] < 0.6


def test_importances(data):
    model = md.preset("rf", **SMALL["rf"]).fit(data.train)
    frame = md.feature_importances(model, data.train)
    got = {r["feature"]: r["importance"] for r in frame.collect()}
    assert sum(got.values()) == pytest.approx(1.0)
    assert max(got, key=got.get) == "delay"
    assert set(got) == {"category_art", "category_books", "category_toys", "delay", "noise"}
    grouped = {r["feature"]: r["importance"] for r in md.grouped_importances(frame).collect()}
    levels = [r["importance"] for r in md.importances_of(frame).collect()]
    assert grouped["category_product"] == pytest.approx(sum(levels))
    assert len(levels) == 3 and levels == sorted(levels, reverse=True)


def test_coefficients(data):
    model = md.preset("svm").fit(data.train)
    got = {r["feature"]: r["weight"] for r in md.coefficients(model, data.train).collect()}
    assert got["delay"] < 0 and abs(got["delay"]) > 5 * abs(got["noise"])
    assert got["(intercept)"] == pytest.approx(model.intercept)


def test_tuning_uses_the_grid(spark, data):
    found = md.tune(data.train, "dt", {"maxDepth": [1, 4], "maxBins": [16]}, folds=3)
    assert found.bestModel.depth <= 4
    scores = md.grid_scores(spark, found).collect()
    assert {(r["point"], r["param"]) for r in scores} == {
        (p, n) for p in (0, 1) for n in ("maxBins", "maxDepth")
    }
    best = {r["param"]: r["value"] for r in md.best_params(spark, found).collect()}
    top = max(scores, key=lambda r: r["metric"])["point"]
    assert best["maxDepth"] == ["1", "4"][top] and best["maxBins"] == "16"


def test_foreign_parameters_are_refused():
    with pytest.raises(ValueError):
        md.grid(md.classifier("rf"), {"stepSize": [0.1]})
    with pytest.raises(ValueError):
        md.classifier("svm", numTrees=3)
    for name, values in md.GRIDS.items():
        points = 1
        for options in values.values():
            points *= len(options)
        estimator = md.preset(name)
        grid = md.grid(estimator, values)
        assert len(grid) == points
        assert all(p.parent == estimator.uid for point in grid for p in point)


def test_final_scoring(spark, base, tmp_path):
    encoder, model = sc.fit_final(base, "dt", maxDepth=4)
    new = spark.createDataFrame(
        [(1, "toys", 1.0, 0.5), (2, "pink", 9.0, 0.5)],
        "order_id long, category string, delay double, noise double",
    )
    scored = sc.score_and_export(encoder, model, new, str(tmp_path / "out"))
    # the unknown category is scored as well
    assert {r["order_id"]: r["prediction"] for r in scored.collect()} == {1: 1.0, 2: 0.0}
    asked = spark.createDataFrame([(1,), (2,), (3,)], "order_id long")
    assert [r[0] for r in sc.unscored(asked, scored).collect()] == [3]
    assert tuple(sc.coverage(asked, scored).head()) == (3, 2, 1)
    sc.save_model(encoder, model, str(tmp_path / "model"))
    again = sc.load_model(str(tmp_path / "model")).transform(new)
    assert sorted(map(tuple, again.select("order_id", "prediction").collect())) == [(1, 1.0), (2, 0.0)]


def test_evaluate_in_the_order_of_scores(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(1.0, 1.0, Vectors.dense([0.2, 0.8])), (0.0, 0.0, Vectors.dense([0.9, 0.1]))]
    df = spark.createDataFrame(rows, ["label", "prediction", "probability"])
    got = {r["metric"]: r["value"] for r in evaluate(df).collect()}
    assert got["auc"] == got["accuracy"] == 1.0


def test_encoder_is_fitted_on_the_training_side(base):
    rare = base.withColumn("category", F.when(F.col("order_id") == 0, "only here").otherwise(F.col("category")))
    train, test = en.split(rare)
    held_out = test.filter("order_id = 0").count() == 1
    prepared = tr.prepare(rare, durable=False)
    known = "category_only here" in en.feature_names(prepared.train)
    prepared.release()
    assert known != held_out


def test_rare_levels_count_as_unknown(base):
    prepared = tr.prepare(base, durable=False, max_levels=1)
    names = en.feature_names(prepared.train)
    sizes = prepared.train.count(), prepared.test.count()
    prepared.release()
    assert len([n for n in names if n.startswith("category_")]) == 1
    assert sum(sizes) == base.count()
