"""The five classifiers, their grids, tuning and the reports on fitted models."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.operators.encoding import feature_names, with_fold
from reviewlab.operators.staged import STAGED, WALKED_ROWS, Search, fit_trees, side_by_side
from reviewlab.operators.staged import search as staged_search

CLASSIFIERS = {
    "lr": LogisticRegression,
    "dt": DecisionTreeClassifier,
    "rf": RandomForestClassifier,
    "svm": LinearSVC,
    "gbt": GBTClassifier,
}
# Linear models get the scaled vector; trees do not care and keep the readable one.
FEATURES_COLUMN = {"lr": "scaledFeatures", "svm": "scaledFeatures"}

# Trees of this depth or more are fitted with remembered node numbers.
DEEP = 15

# Parameters of the single fits.
PRESETS = {
    "lr": {},
    "dt": {"maxDepth": 10, "maxBins": 128},
    "rf": {"numTrees": 100, "maxDepth": 20, "maxBins": 128, "seed": 42},
    "svm": {"maxIter": 10, "regParam": 0.1},
    "gbt": {"maxDepth": 15, "maxIter": 15, "maxBins": 80, "stepSize": 0.1, "seed": 42},
}
# Parameters searched, and number of folds.
GRIDS = {
    "lr": {"regParam": [0.1, 0.01], "elasticNetParam": [0.8, 0.7]},
    "dt": {"maxDepth": [10, 20], "maxBins": [32, 64]},
    "rf": {"numTrees": [40, 60, 80, 100], "maxDepth": [10, 15, 20]},
    "svm": {"regParam": [0.01, 0.1, 1.0], "maxIter": [10, 50, 100]},
    "gbt": {
        "maxDepth": [10, 15, 25],
        "maxIter": [15, 30],
        "maxBins": [75],
        "stepSize": [0.01, 0.1],
    },
}
FOLDS = {"lr": 3, "dt": 5, "rf": 3, "svm": 3, "gbt": 3}


def classifier(name: str, features: str | None = None, **params) -> Estimator:
    """An estimator by short name with exactly the given parameters."""
    column = features or vector_of(name)
    estimator = CLASSIFIERS[name](featuresCol=column, labelCol="label")
    for key in params:
        if not estimator.hasParam(key):
            raise ValueError(f"{type(estimator).__name__} has no parameter {key}")
    return estimator.setParams(**params)


def preset(name: str, features: str | None = None, **overrides) -> Estimator:
    """The named classifier with its preset parameters, any of them overridden.

    Deep trees remember each row's node instead of walking the tree again at every level; with a
    checkpoint folder Spark cuts the lineage of these numbers now and then.
    """
    params = {**PRESETS[name], **overrides}
    if params.get("maxDepth", 0) >= DEEP:
        params.setdefault("cacheNodeIds", True)
    return classifier(name, features, **params)


def vector_of(name: str) -> str:
    """The vector that the named classifier reads."""
    return FEATURES_COLUMN.get(name, "features")


def fit(train: DataFrame, name: str, **overrides) -> Model:
    """The named classifier with its preset parameters, any of them overridden, fitted.

    A tree model is fitted on few partitions; on little data its trees are walked again at every
    level, which is cheaper than remembered node numbers.
    """
    if name not in STAGED:
        return preset(name, **overrides).fit(train)
    rows = train.count()
    if rows <= WALKED_ROWS:
        overrides = {"cacheNodeIds": False, **overrides}
    return fit_trees(preset(name, **overrides), train, rows=rows)


def grid(estimator: Estimator, values: dict[str, list]) -> list[dict]:
    """Every combination of the values, as parameters of this very estimator.

    Spark skips the parameters of another estimator without a word, so names are looked up here.
    """
    builder = ParamGridBuilder()
    for key, options in values.items():
        if not estimator.hasParam(key):
            raise ValueError(f"{type(estimator).__name__} has no parameter {key}")
        builder = builder.addGrid(estimator.getParam(key), options)
    return builder.build()


def evaluator(column: str = "rawPrediction") -> BinaryClassificationEvaluator:
    """Area under ROC from ``rawPrediction``, which every classifier here writes.

    The raw prediction of a single tree counts the rows of a leaf, so a tree's area by
    ``probability`` is another number; a grid search may use either.
    """
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=column)


def tune(
    train: DataFrame,
    name: str,
    values: dict[str, list] | None = None,
    folds: int | None = None,
    features: str | None = None,
    fold_column: str | None = "fold",
    parallelism: int = 8,
    score_column: str = "rawPrediction",
    key: str = "order_id",
    staged: bool = True,
    **fixed,
) -> CrossValidatorModel | Search:
    """Grid search by cross-validated area under ROC.

    ``fold_column`` keeps the rows of a key in one fold; it is computed here for the number of
    folds where ``train`` has the key. Grid points are fitted ``parallelism`` at a time, fewer on
    many rows; those of a tree model that are parts of a larger point are scored from its trees (``operators.staged``),
    unless ``staged`` is off or there are no fold numbers.
    """
    folds = folds or FOLDS[name]
    if fold_column and key in train.columns:
        train = with_fold(train.drop(fold_column), folds, key).withColumnRenamed("fold", fold_column)
    values = values or GRIDS[name]
    kept = {"seed": PRESETS[name]["seed"]} if "seed" in PRESETS[name] else {}
    if max(values.get("maxDepth", [0])) >= DEEP:
        kept["cacheNodeIds"] = True
    estimator = classifier(name, features, **{**kept, **fixed})
    if staged and name in STAGED and fold_column and score_column == "rawPrediction":
        grid(estimator, values)  # refuses names the estimator doesn't have
        found = evaluator(score_column)
        return staged_search(train, name, estimator, values, found, folds, fold_column, parallelism)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid(estimator, values),
        evaluator=evaluator(score_column),
        numFolds=folds,
        parallelism=side_by_side(parallelism, train.count()),
        seed=42,
    )
    if fold_column:
        search.setFoldCol(fold_column)
    return search.fit(train)


def score(model: Model, df: DataFrame, key: str | None = "order_id") -> DataFrame:
    """Predictions with the key kept."""
    scored = model.transform(df)
    wanted = [key, "label", "prediction", "probability", "rawPrediction"]
    return scored.select(*[c for c in wanted if c in scored.columns])


# -- reports ----------------------------------------------------------------------------------


def _frame(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def grid_scores(spark: SparkSession, found: CrossValidatorModel | Search) -> DataFrame:
    """(point, param, value, metric): mean metric of every grid point over the folds."""
    rows = [
        (i, p.name, str(v), float(metric))
        for i, (point, metric) in enumerate(zip(found.getEstimatorParamMaps(), found.avgMetrics))
        for p, v in sorted(point.items(), key=lambda item: item[0].name)
    ]
    return _frame(spark, rows, "point int, param string, value string, metric double")


def best_params(spark: SparkSession, found: CrossValidatorModel | Search) -> DataFrame:
    """(param, value) of the searched parameters, read from the best model itself."""
    names = sorted({p.name for point in found.getEstimatorParamMaps() for p in point})
    best = found.bestModel
    rows = [(n, str(best.getOrDefault(best.getParam(n)))) for n in names]
    return _frame(spark, rows, "param string, value string")


def coefficients(model: Model, encoded: DataFrame) -> DataFrame:
    """(feature, weight) of a linear model, the intercept last.

    Scaling keeps the order of the entries but not their names, so these come from ``features``.
    """
    names = feature_names(encoded)
    rows = [(n, float(w)) for n, w in zip(names, model.coefficients.toArray())]
    rows.append(("(intercept)", float(model.intercept)))
    return _frame(encoded.sparkSession, rows, "feature string, weight double")


def feature_importances(model: Model, encoded: DataFrame) -> DataFrame:
    """(feature, importance) of a tree model, the most important first."""
    names = feature_names(encoded)
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    report = _frame(encoded.sparkSession, rows, "feature string, importance double")
    return report.orderBy(F.desc("importance"), "feature")


def grouped_importances(
    importances: DataFrame, prefix: str = "category_", name: str = "category_product"
) -> DataFrame:
    """Sum the levels of one text column, which share a name prefix, into one line."""
    feature = F.when(F.col("feature").startswith(prefix), F.lit(name)).otherwise(F.col("feature"))
    return (
        importances.groupBy(feature.alias("feature"))
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def importances_of(importances: DataFrame, prefix: str = "category_") -> DataFrame:
    """The levels of one text column alone, the most important first."""
    levels = importances.filter(F.col("feature").startswith(prefix))
    return levels.orderBy(F.desc("importance"), "feature")
