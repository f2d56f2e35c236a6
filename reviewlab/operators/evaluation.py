"""Measures of a binary classifier, computed where the scored rows are.

A scored frame has a ``label`` (0/1), a hard ``prediction`` (0/1) and a numeric score that grows
with the chance of label 1. ``score_column`` takes such a score out of a model's output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.ranking import bucketed, cut_points, running_totals
from reviewlab.session import remove, scratch_path

# Probabilities are kept this far from 0 and 1 before a logarithm is taken.
EPSILON = 1e-15


def score_column(scored: DataFrame) -> Column:
    """P(label 1), or the margin for a model without probabilities (linear SVM)."""
    name = "probability" if "probability" in scored.columns else "rawPrediction"
    return vector_to_array(F.col(name)).getItem(1)


# -- hard predictions -------------------------------------------------------------------------


def _cells(prediction: str, label: str) -> list[Column]:
    p, y = F.col(prediction), F.col(label)
    cells = {"tp": (1, 1), "fp": (1, 0), "fn": (0, 1), "tn": (0, 0)}
    return [F.count_if((p == a) & (y == b)).alias(n) for n, (a, b) in cells.items()]


def _rates() -> list[Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return [
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.try_divide(tp, tp + fn).alias("sensitivity"),
        F.try_divide(tn, tn + fp).alias("specificity"),
        F.try_divide(tp, tp + fp).alias("precision"),
    ]


def confusion_matrix(
    df: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """One row (tp, fp, fn, tn); a class nobody predicted counts zero."""
    return df.agg(*_cells(prediction, label))


def classification_rates(
    df: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """Accuracy, sensitivity, specificity and precision of class 1; null where undefined."""
    return confusion_matrix(df, prediction, label).select(*_rates())


def weighted_prf(
    df: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """Precision, recall and F1 averaged over the classes by their true frequency.

    Works for any number of classes: the pair counts are the only thing grouped.
    """
    pairs = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = F.array(
        F.struct(F.col("y").cast("double").alias("cls"), F.lit(True).alias("true_side")),
        F.struct(F.col("p").cast("double").alias("cls"), F.lit(False).alias("true_side")),
    )
    right = (F.col("y") == F.col("p")) & F.col("true_side")
    per_class = (
        pairs.select("*", F.inline(sides))
        .groupBy("cls")
        .agg(
            F.sum(F.when(right, F.col("n")).otherwise(0)).alias("hit"),
            F.sum(F.when(F.col("true_side"), F.col("n")).otherwise(0)).alias("true_n"),
            F.sum(F.when(~F.col("true_side"), F.col("n")).otherwise(0)).alias("said_n"),
        )
    )
    precision = F.coalesce(F.try_divide("hit", "said_n"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "true_n"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.col("hit") * 2.0, F.col("said_n") + F.col("true_n")), F.lit(0.0))
    weight = F.col("true_n")
    return per_class.agg(
        (F.sum(precision * weight) / F.sum(weight)).alias("weighted_precision"),
        (F.sum(recall * weight) / F.sum(weight)).alias("weighted_recall"),
        (F.sum(f1 * weight) / F.sum(weight)).alias("f1"),
    )


# -- scores -----------------------------------------------------------------------------------


def _class_totals(df: DataFrame, score: str, label: str, buckets: int | None) -> DataFrame:
    """Per distinct score, from the highest down: positives and negatives here and above."""
    rows = df.select(F.col(score).cast("double").alias("score"), F.col(label).alias("y"))
    rows = rows.filter(F.col("score").isNotNull() & F.col("y").isNotNull())
    cells = bucketed(rows, "score", cut_points(rows, ["score"], buckets)[0])
    weights = {"pos": F.count_if(F.col("y") == 1), "neg": F.count_if(F.col("y") != 1)}
    return running_totals(cells, "score", weights, descending=True)


def roc_curve(
    df: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None
) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, counting rows at or above it."""
    t = _class_totals(df, score, label, buckets)
    return t.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("neg_before") + F.col("neg"), "neg_all").alias("fpr"),
        F.try_divide(F.col("pos_before") + F.col("pos"), "pos_all").alias("tpr"),
    )


def auc_roc(
    df: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve; equal scores of the two classes count one half."""
    t = _class_totals(df, score, label, buckets)
    share = F.try_divide("neg", "neg_all")
    height = F.try_divide(F.col("pos_before") + F.col("pos") / 2, "pos_all")
    return t.agg(F.sum(share * height).alias("auc"))


def _log_loss(probability: str, label: str) -> Column:
    p = F.least(F.greatest(F.col(probability), F.lit(EPSILON)), F.lit(1 - EPSILON))
    return F.avg(F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))).alias("log_loss")


def log_loss(df: DataFrame, probability: str = "score", label: str = "label") -> DataFrame:
    """Mean negative log likelihood of the true class."""
    return df.agg(_log_loss(probability, label))


# -- whole models -----------------------------------------------------------------------------


def evaluate(scored: DataFrame) -> DataFrame:
    """(metric, value) of a model's output; log loss only where there are probabilities.

    The scores are written and read back: tasks on persisted rows would still be sent the model
    that they come from, a large forest again for every pass.
    """
    spark = scored.sparkSession
    path = scratch_path(spark, "scored")
    rows = scored.select("label", "prediction", score_column(scored).alias("score"))
    try:
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        sums = [F.count(F.lit(1)).alias("rows"), *_cells("prediction", "label")]
        if "probability" in scored.columns:
            sums.append(_log_loss("score", "label"))
        found = rows.agg(*sums).select("*", *_rates()).drop("tp", "fp", "fn", "tn").head().asDict()
        found.update(weighted_prf(rows).head().asDict())
        found.update(auc_roc(rows).head().asDict())
    finally:
        remove(spark, path)
    lines = [(m, None if v is None else float(v)) for m, v in sorted(found.items())]
    return spark.createDataFrame(lines, "metric string, value double")


def compare_models(reports: dict[str, DataFrame]) -> DataFrame:
    """The reports of several models under one another, as (model, metric, value)."""
    named = [
        report.select(F.lit(name).alias("model"), "metric", "value")
        for name, report in reports.items()
    ]
    return reduce(DataFrame.unionAll, named)
