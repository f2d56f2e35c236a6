"""Correlation, collinearity, quantiles and outliers, all measured in distributed passes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.operators.cleaning import drop_nulls
from reviewlab.operators.ranking import bucket_offsets, bucketed_long, cut_points

# The columns of the two collinearity reports.
CORRELATION_COLUMNS = [
    "recency",
    "order_count",
    "approval_duration",
    "delivery_delay",
    "avg_name_length",
    "avg_description_length",
    "total_photos",
    "total_volume",
    "avg_product_volume_per_order",
    "total_product_density",
    "avg_product_density",
    "payment_value",
    "installment_value",
    "review",
    "review_responsiveness",
]
VIF_COLUMNS = [c for c in CORRELATION_COLUMNS if c not in ("recency", "avg_name_length")]


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return drop_nulls(df.select([F.col(c).cast("double").alias(c) for c in columns]))


def _pearson(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """The k x k correlation matrix; Spark adds it up over the partitions, block by block.

    The vectors are kept for the few passes that takes, so what built them runs once.
    """
    vectors = _doubles(df, columns).select(array_to_vector(F.array(*columns)).alias("v")).persist()
    try:
        return Correlation.corr(vectors, "v").head()[0].toArray()
    finally:
        vectors.unpersist()


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair as (row, col, r); rows with a null are left out."""
    matrix = _pearson(df, columns)
    cells = [
        (a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(cells, "row string, col string, r double")


def vif(df: DataFrame, columns: Sequence[str], center: bool = False) -> DataFrame:
    """Variance inflation factor of each column, largest first.

    Each column is regressed on the others without an intercept, so the factor is the diagonal
    of the inverse cosine matrix. With ``center`` it is that of the correlation matrix, the
    textbook factor. The matrix is added up by Spark; only its k x k inverse is local.
    A constant column counts like any other and is not taken for an intercept.
    """
    names = list(columns)
    gram = _pearson(df, names) if center else _products(df, names)
    report = df.sparkSession.createDataFrame(
        [(c, float(v)) for c, v in zip(names, _inflation(gram))], "feature string, vif double"
    )
    return report.orderBy(F.desc("vif"), "feature")


def _products(df: DataFrame, names: Sequence[str]) -> np.ndarray:
    """Sums of the products of every pair of columns, from one pass."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs]
    row = _doubles(df, names).agg(*sums).head()
    gram = np.full((len(names), len(names)), np.nan)
    for i, j in pairs:
        if row[f"p{i}_{j}"] is not None:
            gram[i, j] = gram[j, i] = row[f"p{i}_{j}"]
    return gram


def _inflation(gram: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", divide="ignore"):
        scale = np.sqrt(np.diag(gram))
        cosine = gram / np.outer(scale, scale)
        try:
            return np.diag(np.linalg.inv(cosine))
        except np.linalg.LinAlgError:
            return np.full(len(gram), np.inf)


# -- quantiles --------------------------------------------------------------------------------


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    buckets: int | None = None,
) -> DataFrame:
    """Exact interpolated quantiles of each column as (column, p, value).

    The value at a fraction p of n sorted values lies at rank (n-1)p, between two neighbours if
    that is no whole number. One approximate pass finds the cut points and one counts rows per
    bucket; only rows of the buckets that hold a wanted rank are then put in order.
    """
    names = list(columns)
    doubles = df.select([F.col(c).cast("double").alias(c) for c in names])
    values = bucketed_long(doubles, names, cut_points(doubles, names, buckets))
    per_bucket = values.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = bucket_offsets(per_bucket, ["column"], ["n"], descending=False)

    # the two neighbour ranks of each probability, with the bucket that holds them
    place = (F.col("n_all") - 1) * F.col("p")
    wanted = (
        offsets.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("part", place - F.floor(place))
        .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("rank", F.when(F.col("side") == 0, F.floor(place)).otherwise(F.ceil(place)))
        .filter(F.col("rank") >= F.col("n_offset"))
        .filter(F.col("rank") < F.col("n_offset") + F.col("n_bucket"))
        .select("column", "bucket", "n_offset", "p", "part", "side", "rank")
    )
    needed = wanted.select("column", "bucket", "n_offset").distinct()
    inside = Window.partitionBy("column", "bucket").orderBy("value")
    ranked = (
        values.join(F.broadcast(needed), ["column", "bucket"])
        .groupBy("column", "bucket", "value", "n_offset")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(inside) + F.col("n_offset"))
        .drop("n_offset")
    )
    hit = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    low, high = (F.max(F.when(F.col("side") == i, F.col("value"))) for i in (0, 1))
    return (
        ranked.join(F.broadcast(wanted), ["column", "bucket"])
        .filter(hit)
        .groupBy("column", "p")
        .agg((low + (high - low) * F.max("part")).alias("value"))
    )


def quartiles(df: DataFrame, columns: Sequence[str], error: float = 0.05) -> dict[str, list[float]]:
    """First and third quartile of each column; exact when the permitted rank error is 0."""
    if error > 0:
        found = df.approxQuantile(list(columns), [0.25, 0.75], error)
        return dict(zip(columns, found))
    rows = quantiles(df, columns, [0.25, 0.75]).collect()
    cells = {(r["column"], r["p"]): r["value"] for r in rows}
    return {c: [cells[c, 0.25], cells[c, 0.75]] for c in columns if (c, 0.25) in cells}


def fences(
    df: DataFrame, columns: Sequence[str], error: float = 0.0, k: float = 0.0
) -> dict[str, tuple[float, float, float, float]]:
    """(q1, q3, low, high) per column, the fences ``k`` interquartile ranges outside."""
    out = {}
    for c, found in quartiles(df, columns, error).items():
        if found:
            q1, q3 = found
            out[c] = (q1, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def iqr_outliers(df: DataFrame, column: str, error: float = 0.0, k: float = 0.0) -> DataFrame:
    """The rows whose value lies outside the fences (k=0: outside the quartiles)."""
    limits = fences(df, [column], error, k)
    if not limits:
        return df.limit(0)
    _, _, low, high = limits[column]
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def outlier_counts(
    df: DataFrame, columns: Sequence[str], error: float = 0.05, k: float = 0.0
) -> DataFrame:
    """Quartiles, fences and number of rows outside them per column; counted in one pass."""
    limits = fences(df, columns, error, k)
    names = list(limits)
    row = df.agg(
        *[
            F.count_if((F.col(c) < limits[c][2]) | (F.col(c) > limits[c][3])).alias(c)
            for c in names
        ]
    )
    fields = ["q1", "q3", "low", "high"]
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.lit(float(v)).alias(f) for f, v in zip(fields, limits[c])],
            F.col(f"`{c}`").alias("outliers"),
        )
        for c in names
    ]
    return row.select(F.inline(F.array(*lines)))


def box_stats(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Least value, quartiles, median and greatest value of each column."""
    # The five numbers of a box plot.
    parts = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    found = quantiles(df, list(columns), list(parts.values()))
    return found.groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for n, p in parts.items()]
    )
