"""Turning feature columns into vectors, scaling, selecting, splitting and staging."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    RFormula,
    StandardScaler,
    UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.storagelevel import StorageLevel

from reviewlab.functions.expressions import key_bucket
from reviewlab.operators.sets import SetEncoder
from reviewlab.session import scratch_path

# Label, key and joined-name columns of the review model, shares of the split, size of the selection.
LABEL = "review"
KEY = "order_id"
FORMULA = "review ~ . - order_id"
SETS = ("category",)
TRAIN_SHARE = 0.7
SPLIT_SEED = 123
SELECTED_FEATURES = 15
TRAIN_PARTITIONS = 15

# A split is decided over the whole range of a 32-bit hash.
HASH_BUCKETS = 1 << 32


# -- vectors ----------------------------------------------------------------------------------


def assemble(
    df: DataFrame, columns: Sequence[str], out: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    return VectorAssembler(
        inputCols=list(columns), outputCol=out, handleInvalid=handle_invalid
    ).transform(df)


def formula(text: str = FORMULA, handle_invalid: str = "skip", out: str = "features") -> RFormula:
    """Encoder of a model formula: text columns become 1/0 levels, numbers pass.

    Levels are ordered by frequency, then name. With ``skip`` the last level is left out and a
    row with an unknown level is dropped; with ``keep`` every known level has its place and an
    unknown one is all zeros.
    """
    return RFormula(
        formula=text, featuresCol=out, labelCol="label", handleInvalid=handle_invalid
    )


def scaler(column: str = "features", out: str = "scaledFeatures") -> StandardScaler:
    """Division by the sample standard deviation, without centring."""
    return StandardScaler(inputCol=column, outputCol=out)


def selector(
    k: int = SELECTED_FEATURES, column: str = "features", out: str = "selectedFeatures"
) -> UnivariateFeatureSelector:
    """The k features with the strongest chi-square relation to the label."""
    chosen = UnivariateFeatureSelector(
        featuresCol=column, labelCol="label", outputCol=out, selectionMode="numTopFeatures"
    )
    return chosen.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(k)


def build_stages(
    text: str = FORMULA,
    handle_invalid: str = "skip",
    scale: bool = True,
    select: int | Estimator | None = None,
    sets: Iterable[str] = (),
    max_levels: int | None = None,
) -> Pipeline:
    """Formula encoder, then scaling, then selection, each with an output column of its own.

    ``sets`` are text columns of joined names, which get an entry per name before the formula sees
    them (``operators.sets``); none of their names is left out, and unknown ones count for nothing.
    ``select`` is a number of entries for the plain test, where every value is a category, or a
    selector such as ``selection.BinnedSelector``, which takes continuous entries.
    """
    stages: list[Estimator] = [
        SetEncoder(inputCol=c, outputCol=c, maxLevels=max_levels or 0) for c in sets
    ]
    stages.append(formula(text, handle_invalid))
    if scale:
        stages.append(scaler())
    if select is not None:
        stages.append(select if isinstance(select, Estimator) else selector(select))
    return Pipeline(stages=stages)


def formula_features(
    df: DataFrame, text: str = FORMULA, handle_invalid: str = "skip"
) -> tuple[DataFrame, PipelineModel]:
    """Fit the encoder alone and apply it to the same rows."""
    model = build_stages(text, handle_invalid, scale=False).fit(df)
    return model.transform(df), model


def standardize(df: DataFrame, column: str = "features", out: str = "scaledFeatures") -> DataFrame:
    return scaler(column, out).fit(df).transform(df)


def chi2_scores(df: DataFrame, column: str = "features", label: str = "label") -> DataFrame:
    """(feature, pvalue, freedom, statistic) of the independence test of every feature."""
    names = F.array(*[F.lit(n) for n in feature_names(df, column)])
    found = ChiSquareTest.test(df, column, label, flatten=True)
    return found.select(
        F.get(names, F.col("featureIndex")).alias("feature"),
        F.col("pValue").alias("pvalue"),
        F.col("degreesOfFreedom").alias("freedom"),
        "statistic",
    )


def chi2_select(df: DataFrame, k: int = SELECTED_FEATURES, column: str = "features") -> DataFrame:
    return selector(k, column).fit(df).transform(df)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's entries in vector order.

    The metadata lists them by kind (numeric, binary, nominal), so they are sorted by index.
    """
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    entries = sorted((a["idx"], a["name"]) for group in groups for a in group)
    return [name for _, name in entries]


def cap_levels(
    df: DataFrame, column: str, max_levels: int, other: str | None = "other"
) -> DataFrame:
    """Keep the most frequent levels and call all rarer ones ``other``; no row is lost."""
    kept = (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col(column).isNotNull())
        .orderBy(F.desc("_n"), column)
        .limit(max_levels)
        .select(column, F.lit(True).alias("_kept"))
    )
    # max_levels rows: the bound of what is broadcast
    joined = df.join(F.broadcast(kept), column, "left")
    level = F.when(F.col("_kept") | F.col(column).isNull(), F.col(column)).otherwise(F.lit(other))
    return joined.withColumn(column, level).select(*df.columns)


def set_columns(df: DataFrame) -> list[str]:
    """The columns of joined names that a table has as text."""
    return [c for c in SETS if c in df.columns and isinstance(df.schema[c].dataType, StringType)]


def bound_levels(
    df: DataFrame, max_levels: int, key: str = KEY, sets: Iterable[str] = ()
) -> DataFrame:
    """Let each text column but the key and the sets keep its ``max_levels`` most frequent levels.

    An encoder's levels are part of the model and pass through the driver. Rarer ones become
    null, which an encoder that keeps unknown levels turns into all zeros, just as it does with
    levels that first occur at scoring.
    """
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType) and field.name not in (key, *sets):
            df = cap_levels(df, field.name, max_levels, other=None)
    return df


# -- rows -------------------------------------------------------------------------------------


def split(
    df: DataFrame,
    weights: Sequence[float] = (TRAIN_SHARE, 1 - TRAIN_SHARE),
    key: str | Iterable[str] = KEY,
    seed: int = SPLIT_SEED,
) -> list[DataFrame]:
    """Disjoint parts of about the given shares, chosen by the key's hash.

    All rows of a key go to the same part, and the choice does not change with the number of
    partitions, the order of the rows or a recomputation.
    """
    keys = [key] if isinstance(key, str) else list(key)
    bucket = key_bucket(*keys, buckets=HASH_BUCKETS, seed=seed)
    total, upto, parts = sum(weights), 0.0, []
    edges = [0]
    for w in weights:
        upto += w
        edges.append(round(HASH_BUCKETS * upto / total))
    for low, high in zip(edges, edges[1:]):
        parts.append(df.filter((bucket >= low) & (bucket < high)))
    return parts


def hash_sample(
    df: DataFrame, fraction: float, key: str | Iterable[str] = KEY, seed: int = 42
) -> DataFrame:
    """About ``fraction`` of the keys, with all their rows."""
    return split(df, [fraction, 1 - fraction], key, seed)[0]


def with_fold(df: DataFrame, folds: int, key: str = KEY, seed: int = SPLIT_SEED) -> DataFrame:
    """Number of the cross-validation fold of each row; a key has one fold."""
    return df.withColumn("fold", key_bucket(key, buckets=folds, seed=seed + 1))


def stage_for_training(
    df: DataFrame,
    partitions: int | None = None,
    durable: bool = True,
    path: str | None = None,
    spread: bool = True,
) -> DataFrame:
    """Spread rows evenly and keep them for the many passes of a training run.

    Rows go by the hash of all their plain columns: a key with very many rows does not fill one
    partition, and a recomputed row lands where it was. Without a number of partitions the
    session's setting holds and adaptive execution merges small ones; a fixed number such as
    TRAIN_PARTITIONS suits one size of data only.

    ``durable`` writes the rows once as Parquet to ``path``, by default a new one below the shared
    folder, so that a lost executor costs a read and not the joins behind them, and a pass reads
    only its columns. The caller owns that folder: ``session.remove`` deletes it, as does the end
    of a ``session.scratch`` block. Rows that a join by their key has spread already, such as the
    base table's, may go there as they lie (``spread`` off), which saves a shuffle. Without it, or with a number of partitions, the rows are
    persisted; call ``unpersist`` on the result when done.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, VectorUDT)]
    place = F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    if durable:
        spark = df.sparkSession
        path = path or scratch_path(spark, "staged")
        (df if partitions or not spread else df.repartition(place)).write.parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
        if not partitions:
            return df
    rows = df.repartition(partitions, place) if partitions else df.repartition(place)
    return rows.persist(StorageLevel.MEMORY_AND_DISK)
