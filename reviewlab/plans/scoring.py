"""Fit on every labelled order, score the unlabelled ones, export."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.operators import encoding as en
from reviewlab.operators import models as md
from reviewlab.plans.base_table import build_base_table
from reviewlab.plans.state import FeatureState, load
from reviewlab.session import remove, scratch_path
from reviewlab.sources.tables import Tables, export_predictions


def fit_final(
    base: DataFrame,
    name: str = "gbt",
    formula: str = en.FORMULA,
    key: str = en.KEY,
    durable: bool = True,
    max_levels: int | None = None,
    spread: bool = True,
    **params,
) -> tuple[PipelineModel, Model]:
    """Fit encoder and classifier on all labelled rows.

    Unknown levels are kept, so that every order with complete features gets a prediction.
    """
    staged = scratch_path(base.sparkSession, "staged") if durable else None
    base = en.stage_for_training(base, durable=durable, path=staged, spread=spread)
    sets = en.set_columns(base)
    labelled = base if max_levels is None else en.bound_levels(base, max_levels, key, sets)
    encoder = en.build_stages(formula, "keep", sets=sets, max_levels=max_levels).fit(labelled)
    vector = params.get("features") or md.vector_of(name)
    encoded = encoder.transform(labelled).select(vector, "label").persist()
    model = md.fit(encoded, name, **params)
    encoded.unpersist()
    base.unpersist()
    if staged is not None:
        remove(encoded.sparkSession, staged)
    return encoder, model


def scoring_table(tables: Tables, state: FeatureState, **options) -> DataFrame:
    """The base table of orders without reviews, with the history the model was trained with."""
    if state is None:
        raise ValueError("scoring needs the feature state of the training orders")
    unlabelled = replace(tables, reviews=None)
    return build_base_table(unlabelled, state=state, **options)


def score_orders(
    encoder: PipelineModel, model: Model, base: DataFrame, key: str = en.KEY
) -> DataFrame:
    """(key, prediction, probability or margin) of every row the model can score."""
    return md.score(model, encoder.transform(base), key)


def unscored(orders: DataFrame, scored: DataFrame, key: str = en.KEY) -> DataFrame:
    """The orders asked for that got no prediction (incomplete features)."""
    return orders.select(key).distinct().join(scored.select(key), key, "left_anti")


def coverage(orders: DataFrame, scored: DataFrame, key: str = en.KEY) -> DataFrame:
    """Number of orders asked for, scored, and left without a prediction."""
    asked = orders.select(key).distinct()
    done = scored.select(key).distinct().withColumn("done", F.lit(True))
    return asked.join(done, key, "left").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("done").alias("scored"),
        F.count_if(F.col("done").isNull()).alias("unscored"),
    )


def score_and_export(
    encoder: PipelineModel, model: Model, base: DataFrame, path: str, key: str = en.KEY
) -> DataFrame:
    """Score, write (key, prediction) as CSV, return the scored rows."""
    scored = score_orders(encoder, model, base, key)
    export_predictions(scored, path, key)
    return scored


def save_model(
    encoder: PipelineModel, model: Model, path: str, state: FeatureState | None = None
) -> None:
    """Encoder and classifier as one saved model, with the feature state beside it."""
    PipelineModel(stages=[*encoder.stages, model]).write().overwrite().save(path)
    if state is not None:
        state.save(f"{path.rstrip('/')}-state")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_state(spark: SparkSession, path: str) -> FeatureState:
    """The feature state saved with a model."""
    return load(spark, f"{path.rstrip('/')}-state")
