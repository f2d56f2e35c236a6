"""Train on the base table and measure on held-out orders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame

from reviewlab.operators import encoding as en
from reviewlab.operators import models as md
from reviewlab.operators.evaluation import compare_models, evaluate
from reviewlab.session import remove, scratch_path


@dataclass
class Prepared:
    """Encoded rows of both sides, staged for many passes, and the fitted encoder.

    It owns the staged rows: ``release`` drops them, and with them what is still to be computed
    from ``train`` and ``test``. Models, reports and metrics stay.

    Only the unscaled vectors are ``kept``, which are most of what is held: a scaled one, which is
    one division an entry away, is computed by who reads it.
    """

    train: DataFrame
    test: DataFrame
    encoder: PipelineModel
    staged: str | None = None
    kept: Sequence[DataFrame] = field(default=(), repr=False)

    def release(self) -> None:
        for side in self.kept:
            side.unpersist()
        if self.staged is not None:
            remove(self.train.sparkSession, self.staged)


@dataclass
class Trained:
    model: Model
    metrics: DataFrame
    scored: DataFrame = field(repr=False)


def prepare(
    base: DataFrame,
    formula: str = en.FORMULA,
    key: str = en.KEY,
    folds: int = 3,
    handle_invalid: str = "keep",
    partitions: int | None = None,
    durable: bool = True,
    max_levels: int | None = None,
    spread: bool = False,
) -> Prepared:
    """Split by key, fit the encoder on the training side only, encode and stage both sides.

    Every level of a text column, and every name of a column of joined names, is encoded, unless
    the caller bounds them by ``max_levels``. ``spread`` is that of ``stage_for_training``: a
    base table lies spread by its joins.
    """
    staged = scratch_path(base.sparkSession, "staged") if durable else None
    base = en.stage_for_training(base, partitions, durable, staged, spread)
    train, test = en.split(base, key=key)
    sets = en.set_columns(base)
    if max_levels is not None:
        train = en.bound_levels(train, max_levels, key, sets)
    encoder = en.build_stages(formula, handle_invalid, sets=sets, max_levels=max_levels).fit(train)
    *first, scaling = encoder.stages
    vectors, columns = PipelineModel(first), [key, "features", "label"]
    kept_train = en.with_fold(vectors.transform(train).select(*columns), folds, key).persist()
    kept_test = vectors.transform(test).select(*columns).persist()
    kept_train.count()
    kept_test.count()
    base.unpersist()
    columns = [key, "features", "scaledFeatures", "label"]
    encoded_train = scaling.transform(kept_train).select(*columns, "fold")
    encoded_test = scaling.transform(kept_test).select(*columns)
    return Prepared(encoded_train, encoded_test, encoder, staged, (kept_train, kept_test))


def train_and_evaluate(data: Prepared, name: str, key: str = en.KEY, **params) -> Trained:
    """Fit one classifier (preset parameters unless overridden) and measure it on the test side."""
    model = md.fit(data.train, name, **params)
    scored = md.score(model, data.test, key)
    return Trained(model, evaluate(scored), scored)


def tune_and_evaluate(
    data: Prepared,
    name: str,
    values: dict[str, list] | None = None,
    folds: int | None = None,
    key: str = en.KEY,
    **fixed,
) -> tuple[CrossValidatorModel, Trained]:
    """Search the grid on the training side and measure the best model on the test side."""
    found = md.tune(data.train, name, values, folds, key=key, **fixed)
    scored = md.score(found.bestModel, data.test, key)
    return found, Trained(found.bestModel, evaluate(scored), scored)


def compare(data: Prepared, specs: dict[str, dict], key: str = en.KEY) -> DataFrame:
    """Train several classifiers on the same split: (model, metric, value)."""
    reports = {
        name: train_and_evaluate(data, name, key, **params).metrics
        for name, params in specs.items()
    }
    return compare_models(reports)
