"""Text columns that hold several names: one 1/0 entry per name instead of one level per set."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = ", "


def names_of(column: str | Column, separator: str = SEPARATOR) -> Column:
    """The distinct names of a joined text; none for a null or an empty text."""
    text = F.col(column) if isinstance(column, str) else column
    # the separator is plain text, not a pattern
    names = F.array_distinct(F.split(text, "\\Q" + separator + "\\E"))
    return F.coalesce(F.filter(names, lambda x: x != ""), F.array().cast("array<string>"))


def level_counts(df: DataFrame, column: str, separator: str = SEPARATOR) -> DataFrame:
    """(level, rows): in how many rows each name occurs; counted before the shuffle."""
    level = F.explode(names_of(column, separator)).alias("level")
    return df.select(level).groupBy("level").agg(F.count(F.lit(1)).alias("rows"))


class _SetParams(HasInputCol, HasOutputCol):
    separator = Param(Params._dummy(), "separator", "between names", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(separator=SEPARATOR)


class SetEncoder(Estimator, _SetParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the names of a column, the most frequent first (by name where equally frequent).

    The names are part of the model and pass through the driver; ``maxLevels`` bounds them (0: no
    bound), and rarer names are then encoded like names first seen at scoring: they have no entry.
    """

    maxLevels = Param(Params._dummy(), "maxLevels", "names kept, 0 for all", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, separator=SEPARATOR, maxLevels=0):
        super().__init__()
        self._setDefault(maxLevels=0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SetModel:
        separator = self.getOrDefault("separator")
        counts = level_counts(dataset, self.getInputCol(), separator)
        counts = counts.orderBy(F.desc("rows"), "level")
        if most := self.getOrDefault("maxLevels"):
            counts = counts.limit(most)
        levels = [r.level for r in counts.select("level").collect()]
        return SetModel(
            inputCol=self.getInputCol(),
            outputCol=self.getOutputCol(),
            separator=separator,
            levels=levels,
        )


class SetModel(Model, _SetParams, DefaultParamsReadable, DefaultParamsWritable):
    """A sparse 1/0 vector with an entry, named after it, for every known name."""

    levels = Param(Params._dummy(), "levels", "names in vector order", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, separator=SEPARATOR, levels=None):
        super().__init__()
        self._setDefault(levels=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, levels = self.getOutputCol(), self.getOrDefault("levels")
        names = names_of(self.getInputCol(), self.getOrDefault("separator"))
        attributes = [{"idx": i, "name": level} for i, level in enumerate(levels)]
        metadata = {"ml_attr": {"attrs": {"binary": attributes}, "num_attrs": len(levels)}}
        held = dataset.withColumn("_names", names)
        if not levels:
            return held.drop("_names", out)
        # the vocabulary's own vectorizer: sparse, and in the JVM
        flags = CountVectorizerModel.from_vocabulary(levels, inputCol="_names", outputCol="_flags")
        flags = flags.setBinary(True).setMinTF(1.0)
        coded = flags.transform(held).drop("_names", out)
        return coded.withColumn(out, F.col("_flags").alias(out, metadata=metadata)).drop("_flags")
