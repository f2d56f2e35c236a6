"""Chi-square selection of continuous entries: cut into bins first, then tested against the label.

The plain test takes every value as a category of its own, so a price has as many as there are
orders. Here every entry of a vector is cut into bins of equal width between its bounds, which
one pass learns; a 1/0 entry keeps its two values.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.stat import ChiSquareTest, Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.encoding import SELECTED_FEATURES, feature_names

BINS = 32
# Decimals by which two entries of equal strength are held equal, whatever the order of addition.
STRENGTH_DECIMALS = 6
# A statistic of 0 has no logarithm.
LEAST_STATISTIC = 1e-12


def bounds(df: DataFrame, column: str = "features") -> tuple[list[float], list[float]]:
    """The least and the greatest value of every entry, in one pass; none without rows."""
    if df.isEmpty():  # the summary refuses it
        return [], []
    found = Summarizer.metrics("min", "max").summary(F.col(column))
    row = df.select(found.alias("s")).select("s.*").head()
    return row["min"].tolist(), row["max"].tolist()


def binned(column: str, low: list[float], high: list[float], bins: int = BINS) -> Column:
    """The vector of bin numbers: 0 to ``bins`` - 1 between the bounds, 0 for a constant entry."""
    lows = F.array(*[F.lit(float(x)) for x in low])
    highs = F.array(*[F.lit(float(x)) for x in high])

    def place(x: Column, i: Column) -> Column:
        least, greatest = F.get(lows, i), F.get(highs, i)
        cut = F.floor((x - least) / (greatest - least) * F.lit(float(bins)))
        inside = F.least(cut, F.lit(bins - 1).cast("long")).cast("double")
        return F.when(greatest > least, inside).otherwise(F.lit(0.0))

    return array_to_vector(F.transform(vector_to_array(F.col(column)), place))


def strength(statistic: Column, freedom: Column) -> Column:
    """The statistic as a normal number: the signed root of the likelihood ratio against ``freedom``.

    Half its square is the tail's exponent, so it orders entries of different freedom as p-values
    do, also where these are all 0, as they are in a large table. Null without freedom: a constant
    entry tells nothing.
    """
    x = F.greatest(statistic, F.lit(LEAST_STATISTIC))
    ratio = x - freedom - freedom * F.ln(x / freedom)
    return F.when(freedom > 0, F.signum(x - freedom) * F.sqrt(F.greatest(ratio, F.lit(0.0))))


def binned_scores(
    df: DataFrame, column: str = "features", label: str = "label", bins: int = BINS
) -> DataFrame:
    """(place, feature, freedom, statistic, strength) of every entry, one row each."""
    low, high = bounds(df, column)
    if not low:
        schema = "place int, feature string, freedom int, statistic double, strength double"
        return df.sparkSession.createDataFrame([], schema)
    cut = df.select(F.col(label).cast("double").alias("label"), binned(column, low, high, bins).alias("bins"))
    names = F.array(*[F.lit(n) for n in feature_names(df, column)])
    found = ChiSquareTest.test(cut, "bins", "label", flatten=True)
    return found.select(
        F.col("featureIndex").alias("place"),
        F.get(names, F.col("featureIndex")).alias("feature"),
        F.col("degreesOfFreedom").alias("freedom"),
        "statistic",
        strength(F.col("statistic"), F.col("degreesOfFreedom")).alias("strength"),
    )


def strongest(scores: DataFrame, k: int = SELECTED_FEATURES) -> DataFrame:
    """The ``k`` entries with the strongest relation, equal ones by name; no constant entry."""
    rank = F.round("strength", STRENGTH_DECIMALS)
    return scores.filter("strength is not null").orderBy(F.desc(rank), "feature").limit(k)


class BinnedSelector(
    Estimator, HasInputCol, HasOutputCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Learns which entries to keep; the fitted stage is a plain slicer of the uncut vector."""

    numTopFeatures = Param(Params._dummy(), "numTopFeatures", "entries kept", TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "bins of an entry", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        inputCol="features",
        outputCol="selectedFeatures",
        labelCol="label",
        numTopFeatures=SELECTED_FEATURES,
        bins=BINS,
    ):
        super().__init__()
        self._setDefault(
            inputCol="features",
            outputCol="selectedFeatures",
            labelCol="label",
            numTopFeatures=SELECTED_FEATURES,
            bins=BINS,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        scores = binned_scores(
            dataset, self.getInputCol(), self.getLabelCol(), self.getOrDefault("bins")
        )
        kept = strongest(scores, self.getOrDefault("numTopFeatures")).select("place").collect()
        if not kept:
            raise ValueError("no entry differs between rows, so none can be selected")
        return VectorSlicer(
            inputCol=self.getInputCol(),
            outputCol=self.getOutputCol(),
            indices=sorted(r["place"] for r in kept),
        )
