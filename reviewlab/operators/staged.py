"""Grid search over tree models with one fit for all points that are parts of it.

A boosted model's first 15 rounds are the model of 15 rounds; a tree cut at depth 10 is the tree
grown to depth 10; the first 40 trees of a forest are a forest of 40 trees. So only the largest
point is fitted for every choice of the other parameters, and its smaller ones are scored from the
same trees. The points of a forest thus share their bootstrap samples; each is a forest drawn as
its parameters say.

On many rows the trees of a search are grown from binned rows (``operators.forest``), boosted ones
wherever all rows fit one task. Those that differ from Spark's plain ones, or are boosted on more rows, are fitted by
Spark, and scored from the fitted nodes as flat arrays, walked by numpy on Arrow batches: one pass
over the held-out rows gives the scores of all points of a fit.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.operators import forest
from reviewlab.session import remove, scratch_path, shared_folder

# A fit's rows are in partitions of at least so many: every level of every tree is a job of its own,
# and on little data the tasks' start is most of its time.
PARTITION_ROWS = 20_000
# Every partition sends the counts of all nodes it knows, so beyond the cores at hand more of them
# cost time and shuffle; one still holds no more rows than this.
MOST_ROWS = 2_000_000
# Up to so many rows a tree is walked again at every level rather than node numbers remembered.
WALKED_ROWS = 1_000_000
# Up to that many rows a forest is fitted as forests of so many trees, side by side.
PART_TREES = 10
# Every fit keeps its rows in a form of its own, and one on many rows has work for all cores, so fits
# that run at the same time have no more rows than this together, unless they are two.
SIDE_BY_SIDE_ROWS = 8_000_000
# Boosting cuts its lineage, which holds the trees so far, after so many rounds.
CUT_ROUNDS = 2

# A search on more rows than this grows its trees from binned rows. Equal splits are broken otherwise
# there, so trees that Spark fits in good time stay as they are; boosted ones it never does.
BINNED_FROM = {"gbt": 0, "rf": 20_000, "dt": WALKED_ROWS}

# The parameters whose smaller values are parts of the fit with the largest.
STAGED = {"dt": ("maxDepth",), "rf": ("maxDepth", "numTrees"), "gbt": ("maxIter",)}


@dataclass
class Trees:
    """All nodes of a model's trees, one tree after the other; a leaf has no children (-1).

    ``value`` is what a tree adds to the score of class 1 at a node, ``leading`` the class it
    predicts there; ``left_of`` has a row of categories for every split on one.
    """

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    category: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    value: np.ndarray
    leading: np.ndarray
    left_of: np.ndarray
    weight: np.ndarray

    def leaves(self, depth: int | None) -> np.ndarray:
        """The nodes at which a walk ends if trees stop at ``depth``.

        Two leaves that predict the same class are one, as in a fit to that depth.
        """
        ends = self.left < 0
        if depth is None:
            return ends
        ends = ends | (self.depth >= depth)
        for level in range(depth - 1, -1, -1):
            inner = np.flatnonzero((self.depth == level) & ~ends)
            a, b = self.left[inner], self.right[inner]
            ends[inner] = ends[a] & ends[b] & (self.leading[a] == self.leading[b])
        return ends

    def scores(self, x: np.ndarray, depths: Sequence, counts: Sequence) -> np.ndarray:
        """rows x (depth, count): the summed values of the first ``count`` trees cut at a depth."""
        out = np.empty((len(x), len(depths), len(counts)))
        rows = np.arange(len(x))
        for i, depth in enumerate(depths):
            ends, total = self.leaves(depth), np.zeros(len(x))
            for t, root in enumerate(self.root):
                node = np.full(len(x), root)
                going = rows[~ends[node]]
                while len(going):
                    at = node[going]
                    found = x[going, self.feature[at]]
                    kind = self.category[at]
                    goes_left = found <= self.threshold[at]
                    if (of := kind >= 0).any():
                        goes_left[of] = self.left_of[kind[of], found[of].astype(np.int64)]
                    node[going] = at = np.where(goes_left, self.left[at], self.right[at])
                    going = going[~ends[at]]
                total += self.weight[t] * self.value[node]
                for k in np.flatnonzero(np.asarray(counts) == t + 1):
                    out[:, i, k] = total
        return out


def trees(model: Model, spark) -> Trees:
    """The nodes of a fitted tree model, from the tables it is saved as."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    single = "nodeData" not in saved.columns
    node = "" if single else "nodeData."
    names = ["id", "prediction", "impurityStats", "leftChild", "rightChild", "split"]
    tree = F.lit(0).alias("tree") if single else F.col("treeID").alias("tree")
    rows = saved.select(tree, *(F.col(f"{node}{c}").alias(c) for c in names))
    rows = sorted(rows.collect(), key=lambda r: (r.tree, r.id))
    weight = getattr(model, "treeWeights", [1.0])
    root, base = [], np.zeros(len(rows), np.int64)
    for i, r in enumerate(rows):
        if r.id == 0:
            root.append(i)
        base[i] = root[-1]
    left = np.array([r.leftChild for r in rows], np.int64)
    right = np.array([r.rightChild for r in rows], np.int64)
    inner = left >= 0
    left, right = np.where(inner, left + base, -1), np.where(inner, right + base, -1)
    depth = np.zeros(len(rows), np.int64)
    for i in np.flatnonzero(inner):  # parents stand before their children
        depth[left[i]] = depth[right[i]] = depth[i] + 1
    categories = [r.split.numCategories if i else -1 for r, i in zip(rows, inner)]
    category, width = np.full(len(rows), -1, np.int64), max([*categories, 1])
    left_of = np.zeros((sum(c >= 0 for c in categories), width), bool)
    threshold = np.zeros(len(rows))
    for i, c in enumerate(categories):
        if c >= 0:
            category[i] = category[:i].max(initial=-1) + 1
            left_of[category[i], [int(v) for v in rows[i].split.leftCategoriesOrThreshold]] = True
        elif inner[i]:
            threshold[i] = rows[i].split.leftCategoriesOrThreshold[0]
    prediction = np.array([r.prediction for r in rows])
    boosted = hasattr(model, "evaluateEachIteration")
    if boosted:
        value = prediction
    elif single:  # a tree's raw prediction counts the rows of the leaf
        value = np.array([r.impurityStats[1] for r in rows])
    else:
        value = np.array([r.impurityStats[1] / max(sum(r.impurityStats), 1e-300) for r in rows])
    return Trees(
        root=np.array(root),
        feature=np.array([r.split.featureIndex if i else 0 for r, i in zip(rows, inner)], np.int64),
        threshold=threshold,
        category=category,
        left=left,
        right=right,
        depth=depth,
        value=value,
        leading=prediction,
        left_of=left_of,
        weight=np.array(weight if boosted else [1.0] * len(root)),
    )


def point_scores(found: Trees, features: Column, spark, depths: Sequence, counts: Sequence) -> Column:
    """An array column with the score of class 1 for every (depth, count)."""
    shared = spark.sparkContext.broadcast(found)

    @F.arrow_udf("array<double>")
    def scored(column: pa.Array) -> pa.Array:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        n = len(column)
        x = np.asarray(column.flatten()).reshape(n, -1) if n else np.zeros((0, 1))
        got = shared.value.scores(x, depths, counts).reshape(n, -1)
        offsets = np.arange(n + 1, dtype=np.int32) * got.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(got.ravel()))

    return scored(vector_to_array(features))


@dataclass
class Search:
    """What a cross-validated search found; the best point is fitted when it is asked for."""

    estimator: Estimator
    points: list[dict]
    avgMetrics: list[float]  # named as Spark's searches name it
    train: DataFrame = field(repr=False)

    def getEstimatorParamMaps(self) -> list[dict]:
        return self.points

    @cached_property
    def bestModel(self) -> Model:
        best = max(range(len(self.points)), key=self.avgMetrics.__getitem__)
        return fit_trees(self.estimator, self.train, self.points[best])


def tree_rows(train: DataFrame, rows: int | None = None, fits: int = 1) -> DataFrame:
    """The rows in as many partitions as a tree fit needs, one of several at the same time."""
    rows = train.count() if rows is None else rows
    cores = -(-train.sparkSession.sparkContext.defaultParallelism // fits)
    return train.coalesce(min(rows // PARTITION_ROWS, max(cores - 1, rows // MOST_ROWS)) + 1)


def side_by_side(parallelism: int, rows: int) -> int:
    """How many fits on so many rows run at the same time."""
    return min(parallelism, max(2, SIDE_BY_SIDE_ROWS // max(rows, 1)))


def fit_trees(
    estimator: Estimator, train: DataFrame, params: dict | None = None, rows: int | None = None
) -> Model:
    """A tree model fitted on few partitions, a large forest on little data in parts.

    Every partition sends the counts of every node, whose number grows with the trees, so on little
    data a forest's time is that of these counts and of waiting between its levels. Its trees are
    independent draws: forests of ``PART_TREES`` trees with seeds of their own, each on its share of
    the cores, are as good a draw of the same forest. On more rows it is grown from binned rows
    (``operators.forest``).
    """
    estimator, spark = estimator.copy(params or {}), train.sparkSession
    rows = train.count() if rows is None else rows
    count = estimator.getNumTrees() if isinstance(estimator, RandomForestClassifier) else 1
    if rows > WALKED_ROWS and count > 1 and forest.fits(estimator, train):
        return forest.fit_forest(estimator, train)
    parts = -(-count // PART_TREES) if rows <= WALKED_ROWS else 1
    if parts == 1:
        return estimator.fit(tree_rows(train, rows))
    seeds = random.Random(estimator.getSeed())
    draws = [
        {
            estimator.numTrees: count * (i + 1) // parts - count * i // parts,
            estimator.seed: seeds.getrandbits(62),
        }
        for i in range(parts)
    ]
    data = tree_rows(train, rows, parts)
    with ThreadPool(parts) as pool:
        fit = inheritable_thread_target(spark)(lambda draw: estimator.fit(data, draw))
        return joined_forest(estimator, pool.map(fit, draws, chunksize=1))


def joined_forest(
    estimator: RandomForestClassifier, forests: Sequence[RandomForestClassificationModel]
) -> RandomForestClassificationModel:
    """One forest of all trees of some, with the estimator's parameters."""
    context = SparkContext._active_spark_context
    kinds = context._jvm.org.apache.spark.ml.classification
    all_trees = [tree for part in forests for tree in part._java_obj.trees()]
    array = context._gateway.new_array(kinds.DecisionTreeClassificationModel, len(all_trees))
    for i, tree in enumerate(all_trees):
        array[i] = tree
    first = forests[0]
    joined = kinds.RandomForestClassificationModel(
        estimator.uid, array, first.numFeatures, first.numClasses
    )
    model = estimator._copyValues(RandomForestClassificationModel(joined))
    model._transfer_params_to_java()
    return model


def search(
    train: DataFrame,
    name: str,
    estimator: Estimator,
    values: dict[str, list],
    evaluator: BinaryClassificationEvaluator,
    folds: int,
    fold_column: str,
    parallelism: int,
) -> Search:
    """Cross-validated area under ROC of every point of a grid over a tree model.

    The fits of all folds run ``parallelism`` at a time, fewer on many rows.
    """
    spark, staged = train.sparkSession, STAGED[name]
    shared = {p: v for p, v in values.items() if p not in staged}
    depths = values.get("maxDepth", [None]) if "maxDepth" in staged else [None]
    count = "numTrees" if "numTrees" in staged else "maxIter" if "maxIter" in staged else None
    counts = values.get(count, [None]) if count else [1]
    if counts == [None]:
        counts = [estimator.getOrDefault(count)]
    fits = [dict(zip(shared, combo)) for combo in itertools.product(*shared.values())]
    features, rows = estimator.getFeaturesCol(), train.count()
    if rows <= WALKED_ROWS:
        estimator.setParams(cacheNodeIds=False)
    if name == "gbt":
        shared_folder(spark)
        estimator.setParams(checkpointInterval=CUT_ROUNDS)
    most = {"maxDepth": max(depths)} if depths != [None] else {}
    most |= {count: max(counts)} if count else {}

    def measured(scored: DataFrame) -> np.ndarray:
        """The area of every (depth, count) from the label and an array of scores."""
        found = [
            evaluator.evaluate(
                scored.select("label", F.get("scores", F.lit(k)).alias("rawPrediction")),
                {evaluator.rawPredictionCol: "rawPrediction"},
            )
            for k in range(len(depths) * len(counts))
        ]
        return np.array(found).reshape(len(depths), len(counts))

    def areas(fold: int, i: int) -> dict[int, np.ndarray]:
        params = {estimator.getParam(p): v for p, v in {**fits[i], **most}.items()}
        others = train.filter(F.col(fold_column) != fold)
        model = fit_trees(estimator, others, params, rows)
        held_out = train.filter(F.col(fold_column) == fold).select("label", features)
        scores = point_scores(trees(model, spark), F.col(features), spark, depths, counts)
        scored = held_out.select("label", scores.alias("scores")).persist()
        try:
            return {i: measured(scored)}
        finally:
            scored.unpersist()

    def grown(fold: int, some: Sequence[int]) -> dict[int, np.ndarray]:
        """The same of points with the same bins, whose trees are grown from binned rows."""
        own = [
            estimator.copy({estimator.getParam(p): v for p, v in {**fits[i], **most}.items()})
            for i in some
        ]
        used = F.col(fold_column) != fold
        data = forest.binned(train, features, own[0].getMaxBins(), used)
        path = scratch_path(spark, "scored")
        if name == "gbt":
            points = [(e.getMaxDepth(), e.getStepSize()) for e in own]
            scored = forest.boosted(data, points, counts)
        else:
            draw = forest.drawn(own[0], max(counts), len(data.bins.sizes))
            found = forest.fit(data, draw)
            share = name == "rf"
            scores = forest.point_scores(found, F.col(features), spark, depths, counts, share)
            held_out = train.filter(~used).select(F.lit(0).alias("fit"), "label", features)
            scored = held_out.select("fit", "label", scores.alias("scores"))
        scored.write.parquet(path)
        scored = spark.read.schema(scored.schema).parquet(path)
        areas = {i: measured(scored.filter(F.col("fit") == k)) for k, i in enumerate(some)}
        remove(spark, path)
        remove(spark, data.path)
        if name != "gbt":
            remove(spark, found.path)
        return areas

    fitting = rows <= forest.GROUP_ROWS if name == "gbt" else True
    if fitting and rows > BINNED_FROM[name] and forest.fits(estimator, train):
        # boosted points with the same bins share them
        bins = [fit.get("maxBins", estimator.getMaxBins()) for fit in fits]
        some = [[i for i in range(len(fits)) if bins[i] == b] for b in dict.fromkeys(bins)]
        if name != "gbt":
            some = [[i] for i in range(len(fits))]
        run, units = grown, [(fold, at) for fold in range(folds) for at in some]
        parallelism = side_by_side(parallelism, rows)
    else:
        run, units = areas, [(fold, i) for fold in range(folds) for i in range(len(fits))]
        units.sort(key=lambda u: -fits[u[1]].get("maxDepth", 0))
        parallelism = side_by_side(parallelism, rows)
    with ThreadPool(min(parallelism, len(units))) as pool:
        work = [pool.apply_async(inheritable_thread_target(spark)(run), u) for u in units]
        total = [np.zeros((len(depths), len(counts))) for _ in fits]
        for done in work:
            for i, area in done.get().items():
                total[i] = total[i] + area / folds
    points, metrics = [], []
    for combo in itertools.product(*values.values()):
        point = dict(zip(values, combo))
        fit = fits.index({p: point[p] for p in shared})
        d = depths.index(point["maxDepth"]) if "maxDepth" in staged and "maxDepth" in point else 0
        c = counts.index(point[count]) if count in point else 0
        points.append({estimator.getParam(p): v for p, v in point.items()})
        metrics.append(float(total[fit][d, c]))
    return Search(estimator, points, metrics, train)
