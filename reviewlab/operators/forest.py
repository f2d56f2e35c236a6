"""Trees grown on binned rows, many at a time, with no node's counts sent twice.

Spark's fits count every level of a tree over all rows and send the counts of all its nodes, so deep
trees cost a job and a growing shuffle a level, and their nodes are objects on the driver. Here

* every entry is cut into bins once, at the thresholds that Spark would take if it saw all rows, and
  the binned rows are written in blocks;
* nodes of more than ``GROUP_ROWS`` rows are split from counts that tasks make over the blocks and
  that are added up and decided where a node's counts meet; the driver sees the splits;
* the rows of every smaller node are brought to one task, which grows the rest of its subtree level
  by level in numpy: nodes with many rows from dense counts, small ones from sorted bins;
* finished subtrees are written, and read one tree at a time where rows are scored.

Splits, stopping and the merging of leaves that predict the same are Spark's: with all rows and all
features the tree is the one Spark fits, but for the choice among equal splits of few rows. A forest draws its rows (Poisson counts from a block's and
a tree's number) and the features of a node as its seed says: the same blocks give the same forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    RandomForestClassifier,
    _ProbabilisticClassifierParams,
    _RandomForestClassifierParams,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.session import remove, scratch_path, shipped

# A node of no more rows than this is finished in one task (some 50 bytes a row and feature set).
GROUP_ROWS = 1_000_000
BLOCK_ROWS = 1 << 16
# A table of values and counts with more values than this is thinned to a quarter of them.
VALUES = 16_384
# Nodes with fewer rows than a bin count's share of this are split from sorted bins.
DENSE_SHARE = 4
# Rows of nodes whose splits are sought together.
CACHED_ROWS = 1 << 16
# Rows scored at a time by one task, for every reading of the trees.
SCORED_ROWS = 250_000

SUMMARY = "feature int, value binary, n binary"
BLOCK = "block long, n int, bins binary, y binary, used binary"
COUNTS = "tree int, node int, counts binary"
SPLIT = "tree int, node int, feature int, cut int, gain double, n double, s double, ln double, ls double"
PIECE = "tree int, node int, n int, rows binary"
SUBTREE = (
    "tree int, node int, size int, feature binary, cut binary, left binary, n binary, s binary, "
    "importance binary"
)
# Counts and sums of integers are added up as one number, so many bits apart.
APART = float(1 << 26)
# Poisson(1) by the 16 bits of a draw: the number of the cumulative shares that it passes.
_POISSON = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), np.arange(65536) / 65536, "right"
).astype(np.uint8)


# -- bins ---------------------------------------------------------------------------------------


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return np.asarray(column.flatten()).reshape(len(column), -1)


def merged(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and their counts."""
    found, at = np.unique(values, return_inverse=True)
    return found, np.bincount(at, n, len(found))


def thinned(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most a quarter of ``VALUES`` of very many values, at even steps of the summed counts."""
    if len(values) <= VALUES:
        return values, n
    total = np.cumsum(n)
    marks = np.linspace(0, total[-1], VALUES // 4 + 1)[1:]
    kept = np.unique(np.minimum(np.searchsorted(total, marks), len(values) - 1))
    return values[kept], np.diff(total[kept], prepend=0)


def cuts(values: np.ndarray, n: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds: between all values, or at even steps of the rows.

    This is what Spark takes: a threshold is put where the rows below come nearest to the next step.
    """
    if len(values) - 1 <= most:
        return (values[:-1] + values[1:]) / 2
    step, below, found = n.sum() / (most + 1), np.cumsum(n), []
    target = step
    for i in range(1, len(values)):
        if abs(below[i - 1] - target) < abs(below[i] - target):
            found.append((values[i - 1] + values[i]) / 2)
            target += step
    return np.array(found)


def thresholds(rows: DataFrame, features: str, max_bins: int) -> list[np.ndarray]:
    """Per entry of the vector its thresholds, from all rows."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            x = matrix(batch.column(0))
            if not len(x):
                continue
            if not held:
                held = [(np.zeros(0), np.zeros(0))] * x.shape[1]
            for f, (v, n) in enumerate(held):
                both = np.concatenate([v, x[:, f]]), np.concatenate([n, np.ones(len(x))])
                held[f] = thinned(*merged(*both))
        yield table(SUMMARY, [(f, v.tobytes(), n.tobytes()) for f, (v, n) in enumerate(held)])

    def decide(group: pa.Table) -> pa.Table:
        v = np.concatenate([np.frombuffer(b) for b in group["value"].to_pylist()])
        n = np.concatenate([np.frombuffer(b) for b in group["n"].to_pylist()])
        found = cuts(*merged(v, n), max_bins - 1)
        f = group["feature"][0].as_py()
        return pa.Table.from_batches([table(SUMMARY, [(f, found.tobytes(), b"")])])

    x = shipped(rows).select(vector_to_array(features).alias("x"))
    found = x.mapInArrow(summary, SUMMARY).groupBy("feature").applyInArrow(decide, SUMMARY).collect()
    return [np.frombuffer(r.value) for r in sorted(found, key=lambda r: r.feature)]


def table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """An Arrow batch of rows, by a schema of Spark's simple names."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    arrow = pa.schema([(name, kinds[kind]) for name, kind in fields])
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
    )


@dataclass
class Bins:
    """Thresholds per entry, and how a binned row is packed to be moved."""

    thresholds: list[np.ndarray]
    flags: Sequence[int] = ()  # the entries that are 1/0 by the vector's metadata

    def __post_init__(self) -> None:
        self.flag = np.isin(np.arange(len(self.thresholds)), self.flags)
        self.sizes = np.array([len(t) + 1 for t in self.thresholds], np.int64)
        self.width = int(self.sizes.max(initial=1))
        self.kind = np.dtype(np.uint8 if self.width <= 256 else np.uint16)
        self.two = np.flatnonzero(self.sizes <= 2)
        self.more = np.flatnonzero(self.sizes > 2)

    def of(self, x: np.ndarray) -> np.ndarray:
        """rows x entries: the number of the bin; a value at a threshold lies below it."""
        out = np.empty(x.shape, self.kind)
        for f, t in enumerate(self.thresholds):
            out[:, f] = np.searchsorted(t, x[:, f], "left")
        return out

    def pack(self, x: np.ndarray) -> np.ndarray:
        """Entries of two bins as bits: the bytes of each row."""
        more = np.ascontiguousarray(x[:, self.more]).view(np.uint8)
        return np.concatenate([np.packbits(x[:, self.two].astype(bool), axis=1), more], axis=1)

    def unpack(self, raw: np.ndarray) -> np.ndarray:
        bits = -(-len(self.two) // 8)
        x = np.empty((len(raw), len(self.sizes)), self.kind)
        x[:, self.two] = np.unpackbits(raw[:, :bits], axis=1, count=len(self.two))
        x[:, self.more] = np.ascontiguousarray(raw[:, bits:]).view(self.kind)
        return x


@dataclass
class Binned:
    """Blocks of binned rows below the shared folder; rows not ``used`` are held out."""

    blocks: DataFrame = field(repr=False)
    bins: Bins
    path: str
    rows: int


def binned(
    rows: DataFrame, features: str, max_bins: int, used: Column | None = None, label: str = "label"
) -> Binned:
    """Cut all rows at thresholds of the used ones and write them in blocks."""
    spark = rows.sparkSession
    used = F.lit(True) if used is None else used
    attributes = rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    flags = [a["idx"] for a in attributes.get("binary", ())]
    bins = Bins(thresholds(rows.filter(used), features, max_bins), flags)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, size, number = TaskContext.get().partitionId() << 32, [], 0, 0

        def block():
            x, y, u = (np.concatenate(part) for part in zip(*held))
            return table(BLOCK, [(first + number, len(x), x.tobytes(), y.tobytes(), u.tobytes())])

        for batch in batches:
            if not batch.num_rows:
                continue
            y, u = (np.asarray(batch.column(i)).astype(np.uint8) for i in (1, 2))
            held.append((bins.of(matrix(batch.column(0))), y, u))
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block()
                held, size, number = [], 0, number + 1
        if held:
            yield block()

    path = scratch_path(spark, "bins")
    x = vector_to_array(features).alias("x")
    columns = x, F.col(label).cast("int"), used.cast("int").alias("used")
    rows.select(*columns).mapInArrow(write, BLOCK).write.parquet(path)
    blocks = spark.read.schema(BLOCK).parquet(path)
    count = rows.filter(used).count()
    return Binned(blocks, bins, path, count)


# -- one subtree in numpy -------------------------------------------------------------------------


@dataclass
class Grown:
    """Nodes level by level; the right child stands behind the left one, a leaf has none (-1)."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    n: np.ndarray
    s: np.ndarray
    gain: np.ndarray


def gini(n, s):
    zeros, ones = (n - s) / n, s / n
    return 1.0 - zeros * zeros - ones * ones


def gains(n, s, ln, ls, variance: bool):
    """What a split takes from the impurity, Gini or variance; nothing where a side is empty."""
    rn, rs = n - ln, s - ls
    with np.errstate(divide="ignore", invalid="ignore"):
        if variance:
            gain = (ls * ls / ln + rs * rs / rn - s * s / n) / n
        else:
            gain = gini(n, s) - ln / n * gini(ln, ls) - rn / n * gini(rn, rs)
    return np.where((ln > 0) & (rn > 0), gain, -np.inf)


def flag_gains(n, s, ln, ls, variance: bool):
    """The same of a 1/0 entry, whose value with fewer ones among its labels is on the left.

    That is how Spark orders two categories; equal splits differ in their last digits by it.
    """
    turn = ls > s - ls
    return gains(n, s, np.where(turn, n - ln, ln), np.where(turn, s - ls, ls), variance)


def parted(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counts and the sums of what was added up as one number."""
    n = np.floor(both / APART)
    return n, both - n * APART


def draw_features(rng: np.random.Generator | None, nodes: int, count: int, subset: int) -> np.ndarray:
    """nodes x subset: the features each node may split on, in order."""
    if subset >= count:
        return np.broadcast_to(np.arange(count), (nodes, count))
    return np.sort(np.argpartition(rng.random((nodes, count)), subset, axis=1)[:, :subset], axis=1)


@dataclass
class Level:
    """The rows of some nodes, those of a node side by side, and the nodes' sums."""

    x: np.ndarray
    w: np.ndarray | None  # None where every row counts once, as it does for the variance
    s: np.ndarray
    spans: np.ndarray
    n_at: np.ndarray
    s_at: np.ndarray
    variance: bool

    def __post_init__(self) -> None:
        self.node = np.repeat(np.arange(len(self.spans)), self.spans)
        self.starts = np.cumsum(self.spans) - self.spans
        if not self.variance:
            self.both = self.s + (APART if self.w is None else self.w * APART)

    def of(self, nodes: np.ndarray) -> Level:
        if len(nodes) == len(self.spans):
            return self
        if nodes[-1] - nodes[0] == len(nodes) - 1:  # they stand side by side
            rows = slice(self.starts[nodes[0]], self.starts[nodes[-1]] + self.spans[nodes[-1]])
        else:
            asked = np.zeros(len(self.spans), bool)
            asked[nodes] = True
            rows = np.flatnonzero(np.repeat(asked, self.spans))
        w = None if self.w is None else self.w[rows]
        its = self.spans[nodes], self.n_at[nodes], self.s_at[nodes]
        return Level(self.x[rows], w, self.s[rows], *its, self.variance)

    def two(self, x: np.ndarray, flag: bool):
        """Per node the gain and the cut of an entry of two bins."""
        zero = x == 0
        if self.variance:
            ln = np.add.reduceat(zero.astype(np.float64), self.starts)
            ls = np.add.reduceat(np.where(zero, self.s, 0.0), self.starts)
        else:
            ln, ls = parted(np.add.reduceat(np.where(zero, self.both, 0.0), self.starts))
        found = flag_gains if flag else gains
        gain = found(self.n_at, self.s_at, ln, ls, self.variance)
        return gain, np.zeros(len(ln), np.int64)

    def dense(self, x: np.ndarray, width: int):
        """The same of any entry, from the counts of all bins."""
        m = len(self.spans)
        key = self.node * width + x

        def below(v: np.ndarray | None) -> np.ndarray:
            cells = np.bincount(key, v, m * width).reshape(m, width)
            return np.cumsum(cells, axis=1)[:, :-1].astype(np.float64, copy=False)

        ln, ls = (below(None), below(self.s)) if self.variance else parted(below(self.both))
        gain = gains(self.n_at[:, None], self.s_at[:, None], ln, ls, self.variance)
        # a cut behind an empty bin is the one before it
        at = gain.argmax(axis=1)
        return gain[np.arange(m), at], at

    def sparse(self, x: np.ndarray, width: int):
        """The same from the rows' sorted bins, for nodes with few of them."""
        m, shift = len(self.spans), max(len(x) - 1, 1).bit_length()
        key = (self.node * width + x) << shift | np.arange(len(x))
        key.sort()
        at, cell = key & ((1 << shift) - 1), key >> shift
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        owner = self.node[at[first]]
        begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sizes = np.diff(np.append(begins, len(owner)))

        def below(sums: np.ndarray) -> np.ndarray:
            total = np.cumsum(sums)
            return total - np.repeat(np.concatenate([[0.0], total])[begins], sizes)

        if self.variance:
            ln = below(np.diff(np.append(first, len(at))).astype(np.float64))
            ls = below(np.add.reduceat(self.s[at], first))
        else:
            ln, ls = parted(below(np.add.reduceat(self.both[at], first)))
        gain = gains(self.n_at[owner], self.s_at[owner], ln, ls, self.variance)
        gain[begins + sizes - 1] = -np.inf  # nothing is on the right
        best = np.maximum.reduceat(gain, begins)
        top = np.flatnonzero(gain == np.repeat(best, sizes))
        where = np.zeros(m, np.int64)
        where[owner[top][::-1]] = top[::-1]  # the first of equal ones
        return best, cell[first][where] % width

    def best(self, asked: np.ndarray, bins: Bins):
        """(gain, feature, cut) of every node's best split on the features asked for it."""
        m, count, sizes = len(self.spans), len(bins.sizes), bins.sizes
        best, feature, cut = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64)

        def take(who, f, gain, at) -> None:
            # of equal ones that of the first feature
            better = (gain > best[who]) | ((gain == best[who]) & (f < feature[who]) & (gain > 0))
            to = who[better]
            best[to], feature[to], cut[to] = gain[better], f[better], at[better]

        def by_size(width: int):
            big = self.spans * DENSE_SHARE >= width
            for who, way in ((big, "dense"), (~big, "sparse")):
                who = np.flatnonzero(who)
                if not len(who):
                    continue
                part = self.of(who)
                # a few nodes at a time, so that their rows stay in the processor's cache
                cuts = np.flatnonzero(np.diff(part.starts // CACHED_ROWS)) + 1
                for some in np.split(np.arange(len(who)), cuts):
                    yield who[some], part.of(some), way

        if asked.shape[1] == count:
            every = np.arange(m)
            for j in np.flatnonzero(sizes == 2):
                take(every, np.full(m, j), *self.two(self.x[:, j], bins.flag[j]))
            for width in np.unique(sizes[sizes > 2]):
                for who, part, way in by_size(int(width)):
                    for j in np.flatnonzero(sizes == width):
                        found = getattr(part, way)(part.x[:, j].astype(np.int64), int(width))
                        take(who, np.full(len(who), j), *found)
            return best, feature, cut
        width = int(sizes.max(initial=1))
        for who, part, way in by_size(width):
            flat, place = part.x.reshape(-1), np.arange(len(part.x)) * count
            for j in range(asked.shape[1]):
                f = asked[who, j]
                values = flat[place + f[part.node]].astype(np.int64)
                take(who, f, *getattr(part, way)(values, width))
        return best, feature, cut


def grow(
    x: np.ndarray,
    w: np.ndarray | None,
    y: np.ndarray,
    bins: Bins,
    depth: int,
    subset: int | None = None,
    rng: np.random.Generator | None = None,
    variance: bool = False,
) -> Grown:
    """A tree on binned rows of some weight, split to ``depth`` by Gini, or by the variance."""
    count = len(bins.sizes)
    if w is not None and not (held := w > 0).all():
        x, w, y = x[held], w[held], y[held]
    y = y.astype(np.float64)
    w = None if w is None else w.astype(np.float64)
    s, nodes, total = y if w is None else w * y, [], 1
    spans = np.array([len(x)])
    n_at, s_at = np.array([len(x) if w is None else w.sum()], np.float64), np.array([s.sum()])
    alive = np.array([len(x) > 0 and y.min() != y.max()])
    for level in range(depth + 1):
        m = len(n_at)
        feature, cut = np.full(m, -1, np.int16), np.zeros(m, np.uint16)
        left, gained = np.full(m, -1, np.int32), np.zeros(m)
        nodes.append([feature, cut, left, n_at, s_at, gained])
        going = np.flatnonzero(alive)
        if level == depth or not len(going):
            break

        def only(kept: np.ndarray, spans: np.ndarray):
            """The rows of some nodes; finished nodes leave with theirs."""
            if kept.all():
                return x, w, y, s
            rows = np.flatnonzero(np.repeat(kept, spans))
            return x[rows], None if w is None else w[rows], y[rows], s[rows]

        (x, w, y, s), spans = only(alive, spans), spans[going]
        held = Level(x, w, s, spans, n_at[going], s_at[going], variance)
        asked = draw_features(rng, len(going), count, count if subset is None else subset)
        best, best_f, best_cut = held.best(asked, bins)
        good = best > 0
        done = going[good]
        feature[done], cut[done], gained[done] = best_f[good], best_cut[good], best[good]
        left[done] = total + 2 * np.arange(len(done))
        total += 2 * len(done)
        if not len(done):
            break
        (x, w, y, s), spans = only(good, spans), spans[good]
        node = np.repeat(np.arange(len(done)), spans)
        entry = x.reshape(-1)[np.arange(len(x)) * count + best_f[good][node]]
        child = 2 * node + (entry > best_cut[good][node])
        order = np.argsort(child, kind="stable")
        x, y, s = x[order], y[order], s[order]
        w = None if w is None else w[order]
        spans = np.bincount(child, minlength=2 * len(done))
        starts = np.cumsum(spans) - spans
        n_at = spans.astype(np.float64) if w is None else np.add.reduceat(w, starts)
        s_at = np.add.reduceat(s, starts)
        alive = np.minimum.reduceat(y, starts) != np.maximum.reduceat(y, starts)
    found = Grown(*(np.concatenate(part) for part in zip(*nodes)))
    return found if variance else pruned(found, np.cumsum([0, *(len(p[0]) for p in nodes)]))


def leading(n: np.ndarray, s: np.ndarray) -> np.ndarray:
    return s > n - s


def pruned(tree: Grown, levels: np.ndarray) -> Grown:
    """Two leaves that predict the same class become one."""
    left, says = tree.left.copy(), leading(tree.n, tree.s)
    gone = np.zeros(len(left), bool)
    for a, b in zip(levels[-2::-1], levels[:0:-1]):
        inner = a + np.flatnonzero(left[a:b] >= 0)
        l = left[inner]
        same = (left[l] < 0) & (left[l + 1] < 0) & (says[l] == says[l + 1])
        gone[l[same]] = gone[l[same] + 1] = True
        left[inner[same]] = -1
    kept = ~gone
    place = np.cumsum(kept) - 1
    left = np.where(left >= 0, place[np.maximum(left, 0)], -1).astype(np.int32)[kept]
    leaf = left < 0
    out = [v[kept] for v in (tree.feature, tree.cut, tree.n, tree.s, tree.gain)]
    feature, cut, n, s, gain = out
    return Grown(np.where(leaf, -1, feature), cut, left, n, s, np.where(leaf, 0.0, gain))


def walk(tree: Grown, x: np.ndarray, stops: Sequence[int] = ()) -> Iterator[np.ndarray]:
    """The node of every binned row after so many steps each, and at its leaf at last."""
    leaf = tree.left < 0
    feature = np.where(leaf, 0, tree.feature).astype(np.int64)
    # one word a node: a leaf leads to itself, whatever the row
    word = np.where(leaf, np.arange(len(leaf)), tree.left).astype(np.int64) << 32 | feature << 16
    word |= np.where(leaf, 0xFFFF, tree.cut).astype(np.int64)
    flat, place = x.reshape(-1), np.arange(len(x)) * x.shape[1]
    node, step, stops = np.zeros(len(x), np.int64), 0, list(stops)
    while True:
        while stops and stops[0] == step:
            yield node
            stops.pop(0)
        at = word[node]
        after = (at >> 32) + (flat[place + ((at >> 16) & 0xFFFF)] > (at & 0xFFFF))
        if np.array_equal(after, node):
            break
        node, step = after, step + 1
    for _ in stops:
        yield node
    yield node


def leaf_of(tree: Grown, x: np.ndarray) -> np.ndarray:
    return next(walk(tree, x))


def cut_values(tree: Grown, depth: int | None, value: np.ndarray) -> np.ndarray:
    """Per node what the tree cut at a depth says of a row that is there after so many steps.

    Two leaves that predict the same class are one, as in a fit to that depth.
    """
    if depth is None:
        return value
    levels = [np.zeros(1, np.int64)]
    while len(levels) <= depth and len(inner := levels[-1][tree.left[levels[-1]] >= 0]):
        levels.append(np.concatenate([tree.left[inner], tree.left[inner] + 1]))
    ends, says, value = tree.left < 0, leading(tree.n, tree.s), value.copy()
    if len(levels) > depth:
        ends[levels[depth]] = True
    inners = [at[~ends[at]] for at in levels]
    for at in inners[::-1]:
        l = tree.left[at]
        ends[at] = ends[l] & ends[l + 1] & (says[l] == says[l + 1])
    for at in inners:
        done = at[ends[at]]
        for child in (tree.left[done], tree.left[done] + 1):
            value[child], ends[child] = value[done], True
    return value


# -- many trees on blocks ---------------------------------------------------------------------------


@dataclass
class Draw:
    """What the trees of a fit have in common."""

    count: int
    depth: int
    subset: int
    bootstrap: bool
    seed: int

    def weights(self, tree: int, block: int, used: np.ndarray) -> np.ndarray:
        if not self.bootstrap:
            return used
        draws = self.rng(tree, 0, block).integers(0, 65536, len(used), np.uint16)
        return _POISSON[draws] * used

    def rng(self, tree: int, step: int, place: int) -> np.random.Generator:
        return np.random.Generator(np.random.SFC64([self.seed & (1 << 64) - 1, tree, step, place]))

    def features(self, tree: int, node: int, count: int) -> np.ndarray:
        return draw_features(self.rng(tree, 1, node), 1, count, self.subset)[0]


LEAF, OPEN, GROUP = range(3)


class Top:
    """The nodes of a tree that the driver knows: leaves, open ones, and roots of subtrees."""

    def __init__(self, state: int):
        self.rows = [[-1, 0, -1, 0.0, 0.0, 0.0]]
        self.state, self.depth = [state], [0]

    def split(self, node: int, feature: int, cut: int, gain: float, sides: list) -> None:
        self.rows[node][:3], self.rows[node][5] = [feature, cut, len(self.rows)], gain
        for n, s, state in sides:
            self.rows.append([-1, 0, -1, n, s, 0.0])
            self.state.append(state)
            self.depth.append(self.depth[node] + 1)
        self.state[node] = LEAF

    def tree(self) -> Grown:
        kinds = np.int16, np.uint16, np.int32, np.float64, np.float64, np.float64
        return Grown(*(np.array(v, kind) for v, kind in zip(zip(*self.rows), kinds)))

    def of(self, state: int) -> np.ndarray:
        return np.flatnonzero(np.array(self.state) == state)

    def prune(self) -> None:
        """Merge leaves that predict the same, from the last node up."""
        for row in self.rows[::-1]:
            if (l := row[2]) >= 0 and self.state[l] == self.state[l + 1] == LEAF:
                a, b = self.rows[l], self.rows[l + 1]
                if a[2] < 0 and b[2] < 0 and (a[4] > a[3] - a[4]) == (b[4] > b[3] - b[4]):
                    row[:3], row[5] = [-1, 0, -1], 0.0


def block_rows(batches: Iterator[pa.RecordBatch], bins: Bins) -> Iterator[tuple]:
    """(block, bins, label, used) of the blocks of a task."""
    for batch in batches:
        for row in batch.to_pylist():
            x = np.frombuffer(row["bins"], bins.kind).reshape(row["n"], -1)
            y, used = (np.frombuffer(row[c], np.uint8) for c in ("y", "used"))
            yield row["block"], x, y, used


@dataclass
class Forest:
    """Fitted trees: their tops, and the folder with the rest of each."""

    bins: Bins
    draw: Draw
    tops: list[Grown]
    hung: list[np.ndarray]
    path: str
    importances: np.ndarray

    def tree(self, t: int) -> Grown:
        """One whole tree, read from where it was written."""
        top, hung = self.tops[t], self.hung[t]
        if not len(hung):
            return top
        found = {}
        files, folder = pa.fs.FileSystem.from_uri(self.path)
        for row in pq.read_table(f"{folder}/tree={t}", filesystem=files).to_pylist():
            kinds = np.int16, np.uint16, np.int32, np.float64, np.float64
            names = "feature", "cut", "left", "n", "s"
            found[row["node"]] = [np.frombuffer(row[c], k) for c, k in zip(names, kinds)]
        parts = [[v.copy() for v in (top.feature, top.cut, top.left, top.n, top.s)]]
        size = len(top.left)
        for node in hung:
            sub = found[node]
            left = np.where(sub[2] >= 0, sub[2] + size - 1, -1)  # its root stands in the top
            for own, v in zip(parts[0], (sub[0], sub[1], left, sub[3], sub[4])):
                own[node] = v[0]
            parts.append([sub[0][1:], sub[1][1:], left[1:], sub[3][1:], sub[4][1:]])
            size += len(left) - 1
        feature, cut, left, n, s = (np.concatenate(v) for v in zip(*parts))
        return Grown(feature, cut, left.astype(np.int32), n, s, np.zeros(len(n)))

    def scores(self, x: np.ndarray, depths: Sequence, counts: Sequence, share: bool) -> np.ndarray:
        """rows x (depth, count): the summed scores of class 1 of the first trees cut at a depth."""
        out = np.empty((len(x), len(depths), len(counts)))
        total = np.zeros((len(depths), len(x)))
        stops = sorted({d for d in depths if d is not None})
        for t in range(max(counts)):
            tree = self.tree(t)
            value = tree.s / tree.n if share else tree.s
            at = dict(zip([*stops, None], walk(tree, x, stops)))
            for i, depth in enumerate(depths):
                total[i] += cut_values(tree, depth, value)[at[depth]]
            for k in np.flatnonzero(np.asarray(counts) == t + 1):
                out[:, :, k] = total.T
        return out


def point_scores(
    forest: Forest, features: Column, spark, depths: Sequence, counts: Sequence, share: bool = True
) -> Column:
    """An array column with the score of class 1 for every (depth, count)."""
    shared = spark.sparkContext.broadcast(forest)

    @F.arrow_udf("array<double>")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found, held, size = shared.value, [], 0

        def done() -> Iterator[pa.Array]:
            got = found.scores(np.concatenate(held), depths, counts, share)
            got = got.reshape(len(got), -1)
            for part in np.split(got, np.cumsum([len(x) for x in held])[:-1]):
                offsets = np.arange(len(part) + 1, dtype=np.int32) * part.shape[1]
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(part.ravel()))

        for column in columns:
            x = matrix(column) if len(column) else np.zeros((0, len(found.bins.sizes)))
            held.append(found.bins.of(x))
            size += len(x)
            if size >= SCORED_ROWS:
                yield from done()
                held, size = [], 0
        if held:
            yield from done()

    shipped(spark.range(0))
    return scored(vector_to_array(features))


def fit(data: Binned, draw: Draw) -> Forest:
    """All trees of a forest, or of one draw with all rows and features a single tree."""
    spark, bins = data.blocks.sparkSession, data.bins
    state = GROUP if data.rows <= GROUP_ROWS else OPEN
    tops = [Top(state) for _ in range(draw.count)]
    while any(OPEN in top.state for top in tops):
        for r in split_open(data, draw, tops):
            top, deep = tops[r.tree], tops[r.tree].depth[r.node] + 1 == draw.depth
            top.rows[r.node][3:5] = r.n, r.s
            if not r.gain > 0:
                top.state[r.node] = LEAF
                continue
            sides = []
            for n, s in ((r.ln, r.ls), (r.n - r.ln, r.s - r.ls)):
                kind = LEAF if deep or s in (0, n) else OPEN if n > GROUP_ROWS else GROUP
                sides.append((n, s, kind))
            top.split(r.node, r.feature, r.cut, r.gain, sides)
    path = scratch_path(spark, "forest")
    subtrees(data, draw, tops).write.partitionBy("tree").parquet(path)
    found = subtrees_at(spark, path)
    importances = np.zeros((draw.count, len(bins.sizes)))
    hung = [top.of(GROUP) for top in tops]
    whole = found.filter("size = 1").select("tree", "node", "n", "s")
    for r in whole.collect():  # a subtree of one node is a leaf
        tops[r.tree].rows[r.node][3:5] = np.frombuffer(r.n)[0], np.frombuffer(r.s)[0]
        tops[r.tree].state[r.node] = LEAF
    for r in found.select("tree", "importance").collect():
        importances[r.tree] += np.frombuffer(r.importance)
    for top in tops:
        top.prune()
    trees = [top.tree() for top in tops]
    for i, tree in enumerate(trees):
        inner = tree.left >= 0
        np.add.at(importances[i], tree.feature[inner], tree.gain[inner] * tree.n[inner])
    sums = importances.sum(axis=1, keepdims=True)
    mean = np.divide(importances, sums, out=np.zeros_like(importances), where=sums > 0).sum(axis=0)
    hung = [at[np.isin(at, reached(tree))] for at, tree in zip(hung, trees)]
    return Forest(bins, draw, trees, hung, path, mean / mean.sum() if mean.sum() > 0 else mean)


def subtrees_at(spark, path: str) -> DataFrame:
    tree, *others = SUBTREE.split(", ")
    return spark.read.schema(", ".join([*others, tree])).parquet(path)


def reached(tree: Grown) -> np.ndarray:
    """The nodes that a merge has not cut off."""
    found = [np.zeros(1, np.int64)]
    while len(inner := found[-1][tree.left[found[-1]] >= 0]):
        found.append(np.concatenate([tree.left[inner], tree.left[inner] + 1]))
    return np.concatenate(found)


def split_open(data: Binned, draw: Draw, tops: list[Top]) -> list:
    """The best split of every open node, from its counts over all blocks."""
    spark, bins, width = data.blocks.sparkSession, data.bins, data.bins.width
    count = len(bins.sizes)
    known = {}
    for t, top in enumerate(tops):
        if len(nodes := top.of(OPEN)):
            asked = np.array([draw.features(t, node, count) for node in nodes])
            known[t] = top.tree(), nodes, asked
    shared = spark.sparkContext.broadcast(known)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for block, x, y, used in block_rows(batches, bins):
            for t, (tree, nodes, asked) in shared.value.items():
                w = draw.weights(t, block, used)
                place = np.full(len(tree.left), -1)
                place[nodes] = np.arange(len(nodes))
                rows = np.flatnonzero(w)
                at = place[leaf_of(tree, x[rows])]
                rows, at = rows[at >= 0], at[at >= 0]
                part, weight = x[rows], w[rows].astype(np.float64)
                both, k = weight * APART + weight * y[rows], asked.shape[1]
                if t not in sums:
                    sums[t] = np.zeros((2, k, len(nodes), width))
                flat, place = part.reshape(-1), np.arange(len(part)) * count
                for j in range(k):
                    key = at * width + flat[place + asked[:, j][at]]
                    cells = np.bincount(key, both, len(nodes) * width)
                    for i, v in enumerate(parted(cells.reshape(len(nodes), width))):
                        sums[t][i, j] += v
        for t, found in sums.items():
            nodes = shared.value[t][1]
            yield table(
                COUNTS, [(t, int(v), found[:, :, i].tobytes()) for i, v in enumerate(nodes)]
            )

    def decide(group: pa.Table) -> pa.Table:
        t, node = group["tree"][0].as_py(), group["node"][0].as_py()
        total = sum(np.frombuffer(b) for b in group["counts"].to_pylist()).reshape(2, -1, width)
        n, s = total[0, 0].sum(), total[1, 0].sum()
        ln, ls = np.cumsum(total, axis=2)[:, :, :-1]
        gain, asked = gains(n, s, ln, ls, False), draw.features(t, node, count)
        if draw.subset == count:
            gain[bins.flag, 0] = flag_gains(n, s, ln[bins.flag, 0], ls[bins.flag, 0], False)
        j, cut = np.unravel_index(gain.argmax(), gain.shape)
        f = int(asked[j])
        row = t, node, f, int(cut), gain[j, cut], n, s, ln[j, cut], ls[j, cut]
        return pa.Table.from_batches([table(SPLIT, [row])])

    found = data.blocks.mapInArrow(counts, COUNTS).groupBy("tree", "node")
    return sorted(found.applyInArrow(decide, SPLIT).collect(), key=lambda r: (r.tree, r.node))


def subtrees(data: Binned, draw: Draw, tops: list[Top]) -> DataFrame:
    """Every subtree, grown where the rows of its root meet."""
    spark, bins = data.blocks.sparkSession, data.bins
    known = {}
    for t, top in enumerate(tops):
        if len(nodes := top.of(GROUP)):
            known[t] = top.tree(), {int(node): top.depth[node] for node in nodes}
    shared = spark.sparkContext.broadcast(known)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x, y, used in block_rows(batches, bins):
            packed = bins.pack(x)
            for t, (tree, groups) in shared.value.items():
                w = draw.weights(t, block, used)
                rows, out = np.flatnonzero(w), []
                node = leaf_of(tree, x[rows])
                order = np.argsort(node, kind="stable")
                rows, node = rows[order], node[order]
                first = np.flatnonzero(np.diff(node, prepend=-1))
                for a, b in zip(first, [*first[1:], len(rows)]):
                    if int(node[a]) in groups:
                        at = rows[a:b]
                        raw = np.concatenate([packed[at], w[at, None], y[at, None]], axis=1)
                        out.append((t, int(node[a]), len(at), raw.tobytes()))
                if out:
                    yield table(PIECE, out)

    def finish(group: pa.Table) -> pa.Table:
        t, node = group["tree"][0].as_py(), group["node"][0].as_py()
        raw = np.concatenate(
            [
                np.frombuffer(b, np.uint8).reshape(n, -1)
                for b, n in zip(group["rows"].to_pylist(), group["n"].to_pylist())
            ]
        )
        x, w, y = bins.unpack(raw[:, :-2]), raw[:, -2], raw[:, -1]
        depth = draw.depth - shared.value[t][1][node]
        rng = draw.rng(t, 2, node)
        got = grow(x, w, y, bins, depth, draw.subset, rng)
        inner = got.left >= 0
        weight = got.gain[inner] * got.n[inner]
        by_feature = np.bincount(got.feature[inner], weight, len(bins.sizes)).astype(np.float64)
        arrays = got.feature, got.cut, got.left, got.n, got.s, by_feature
        row = t, node, len(got.left), *(v.tobytes() for v in arrays)
        return pa.Table.from_batches([table(SUBTREE, [row])])

    groups = sum(len(groups) for _, groups in known.values())
    keys = ["tree", "node"]
    dealt = data.blocks.mapInArrow(pieces, PIECE).repartition(max(1, min(groups, 4096)), *keys)
    return dealt.groupBy(*keys).applyInArrow(finish, SUBTREE)


# -- boosting -------------------------------------------------------------------------------------

BOOSTED = "fit int, label double, scores array<double>"


def boost(
    x: np.ndarray, y: np.ndarray, used: np.ndarray, bins: Bins, depth: int, step: float, counts: Sequence
) -> np.ndarray:
    """held-out rows x counts: the scores after so many rounds on the used rows, as Spark boosts.

    The first tree is fitted to the labels -1 and 1, every further one to what the logistic loss
    leaves, and counts for ``step``.
    """
    own, others, sign = x[used > 0], x[used == 0], 2.0 * y[used > 0] - 1
    score, held = np.zeros(len(own)), np.zeros(len(others))
    out = np.empty((len(others), len(counts)))
    for t in range(max(counts)):
        with np.errstate(over="ignore"):
            left = sign if t == 0 else 4 * sign / (1 + np.exp(2 * sign * score))
        tree = grow(own, None, left, bins, depth, variance=True)
        value, weight = tree.s / tree.n, 1.0 if t == 0 else step
        score += weight * value[leaf_of(tree, own)]
        held += weight * value[leaf_of(tree, others)]
        out[:, np.asarray(counts) == t + 1] = held[:, None]
    return out


def boosted(data: Binned, points: Sequence[tuple[int, float]], counts: Sequence) -> DataFrame:
    """(fit, label, scores) of the held-out rows for every (depth, step), each boosted by one task.

    All used rows are in each of these tasks, so this is for rows that fit one (``GROUP_ROWS``).
    """
    bins, kind = data.bins, pa.list_(pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            named = batch.column("fit").to_pylist()
            for fit, row in zip(named, block_rows([batch.drop_columns(["fit"])], bins)):
                held.setdefault(fit, []).append(row)
        for fit, rows in held.items():
            rows.sort(key=lambda row: row[0])
            x, y, used = (np.concatenate(part) for part in list(zip(*rows))[1:])
            got, label = boost(x, y, used, bins, *points[fit], counts), y[used == 0]
            for at in range(0, len(got), BLOCK_ROWS):
                part = got[at : at + BLOCK_ROWS]
                offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * len(counts))
                columns = [
                    pa.array(np.full(len(part), fit, np.int32)),
                    pa.array(label[at : at + BLOCK_ROWS].astype(np.float64)),
                    pa.ListArray.from_arrays(offsets, pa.array(part.ravel())).cast(kind),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["fit", "label", "scores"])

    every = F.explode(F.sequence(F.lit(0), F.lit(len(points) - 1))).alias("fit")
    dealt = data.blocks.select("*", every).repartitionById(len(points), F.col("fit"))
    return dealt.mapInArrow(run, BOOSTED)


# -- the model ----------------------------------------------------------------------------------------


class ForestModel(
    Model, _ProbabilisticClassifierParams, _RandomForestClassifierParams, MLWritable, MLReadable
):
    """A forest whose nodes are written and not held by the driver; it scores like Spark's."""

    def __init__(self, forest: Forest | None = None):
        super().__init__()
        self.forest = forest

    @property
    def getNumTrees(self) -> int:
        return self.forest.draw.count

    @property
    def trees(self) -> list[Grown]:
        """All trees as arrays, which a large forest's driver can't hold."""
        return [self.forest.tree(t) for t in range(self.getNumTrees)]

    @property
    def treeWeights(self) -> list[float]:
        return [1.0] * self.getNumTrees

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.forest.importances)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        count = self.getNumTrees
        features = F.col(self.getFeaturesCol())
        ones = point_scores(self.forest, features, dataset.sparkSession, [None], [count])
        scored = dataset.withColumn("_ones", F.get(ones, F.lit(0)))
        zeros, ones = F.lit(float(count)) - F.col("_ones"), F.col("_ones")
        raw, share = F.array(zeros, ones), F.array(zeros / count, ones / count)
        return (
            scored.withColumn(self.getRawPredictionCol(), array_to_vector(raw))
            .withColumn(self.getProbabilityCol(), array_to_vector(share))
            .withColumn(self.getPredictionCol(), (ones > zeros).cast("double"))
            .drop("_ones")
        )

    def write(self) -> MLWriter:
        return ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return ForestReader()


class ForestWriter(MLWriter):
    """Parameters, tops and thresholds beside the written subtrees."""

    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        found, spark = self.model.forest, self.sparkSession
        plain = {
            "draw": vars(found.draw),
            "thresholds": [t.tolist() for t in found.bins.thresholds],
            "flags": [int(f) for f in found.bins.flags],
            "tops": [[v.tolist() for v in vars(t).values()] for t in found.tops],
            "hung": [at.tolist() for at in found.hung],
            "importances": found.importances.tolist(),
        }
        DefaultParamsWriter.saveMetadata(self.model, path, self.sc, {"forest": plain})
        subtrees_at(spark, found.path).write.partitionBy("tree").parquet(f"{path}/data")


class ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        plain = metadata["forest"]
        kinds = np.int16, np.uint16, np.int32, np.float64, np.float64, np.float64
        tops = [Grown(*map(np.array, top, kinds)) for top in plain["tops"]]
        forest = Forest(
            Bins([np.array(t, np.float64) for t in plain["thresholds"]], plain["flags"]),
            Draw(**plain["draw"]),
            tops,
            [np.array(at, np.int64) for at in plain["hung"]],
            f"{path}/data",
            np.array(plain["importances"]),
        )
        model = ForestModel(forest)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def plain_features(df: DataFrame, column: str) -> bool:
    """Whether no entry is one of more than two categories."""
    groups = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    return all(len(a.get("vals", ())) <= 2 for a in groups.get("nominal", ()))


def fits(estimator, train: DataFrame) -> bool:
    """Whether these trees are fitted as Spark's estimator says, from all rows alike."""
    plain = {"subsamplingRate": 1.0, "minInstancesPerNode": 1, "minInfoGain": 0.0}
    plain |= {"minWeightFractionPerNode": 0.0, "lossType": "logistic"}
    boosted = isinstance(estimator, GBTClassifier)
    plain |= {"impurity": "variance" if boosted else "gini"}
    plain |= {"featureSubsetStrategy": "all" if boosted else "auto"}
    special = "weightCol", "thresholds", "validationIndicatorCol"
    return (
        all(estimator.getOrDefault(p) == v for p, v in plain.items() if estimator.hasParam(p))
        and not any(estimator.isSet(p) for p in special if estimator.hasParam(p))
        and estimator.getMaxBins() <= 256
        and plain_features(train, estimator.getFeaturesCol())
        and train.filter(~F.col(estimator.getLabelCol()).isin(0, 1)).isEmpty()
    )


def drawn(estimator, count: int, features: int) -> Draw:
    """What Spark's estimator says about its trees."""
    forest = isinstance(estimator, RandomForestClassifier)
    subset = math.ceil(math.sqrt(features)) if forest and count > 1 else features
    bootstrap = forest and estimator.getBootstrap()
    return Draw(count, estimator.getMaxDepth(), subset, bootstrap, estimator.getSeed())


def fit_forest(estimator: RandomForestClassifier, train: DataFrame) -> ForestModel:
    """The estimator's forest with nodes that are written."""
    label = estimator.getLabelCol()
    data = binned(train, estimator.getFeaturesCol(), estimator.getMaxBins(), label=label)
    found = fit(data, drawn(estimator, estimator.getNumTrees(), len(data.bins.sizes)))
    remove(train.sparkSession, data.path)
    return estimator._copyValues(ForestModel(found))
