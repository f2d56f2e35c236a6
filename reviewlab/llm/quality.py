"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text (shares of byte classes, word and line lengths, repetition) are computed
by numpy over the flat bytes of a batch. The trees are grown on a bounded sample of labelled rows
(``max_rows``, smallest key hashes first) from histograms of at most 64 bins, one level at a time,
and kept as flat arrays, in which node i has the children 2i + 1 and 2i + 2; scoring walks all
rows down a tree level by level.

Defined results: a null text is an empty one and gets the score of its statistics, like any other;
rows without a label or key teach nothing; a key labelled several times counts once, by its mean;
where no labelled row is left the score is 0.5. Rows are independent, so repeated rows give equal
rows and an empty table gives an empty table. All other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.arrays import flat_text, mix, release, slices, spread
from reviewlab.llm.frames import shipped

MAX_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_ROWS, SMOOTH = 60, 4, 0.15, 64, 20, 1.0

# Classes of bytes; every other byte is other punctuation or control.
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "comma", "wide", "other")
STATISTICS = (
    *(f"share_{c}" for c in CLASSES),
    "log_bytes", "words", "word_mean", "word_spread", "word_longest", "distinct_words",
    "adjacent_repeats", "lines", "line_mean", "distinct_lines", "common_byte",
)
_TABLE = np.full(256, CLASSES.index("other"), np.uint8)
for _name, _chars in (
    ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
    ("space", (9, 32)), ("newline", (10, 13)), ("stop", (46,)), ("comma", (44,)),
    ("wide", range(128, 256)),
):
    _TABLE[list(_chars)] = CLASSES.index(_name)
_VALUES = spread(0, 256)
_ODD = np.uint64(0x2545F4914F6CDD1D)


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of the runs of True that don't go over a document's end."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before = np.append(False, inside[:-1])
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.append(inside[1:], False)
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of pieces of a byte array."""
    power = np.cumprod(np.append(np.uint64(1), np.full(len(data), _ODD)))
    back = np.uint64(pow(int(_ODD), -1, 1 << 64))
    inverse = np.cumprod(np.append(np.uint64(1), np.full(len(data), back)))
    sums = np.append(np.uint64(0), np.cumsum(_VALUES[data] * power[:-1]))
    return mix((sums[end] - sums[start]) * inverse[start])


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The statistics of flat texts, one row each."""
    docs = len(offsets) - 1
    out = np.zeros((docs, len(STATISTICS)), np.float32)
    size = np.diff(offsets)
    doc = np.repeat(np.arange(docs), size)
    some = np.maximum(size, 1)
    kind = _TABLE[data]
    wide = len(CLASSES)
    out[:, :wide] = np.bincount(doc * wide + kind, minlength=docs * wide).reshape(docs, wide)
    out[:, :wide] /= some[:, None]
    out[:, wide] = np.log1p(size)
    gap = (kind == 3) | (kind == 4)
    start, end, of = _runs(~gap, offsets)
    length = end - start
    words = np.bincount(of, minlength=docs)
    count = np.maximum(words, 1)
    mean = np.bincount(of, length, docs) / count
    out[:, wide + 1] = np.log1p(words)
    out[:, wide + 2] = mean
    out[:, wide + 3] = np.sqrt(
        np.maximum(np.bincount(of, length.astype(float) ** 2, docs) / count - mean**2, 0)
    )
    longest = np.zeros(docs)
    np.maximum.at(longest, of, length)
    out[:, wide + 4] = np.log1p(longest)
    code = _hashes(data, start, end)
    out[:, wide + 5] = _distinct(code, of, docs) / count
    same = (code[1:] == code[:-1]) & (of[1:] == of[:-1])
    if len(code) > 2:
        two = (code[2:] == code[:-2]) & (of[2:] == of[:-2])
        same[1:] |= two
    out[:, wide + 6] = np.bincount(of[1:][same], minlength=docs) / count
    start, end, of = _runs(kind != 4, offsets)
    lines = np.maximum(np.bincount(of, minlength=docs), 1)
    out[:, wide + 7] = np.log1p(lines)
    out[:, wide + 8] = np.log1p(size / lines)
    out[:, wide + 9] = _distinct(_hashes(data, start, end), of, docs) / lines
    # the share of the most frequent byte that is no letter, digit, space or line end
    rare = (kind == 8) | (kind == 5) | (kind == 6)
    counts = np.bincount(doc[rare] * 128 + (data[rare] & 127), minlength=docs * 128)
    out[:, wide + 10] = counts.reshape(docs, 128).max(1) / some
    return out


def _distinct(code: np.ndarray, of: np.ndarray, docs: int) -> np.ndarray:
    """Distinct codes per document."""
    key = mix(code ^ mix(of.astype(np.uint64)))
    order = np.argsort(key)
    new = np.append(True, key[order][1:] != key[order][:-1]) if len(key) else np.zeros(0, bool)
    return np.bincount(of[order][new], minlength=docs)


def measure(text: Column) -> Column:
    """The statistics of a text column, as array<float>."""

    @F.arrow_udf("array<float>")
    def numbers(column: pa.Array) -> pa.Array:
        data, offsets = flat_text(column)
        parts = [np.zeros((0, len(STATISTICS)), np.float32)]
        for a, b in slices(offsets):
            parts.append(statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        flat = np.concatenate(parts)
        release()
        at = pa.array(np.arange(len(flat) + 1) * len(STATISTICS), pa.int32())
        return pa.ListArray.from_arrays(at, pa.array(flat.ravel()))

    return numbers(F.coalesce(text, F.lit("")))


@dataclass
class Trees:
    """Flattened trees: split statistic (-1 in leaves), threshold, value; one row per tree."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float
    rate: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                split = feature[node]
                right = x[rows, np.maximum(split, 0)] > threshold[node]
                node = np.where(split >= 0, 2 * node + 1 + right, node)
            total += self.rate * value[node]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost trees on the logistic loss."""
    nodes = 2 ** (DEPTH + 1) - 1
    feature = np.full((TREES, nodes), -1, np.int64)
    threshold, value = np.zeros((TREES, nodes)), np.zeros((TREES, nodes))
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    if not len(y):
        return Trees(feature[:0], threshold[:0], value[:0], start, RATE)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(c, col) for c, col in zip(cuts, x.T)], 1)
    total = np.full(len(y), start)
    columns = np.arange(x.shape[1])
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH + 1):
            for n in range(2**depth - 1, 2 ** (depth + 1) - 1):
                own = np.flatnonzero(node == n)
                if not len(own):
                    continue
                value[t, n] = g[own].sum() / (h[own].sum() + SMOOTH)
                if depth == DEPTH or len(own) < 2 * LEAST_ROWS:
                    continue
                at = (columns * BINS + bins[own]).ravel()
                size = len(columns) * BINS
                weights = [np.repeat(v[own], len(columns)) for v in (g, h, np.ones(len(y)))]
                G, H, N = (
                    np.cumsum(np.bincount(at, w, size).reshape(-1, BINS), 1) for w in weights
                )
                gain = (
                    G**2 / (H + SMOOTH)
                    + (G[:, -1:] - G) ** 2 / (H[:, -1:] - H + SMOOTH)
                    - G[:, -1:] ** 2 / (H[:, -1:] + SMOOTH)
                )
                gain[(N < LEAST_ROWS) | (N[:, -1:] - N < LEAST_ROWS)] = 0
                best = int(gain.argmax())
                f, b = divmod(best, BINS)
                if gain[f, b] <= 1e-6 or b >= len(cuts[f]):
                    continue
                feature[t, n], threshold[t, n] = f, cuts[f][b]
                node[own] = 2 * n + 1 + (bins[own, f] > b)
        total += RATE * value[t][node]
    return Trees(feature, threshold, value, start, RATE)


def held_out(key: Column) -> Column:
    """Whether a document never teaches: crc32 of its id as text leaves 1 when divided by 3."""
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", max_rows: int = MAX_ROWS,
) -> Trees:
    """Grow trees on at most ``max_rows`` labelled documents that aren't held out."""
    taught = (
        labels.select(labels[key].alias("key"), labels[label].cast("double").alias("label"))
        .filter(F.col("key").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("key")))
        .groupBy("key")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(max_rows)
    )
    rows = (
        shipped(docs).select(docs[key].alias("key"), docs[text].alias("text"))
        .join(F.broadcast(taught), "key")  # at most max_rows rows of two numbers
        .select("key", "label", measure(F.col("text")).alias("x"))
        .orderBy(F.xxhash64("key"), "key", "x")
        .limit(max_rows)
        .select("label", "x")
        .toArrow()
    )
    x = np.asarray(rows["x"].combine_chunks().flatten(), np.float32).reshape(-1, len(STATISTICS))
    return grow(x.astype(float), np.asarray(rows["label"], float))


def score(df: DataFrame, trees: Trees, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability that a text is of good quality."""

    @F.arrow_udf("double")
    def probability(column: pa.Array) -> pa.Array:
        data, offsets = flat_text(column)
        done = [np.zeros(0)]
        for a, b in slices(offsets):
            x = statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            done.append(trees.score(x.astype(float)))
        release()
        return pa.array(np.concatenate(done))

    return shipped(df).withColumn(out, probability(F.coalesce(df[text], F.lit(""))))
