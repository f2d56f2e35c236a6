"""N-gram Jaccard self-join by vertical partitioning.

A document's set holds 64-bit hashes of its distinct word n-grams; the global n-gram order is the
order of the hashes. Two sets are linked when their Jaccard similarity reaches ``percent``.

Candidates. The order is cut into F ranges, and every document's set into F fragments. Two linked
sets whose smaller one has n n-grams differ in at most d = floor(n (100 - p) / p) of them, so with
more than d fragments that aren't empty at least one is equal in both. Documents meet by the hash
of a whole fragment. F depends on a class of set sizes; a set near the lower end of its class is
cut for the class below as well. A set with too few fragments that aren't empty (a few tiny ones)
also goes by its prefix: two such sets share one of their first n - ceil(p n / 100) + 1 n-grams.

Counting. For candidate pairs the global order is cut into a few vertical partitions; each counts
the pairs' partial overlaps on its own, and the counts are summed per pair.

Groups of copies. Equal sets are one node. Documents that meet in a fragment are first compared
with the most central node there, not with each other: every document with the most central of
these nodes, then with those it is still apart from; connected components follow; then only pairs
of nodes in different components that meet somewhere are left: first the most similar pair of every
two components is compared, then those that are still apart. So a group isn't compared pair by
pair, and no link between components is lost. Of meeting places with the same nodes one is kept.
Parity sketches, which bound from below in how many n-grams two sets differ, drop pairs before they
are made and before sets are sent; a larger set has a wider one, so that its allowed differences
don't fill it.

Defined results: a null text or one without words has an empty set and is linked with nothing;
fewer words than n make one n-gram; rows repeated in full, or several texts under one key, are one
document (their links are the key's); rows without a key are linked with nothing and their
component is null. An empty table gives an empty table. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.arrays import flat_text, mix, release, slices, spread
from reviewlab.llm.frames import merged, shipped, small, written

PARTITIONS = 8
# A batch goes out of Python once it has this many n-grams or keys.
MOST_ROWS = 100_000
# Sizes of a class span this factor.
CLASS_FACTOR = 1.7
# Bits of a parity sketch, kept as 64-bit words.
BITS = 512
SKETCH = [f"sketch_{i}" for i in range(BITS // 64)]
# A wide sketch, by which candidate pairs are compared before their sets are, has at least so many
# bits, and so many for every allowed difference. Nodes still apart are compared by its half where
# they meet: the short one says nothing about sets of more than about a thousand n-grams, whose
# allowed differences fill it.
WIDE_BITS, WIDE_FACTOR = 4096, 12
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
_VALUES = spread(0, 256)
_STEPS = spread(256, 16)
_ODD = np.uint64(0x2545F4914F6CDD1D)
_BACK = np.uint64(pow(0x2545F4914F6CDD1D, -1, 1 << 64))


class Powers:
    """Powers of an odd number modulo 2^64, and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            self.up = np.cumprod(np.append(np.uint64(1), np.full(n + n // 4, _ODD)))
            self.down = np.cumprod(np.append(np.uint64(1), np.full(n + n // 4, _BACK)))
        return self.up, self.down


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, powers: Powers
) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words before each document's first and the last's end)."""
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (~np.append(False, inside[:-1]) | edge[:-1]))
    end = np.flatnonzero(inside & (~np.append(inside[1:], False) | edge[1:])) + 1
    up, down = powers.upto(len(data))
    sums = np.append(np.uint64(0), np.cumsum(_VALUES[_LOWER[data]] * up[: len(data)]))
    code = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return code, np.searchsorted(start, offsets)


def ngram_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of every text."""
    data, offsets = flat_text(column)
    powers = Powers()
    for a, b in slices(offsets):
        words, at = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], powers)
        gram = words
        for k in range(1, n):
            gram = mix(gram[: len(words) - k] * _STEPS[0] + words[k:]) if len(words) > k else words[:0]
        for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
            if e - s >= n:
                yield np.unique(gram[s : e - n + 1])
            elif e > s:
                x = words[s : s + 1]
                for k in range(s + 1, e):
                    x = mix(x * _STEPS[0] + words[k : k + 1])
                yield x ^ _STEPS[e - s]
            else:
                yield words[:0]


def node_of(grams: np.ndarray) -> int:
    """A 64-bit name of a set: equal sets have equal names."""
    place = np.arange(1, len(grams) + 1, dtype=np.uint64) * _ODD
    total = np.add.reduce(mix(grams ^ place)) + np.uint64(len(grams))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


class Cuts:
    """How sets are cut into fragments, for a similarity of ``percent`` hundredths."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bounds = [1]

    def classes(self, size: int) -> list[int]:
        """The classes a set of this size is cut for."""
        while self.bounds[-1] <= size:
            self.bounds.append(max(self.bounds[-1] + 1, int(self.bounds[-1] * CLASS_FACTOR)))
        own = int(np.searchsorted(self.bounds, size, "right")) - 1
        out, least = [own], -(-self.percent * size // 100)
        while own and self.bounds[own] > least:
            own -= 1
            out.append(own)
        return out

    def most_different(self, size: int) -> int:
        """Most n-grams in which a set of this size differs from a linked one not smaller."""
        return size * (100 - self.percent) // self.percent

    def fragments(self, of_class: int) -> int:
        d = self.most_different(self.bounds[of_class + 1] - 1)
        return d + 3 + d // 16

    def signatures(self, grams: np.ndarray) -> np.ndarray:
        """The keys under which a set meets others; none where only equal sets can be linked."""
        size = len(grams)
        d = self.most_different(size)
        if size == 0 or d == 0:
            return grams[:0]
        spread_grams, out, fewest = mix(grams + _STEPS[1]), [], size
        for c in self.classes(size):
            count = np.uint64(self.fragments(c))
            fragment = ((grams >> np.uint64(32)) * count) >> np.uint64(32)
            first = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1]))
            whole = np.add.reduceat(spread_grams, first)
            out.append(mix(whole + mix(fragment[first] + np.uint64(c << 40) + _STEPS[2])))
            fewest = min(fewest, len(first))
        if fewest <= d:
            prefix = size - -(-self.percent * size // 100) + 1
            out.append(mix(grams[:prefix] ^ _STEPS[3]))
        return np.concatenate(out)


def sketch_of(grams: np.ndarray, width: int = BITS) -> np.ndarray:
    """One bit per residue of the hashes: whether it occurs an odd number of times.

    Two sets differ in at least as many n-grams as their sketches differ in bits.
    """
    place = (mix(grams) >> np.uint64(40)).astype(np.int64) % width
    bits = np.bincount(place, minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sets(df: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, node, sketch words) of every row."""

    @F.arrow_udf("struct<n_shingles:bigint,node:bigint,sketch:array<bigint>>")
    def summary(column: pa.Array) -> pa.Array:
        size, node, sketch = [], [], []
        for grams in ngram_sets(column, n):
            size.append(len(grams))
            node.append(node_of(grams))
            sketch.append(sketch_of(grams))
        release()
        words = pa.array(np.concatenate([np.zeros(0, np.int64), *sketch]))
        at = pa.array(np.arange(len(size) + 1) * (BITS // 64), pa.int32())
        columns = [pa.array(size, pa.int64()), pa.array(node, pa.int64())]
        return pa.StructArray.from_arrays(
            [*columns, pa.ListArray.from_arrays(at, words)], ["n_shingles", "node", "sketch"]
        )

    rows = df.select(df[key].alias("key"), summary(F.coalesce(df[text], F.lit(""))).alias("s"))
    return rows.select(
        "key", "s.n_shingles", "s.node", *(F.col("s.sketch")[i].alias(w) for i, w in enumerate(SKETCH))
    )


def meetings(df: DataFrame, n: int, percent: int, text: str = "text") -> DataFrame:
    """(signature, node) of the distinct sets, each once per task."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, seen = Cuts(percent), set()
        for batch in batches:
            signature, node, rows = [], [], 0
            for grams in ngram_sets(batch.column(0), n):
                keys = cuts.signatures(grams)
                if not len(keys):
                    continue
                name = node_of(grams)
                if name in seen:
                    continue
                seen.add(name)
                signature.append(keys)
                node.append(np.full(len(keys), name, np.int64))
                rows += len(keys)
                if rows >= MOST_ROWS:
                    yield rows_of(signature, node)
                    signature, node, rows = [], [], 0
            if rows:
                yield rows_of(signature, node)
            release()

    def rows_of(*columns):
        arrays = [pa.array(np.concatenate(c).view(np.int64)) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, ["signature", "node"])

    return df.select(df[text].alias("text")).mapInArrow(emit, "signature bigint, node bigint")


def partitions(df: DataFrame, n: int, count: int = PARTITIONS) -> DataFrame:
    """(node, part, grams): the sets of (node, text) rows, cut at fixed places of the order.

    A node has every part once, in however many rows its text is.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            nodes, kept, rows = [], [], 0
            for node, grams in zip(batch.column(0).to_pylist(), ngram_sets(batch.column(1), n)):
                if node in seen or node_of(grams) != node:
                    continue  # a copy, or another text under the same key
                seen.add(node)
                nodes.append(node)
                kept.append(grams)
                rows += len(grams)
                if rows >= MOST_ROWS:
                    yield cut(nodes, kept)
                    nodes, kept, rows = [], [], 0
            if rows:
                yield cut(nodes, kept)
            release()

    def cut(nodes: list[int], grams: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(grams)
        of = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        part = (((flat >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)
        sizes = np.bincount(of * count + part, minlength=len(grams) * count)
        at = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(nodes, np.int64), count)),
                pa.array(np.tile(np.arange(count, dtype=np.int32), len(grams))),
                pa.ListArray.from_arrays(at, pa.array(flat.view(np.int64))),
            ],
            ["node", "part", "grams"],
        )

    parts = df.select("node", "text").mapInArrow(emit, "node bigint, part int, grams array<bigint>")
    return parts.filter(F.size("grams") > 0).dropDuplicates(["node", "part"])


def wide_bits(differences: int) -> int:
    """Bits of the wide sketch of a set that may differ in so many n-grams, a power of two."""
    return max(WIDE_BITS, 1 << max(WIDE_FACTOR * differences - 1, 0).bit_length())


def wide_sketches(df: DataFrame, n: int, percent: int = 85) -> DataFrame:
    """(node, wide) of (node, text) rows; a row with another text of the node's key is left out."""

    @F.arrow_udf("struct<own:bigint,wide:array<bigint>>")
    def wide(column: pa.Array) -> pa.Array:
        cuts, own, words = Cuts(percent), [], []
        for grams in ngram_sets(column, n):
            own.append(node_of(grams))
            words.append(sketch_of(grams, wide_bits(cuts.most_different(len(grams)))))
        release()
        at = pa.array(np.cumsum([0, *map(len, words)]), pa.int32())
        flat = pa.array(np.concatenate([np.zeros(0, np.int64), *words]))
        columns = [pa.array(own, pa.int64()), pa.ListArray.from_arrays(at, flat)]
        return pa.StructArray.from_arrays(columns, ["own", "wide"])

    rows = df.select("node", wide(F.col("text")).alias("s")).filter("node = s.own")
    return rows.select("node", "s.wide").dropDuplicates(["node"])


def halved(wide: str) -> Column:
    """The sketch of half as many bits: of two bits that become one, whether they differ."""
    words = (F.size(wide) / 2).cast("int")
    first, last = F.slice(wide, F.lit(1), words), F.slice(wide, words + 1, words)
    return F.zip_with(first, last, lambda x, y: x.bitwiseXOR(y))


def _folded(wide: str, other: str) -> Column:
    """A sketch, halved if the other has fewer bits.

    Sizes that allow a link are so near that one sketch has at most twice the bits of the other.
    """
    return F.when(F.size(wide) > F.size(other), halved(wide)).otherwise(F.col(wide))


def close(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """The pairs that differ in few enough bits of their wide sketches; no link is lost."""
    columns = pairs.columns
    for i in "ab":
        pairs = pairs.join(wide.select(F.col("node").alias(i), F.col("wide").alias(f"wide_{i}")), i)
    return written(pairs.filter(_near_wide(percent)).select(columns), "close")


def _near_wide(percent: int) -> Column:
    """Whether the wide sketches of a pair allow a link, of a node without one that they do."""
    x, y = _folded("wide_a", "wide_b"), _folded("wide_b", "wide_a")
    bits = F.zip_with(x, y, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda total, k: total + k)
    return F.coalesce(_allowed(differ, percent), F.lit(True))


def linked(
    pairs: DataFrame, rows: DataFrame, own: DataFrame, n: int, percent: int
) -> DataFrame:
    """The (a, b) pairs of nodes whose sets are similar enough.

    ``pairs`` has a, b and their set sizes size_a, size_b, as a written table.
    """
    if pairs.isEmpty():
        return pairs.select("a", "b")
    texts = _texts(rows, own, _ends(pairs))
    parts = partitions(texts, n)
    # sets go straight to the partition of a, once for every pair and once for a itself
    left = parts.withColumnsRenamed({"node": "a", "grams": "x"})
    left = left.join(small(pairs.select("a").distinct()), "a", "left_semi")
    right = parts.withColumnsRenamed({"node": "b", "grams": "y"}).join(small(pairs), "b")
    overlap = F.size(F.array_intersect("x", "y"))
    return (
        right.join(left, ["a", "part"])
        .groupBy("a", "b", "size_a", "size_b")
        .agg(F.sum(overlap).alias("both"))
        .filter(100 * F.col("both") >= percent * (F.col("size_a") + F.col("size_b") - F.col("both")))
        .select("a", "b")
    )


def groups(
    df: DataFrame, n: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_shingles, component_id) of every row."""
    rows = shipped(df).select(df[key].alias("key"), df[text].alias("text"))
    own = written(sets(rows, n, "key"), "sets")
    rows = rows.filter("key is not null")
    known = written(own.filter("n_shingles > 0").drop("key").dropDuplicates(["node"]), "nodes")
    same = Window.partitionBy("signature")
    shared = written(
        meetings(rows, n, percent)
        .withColumns({"least": F.min("node").over(same), "most": F.max("node").over(same)})
        .filter("least < most")
        .select("signature", "node")
        .distinct(),  # several tasks may have had the same set
        "shared",
    )
    wide = written(wide_sketches(_texts(rows, own, shared.select("node")), n, percent), "wide")
    # first the most central node of every meeting place with all others there
    met = shared.withColumn("met", F.count("*").over(same))
    central = met.groupBy("node").agg(F.sum("met").alias("met"))
    hub = F.max(F.struct("met", "node")).over(same)
    first = (
        shared.join(central, "node")
        .select(hub["node"].alias("a"), F.col("node").alias("b"), hub["met"].alias("met"))
        .filter("a <> b")
        .distinct()
    )
    for i in "ab":
        first = first.join(_side(known, i), i)
    first = first.filter(_near(percent)).select("a", "b", "size_a", "size_b", "met")
    first = close(written(first, "pairs"), wide, percent)
    chosen = written(most_central(first), "chosen")
    links = written(linked(chosen, rows, own, n, percent).union(_same_key(own)), "links")
    alone = known.select("node", F.col("node").alias("component"))
    parts = merged(alone, links)
    # a node that isn't linked with the most central one, with the others
    others = written(still_apart(first.join(chosen, ["a", "b"], "left_anti"), parts), "others")
    if not others.isEmpty():
        parts = merged(parts, written(linked(others, rows, own, n, percent), "links"))
    # then nodes of different components that meet somewhere
    placed = (
        shared.join(parts, "node")
        .withColumns(
            {"lowest": F.min("component").over(same), "highest": F.max("component").over(same)}
        )
        .filter("lowest < highest")
        .select("signature", "node", "component")
    )
    placed = distinct_places(written(placed, "open"))
    placed = placed.join(known, "node")
    placed = placed.join(wide.select("node", halved("wide").alias("wide")), "node", "left")
    x, y = (
        _side(placed, i, "signature", *(F.col(c).alias(f"{c}_{i}") for c in ("component", "wide")))
        for i in "ab"
    )
    apart = (F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b"))
    on = (x["signature"] == y["signature"]) & apart & _near(percent) & _near_wide(percent)
    second = (
        x.join(y, on)
        .groupBy("a", "b", "size_a", "size_b", "component_a", "component_b")
        .agg(F.first(_differ()).alias("differ"))
        .join(first, ["a", "b"], "left_anti")
    )
    second = written(second, "pairs")
    # of every two components the most similar pair, as one link joins them
    best = second.groupBy(
        F.least("component_a", "component_b").alias("x"),
        F.greatest("component_a", "component_b").alias("y"),
    ).agg(F.min_by(F.struct("a", "b", "size_a", "size_b"), F.struct("differ", "a", "b")).alias("p"))
    best = written(best.select("p.*"), "best")
    parts = merged(parts, written(linked(best, rows, own, n, percent), "links"))
    # at last all that are still apart
    apart = written(still_apart(second.join(best, ["a", "b"], "left_anti"), parts), "apart")
    if not apart.isEmpty():
        parts = merged(parts, written(linked(apart, rows, own, n, percent), "links"))
    return labelled(own, parts, key)


def most_central(pairs: DataFrame) -> DataFrame:
    """For every b the pair with the most central a."""
    best = F.max_by(F.struct("a", "b", "size_a", "size_b"), F.struct("met", "a"))
    return pairs.groupBy("b").agg(best.alias("p")).select("p.*")


def still_apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different components."""
    pairs = pairs.select("a", "b", "size_a", "size_b")
    for i in "ab":
        side = parts.select(F.col("node").alias(i), F.col("component").alias(f"component_{i}"))
        pairs = pairs.join(side, i)
    return pairs.filter("component_a <> component_b").select("a", "b", "size_a", "size_b")


def distinct_places(placed: DataFrame) -> DataFrame:
    """Of the signatures that the same nodes share only one: the others pair nobody else.

    ``placed`` has a row for every signature and node. The nodes of a signature go by their number
    and 128 bits of hashes.
    """
    members = [F.count("*"), F.bit_xor("node"), F.bit_xor(F.xxhash64("node"))]
    names = ["count", "members", "hashed"]
    lists = placed.groupBy("signature").agg(*(m.alias(c) for m, c in zip(members, names)))
    kept = lists.groupBy(*names).agg(F.min("signature").alias("signature")).select("signature")
    return placed.join(kept, "signature", "left_semi")


def _side(nodes: DataFrame, i: str, *more) -> DataFrame:
    """Nodes as side a or b of a pair, with their set sizes and sketches."""
    columns = [F.col(w).alias(f"{w}_{i}") for w in SKETCH]
    return nodes.select(
        *more, F.col("node").alias(i), F.col("n_shingles").alias(f"size_{i}"), *columns
    )


def _same_key(own: DataFrame) -> DataFrame:
    """Links between the nodes of a key that has several texts."""
    full = own.filter("n_shingles > 0 and key is not null").select("key", "node")
    ends = full.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("most"))
    return full.join(ends.filter("a < most"), "key").select("a", F.col("node").alias("b"))


def labelled(own: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Name every component by its smallest key and carry the name over to its rows."""
    full = own.filter("n_shingles > 0 and key is not null")
    first = full.groupBy("node").agg(F.min("key").alias("first")).join(parts, "node")
    first = written(first, "first")
    names = first.groupBy("component").agg(F.min("first").alias("component_id"))
    names = written(first.join(names, "component").select("node", "component_id"), "names")
    return own.join(names, "node", "left").select(
        F.col("key").alias(key),
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.when(F.col("key").isNotNull(), F.col("component_id")))
        .otherwise(F.col("key"))
        .alias("component_id"),
    )


def _differ() -> Column:
    """In how many bits the sketches of a pair differ."""
    bits = [F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in SKETCH]
    return sum(bits[1:], bits[0])


def _near(percent: int) -> Column:
    """Whether sizes and sketches of a pair allow a link; exact, as both only give bounds."""
    least, most = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    return (100 * least >= percent * most) & _allowed(_differ(), percent)


def _allowed(differ: Column, percent: int) -> Column:
    """Whether two linked sets can differ in so many n-grams: just as many as their sizes leave."""
    return (100 + percent) * differ <= (100 - percent) * (F.col("size_a") + F.col("size_b"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))


def _texts(rows: DataFrame, own: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text for every node."""
    keys = own.join(nodes.distinct(), "node").groupBy("node").agg(F.min("key").alias("key"))
    keys = written(keys, "keys")
    return rows.join(small(keys), "key")
