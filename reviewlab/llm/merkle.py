"""Merkle manifest of a table: bitmap ranks give every leaf its coordinates, slot arrays hash levels.

A row is a leaf; leaves of a group (a language) stand in the order of an id, their tree's root is
the group's subroot, and the subroots in the order of the groups are leaves of the last tree.
Every two consecutive nodes of a level make one of the next, a last single one too.

Coordinates come without sorting the leaves: per group the ids are bits of 64-bit words (``bit_or``,
merged from what every task has seen; words without a bit are not kept), and a directory holds
before each word the rows that stand before it, added up from a hierarchy of at most 4096 words or
subtrees under one parent. A leaf's rank is its word's number plus the bits below its own. A row's
block (rank / ``SLOTS``) and slot then key fixed arrays, in which ten levels are hashed at a time;
the blocks' roots are the leaves of the next such step, a thousandth as many. What a leaf needs to
reach its block's root stays with it; what a block needs to reach the root is put together from the
top down and joined to the leaves once.

Defined results: a null id stands before all others; rows with one id stand in the order of their
leaves' hashes, and rows repeated in full are leaves of their own; a null group is the first of the
groups, which are ordered bytewise; an empty table has no rows. Ids are integers. Only the named
columns are read, so extra columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.arrays import one_array
from reviewlab.llm.frames import shipped, small, written

LEVELS = 10
SLOTS = 1 << LEVELS
# Of a word's or subtree's number so many bits count its place under one parent.
DIRECTORY_BITS = 12
# Blocks are broadcast below this many rows, each of at most some kilobytes.
BROADCAST_BLOCKS = 10_000


def field(column: Column, kind: str) -> Column:
    """A value as it is hashed: ``-`` if null, else its number of bytes, ``:`` and itself."""
    value = column if kind == "string" else column.cast("string")
    sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    return F.coalesce(sized, F.lit("-"))


def leaf(df: DataFrame, columns: list[str], **changed: Column) -> Column:
    """The hash of a row's columns, some of them changed, as 32 bytes."""
    kinds = dict(df.dtypes)
    fields = [field(changed.get(c, df[c]), kinds[c]) for c in columns]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ranks


def bitmap(keys: DataFrame, by: list[str], id: str, n: str | None = None) -> DataFrame:
    """(by..., word, bits, rows, more): the words of (by, id), merged from all tasks.

    ``n`` counts the rows of an id that are given as one; ``more`` lists the bits with several, of
    which a word has 64 at most.
    """
    bit, more = f"cast({id} & 63 as int)", F.lit(None).cast("array<struct<bit:int,n:bigint>>")
    rows = F.count(F.lit(1))
    if n is not None:
        several = F.struct(F.expr(bit).alias("bit"), (F.col(n) - 1).alias("n"))
        rows, more = F.sum(n), F.collect_list(F.when(F.col(n) > 1, several))
    word = F.expr(f"shiftright({id}, 6)").alias("word")
    bits = F.bit_or(F.expr(f"shiftleft(1L, {bit})"))
    found = keys.groupBy(*by, word).agg(bits.alias("bits"), rows.alias("rows"), more.alias("more"))
    return written(found, "words")


def directory(words: DataFrame, by: list[str]) -> DataFrame:
    """Add ``before``, the rows of smaller words, from sums over a hierarchy of subtrees."""
    ends = words.agg(F.min("word").alias("a"), F.max("word").alias("b")).first()
    parent = F.expr(f"shiftright(word, {DIRECTORY_BITS})")
    levels, shift = [words.select(*by, "word", "rows")], DIRECTORY_BITS
    # of 58 bits, at most ten are left above the last level
    while ends.a is not None and shift < 58 and ends.a >> shift != ends.b >> shift:
        sums = levels[-1].groupBy(*by, parent.alias("word")).agg(F.sum("rows").alias("rows"))
        levels.append(written(sums, "subtrees"))
        shift += DIRECTORY_BITS
    inside = Window.partitionBy(*by, "parent").orderBy("word")
    earlier = F.sum("rows").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    known = None
    for level in reversed(levels):  # from the root down
        level = level.withColumn("parent", F.lit(0) if known is None else parent)
        level = level.withColumn("before", F.coalesce(earlier, F.lit(0)))
        if known is not None:
            above = known.select(*by, F.col("word").alias("parent"), F.col("before").alias("above"))
            total = F.col("before") + F.col("above")
            level = level.join(small(above), [*by, "parent"]).withColumn("before", total)
        known = written(level.select(*by, "word", "before"), "directory")
    return written(words.drop("rows").join(known, [*by, "word"]), "index")


def ranked(rows: DataFrame, words: DataFrame, by: list[str], id: str, out: str) -> DataFrame:
    """Add the number of rows that stand before a row's id."""
    words = small(directory(words, by))
    found = rows.withColumn("word", F.expr(f"shiftright({id}, 6)")).join(words, [*by, "word"])
    below = F.expr(f"bit_count(shiftleft(shiftleft(bits, 63 - cast({id} & 63 as int)), 1))")
    more = F.expr(
        f"coalesce(aggregate(more, 0L, (s, x) -> s + if(x.bit < cast({id} & 63 as int), x.n, 0L)), 0L)"
    )
    return found.withColumn(out, F.col("before") + below + more).drop("word", "bits", "before", "more")


def coordinates(rows: DataFrame) -> DataFrame:
    """Add ``rank``, a row's place in its group, to (grp, known, id, leaf, ...)."""
    by, same = ["grp", "known"], rows.columns
    words = bitmap(rows, by, "id")
    if words.filter("rows > bit_count(bits)").isEmpty():
        return ranked(rows, words, by, "id", "rank")
    copies = written(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("copies")), "copies")
    ids = copies.groupBy(*by, "id").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("kinds"))
    ids = written(ids, "ids")
    first = ranked(copies, bitmap(ids, by, "id", "n"), by, "id", "rank")
    repeats = small(ids.filter("kinds > 1").select(*by, "id"))
    # rows that share an id: the same ranks once more, by the first bits of the leaf
    first = first.withColumn("prefix", F.conv(F.hex(F.substring("leaf", 1, 7)), 16, 10).cast("long"))
    shared = first.join(repeats, [*by, "id"])
    alone = first.join(repeats, [*by, "id"], "left_anti")
    under = [*by, "id"]
    prefixes = shared.groupBy(*under, "prefix").agg(F.sum("copies").alias("n"))
    shared = ranked(shared, bitmap(prefixes, under, "prefix", "n"), under, "prefix", "later")
    ties = Window.partitionBy(*under, "prefix").orderBy("leaf", *(c for c in same if c not in (*under, "leaf")))
    tied = F.coalesce(F.sum("copies").over(ties.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shared = shared.withColumn("rank", F.col("rank") + F.col("later") + tied)
    both = alone.select(*same, "copies", "rank").unionByName(shared.select(*same, "copies", "rank"))
    # a row's copies in pieces of a block each, dealt out before they become rows
    pieces = both.select("*", F.explode(F.expr(f"sequence(0L, (copies - 1) div {SLOTS})")).alias("piece"))
    last = F.expr(f"least(copies - 1, (piece + 1) * {SLOTS} - 1)")
    copy = F.explode(F.sequence(F.col("piece") * SLOTS, last)).alias("copy")
    spread = pieces.repartition("grp", "rank", "piece").select("*", copy)
    return spread.withColumn("rank", F.col("rank") + F.col("copy")).drop("copies", "piece", "copy")


# trees


def reduce_block(nodes: list[str], size: int) -> tuple[list[str], str]:
    """(siblings of every slot from the bottom up, last node) of one slot array.

    ``size`` is the number of nodes of the whole level, which stops at a single one.
    """
    siblings, level = [], 0
    while level < LEVELS and size > 1:
        siblings.append([nodes[i ^ 1] if i ^ 1 < len(nodes) else "" for i in range(len(nodes))])
        nodes = [_h("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        size, level = (size + 1) // 2, level + 1
    paths = [""] * len(nodes)
    for above in reversed(siblings):
        paths = [s + paths[i >> 1] for i, s in enumerate(above)]
    return paths, nodes[0]


def _block(table: pa.Table) -> pa.Table:
    """Put a block's nodes into their slots, hash its levels, give every row its siblings."""
    slot = [r % SLOTS for r in table["rank"].to_pylist()]
    nodes = [""] * len(slot)
    for s, node in zip(slot, table["node"].to_pylist()):
        nodes[s] = node.hex()
    paths, top = reduce_block(nodes, table["size"][0].as_py())
    path = [bytes.fromhex(paths[s]) for s in slot]
    root = [bytes.fromhex(top) if s == 0 else None for s in slot]
    table = table.append_column("path", pa.array(path, pa.binary()))
    return table.append_column("top", pa.array(root, pa.binary()))


def reduced(nodes: DataFrame) -> DataFrame:
    """Add ``path`` and, in a block's first slot, ``top`` to (grp, rank, size, node, ...)."""
    nodes = nodes.withColumn("block", F.expr(f"shiftright(rank, {LEVELS})"))
    kinds = [f"{name} {kind}" for name, kind in nodes.dtypes]
    done = nodes.groupBy("grp", "block").applyInArrow(_block, ", ".join([*kinds, "path binary", "top binary"]))
    return written(done, "blocks")


def _roots(level: DataFrame) -> DataFrame:
    size = F.expr(f"shiftright(size + {SLOTS - 1}, {LEVELS})")
    return level.filter("top is not null").select(
        "grp", F.col("block").alias("rank"), size.alias("size"), F.col("top").alias("node")
    )


def numbered(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the place of every row in the order of a column; range partitions keep the order.

    The driver sees one number per partition.
    """
    order = df.repartitionByRange(column).sortWithinPartitions(column)
    order = written(order.withColumn("at", F.monotonically_increasing_id()), "order")
    part, inside = F.expr("shiftright(at, 33)"), F.expr("at & 8589934591")
    sizes = order.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = 0, []
    for r in sorted(sizes):
        offsets.append((r.part, before))
        before += r.n
    table = df.sparkSession.createDataFrame(offsets, "part long, offset long")
    order = order.withColumn("part", part).join(F.broadcast(table), "part")
    return order.withColumn(out, F.col("offset") + inside).drop("at", "part", "offset")


def manifest(
    df: DataFrame, leaf: Column, key: str = "doc_id", group: str = "lang", **carried: Column
) -> DataFrame:
    """(key, leaf, subroot, root, rank, size, place, groups, proof, ...) of every row.

    ``rank`` is the row's place of ``size`` in its group, ``place`` the group's of ``groups``;
    ``proof`` holds the siblings, 32 bytes each, from the leaf up to the root. ``carried`` columns
    are computed from the row and returned.
    """
    rows = shipped(df).select(
        # null, then the values bytewise
        F.coalesce(F.concat(F.lit("="), df[group].cast("string")), F.lit("-")).alias("grp"),
        df[key].isNotNull().alias("known"),
        F.coalesce(df[key].cast("long"), F.lit(0).cast("long")).alias("id"),
        leaf.alias("leaf"),
        *(column.alias(f"carried_{name}") for name, column in carried.items()),
    )
    rows = written(rows, "leaves")
    groups = rows.groupBy("grp").agg(
        F.count(F.lit(1)).alias("size"), F.count_if(~F.col("known")).alias("unknown")
    )
    groups = written(numbered(groups, "grp", "place"), "groups")
    places = coordinates(rows).join(small(groups), "grp")
    # rows without an id stand before the others
    rank = F.col("rank") + F.when(F.col("known"), F.col("unknown")).otherwise(F.lit(0))
    places = places.withColumn("rank", rank).withColumnRenamed("leaf", "node").drop("unknown", "place")
    levels = [reduced(places)]
    while not (nodes := _roots(levels[-1])).filter("size > 1").isEmpty():
        levels.append(reduced(nodes))
    # the groups' roots, then from the top down what every block needs to reach the root
    level = reduced(_group_nodes(groups, nodes))
    crowns = [level]
    while not (nodes := _roots(level)).filter("size > 1").isEmpty():
        level = reduced(nodes)
        crowns.append(level)
    root = nodes.first()
    whole = F.lit(bytes(root.node) if root else b"")
    rest = None
    for crown in reversed(crowns):
        rest = _with_rest(crown, rest)
    rest = rest.withColumnsRenamed({"rank": "place", "size": "groups", "node": "subroot"}).drop("grp")
    rest = rest.join(groups.select("grp", "place"), "place").withColumn("block", F.lit(0).cast("long"))
    rest = written(rest, "subroots")
    extra = ["place", "groups", "subroot"]
    for level in reversed(levels[1:]):
        above = rest.select("grp", "block", F.col("rest").alias("above"), *extra)
        level = level.select("grp", "rank", "block", "path")
        rest = level.join(small(above, BROADCAST_BLOCKS), ["grp", "block"]).select(
            "grp", F.col("rank").alias("block"), F.concat("path", "above").alias("rest"), *extra
        )
        rest = written(rest, "paths")
    rest = small(rest.select("grp", "block", "rest", *extra), BROADCAST_BLOCKS)
    done = levels[0].join(rest, ["grp", "block"])
    return done.select(
        F.when(F.col("known"), F.col("id")).alias(key),
        F.col("node").alias("leaf"),
        "subroot",
        whole.alias("root"),
        "rank",
        "size",
        "place",
        "groups",
        F.concat("path", "rest").alias("proof"),
        *(F.col(f"carried_{name}").alias(name) for name in carried),
    )


def _group_nodes(groups: DataFrame, roots: DataFrame) -> DataFrame:
    """The groups as nodes of the last tree."""
    count = F.lit(groups.count()).cast("long")
    nodes = groups.select("grp", "place").join(roots.select("grp", "node"), "grp")
    return nodes.select(F.lit("").alias("grp"), F.col("place").alias("rank"), count.alias("size"), "node")


def _with_rest(level: DataFrame, above: DataFrame | None) -> DataFrame:
    """(grp, rank, size, node, rest) of a level, with what stands above its blocks."""
    if above is None:
        return level.select("grp", "rank", "size", "node", F.col("path").alias("rest"))
    above = above.select("grp", F.col("rank").alias("block"), F.col("rest").alias("above"))
    joined = level.join(small(above, BROADCAST_BLOCKS), ["grp", "block"])
    return joined.select("grp", "rank", "size", "node", F.concat("path", "above").alias("rest"))


# proofs


def fold_one(node: str, proof: str, rank: int, size: int, place: int, groups: int) -> str:
    """The root that a leaf and its siblings lead to."""
    at = 0
    for i, n in ((rank, size), (place, groups)):
        while n > 1:
            if i ^ 1 < n:
                sibling, at = proof[at : at + 64], at + 64
                node = _h(sibling + node if i & 1 else node + sibling)
            else:
                node = _h(node)
            i, n = i >> 1, (n + 1) // 2
    return node


def fold(leaf: Column) -> Column:
    """The root recomputed from a leaf and the other columns of ``manifest``, as 32 bytes."""

    @F.arrow_udf("binary")
    def folded(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            rows = zip(*(one_array(c).to_pylist() for c in columns))
            out = [
                bytes.fromhex(fold_one(node.hex(), proof.hex(), *numbers))
                for node, proof, *numbers in rows
            ]
            yield pa.array(out, pa.binary())

    return folded(leaf, *(F.col(c) for c in ("proof", "rank", "size", "place", "groups")))
