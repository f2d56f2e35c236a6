"""The Merkle manifest against a plain tree: many blocks, wide ids, repeated and odd rows."""

from __future__ import annotations

import hashlib
import random

from conftest import SCHEMA
from pyspark.sql import functions as F

from reviewlab.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """(root, siblings of every node)."""
    proofs, at = [""] * len(nodes), list(range(len(nodes)))
    while len(nodes) > 1:
        proofs = [p + (nodes[i ^ 1] if i ^ 1 < len(nodes) else "") for p, i in zip(proofs, at)]
        nodes = [h("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], proofs


def plain(rows):
    """Sorted (doc_id, leaf, subroot, root, proof) of all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(("" if r["lang"] is None else "=" + r["lang"]).encode(), []).append(r)
    out, tops = [], []
    for _, members in sorted(groups.items()):
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        leaves = [leaf(r) for r in members]
        root, proofs = tree(leaves)
        tops.append(root)
        out += [[r["doc_id"], x, root, p, len(tops) - 1] for r, x, p in zip(members, leaves, proofs)]
    root, crowns = tree(tops)
    rows = [(i, x, s, root, p + crowns[g]) for i, x, s, p, g in out]
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def found(df):
    done = merkle.manifest(df, merkle.leaf(df, COLUMNS), claimed=F.lit(None).cast("binary"))
    done = done.withColumn("folded", merkle.fold(F.col("leaf")))
    names = ("leaf", "subroot", "root", "proof", "folded")
    rows = done.select("doc_id", *(F.lower(F.hex(c)).alias(c) for c in names)).collect()
    assert all(r.folded == r.root for r in rows)
    rows = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def check(spark, rows):
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got == plain([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])


def test_many_blocks_and_wide_ids(spark):
    dice = random.Random(1)
    ids = {dice.randrange(-(1 << 63), 1 << 63) for _ in range(300)} | {-(1 << 63), (1 << 63) - 1}
    ids |= set(range(-40, 2500))
    rows = [(i, f"text {i}", "en" if i % 7 else "é", "web", i % 1000) for i in ids]
    check(spark, rows + [(5, "a", "de", None, None), (1, "", "EN", "x", 0)])


def test_repeated_ids_and_rows(spark, odd_rows):
    rows = [(7, f"text {i % 90}", "en", "web", i % 3) for i in range(400)]
    rows += [(None, f"other {i % 50}", None, "web", None) for i in range(300)]
    rows += [(8, "copy", "en", "web", 4)] * 2500 + [(i, "x", "en", "web", 1) for i in range(64)]
    check(spark, rows + odd_rows)


def test_odd_rows(spark, clashing, odd_rows, none):
    names = ("doc_id", "text", "lang", "source", "n_chars")
    assert found(clashing) == plain([dict(zip(names, r)) for r in odd_rows])
    assert found(none) == []


def test_tampering_is_found(spark):
    df = spark.createDataFrame([(i, f"t{i}", "en", "a", i) for i in range(37)], SCHEMA)
    other = merkle.leaf(df, COLUMNS, n_chars=F.col("n_chars") + 1)
    done = merkle.manifest(df, merkle.leaf(df, COLUMNS), claimed=F.when(F.col("doc_id") % 5 == 0, other))
    done = done.withColumn("same", merkle.fold(F.coalesce("claimed", "leaf")) == F.col("root"))
    assert {(r.doc_id % 5 == 0, r.same) for r in done.collect()} == {(True, False), (False, True)}
