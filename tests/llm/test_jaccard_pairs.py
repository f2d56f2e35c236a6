"""The n-gram join makes few pairs beside the linked ones, and no pair again and again."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from reviewlab.llm import jaccard_join


def _replaced(words, count, name):
    """The words with ``count`` evenly spaced ones replaced."""
    out, step = list(words), len(words) // count
    for i in range(count):
        out[i * step] = f"{name}{i}"
    return out


def _pairs(spark, texts):
    """All pairs of the texts' sets, with the sketches that they are compared by where they meet."""
    sets = list(jaccard_join.ngram_sets(pa.array(texts), 4))
    rows = [(jaccard_join.node_of(g), t, len(g)) for g, t in zip(sets, texts)]
    df = spark.createDataFrame(rows, "node bigint, text string, size int")
    wide = jaccard_join.wide_sketches(df.select("node", "text"), 4)
    nodes = df.join(wide, "node").select("size", jaccard_join.halved("wide").alias("wide"))
    x, y = (nodes.toDF(f"size_{i}", f"wide_{i}") for i in "ab")
    return x.join(y, F.col("size_a") < F.col("size_b"))


def test_large_sets_that_differ_twice_too_much_are_no_pair(spark):
    words = [f"w{i}" for i in range(9000)]
    texts = [" ".join(words), " ".join([*_replaced(words, 400, "x"), "one", "more"])]
    pairs = _pairs(spark, texts)
    assert pairs.count() == 1 and pairs.filter(jaccard_join._near_wide(85)).count() == 0


def test_sets_that_differ_a_little_too_much_are_no_pair(spark):
    """The sizes of both say how much they can differ, which is less than that of one allows."""
    words = [f"w{i}" for i in range(9000)]
    rows = []
    for count in (184, 176):  # of 18,000 n-grams 1459 may differ; 8 do for every word
        texts = [" ".join(words), " ".join([*_replaced(words, count, "x"), "more"])]
        a, b = jaccard_join.ngram_sets(pa.array(texts), 4)
        both = len(set(a.tolist()) & set(b.tolist()))
        differ = len(a) + len(b) - 2 * both
        rows.append((len(a), len(b), differ, 100 * both >= 85 * (len(a) + len(b) - both)))
        rows.append((len(a), len(b), 8 * differ // 7, False))
    df = spark.createDataFrame(rows, "size_a int, size_b int, differ int, linked boolean")
    for r in df.withColumn("allowed", jaccard_join._allowed(F.col("differ"), 85)).collect():
        similar = (r.size_a + r.size_b - r.differ) / (r.size_a + r.size_b + r.differ)
        assert r.allowed == (similar >= 0.85) and (r.allowed or not r.linked)


def test_linked_sets_with_sketches_of_two_widths_stay_a_pair(spark):
    words = [f"w{i}" for i in range(8000)]
    texts = [" ".join(words[:7400]), " ".join(words), " ".join(_replaced(words[:7500], 50, "x"))]
    pairs = _pairs(spark, texts)
    widths = pairs.select(F.size("wide_a") + F.size("wide_b")).distinct().count()
    assert widths > 1 and pairs.filter(jaccard_join._near_wide(85)).count() == 3


def test_meeting_places_of_the_same_nodes_are_one(spark):
    groups = {1: [10, 11], 2: [10, 11], 3: [10, 11, 12], 4: [12, 13], 5: [11, 10], 6: [13, 12]}
    rows = [(s, node, node) for s, nodes in groups.items() for node in nodes]
    placed = spark.createDataFrame(rows, "signature bigint, node bigint, component bigint")
    kept = jaccard_join.distinct_places(placed.repartition(4)).collect()
    assert sorted((r.signature, r.node) for r in kept) == [
        (s, n) for s in (1, 3, 4) for n in sorted(groups[s])
    ]


def test_a_group_of_near_copies_is_compared_once_per_member(spark, monkeypatch):
    """Its members meet many central nodes, each in another fragment."""
    rng, asked = random.Random(5), []
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(_replaced(words, 1, f"d{i}x")[: 200 - rng.randint(0, 5)])) for i in range(40)]
    docs += [(100 + i, " ".join(_replaced(words, 2, f"e{i}x"))) for i in range(20)]
    linked = jaccard_join.linked

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return linked(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "linked", counted)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    found = jaccard_join.groups(df, n=4, percent=85).collect()
    assert {r.component_id for r in found} == {0}
    assert sum(asked) < len(docs)


def test_copies_under_one_key_are_cut_once(spark):
    """Rows that share a text share its key in the pipeline, so they don't pair with one another."""
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words), " ".join(_replaced(words, 1, "x")), " ".join(words[:60])]
    sets = list(jaccard_join.ngram_sets(pa.array(texts), 4))
    names = [jaccard_join.node_of(g) for g in sets]
    rows = [(name, text) for name, text in zip(names, texts)] * 30
    rows += [(names[0], "another text under the key of the first one")] * 5
    df = spark.createDataFrame(rows, "node bigint, text string").repartition(4)
    parts = jaccard_join.partitions(df, 4).collect()
    assert len(parts) == len({(r.node, r.part) for r in parts}) <= 3 * jaccard_join.PARTITIONS
    for name, grams in zip(names, sets):
        found = [g for r in parts if r.node == name for g in r.grams]
        assert sorted(found) == sorted(grams.astype("int64").tolist())
    copies = spark.createDataFrame([(t,) for t in texts * 30], "text string").repartition(4)
    keyed = copies.withColumn("code", F.xxhash64("text"))
    found = jaccard_join.groups(keyed, n=4, percent=85, key="code")
    sizes = found.groupBy("component_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [30, 60]
