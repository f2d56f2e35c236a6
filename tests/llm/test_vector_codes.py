"""Vector codes against plain integer Lloyd, hot entries, and odd rows."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlab.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, entry string, part string"


def plain(rows, entries, rounds, parts=4):
    """{(vec_id, ints): (codes, error)} and the codebooks' hash, one part at a time."""
    kept = []
    for vec_id, vector, *_ in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, tuple(math.floor(float(np.float32(x)) * 1024) for x in vector)))
    least = {}
    for vec_id, v in kept:
        if vec_id is not None and (vec_id not in least or v < least[vec_id]):
            least[vec_id] = v
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for _, v in kept] for p in range(parts)]
    codes, errors, numbers = [], [0] * len(kept), []
    for p in range(parts):
        book = [least[i][p * width : (p + 1) * width] for i in sorted(least)[:entries]]
        for k in range(rounds + 1):
            far = [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in book] for x in cut[p]]
            at = [f.index(min(f)) for f in far]
            if k < rounds:
                for e in range(len(book)):
                    own = [x for x, a in zip(cut[p], at) if a == e]
                    if own:
                        book[e] = tuple(sum(c) // len(own) for c in zip(*own))
        codes.append(at)
        errors = [e + f[a] for e, f, a in zip(errors, far, at)]
        numbers += [str(x) for c in book for x in c]
    found = [(i, v, list(c), e) for (i, v), c, e in zip(kept, zip(*codes), errors)]
    return found, hashlib.sha256(",".join(numbers).encode()).hexdigest()


def check(spark, rows, entries=8, rounds=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = vector_codes.encode(df, entries=entries, rounds=rounds).collect()
    wanted, digest = plain(rows, entries, rounds)
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.vec_id, r.codes, r.error) for r in got), key=order) == sorted(
        ((i, c, e) for i, _, c, e in wanted), key=order
    )
    assert {r.codebooks_sha256 for r in got} == {digest}


def vectors(n, dice, first=0):
    return [
        (first + i, [dice.uniform(-0.3, 0.3) for _ in range(16)], dice.choice([1, 2, None]), "x", "x")
        for i in range(n)
    ]


def test_random_vectors(spark):
    check(spark, vectors(150, random.Random(3)))
    check(spark, vectors(40, random.Random(4)), entries=64, rounds=2)
    check(spark, vectors(30, random.Random(5)), rounds=0)


def test_repeated_rows_ties_and_odd_vectors(spark):
    dice = random.Random(6)
    same = [0.25] * 16
    rows = vectors(30, dice) + [(100 + i, same, 3, "x", "x") for i in range(300)]
    rows += [(5, same, 1, "x", "x")] * 3 + [(None, same, None, "x", "x")] * 2
    rows += [(-9, None, 1, "x", "x"), (-8, [None, *same[1:]], 1, "x", "x")]
    rows += [(-7, [math.nan, *same[1:]], 1, "x", "x"), (-6, [math.inf, *same[1:]], 1, "x", "x")]
    rows += [(400, [3e4, -3e4] * 8, 1, "x", "x")]
    check(spark, rows)


def test_many_salts_give_the_same(spark, monkeypatch):
    rows = vectors(80, random.Random(7))
    monkeypatch.setattr(vector_codes, "SALT_ROWS", 5)
    check(spark, rows)


def test_undefined_vectors(spark):
    rows = [(1, [0.5] * 8, 1, "x", "x"), (2, [0.5] * 4, 1, "x", "x"), (3, [], 1, "x", "x")]
    got = {r.vec_id: r for r in vector_codes.encode(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].codes == [0, 0, 0, 0] and got[1].error == 0
    assert got[2].codes is None and got[3].error is None
    short = vector_codes.encode(spark.createDataFrame([(1, [0.5] * 7, 1, "x", "x")], SCHEMA)).collect()
    assert [r.codes for r in short] == [None]
    none = spark.createDataFrame([], SCHEMA)
    assert vector_codes.encode(none).count() == 0
    unnamed = spark.createDataFrame([(None, [0.5] * 8, 1, "x", "x"), (None, [0.1] * 8, 1, "x", "x")], SCHEMA)
    assert sorted(r.codes for r in vector_codes.encode(unnamed).collect()) == [[0] * 4, [1] * 4]


def test_members_leave_no_tables(spark):
    before = [t.name for t in spark.catalog.listTables()]
    vector_codes.encode(spark.createDataFrame(vectors(20, random.Random(8)), SCHEMA), entries=4).count()
    assert [t.name for t in spark.catalog.listTables()] == before


@pytest.mark.parametrize("most", [10, vector_codes.EXACT * 8])
def test_nearest_is_exact(most):
    dice = np.random.default_rng(9)
    parts, book = dice.integers(-most, most, (50, 6)), dice.integers(-most, most, (9, 6))
    far = ((parts[:, None] - book) ** 2).sum(2)
    entry, error = vector_codes.nearest(parts, book)
    assert (entry == far.argmin(1)).all() and (error == far.min(1)).all()


def test_label_errors(spark):
    rows = vectors(25, random.Random(10))
    done = vector_codes.encode(spark.createDataFrame(rows, SCHEMA), entries=4)
    assert done.groupBy("label").agg(F.sum("error")).count() == len({r[2] for r in rows})
