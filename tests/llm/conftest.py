from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Columns that operators use inside, or add, under their own names.
CLASHES = ["key", "code", "node", "hits", "row", "_table", "signature", "component_id", "word", "size"]

LONG = " ".join(f"w{i % 977} of{i % 31}" for i in range(30_000)) + "."


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty and long texts, rows repeated in full, ties, a null key."""
    near = " ".join(f"word{i}" for i in range(60))
    return [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, "   \n\n ", None, None, 5),
        (4, LONG, "en", "a", len(LONG)),
        (5, near, "en", "a", len(near)),
        (5, near, "en", "a", len(near)),
        (6, near, "en", "b", len(near)),
        (7, near + " more", "en", "b", len(near) + 5),
        (None, near, "en", "b", len(near)),
        (8, "one", "en", "b", 3),
        (9, "mail a.b@c.example.org or +1 (042) 555-7845, again 042 555 7845", "en", "b", 60),
        (10, 'password = "abcdefghijkl" pwd: Xk9#mP2$vL8q', "en", "b", 40),
    ]


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *(F.lit("x").alias(c) for c in CLASHES))


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
