"""Left joins to a table with one row per key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with this many rows or more is spread over several join tasks.
HOT_ROWS = 1_000_000
# Number of hot keys looked for. A key outside the largest 10,000 holds less than one
# ten-thousandth of the rows, so this bounds what is broadcast and not what is joined.
MAX_HOT_KEYS = 10_000
# Rows without a key match nothing, so they may be spread over as many salts as there are numbers.
NULL_SALTS = 2**31 - 1


def hot_keys(counts: DataFrame, key: str, n: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, number of salts) of the largest keys: at most MAX_HOT_KEYS rows."""
    salts = F.ceil(F.col(n) / F.lit(hot_rows)) + 1
    return (
        counts.filter((F.col(n) >= hot_rows) & F.col(key).isNotNull())
        .orderBy(F.desc(n), key)
        .limit(MAX_HOT_KEYS)
        .select(key, salts.cast("int").alias("_salts"))
    )


def attach(
    detail: DataFrame,
    lookup: DataFrame,
    key: str,
    spread: Sequence[str],
    counts: DataFrame | None = None,
    n: str = "_n",
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join every ``detail`` row to the one ``lookup`` row of its key.

    Rows of a hot key get a salt hashed from the ``spread`` columns, and the key's lookup row is
    repeated once per salt, so the rows go to many tasks and the result stays the plain join's.
    ``counts`` may bring rows per key (column ``n``) where the caller has them; else they are
    counted here, with partial sums before the shuffle. Rows without a key match nothing and are
    spread too.
    """
    if counts is None:
        counts = detail.groupBy(key).agg(F.count(F.lit(1)).alias(n))
    hot = hot_keys(counts, key, n, hot_rows)
    piece = F.xxhash64(*spread)
    salted = (
        detail.join(F.broadcast(hot), key, "left")
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.pmod(piece, F.lit(NULL_SALTS)))
            .when(F.col("_salts").isNotNull(), F.pmod(piece, F.col("_salts")))
            .otherwise(F.lit(0))
            .cast("int"),
        )
        .drop("_salts")
    )
    repeated = (
        lookup.join(F.broadcast(hot), key, "left")
        .withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
        )
        .drop("_salts")
    )
    columns = [key, *[c for c in detail.columns if c != key]]
    columns += [c for c in lookup.columns if c != key]
    return salted.join(repeated, [key, "_salt"], how).select(*columns)

