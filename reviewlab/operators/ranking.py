"""Running totals over a whole table in value order.

A window without a partition key would move the table to one task. Here the value range is cut
into buckets of about equal row count; totals run inside each bucket in parallel, and the sums of
the earlier buckets, one row per bucket, are added to them. The cut points only balance the work:
the totals are exact wherever they lie.

A bucket with more than ``BUCKET_ROWS`` rows of differing values is cut again by the quantiles of
its own rows, until there is none, so a bucket's work doesn't grow with the table; a value that is
very frequent gets a bucket to itself, in which there is nothing to order. There is about one bucket
for every ``BUCKET_ROWS`` rows, and one number for each on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Least number of buckets; a session with more shuffle partitions gets one for each of them. The
# first pass makes no more than MAX_BUCKETS, the later ones as many as the rows need.
MIN_BUCKETS = 256
MAX_BUCKETS = 10_000
BUCKET_ROWS = 1_000_000
# A bucket that is too full is cut into so many at a time.
SPLITS = 16


def bucket_number(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(MIN_BUCKETS, partitions), MAX_BUCKETS)


def cut_points(
    df: DataFrame,
    columns: Sequence[str],
    buckets: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> list[list[float]]:
    """Ascending bucket edges per column, from one approximate-quantile pass and refinement."""
    edges = first_cuts(df, columns, buckets)
    if df.limit(bucket_rows + 1).count() <= bucket_rows:
        return edges
    while (finer := refined(df, columns, edges, bucket_rows)) != edges:
        edges = finer
    return edges


def refined(
    df: DataFrame, columns: Sequence[str], edges: Sequence[Sequence[float]], bucket_rows: int
) -> list[list[float]]:
    """The edges, with more of them inside the buckets that are too full."""
    values = bucketed_long(df, columns, edges)
    full = values.groupBy("column", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    full = full.filter((F.col("n") > bucket_rows) & (F.col("low") < F.col("high")))
    found = full.collect()  # fewer than the rows / bucket_rows
    if not found:
        return [list(e) for e in edges]
    places = [(r["column"], r["bucket"]) for r in found]
    wanted = df.sparkSession.createDataFrame(places, "column string, bucket int")
    shares = [i / SPLITS for i in range(1, SPLITS)]
    inner = (
        values.join(F.broadcast(wanted), ["column", "bucket"])
        .groupBy("column", "bucket")
        .agg(F.percentile_approx("value", shares, 10 * SPLITS).alias("cuts"))
    )
    cuts = {(r["column"], r["bucket"]): r["cuts"] for r in inner.collect()}
    finer = [set(e) for e in edges]
    for r in found:
        own = cuts[r["column"], r["bucket"]]
        # a value on several cuts is frequent: it is cut off from the next greater one
        often = [c for c in set(own) if own.count(c) > 1]
        new = {*own, *(math.nextafter(c, math.inf) for c in [*often, r["low"]])}
        finer[columns.index(r["column"])] |= {c for c in new if r["low"] < c <= r["high"]}
    return [sorted(e) for e in finer]


def first_cuts(
    df: DataFrame, columns: Sequence[str], buckets: int | None = None
) -> list[list[float]]:
    buckets = buckets or bucket_number(df)
    probabilities = [i / buckets for i in range(1, buckets)]
    found = df.approxQuantile(list(columns), probabilities, 0.5 / buckets)
    edges = []
    for quantiles in found:
        inner = sorted(set(quantiles) - {float("inf"), float("-inf")})
        edges.append([float("-inf"), *(inner or [0.0]), float("inf")])
    return edges


def bucketed(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Add the number of the bucket that holds the value."""
    cutter = Bucketizer(splits=list(edges), inputCol=value, outputCol="_b")
    return cutter.transform(df).withColumn("bucket", F.col("_b").cast("int")).drop("_b")


def bucketed_long(
    df: DataFrame, columns: Sequence[str], edges: Sequence[Sequence[float]]
) -> DataFrame:
    """(column, bucket, value) of several columns from one scan; null and NaN are left out."""
    numbers = [f"_b{i}" for i in range(len(columns))]
    cutter = Bucketizer(
        splitsArray=[list(e) for e in edges],
        inputCols=list(columns),
        outputCols=numbers,
        handleInvalid="keep",
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"), F.col(b).cast("int").alias("bucket"), F.col(c).alias("value")
        )
        for c, b in zip(columns, numbers)
    ]
    return (
        cutter.transform(df)
        .select(F.inline(F.array(*lines)))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def _earlier(column: str, window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0).cast("long"))


def bucket_offsets(
    sums: DataFrame, by: Sequence[str], weights: Sequence[str], descending: bool
) -> DataFrame:
    """Per bucket its own sums, those of the buckets before it, and those of all.

    ``sums`` holds one row per bucket (and per column, of which there are a few).
    """
    order = F.desc("bucket") if descending else F.asc("bucket")
    # constant key when there is no other: the frame holds one row per bucket at most
    keys = list(by) or [F.lit(0)]
    running = Window.partitionBy(*keys).orderBy(order)
    whole = Window.partitionBy(*keys)
    return sums.select(
        *by,
        "bucket",
        *[F.col(w).alias(f"{w}_bucket") for w in weights],
        *[_earlier(w, running).alias(f"{w}_offset") for w in weights],
        *[F.sum(w).over(whole).alias(f"{w}_all") for w in weights],
    )


def running_totals(
    df: DataFrame,
    value: str,
    weights: dict[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """One row per distinct value with each weight's sum, running total and grand total.

    ``df`` is already bucketed; ``weights`` are count-like aggregates. For a weight ``w`` the
    result has ``w`` (the value's own sum), ``w_before`` (sum over the values that come earlier)
    and ``w_all``. Equal values are summed before anything is shuffled.
    """
    names = list(weights)
    group = [*by, "bucket"]
    per_value = df.groupBy(*group, value).agg(*[a.alias(n) for n, a in weights.items()])
    sums = per_value.groupBy(*group).agg(*[F.sum(n).alias(n) for n in names])
    offsets = bucket_offsets(sums, by, names, descending)
    inside = Window.partitionBy(*group).orderBy(F.desc(value) if descending else F.asc(value))
    # one row per bucket (and column): the rows of the table / BUCKET_ROWS, or MAX_BUCKETS
    joined = per_value.join(F.broadcast(offsets), group)
    return joined.select(
        *by,
        value,
        *names,
        *[(_earlier(n, inside) + F.col(f"{n}_offset")).alias(f"{n}_before") for n in names],
        *[F.col(f"{n}_all") for n in names],
    )
