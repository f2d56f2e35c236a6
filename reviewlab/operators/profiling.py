"""Table profiles: schema, nulls, distinct counts, frequencies, descriptions, previews."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.operators.cleaning import is_float, missing


def _numeric(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    if columns is not None:
        return list(columns)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def unpivot_row(row: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One wide row of ``<name>__<field>`` columns as one line per name."""
    structs = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"`{n}__{f}`").alias(f) for f in fields])
        for n in names
    ]
    return row.select(F.inline(F.array(*structs)))


# -- rows and schema --------------------------------------------------------------------------


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type, rows and non-null rows of every column, in one pass."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("rows"),
            F.col(f"`{f.name}`").alias("filled"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return row.select(F.inline(F.array(*lines)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, n: int = 20, key: str | Sequence[str] | None = None) -> DataFrame:
    """The first n rows in key order (all columns by default), the same on every run."""
    keys = [key] if isinstance(key, str) else list(key or df.columns)
    return df.orderBy(*keys).limit(n)


def sorted_report(
    df: DataFrame, by: str, tie_break: Sequence[str], descending: bool = True
) -> DataFrame:
    """Total order. The tie-break columns let the range partitioner split equal ``by`` values."""
    first = F.desc(by) if descending else F.asc(by)
    return df.orderBy(first, *tie_break)


def top_k(df: DataFrame, by: str, k: int = 10, tie_break: Sequence[str] = ()) -> DataFrame:
    """The k largest rows; each partition keeps k, so nothing is sorted as a whole."""
    return df.orderBy(F.desc(by), *tie_break).limit(k)


# -- nulls, keys ------------------------------------------------------------------------------


def null_counts(df: DataFrame, nan: bool = False) -> DataFrame:
    """One row with the number of null (with ``nan``: null or NaN) values of each column."""
    return df.agg(*[F.count_if(missing(df, c, nan)).alias(c) for c in df.columns])


def null_nan_counts(df: DataFrame) -> DataFrame:
    return null_counts(df, nan=True)


def distinct_count(
    df: DataFrame, columns: Iterable[str], approximate: bool = False, rsd: float = 0.05
) -> DataFrame:
    """One row with the number of distinct values of each column, nulls left out.

    Exact counts are one grouped pass per column, over that column alone: no row is multiplied by
    the number of columns before the shuffle. Approximate ones are sketches from a single pass.
    """
    names = list(columns)
    if approximate:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in names])
    counts = [
        df.select(F.col(c).alias("v")).distinct().agg(F.count("v")).scalar().alias(c) for c in names
    ]
    return df.sparkSession.range(1).select(*counts)


def distinct_sketches(
    df: DataFrame, columns: Iterable[str], by: Sequence[str] = (), lg_k: int = 12
) -> DataFrame:
    """A sketch of the distinct values of each column, per group, from one pass.

    Sketches can be stored and merged later (``merged_distinct``), so new data needs no second look
    at old rows. The relative standard error is about 1.04 / sqrt(2 ** lg_k), 1.6 % for 12.
    """
    kept = []
    for c in columns:
        # 0.0 and -0.0 are one value, as in a grouping
        value = F.col(c) + 0.0 if is_float(df, c) else F.col(c)
        kept.append(F.hll_sketch_agg(value.cast("string"), lg_k).alias(c))
    return df.groupBy(*by).agg(*kept)


def merged_distinct(sketches: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row with the approximate number of distinct values behind all sketches of a column."""
    return sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def key_repeats(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The keys held by more than one row, with their number of rows."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def grain_check(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows, distinct keys, and keys held by several rows, side by side."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    )


def assert_unique_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The frame itself, after a check that no key occurs twice."""
    bad = key_repeats(df, key).head(1)
    if bad:
        raise ValueError(f"key {key} is not unique, for instance {bad[0].asDict()}")
    return df


# -- frequencies ------------------------------------------------------------------------------


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def share_of_total(df: DataFrame, column: str, decimals: int = 1) -> DataFrame:
    """Frequency of each value and its percentage of all rows."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n")).scalar()  # of the counts, not of the rows once more
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, decimals))


def pivot_counts(
    df: DataFrame, row: str, column: str, values: Sequence, prefix: str = ""
) -> DataFrame:
    """Rows by ``row``, one count column per value of ``column``, 0 where there is none."""
    return df.groupBy(row).agg(
        *[F.count_if(F.col(column) == v).alias(f"{prefix}{v}") for v in values]
    )


def histogram(
    df: DataFrame, column: str, bins: int = 5, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Equal-width frequencies from ``low`` to ``high`` (by default the data's range).

    As in a plot's histogram the last bin includes its upper edge, values outside the range are
    not counted, and empty bins are listed.
    """
    x = F.col(column).cast("double")
    lo = F.lit(float(low)) if low is not None else df.agg(F.min(x)).scalar()
    hi = F.lit(float(high)) if high is not None else df.agg(F.max(x)).scalar()
    step = (hi - lo) / bins
    number = F.coalesce(F.floor(F.try_divide(x - lo, step)), F.lit(0))
    counted = (
        df.filter(x.between(lo, hi))
        .groupBy(F.least(number, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .join(counted, "bin", "left")
        .select(
            "bin",
            (lo + F.col("bin") * step).alias("low"),
            (lo + (F.col("bin") + 1) * step).alias("high"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


# -- descriptions -----------------------------------------------------------------------------

DESCRIBE_FIELDS = ["count", "mean", "stddev", "min", "max"]


def describe(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, least and greatest value of each numeric column.

    All columns are measured in one pass; the report has one line per column.
    """
    names = _numeric(df, columns)
    measures = {
        "count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    cells = [
        f(c).cast("long" if field == "count" else "double").alias(f"{c}__{field}")
        for c in names
        for field, f in measures.items()
    ]
    return unpivot_row(df.agg(*cells), names, DESCRIBE_FIELDS)


def describe_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Count, least and greatest value of text columns."""
    names = list(columns)
    cells = [
        f(c).alias(f"{c}__{field}")
        for c in names
        for field, f in {"count": F.count, "min": F.min, "max": F.max}.items()
    ]
    return unpivot_row(df.agg(*cells), names, ["count", "min", "max"])
