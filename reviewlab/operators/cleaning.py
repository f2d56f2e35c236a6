"""Null handling, duplicates, timestamps and column choice."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.sources.schemas import TIMESTAMP_FORMAT

FLOATS = (T.FloatType, T.DoubleType)


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, FLOATS)


def missing(df: DataFrame, name: str, nan: bool = True) -> Column:
    """True where the column is null or, for float columns, NaN."""
    test = F.col(name).isNull()
    return test | F.isnan(name) if nan and is_float(df, name) else test


def _present(df: DataFrame, name: str) -> str:
    test = f"`{name}` IS NOT NULL"
    return f"{test} AND NOT isnan(`{name}`)" if is_float(df, name) else test


def drop_nulls(df: DataFrame, how: str = "any", subset: Iterable[str] | None = None) -> DataFrame:
    """Remove rows with any (or with only) missing values, NaN included.

    The result is that of ``na.drop``, but as one predicate per column: Catalyst can push each
    one below a join, and turn an outer join whose right side must be present into an inner one.
    """
    names = list(subset) if subset is not None else df.columns
    if how not in ("any", "all"):
        raise ValueError(f"how must be 'any' or 'all', not {how!r}")
    link = " AND " if how == "any" else " OR "
    return df.filter(link.join(f"({_present(df, c)})" for c in names))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct; repeats are folded in each partition before the shuffle."""
    return df.dropDuplicates()


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One whole row per key, the greatest by all its columns, whatever order the rows come in."""
    rest = [c for c in df.columns if c != key]
    greatest = df.groupBy(key).agg(F.max(F.struct(*rest)).alias("row"))
    return greatest.select(*(c if c == key else F.col("row")[c].alias(c) for c in df.columns))


def parse_timestamps(
    df: DataFrame, columns: Iterable[str], fmt: str = TIMESTAMP_FORMAT
) -> DataFrame:
    """Turn text columns into timestamps without time zone; bad text becomes null."""
    return df.withColumns(
        {
            c: F.try_to_timestamp(F.col(c), F.lit(fmt)).cast(T.TimestampNTZType())
            for c in columns
            if isinstance(df.schema[c].dataType, T.StringType)
        }
    )


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Remove the named columns; names the frame lacks are ignored."""
    return df.drop(*names)


def project(df: DataFrame, columns: Iterable[str] | dict[str, str]) -> DataFrame:
    """Keep the listed columns; a dict gives new name -> old name."""
    if isinstance(columns, dict):
        return df.select([F.col(old).alias(new) for new, old in columns.items()])
    return df.select(*columns)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def latest_per_key(
    df: DataFrame, key: str, order_by: str, tie_break: str | None = None
) -> DataFrame:
    """The row with the greatest ``order_by`` of every key; the larger ``tie_break`` wins a tie.

    An aggregate rather than a ranking window: each partition keeps one row per key before the
    shuffle, so a key that owns a third of the table costs no more than any other.
    """
    rank = F.struct(order_by, tie_break) if tie_break else F.col(order_by)
    return (
        df.filter(F.col(order_by).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), rank).alias("latest"))
        .select(key, "latest.*")
        .select(*df.columns)
    )
