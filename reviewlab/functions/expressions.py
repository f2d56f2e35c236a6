"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are summed as decimals with this many places, which gives the same total whatever order
# the partitions arrive in. Those from 10^18 on are summed as whole numbers, which they are.
MONEY_SCALE = 10


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient that is null, not an error, when the divisor is zero."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def money_units(c: str | Column, scale: int = MONEY_SCALE) -> Column:
    """The amount as a decimal; null where it is no number or 10^18 or more."""
    return as_col(c).try_cast(f"decimal(28,{scale})")


def _large_units(c: str | Column, scale: int) -> Column:
    """An amount of 10^18 up to 10^28 as a whole number; null for any other."""
    return F.when(money_units(c, scale).isNull(), as_col(c).try_cast("decimal(28,0)"))


def _remainder(c: str | Column, scale: int) -> Column:
    """What the decimals lose of an amount: all of one from 10^28 on, and the later places of one
    so small that they matter (below 10^-5 for ten places). Else zero: the places that rounding
    takes from larger amounts are noise of binary fractions. Null for null, NaN and infinity,
    which are no amounts."""
    x = as_col(c).cast("double")
    units = money_units(c, scale).cast("double")
    lost = F.when(F.abs(x) < 10.0 ** -(scale / 2), x - units)
    lost = lost.when(units.isNotNull() | _large_units(c, scale).isNotNull(), 0.0).otherwise(x)
    return F.when(F.abs(x) < float("inf"), lost)


def money_total(c: str | Column, scale: int | None = MONEY_SCALE) -> Column:
    """Sum of a money column as double, null where there is no amount; NaN and infinity are none.

    The decimal parts are exact in any order; remainders are added as doubles. With ``scale`` None
    the whole sum is one of doubles.
    """
    if scale is None:
        return F.sum(as_col(c))
    parts = [F.sum(money_units(c, scale)), F.sum(_large_units(c, scale))]
    units, large = (F.coalesce(p.cast("double"), F.lit(0.0)) for p in parts)
    return large + units + F.sum(_remainder(c, scale))


def money_mean(c: str | Column, scale: int | None = MONEY_SCALE) -> Column:
    if scale is None:
        return F.avg(as_col(c))
    return F.try_divide(money_total(c, scale), F.count(_remainder(c, scale)))


def days_between(end: str | Column, start: str | Column) -> Column:
    """Calendar days from ``start`` to ``end``."""
    return F.datediff(as_col(end), as_col(start))


def elapsed_days(end: str | Column, start: str | Column) -> Column:
    """Days from ``start`` to ``end`` with their fraction, counted in whole seconds."""
    return F.timestamp_diff("SECOND", as_col(start), as_col(end)) / F.lit(86400)


def at_least(score: str | Column, threshold: float) -> Column:
    """1 when the score reaches the threshold, 0 when it does not, null when unknown."""
    score = as_col(score)
    return F.when(score >= threshold, 1).when(score.isNotNull(), 0)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 otherwise (also where it is unknown)."""
    return F.when(condition, 1).otherwise(0)


def joined_set(c: str | Column) -> Column:
    """The sorted distinct values of a group as one text."""
    return F.concat_ws(", ", F.array_sort(F.collect_set(as_col(c))))


def key_bucket(*keys: str | Column, buckets: int = 100, seed: int = 0) -> Column:
    """Bucket number 0..buckets-1 that depends on the key and the seed alone.

    MD5 rather than a Spark-only hash: any engine can repeat the assignment, and a recomputed
    partition always gets the same answer.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[as_col(k).cast("string") for k in keys])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets
    return bucket.cast("int") if buckets < 2**31 else bucket
