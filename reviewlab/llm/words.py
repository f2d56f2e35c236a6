"""Native expressions on texts: lower case, words, and values bound once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands between words, and the letters A-Z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though a lambda in ``body`` uses it often."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Plain lower() does that where all characters are ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def folded(text: Column) -> Column:
    """Lower case of all letters, the same for a word whatever stands around it.

    Texts that agree after ascii_lower agree after this too, and it is much cheaper.
    """
    return F.replace(F.lower(text), F.lit("ς"), F.lit("σ"))


def split_words(lowered: Column) -> Column:
    """The words of a lower-case text, in order; null for null."""
    return F.filter(F.split(lowered, GAP), lambda w: w != "")


def with_next(values: Column, step: int, both: Callable[[Column, Column], Column]) -> Column:
    """Combine every element with the one ``step`` further on; the last ``step`` ones are void."""
    return F.transform(values, lambda x, i: both(x, F.get(values, i + F.lit(step))))


def sliding(
    values: Column, width: int, both: Callable[[Column, Column], Column], then: Callable
) -> Column:
    """``then`` of the combination of every ``width`` elements, by doubling.

    ``both`` must allow parts to overlap unless ``width`` is a power of two. The last
    ``width - 1`` elements are void.
    """
    done = 1

    def step(current: Column, done: int) -> Column:
        if done == width:
            return then(current)
        by = min(done, width - done)
        return bound(with_next(current, by, both), lambda c: step(c, done + by))

    return step(values, done)
