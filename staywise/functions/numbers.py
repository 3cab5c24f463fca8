"""Expressions that make and combine numbers.

ANSI mode raises on a bad cast and on division by zero, so every cast and division here is a guarded one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from staywise.values import NUMBER_PATTERN, WHITESPACE


def _nan_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(float("nan")))


def to_number(col: Column) -> Column:
    """Text as double, null when it is not wholly a number.

    The pattern is needed because a cast alone takes ``"12d"`` for 12 and ``"nan"`` for NaN. NaN from any
    source becomes null, so that it cannot poison an average or win a maximum.
    """
    text = F.btrim(col.cast("string"), F.lit(WHITESPACE))
    return _nan_to_null(F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double")))


def zero_if_missing(col: Column) -> Column:
    """Number with 0 in place of null or NaN."""
    return F.coalesce(_nan_to_null(col.cast("double")), F.lit(0.0))


def parse_percent(col: Column) -> Column:
    """``"5%"``, ``"1,2 %"`` or ``"3"`` as a fraction. Always divides by 100, with or without the sign."""
    text = F.replace(F.replace(col.cast("string"), F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    return to_number(text) / F.lit(100.0)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null when the denominator is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def row_mean(cols: Sequence[Column]) -> Column:
    """Mean over the non-null values of one row; null when all are null."""
    total = reduce(add, (F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols))
    present = reduce(add, (c.isNotNull().cast("int") for c in cols))
    return F.try_divide(total, present.cast("double"))


def difference(current: Column, previous: Column) -> Column:
    """Change from ``previous`` to ``current``; null when either is null."""
    return current.cast("double") - previous.cast("double")
