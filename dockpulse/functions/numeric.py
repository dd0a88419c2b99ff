"""Exact half-up rounding to two places, as aggregates and as row expressions.

Sums stay in fixed-width buffers, so the aggregates keep partial hash aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockpulse.schemas import AMOUNT, RATE

_SUM = "decimal(24,2)"


def quotient2(total: Column, count: Column, dtype=AMOUNT) -> Column:
    """``total / count`` rounded to two places; NULL when the count is 0."""
    exact = total.cast(_SUM) / F.nullif(count, F.lit(0).cast("bigint"))
    return F.round(exact, 2).cast(dtype)


def mean2(column: str | Column, dtype=AMOUNT) -> Column:
    """Mean of an integer or decimal column, rounded once from the exact sum."""
    return quotient2(F.sum(column), F.count(column), dtype)


def share2(part: str | Column, whole: str | Column) -> Column:
    """``sum(part)`` as a percentage of ``sum(whole)``; NULL for an empty whole."""
    return quotient2(F.sum(part) * 100, F.sum(whole), RATE)


def true_count(flag: str | Column) -> Column:
    return F.count_if(F.col(flag) if isinstance(flag, str) else flag)


def true_pct(flag: str | Column) -> Column:
    """Percentage of rows whose flag is true; NULL flags count as false."""
    return quotient2(true_count(flag) * 100, F.count(F.lit(1)), RATE)


def capped_rate(part: Column, capacity: Column) -> Column:
    """``part / capacity`` in percent, two places, clamped to 0..100; 0 without capacity.

    Works on whole hundredths, which avoids a wide decimal division per row.
    """
    part, capacity = part.cast("bigint"), capacity.cast("bigint")
    hundredths = F.call_function("div", part * 20000 + capacity, capacity * 2)
    clamped = F.least(F.lit(10000).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), hundredths))
    whole = F.when(capacity > 0, clamped).otherwise(F.lit(0).cast("bigint"))
    return (whole.cast("decimal(5,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(RATE)


def int_or_zero(column: str | Column) -> Column:
    """Lenient integer cast; unreadable and missing values become 0."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.try_cast("int"), F.lit(0))
