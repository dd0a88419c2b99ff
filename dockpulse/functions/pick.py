"""Arg-max helpers with a defined winner among ties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_by_desc(pick: str, order: str) -> Column:
    """Value of ``pick`` where ``order`` is highest; the lowest value wins a tie."""
    return F.max_by(pick, F.struct(F.col(order), -F.col(pick)))


def peak_hour(hour: str, rate: str) -> Column:
    """As ``first_by_desc`` for an hour 0..23 and a two-place rate.

    Packing both into one integer keeps the aggregation buffer fixed-width (hash aggregation);
    an ordering struct would force a sort.
    """
    packed = (F.col(rate) * 100).cast("int") * 24 + (23 - F.col(hour))
    return F.max_by(hour, packed)


def distinct_hours(hour: str) -> Column:
    """Exact number of distinct hours 0..23, without the second shuffle of a distinct count."""
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1), F.col(hour)))
    return F.coalesce(F.bit_count(mask), F.lit(0)).cast("bigint")


def first_of_array(pick: str, order: str) -> Column:
    """``first_by_desc`` by way of a sorted array; for groups known to be small."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col(order)).alias("o"), F.col(pick).alias("p"))))
    return F.element_at(ordered, 1)["p"]
