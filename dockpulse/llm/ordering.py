"""Places of rows in an order, without a sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockpulse.session import stage


def placed(rows: DataFrame, order: list[str], group: str | None = None, weight: str | None = None) -> DataFrame:
    """``rows`` with ``place`` (0, 1, ... in ``order``) and ``total`` (rows), each within ``group``; with ``weight`` also ``before``.

    ``before`` is the sum of the weights of the rows before.  Rows are dealt by ranges of group and order, so a group with a
    third of all rows spans many tasks.  One narrow row for each range and group carries the counts from range to range.  Null
    is a group of its own, and comes first in any order.  ``rows`` is read twice, so pass a stored table; rows that are equal
    in ``order`` need a number of their own there, if they are to come out alike each time.
    """
    keys = [*([group] if group else []), *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), "ordered").withColumn("_part", F.shiftright("_at", 33))
    by = [group] if group else []
    counts = ordered.groupBy(*by, "_part").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"), (F.sum(weight) if weight else F.lit(0)).alias("_w")
    )
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(g).alias("_group") for g in by],
        F.col("_part").alias("_range"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_sum"),
        F.sum("_n").over(whole).alias("total"),
    )
    match = F.col("_part") == F.col("_range")
    if group:
        match = match & F.col(group).eqNullSafe(F.col("_group"))
    found = ordered.join(starts, match).withColumn("place", F.col("_at") + F.col("_shift"))
    if weight:
        inner = Window.partitionBy("_part", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn("before", F.col("_sum") + F.coalesce(F.sum(weight).over(inner), F.lit(0)))
    return found.drop("_at", "_part", "_range", "_shift", "_sum", "_group")
