"""Ranks without a single sorting task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rank:
    """``name`` = rank() over ([partition by within] order by column [desc] nulls last)."""

    name: str
    column: str
    descending: bool = True
    within: str | None = None


def with_ranks(df: DataFrame, key: str, *ranks: Rank) -> DataFrame:
    """Add rank columns for two-place rates to rows with a unique ``key``.

    A rank is 1 + the number of rows with a better value.  The column is DECIMAL(5,2), so a group
    has at most 199,999 distinct values however many rows it holds: the rows are counted per value
    (combined before the shuffle), the running total goes over those counts only, and each row
    looks its value up.  A plain ``rank()`` would send all rows, or a third of them for a crowded
    group, through one task.  All ranks share one count and one look-up, and no job runs while the plan is built.
    """
    for rank in ranks:
        dtype = df.schema[rank.column].dataType
        if not (isinstance(dtype, T.DecimalType) and dtype.precision <= 5):
            raise TypeError(f"{rank.column} must be DECIMAL(5,2) or narrower, not {dtype.simpleString()}")
    entries = [
        F.struct(
            F.lit(number).alias("rank"),
            (F.col(rank.within).cast("string") if rank.within else F.lit(None).cast("string")).alias("within"),
            (F.col(rank.column).cast("decimal(5,2)") * F.lit(-1 if rank.descending else 1)).alias("order"),
        )
        for number, rank in enumerate(ranks)
    ]
    values = df.select(F.col(key).alias("_key"), F.explode(F.array(*entries)).alias("e")).select("_key", "e.*")
    better = (
        Window.partitionBy("rank", "within").orderBy(F.asc_nulls_last("order")).rowsBetween(Window.unboundedPreceding, -1)
    )
    place = (F.coalesce(F.sum("count").over(better), F.lit(0)) + 1).cast("int").alias("place")
    names = ("rank", "within", "order")
    places = values.groupBy(*names).count().select(*[F.col(c).alias(f"_{c}") for c in names], place)
    same = F.col("rank") == F.col("_rank")
    for name in names[1:]:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    of_key = values.join(places, same).groupBy("_key").agg(
        *[F.max(F.when(F.col("rank") == number, F.col("place"))).alias(rank.name) for number, rank in enumerate(ranks)]
    )
    return df.join(of_key, F.col(key).eqNullSafe(F.col("_key")), "left").select(*df.columns, *[r.name for r in ranks])
