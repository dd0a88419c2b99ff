"""Incremental logic as DataFrame transformations; the sinks store the results."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.functions.clock import EMPTY_TARGET_DATE, lookback_start, wall_clock_now
from dockpulse.operators.gold import DISTRICT


def new_rows(incoming: DataFrame, existing: DataFrame, *keys: str) -> DataFrame:
    """Incoming rows whose key is not stored yet.

    The stored side is reduced to its keys first: a key with a third of all stored rows is one row of the join.
    """
    stored = existing.select(*keys).distinct()
    return incoming.join(stored, list(keys), "left_anti").select(*incoming.columns)


def matching(left: DataFrame, right: DataFrame, how: str, *keys: str) -> DataFrame:
    """Semi- or anti-join by keys where NULL equals NULL."""
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return left.join(other, same, how)


def without_stored(rows: DataFrame, stored: DataFrame, *keys: str) -> DataFrame:
    return matching(rows, stored, "left_anti", *keys)


def batch_bounds(batch: DataFrame, *more: Column) -> DataFrame:
    """Time bounds and size of a batch, with ``more`` aggregates; the scan is pruned to the timestamp."""
    return batch.agg(
        F.min("snapshot_timestamp").alias("min_ts"),
        F.max("snapshot_timestamp").alias("max_ts"),
        F.count(F.lit(1)).alias("rows"),
        *more,
    )


def replace_by_key(target: DataFrame, batch: DataFrame, *keys: str) -> DataFrame:
    """Target rows whose key the batch does not carry, followed by the batch."""
    return new_rows(target, batch, *keys).unionByName(batch.select(*target.columns))


def rebuild_from(target: DataFrame | None, column: str = "snapshot_date", days: int = 1) -> date:
    """First day an incremental run rebuilds, as a literal so that partitions prune statically."""
    if target is None:
        return date.fromisoformat(EMPTY_TARGET_DATE)
    return target.agg(lookback_start(column, days).alias("start")).first()["start"]


def filter_from(source: DataFrame, start: date, column: str = "snapshot_date", days: Iterable[date] = ()) -> DataFrame:
    """Rows from a day on, and of the given earlier days; both are literals, so that partitions prune statically."""
    wanted = F.col(column) >= F.lit(start)
    earlier = sorted(day for day in days if day < start)
    if earlier:
        wanted = wanted | F.col(column).isin(*[F.lit(day) for day in earlier])
    return source.where(wanted)


def filter_days(source: DataFrame, days: Iterable[date], column: str = "snapshot_date") -> DataFrame:
    """Rows of the given days, as literals, so that partitions prune statically."""
    return source.where(F.col(column).isin(*[F.lit(day) for day in days]))


def update_attribute(
    rows: DataFrame, updates: DataFrame, key: str = "station_id", column: str = DISTRICT, now: Column | None = None
) -> DataFrame:
    """Set ``column`` from ``updates(key, column)`` where it differs; ``updated_at`` moves only then."""
    now = wall_clock_now() if now is None else now
    wanted = updates.select(F.col(key).alias("_key"), F.col(column).alias("_wanted"))
    joined = rows.join(wanted, F.col(key) == F.col("_key"), "left")
    changed = F.col("_wanted").isNotNull() & ~F.col("_wanted").eqNullSafe(F.col(column))
    return joined.withColumns(
        {
            "updated_at": F.when(changed, now).otherwise(F.col("updated_at")),
            column: F.when(changed, F.col("_wanted")).otherwise(F.col(column)),
        }
    ).select(*rows.columns)
