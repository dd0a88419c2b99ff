"""Mergeable states of the hourly fact: what is added up instead of computed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.functions.numeric import quotient2, true_count
from dockpulse.schemas import FACT_HOURLY, RATE

HOUR_KEYS = ("station_id", "snapshot_date", "snapshot_hour", "snapshot_day_of_week")

# Means by the name of the fact's column: the column whose sum and count they come from, and their type.
AMOUNTS = {
    "avg_bikes_available": "num_bikes_available",
    "avg_bikes_mechanical": "num_bikes_available_mechanical",
    "avg_bikes_ebike": "num_bikes_available_ebike",
    "avg_docks_available": "num_docks_available",
}
RATES = {"avg_occupancy_rate": "occupancy_rate", "avg_availability_rate": "availability_rate", "avg_service_rate": "service_rate"}
COUNTS = {"minutes_empty": "is_empty", "minutes_full": "is_full", "operational": "is_operational"}
PEAKS = {"peak_bikes_available": "num_bikes_available", "hour_end": "snapshot_timestamp"}
TROUGHS = {"trough_bikes_available": "num_bikes_available", "hour_start": "snapshot_timestamp"}


def _sums() -> dict[str, Column]:
    """Sums are whole numbers: amounts as they are, rates in hundredths."""
    out = {"num_snapshots": F.count(F.lit(1))}
    for name, column in (AMOUNTS | RATES).items():
        value = F.col(column).cast("bigint") if name in AMOUNTS else (F.col(column) * 100).cast("bigint")
        out |= {f"sum_{name}": F.sum(value), f"n_{name}": F.count(column)}
    return out | {name: true_count(flag) for name, flag in COUNTS.items()}


def hourly_state(staged: DataFrame) -> DataFrame:
    """One row per station, date and hour with sums, counts, minima and maxima."""
    ends = {n: F.max(c) for n, c in PEAKS.items()} | {n: F.min(c) for n, c in TROUGHS.items()}
    return staged.groupBy(*HOUR_KEYS).agg(*(c.alias(n) for n, c in (_sums() | ends).items()))


def merged(states: DataFrame) -> DataFrame:
    """States of the same hour as one.  The order of merging does not matter, nor how rows were dealt to states."""
    columns = [n for n in states.columns if n not in HOUR_KEYS]
    of = {n: F.max if n in PEAKS else F.min if n in TROUGHS else F.sum for n in columns}
    return states.groupBy(*HOUR_KEYS).agg(*(of[n](n).alias(n) for n in columns))


def hourly_from_states(states: DataFrame) -> DataFrame:
    """The hourly fact, equal to the one built from the rows."""
    means = {n: quotient2(F.col(f"sum_{n}"), F.col(f"n_{n}")) for n in AMOUNTS}
    for name in RATES:
        hundredths = F.col(f"sum_{name}").cast("decimal(24,0)") * F.lit(0.01).cast("decimal(3,2)")
        means[name] = quotient2(hundredths, F.col(f"n_{name}"), RATE)
    means["operational_pct"] = quotient2(F.col("operational") * 100, F.col("num_snapshots"), RATE)
    return merged(states).withColumns(means).select(*FACT_HOURLY.fieldNames())


STATE_SCHEMA = T.StructType(
    [T.StructField("station_id", T.StringType()), T.StructField("snapshot_hour", T.IntegerType())]
    + [T.StructField("snapshot_day_of_week", T.IntegerType()), T.StructField("num_snapshots", T.LongType())]
    + [T.StructField(f"{kind}_{n}", T.LongType()) for n in (*AMOUNTS, *RATES) for kind in ("sum", "n")]
    + [T.StructField(n, T.LongType()) for n in COUNTS]
    + [T.StructField(n, T.IntegerType()) for n in ("peak_bikes_available", "trough_bikes_available")]
    + [T.StructField(n, T.TimestampNTZType()) for n in ("hour_end", "hour_start")]
    + [T.StructField("snapshot_date", T.DateType())]
)
