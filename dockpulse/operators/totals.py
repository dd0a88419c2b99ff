"""All-time totals of stations as sums of rounded daily values, to which days are added and from which they are taken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.functions.numeric import quotient2
from dockpulse.operators.gold import STATION_ATTRIBUTES, with_station_ranks
from dockpulse.schemas import AMOUNT, RATE

# Means of the summary by name: the daily column that they are the mean of, and their type.
MEANS = {
    "avg_occupancy_rate": ("avg_occupancy_rate", RATE),
    "avg_service_rate": ("avg_service_rate", RATE),
    "avg_bikes_available": ("avg_bikes_available", AMOUNT),
    "avg_docks_available": ("avg_docks_available", AMOUNT),
    "avg_operational_pct": ("daily_operational_pct", RATE),
    "avg_pct_time_empty": ("pct_time_empty", RATE),
    "avg_pct_time_full": ("pct_time_full", RATE),
    "avg_peak_hourly_occupancy": ("peak_hourly_occupancy", RATE),
}
SUMS = ("total_snapshots", "total_minutes_empty", "total_minutes_full")


def _amounts() -> dict[str, Column]:
    """What one daily row adds: values in hundredths, and whether they are there."""
    out = {"days_observed": F.lit(1).cast("bigint")} | {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in SUMS}
    for name, (column, _) in MEANS.items():
        out[f"sum_{name}"] = F.coalesce((F.col(column) * 100).cast("bigint"), F.lit(0).cast("bigint"))
        out[f"n_{name}"] = F.col(column).isNotNull().cast("bigint")
    return out


AMOUNT_COLUMNS = tuple(["days_observed", *SUMS, *(f"{k}_{n}" for n in MEANS for k in ("sum", "n"))])
ENDS = {"first_data_date": F.min, "last_data_date": F.max}


def station_totals(daily: DataFrame, sign: int = 1) -> DataFrame:
    """One row per station with the sums of its days; with ``sign`` -1 what their removal adds."""
    rows = daily.select("station_id", "snapshot_date", *[(c * sign).alias(n) for n, c in _amounts().items()])
    ends = [end("snapshot_date").alias(name) for name, end in ENDS.items()]
    return rows.groupBy("station_id").agg(*[F.sum(c).alias(c) for c in AMOUNT_COLUMNS], *ends)


def changed_totals(totals: DataFrame, before: DataFrame, after: DataFrame, daily: DataFrame) -> DataFrame:
    """Totals after the daily rows ``before`` were replaced by ``after``; ``daily`` is the daily fact by then.

    Sums follow by addition and subtraction.  First and last days can only be taken from stored days where one of them went:
    just the days of such stations are read from ``daily``.
    """
    no_ends = dict.fromkeys(ENDS, F.lit(None).cast("date"))
    parts = totals.unionByName(station_totals(after)).unionByName(station_totals(before, -1).withColumns(no_ends))
    ends = [end(name).alias(name) for name, end in ENDS.items()]
    summed = parts.groupBy("station_id").agg(*[F.sum(c).alias(c) for c in AMOUNT_COLUMNS], *ends).where("days_observed > 0")
    keys = ["station_id", "snapshot_date"]
    gone = before.select(*keys).join(after.select(*keys), keys, "left_anti")
    lost = gone.join(totals.select("station_id", *ENDS), "station_id").where("snapshot_date IN (first_data_date, last_data_date)")
    lost = lost.select("station_id").distinct()
    anew = daily.select(*keys).join(lost, "station_id", "left_semi").groupBy("station_id")
    anew = anew.agg(*[end("snapshot_date").alias(f"_{name}") for name, end in ENDS.items()])
    found = summed.join(anew, "station_id", "left")
    return found.withColumns({n: F.coalesce(f"_{n}", n) for n in ENDS}).select(*totals.columns)


def summary_from_totals(totals: DataFrame, dim: DataFrame) -> DataFrame:
    """``station_summary`` from the totals."""
    means = {n: quotient2((F.col(f"sum_{n}").cast("decimal(24,0)") * F.lit(0.01).cast("decimal(3,2)")), F.col(f"n_{n}"), kind) for n, (_, kind) in MEANS.items()}
    figures = totals.withColumns(means)
    names = (
        "days_observed", "total_snapshots", *ENDS, "avg_occupancy_rate", "avg_service_rate", "avg_bikes_available", "avg_docks_available",
        "avg_operational_pct", "avg_pct_time_empty", "avg_pct_time_full", "total_minutes_empty", "total_minutes_full", "avg_peak_hourly_occupancy",
    )
    return figures.join(dim.select("station_id", *STATION_ATTRIBUTES), "station_id").select("station_id", *STATION_ATTRIBUTES, *names)


def performance_from_totals(totals: DataFrame, dim: DataFrame) -> DataFrame:
    return with_station_ranks(summary_from_totals(totals, dim))
