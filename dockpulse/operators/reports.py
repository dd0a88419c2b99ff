"""Load validation, summaries and dashboard queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.functions.clock import hour_floor
from dockpulse.functions.numeric import mean2
from dockpulse.operators.gold import DISTRICT
from dockpulse.schemas import RATE


def filter_hour_window(df: DataFrame, start: str | Column, hours: int = 1, column: str = "snapshot_timestamp") -> DataFrame:
    """Half-open window ``[start, start + hours)``; the date predicate prunes stored partitions."""
    begin = F.lit(start).cast("timestamp_ntz") if isinstance(start, str) else start
    end = begin + F.make_dt_interval(hours=F.lit(hours))
    window = df.where((F.col(column) >= begin) & (F.col(column) < end))
    if "snapshot_date" in df.columns and column == "snapshot_timestamp":
        window = window.where((F.col("snapshot_date") >= F.to_date(begin)) & (F.col("snapshot_date") <= F.to_date(end)))
    return window


def filter_last_hours(df: DataFrame, as_of: Column, hours: int = 24, column: str = "snapshot_timestamp") -> DataFrame:
    """Rows of the ``hours`` before ``as_of`` and later; the date predicate prunes stored partitions."""
    begin = as_of - F.make_dt_interval(hours=F.lit(hours))
    recent = df.where(F.col(column) >= begin)
    if "snapshot_date" in df.columns and column == "snapshot_timestamp":
        recent = recent.where(F.col("snapshot_date") >= F.to_date(begin))
    return recent


def latest_timestamp(availability: DataFrame):
    """The newest timestamp of a table stored by day: the newest day from the partition column, then that day's rows alone."""
    newest = availability.agg(F.max("snapshot_date")).first()[0]
    return availability.where(F.col("snapshot_date") == F.lit(newest)).agg(F.max("snapshot_timestamp")).first()[0]


def load_validation(window: DataFrame) -> DataFrame:
    """Rows, stations and time bounds of a loaded window."""
    return window.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("station_id").alias("unique_stations"),
        F.min("snapshot_timestamp").alias("earliest"),
        F.max("snapshot_timestamp").alias("latest"),
    )


def require_rows(window: DataFrame, what: str):
    """The validation row; raises when the window is empty."""
    row = load_validation(window).first()
    if row["total_rows"] == 0:
        raise ValueError(f"no Silver rows for {what}")
    return row


def hourly_loads(availability: DataFrame) -> DataFrame:
    return availability.groupBy(hour_floor("snapshot_timestamp").alias("snapshot_hour")).agg(
        F.count(F.lit(1)).alias("rows_added"), F.count_distinct("station_id").alias("stations_count")
    )


def latest_hours(availability: DataFrame, k: int = 5) -> DataFrame:
    return hourly_loads(availability).orderBy(F.desc("snapshot_hour")).limit(k)


def district_counts(stations: DataFrame) -> DataFrame:
    """Stations per Paris district, most first."""
    return (
        paris_stations(stations)
        .groupBy(DISTRICT)
        .agg(F.count(F.lit(1)).alias("stations"))
        .orderBy(F.desc("stations"), F.asc(DISTRICT))
    )


def paris_stations(stations: DataFrame) -> DataFrame:
    return stations.where(F.lower(F.coalesce(DISTRICT, F.lit(""))).startswith("paris"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, as a union of one-row summaries."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()]
    union = counts[0]
    for other in counts[1:]:
        union = union.unionByName(other)
    return union


def network_pressure(hourly: DataFrame) -> DataFrame:
    """Mean occupancy of the network per date and hour."""
    return hourly.groupBy("snapshot_date", "snapshot_hour").agg(mean2("avg_occupancy_rate", RATE).alias("avg_occupancy_rate"))


def most_empty_stations(performance: DataFrame, k: int = 10) -> DataFrame:
    """Stations most often empty; the station name breaks ties."""
    return (
        performance.groupBy("station_name")
        .agg(mean2("avg_pct_time_empty", RATE).alias("avg_pct_time_empty"))
        .orderBy(F.desc("avg_pct_time_empty"), F.asc("station_name"))
        .limit(k)
    )


def district_hour_heatmap(peak_hours: DataFrame) -> DataFrame:
    return peak_hours.groupBy(DISTRICT, "snapshot_hour").agg(mean2("avg_occupancy_rate", RATE).alias("avg_occupancy_rate"))
