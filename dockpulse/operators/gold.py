"""Gold models: staging filters, dimension, facts and marts.

Wherever a model joins a fact to the station dimension and groups, the fact is reduced to the
join key first.  The join then sees one row per station (and hour), not the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockpulse.functions.clock import wall_clock_now
from dockpulse.functions.numeric import mean2, quotient2, share2, true_count, true_pct
from dockpulse.functions.pick import distinct_hours, peak_hour
from dockpulse.functions.text import capacity_category, city_label
from dockpulse.operators.ranking import Rank, with_ranks
from dockpulse.schemas import AVAILABILITY_STORED, FACT_DAILY, FACT_HOURLY, RATE, STATIONS

DISTRICT = "district_municipality_names"


def stg_stations(stations: DataFrame) -> DataFrame:
    audit = {"created_at", "updated_at"}
    return stations.where(
        F.col("station_id").isNotNull() & (F.col("capacity") > 0) & F.col("is_active")
    ).select(*[c for c in STATIONS.fieldNames() if c not in audit])


def stg_availability(availability: DataFrame) -> DataFrame:
    return availability.where(F.col("station_id").isNotNull() & F.col("is_installed")).select(
        *[c for c in AVAILABILITY_STORED.fieldNames() if c != "processing_timestamp"]
    )


def dim_stations(stations: DataFrame) -> DataFrame:
    return stg_stations(stations).withColumns(
        {
            "capacity_category": capacity_category("capacity"),
            "city": city_label(DISTRICT),
            "built_at": wall_clock_now(),
        }
    )


def hourly_measures() -> list[Column]:
    """Aggregates of the hourly fact; every buffer is fixed-width, so this is hash aggregation."""
    return [
        F.count(F.lit(1)).alias("num_snapshots"),
        mean2("num_bikes_available").alias("avg_bikes_available"),
        mean2("num_bikes_available_mechanical").alias("avg_bikes_mechanical"),
        mean2("num_bikes_available_ebike").alias("avg_bikes_ebike"),
        mean2("num_docks_available").alias("avg_docks_available"),
        mean2("occupancy_rate", RATE).alias("avg_occupancy_rate"),
        mean2("availability_rate", RATE).alias("avg_availability_rate"),
        mean2("service_rate", RATE).alias("avg_service_rate"),
        F.max("num_bikes_available").alias("peak_bikes_available"),
        F.min("num_bikes_available").alias("trough_bikes_available"),
        true_count("is_empty").alias("minutes_empty"),
        true_count("is_full").alias("minutes_full"),
        true_pct("is_operational").alias("operational_pct"),
        F.min("snapshot_timestamp").alias("hour_start"),
        F.max("snapshot_timestamp").alias("hour_end"),
    ]


def fact_hourly(staged: DataFrame) -> DataFrame:
    """One row per station, date and hour."""
    hourly = staged.groupBy("station_id", "snapshot_date", "snapshot_hour", "snapshot_day_of_week").agg(
        *hourly_measures()
    )
    return hourly.select(*FACT_HOURLY.fieldNames())


def fact_daily(hourly: DataFrame) -> DataFrame:
    """One row per station and date.  Averages are unweighted means of the rounded hourly values."""
    daily = hourly.groupBy("station_id", "snapshot_date").agg(
        distinct_hours("snapshot_hour").alias("active_hours"),
        F.sum("num_snapshots").alias("total_snapshots"),
        mean2("avg_bikes_available").alias("avg_bikes_available"),
        mean2("avg_docks_available").alias("avg_docks_available"),
        mean2("avg_occupancy_rate", RATE).alias("avg_occupancy_rate"),
        mean2("avg_availability_rate", RATE).alias("avg_availability_rate"),
        mean2("avg_service_rate", RATE).alias("avg_service_rate"),
        F.max("avg_bikes_available").alias("peak_hourly_avg_bikes"),
        F.min("avg_bikes_available").alias("trough_hourly_avg_bikes"),
        F.max("avg_occupancy_rate").alias("peak_hourly_occupancy"),
        peak_hour("snapshot_hour", "avg_occupancy_rate").alias("peak_hour"),
        F.sum("minutes_empty").alias("total_minutes_empty"),
        F.sum("minutes_full").alias("total_minutes_full"),
        share2("minutes_empty", "num_snapshots").alias("pct_time_empty"),
        share2("minutes_full", "num_snapshots").alias("pct_time_full"),
        mean2("operational_pct", RATE).alias("daily_operational_pct"),
    )
    return daily.select(*FACT_DAILY.fieldNames())


def daily_station_stats(availability: DataFrame) -> DataFrame:
    """Daily view straight from Silver."""
    return availability.groupBy("station_id", "snapshot_date").agg(
        F.count(F.lit(1)).alias("num_snapshots"),
        mean2("num_bikes_available").alias("avg_bikes_available"),
        mean2("num_docks_available").alias("avg_docks_available"),
        mean2("occupancy_rate", RATE).alias("avg_occupancy_rate"),
        mean2("service_rate", RATE).alias("avg_service_rate"),
        F.max("num_bikes_available").alias("max_bikes_available"),
        F.min("num_bikes_available").alias("min_bikes_available"),
        true_count("is_empty").alias("times_empty"),
        true_count("is_full").alias("times_full"),
        true_pct("is_operational").alias("operational_pct"),
    )


STATION_ATTRIBUTES = (
    "station_name",
    DISTRICT,
    "city",
    "capacity",
    "capacity_category",
    "latitude",
    "longitude",
)


def station_summary(daily: DataFrame, dim: DataFrame) -> DataFrame:
    """Whole-history figures per station; the daily fact is reduced before it meets the dimension.

    The daily fact has one row per station and date, so its days are counted in one pass, without the second shuffle of a
    distinct count.
    """
    figures = daily.groupBy("station_id").agg(
        F.count("snapshot_date").alias("days_observed"),
        F.sum("total_snapshots").alias("total_snapshots"),
        F.min("snapshot_date").alias("first_data_date"),
        F.max("snapshot_date").alias("last_data_date"),
        mean2("avg_occupancy_rate", RATE).alias("avg_occupancy_rate"),
        mean2("avg_service_rate", RATE).alias("avg_service_rate"),
        mean2("avg_bikes_available").alias("avg_bikes_available"),
        mean2("avg_docks_available").alias("avg_docks_available"),
        mean2("daily_operational_pct", RATE).alias("avg_operational_pct"),
        mean2("pct_time_empty", RATE).alias("avg_pct_time_empty"),
        mean2("pct_time_full", RATE).alias("avg_pct_time_full"),
        F.sum("total_minutes_empty").alias("total_minutes_empty"),
        F.sum("total_minutes_full").alias("total_minutes_full"),
        mean2("peak_hourly_occupancy", RATE).alias("avg_peak_hourly_occupancy"),
    )
    return figures.join(dim.select("station_id", *STATION_ATTRIBUTES), "station_id").select(
        "station_id", *STATION_ATTRIBUTES, *[c for c in figures.columns if c != "station_id"]
    )


GLOBAL_RANKS = (
    Rank("global_occupancy_rank", "avg_occupancy_rate"),
    Rank("most_empty_rank", "avg_pct_time_empty"),
    Rank("most_full_rank", "avg_pct_time_full"),
    Rank("least_reliable_rank", "avg_operational_pct", descending=False),
)
DISTRICT_RANK = Rank("district_occupancy_rank", "avg_occupancy_rate", within=DISTRICT)


def with_station_ranks(summary: DataFrame) -> DataFrame:
    """Four network-wide ranks and one per district (1 = busiest or most stressed)."""
    return with_ranks(summary, "station_id", *GLOBAL_RANKS, DISTRICT_RANK)


def mart_station_performance(daily: DataFrame, dim: DataFrame) -> DataFrame:
    return with_station_ranks(station_summary(daily, dim)).withColumn("built_at", wall_clock_now())


def district_hour_summary(hourly: DataFrame, dim: DataFrame) -> DataFrame:
    """District x city x weekday x hour figures.

    First per station, weekday and hour (sums and counts), then across the stations of a
    district, so both the join and the district shuffle are independent of the history's length.
    A station appears once per weekday and hour by then, hence the plain station count.
    """
    slot = ("snapshot_day_of_week", "snapshot_hour")
    means = ("avg_occupancy_rate", "avg_availability_rate", "avg_bikes_available", "avg_docks_available")
    sums = ("num_snapshots", "minutes_empty", "minutes_full")
    per_station = hourly.groupBy("station_id", *slot).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.sum(c).alias(f"{c}_sum") for c in means],
        *[F.count(c).alias(f"{c}_n") for c in means],
    )

    def mean_of_parts(column: str) -> Column:
        dtype = RATE if column.endswith("_rate") else None
        total, count = F.sum(f"{column}_sum"), F.sum(f"{column}_n")
        return (quotient2(total, count, dtype) if dtype else quotient2(total, count)).alias(column)

    return (
        per_station.join(dim.select("station_id", DISTRICT, "city"), "station_id")
        .groupBy(DISTRICT, "city", *slot)
        .agg(
            F.count("station_id").alias("num_stations"),
            F.sum("num_snapshots").alias("total_snapshots"),
            *[mean_of_parts(c) for c in means],
            share2("minutes_empty", "num_snapshots").alias("pct_station_minutes_empty"),
            share2("minutes_full", "num_snapshots").alias("pct_station_minutes_full"),
        )
    )


def mart_peak_hours(hourly: DataFrame, dim: DataFrame) -> DataFrame:
    """Adds the hour's rank within its district and weekday (at most 24 rows per group and city)."""
    order = Window.partitionBy(DISTRICT, "snapshot_day_of_week").orderBy(F.desc_nulls_last("avg_occupancy_rate"))
    return district_hour_summary(hourly, dim).withColumn("peak_hour_rank", F.rank().over(order))
