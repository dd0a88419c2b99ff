"""Station dimension and latest-state views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockpulse.functions.clock import wall_clock_now
from dockpulse.operators.spatial import enrich_district
from dockpulse.schemas import STATIONS


def latest_by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The row with the highest ``order`` columns per key; remaining columns break ties.

    The highest first ``order`` column of each key is a hash aggregation with a fixed buffer, combined before the
    shuffle.  Only the rows that reach it (one per key, and ties) are compared as a whole: a maximum of whole rows over all
    rows would sort them in every map task.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    highest = df.groupBy(key).agg(F.max(order[0]).alias("_highest")).withColumnRenamed(key, "_key")
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(order[0]).eqNullSafe(F.col("_highest"))
    near = df.join(highest, same).drop("_key", "_highest")
    top = near.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("top"))
    return top.select(key, "top.*").select(*df.columns)


def first_seen(silver: DataFrame) -> DataFrame:
    return silver.groupBy("station_id").agg(F.min("snapshot_timestamp").alias("first_seen_at"))


ATTRIBUTES = (
    "station_name",
    "capacity",
    "latitude",
    "longitude",
    "district_municipality_names",
    "insee_municipality_code",
)


def station_history(silver: DataFrame) -> DataFrame:
    """Latest attributes with first and last sighting; equal times go to the greater attributes.

    Attributes hardly ever change, so the rows are first reduced to one per station and attribute
    version: a hash aggregation with two timestamps as its buffer, which also shrinks a station
    with a third of all rows inside the map tasks.  Only versions are compared after that.
    """
    versions = silver.groupBy("station_id", *ATTRIBUTES).agg(
        F.max("snapshot_timestamp").alias("last_seen_at"), F.min("snapshot_timestamp").alias("first_seen_at")
    )
    history = versions.groupBy("station_id").agg(
        F.max(F.struct("last_seen_at", *ATTRIBUTES)).alias("top"), F.min("first_seen_at").alias("first_seen_at")
    )
    return history.select(
        "station_id", *[F.col(f"top.{a}").alias(a) for a in ATTRIBUTES], "first_seen_at", "top.last_seen_at"
    )


def stations_dimension(silver: DataFrame, boundaries: DataFrame | None = None) -> DataFrame:
    """Silver station rows.  Districts are resolved once per station, after the reduction."""
    history = station_history(silver)
    if boundaries is not None:
        history = enrich_district(history, boundaries)
    now = wall_clock_now()
    return history.withColumns({"is_active": F.lit(True), "created_at": now, "updated_at": now}).select(
        *STATIONS.fieldNames()
    )


def latest_availability(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Latest measurement of every known station: reduce first, then join one row per station."""
    measures = [
        "snapshot_timestamp",
        "num_bikes_available",
        "num_bikes_available_mechanical",
        "num_bikes_available_ebike",
        "num_docks_available",
        "occupancy_rate",
        "availability_rate",
        "service_rate",
        "is_empty",
        "is_full",
        "is_operational",
    ]
    latest = latest_by_key(fact.select("station_id", *measures), "station_id", "snapshot_timestamp")
    return latest.join(stations, "station_id").select(
        "station_id",
        "station_name",
        "district_municipality_names",
        "capacity",
        *measures,
        "latitude",
        "longitude",
        "insee_municipality_code",
    )
