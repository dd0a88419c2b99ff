"""Resolve the districts of stored Paris stations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.config import Warehouse
from dockpulse.operators.gold import DISTRICT
from dockpulse.operators.loading import update_attribute
from dockpulse.operators.reports import district_counts, paris_stations
from dockpulse.operators.spatial import resolve_label
from dockpulse.sinks.writers import materialize_full
from dockpulse.session import stage


@dataclass(frozen=True)
class EnrichmentResult:
    checked: int
    to_update: int
    unresolved: DataFrame
    summary: DataFrame


def candidates(stations: DataFrame) -> DataFrame:
    """Located stations whose district starts with ``paris``, in id order."""
    return (
        paris_stations(stations)
        .where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select("station_id", "latitude", "longitude", DISTRICT)
        .orderBy("station_id")
    )


def resolved(stations: DataFrame, boundaries: DataFrame) -> DataFrame:
    return resolve_label(candidates(stations), boundaries)


def run(spark: SparkSession, warehouse: Warehouse, boundaries: DataFrame, dry_run: bool = False) -> EnrichmentResult:
    table = warehouse.table("stations")
    stations = table.read(spark)
    labelled = stage(resolved(stations, boundaries), "district-labels")
    changed = F.col("district_label").isNotNull() & (F.col("district_label") != F.col(DISTRICT))
    counts = labelled.agg(F.count(F.lit(1)).alias("checked"), F.count_if(changed).alias("to_update")).first()
    updates = labelled.where(changed).select("station_id", F.col("district_label").alias(DISTRICT))
    if counts["to_update"] and not dry_run:
        materialize_full(update_attribute(stations, updates), table)
    unresolved = labelled.where(F.col("district_label").isNull()).select("station_id")
    return EnrichmentResult(counts["checked"], counts["to_update"], unresolved, district_counts(table.read(spark)))
