"""Gold for given days: their facts are replaced, and the stations' mart follows by addition and subtraction."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.config import Warehouse
from dockpulse.functions.clock import wall_clock_now
from dockpulse.operators import gold
from dockpulse.operators.totals import changed_totals, performance_from_totals, station_totals
from dockpulse.session import hadoop_path, path_exists, staged_for_use
from dockpulse.sinks.writers import materialize_full, replace_stored_days
from dockpulse.sources.tables import StoredTable


def totals_table(warehouse: Warehouse) -> StoredTable:
    """The totals lie beside the mart."""
    mart = warehouse.table("mart_station_performance")
    if mart.kind != "parquet":
        raise ValueError("totals are kept beside Parquet tables only")
    return replace(mart, location=f"{mart.location}_totals", schema=None)


def refresh(spark: SparkSession, warehouse: Warehouse, hours: DataFrame, days: Collection[date]) -> None:
    """Replace the given days of the hourly and daily facts by ``hours`` (hourly rows of those days) and update the mart.

    Days without an hourly row are emptied.  Of the history only the given days are read; the mart's figures come from stored
    totals of the stations.  A run that is lost halfway leaves a mark, and the next one sums the totals up from the daily fact.
    """
    if not days:
        return
    hourly, daily = (warehouse.table(n) for n in ("fact_hourly_availability", "fact_daily_station_stats"))
    totals = totals_table(warehouse)
    mark, named = f"{totals.location}.unfinished", [F.lit(d).cast("date") for d in sorted(days)]
    whole = path_exists(spark, mark) or not totals.exists(spark) or not daily.exists(spark)
    system, target = hadoop_path(spark, mark)
    system.mkdirs(target)
    with staged_for_use(hours.where(F.col("snapshot_date").isin(*named)), "day-hours") as hours:
        with staged_for_use(gold.fact_daily(hours), "days-after") as after:
            before = daily.read(spark).where(F.col("snapshot_date").isin(*named)) if daily.exists(spark) else after.where("false")
            with staged_for_use(before.select(*after.columns), "days-before") as before:
                replace_stored_days(spark, hours, hourly, days)
                replace_stored_days(spark, after, daily, days)
                stored = daily.read(spark)
                fresh = station_totals(stored) if whole else changed_totals(totals.read(spark), before, after, stored)
                materialize_full(fresh, totals)
    dim = warehouse.table("dim_stations")
    materialize_full(gold.dim_stations(warehouse.table("stations").read(spark)), dim)
    mart = performance_from_totals(totals.read(spark), dim.read(spark)).withColumn("built_at", wall_clock_now())
    materialize_full(mart, warehouse.table("mart_station_performance"))
    system.delete(target, True)
