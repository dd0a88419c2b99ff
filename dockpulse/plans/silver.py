"""Bronze to Silver job."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dockpulse.config import Warehouse
from dockpulse.operators.reports import filter_hour_window, latest_hours, require_rows, table_counts
from dockpulse.operators.silver import project_fact, stored_fact, transform_silver
from dockpulse.operators.stations import stations_dimension
from dockpulse.sinks.writers import LoadResult, load_dim_insert_only, load_fact_dedup
from dockpulse.session import staged_for_use
from dockpulse.sources.boundaries import scan_boundaries
from dockpulse.sources.bronze import scan_bronze


@dataclass(frozen=True)
class SilverRun:
    """What one run did; all counts come from the passes that did the work."""

    rows_read: int
    rows_rejected: int
    facts: LoadResult
    stations: LoadResult
    seconds: float

    @property
    def duplicates_skipped(self) -> int:
        return self.facts.rows_in - self.facts.rows_written

    def as_row(self) -> dict[str, float]:
        return {
            "rows_read": self.rows_read,
            "rows_rejected": self.rows_rejected,
            "facts_in": self.facts.rows_in,
            "facts_written": self.facts.rows_written,
            "duplicates_skipped": self.duplicates_skipped,
            "stations_written": self.stations.rows_written,
            "duration_seconds": self.seconds,
        }


def load_silver(
    spark: SparkSession, bronze: DataFrame, warehouse: Warehouse, boundaries: DataFrame | None = None
) -> SilverRun:
    """Transform Bronze rows once, then load both Silver tables from the stored result."""
    started = time.monotonic()
    metrics = Observation("silver_rows")
    with staged_for_use(transform_silver(bronze, metrics), "silver-batch") as silver:
        read = metrics.get
        stations = load_dim_insert_only(spark, stations_dimension(silver, boundaries), warehouse.table("stations"))
        facts = load_fact_dedup(
            spark, stored_fact(project_fact(silver)), warehouse.table("station_availability"), stored=True
        )
    return SilverRun(read["rows_read"], read["rows_rejected"], facts, stations, time.monotonic() - started)


def run(
    spark: SparkSession,
    warehouse: Warehouse,
    bronze_path: str,
    date: str | None = None,
    hour: int | str | None = None,
    boundaries_path: str | None = None,
) -> SilverRun:
    boundaries = scan_boundaries(spark, boundaries_path) if boundaries_path else None
    return load_silver(spark, scan_bronze(spark, bronze_path, date, hour), warehouse, boundaries)


def validate(spark: SparkSession, warehouse: Warehouse, date: str, hour: int | str):
    """Bounds of one loaded hour; raises when nothing is there."""
    availability = warehouse.table("station_availability").read(spark)
    return require_rows(filter_hour_window(availability, f"{date} {int(hour):02d}:00:00"), f"{date} {hour}h")


def summary(spark: SparkSession, warehouse: Warehouse, hours: int = 1) -> tuple[DataFrame, DataFrame]:
    """Table row counts, and the latest ``hours`` hours that hold rows, however far back they lie."""
    stations, availability = (warehouse.table(t).read(spark) for t in ("stations", "station_availability"))
    counts = table_counts({"stations": stations, "station_availability": availability})
    return counts, recent_hours(availability, hours)


def recent_hours(availability: DataFrame, hours: int) -> DataFrame:
    """``latest_hours`` that reads the newest days only: twice as many each time, until they hold enough hours.

    The days come from the partition column; no measurement is read for them.
    """
    newest_first = availability.select("snapshot_date").distinct().orderBy(F.desc("snapshot_date"))
    days = [row["snapshot_date"] for row in newest_first.collect()]
    take = max(1, -(-hours // 24))
    while True:
        recent = availability.where(F.col("snapshot_date").isin(*[F.lit(day) for day in days[:take]]))
        found = latest_hours(recent, hours)
        if take >= len(days) or found.count() >= hours:
            return found
        take *= 2
