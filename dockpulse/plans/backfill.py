"""Load the days that the lake has and Silver lacks."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dockpulse.config import Warehouse
from dockpulse.operators.hygiene import loaded_days, missing_days
from dockpulse.plans import gold
from dockpulse.plans.silver import SilverRun, load_silver
from dockpulse.sinks.writers import write_table
from dockpulse.sources.boundaries import scan_boundaries
from dockpulse.sources.bronze import list_partitions, scan_bronze
from dockpulse.sources.tables import scan_table, stored_days


@dataclass
class BackfillResult:
    pending: list[str]
    loaded: dict[str, SilverRun] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    unreadable_rows: int = 0
    gold_built: bool = False

    @property
    def days(self) -> set[date]:
        """Days of the measurements that were loaded."""
        return {day for run in self.loaded.values() for day in run.facts.days}


def pending_days(spark: SparkSession, warehouse: Warehouse, lake: str, start: str | None = None, end: str | None = None):
    """Days of the lake that are neither in Silver nor recorded as read without result."""
    in_lake = list_partitions(spark, lake).select(F.col("ingestion_date").alias("day"))
    done = loaded_days(stored_days(spark, warehouse.table("station_availability")), spark)
    recorded = scan_table(spark, warehouse.table("backfilled_days"), ["day"])
    if recorded is not None:
        done = done.union(recorded)
    return missing_days(in_lake, done, start, end).orderBy("day")


def run(
    spark: SparkSession,
    warehouse: Warehouse,
    lake: str,
    start: str | None = None,
    end: str | None = None,
    apply: bool = False,
    days_per_run: int = 1,
    build_gold: bool = True,
    boundaries_path: str | None = None,
) -> BackfillResult:
    """One Silver load per group of missing days, then Gold for exactly the days loaded.

    A failed group does not stop the others, but Gold is skipped then.  Without ``apply`` nothing is written.  Loads skip
    stored rows, so a repeated backfill adds nothing; a day whose rows are all invalid is recorded and not tried again.
    Rows without a readable time belong to no day; they are counted as ``unreadable_rows``.
    """
    warehouse.require_file_tables("a backfill")
    days = [str(row["day"]) for row in pending_days(spark, warehouse, lake, start, end).collect()]
    result = BackfillResult(days)
    if not apply:
        return result
    result.unreadable_rows = scan_bronze(spark, lake).where(F.col("ingestion_date").isNull()).count()
    boundaries = scan_boundaries(spark, boundaries_path) if boundaries_path else None
    for at in range(0, len(days), days_per_run):
        group = days[at : at + days_per_run]
        bronze = scan_bronze(spark, lake).where(F.col("ingestion_date").isin(*[F.lit(d).cast("date") for d in group]))
        label = group[0] if len(group) == 1 else f"{group[0]}..{group[-1]}"
        try:
            loaded = load_silver(spark, bronze, warehouse, boundaries)
            record(spark, warehouse, group, loaded)
            result.loaded[label] = loaded
        except Exception as error:  # isolate the failure; it is reported and blocks Gold
            result.failed[label] = f"{type(error).__name__}: {error}"
    if build_gold and not result.failed:
        gold.run(spark, warehouse, days=result.days)
        result.gold_built = True
    return result


def record(spark: SparkSession, warehouse: Warehouse, days: list[str], loaded: SilverRun) -> None:
    """Note days that were read, so that one without valid rows does not stay pending; a group's counts stand at its first day."""
    table = warehouse.table("backfilled_days")
    counts = [(loaded.rows_read, loaded.facts.rows_written)] + [(0, 0)] * (len(days) - 1)
    rows = [(date.fromisoformat(day), *count) for day, count in zip(days, counts, strict=True)]
    write_table(spark.createDataFrame(rows, table.schema), table)
