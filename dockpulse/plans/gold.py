"""Silver to Gold build: staging, dimension, incremental facts, marts, expectations."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.config import Warehouse
from dockpulse.functions.clock import EMPTY_TARGET_DATE, wall_clock_now
from dockpulse.operators import expectations as ex
from dockpulse.operators import gold
from dockpulse.operators.loading import filter_days, rebuild_from
from dockpulse.operators.reports import table_counts
from dockpulse.session import staged_for_use
from dockpulse.sinks.writers import incremental_replace, materialize_full, write_table
from dockpulse.sources.tables import StoredTable, register_views, scan_table, stored_days

CAPACITY_CATEGORIES = ("small", "medium", "large", "extra_large")


def sources(spark: SparkSession, warehouse: Warehouse) -> dict[str, DataFrame]:
    return {name: warehouse.table(name).read(spark) for name in ("stations", "station_availability")}


def staging(spark: SparkSession, warehouse: Warehouse) -> dict[str, DataFrame]:
    """The staging layer as views."""
    silver = sources(spark, warehouse)
    views = {
        "stg_stations": gold.stg_stations(silver["stations"]),
        "stg_station_availability": gold.stg_availability(silver["station_availability"]),
    }
    register_views(views)
    return views


def _days(spark: SparkSession, table: StoredTable) -> set[date]:
    return {r["snapshot_date"] for r in stored_days(spark, table).where("snapshot_date IS NOT NULL").collect()}


def _refresh(
    spark,
    source: DataFrame,
    source_table: StoredTable,
    build,
    table: StoredTable,
    keys: tuple[str, ...],
    incremental: bool,
    replace_days: bool,
    days: Collection[date],
):
    """Build a fact of ``source``, whose rows all lie in the days of ``source_table``.

    Days that the fact does not hold yet have no rows to replace: they are built and written once.  The other days come first,
    so a run that is lost between the two leaves out whole days.
    """
    stored = scan_table(spark, table) if incremental else None
    if stored is None:
        materialize_full(build(source), table)
        return
    start = rebuild_from(stored)
    if str(start) == EMPTY_TARGET_DATE:
        incremental_replace(spark, build(source), table, *keys, replace_days=replace_days)
        return
    held = _days(spark, table)
    wanted = {day for day in _days(spark, source_table) if day >= start or day in days}
    if again := sorted(wanted & held):
        batch = build(filter_days(source, again))
        incremental_replace(spark, batch, table, *keys, replace_days=replace_days)
    if fresh := sorted(wanted - held):
        write_table(build(filter_days(source, fresh)), table)


def run(
    spark: SparkSession,
    warehouse: Warehouse,
    incremental: bool = True,
    replace_days: bool = False,
    days: Collection[date] = (),
) -> None:
    """Build every Gold table.  ``incremental`` rebuilds the last two stored days of the facts, and the given ``days``."""
    warehouse.require_file_tables("Gold")
    views = staging(spark, warehouse)
    hourly, daily = warehouse.table("fact_hourly_availability"), warehouse.table("fact_daily_station_stats")
    _refresh(
        spark,
        views["stg_station_availability"],
        warehouse.table("station_availability"),
        gold.fact_hourly,
        hourly,
        ("station_id", "snapshot_date", "snapshot_hour"),
        incremental,
        replace_days,
        days,
    )
    daily_keys = ("station_id", "snapshot_date")
    _refresh(spark, hourly.read(spark), hourly, gold.fact_daily, daily, daily_keys, incremental, replace_days, days)
    materialize_full(
        gold.dim_stations(warehouse.table("stations").read(spark)), warehouse.table("dim_stations")
    )
    dim = warehouse.table("dim_stations").read(spark)
    # The ranks and the figures both read the summary; staged, the daily fact is summed up once.
    with staged_for_use(gold.station_summary(daily.read(spark), dim), "station-summary") as summary:
        ranked = gold.with_station_ranks(summary).withColumn("built_at", wall_clock_now())
        materialize_full(ranked, warehouse.table("mart_station_performance"))
    materialize_full(gold.mart_peak_hours(hourly.read(spark), dim), warehouse.table("mart_peak_hours_by_district"))


# Columns that must not be NULL, by table.
REQUIRED = {
    "stations": ("station_id", "station_name", "capacity", "is_active"),
    "station_availability": ("station_id", "snapshot_timestamp", "num_bikes_available"),
    "stg_stations": ("station_id", "capacity"),
    "stg_station_availability": ("station_id", "snapshot_timestamp"),
    "dim_stations": ("station_id", "station_name", "capacity", "capacity_category"),
    "fact_hourly_availability": ("station_id", "snapshot_date", "snapshot_hour"),
    "fact_daily_station_stats": ("station_id", "snapshot_date"),
    "mart_station_performance": ("station_id",),
    "mart_peak_hours_by_district": ("district_municipality_names", "snapshot_hour"),
}
ORPHAN_TEST = "relationships_station_availability"
UNIQUE_STATION = ("stations", "stg_stations", "dim_stations", "mart_station_performance")


def _tables(spark: SparkSession, warehouse: Warehouse) -> dict[str, DataFrame]:
    built = ("dim_stations", *(name for name in REQUIRED if name.startswith(("fact_", "mart_"))))
    return sources(spark, warehouse) | staging(spark, warehouse) | {n: warehouse.table(n).read(spark) for n in built}


def _key_checks(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    found = {f"unique_{name}_station_id": ex.unique(tables[name], "station_id") for name in UNIQUE_STATION}
    found["accepted_values_capacity_category"] = ex.accepted_values(
        tables["dim_stations"], "capacity_category", CAPACITY_CATEGORIES
    )
    found["accepted_values_snapshot_hour"] = ex.accepted_values(
        tables["fact_hourly_availability"], "snapshot_hour", list(range(24))
    )
    return found


def _orphans(tables: dict[str, DataFrame], check) -> DataFrame:
    return check(tables["station_availability"], "station_id", tables["stations"], "station_id")


def checks(spark: SparkSession, warehouse: Warehouse) -> dict[str, DataFrame]:
    """The 30 table tests, each as its violating rows."""
    tables = _tables(spark, warehouse)
    found = {f"not_null_{t}_{c}": ex.not_null(tables[t], c) for t, columns in REQUIRED.items() for c in columns}
    return found | _key_checks(tables) | {ORPHAN_TEST: _orphans(tables, ex.relationships)}


def check_results(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """One row per test with its number of violations; a table's NULL tests share one scan."""
    tables = _tables(spark, warehouse)
    results = table_counts(_key_checks(tables)).withColumnsRenamed(
        {"table_name": "test_name", "row_count": "violations"}
    )
    orphans = _orphans(tables, ex.orphan_counts).agg(
        F.lit(ORPHAN_TEST).alias("test_name"), F.coalesce(F.sum("n_records"), F.lit(0)).alias("violations")
    )
    results = results.unionByName(orphans)
    for name, columns in REQUIRED.items():
        rules = [ex.Constraint(f"not_null_{name}_{c}", F.col(c).isNotNull()) for c in columns]
        counted = ex.violation_counts(tables[name], rules).withColumnRenamed("constraint_name", "test_name")
        results = results.unionByName(counted)
    return results
