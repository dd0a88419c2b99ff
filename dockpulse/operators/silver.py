"""Bronze rows to typed, validated Silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from dockpulse.functions.clock import wall_clock, wall_clock_now, with_calendar
from dockpulse.functions.numeric import capped_rate, int_or_zero
from dockpulse.functions.text import token_bool
from dockpulse.schemas import AVAILABILITY

STATUS_COLUMNS = ("is_installed", "is_renting", "is_returning")


def normalize_columns(bronze: DataFrame) -> DataFrame:
    """Rename, trim and cast the Bronze columns; the status columns stay text."""
    return bronze.select(
        F.trim("stationcode").alias("station_id"),
        F.trim("name").alias("station_name"),
        int_or_zero("capacity").alias("capacity"),
        int_or_zero("numbikesavailable").alias("num_bikes_available"),
        int_or_zero("mechanical").alias("num_bikes_available_mechanical"),
        int_or_zero("ebike").alias("num_bikes_available_ebike"),
        int_or_zero("numdocksavailable").alias("num_docks_available"),
        *STATUS_COLUMNS,
        F.col("lon").try_cast("double").alias("longitude"),
        F.col("lat").try_cast("double").alias("latitude"),
        F.trim("nom_arrondissement_communes").alias("district_municipality_names"),
        F.trim("code_insee_commune").alias("insee_municipality_code"),
        wall_clock("ingestion_timestamp").alias("ingestion_timestamp"),
        "snapshot_id",
    )


def normalize_booleans(df: DataFrame) -> DataFrame:
    return df.withColumns({name: token_bool(name) for name in STATUS_COLUMNS})


def with_rates(df: DataFrame) -> DataFrame:
    """Occupancy (bikes), availability (docks) and service (both) in percent of capacity."""
    bikes, docks = (F.col(c).cast("bigint") for c in ("num_bikes_available", "num_docks_available"))
    capacity = F.col("capacity")
    return df.withColumns(
        {
            "occupancy_rate": capped_rate(bikes, capacity),
            "availability_rate": capped_rate(docks, capacity),
            "service_rate": capped_rate(docks + bikes, capacity),
        }
    )


def with_status_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_empty": F.col("num_bikes_available") == 0,
            "is_full": F.col("num_docks_available") == 0,
            "is_operational": F.col("is_installed") & F.col("is_renting") & F.col("is_returning"),
        }
    )


def validity() -> Column:
    """The acceptance rules as one conjunction; NULL or false means rejected."""
    return (
        (F.col("station_id") != "")
        & (F.col("capacity") > 0)
        & (F.col("num_bikes_available") >= 0)
        & (F.col("num_docks_available") >= 0)
        & F.col("snapshot_timestamp").isNotNull()
    )


def is_rejected() -> Column:
    return ~F.coalesce(validity(), F.lit(False))


def filter_valid(df: DataFrame) -> DataFrame:
    return df.where(validity())


def quarantine(df: DataFrame) -> DataFrame:
    """The rows ``filter_valid`` rejects."""
    return df.where(is_rejected())


def enrich(bronze: DataFrame) -> DataFrame:
    """Every Bronze row as a Silver row, before validation."""
    clean = normalize_booleans(normalize_columns(bronze))
    timed = clean.withColumn("snapshot_timestamp", F.col("ingestion_timestamp"))
    return with_status_flags(with_rates(timed))


def transform_silver(bronze: DataFrame, metrics: Observation | None = None) -> DataFrame:
    """Bronze to valid Silver rows.  ``metrics`` collects rows read and rejected during the one pass."""
    df = enrich(bronze)
    if metrics is not None:
        df = df.observe(
            metrics,
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(is_rejected()).alias("rows_rejected"),
        )
    return filter_valid(df)


def project_fact(silver: DataFrame) -> DataFrame:
    """The 17 stored availability columns."""
    return silver.withColumn("processing_timestamp", wall_clock_now()).select(*AVAILABILITY.fieldNames())


def dedup_in_batch(df: DataFrame, keys: tuple[str, ...] = ("station_id", "snapshot_timestamp")) -> DataFrame:
    """One row per key: the smallest by all other columns, so reruns keep the same row.

    Spark applies a first-row filter over a window on both sides of the shuffle (window group
    limit), so many copies of a key leave each map task as one row.
    """
    rest = [c for c in df.columns if c not in keys]
    order = Window.partitionBy(*keys).orderBy(*rest)
    return df.withColumn("_row", F.row_number().over(order)).where("_row = 1").drop("_row")


def stored_fact(fact: DataFrame) -> DataFrame:
    """Fact rows with the derived calendar columns of the stored table."""
    return with_calendar(fact)
