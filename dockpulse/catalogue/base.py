"""Registry of the queries and the tables they start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.config import Warehouse, parquet_warehouse
from dockpulse.operators import gold, silver, stations
from dockpulse.plans import gold as gold_plan
from dockpulse.plans.silver import load_silver
from dockpulse.schemas import BRONZE_LAKE
from dockpulse.session import move_one, path_exists, work_path
from dockpulse.sinks.writers import write_bronze
from dockpulse.sources import samples
from dockpulse.sources.boundaries import scan_boundaries

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Scenario value: where the period is cut into an earlier and a later load.
CUTOFF = "2024-01-16"


def tidy(df: DataFrame) -> DataFrame:
    """Types that both engines print alike: decimals as doubles, dates and timestamps as text."""
    out = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: tidy(build(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def bronze_path(spark: SparkSession, sf_dir: str) -> str:
    """Bronze rows derived from the given tables, stored by day once per application.

    Queries start from stored snapshots, as they would in use.  Fused with the adapter's own
    expressions, their generated code would outgrow what the JVM compiles.
    """

    def write(path: str) -> None:
        samples.bronze(spark, sf_dir, by_day=True).write.partitionBy("ingestion_date").parquet(path)

    return stored(spark, sf_dir, "bronze-by-day", write)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(BRONZE_LAKE).parquet(bronze_path(spark, sf_dir))


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.transform_silver(bronze(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stored_fact(silver.project_fact(silver_rows(spark, sf_dir)))


def station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations.stations_dimension(silver_rows(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stg_availability(fact(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_hourly(staged(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_daily(hourly(spark, sf_dir))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_stations(station_rows(spark, sf_dir))


def without(df: DataFrame, *columns: str) -> DataFrame:
    """Drops audit columns that hold the time of the run."""
    return df.drop(*columns, "processing_timestamp", "created_at", "updated_at", "built_at")


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a data set written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED or not path_exists(spark, _STORED[key]):
        path = work_path(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


SILVER_TABLES = ("stations", "station_availability")


def silver_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Silver tables of all given rows, as the job stores them, built once per application."""
    return parquet_warehouse(stored(spark, sf_dir, "warehouse", lambda path: load_silver(spark, bronze(spark, sf_dir), parquet_warehouse(path))))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Silver and Gold tables of all given rows; Gold is built when the first query asks for it."""
    target = silver_warehouse(spark, sf_dir)
    if not target.table("mart_peak_hours_by_district").exists(spark):
        gold_plan.run(spark, target, incremental=False)
    return target


def stored_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    target = silver_warehouse(spark, sf_dir) if name in SILVER_TABLES else warehouse(spark, sf_dir)
    return target.table(name).read(spark)


def lake(spark: SparkSession, sf_dir: str) -> str:
    return stored(spark, sf_dir, "bronze-lake", lambda path: write_bronze(bronze(spark, sf_dir), path))


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Payload texts, one per line, in a folder per poll day."""
    return stored(spark, sf_dir, "landing", lambda path: _land(samples.payloads(bronze(spark, sf_dir)), path))


def _land(payloads: DataFrame, path: str) -> None:
    """Bronze rows are stored by day, so a task writes few folders, and the texts, many times their size, need no shuffle."""
    payloads.select("value", F.to_date("poll").alias("poll_date")).write.mode("append").partitionBy("poll_date").text(path)


def broken_landing(spark: SparkSession, sf_dir: str) -> str:
    """The landing folder of ``landing``, with payloads between that give no station."""

    def write(path: str) -> None:
        _land(samples.payloads(bronze(spark, sf_dir)), path)
        broken = samples.broken_payloads(samples.table(spark, sf_dir, "events")).withColumn("poll_date", F.to_date("poll"))
        _land(broken.hint("rebalance", "poll_date"), path)

    return stored(spark, sf_dir, "broken-landing", write)


def mixed_lake(spark: SparkSession, sf_dir: str) -> str:
    """A Bronze lake of its own whose late files have another type of two columns, with every row twice and an unreadable file a half."""
    path, rows = work_path(spark, "mixed-lake"), bronze(spark, sf_dir)
    late = F.col("ingestion_date") >= F.lit(CUTOFF).cast("date")
    twice = rows.unionByName(rows)
    write_bronze(twice.where(~late).withColumn("x", F.col("capacity").cast("int")), path, skip_stored=False)
    texts = {"x": F.concat(F.lit("c"), F.col("capacity").cast("string")), "capacity": F.col("capacity").cast("string")}
    write_bronze(twice.where(late).withColumns(texts), path, skip_stored=False)
    for day in rows.groupBy(late).agg(F.max("ingestion_date").alias("day")).collect():
        spark.range(1).selectExpr("'no parquet' AS value").coalesce(1).write.mode("append").text(f"{path}/broken")
        name = f"snapshot_{day['day']:%Y%m%d}_120000.parquet"
        move_one(spark, f"{path}/broken", f"{path}/ingestion_date={day['day']}/hour=12/{name}")
    return path


def boundary_table(spark: SparkSession, sf_dir: str, name: str, number: str) -> DataFrame:
    """District boundaries read back from GeoJSON that Spark wrote from a given table's keys."""

    def write(path: str) -> None:
        features = samples.boundary_features(samples.table(spark, sf_dir, name), number)
        samples.geojson_text(features).write.text(path)

    return scan_boundaries(spark, stored(spark, sf_dir, f"boundaries-{name}", write), multi_line=False)


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary_table(spark, sf_dir, "nation", "n_nationkey")


def before_cutoff(df: DataFrame, column: str = "snapshot_timestamp") -> DataFrame:
    return df.where(F.col(column) < F.lit(CUTOFF).cast("timestamp_ntz"))
