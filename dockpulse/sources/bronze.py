"""The Bronze lake: snapshots under ``ingestion_date=.../hour=...``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.schemas import BRONZE, BRONZE_PARTITIONS
from dockpulse.session import child_folders, count_files, path_exists


def scan_bronze(
    spark: SparkSession, path: str, date: str | None = None, hour: int | str | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Read the lake with its declared schema; date and hour prune partitions.

    ``extra`` names further text columns that the feed delivered; snapshots without them give NULL.
    """
    schema = T.StructType(BRONZE.fields + [T.StructField(c, T.StringType()) for c in extra] + BRONZE_PARTITIONS.fields)
    lake = spark.read.schema(schema).parquet(path)
    if date is not None:
        lake = lake.where(F.col("ingestion_date") == F.lit(date).cast("date"))
    if hour is not None:
        lake = lake.where(F.col("hour") == int(hour))
    return lake


def list_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Days present in the lake, from its folder names: no file is listed or opened.

    The folder of rows without a readable time is no day; ``scan_bronze`` gives its rows with a NULL day.
    """
    days = [name.split("=", 1)[1] for name in child_folders(spark, path, "ingestion_date=*")]
    return spark.createDataFrame([(d,) for d in days], "day string").select(
        F.col("day").try_cast("date").alias("ingestion_date")
    ).where("ingestion_date IS NOT NULL")


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files and bytes per partition, from the listing alone (no file is opened)."""
    parts = F.regexp_extract_all(F.col("path"), F.lit(r"(ingestion_date|hour)=([^/]+)"), F.lit(2))
    return (
        list_files(spark, path)
        .select(
            F.get(parts, F.lit(0)).try_cast("date").alias("ingestion_date"),
            F.get(parts, F.lit(1)).try_cast("int").alias("hour"),
            "length",
        )
        .groupBy("ingestion_date", "hour")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per Parquet file below the paths.  ``content`` is never selected, so it is not read.

    ``uri`` is the path as Spark's file metadata spells it.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths))
        .select("path", "modificationTime", "length", F.col("_metadata.file_path").alias("uri"))
    )


def require_partition(spark: SparkSession, path: str, date: str, hour: int | str) -> int:
    """Number of files in one partition, from the listing of its folder alone; raises when it is absent or empty."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no Bronze lake at {path}")
    spellings = dict.fromkeys((f"{int(hour):02d}", str(int(hour))))
    files = sum(count_files(spark, f"{path}/ingestion_date={date}/hour={h}", "*.parquet") for h in spellings)
    if not files:
        raise FileNotFoundError(f"no Parquet file in partition {date} {int(hour):02d} of {path}")
    return files
