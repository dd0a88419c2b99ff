"""Lake hygiene: duplicate and corrupt snapshot files, and the days still to load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.functions.text import file_name, parse_snapshot_name


def _with_minute(files: DataFrame) -> DataFrame:
    """Files with a readable name, with their partition folder, timestamp and minute."""
    return (
        files.withColumns(
            {
                "folder": F.regexp_replace("path", r"/[^/]*$", ""),
                "snapshot_timestamp": parse_snapshot_name(file_name("path")),
            }
        )
        .where(F.col("snapshot_timestamp").isNotNull())
        .withColumn("minute", F.date_trunc("minute", "snapshot_timestamp").cast("timestamp_ntz"))
    )


def minute_duplicates(files: DataFrame) -> DataFrame:
    """Files that follow another of the same folder and minute, in (timestamp, path) order.

    The first file per minute comes from an aggregate, not from a window over the minute, so a
    minute with very many copies does not end in one task.
    """
    timed = _with_minute(files)
    first = timed.groupBy("folder", "minute").agg(
        F.min(F.struct("snapshot_timestamp", "path")).alias("first")
    )
    return (
        timed.join(first, ["folder", "minute"])
        .where(F.col("path") != F.col("first.path"))
        .select("path", "snapshot_timestamp", F.col("first.path").alias("kept_path"))
    )


def cleanup_plan(validated: DataFrame) -> DataFrame:
    """Files without a place in a clean lake, with the reasons, from ``validate_parquet_files`` output.

    The first *valid* file of a minute is kept.
    """
    corrupt = validated.where(~F.col("valid")).select("path", F.lit("corrupt").alias("reason"))
    duplicate = minute_duplicates(validated.where("valid").select("path")).select("path", F.lit("duplicate").alias("reason"))
    return (
        corrupt.unionByName(duplicate)
        .groupBy("path")
        .agg(F.array_sort(F.collect_set("reason")).alias("reasons"))
    )


def files_to_delete(validated: DataFrame) -> DataFrame:
    return cleanup_plan(validated).select("path")


def first_of_minute(rows: DataFrame, *partition: str) -> DataFrame:
    """Bronze rows with ``unit``, the snapshot they belong to, and ``minute_first``: whether it is the first of its minute.

    A snapshot is a file named by its time, or all rows of one ``snapshot_id``; ``file`` names the row's file.  The first of
    each minute comes from aggregates, so a minute with very many copies does not end in one task.  Rows without
    a readable snapshot time have no unit and are all first.  A missing ``snapshot_id`` is taken from the file's name.
    """
    by_file = parse_snapshot_name(file_name("file"))
    by_id = F.try_to_timestamp(F.col("snapshot_id"), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")
    rows = rows.withColumn("_taken", F.coalesce(by_file, by_id)).withColumns(
        {
            "unit": F.when(by_file.isNotNull(), F.col("file")).when(F.col("_taken").isNotNull(), F.col("snapshot_id")),
            "snapshot_id": F.coalesce("snapshot_id", F.date_format("_taken", "yyyyMMdd_HHmmss")),
            "_minute": F.date_trunc("minute", "_taken").cast("timestamp_ntz"),
        }
    )
    keys = [*partition, "_minute"]
    first = rows.where("_minute IS NOT NULL").groupBy(*keys).agg(F.min(F.struct("_taken", "unit")).alias("_first"))
    named = first.select(*[F.col(k).alias(f"{k}_") for k in keys], "_first")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"{key}_"))
    kept = F.col("_first").isNull() | ((F.col("unit") == F.col("_first.unit")) & (F.col("_taken") == F.col("_first._taken")))
    out = rows.join(named, same, "left").withColumn("minute_first", kept)
    return out.drop("_taken", "_minute", "_first", *[f"{k}_" for k in keys])


def cleanup_summary(validated: DataFrame, plan: DataFrame) -> DataFrame:
    """Counts of a cleanup in one row."""
    marked = validated.join(plan, "path", "left")
    has = F.col("reasons")
    return marked.agg(
        F.count_if(F.array_contains(has, "duplicate")).alias("duplicate_files"),
        F.count_if(F.array_contains(has, "corrupt")).alias("corrupted_files"),
        F.count_if(has.isNotNull()).alias("files_to_delete"),
        F.count_if(has.isNull()).alias("remaining_files"),
        F.count_if(has.isNull() & F.col("valid")).alias("remaining_valid_files"),
    )


def loaded_days(availability: DataFrame | None, spark: SparkSession) -> DataFrame:
    """Distinct days already in Silver; empty when the table does not exist.

    The stored table is partitioned by day, so only the partition column is read there.
    """
    if availability is None:
        return spark.createDataFrame([], "day date")
    stored_day = "snapshot_date" in availability.columns
    day = F.col("snapshot_date") if stored_day else F.to_date("snapshot_timestamp")
    return availability.select(day.alias("day")).distinct()


def missing_days(lake_days: DataFrame, loaded: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Days of the lake that Silver lacks, within optional inclusive limits."""
    return filter_date_range(lake_days.select("day").subtract(loaded.select("day")), "day", start, end)


def filter_date_range(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    if start:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df
