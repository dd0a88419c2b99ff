"""Stored tables behind one small interface: a Parquet folder, a catalog table, or a connector."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dockpulse.session import child_folders, path_exists
from dockpulse.sources.jdbc import window_query


@dataclass(frozen=True)
class StoredTable:
    """Where a table lives.  ``kind`` is ``parquet``, ``catalog``, ``jdbc`` or a connector format."""

    kind: str
    location: str
    schema: StructType | None = None
    options: dict[str, str] = field(default_factory=dict, repr=False)
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()

    def exists(self, spark: SparkSession) -> bool:
        if self.kind == "parquet":
            return path_exists(spark, self.location)
        if self.kind == "catalog":
            return spark.catalog.tableExists(self.location)
        # JDBC tables are created by their owner before the first load.
        return True

    def read(self, spark: SparkSession) -> DataFrame:
        if self.kind == "parquet":
            reader = spark.read.schema(self.schema) if self.schema else spark.read
            return reader.parquet(self.location)
        if self.kind == "catalog":
            return spark.table(self.location)
        key = "dbtable" if self.kind == "jdbc" else "table"
        return spark.read.format(self.kind).options(**self.options).option(key, self.location).load()


def scan_table(
    spark: SparkSession,
    table: StoredTable,
    columns: list[str] | None = None,
    condition: Column | str | None = None,
) -> DataFrame | None:
    """Read selected columns of the matching rows; ``None`` when the table does not exist yet."""
    if not table.exists(spark):
        return None
    df = table.read(spark)
    if condition is not None:
        df = df.where(condition)
    return df.select(*columns) if columns else df


def stored_days(spark: SparkSession, table: StoredTable) -> DataFrame | None:
    """(snapshot_date) of a table stored by day; ``None`` when it does not exist yet.

    A Parquet folder tells its days by its folder names, so no file is listed or opened.
    """
    if not table.exists(spark):
        return None
    if table.kind != "parquet":
        return table.read(spark).select("snapshot_date").distinct()
    names = [(name.split("=", 1)[1],) for name in child_folders(spark, table.location, "snapshot_date=*")]
    days = spark.createDataFrame(names, "day string").select(F.col("day").try_cast("date").alias("snapshot_date"))
    return days.where("snapshot_date IS NOT NULL")


def window_options(
    table: StoredTable, columns: list[str], column: str, low: datetime, high: datetime, partitions: int = 8
) -> dict[str, str]:
    """JDBC options that let the database evaluate a closed time window, in parallel ranges."""
    query = window_query(table.location, columns, column, low, high)
    return table.options | {
        "dbtable": f"({query}) AS bounded",
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def scan_window(
    spark: SparkSession, table: StoredTable, columns: list[str], column: str, low: datetime, high: datetime
) -> DataFrame | None:
    """Columns of the rows inside a closed time window; ``None`` when the table does not exist.

    Tables stored by day get a date predicate as well, which prunes partitions.
    """
    if not table.exists(spark):
        return None
    if table.kind == "jdbc":
        return spark.read.format("jdbc").options(**window_options(table, columns, column, low, high)).load()
    df = table.read(spark)
    inside = F.col(column).between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"))
    if "snapshot_date" in df.columns:
        inside = inside & F.col("snapshot_date").between(F.lit(low.date()), F.lit(high.date()))
    return df.where(inside).select(*columns)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames as named temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
