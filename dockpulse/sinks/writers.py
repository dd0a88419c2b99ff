"""Table writers and loads."""

from __future__ import annotations

import uuid
from collections.abc import Collection
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dockpulse.operators.key_bitmaps import BITMAP_SCHEMA, SPAN, key_bitmaps, merged_bitmaps, with_maybe_stored
from dockpulse.operators.loading import batch_bounds, matching, new_rows, replace_by_key, without_stored
from dockpulse.operators.silver import dedup_in_batch
from dockpulse.session import hadoop_path, path_exists, staged_for_use, swap_folder
from dockpulse.sinks.deltas import DeltaStore
from dockpulse.sources.bronze import scan_bronze
from dockpulse.sources.tables import StoredTable, scan_table, scan_window

# Fixed values of the JDBC append.
JDBC_APPEND = {"batchsize": "5000", "isolationLevel": "READ_COMMITTED"}

# Tables that Spark itself stores as files; other kinds have a server of their own.
FILE_KINDS = ("parquet", "catalog")

FACT_KEYS = ("station_id", "snapshot_timestamp")


@dataclass(frozen=True)
class LoadResult:
    rows_in: int = 0
    rows_written: int = 0
    days: tuple[date, ...] = ()


def _arranged(df: DataFrame, table: StoredTable, written: Observation | None = None) -> DataFrame:
    """Bring the rows of a partition together and sort them for narrow row-group statistics.

    ``rebalance`` lets adaptive execution split a crowded day and merge small ones, which a plain
    repartition by day could not.  Rows are counted after that exchange: an empty exchange is
    dropped from the plan together with everything below it.
    """
    if table.partition_by:
        df = df.hint("rebalance", *table.partition_by)
    if written is not None:
        df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    order = (*table.partition_by, *table.sort_by)
    return df.sortWithinPartitions(*order) if order else df


def write_table(df: DataFrame, table: StoredTable, mode: str = "append", written: Observation | None = None) -> None:
    """Store rows; the first write creates the table with its partitioning.

    ``written`` receives the number of rows.
    """
    if table.kind == "catalog":
        writer = _arranged(df, table, written).write.format("parquet").mode(mode)
        writer.partitionBy(*table.partition_by).saveAsTable(table.location)
        return
    if table.kind == "parquet":
        _arranged(df, table, written).write.mode(mode).partitionBy(*table.partition_by).parquet(table.location)
        return
    key = "dbtable" if table.kind == "jdbc" else "table"
    extra = JDBC_APPEND if table.kind == "jdbc" else {}
    if written is not None:
        df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    df.write.format(table.kind).options(**table.options, **extra).option(key, table.location).mode(mode).save()


BRONZE_KEYS = ("ingestion_date", "hour", "snapshot_id", "stationcode")


def write_bronze(df: DataFrame, path: str, skip_stored: bool = True) -> None:
    """Append snapshots under ``ingestion_date=YYYY-MM-DD/hour=HH``.

    Rows of a snapshot and station that the lake has already are left out, so a load that failed halfway, or was simply
    repeated, can run again.  Only the keys of the batch's own days are read for that.
    """
    spark = df.sparkSession
    if not skip_stored or not path_exists(spark, path):
        _append_bronze(df, path)
        return
    with staged_for_use(df, "bronze-batch") as rows:
        days = [row["ingestion_date"] for row in rows.select("ingestion_date").distinct().collect()]
        if not days:
            return
        day = F.col("ingestion_date")
        wanted = day.isin(*[F.lit(d) for d in days if d is not None])
        stored = scan_bronze(spark, path).where(wanted | day.isNull() if None in days else wanted)
        _append_bronze(without_stored(rows, stored, *BRONZE_KEYS), path)


def _append_bronze(df: DataFrame, path: str) -> None:
    arranged = (
        df.withColumn("hour", F.lpad(F.col("hour").cast("string"), 2, "0"))
        .hint("rebalance", "ingestion_date", "hour")
        .sortWithinPartitions("ingestion_date", "hour", "stationcode")
    )
    arranged.write.mode("append").partitionBy("ingestion_date", "hour").parquet(path)


def load_dim_insert_only(spark: SparkSession, batch: DataFrame, table: StoredTable) -> LoadResult:
    """Insert stations that are not stored yet; stored ones stay as they are."""
    existing = scan_table(spark, table, ["station_id"])
    fresh = batch if existing is None else new_rows(batch, existing, "station_id")
    written = Observation()
    write_table(fresh, table, written=written)
    return LoadResult(rows_written=written.get["rows"])


def load_fact_dedup(spark: SparkSession, batch: DataFrame, table: StoredTable, stored: bool = False) -> LoadResult:
    """Append measurements whose (station, timestamp) is new, within the batch and in the table.

    The stored side is read only between the batch's first and last timestamp.  The duplicate
    removal and the anti-join use the same keys, so the batch is shuffled once.  The batch is computed once and stored for both of
    its uses; ``stored`` says that it comes from storage already.
    """
    if stored:
        return _load_fact(spark, batch, table)
    with staged_for_use(batch, "fact-batch") as rows:
        return _load_fact(spark, rows, table)


def _load_fact(spark: SparkSession, batch: DataFrame, table: StoredTable) -> LoadResult:
    days = F.array_sort(F.collect_set(F.to_date("snapshot_timestamp"))).alias("days")
    bounds = batch_bounds(batch, days).first()
    if bounds["min_ts"] is None:
        return LoadResult()
    fresh = dedup_in_batch(batch)
    stored = scan_window(spark, table, list(FACT_KEYS), "snapshot_timestamp", bounds["min_ts"], bounds["max_ts"])
    if stored is not None:
        fresh = new_rows(fresh, stored, *FACT_KEYS)
    written = Observation()
    write_table(fresh, table, written=written)
    return LoadResult(bounds["rows"], written.get["rows"], tuple(bounds["days"]))


def stored_key_bitmaps(path: str) -> DeltaStore:
    """The bitmaps of a fact's stored keys, kept below a folder beside it.

    The folder is named by their form: bitmaps of another form are not seen, and made anew from the stored keys.
    """
    return DeltaStore(f"{path}/words-{SPAN}", BITMAP_SCHEMA, merged_bitmaps)


def load_fact_by_bitmaps(spark: SparkSession, batch: DataFrame, table: StoredTable, bitmaps: DeltaStore) -> LoadResult:
    """As ``load_fact_dedup``, but the stored keys are read only where a bit says that they may be there.

    The batch's own bits are stored before its rows: a load that is lost between the two leaves bits without rows, which cost a
    look at the stored keys when it is repeated, and never the other way round.  All loads of the table must keep its bitmaps; a table
    that was loaded without gets them from its own keys first.
    """
    with staged_for_use(batch, "fact-batch") as rows:
        days = F.array_sort(F.collect_set(F.to_date("snapshot_timestamp"))).alias("days")
        bounds = batch_bounds(rows, days).first()
        if bounds["min_ts"] is None:
            return LoadResult()
        if bitmaps.last(spark, "loads") is None and table.exists(spark):
            bitmaps.append(key_bitmaps(table.read(spark)), "loads", 0)
            bitmaps.compact(spark)
        low, high = str(bounds["min_ts"].date()), str(bounds["max_ts"].date())
        with staged_for_use(with_maybe_stored(dedup_in_batch(rows), bitmaps.read(spark, low, high)), "fact-marked") as marked:
            fresh, doubtful = (marked.where(c).drop("maybe_stored") for c in ("NOT maybe_stored", "maybe_stored"))
            near = batch_bounds(doubtful).first()
            if near["min_ts"] is not None:
                stored = scan_window(spark, table, list(FACT_KEYS), "snapshot_timestamp", near["min_ts"], near["max_ts"])
                fresh = fresh.unionByName(doubtful if stored is None else new_rows(doubtful, stored, *FACT_KEYS))
            last = bitmaps.last(spark, "loads")
            bitmaps.append(key_bitmaps(marked), "loads", 0 if last is None else last + 1)
            written = Observation()
            write_table(fresh, table, written=written)
    return LoadResult(bounds["rows"], written.get["rows"], tuple(bounds["days"]))


def materialize_full(df: DataFrame, table: StoredTable) -> None:
    """Full refresh.  The new version is complete on disk before the old one goes.

    A Parquet folder is written beside the old one and then takes its place by renaming, so the
    rows may come from the old version and are written once.
    """
    spark = df.sparkSession
    if table.kind not in FILE_KINDS or not table.exists(spark):
        write_table(df, table, "overwrite")
    elif table.kind == "catalog":
        with staged_for_use(df, "full-refresh") as rows:
            write_table(rows, table, "overwrite")
    else:
        version = uuid.uuid4().hex[:12]
        following = replace(table, location=f"{table.location}.next-{version}")
        write_table(df, following, "overwrite")
        swap_folder(spark, following.location, table.location, f"{table.location}.previous-{version}")


def incremental_replace(
    spark: SparkSession, batch: DataFrame, table: StoredTable, *keys: str, replace_days: bool = False
) -> None:
    """Replace stored rows by key (or, with ``replace_days``, whole days) with the batch.

    Only the days that the batch touches are read and rewritten; they are literals, so that the stored days prune statically.
    """
    if not table.exists(spark):
        write_table(batch, table)
        return
    if table.kind not in FILE_KINDS:
        raise NotImplementedError(f"replace rows in a {table.kind} table with its own MERGE")
    with staged_for_use(batch, "incremental") as rows:
        found = rows.select("snapshot_date").distinct().where("snapshot_date IS NOT NULL").collect()
        if not found:
            return
        if not replace_days:
            touched = table.read(spark).where(F.col("snapshot_date").isin(*[F.lit(r["snapshot_date"]) for r in found]))
            rows = replace_by_key(touched.select(*rows.columns), rows, *keys)
        if table.kind == "parquet":
            writer = _arranged(rows, table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*table.partition_by).parquet(table.location)
            return
        # An insert goes by position, and a catalog table must not be read by its own overwrite.
        with staged_for_use(rows, "incremental-result") as rows:
            ordered = rows.select(*spark.table(table.location).columns)
            _arranged(ordered, table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(
                table.location
            )


def replace_stored_days(spark: SparkSession, rows: DataFrame, table: StoredTable, days: Collection[date]) -> None:
    """Put ``rows`` in the place of the given days of a Parquet table; days without a row are emptied."""
    if table.kind != "parquet":
        raise NotImplementedError(f"replace days in a {table.kind} table with its own statements")
    held = {r["snapshot_date"] for r in rows.select("snapshot_date").distinct().collect()}
    if not held <= set(days):
        raise ValueError(f"rows of other days than those to be replaced: {sorted(map(str, held - set(days)))}")
    if held:
        incremental_replace(spark, rows, table, replace_days=True)
    for day in set(days) - held:
        system, target = hadoop_path(spark, f"{table.location}/snapshot_date={day}")
        system.delete(target, True)


def write_quality_report(report: DataFrame, path: str, local_time) -> None:
    """Append reports under ``report_date=.../hour=HH``, the rows of an hour in as few files as their size asks for."""
    report.withColumns(
        {"report_date": F.date_format(local_time, "yyyy-MM-dd"), "hour": F.date_format(local_time, "HH")}
    ).hint("rebalance", "report_date", "hour").write.mode("append").partitionBy("report_date", "hour").parquet(path)


def mirror_partitions(spark: SparkSession, source: str, target: str) -> None:
    """Copy snapshots that the target lake lacks, keeping the partition layout.

    Both lakes are compared by snapshot id alone; whole rows are read only from the days that
    lack something.  NULL ids and hours are keys like any other.
    """
    rows = scan_bronze(spark, source)
    if not path_exists(spark, target):
        write_bronze(rows, target, skip_stored=False)
        return
    keys = ("ingestion_date", "hour", "snapshot_id")
    missing = without_stored(rows.select(*keys).distinct(), scan_bronze(spark, target), *keys)
    with staged_for_use(missing, "mirror-lacking") as lacking:
        days = [row["ingestion_date"] for row in lacking.select("ingestion_date").distinct().collect()]
        if days:
            day = F.col("ingestion_date")
            wanted = day.isin(*[F.lit(d) for d in days if d is not None])
            near = rows.where(wanted | day.isNull() if None in days else wanted)
            write_bronze(matching(near, lacking, "left_semi", *keys), target, skip_stored=False)
