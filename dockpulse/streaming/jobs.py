"""Structured Streaming forms of the loads.  Event time must be TIMESTAMP inside a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockpulse.config import Warehouse
from dockpulse.functions.clock import with_calendar
from dockpulse.operators.gold import hourly_measures
from dockpulse.operators.states import STATE_SCHEMA, hourly_state, merged
from dockpulse.plans.silver import load_silver
from dockpulse.schemas import FACT_HOURLY
from dockpulse.sinks.deltas import DeltaStore
from dockpulse.sinks.writers import FACT_KEYS, incremental_replace, load_fact_by_bitmaps
from dockpulse.sources.landing import explode_payloads, quarantined, to_bronze
from dockpulse.sources.tables import StoredTable

HOURLY_KEYS = ("station_id", "snapshot_date", "snapshot_hour")


# Every started job takes another trigger; this one works off what has arrived and ends.
ONCE = {"availableNow": True}
# Files that a micro-batch writes for an hour, at most.
FILES_PER_HOUR = 4


def stream_ingest(
    spark: SparkSession,
    landing: str,
    lake: str,
    checkpoint: str,
    schema: str,
    instant: Column,
    extra: Sequence[str] = (),
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Land payload texts as typed Bronze snapshots, exactly once per landed file.

    ``extra`` names columns of the feed beside the contract.  Rows of an hour meet in a few tasks, so that a micro-batch
    does not leave a file for every task and hour.
    """
    payloads = spark.readStream.schema(schema).text(landing)
    bronze = to_bronze(explode_payloads(payloads, extra=extra), instant)
    return (
        bronze.withColumn("hour", F.lpad(F.col("hour").cast("string"), 2, "0"))
        .repartition("ingestion_date", "hour", F.pmod(F.xxhash64("stationcode"), F.lit(FILES_PER_HOUR)))
        .writeStream.format("parquet")
        .partitionBy("ingestion_date", "hour")
        .option("path", lake)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_quarantine(
    spark: SparkSession, landing: str, folder: str, checkpoint: str, schema: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Set aside the payloads that ``stream_ingest`` takes no station from, with file and reason, exactly once per landed file.

    A stream of its own beside the ingest: each has one sink and one checkpoint, so neither can repeat rows after a failure.
    The landed files are read by as many tasks as they have parts; only tasks that find something write a file.
    """
    payloads = spark.readStream.schema(schema).text(landing).withColumn("file", F.col("_metadata.file_path"))
    return (
        quarantined(payloads)
        .writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def dedup_stream(silver: DataFrame, lateness: str = "2 days") -> DataFrame:
    """One row per (station, timestamp) within the watermark; state is dropped behind it."""
    timed = silver.withColumn("event_time", F.col("snapshot_timestamp").cast("timestamp"))
    return timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(list(FACT_KEYS)).drop("event_time")


def start_fact_dedup(
    facts: DataFrame, table: StoredTable, bitmaps: DeltaStore, checkpoint: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Store each (station, timestamp) once, however late or often it comes.

    ``dedup_stream`` forgets keys behind its watermark and drops rows that come later than that.  Here no key is kept in state:
    repeats within a micro-batch are dropped there, others by the bitmaps of the stored keys, and only rows whose bit is
    set meet the stored keys themselves.  A replayed micro-batch finds its rows stored.
    """

    def load(batch: DataFrame, _: int) -> None:
        load_fact_by_bitmaps(batch.sparkSession, batch, table, bitmaps)

    return facts.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def hourly_stream(staged: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Hourly fact per station.  Grouping by the event-time window bounds the state to ``lateness``."""
    timed = staged.withColumn("event_time", F.col("snapshot_timestamp").cast("timestamp"))
    hours = timed.withWatermark("event_time", lateness).groupBy("station_id", F.window("event_time", "1 hour"))
    start = F.col("window.start").cast("timestamp_ntz")
    calendar = with_calendar(hours.agg(*hourly_measures()).withColumn("slot", start), "slot")
    return calendar.select(*FACT_HOURLY.fieldNames())


def start_hourly(
    staged: DataFrame,
    table: StoredTable,
    checkpoint: str,
    lateness: str = "2 days",
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Keep the hourly fact current: changed hours are replaced by key, so a replay is harmless."""

    def upsert(batch: DataFrame, _: int) -> None:
        incremental_replace(batch.sparkSession, batch, table, *HOURLY_KEYS)

    return (
        hourly_stream(staged, lateness)
        .writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def hourly_states(path: str) -> DeltaStore:
    """The store of mergeable hourly states below a folder."""
    return DeltaStore(path, STATE_SCHEMA, merged)


def start_hourly_states(
    staged: DataFrame, store: DeltaStore, checkpoint: str, stream: str = "hourly", trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Append each micro-batch's states of the hours it touches; ``hourly_from_states(store.read(spark))`` is the fact.

    No state is kept between batches and nothing stored is read, so rows of any age count and a batch writes as much as it
    brings.  A replayed batch replaces what it wrote.  ``stream`` names the checkpoint: another one needs another name.
    """

    def add(batch: DataFrame, number: int) -> None:
        store.append(hourly_state(batch), stream, number)

    return staged.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_silver_upsert(
    bronze: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    boundaries: DataFrame | None = None,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Micro-batches of Bronze rows into both Silver tables; reruns of a batch add nothing."""

    def load(batch: DataFrame, _: int) -> None:
        load_silver(batch.sparkSession, batch, warehouse, boundaries)

    return (
        bronze.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
