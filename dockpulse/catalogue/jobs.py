"""Queries: streaming jobs and whole pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockpulse.catalogue import oracle as o
from dockpulse.catalogue.base import CUTOFF, broken_landing, bronze, bronze_path, districts, lake, landing, mixed_lake, query, without
from dockpulse.catalogue.checks import BROKEN_SQL, dq_report_sql
from dockpulse.config import parquet_warehouse
from dockpulse.operators import gold, silver, states
from dockpulse.operators.gold import DISTRICT
from dockpulse.plans import backfill, cleanup, enrich, gold_days, ingest
from dockpulse.plans import gold as gold_plan
from dockpulse.plans import quality as quality_plan
from dockpulse.plans import silver as silver_plan
from dockpulse.schemas import BRONZE_LAKE
from dockpulse.session import move_one, work_path
from dockpulse.sinks.writers import materialize_full, stored_key_bitmaps, write_bronze
from dockpulse.sources.bronze import scan_bronze
from dockpulse.streaming import jobs


def _warehouse(spark):
    return parquet_warehouse(work_path(spark, "warehouse"))


def _bronze_stream(spark, sf):
    """Stored Bronze rows as a file stream."""
    return spark.readStream.schema(BRONZE_LAKE).parquet(bronze_path(spark, sf))


def _finish(job):
    job.awaitTermination()
    if job.exception() is not None:
        raise job.exception()


# All 18 columns of the contract, an extra one of the feed, and the partition; the poll instant is the landing folder's UTC midnight.
LANDED = f"""{o.chain("bronze")}
    SELECT stationcode, name, is_installed, capacity, numdocksavailable, numbikesavailable, mechanical, ebike, is_renting, is_returning,
           CAST(NULL AS VARCHAR) AS duedate, nom_arrondissement_communes, code_insee_commune, lon, lat,
           CAST(NULL AS VARCHAR) AS station_opening_hours,
           strftime(ingestion_timestamp - INTERVAL 1 HOUR, '%Y-%m-%dT01:00:00.000000+01:00') AS ingestion_timestamp,
           strftime(ingestion_timestamp - INTERVAL 1 HOUR, '%Y%m%d_010000') AS snapshot_id, 'op-' || code_insee_commune AS operator,
           strftime(ingestion_timestamp - INTERVAL 1 HOUR, '%Y-%m-%d') AS ingestion_date, 1 AS hour
    FROM bronze"""


@query("stream_ingest", LANDED)
def _(spark, sf):
    path, checkpoint = work_path(spark, "stream-lake"), work_path(spark, "stream-checkpoint")
    job = jobs.stream_ingest(
        spark,
        landing(spark, sf),
        path,
        checkpoint,
        "value string, poll_date date",
        F.col("poll_date").cast("timestamp"),
        extra=("operator",),
    )
    _finish(job)
    return scan_bronze(spark, path, extra=("operator",))


@query("stream_dedup", o.final("fact", "station_id snapshot_timestamp:t occupancy_rate:c"))
def _(spark, sf):
    """Every snapshot arrives twice."""
    twice = _bronze_stream(spark, sf).union(_bronze_stream(spark, sf))
    rows = jobs.dedup_stream(silver.transform_silver(twice))
    path, checkpoint = work_path(spark, "stream-facts"), work_path(spark, "stream-checkpoint")
    columns = ("station_id", "snapshot_timestamp", "occupancy_rate")
    job = (
        rows.select(*columns)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    _finish(job)
    return spark.read.schema(rows.select(*columns).schema).parquet(path)


@query("stream_fact_dedup", o.final("fact", "station_id snapshot_timestamp:t occupancy_rate:c"))
def _(spark, sf):
    """Late days first, then all days twice in small micro-batches: rows weeks behind the newest are stored, and once."""
    table, bitmaps = _warehouse(spark).table("station_availability"), stored_key_bitmaps(work_path(spark, "key-bitmaps"))
    late = F.col("ingestion_date") >= F.lit(CUTOFF).cast("date")
    source = work_path(spark, "late-first")
    for part in (bronze(spark, sf).where(late), bronze(spark, sf), bronze(spark, sf).where(~late)):
        part.drop("hour").coalesce(2).write.mode("append").parquet(source)
        rows = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 2).parquet(source)
        facts = silver.stored_fact(silver.project_fact(silver.transform_silver(rows)))
        _finish(jobs.start_fact_dedup(facts, table, bitmaps, f"{source}-checkpoint"))
    return table.read(spark).select("station_id", "snapshot_timestamp", "occupancy_rate")


@query("stream_hourly", o.final("hourly", o.HOURLY_COLUMNS))
def _(spark, sf):
    table = _warehouse(spark).table("fact_hourly_availability")
    facts = silver.stored_fact(silver.project_fact(silver.transform_silver(_bronze_stream(spark, sf))))
    _finish(jobs.start_hourly(gold.stg_availability(facts), table, work_path(spark, "stream-checkpoint")))
    return table.read(spark)


@query("stream_hourly_states", o.final("hourly", o.HOURLY_COLUMNS))
def _(spark, sf):
    """The hourly fact from appended states: two streams over an early and a late half, a compaction between, and a replayed batch."""
    store, path = jobs.hourly_states(work_path(spark, "hourly-states")), bronze_path(spark, sf)
    rows = spark.readStream.schema(BRONZE_LAKE).option("maxFilesPerTrigger", 3).parquet(path)
    late = F.col("ingestion_date") >= F.lit(CUTOFF).cast("date")
    for name, part in (("early", rows.where(~late)), ("late", rows.where(late))):
        facts = silver.stored_fact(silver.project_fact(silver.transform_silver(part)))
        _finish(jobs.start_hourly_states(gold.stg_availability(facts), store, work_path(spark, "stream-checkpoint"), name))
        if name == "early":
            store.compact(spark)
    staged = gold.stg_availability(silver.stored_fact(silver.project_fact(silver.transform_silver(bronze(spark, sf).where(~late)))))
    store.append(states.hourly_state(staged), "early", 0)
    return states.hourly_from_states(store.read(spark))


@query("stream_silver_upsert", o.final("fact", f"{o.FACT_COLUMNS} {o.CALENDAR_COLUMNS}"))
def _(spark, sf):
    """Facts after the stream ran over the lake twice with separate checkpoints: nothing is doubled."""
    warehouse, path = _warehouse(spark), lake(spark, sf)
    schema = scan_bronze(spark, path).schema
    for _attempt in range(2):
        rows = spark.readStream.schema(schema).parquet(path)
        _finish(jobs.start_silver_upsert(rows, warehouse, work_path(spark, "stream-checkpoint")))
    return without(warehouse.table("station_availability").read(spark))


# Pipelines


@query(
    "run_silver",
    f"""{o.chain("fact")} SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS facts, count(DISTINCT station_id) AS stations
        FROM fact GROUP BY 1""",
)
def _(spark, sf):
    warehouse = _warehouse(spark)
    silver_plan.run(spark, warehouse, lake(spark, sf))
    stored = warehouse.table("station_availability").read(spark)
    return stored.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("facts"), F.count_distinct("station_id").alias("stations")
    )


@query("run_gold", o.final("performance", f"{o.SUMMARY_COLUMNS} {o.GLOBAL_RANK_COLUMNS} district_occupancy_rank:i"))
def _(spark, sf):
    """Gold over the early days, then over all days: the second build is incremental."""
    warehouse, rows = _warehouse(spark), bronze(spark, sf)
    early = F.col("ingestion_date") < F.lit(CUTOFF).cast("date")
    for part in (rows.where(early), rows.where(~early)):
        silver_plan.load_silver(spark, part, warehouse)
        gold_plan.run(spark, warehouse)
    return without(warehouse.table("mart_station_performance").read(spark))


@query("gold_by_days", o.final("performance", f"{o.SUMMARY_COLUMNS} {o.GLOBAL_RANK_COLUMNS} district_occupancy_rank:i"))
def _(spark, sf):
    """The stations' mart by days: half of the late days' hours first, then all days in three runs, a wrong day and its removal."""
    warehouse, path = _warehouse(spark), lake(spark, sf)
    silver_plan.run(spark, warehouse, path)
    hours = gold.fact_hourly(gold.stg_availability(warehouse.table("station_availability").read(spark)))
    days = sorted(r["snapshot_date"] for r in hours.select("snapshot_date").distinct().collect())
    early = [d for d in days if str(d) < CUTOFF]
    late = [d for d in days if str(d) >= CUTOFF]
    wrong = days[0].replace(year=days[0].year - 1)
    gold_days.refresh(spark, warehouse, hours.where("snapshot_hour < 12"), late)
    gold_days.refresh(spark, warehouse, hours, early)
    moved = hours.where(F.col("snapshot_date") == F.lit(early[0])).withColumn("snapshot_date", F.lit(wrong))
    gold_days.refresh(spark, warehouse, moved, [wrong])
    gold_days.refresh(spark, warehouse, hours, [*late, wrong])
    return without(warehouse.table("mart_station_performance").read(spark))


# What the damaged tables break, by test; every other test finds nothing.
DAMAGE = {
    "not_null_stations_station_name": "SELECT count(*) FROM stations WHERE capacity > 35",
    "unique_stations_station_id": "SELECT count(*) FROM stations WHERE capacity BETWEEN 11 AND 14",
    "unique_stg_stations_station_id": "SELECT count(*) FROM stg_stations WHERE capacity BETWEEN 11 AND 14",
    "relationships_station_availability": "SELECT count(*) FROM fact WHERE station_id IN (SELECT station_id FROM stations WHERE capacity = 20)",
    "not_null_dim_stations_capacity": "SELECT count(*) FROM dim WHERE capacity = 30",
    "accepted_values_capacity_category": "SELECT count(DISTINCT capacity) FROM dim WHERE capacity > 40",
    "accepted_values_snapshot_hour": "SELECT count(DISTINCT snapshot_hour) FROM hourly WHERE snapshot_hour >= 20",
    "not_null_fact_daily_station_stats_snapshot_date": "SELECT count(*) FROM daily WHERE active_hours = 1",
    "unique_mart_station_performance_station_id": "SELECT count(*) FROM performance WHERE total_snapshots >= 5",
    "not_null_mart_peak_hours_by_district_snapshot_hour": "SELECT count(*) FROM peak_hours WHERE snapshot_hour < 3",
}
TESTS = [f"not_null_{t}_{c}" for t, columns in gold_plan.REQUIRED.items() for c in columns]
TESTS += [f"unique_{t}_station_id" for t in gold_plan.UNIQUE_STATION]
TESTS += ["accepted_values_capacity_category", "accepted_values_snapshot_hour", gold_plan.ORPHAN_TEST]


@query(
    "gold_checks",
    f"""{o.chain("fact", "stg_stations", "dim", "daily", "performance", "peak_hours")}
    SELECT test_name, CAST(CASE test_name {" ".join(f"WHEN '{t}' THEN ({sql})" for t, sql in DAMAGE.items())} ELSE 0 END AS BIGINT) AS violations
    FROM (VALUES {", ".join(f"('{t}')" for t in TESTS)}) AS v(test_name)""",
)
def _(spark, sf):
    """All 30 table tests on a built warehouse, ten of whose tests are then broken by damage to the stored tables."""
    warehouse = _warehouse(spark)
    silver_plan.load_silver(spark, bronze(spark, sf), warehouse)
    gold_plan.run(spark, warehouse, incremental=False)

    def damage(name, change):
        table = warehouse.table(name)
        materialize_full(change(table.read(spark)), table)

    def unnamed(rows):
        rows = rows.where("capacity <> 20").withColumn("station_name", F.when(F.col("capacity") <= 35, F.col("station_name")))
        return rows.unionByName(rows.where("capacity BETWEEN 11 AND 14"))

    huge = F.when(F.col("capacity") > 40, F.concat(F.lit("huge"), "capacity")).otherwise(F.col("capacity_category"))
    late = F.when(F.col("snapshot_hour") >= 20, F.col("snapshot_hour") + 10).otherwise(F.col("snapshot_hour"))
    damage("stations", unnamed)
    damage("dim_stations", lambda rows: rows.withColumns({"capacity_category": huge, "capacity": F.when(F.col("capacity") != 30, F.col("capacity"))}))
    damage("fact_hourly_availability", lambda rows: rows.withColumn("snapshot_hour", late))
    damage("fact_daily_station_stats", lambda rows: rows.withColumn("snapshot_date", F.when(F.col("active_hours") > 1, F.col("snapshot_date"))))
    damage("mart_station_performance", lambda rows: rows.unionByName(rows.where("total_snapshots >= 5")))
    damage("mart_peak_hours_by_district", lambda rows: rows.withColumn("snapshot_hour", F.when(F.col("snapshot_hour") >= 3, F.col("snapshot_hour"))))
    return gold_plan.check_results(spark, warehouse)


def _backfilled(spark, sf):
    """The late half is loaded and in Gold; the backfill loads the early half.

    The lake also holds rows without a readable time, and a day without a valid row; neither may block anything.
    """
    warehouse, path = _warehouse(spark), work_path(spark, "backfill-lake")
    rows = bronze(spark, sf)
    late = F.col("ingestion_date") >= F.lit(CUTOFF).cast("date")
    invalid = F.col("invalid")
    damaged = rows.where("stationcode = '1'").withColumn("invalid", F.explode(F.array(F.lit(False), F.lit(True)))).withColumns(
        {
            "ingestion_timestamp": F.when(invalid, F.col("ingestion_timestamp")).otherwise("unreadable"),
            "capacity": F.when(invalid, F.lit(0).cast("bigint")).otherwise(F.col("capacity")),
            "ingestion_date": F.when(invalid, F.lit("2023-12-31").cast("date")),
        }
    )
    write_bronze(rows.unionByName(damaged.drop("invalid")), path)
    silver_plan.load_silver(spark, scan_bronze(spark, path).where(late), warehouse)
    gold_plan.run(spark, warehouse)
    backfill.run(spark, warehouse, path, apply=True, days_per_run=8)
    if backfill.run(spark, warehouse, path).pending:
        raise AssertionError("days stay pending")
    return warehouse


@query("run_backfill", o.final("hourly", o.HOURLY_COLUMNS))
def _(spark, sf):
    return _backfilled(spark, sf).table("fact_hourly_availability").read(spark)


@query("run_backfill_daily", o.final("daily", o.DAILY_COLUMNS))
def _(spark, sf):
    return without(_backfilled(spark, sf).table("fact_daily_station_stats").read(spark))


SUMMARY_GAP = ("2024-01-08", "2024-01-27")


@query(
    "run_summary",
    f"""{o.chain("fact")} SELECT strftime(date_trunc('hour', snapshot_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS snapshot_hour,
           count(*) AS rows_added, count(DISTINCT station_id) AS stations_count
        FROM fact WHERE snapshot_date NOT BETWEEN DATE '{SUMMARY_GAP[0]}' AND DATE '{SUMMARY_GAP[1]}'
        GROUP BY 1 ORDER BY 1 DESC LIMIT 100""",
)
def _(spark, sf):
    """The latest 100 hours of a table with a gap of three weeks."""
    warehouse, rows = _warehouse(spark), bronze(spark, sf)
    first, last = (F.lit(day).cast("date") for day in SUMMARY_GAP)
    silver_plan.load_silver(spark, rows.where(~F.col("ingestion_date").between(first, last)), warehouse)
    return silver_plan.summary(spark, warehouse, 100)[1]


@query("run_enrichment", o.final("districts", "station_id district_municipality_names"))
def _(spark, sf):
    warehouse = _warehouse(spark)
    silver_plan.load_silver(spark, bronze(spark, sf), warehouse)
    enrich.run(spark, warehouse, districts(spark, sf))
    return warehouse.table("stations").read(spark).select("station_id", DISTRICT)


@query(
    "run_cleanup",
    f"""{o.chain("bronze")},
    numbered AS (SELECT *, dense_rank() OVER (PARTITION BY ingestion_date, hour, date_trunc('minute', ingestion_timestamp) ORDER BY snapshot_id)
                 AS place FROM bronze),
    kept AS (SELECT DISTINCT ingestion_date, hour, snapshot_id, stationcode FROM numbered WHERE place = 1)
    SELECT k.snapshot_id, k.stationcode, CAST(1 AS BIGINT) AS corrupted_files,
           (SELECT 2 * count(*) FROM bronze) - (SELECT count(*) FROM kept) AS duplicate_rows FROM kept k""",
)
def _(spark, sf):
    """A lake of its own, with every row twice and an unreadable file: the first snapshot of each minute is left, once."""
    warehouse, path = _warehouse(spark), work_path(spark, "cleanup-lake")
    write_bronze(bronze(spark, sf).unionByName(bronze(spark, sf)), path, skip_stored=False)
    newest = bronze(spark, sf).agg(F.max("ingestion_date")).first()[0]
    spark.range(1).selectExpr("'no parquet' AS value").coalesce(1).write.mode("append").text(f"{path}/broken")
    move_one(spark, f"{path}/broken", f"{path}/ingestion_date={newest}/hour=12/snapshot_20240130_120000.parquet")
    cleaned, _run = cleanup.run(spark, warehouse, path)
    return scan_bronze(spark, path).select(
        "snapshot_id",
        "stationcode",
        F.lit(cleaned.corrupted_files).cast("bigint").alias("corrupted_files"),
        F.lit(cleaned.duplicate_rows).cast("bigint").alias("duplicate_rows"),
    )


@query("run_ingest", LANDED)
def _(spark, sf):
    path = work_path(spark, "ingested-lake")
    ingest.run(spark, landing(spark, sf), path, F.col("poll_date").cast("timestamp"), lines=True)
    return scan_bronze(spark, path, extra=("operator",))


@query(
    "run_quality",
    f"""{o.chain("bronze")},
    twice AS (
        SELECT * REPLACE ('last' AS snapshot_id, CASE WHEN stationcode LIKE ' %' THEN numbikesavailable * 5 ELSE numbikesavailable END AS numbikesavailable)
        FROM bronze WHERE ingestion_date = (SELECT max(ingestion_date) FROM bronze)
        UNION ALL SELECT * REPLACE ('last' AS snapshot_id) FROM bronze
        WHERE ingestion_date = (SELECT max(ingestion_date) FROM bronze) AND NOT starts_with(stationcode, ' ')),
    {dq_report_sql("twice")}
    SELECT total_rows, passed AS tests_passed, 6 - passed AS tests_failed, CAST(passed AS DOUBLE) / 6 * 100 AS success_rate, details FROM judged""",
)
def _(spark, sf):
    """The stored report of the newest file of a lake: its last day with rows twice and too many bikes, behind a newer unreadable file."""
    path, reports = work_path(spark, "quality-lake"), work_path(spark, "reports")
    rows = bronze(spark, sf)
    last = rows.where(F.col("ingestion_date") == F.lit(rows.agg(F.max("ingestion_date")).first()[0]))
    padded = F.col("stationcode").startswith(" ")
    bikes = F.when(padded, F.col("numbikesavailable") * 5).otherwise(F.col("numbikesavailable"))
    write_bronze(rows.where(F.col("ingestion_date") < F.lit(CUTOFF).cast("date")), path, skip_stored=False)
    file = last.withColumn("numbikesavailable", bikes).unionByName(last.where(~padded))
    file.drop("ingestion_date", "hour").coalesce(1).write.parquet(f"{path}/newest")
    spark.range(1).selectExpr("'no parquet' AS value").coalesce(1).write.text(f"{path}/broken")
    move_one(spark, f"{path}/broken", f"{path}/newest/snapshot_20240130_230000.parquet")
    quality_plan.run(spark, path, reports, F.lit("2024-01-30 23:00:00+00:00").cast("timestamp"), gate=0.0)
    lines = F.transform(
        "details", lambda d: F.concat(F.when(d["passed"], "PASS ").otherwise("FAIL "), d["check"], F.lit(": "), d["message"])
    )
    return spark.read.parquet(reports).select("total_rows", "tests_passed", "tests_failed", "success_rate", F.array_join(lines, "\n").alias("details"))


@query(
    "run_cleanup_mixed",
    f"""{o.chain("bronze")},
    numbered AS (SELECT *, dense_rank() OVER (PARTITION BY ingestion_date, hour, date_trunc('minute', ingestion_timestamp) ORDER BY snapshot_id)
                 AS place FROM bronze),
    kept AS (SELECT DISTINCT ON (ingestion_date, hour, snapshot_id, stationcode) *, ingestion_date >= DATE '{CUTOFF}' AS late FROM numbered WHERE place = 1)
    SELECT k.snapshot_id, k.stationcode, k.capacity, CASE WHEN late THEN 'c' ELSE '' END || k.capacity AS x, CAST(2 AS BIGINT) AS corrupted_files,
           (SELECT 2 * count(*) FROM bronze) - (SELECT count(*) FROM kept) AS duplicate_rows FROM kept k""",
)
def _(spark, sf):
    """Cleanup of a lake whose files disagree about two columns' types; the contract's column gets its type back, the other becomes text."""
    warehouse, path = _warehouse(spark), mixed_lake(spark, sf)
    cleaned, _run = cleanup.run(spark, warehouse, path)
    return scan_bronze(spark, path, extra=("x",)).select(
        "snapshot_id", "stationcode", "capacity", "x",
        F.lit(cleaned.corrupted_files).cast("bigint").alias("corrupted_files"),
        F.lit(cleaned.duplicate_rows).cast("bigint").alias("duplicate_rows"),
    )


@query("stream_quarantine", BROKEN_SQL)
def _(spark, sf):
    """Set aside by a stream that ran twice with one checkpoint, in the same form as in batch."""
    folder, checkpoint = work_path(spark, "stream-quarantine"), work_path(spark, "stream-checkpoint")
    for _attempt in range(2):
        _finish(jobs.stream_quarantine(spark, broken_landing(spark, sf), folder, checkpoint, "value string, poll_date date"))
    return spark.read.parquet(folder).select("reason", "value")

