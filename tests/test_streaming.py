from datetime import datetime

from helpers import bronze
from pyspark.sql import functions as F

from dockpulse.config import parquet_warehouse
from dockpulse.operators import gold, silver
from dockpulse.schemas import BRONZE
from dockpulse.sinks import writers
from dockpulse.sources.bronze import scan_bronze
from dockpulse.streaming import jobs


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def stream(spark, path):
    return spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", 1).parquet(path)


def facts(rows):
    return silver.stored_fact(silver.project_fact(silver.transform_silver(rows)))


def append(spark, path, *changes):
    bronze(spark, *changes).coalesce(1).write.mode("append").parquet(path)


def test_hourly_takes_late_rows_and_restarts(spark, folder):
    source, table = f"{folder}/in", parquet_warehouse(f"{folder}/wh").table("fact_hourly_availability")
    append(spark, source, {"numbikesavailable": 4}, {"ingestion_timestamp": "2026-02-26T15:10:00+01:00"})
    finish(jobs.start_hourly(gold.stg_availability(facts(stream(spark, source))), table, f"{folder}/cp"))
    append(spark, source, {"ingestion_timestamp": "2026-02-26T14:59:00+01:00", "numbikesavailable": 8})
    finish(jobs.start_hourly(gold.stg_availability(facts(stream(spark, source))), table, f"{folder}/cp"))
    got = sorted(map(tuple, table.read(spark).select("snapshot_hour", "num_snapshots", "avg_bikes_available").collect()))
    want = gold.fact_hourly(gold.stg_availability(facts(spark.read.parquet(source))))
    assert got == sorted(map(tuple, want.select("snapshot_hour", "num_snapshots", "avg_bikes_available").collect()))
    assert got[0][1] == 2


def test_dedup_across_batches(spark, folder):
    append(spark, f"{folder}/in", {}, {})
    append(spark, f"{folder}/in", {}, {"stationcode": "2"})
    rows = jobs.dedup_stream(silver.transform_silver(stream(spark, f"{folder}/in"))).select("station_id", "snapshot_timestamp")
    finish(
        rows.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp")
        .trigger(availableNow=True)
        .start()
    )
    out = spark.read.schema(rows.schema).parquet(f"{folder}/out")
    assert sorted(map(tuple, out.collect())) == [("2", datetime(2026, 2, 26, 14)), ("501", datetime(2026, 2, 26, 14))]


def test_silver_upsert_over_batches(spark, folder):
    warehouse = parquet_warehouse(f"{folder}/wh")
    append(spark, f"{folder}/in", {}, {"capacity": 0})
    append(spark, f"{folder}/in", {}, {"ingestion_timestamp": "2026-02-26T14:01:00+01:00"})
    for _ in range(2):
        finish(jobs.start_silver_upsert(stream(spark, f"{folder}/in"), warehouse, f"{folder}/cp"))
    assert warehouse.table("station_availability").read(spark).count() == 2
    assert warehouse.table("stations").read(spark).count() == 1


def test_ingest_lands_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing" / "poll_date=2026-02-26"
    landing.mkdir(parents=True)
    (landing / "a.json").write_text('[{"stationcode":"1","capacity":3}]\n{"results":[{"stationcode":"2","capacity":4}]}\n')
    for round_ in range(2):
        finish(
            jobs.stream_ingest(
                spark,
                str(tmp_path / "landing"),
                str(tmp_path / "lake"),
                str(tmp_path / "cp"),
                "value string, poll_date date",
                F.col("poll_date").cast("timestamp"),
            )
        )
        rows = scan_bronze(spark, str(tmp_path / "lake"), "2026-02-26", 1)
        assert sorted(r["stationcode"] for r in rows.collect()) == ["1", "2"], round_


def test_rows_ten_days_late_and_repeated(spark, folder):
    """What the watermark of ``dedup_stream`` would drop is stored, and once."""
    source = f"{folder}/in"
    table, bitmaps = parquet_warehouse(f"{folder}/wh").table("station_availability"), writers.stored_key_bitmaps(f"{folder}/bits")
    new, late = {"ingestion_timestamp": "2026-02-26T14:00:00+01:00"}, {"ingestion_timestamp": "2026-02-16T14:00:00+01:00"}
    half = {"ingestion_timestamp": "2026-02-16T14:00:00.500000+01:00"}
    for changes in ((new, new), (late, late, new), (late, half, late | {"stationcode": "9"}), (half, new)):
        append(spark, source, *changes)
        finish(jobs.start_fact_dedup(facts(stream(spark, source)), table, bitmaps, f"{folder}/cp"))
    found = sorted((r["station_id"], str(r["snapshot_timestamp"])) for r in table.read(spark).collect())
    times = ["2026-02-16 14:00:00", "2026-02-16 14:00:00.500000", "2026-02-26 14:00:00"]
    assert found == [*(("501", t) for t in times), ("9", times[0])]


def test_quarantine_reads_landed_parts_apart(spark, tmp_path, monkeypatch):
    """Eight landed files that are parts of their own meet eight tasks, each of which writes what it found."""
    folder = tmp_path / "landing"
    folder.mkdir()
    for i in range(8):
        (folder / f"{i}.txt").write_text(f"broken {i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8")
    try:
        finish(jobs.stream_quarantine(spark, str(folder), str(tmp_path / "aside"), str(tmp_path / "cp"), "value string"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = spark.read.parquet(str(tmp_path / "aside"))
    assert found.select("value").distinct().count() == found.count() == 8
    assert found.select(F.input_file_name()).distinct().count() == 8
