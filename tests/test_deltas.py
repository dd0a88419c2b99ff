"""Stored states of the hourly fact: merging, replay, compaction."""

import random

import pytest
from helpers import bronze
from pyspark.sql import functions as F

from dockpulse.config import parquet_warehouse
from dockpulse.operators import gold, key_bitmaps, silver, states
from dockpulse.schemas import BRONZE
from dockpulse.sinks import writers
from dockpulse.streaming import jobs


def staged(rows):
    return gold.stg_availability(silver.stored_fact(silver.project_fact(silver.transform_silver(rows))))


def many(spark, seed, count):
    draw, changes = random.Random(seed), []
    for _ in range(count):
        day, hour, minute = draw.randint(1, 3), draw.randint(0, 2), draw.randint(0, 59)
        bikes = draw.randint(0, 20)
        changes.append({
            "stationcode": str(draw.randint(1, 3)), "ingestion_timestamp": f"2026-02-0{day}T0{hour}:{minute:02d}:00+01:00",
            "numbikesavailable": bikes, "numdocksavailable": 20 - bikes, "mechanical": bikes // 3, "ebike": draw.choice([None, 1]),
            "is_renting": draw.choice(["OUI", "NON"]),
        })
    return bronze(spark, *changes)


def same(one, two):
    assert one.columns == two.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("snapshot_date=*"))


def test_states_however_dealt_give_the_fact(spark):
    rows = staged(many(spark, 1, 300)).cache()
    part = F.pmod(F.xxhash64("station_id", "snapshot_timestamp"), F.lit(4))
    pieces = [states.hourly_state(rows.where(part == i)) for i in range(4)]
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece)
    same(states.hourly_from_states(out), gold.fact_hourly(rows))
    same(states.hourly_from_states(states.merged(out)), gold.fact_hourly(rows))
    assert {f.name: f.dataType for f in states.hourly_state(rows).schema} == {f.name: f.dataType for f in states.STATE_SCHEMA}


def test_replay_and_compaction(spark, tmp_path):
    store, batches = jobs.hourly_states(str(tmp_path / "s")), [staged(many(spark, seed, 60)) for seed in (2, 3, 4)]
    everything = batches[0].unionByName(batches[1]).unionByName(batches[2])
    assert states.hourly_from_states(store.read(spark)).count() == 0 and store.compact(spark) == 0
    for number, batch in enumerate(batches[:2]):
        store.append(states.hourly_state(batch), "a", number)
        store.append(states.hourly_state(batch), "a", number)
    same(states.hourly_from_states(store.read(spark)), gold.fact_hourly(batches[0].unionByName(batches[1])))
    assert store.compact(spark) == 2 and store.compact(spark) == 0
    assert not [f for f in folders(tmp_path) if "pending" in f]
    store.append(states.hourly_state(batches[1]), "a", 1)
    store.append(states.hourly_state(batches[2]), "a", 2)
    same(states.hourly_from_states(store.read(spark)), gold.fact_hourly(everything))
    store.append(states.hourly_state(batches[0].where("false")), "a", 3)
    assert store.compact(spark) == 2
    same(states.hourly_from_states(store.read(spark)), gold.fact_hourly(everything))
    days = [f.rsplit("=", 1)[1] for f in folders(tmp_path)]
    assert len(days) == len(set(days)) == 3
    one = gold.fact_hourly(everything.where("snapshot_date = DATE '2026-02-02'"))
    same(states.hourly_from_states(store.read(spark, "2026-02-02", "2026-02-02")), one)


def test_compaction_lost_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    store, batch = jobs.hourly_states(str(tmp_path / "s")), staged(many(spark, 5, 60))
    store.append(states.hourly_state(batch), "a", 0)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        store.compact(spark)
    monkeypatch.undo()
    assert [f for f in folders(tmp_path) if "folded" in f]
    same(states.hourly_from_states(store.read(spark)), gold.fact_hourly(batch))
    assert store.compact(spark) == 1
    same(states.hourly_from_states(store.read(spark)), gold.fact_hourly(batch))


def test_a_batch_writes_what_it_brings(spark, tmp_path):
    """However much the day holds already, and however late the rows are."""
    store = jobs.hourly_states(str(tmp_path / "s"))
    store.append(states.hourly_state(staged(many(spark, 6, 2000))), "a", 0)
    store.compact(spark)
    before = {p for p in tmp_path.rglob("*.parquet")}
    store.append(states.hourly_state(staged(many(spark, 7, 1))), "a", 1)
    fresh = [p for p in tmp_path.rglob("*.parquet") if p not in before]
    assert sum(len(spark.read.parquet(str(p)).collect()) for p in fresh) == 1


def test_stream_takes_rows_of_any_age(spark, tmp_path):
    source, store = str(tmp_path / "in"), jobs.hourly_states(str(tmp_path / "s"))
    for changes in ({"ingestion_timestamp": "2026-02-26T15:10:00+01:00"}, {"ingestion_timestamp": "2026-02-10T15:10:00+01:00"}):
        bronze(spark, changes, changes | {"stationcode": "7"}).coalesce(1).write.mode("append").parquet(source)
        rows = spark.readStream.schema(BRONZE).parquet(source)
        job = jobs.start_hourly_states(staged(rows), store, str(tmp_path / "cp"))
        job.awaitTermination()
        assert job.exception() is None
    same(states.hourly_from_states(store.read(spark)), gold.fact_hourly(staged(spark.read.parquet(source))))


def test_bits_are_the_seconds(spark):
    times = ["00:00:00", "00:00:07", "00:00:08", "09:06:07", "09:06:08", "12:34:56.5", "18:12:15", "18:12:16", "23:59:59"]
    rows = spark.createDataFrame([("s", t) for t in times], "station_id string, t string")
    rows = rows.select("station_id", F.concat(F.lit("2026-02-26 "), "t").cast("timestamp_ntz").alias("snapshot_timestamp"))
    asked = spark.range(86400).select(
        F.lit("s").alias("station_id"), F.expr("TIMESTAMP_NTZ '2026-02-26 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("snapshot_timestamp")
    )
    found = key_bitmaps.with_maybe_stored(asked, key_bitmaps.key_bitmaps(rows)).where("maybe_stored").collect()
    assert sorted(r["snapshot_timestamp"].strftime("%H:%M:%S") for r in found) == [t[:8] for t in times]
    other = key_bitmaps.with_maybe_stored(asked.withColumn("station_id", F.lit("x")), key_bitmaps.key_bitmaps(rows))
    assert other.where("maybe_stored").count() == 0


def loaded(spark, load, tmp_path, name):
    table = parquet_warehouse(str(tmp_path / name)).table("station_availability")
    written = [load(staged_facts(spark, seed, count), table).rows_written for seed, count in ((1, 80), (2, 80), (1, 80), (3, 1))]
    return table.read(spark).drop("processing_timestamp"), written


def staged_facts(spark, seed, count):
    return silver.stored_fact(silver.project_fact(silver.transform_silver(many(spark, seed, count))))


def test_load_by_bitmaps_equals_load_by_keys(spark, tmp_path):
    bitmaps = writers.stored_key_bitmaps(str(tmp_path / "bits"))
    plain, counts = loaded(spark, lambda rows, table: writers.load_fact_dedup(spark, rows, table), tmp_path, "a")
    found, more = loaded(spark, lambda rows, table: writers.load_fact_by_bitmaps(spark, rows, table, bitmaps), tmp_path, "b")
    same(plain, found)
    assert counts == more and counts[2] == 0


def test_new_keys_need_no_stored_key(spark, tmp_path, monkeypatch):
    """A batch of new seconds never reads the fact."""
    table, bitmaps = parquet_warehouse(str(tmp_path / "w")).table("station_availability"), writers.stored_key_bitmaps(str(tmp_path / "bits"))
    rows = staged_facts(spark, 4, 50)
    late = F.col("snapshot_date") >= F.lit("2026-02-02").cast("date")
    writers.load_fact_by_bitmaps(spark, rows.where(~late), table, bitmaps)
    monkeypatch.setattr(writers, "scan_window", lambda *_: pytest.fail("read the stored keys"))
    writers.load_fact_by_bitmaps(spark, rows.where(late), table, bitmaps)
    assert table.read(spark).count() == rows.dropDuplicates(["station_id", "snapshot_timestamp"]).count()


def test_load_lost_behind_its_bitmaps_is_repeated(spark, tmp_path, monkeypatch):
    table, bitmaps = parquet_warehouse(str(tmp_path / "w")).table("station_availability"), writers.stored_key_bitmaps(str(tmp_path / "bits"))
    rows = staged_facts(spark, 5, 40)
    monkeypatch.setattr(writers, "write_table", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        writers.load_fact_by_bitmaps(spark, rows, table, bitmaps)
    monkeypatch.undo()
    keys = rows.dropDuplicates(["station_id", "snapshot_timestamp"]).count()
    assert writers.load_fact_by_bitmaps(spark, rows, table, bitmaps).rows_written == keys
    assert writers.load_fact_by_bitmaps(spark, rows, table, bitmaps).rows_written == 0


def test_a_lone_key_is_a_short_row(spark):
    rows = spark.createDataFrame([("s", "2026-02-26 09:06:07")], "station_id string, t string")
    (row,) = key_bitmaps.key_bitmaps(rows.select("station_id", F.col("t").cast("timestamp_ntz").alias("snapshot_timestamp"))).collect()
    bits = [v for k, v in row.asDict().items() if k.startswith("bits")]
    assert len(bits) <= 16 and sum(bin(v & (1 << 64) - 1).count("1") for v in bits) == 1
