import os
import random
from datetime import date
from decimal import Decimal

from helpers import bronze
from pyspark.sql import Window
from pyspark.sql import functions as F

from dockpulse.config import parquet_warehouse
from dockpulse.functions import pick
from dockpulse.operators import gold, loading, ranking, silver, stations
from dockpulse.plans import gold_days
from dockpulse.plans.silver import load_silver
from dockpulse.schemas import FACT_HOURLY


def facts(spark, *changes):
    return silver.stored_fact(silver.project_fact(silver.transform_silver(bronze(spark, *changes))))


def hourly_rows(spark, rows):
    """Hourly facts from (station, date, hour, occupancy, snapshots, empty)."""
    default = {f.name: None for f in FACT_HOURLY}
    full = []
    for station, day, hour, occupancy, snapshots, empty in rows:
        values = default | {
            "station_id": station,
            "snapshot_date": date.fromisoformat(day),
            "snapshot_hour": hour,
            "snapshot_day_of_week": 0,
            "num_snapshots": snapshots,
            "minutes_empty": empty,
            "minutes_full": 0,
            "avg_occupancy_rate": Decimal(occupancy),
            "avg_bikes_available": Decimal("1.00"),
        }
        full.append(tuple(values[f.name] for f in FACT_HOURLY))
    return spark.createDataFrame(full, FACT_HOURLY)


def test_hourly_counts_and_flags(spark):
    rows = facts(
        spark,
        {"numbikesavailable": 0, "numdocksavailable": 20, "ingestion_timestamp": "2026-03-01T10:00:00+01:00"},
        {"numbikesavailable": 20, "numdocksavailable": 0, "ingestion_timestamp": "2026-03-01T10:01:00+01:00"},
        {"is_renting": "NON", "ingestion_timestamp": "2026-03-01T10:59:59+01:00"},
        {"ingestion_timestamp": "2026-03-01T11:00:00+01:00"},
        {"is_installed": "NON", "ingestion_timestamp": "2026-03-01T11:01:00+01:00"},
    )
    first, second = gold.fact_hourly(gold.stg_availability(rows)).orderBy("snapshot_hour").collect()
    assert (first["num_snapshots"], first["minutes_empty"], first["minutes_full"]) == (3, 1, 1)
    assert first["operational_pct"] == Decimal("66.67")
    assert first["avg_bikes_available"] == Decimal("8.33")
    assert (first["snapshot_day_of_week"], second["num_snapshots"]) == (0, 1)


def test_daily_is_an_unweighted_mean_of_hours(spark):
    rows = [("1", "2026-03-01", 7, "10.00", 60, 6), ("1", "2026-03-01", 8, "20.01", 1, 1)]
    day = gold.fact_daily(hourly_rows(spark, rows)).first()
    assert day["avg_occupancy_rate"] == Decimal("15.01")
    assert day["pct_time_empty"] == Decimal("11.48")
    assert (day["active_hours"], day["total_snapshots"], day["peak_hour"]) == (2, 61, 8)


def test_peak_hour_tie_goes_to_the_earliest(spark):
    rows = hourly_rows(spark, [("1", "2026-03-01", h, o, 1, 0) for h, o in ((7, "50.00"), (3, "50.00"), (9, "49.99"))])
    assert gold.fact_daily(rows).first()["peak_hour"] == 3
    by_struct = rows.groupBy("station_id").agg(pick.first_by_desc("snapshot_hour", "avg_occupancy_rate").alias("h"))
    by_array = rows.groupBy("station_id").agg(pick.first_of_array("snapshot_hour", "avg_occupancy_rate").alias("h"))
    assert by_struct.first()["h"] == by_array.first()["h"] == 3


def test_ranks_equal_the_window_function(spark):
    """Ties, NULLs, a NULL group and a group with most of the rows."""
    draw = random.Random(3)
    rows = []
    for i in range(3000):
        group = None if i % 97 == 0 else ("hot" if i % 3 else f"g{i % 11}")
        rate = None if i % 53 == 0 else Decimal(draw.randrange(0, 10001, 25)) / 100
        rows.append((i, group, rate))
    df = spark.createDataFrame(rows, "id int, grp string, rate decimal(5,2)")
    ranked = ranking.with_ranks(
        df,
        "id",
        ranking.Rank("overall", "rate"),
        ranking.Rank("lowest", "rate", descending=False),
        ranking.Rank("inside", "rate", within="grp"),
    )
    window = df.select(
        "*",
        F.rank().over(Window.orderBy(F.desc_nulls_last("rate"))).alias("overall"),
        F.rank().over(Window.orderBy(F.asc_nulls_last("rate"))).alias("lowest"),
        F.rank().over(Window.partitionBy("grp").orderBy(F.desc_nulls_last("rate"))).alias("inside"),
    )
    assert sorted(map(tuple, ranked.collect()), key=lambda r: r[0]) == sorted(map(tuple, window.collect()), key=lambda r: r[0])


def test_rank_refuses_wide_values(spark):
    import pytest

    with pytest.raises(TypeError):
        ranking.with_ranks(spark.range(3).withColumn("v", F.col("id").cast("double")), "id", ranking.Rank("r", "v"))


def test_district_hours_match_the_direct_aggregation(spark):
    rows = [(str(s), f"2026-03-0{d}", h, f"{(s * 7 + d * 3 + h) % 100}.{d}5", s + d, d) for s in range(6) for d in (1, 2, 3) for h in (7, 8)]
    hourly = hourly_rows(spark, rows)
    dim = spark.createDataFrame([(str(s), f"D{s % 2}", "C") for s in range(6)], "station_id string, district_municipality_names string, city string")
    got = gold.district_hour_summary(hourly, dim).select("district_municipality_names", "snapshot_hour", "num_stations", "avg_occupancy_rate", "pct_station_minutes_empty")
    direct = (
        hourly.join(dim, "station_id")
        .groupBy("district_municipality_names", "snapshot_hour")
        .agg(
            F.count_distinct("station_id"),
            F.round(F.sum("avg_occupancy_rate") / F.count("avg_occupancy_rate"), 2),
            F.round(F.sum("minutes_empty") * F.lit(100).cast("decimal(3,0)") / F.sum("num_snapshots"), 2),
        )
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, direct.collect()))


def test_latest_availability_ignores_unknown_stations(spark):
    rows = facts(spark, {}, {"ingestion_timestamp": "2026-02-26T15:00:00+01:00", "numbikesavailable": 9}, {"stationcode": "1"})
    known = stations.stations_dimension(silver.transform_silver(bronze(spark, {})))
    latest = stations.latest_availability(rows, known).collect()
    assert [(r["station_id"], r["num_bikes_available"]) for r in latest] == [("501", 9)]


def test_lookback_of_an_empty_target_covers_everything(spark):
    empty = spark.createDataFrame([], "snapshot_date date")
    assert str(loading.rebuild_from(empty)) == "1900-01-01"
    assert str(loading.rebuild_from(None)) == "1900-01-01"
    one = spark.sql("SELECT DATE '2026-03-01' AS snapshot_date")
    assert str(loading.rebuild_from(one)) == "2026-02-28"


def test_mart_by_days_equals_the_full_build(spark, tmp_path):
    """Late rows, repeated runs, a station's first and last days gone, and a run that was lost halfway."""
    draw, warehouse = random.Random(3), parquet_warehouse(str(tmp_path / "w"))

    def rows(days, stations, seed):
        made = random.Random(seed)
        return bronze(spark, *[
            {"stationcode": s, "ingestion_timestamp": f"2026-02-{d:02d}T{made.randint(0, 23):02d}:{made.randint(0, 59):02d}:00+01:00",
             "numbikesavailable": (b := made.randint(0, 20)), "numdocksavailable": 20 - b}
            for d in days for s in stations for _ in range(3)
        ])

    def hours(rows):
        return gold.fact_hourly(gold.stg_availability(silver.stored_fact(silver.project_fact(silver.transform_silver(rows)))))

    load_silver(spark, rows([1], ["1", "2", "3"], 0), warehouse)
    current = {d: rows([d], ["1", "2", "3"], d) for d in range(1, 6)}

    def check(days):
        everything = None
        for part in current.values():
            everything = part if everything is None else everything.unionByName(part)
        gold_days.refresh(spark, warehouse, hours(everything), [date(2026, 2, d) for d in days])
        dim = warehouse.table("dim_stations").read(spark)
        want = gold.with_station_ranks(gold.station_summary(gold.fact_daily(hours(everything)), dim))
        got = warehouse.table("mart_station_performance").read(spark).drop("built_at")
        assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    check([1, 2, 3, 4, 5])
    check([2, 2])
    current[3] = current[3].unionByName(rows([3], ["1", "4"], 9))
    check([3])
    current[1], current[5] = rows([1], ["1"], 11), rows([5], ["2"], 12)
    check([1, 5])
    current[1] = current[1].where("false")
    check([1])
    os.mkdir(f"{gold_days.totals_table(warehouse).location}.unfinished")
    current[2] = rows([2], ["2", "3"], draw.randint(0, 99))
    check([2])
    assert not os.path.exists(f"{gold_days.totals_table(warehouse).location}.unfinished")
