from datetime import datetime
from decimal import Decimal

import pytest
from helpers import bronze
from pyspark.sql import Observation
from pyspark.sql import functions as F

from dockpulse.functions import clock, numeric, text
from dockpulse.operators import silver, stations


def column(df, name):
    return [row[name] for row in df.select(name).collect()]


@pytest.mark.parametrize(
    ("token", "expected"),
    [(" oui ", True), ("YES", True), ("true", True), ("1", True), (None, True), ("NON", False), ("", False), ("maybe", False)],
)
def test_status_tokens(spark, token, expected):
    rows = silver.enrich(bronze(spark, {"is_installed": token}))
    assert column(rows, "is_installed") == [expected]
    assert column(rows, "is_operational") == [expected]


def test_unreadable_integers_become_zero(spark):
    rows = bronze(spark, {}).withColumn("capacity", F.lit("abc")).withColumn("ebike", F.lit(None).cast("string"))
    clean = silver.normalize_columns(rows)
    assert column(clean, "capacity") == [0]
    assert column(clean, "num_bikes_available_ebike") == [0]


def test_integer_overflow_becomes_zero(spark):
    assert column(silver.normalize_columns(bronze(spark, {"capacity": 2**40})), "capacity") == [0]


def test_zero_or_missing_capacity_gives_zero_rates_and_is_rejected(spark):
    rows = silver.enrich(bronze(spark, {"capacity": 0}, {"capacity": None}))
    assert column(rows, "occupancy_rate") == [Decimal("0.00")] * 2
    assert silver.filter_valid(rows).count() == 0
    assert silver.quarantine(rows).count() == 2


def test_rates_are_clamped(spark):
    rows = silver.enrich(bronze(spark, {"numbikesavailable": 30, "numdocksavailable": -2}))
    row = rows.select("occupancy_rate", "availability_rate", "service_rate").first()
    assert row == (Decimal("100.00"), Decimal("0.00"), Decimal("100.00"))


@pytest.mark.parametrize(("bikes", "capacity", "expected"), [(1, 32, "3.13"), (1, 160, "0.63"), (1, 3, "33.33"), (2, 3, "66.67"), (7, 17, "41.18")])
def test_rates_round_half_up(spark, bikes, capacity, expected):
    rows = silver.enrich(bronze(spark, {"numbikesavailable": bikes, "capacity": capacity}))
    assert column(rows, "occupancy_rate") == [Decimal(expected)]


@pytest.mark.parametrize("change", [{"stationcode": "  "}, {"stationcode": None}, {"numbikesavailable": -1}, {"numdocksavailable": -1}, {"ingestion_timestamp": "soon"}])
def test_invalid_rows(spark, change):
    rows = silver.enrich(bronze(spark, change, {}))
    assert silver.filter_valid(rows).count() == 1
    assert silver.quarantine(rows).count() == 1


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Paris"])
def test_offsets_become_local_wall_clock_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = silver.enrich(
            bronze(
                spark,
                {"ingestion_timestamp": "2026-02-26T14:00:00+01:00"},
                {"ingestion_timestamp": "2026-07-26T14:00:00+02:00"},
                {"ingestion_timestamp": "2026-07-26T12:00:00.250+00:00"},
            )
        )
        assert column(rows, "snapshot_timestamp") == [
            datetime(2026, 2, 26, 14),
            datetime(2026, 7, 26, 14),
            datetime(2026, 7, 26, 14, 0, 0, 250000),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_repeated_autumn_hour_is_one_key(spark):
    rows = silver.transform_silver(
        bronze(
            spark,
            {"ingestion_timestamp": "2026-10-25T02:30:00+02:00", "numbikesavailable": 4},
            {"ingestion_timestamp": "2026-10-25T02:30:00+01:00", "numbikesavailable": 9},
        )
    )
    kept = silver.dedup_in_batch(rows)
    assert column(kept, "snapshot_timestamp") == [datetime(2026, 10, 25, 2, 30)]
    again = silver.dedup_in_batch(rows.orderBy(F.desc("num_bikes_available")))
    assert column(kept, "num_bikes_available") == column(again, "num_bikes_available")


def test_dedup_keeps_nulls_and_every_key(spark):
    rows = silver.transform_silver(bronze(spark, {"name": None}, {"name": None}, {"stationcode": "7"}))
    kept = silver.dedup_in_batch(rows)
    assert sorted(column(kept, "station_id")) == ["501", "7"]
    assert None in column(kept, "station_name")


def test_metrics_are_collected_in_the_same_pass(spark):
    metrics = Observation()
    silver.transform_silver(bronze(spark, {}, {"capacity": 0}, {"stationcode": ""}), metrics).collect()
    assert metrics.get == {"rows_read": 3, "rows_rejected": 2}


def test_calendar(spark):
    sunday = spark.sql("SELECT TIMESTAMP_NTZ '2026-03-01 23:59:59' AS snapshot_timestamp")
    row = clock.with_calendar(sunday).first()
    assert (str(row["snapshot_date"]), row["snapshot_hour"], row["snapshot_day_of_week"]) == ("2026-03-01", 23, 0)


def test_previous_hour_crosses_midnight_and_offset(spark):
    one = spark.range(1)
    at = F.lit("2026-02-25T23:10:00+00:00").cast("timestamp")
    day, hour = clock.previous_hour(at)
    assert tuple(one.select(day, hour).first()) == ("2026-02-25", "23")


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("snapshot_20260226_140500.parquet", datetime(2026, 2, 26, 14, 5)),
        ("snapshot_20261399_000000.parquet", None),
        ("snapshot_20260226_140500.parquet.tmp", None),
        ("x.parquet", None),
    ],
)
def test_snapshot_names(spark, name, expected):
    assert spark.range(1).select(text.parse_snapshot_name(F.lit(name))).first()[0] == expected


@pytest.mark.parametrize(("capacity", "expected"), [(10, "small"), (11, "medium"), (20, "medium"), (21, "large"), (35, "large"), (36, "extra_large")])
def test_capacity_category(spark, capacity, expected):
    assert spark.range(1).select(text.capacity_category(F.lit(capacity))).first()[0] == expected


@pytest.mark.parametrize(("district", "expected"), [("Paris 11e Arrondissement", "Paris"), ("PARIS", "Paris"), ("Vincennes", "Vincennes"), (None, None)])
def test_city(spark, district, expected):
    assert spark.range(1).select(text.city_label(F.lit(district).cast("string"))).first()[0] == expected


def test_mean_rounds_once_from_the_exact_sum(spark):
    values = spark.createDataFrame([(1,), (0,), (0,), (0,), (0,), (0,), (0,), (0,)], "v int")
    row = values.agg(numeric.mean2("v").alias("m"), numeric.share2("v", F.lit(1)).alias("s")).first()
    assert row == (Decimal("0.13"), Decimal("12.50"))
    assert values.where("v > 5").agg(numeric.mean2("v").alias("m")).first()[0] is None


def test_station_history(spark):
    rows = silver.transform_silver(
        bronze(
            spark,
            {"ingestion_timestamp": "2026-02-26T14:00:00+01:00", "name": "old"},
            {"ingestion_timestamp": "2026-02-26T15:00:00+01:00", "name": None},
            {"ingestion_timestamp": "2026-02-26T15:00:00+01:00", "name": "new"},
            {"ingestion_timestamp": "2026-02-26T14:30:00+01:00", "name": "old"},
        )
    )
    row = stations.stations_dimension(rows).first()
    assert row["station_name"] == "new"
    assert (row["first_seen_at"], row["last_seen_at"]) == (datetime(2026, 2, 26, 14), datetime(2026, 2, 26, 15))
    assert row["is_active"] and row["created_at"] == row["updated_at"]
