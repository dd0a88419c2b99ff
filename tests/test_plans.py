"""Shape of the physical plans that matter at scale."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockpulse.catalogue import analysis, base, storage, transforms  # noqa: F401
from dockpulse.operators import gold, silver, spatial, stations
from dockpulse.sources.bronze import list_partitions, scan_bronze
from dockpulse.sources.landing import explode_payloads

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_filters_reach_the_scan(spark):
    text = plan(scan_bronze(spark, base.lake(spark, SF), "2024-01-15", 8))
    assert "ingestion_date#" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "hour#" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_listing_days_opens_no_file(spark):
    days = list_partitions(spark, base.lake(spark, SF))
    assert "FileScan" not in plan(days) and days.count() == 30


def test_columns_are_pruned(spark):
    text = plan(stations.first_seen(silver.transform_silver(scan_bronze(spark, base.lake(spark, SF)))))
    columns = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert "lon" not in columns and "name" not in columns.replace("stationcode", "")


def test_facts_use_hash_aggregation_and_one_shuffle_each(spark):
    hourly = plan(base.hourly(spark, SF))
    assert "SortAggregate" not in hourly and hourly.count("Exchange hashpartitioning") == 1
    daily = plan(gold.fact_daily(base.hourly(spark, SF)))
    assert "SortAggregate" not in daily and daily.count("Exchange hashpartitioning") == 2


def test_dedup_and_history_shrink_crowded_keys_before_the_shuffle(spark):
    rows = scan_bronze(spark, base.lake(spark, SF))
    dedup = plan(silver.dedup_in_batch(silver.transform_silver(rows)))
    before_shuffle = dedup.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    history = plan(stations.station_history(silver.transform_silver(rows)))
    assert "HashAggregate" in history.split("Exchange hashpartitioning")[-1]
    assert "SortAggregate" not in history.split("Exchange hashpartitioning")[-1]


def test_no_python_and_no_cross_join(spark):
    built = [
        base.daily(spark, SF),
        gold.mart_station_performance(base.daily(spark, SF), base.dim(spark, SF)),
        gold.mart_peak_hours(base.hourly(spark, SF), base.dim(spark, SF)),
        spatial.enrich_district(base.station_rows(spark, SF), base.districts(spark, SF)),
    ]
    for df in built:
        text = plan(df)
        for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert unwanted not in text


def test_containment_is_an_equi_join_without_broadcast_too(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        points = base.station_rows(spark, SF).select("station_id", "longitude", "latitude")
        joined = spatial.point_in_polygon_join(points, base.districts(spark, SF))
        assert "SortMergeJoin" in plan(joined)
        counts = joined.agg(F.count("*"), F.count_distinct("station_id")).first()
        assert counts[0] == counts[1] == 15
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rank_windows_see_counts_only_and_ranks_share_one_pass(spark):
    text = plan(gold.with_station_ranks(gold.station_summary(base.daily(spark, SF), base.dim(spark, SF))))
    assert "Exchange SinglePartition" not in text
    windows = text.split("Window [sum(count")[1:]
    assert len(windows) == 1 and "HashAggregate" in windows[0].split("Exchange")[1][:400]


def test_time_windows_prune_stored_days(spark):
    queries = base.QUERIES
    for name in ("filter_hour_window", "filter_last_24h", "silver_hour_validation", "incremental_source_filter"):
        text = plan(queries[name](spark, SF))
        assert "snapshot_date#" in text.split("PartitionFilters: [")[1].split("]")[0], name
    for name in ("missing_days", "list_loaded_days"):
        assert "FileScan" not in plan(queries[name](spark, SF)), name


def test_silver_tables_are_read_without_building_gold(spark, monkeypatch):
    monkeypatch.setattr(base, "_STORED", {})
    monkeypatch.setattr(base.gold_plan, "run", lambda *_, **__: pytest.fail("built Gold"))
    assert base.stored_table(spark, SF, "station_availability").count() > 0


def test_landed_texts_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(base, "_STORED", {})
    base.bronze_path(spark, SF)
    monkeypatch.setattr(DataFrame, "hint", lambda *_: pytest.fail("shuffled the payloads"))
    assert spark.read.text(base.landing(spark, SF)).count() == base.bronze(spark, SF).count()


def test_payloads_are_described_by_their_first_character(spark):
    text = plan(explode_payloads(spark.createDataFrame([("[]",)], "value string")))
    assert "schema_of_variant" not in text.lower()


def test_centroids_are_not_spread_over_neighbour_cells(spark):
    boundaries = spark.createDataFrame([(1, "a", 2.3, 48.8)], "arr_number int, label string, centroid_lon double, centroid_lat double")
    points = spark.createDataFrame([(2.3, 48.8)], "longitude double, latitude double")
    text = spatial.nearest_centroid_join(points, boundaries)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Generate explode" in line and "[arr_number#" in line for line in text.split("\n")) <= 1
    assert not any(line.count("label#") and "explode([[" in line.replace(" ", "") for line in text.split("\n"))


def test_days_of_a_station_are_counted_in_one_pass(spark):
    text = plan(gold.station_summary(base.stored_table(spark, SF, "fact_daily_station_stats"), base.stored_table(spark, SF, "dim_stations")))
    assert "distinct" not in text and text.count("Exchange hashpartitioning(station_id") == 1
