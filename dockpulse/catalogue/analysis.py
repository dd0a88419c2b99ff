"""Queries: joins, aggregations, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockpulse.catalogue import oracle as o
from dockpulse.catalogue.base import (
    CUTOFF,
    before_cutoff,
    boundary_table,
    bronze,
    daily,
    dim,
    districts,
    fact,
    hourly,
    lake,
    query,
    silver_rows,
    silver_warehouse,
    station_rows,
    stored_table,
    without,
)
from dockpulse.functions import clock, numeric, pick
from dockpulse.operators import expectations, gold, hygiene, loading, quality, ranking, reports, silver, spatial, stations
from dockpulse.plans.silver import load_silver
from dockpulse.config import parquet_warehouse
from dockpulse.sources.tables import stored_days
from dockpulse.session import work_path
from dockpulse.sources import samples
from dockpulse.sources.bronze import list_partitions

KEY = "station_id snapshot_timestamp:t"
DISTRICT = gold.DISTRICT

# Joins


@query("join_first_seen", o.final("stations", "station_id first_seen_at:t last_seen_at:t"))
def _(spark, sf):
    return stations.station_history(silver_rows(spark, sf)).select("station_id", "first_seen_at", "last_seen_at")


EARLY = f"snapshot_timestamp < TIMESTAMP '{CUTOFF}'"


@query(
    "anti_new_stations",
    f"{o.chain('stations', 'silver')} SELECT station_id FROM stations WHERE station_id NOT IN (SELECT station_id FROM silver WHERE {EARLY} AND is_empty)",
)
def _(spark, sf):
    """Stations that were never empty before the cut."""
    rows = silver_rows(spark, sf)
    known = before_cutoff(rows).where("is_empty")
    return loading.new_rows(station_rows(spark, sf), known, "station_id").select("station_id")


@query("anti_existing_facts", o.final("fact", KEY, f"WHERE NOT ({EARLY})"))
def _(spark, sf):
    rows = fact(spark, sf)
    return loading.new_rows(rows, before_cutoff(rows), "station_id", "snapshot_timestamp").select(
        "station_id", "snapshot_timestamp"
    )


@query(
    "join_mart_daily_dim",
    f"{o.chain('daily', 'dim')} SELECT d.station_id, {o.columns('snapshot_date:d')}, station_name, city, capacity_category, {o.columns('avg_occupancy_rate:c')} FROM daily d JOIN dim s ON d.station_id = s.station_id",
)
def _(spark, sf):
    return daily(spark, sf).join(dim(spark, sf), "station_id").select(
        "station_id", "snapshot_date", "station_name", "city", "capacity_category", "avg_occupancy_rate"
    )


@query(
    "join_mart_hourly_dim",
    f"{o.chain('hourly', 'dim')} SELECT h.station_id, {o.columns('snapshot_date:d')}, snapshot_hour, district_municipality_names, city, capacity_category, {o.columns('avg_occupancy_rate:c')} FROM hourly h JOIN dim s ON h.station_id = s.station_id",
)
def _(spark, sf):
    attributes = dim(spark, sf).select("station_id", DISTRICT, "city", "capacity_category")
    return hourly(spark, sf).join(attributes, "station_id").select(
        "station_id", "snapshot_date", "snapshot_hour", DISTRICT, "city", "capacity_category", "avg_occupancy_rate"
    )


@query(
    "join_latest_view",
    f"{o.chain('fact', 'stations')} SELECT a.station_id, s.station_name, {o.KINDS['t'].format('a.snapshot_timestamp')} AS snapshot_timestamp FROM fact a JOIN stations s ON a.station_id = s.station_id",
)
def _(spark, sf):
    names = station_rows(spark, sf).select("station_id", "station_name")
    return fact(spark, sf).join(names, "station_id").select("station_id", "station_name", "snapshot_timestamp")


ORPHANS = f"""{o.chain("fact")} SELECT station_id AS from_field FROM fact WHERE station_id IS NOT NULL
    AND station_id NOT IN (SELECT station_id FROM fact WHERE {EARLY} AND is_full)"""


@query("orphan_rows", ORPHANS)
def _(spark, sf):
    """Facts without a parent, where the parents are the stations seen full before the cut."""
    rows = fact(spark, sf)
    parents = before_cutoff(rows).where("is_full")
    return expectations.relationships(rows, "station_id", parents, "station_id")


def _points(spark, sf):
    return station_rows(spark, sf).select("station_id", "longitude", "latitude")


@query(
    "point_in_polygon_join",
    f"{o.chain('contained', 'stations')} SELECT p.station_id, p.longitude, p.latitude, CAST(c.arr_number AS INTEGER) AS arr_number, "
    "'Paris ' || c.arr_number || CASE WHEN c.arr_number = 1 THEN 'er' ELSE 'e' END || ' Arrondissement' AS label "
    "FROM stations p LEFT JOIN contained c ON p.station_id = c.station_id",
)
def _(spark, sf):
    return spatial.point_in_polygon_join(_points(spark, sf), districts(spark, sf))


@query("nearest_centroid_join", f"{o.chain('nearest')} SELECT station_id, CAST(arr_number AS INTEGER) AS nearest_number FROM nearest")
def _(spark, sf):
    return spatial.nearest_centroid_join(_points(spark, sf), districts(spark, sf)).select("station_id", "nearest_number")


@query(
    "district_of_every_snapshot",
    f"""{o.chain("bronze", "edges", "centroids")},
    places AS (SELECT DISTINCT lon, lat FROM bronze),
    rings_at AS (SELECT p.lon, p.lat, e.n, e.poly, e.ring FROM places p
        JOIN edges e ON (e.y1 > p.lat) <> (e.y2 > p.lat) AND p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
        GROUP BY ALL HAVING count(*) % 2 = 1),
    inside AS (SELECT s.lon, s.lat, min(s.n) + 1 AS arr_number FROM rings_at s
        LEFT JOIN rings_at h ON h.lon = s.lon AND h.lat = s.lat AND h.n = s.n AND h.poly = s.poly AND h.ring > 1
        WHERE s.ring = 1 AND h.lon IS NULL GROUP BY ALL)
    SELECT CASE WHEN b.is_installed IS NOT NULL THEN b.stationcode END AS station_id, b.lon AS longitude, b.lat AS latitude,
           CAST(coalesce(i.arr_number, 9999) AS INTEGER) AS arr_number
    FROM bronze b LEFT JOIN inside i ON i.lon = b.lon AND i.lat = b.lat""",
)
def _(spark, sf):
    """Points with repeated and NULL keys, and a last district as large as the world."""
    rows = bronze(spark, sf)
    points = rows.select(
        F.when(F.col("is_installed").isNotNull(), F.col("stationcode")).alias("station_id"),
        F.col("lon").alias("longitude"),
        F.col("lat").alias("latitude"),
    )
    known = districts(spark, sf)
    corners = F.expr("array(array(array(array(-180D, -90D), array(180D, -90D), array(180D, 90D), array(-180D, 90D))))")
    world = spark.range(1).select(
        F.lit(9999).alias("arr_number"),
        F.lit("world").alias("label"),
        corners.alias("polygons"),
        F.lit(None).cast("double").alias("centroid_lon"),
        F.lit(None).cast("double").alias("centroid_lat"),
    )
    return spatial.point_in_polygon_join(points, known.select(*world.columns).unionByName(world)).drop("label")


@query(
    "nearest_of_many_centroids",
    f"""{o.chain("stations")},
    many AS (SELECT c_custkey + 1 AS arr_number, CAST(225000 + (c_custkey % 5) * 4000 + 2000 AS DOUBLE) / 100000 AS x,
                    CAST(4880000 + (c_custkey // 5) * 2000 + 1000 AS DOUBLE) / 100000 AS y FROM customer WHERE c_custkey % 7 <> 0)
    SELECT station_id, CAST(arr_number AS INTEGER) AS nearest_number FROM (
        SELECT p.station_id, c.arr_number, row_number() OVER (PARTITION BY p.station_id ORDER BY
            (c.x - p.longitude) * (c.x - p.longitude) + (c.y - p.latitude) * (c.y - p.latitude), c.arr_number) AS rn
        FROM stations p CROSS JOIN many c) WHERE rn = 1""",
)
def _(spark, sf):
    """A centroid for every customer."""
    many = boundary_table(spark, sf, "customer", "c_custkey")
    return spatial.nearest_centroid_join(_points(spark, sf), many).select("station_id", "nearest_number")


@query("enrich_district", o.final("districts", "station_id district_municipality_names"))
def _(spark, sf):
    return spatial.enrich_district(station_rows(spark, sf), districts(spark, sf)).select("station_id", DISTRICT)


# Aggregations


@query("first_seen", o.final("stations", "station_id first_seen_at:t"))
def _(spark, sf):
    return stations.first_seen(silver_rows(spark, sf))


@query(
    "batch_bounds",
    f"{o.chain('fact')} SELECT {o.KINDS['t'].format('min(snapshot_timestamp)')} AS min_ts, {o.KINDS['t'].format('max(snapshot_timestamp)')} AS max_ts, count(*) AS rows FROM fact",
)
def _(spark, sf):
    return loading.batch_bounds(fact(spark, sf))


@query("fact_hourly_availability", o.final("hourly", o.HOURLY_COLUMNS))
def _(spark, sf):
    return hourly(spark, sf)


@query("fact_daily_station_stats", o.final("daily", o.DAILY_COLUMNS))
def _(spark, sf):
    return daily(spark, sf)


def _summary(spark, sf):
    """From the stored daily fact and dimension, as the marts are built."""
    return gold.station_summary(*_stored(spark, sf, "fact_daily_station_stats", "dim_stations"))


def _stored(spark, sf, *names):
    return [stored_table(spark, sf, name) for name in names]


@query("station_summary", o.final("summary", o.SUMMARY_COLUMNS))
def _(spark, sf):
    return _summary(spark, sf)


@query("district_hour_summary", o.final("district_hours", o.DISTRICT_HOUR_COLUMNS))
def _(spark, sf):
    return gold.district_hour_summary(hourly(spark, sf), dim(spark, sf))


@query(
    "count_distinct",
    f"""{o.chain("fact")} SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(DISTINCT station_id) AS stations,
        count(DISTINCT snapshot_hour) AS hours FROM fact GROUP BY snapshot_date""",
)
def _(spark, sf):
    return fact(spark, sf).groupBy("snapshot_date").agg(
        F.count_distinct("station_id").alias("stations"), pick.distinct_hours("snapshot_hour").alias("hours")
    )


@query(
    "conditional_sum",
    f"""{o.chain("fact")} SELECT station_id, CAST(sum(CASE WHEN is_empty THEN 1 ELSE 0 END) AS BIGINT) AS times_empty,
        CAST(sum(CASE WHEN is_full THEN 1 ELSE 0 END) AS BIGINT) AS times_full FROM fact GROUP BY station_id""",
)
def _(spark, sf):
    return fact(spark, sf).groupBy("station_id").agg(
        numeric.true_count("is_empty").alias("times_empty"), numeric.true_count("is_full").alias("times_full")
    )


@query(
    "operational_pct",
    f"""{o.chain("fact")}, pct AS (SELECT station_id, {o.share("sum(CASE WHEN is_operational THEN 1 ELSE 0 END)", "count(*)")} AS operational_pct
        FROM fact GROUP BY station_id) SELECT {o.columns("station_id operational_pct:c")} FROM pct""",
)
def _(spark, sf):
    return fact(spark, sf).groupBy("station_id").agg(numeric.true_pct("is_operational").alias("operational_pct"))


@query(
    "pct_of_total",
    f"""{o.chain("hourly")}, pct AS (SELECT snapshot_date, {o.share("sum(minutes_empty)", "sum(num_snapshots)")} AS pct_time_empty
        FROM hourly GROUP BY snapshot_date) SELECT {o.columns("snapshot_date:d pct_time_empty:c")} FROM pct""",
)
def _(spark, sf):
    return hourly(spark, sf).groupBy("snapshot_date").agg(
        numeric.share2("minutes_empty", "num_snapshots").alias("pct_time_empty")
    )


@query("peak_hour", o.final("daily", "station_id snapshot_date:d peak_hour:i"))
def _(spark, sf):
    return hourly(spark, sf).groupBy("station_id", "snapshot_date").agg(
        pick.first_by_desc("snapshot_hour", "avg_occupancy_rate").alias("peak_hour")
    )


@query(
    "rounded_avg",
    f"""{o.chain("fact")}, avgs AS (SELECT district_municipality_names, {o.mean_int("num_bikes_available")} AS avg_bikes,
        {o.mean_cents("occupancy_rate")} AS avg_occupancy FROM fact GROUP BY district_municipality_names)
        SELECT {o.columns("district_municipality_names avg_bikes:c avg_occupancy:c")} FROM avgs""",
)
def _(spark, sf):
    return silver_rows(spark, sf).groupBy(DISTRICT).agg(
        numeric.mean2("num_bikes_available").alias("avg_bikes"), numeric.mean2("occupancy_rate").alias("avg_occupancy")
    )


@query(
    "v_daily_station_stats",
    f"""{o.chain("fact")}, stats AS (
        SELECT station_id, snapshot_date, count(*) AS num_snapshots, {o.mean_int("num_bikes_available")} AS avg_bikes_available,
               {o.mean_int("num_docks_available")} AS avg_docks_available, {o.mean_cents("occupancy_rate")} AS avg_occupancy_rate,
               {o.mean_cents("service_rate")} AS avg_service_rate, max(num_bikes_available) AS max_bikes_available,
               min(num_bikes_available) AS min_bikes_available, CAST(sum(CASE WHEN is_empty THEN 1 ELSE 0 END) AS BIGINT) AS times_empty,
               CAST(sum(CASE WHEN is_full THEN 1 ELSE 0 END) AS BIGINT) AS times_full,
               {o.share("sum(CASE WHEN is_operational THEN 1 ELSE 0 END)", "count(*)")} AS operational_pct
        FROM fact GROUP BY station_id, snapshot_date)
        SELECT {o.columns("station_id snapshot_date:d num_snapshots:l avg_bikes_available:c avg_docks_available:c avg_occupancy_rate:c avg_service_rate:c max_bikes_available:i min_bikes_available:i times_empty:l times_full:l operational_pct:c")} FROM stats""",
)
def _(spark, sf):
    return gold.daily_station_stats(fact(spark, sf))


@query(
    "silver_hour_validation",
    f"""{o.chain("fact")} SELECT count(*) AS total_rows, count(DISTINCT station_id) AS unique_stations,
        {o.KINDS["t"].format("min(snapshot_timestamp)")} AS earliest, {o.KINDS["t"].format("max(snapshot_timestamp)")} AS latest FROM fact
        WHERE snapshot_timestamp >= TIMESTAMP '2024-01-15 08:00:00' AND snapshot_timestamp < TIMESTAMP '2024-01-15 09:00:00'""",
)
def _(spark, sf):
    return reports.load_validation(
        reports.filter_hour_window(stored_table(spark, sf, "station_availability"), "2024-01-15 08:00:00")
    )


HOURLY_LOADS = f"""{o.chain("fact")} SELECT {o.KINDS["t"].format("date_trunc('hour', snapshot_timestamp)")} AS snapshot_hour,
    count(*) AS rows_added, count(DISTINCT station_id) AS stations_count FROM fact GROUP BY date_trunc('hour', snapshot_timestamp)"""


@query("hourly_load_summary", HOURLY_LOADS)
def _(spark, sf):
    return reports.hourly_loads(fact(spark, sf))


@query("latest_k_hours", f"{HOURLY_LOADS} ORDER BY 1 DESC LIMIT 5")
def _(spark, sf):
    return reports.latest_hours(fact(spark, sf), 5)


@query(
    "district_counts",
    f"""{o.chain("districts")} SELECT district_municipality_names, count(*) AS stations FROM districts
        WHERE lower(coalesce(district_municipality_names, '')) LIKE 'paris%' GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def _(spark, sf):
    return reports.district_counts(spatial.enrich_district(station_rows(spark, sf), districts(spark, sf)))


COUNTS = f"""{o.chain("fact", "stations")} SELECT 'silver.stations' AS table_name, count(*) AS row_count FROM stations
    UNION ALL SELECT 'silver.station_availability', count(*) FROM fact"""


@query("table_counts", COUNTS)
def _(spark, sf):
    return reports.table_counts(
        {"silver.stations": station_rows(spark, sf), "silver.station_availability": fact(spark, sf)}
    )


@query(
    "union_all_counts",
    f"""{COUNTS} UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'customer', count(*) FROM customer""",
)
def _(spark, sf):
    tables = {"silver.stations": station_rows(spark, sf), "silver.station_availability": fact(spark, sf)}
    return reports.table_counts(tables | {n: samples.table(spark, sf, n) for n in ("events", "customer")})


@query("value_counts", f"{o.chain('dim')} SELECT capacity_category AS value_field, count(*) AS n_records FROM dim GROUP BY 1")
def _(spark, sf):
    return expectations.value_counts(dim(spark, sf), "capacity_category")


@query(
    "network_pressure",
    f"""{o.chain("hourly")}, p AS (SELECT snapshot_date, snapshot_hour, {o.mean_cents("avg_occupancy_rate")} AS avg_occupancy_rate
        FROM hourly GROUP BY 1, 2) SELECT {o.columns("snapshot_date:d snapshot_hour:i avg_occupancy_rate:c")} FROM p""",
)
def _(spark, sf):
    return reports.network_pressure(hourly(spark, sf))


@query(
    "run_metrics",
    f"""{o.chain("enriched", "silver", "stations")},
    n AS (SELECT (SELECT count(*) FROM enriched) AS given, (SELECT count(*) FROM silver) AS good)
    SELECT given * 2 AS rows_read, (given - good) * 2 AS rows_rejected, good * 2 AS facts_in, good AS facts_written,
           good AS duplicates_skipped, (SELECT count(*) FROM stations) AS stations_written, true AS timed FROM n""",
)
def _(spark, sf):
    """Every snapshot delivered twice in one batch; the counts are observed while the load runs."""
    rows = bronze(spark, sf)
    run = load_silver(spark, rows.unionByName(rows), parquet_warehouse(work_path(spark, "warehouse")))
    row = run.as_row()
    timed = F.lit(0 < row.pop("duration_seconds") < 3600).alias("timed")
    entries = [*(F.lit(v).cast("bigint").alias(k) for k, v in row.items()), timed]
    return samples.table(spark, sf, "events").agg(F.count(F.lit(1)).alias("n")).select(*entries)


# Windows


@query(
    "latest_station_row",
    f"""{o.chain("silver")} SELECT station_id, {o.KINDS["t"].format("snapshot_timestamp")} AS snapshot_timestamp, snapshot_id,
        CAST(num_bikes_available AS INTEGER) AS num_bikes_available FROM (SELECT *, row_number() OVER
        (PARTITION BY station_id ORDER BY snapshot_timestamp DESC, snapshot_id DESC) AS rn FROM silver) WHERE rn = 1""",
)
def _(spark, sf):
    rows = silver_rows(spark, sf).select("station_id", "snapshot_timestamp", "snapshot_id", "num_bikes_available")
    return stations.latest_by_key(rows, "station_id", "snapshot_timestamp", "snapshot_id")


@query("stations_dimension", o.final("districts", o.STATION_COLUMNS))
def _(spark, sf):
    return without(stations.stations_dimension(silver_rows(spark, sf), districts(spark, sf)))


LATEST = (
    "station_id station_name district_municipality_names capacity:i snapshot_timestamp:t num_bikes_available:i "
    "num_bikes_available_mechanical:i num_bikes_available_ebike:i num_docks_available:i occupancy_rate:c availability_rate:c "
    "service_rate:c is_empty is_full is_operational latitude longitude insee_municipality_code"
)


@query(
    "v_latest_availability",
    f"""{o.chain("fact", "stations")}, latest AS (
        SELECT a.* EXCLUDE (station_name, capacity, latitude, longitude, district_municipality_names, insee_municipality_code),
               s.station_name, s.capacity, s.latitude, s.longitude, s.district_municipality_names, s.insee_municipality_code
        FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY snapshot_timestamp DESC) AS rn FROM fact) a
        JOIN stations s ON a.station_id = s.station_id WHERE a.rn = 1)
        SELECT {o.columns(LATEST)} FROM latest""",
)
def _(spark, sf):
    return stations.latest_availability(fact(spark, sf), station_rows(spark, sf))


@query("rank_global", o.final("performance", f"station_id {o.GLOBAL_RANK_COLUMNS}"))
def _(spark, sf):
    return ranking.with_ranks(_summary(spark, sf), "station_id", *gold.GLOBAL_RANKS).select(
        "station_id", *[r.name for r in gold.GLOBAL_RANKS]
    )


@query("rank_in_district", o.final("performance", "station_id district_municipality_names district_occupancy_rank:i"))
def _(spark, sf):
    return ranking.with_ranks(_summary(spark, sf), "station_id", gold.DISTRICT_RANK).select(
        "station_id", DISTRICT, gold.DISTRICT_RANK.name
    )


@query(
    "mart_station_performance",
    o.final("performance", f"{o.SUMMARY_COLUMNS} {o.GLOBAL_RANK_COLUMNS} district_occupancy_rank:i"),
)
def _(spark, sf):
    return without(gold.mart_station_performance(*_stored(spark, sf, "fact_daily_station_stats", "dim_stations")))


@query(
    "rank_peak_hour",
    o.final("peak_hours", "district_municipality_names city snapshot_day_of_week:i snapshot_hour:i peak_hour_rank:i"),
)
def _(spark, sf):
    return gold.mart_peak_hours(*_stored(spark, sf, "fact_hourly_availability", "dim_stations")).select(
        DISTRICT, "city", "snapshot_day_of_week", "snapshot_hour", "peak_hour_rank"
    )


@query("mart_peak_hours_by_district", o.final("peak_hours", f"{o.DISTRICT_HOUR_COLUMNS} peak_hour_rank:i"))
def _(spark, sf):
    return gold.mart_peak_hours(hourly(spark, sf), dim(spark, sf))


def snapshot_files(spark, sf):
    """The file each snapshot would be stored in; a snapshot with an error event stands for a broken file."""
    events = samples.table(spark, sf, "events")
    return events.groupBy(F.concat(F.lit("lake/"), clock.partition_path("ts")).alias("path")).agg(
        F.bool_and(F.col("event_type") != "error").alias("valid")
    )


@query(
    "minute_duplicates",
    f"""{o.chain("snapshots")} SELECT folder || '/' || file_name AS path FROM (SELECT *, row_number() OVER
        (PARTITION BY folder, date_trunc('minute', snapshot_timestamp) ORDER BY snapshot_timestamp, file_name) AS rn FROM snapshots) WHERE rn > 1""",
)
def _(spark, sf):
    return hygiene.minute_duplicates(snapshot_files(spark, sf)).select("path")


# Ordering and sets


@query(
    "top10_most_empty",
    f"""{o.chain("performance")}, m AS (SELECT station_name, {o.mean_cents("avg_pct_time_empty")} AS avg_pct_time_empty FROM performance GROUP BY 1)
        SELECT {o.columns("station_name avg_pct_time_empty:c")} FROM m ORDER BY m.avg_pct_time_empty DESC, station_name LIMIT 10""",
)
def _(spark, sf):
    return reports.most_empty_stations(_summary(spark, sf), 10)


@query(
    "district_hour_heatmap",
    f"""{o.chain("peak_hours")}, m AS (SELECT district_municipality_names, snapshot_hour, {o.mean_cents("avg_occupancy_rate")} AS avg_occupancy_rate
        FROM peak_hours GROUP BY 1, 2) SELECT {o.columns("district_municipality_names snapshot_hour:i avg_occupancy_rate:c")} FROM m""",
)
def _(spark, sf):
    return reports.district_hour_heatmap(gold.mart_peak_hours(hourly(spark, sf), dim(spark, sf)))


@query(
    "multi_key_sort",
    f"{o.chain('stations')} SELECT district_municipality_names, count(*) AS n FROM stations GROUP BY 1 ORDER BY n DESC, 1 ASC",
)
def _(spark, sf):
    return (
        station_rows(spark, sf)
        .groupBy(DISTRICT)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(DISTRICT))
    )


@query(
    "missing_days",
    f"""{o.chain("bronze", "fact")} SELECT CAST(day AS VARCHAR) AS day FROM (SELECT ingestion_date AS day FROM bronze
        EXCEPT SELECT snapshot_date FROM fact WHERE {EARLY}) WHERE day >= DATE '2024-01-10'""",
)
def _(spark, sf):
    in_lake = list_partitions(spark, lake(spark, sf)).select(F.col("ingestion_date").alias("day"))
    days = stored_days(spark, silver_warehouse(spark, sf).table("station_availability"))
    loaded = hygiene.loaded_days(days.where(F.col("snapshot_date") < F.lit(CUTOFF).cast("date")), spark)
    return hygiene.missing_days(in_lake, loaded, start="2024-01-10")


@query("distinct_days", f"{o.chain('fact')} SELECT DISTINCT CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM fact")
def _(spark, sf):
    return fact(spark, sf).select("snapshot_date").distinct()


@query("dedup_in_batch", o.final("fact", f"{o.FACT_COLUMNS}"))
def _(spark, sf):
    """The batch holds every row twice."""
    rows = without(fact(spark, sf)).drop("snapshot_date", "snapshot_hour", "snapshot_day_of_week")
    return silver.dedup_in_batch(rows.unionByName(rows))


FIRST_VALID = """kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY folder, date_trunc('minute', snapshot_timestamp)
    ORDER BY snapshot_timestamp, file_name) AS rn FROM snapshots WHERE valid) WHERE rn = 1)"""


@query(
    "files_to_delete",
    f"""{o.chain("snapshots")}, {FIRST_VALID} SELECT folder || '/' || file_name AS path FROM snapshots
        WHERE folder || '/' || file_name NOT IN (SELECT folder || '/' || file_name FROM kept)""",
)
def _(spark, sf):
    return hygiene.files_to_delete(snapshot_files(spark, sf))


@query(
    "schema_diff",
    "SELECT column_name, column_name NOT IN ('duedate', 'name') AS present, (SELECT count(*) FROM events) AS input_rows FROM (VALUES "
    + ", ".join(f"('{c}')" for c in samples.BRONZE_LAKE.fieldNames()[:18])
    + ") AS v(column_name)",
)
def _(spark, sf):
    """Two contract columns are missing from the input."""
    return quality.schema_diff(bronze(spark, sf).drop("duedate", "name"))

