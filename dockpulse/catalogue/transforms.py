"""Queries: projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockpulse.catalogue import oracle as o
from dockpulse.catalogue.base import bronze, dim, fact, hourly, query, silver_rows, staged, station_rows, stored_table, without
from dockpulse.functions import clock, numeric, pick, text
from dockpulse.operators import gold, silver
from dockpulse.operators.hygiene import filter_date_range
from dockpulse.operators.reports import filter_hour_window, filter_last_hours, latest_timestamp
from dockpulse.plans.enrich import candidates
from dockpulse.sources import landing, samples

CLEAN = (
    "station_id station_name capacity:i num_bikes_available:i num_bikes_available_mechanical:i num_bikes_available_ebike:i "
    "num_docks_available:i longitude latitude district_municipality_names insee_municipality_code ingestion_timestamp:t snapshot_id"
)
STATUS = "is_installed is_renting is_returning"
KEY = "station_id snapshot_timestamp:t"


@query("normalize_columns", o.final("clean", CLEAN))
def _(spark, sf):
    return silver.normalize_columns(bronze(spark, sf)).drop(*silver.STATUS_COLUMNS)


@query("normalize_booleans", o.final("clean", f"{KEY} {STATUS}"))
def _(spark, sf):
    clean = silver.normalize_booleans(silver.normalize_columns(bronze(spark, sf)))
    return clean.select("station_id", F.col("ingestion_timestamp").alias("snapshot_timestamp"), *silver.STATUS_COLUMNS)


def _nested(df):
    """Stations back in feed form, to be flattened again."""
    return df.withColumn("coordonnees_geo", F.struct("lon", "lat")).drop("lon", "lat")


@query("flatten_geo", o.final("bronze", "stationcode snapshot_id lon lat"))
def _(spark, sf):
    nested = _nested(bronze(spark, sf))
    return landing.flatten_geo(nested).select("stationcode", "snapshot_id", "lon", "lat")


@query("apply_type_contract", o.final("bronze", o.BRONZE_COLUMNS + " ingestion_date:d hour:i"))
def _(spark, sf):
    """Every contract column arrives as text; other columns pass through."""
    rows = bronze(spark, sf)
    as_text = rows.withColumns({c: F.col(c).cast("string") for c in landing.BRONZE.fieldNames()})
    return landing.apply_type_contract(as_text).drop("duedate", "station_opening_hours", "ingestion_timestamp")


@query(
    "add_lineage",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
           || CASE WHEN ts = (ts AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC' + INTERVAL 1 HOUR THEN '+01:00' ELSE '+02:00' END
           AS ingestion_timestamp, strftime(ts, '%Y%m%d_%H%M%S') AS snapshot_id FROM events""",
)
def _(spark, sf):
    events = samples.table(spark, sf, "events")
    instant = F.convert_timezone(F.lit(clock.LOCAL_ZONE), F.lit("UTC"), F.col("ts").cast("timestamp_ntz")).cast("timestamp")
    return landing.add_lineage(events.select("event_id", "ts"), instant).drop("ts")


def _enriched(spark, sf, *columns):
    return silver.enrich(bronze(spark, sf)).select("station_id", "snapshot_timestamp", *columns)


@query("occupancy_rate", o.final("enriched", f"{KEY} occupancy_rate:c"))
def _(spark, sf):
    return _enriched(spark, sf, "occupancy_rate")


@query("availability_rate", o.final("enriched", f"{KEY} availability_rate:c"))
def _(spark, sf):
    return _enriched(spark, sf, "availability_rate")


@query("service_rate", o.final("enriched", f"{KEY} service_rate:c"))
def _(spark, sf):
    return _enriched(spark, sf, "service_rate")


@query("status_flags", o.final("enriched", f"{KEY} is_empty is_full is_operational"))
def _(spark, sf):
    return _enriched(spark, sf, "is_empty", "is_full", "is_operational")


@query(
    "filter_valid",
    f"""{o.chain("enriched", "silver")}
    SELECT station_id, {o.KINDS["t"].format("snapshot_timestamp")} AS snapshot_timestamp, true AS accepted FROM silver
    UNION ALL
    SELECT station_id, {o.KINDS["t"].format("snapshot_timestamp")}, false FROM enriched WHERE capacity <= 0""",
)
def _(spark, sf):
    """Accepted rows and, from the same rules, the quarantined ones."""
    rows = silver.enrich(bronze(spark, sf))
    columns = ["station_id", "snapshot_timestamp"]
    good = silver.filter_valid(rows).select(*columns, F.lit(True).alias("accepted"))
    return good.unionByName(silver.quarantine(rows).select(*columns, F.lit(False).alias("accepted")))


@query("project_fact", o.final("silver", o.FACT_COLUMNS))
def _(spark, sf):
    return without(silver.project_fact(silver_rows(spark, sf)))


@query("stg_stations", o.final("stg_stations", o.STATION_COLUMNS))
def _(spark, sf):
    return gold.stg_stations(station_rows(spark, sf))


@query("stg_availability", o.final("staged", f"{o.FACT_COLUMNS} {o.CALENDAR_COLUMNS}"))
def _(spark, sf):
    return staged(spark, sf)


@query("calendar_columns", o.final("fact", f"{KEY} {o.CALENDAR_COLUMNS}"))
def _(spark, sf):
    return clock.with_calendar(silver_rows(spark, sf).select("station_id", "snapshot_timestamp"))


@query("capacity_category", o.final("dim", "station_id capacity:i capacity_category"))
def _(spark, sf):
    return station_rows(spark, sf).select(
        "station_id", "capacity", text.capacity_category("capacity").alias("capacity_category")
    )


@query("city_label", o.final("dim", "station_id district_municipality_names city"))
def _(spark, sf):
    return station_rows(spark, sf).select(
        "station_id", "district_municipality_names", text.city_label("district_municipality_names").alias("city")
    )


@query("dim_stations", o.final("dim", f"{o.STATION_COLUMNS} capacity_category city"))
def _(spark, sf):
    return without(dim(spark, sf))


@query("audit_columns", f"{o.chain('stations')} SELECT station_id, true AS stamped FROM stations")
def _(spark, sf):
    """Audit times are those of the run, so only their presence is compared."""
    stamped = F.col("created_at").isNotNull() & (F.col("created_at") == F.col("updated_at"))
    return station_rows(spark, sf).select("station_id", stamped.alias("stamped"))


@query(
    "filter_prefix_notnull",
    o.final(
        "stations",
        "station_id latitude longitude district_municipality_names",
        "WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND lower(coalesce(district_municipality_names, '')) LIKE 'paris%' ORDER BY station_id",
    ),
)
def _(spark, sf):
    return candidates(station_rows(spark, sf))


@query(
    "filter_hour_window",
    o.final(
        "fact",
        f"{KEY} num_bikes_available:i",
        "WHERE snapshot_timestamp >= TIMESTAMP '2024-01-15 08:00:00' AND snapshot_timestamp < TIMESTAMP '2024-01-15 09:00:00'",
    ),
)
def _(spark, sf):
    window = filter_hour_window(stored_table(spark, sf, "station_availability"), "2024-01-15 08:00:00")
    return window.select("station_id", "snapshot_timestamp", "num_bikes_available")


@query(
    "filter_date_range",
    f"{o.chain('bronze')} SELECT DISTINCT CAST(ingestion_date AS VARCHAR) AS day FROM bronze WHERE ingestion_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
)
def _(spark, sf):
    days = bronze(spark, sf).select(F.col("ingestion_date").alias("day")).distinct()
    return filter_date_range(days, "day", "2024-01-05", "2024-01-20")


@query(
    "previous_hour",
    """SELECT event_id, strftime(local, '%Y-%m-%d') AS previous_date, strftime(local, '%H') AS previous_hour
       FROM (SELECT event_id, ((ts - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS local FROM events)""",
)
def _(spark, sf):
    """Each event time is read as the UTC instant of a scheduled run."""
    day, hour = clock.previous_hour(F.col("ts").cast("timestamp"))
    return samples.table(spark, sf, "events").select("event_id", day.alias("previous_date"), hour.alias("previous_hour"))


@query(
    "filter_last_24h",
    o.final(
        "fact",
        f"{KEY} is_empty",
        "WHERE snapshot_timestamp >= (SELECT max(snapshot_timestamp) FROM fact) - INTERVAL 24 HOUR",
    ),
)
def _(spark, sf):
    rows = stored_table(spark, sf, "station_availability")
    recent = filter_last_hours(rows, F.lit(latest_timestamp(rows)).cast("timestamp_ntz"))
    return recent.select("station_id", "snapshot_timestamp", "is_empty")


@query(
    "transform_silver",
    o.final(
        "silver",
        f"{o.FACT_COLUMNS} station_name capacity:i longitude latitude district_municipality_names "
        "insee_municipality_code snapshot_id",
    ),
)
def _(spark, sf):
    return silver_rows(spark, sf)


# Scalar functions


@query(
    "string_fns",
    """SELECT c_custkey, trim('  ' || c_mktsegment || ' ') AS trimmed, upper(c_name) AS uppered, lower(c_mktsegment) AS lowered,
              c_mktsegment LIKE '%BUILD%' AS matched, split_part(c_name, '#', 2) AS second_part,
              'Paris ' || (c_nationkey + 1) || CASE WHEN c_nationkey = 0 THEN 'er' ELSE 'e' END || ' Arrondissement' AS label
       FROM customer""",
)
def _(spark, sf):
    return samples.table(spark, sf, "customer").select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.upper("c_name").alias("uppered"),
        F.lower("c_mktsegment").alias("lowered"),
        F.col("c_mktsegment").like("%BUILD%").alias("matched"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("second_part"),
        text.district_label(F.col("c_nationkey") + 1).alias("label"),
    )


@query(
    "math_fns",
    f"""{o.chain("enriched")}
    SELECT station_id, {o.KINDS["t"].format("snapshot_timestamp")} AS snapshot_timestamp,
           CAST(num_bikes_available + num_docks_available AS BIGINT) AS places,
           CAST(capacity - num_bikes_available AS BIGINT) AS free_places,
           CAST(least(num_bikes_available, num_docks_available) AS BIGINT) AS lowest,
           CAST(greatest(num_bikes_available, num_docks_available) AS BIGINT) AS highest,
           CAST((num_bikes_available * 200 + capacity) // (2 * nullif(capacity, 0)) AS DOUBLE) AS whole_percent,
           (longitude - 2.3522::DOUBLE) * (longitude - 2.3522::DOUBLE) + (latitude - 48.8566::DOUBLE) * (latitude - 48.8566::DOUBLE) AS distance2
    FROM enriched""",
)
def _(spark, sf):
    bikes, docks, capacity = (F.col(c).cast("bigint") for c in ("num_bikes_available", "num_docks_available", "capacity"))
    dx, dy = F.col("longitude") - F.lit(2.3522), F.col("latitude") - F.lit(48.8566)
    whole = F.nullif(capacity, F.lit(0).cast("bigint")).cast("decimal(12,0)")
    return silver.enrich(bronze(spark, sf)).select(
        "station_id",
        "snapshot_timestamp",
        (bikes + docks).alias("places"),
        (capacity - bikes).alias("free_places"),
        F.least(bikes, docks).alias("lowest"),
        F.greatest(bikes, docks).alias("highest"),
        F.round(bikes.cast("decimal(12,0)") * 100 / whole, 0).cast("double").alias("whole_percent"),
        (dx * dx + dy * dy).alias("distance2"),
    )


@query(
    "datetime_fns",
    """SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS hour_start,
              CAST(extract(hour FROM ts) AS INTEGER) AS hour_of_day, CAST(extract(dow FROM ts) AS INTEGER) AS weekday,
              CAST(CAST(ts AS DATE) - 2 AS VARCHAR) AS two_days_before,
              strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS one_hour_later,
              strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris', '%Y-%m-%d %H:%M:%S.%f') AS paris_time
       FROM events""",
)
def _(spark, sf):
    return samples.table(spark, sf, "events").select(
        "event_id",
        clock.hour_floor("ts").alias("hour_start"),
        F.hour("ts").alias("hour_of_day"),
        clock.day_of_week("ts").alias("weekday"),
        clock.days_before(F.to_date("ts"), 2).alias("two_days_before"),
        (F.col("ts") + F.expr("interval 1 hour")).alias("one_hour_later"),
        clock.wall_clock(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("paris_time"),
    )


@query(
    "null_fns",
    f"""{o.chain("bronze")}
    SELECT stationcode, snapshot_id, coalesce(is_installed, 'OUI') AS installed_or_default,
           is_installed IS NULL AS installed_missing, nullif(capacity, 0) AS capacity_or_null,
           numbikesavailable / CAST(nullif(capacity, 0) AS DOUBLE) AS share FROM bronze""",
)
def _(spark, sf):
    known = F.nullif(F.col("capacity"), F.lit(0).cast("bigint"))
    return bronze(spark, sf).select(
        "stationcode",
        "snapshot_id",
        F.coalesce("is_installed", F.lit(text.DEFAULT_TOKEN)).alias("installed_or_default"),
        F.col("is_installed").isNull().alias("installed_missing"),
        known.alias("capacity_or_null"),
        (F.col("numbikesavailable") / known).alias("share"),
    )


@query(
    "conditional_fns",
    f"""{o.chain("enriched")}
    SELECT station_id, {o.KINDS["t"].format("snapshot_timestamp")} AS snapshot_timestamp,
           CASE WHEN is_empty THEN 'empty' WHEN is_full THEN 'full' ELSE 'mixed' END AS state,
           district_municipality_names IN ('Paris', 'NATION_1') AS in_list,
           extract(hour FROM snapshot_timestamp) NOT IN (7, 8, 9, 17, 18, 19) AS off_peak FROM enriched""",
)
def _(spark, sf):
    return silver.enrich(bronze(spark, sf)).select(
        "station_id",
        "snapshot_timestamp",
        F.when(F.col("is_empty"), "empty").when(F.col("is_full"), "full").otherwise("mixed").alias("state"),
        F.col("district_municipality_names").isin("Paris", "NATION_1").alias("in_list"),
        (~F.hour("snapshot_timestamp").isin(7, 8, 9, 17, 18, 19)).alias("off_peak"),
    )


@query(
    "cast_fns",
    """SELECT event_id, coalesce(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER), 0) AS as_int,
              coalesce(TRY_CAST(event_type AS INTEGER), 0) AS bad_int, CAST(user_id AS DOUBLE) AS as_double,
              CAST(CAST(user_id AS DECIMAL(18,2)) AS DOUBLE) AS as_decimal, CAST(CAST(ts AS DATE) AS VARCHAR) AS as_date
       FROM events""",
)
def _(spark, sf):
    return samples.table(spark, sf, "events").select(
        "event_id",
        numeric.int_or_zero(F.regexp_extract("props", "([0-9]+)", 1)).alias("as_int"),
        numeric.int_or_zero("event_type").alias("bad_int"),
        F.col("user_id").cast("double").alias("as_double"),
        F.col("user_id").cast("decimal(18,2)").alias("as_decimal"),
        F.col("ts").cast("date").alias("as_date"),
    )


@query(
    "parse_snapshot_name",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') END
       AS snapshot_timestamp FROM events""",
)
def _(spark, sf):
    """Files of failed polls carry another name and give NULL."""
    prefix = F.when(F.col("event_type") == "error", "broken_").otherwise("snapshot_")
    name = F.concat(prefix, clock.snapshot_id("ts"), F.lit(".parquet"))
    return samples.table(spark, sf, "events").select("event_id", text.parse_snapshot_name(name).alias("snapshot_timestamp"))


@query(
    "json_struct_fns",
    "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS from_struct, regexp_extract(props, '([0-9]+)', 1) AS from_path FROM events",
)
def _(spark, sf):
    return samples.table(spark, sf, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("from_struct"),
        F.get_json_object("props", "$.k").alias("from_path"),
    )


@query(
    "partition_path",
    """SELECT event_id, strftime(ts, 'ingestion_date=%Y-%m-%d/hour=%H/snapshot_%Y%m%d_%H%M%S.parquet') AS snapshot_path,
              strftime(ts, 'report_date=%Y-%m-%d/hour=%H/report-%Y-%m-%d-%H-%M.txt') AS report_path FROM events""",
)
def _(spark, sf):
    return samples.table(spark, sf, "events").select(
        "event_id", clock.partition_path("ts").alias("snapshot_path"), clock.report_path("ts").alias("report_path")
    )


@query("array_pick", o.final("daily", "station_id snapshot_date:d peak_hour:i"))
def _(spark, sf):
    """Arg-max by sorted array; a station has at most 24 hours per day."""
    picked = pick.first_of_array("snapshot_hour", "avg_occupancy_rate").alias("peak_hour")
    return hourly(spark, sf).groupBy("station_id", "snapshot_date").agg(picked)

