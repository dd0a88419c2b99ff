"""Queries: sources and sinks, each as a round trip through stored files."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockpulse.catalogue import oracle as o
from dockpulse.catalogue.base import (
    CUTOFF,
    before_cutoff,
    boundary_table,
    bronze,
    fact,
    lake,
    landing,
    query,
    silver_rows,
    silver_warehouse,
    staged,
    station_rows,
    stored_table,
    without,
)
from dockpulse.catalogue.checks import AS_OF, DQ_REPORT
from dockpulse.config import parquet_warehouse
from dockpulse.operators import gold
from dockpulse.operators.hygiene import loaded_days
from dockpulse.operators.loading import filter_from, rebuild_from, update_attribute
from dockpulse.operators.quality import check_rows
from dockpulse.operators.silver import project_fact, stored_fact, transform_silver
from dockpulse.operators.stations import stations_dimension
from dockpulse.session import work_path
from dockpulse.sinks import writers
from dockpulse.sources import bronze as lake_source
from dockpulse.sources import jdbc
from dockpulse.sources.files import latest_readable_snapshot
from dockpulse.sources.landing import add_lineage, apply_type_contract, flatten_geo, scan_snapshot_json, with_bronze_partitions
from dockpulse.sources.tables import register_views, scan_table, stored_days

LAKE_COLUMNS = o.BRONZE_COLUMNS + " ingestion_date:d hour:i"


def _empty_warehouse(spark):
    return parquet_warehouse(work_path(spark, "warehouse"))


def _fact_of(spark, bronze_df):
    return stored_fact(project_fact(transform_silver(bronze_df)))


def _lake_rows(df):
    return df.drop("duedate", "station_opening_hours", "ingestion_timestamp")


@query(
    "scan_bronze",
    o.final("bronze", LAKE_COLUMNS, "WHERE ingestion_date = DATE '2024-01-15' AND hour BETWEEN 8 AND 8"),
)
def _(spark, sf):
    return _lake_rows(lake_source.scan_bronze(spark, lake(spark, sf), "2024-01-15", 8))


@query(
    "scan_snapshot_json",
    o.final("bronze", "stationcode name is_installed capacity:l numdocksavailable:l numbikesavailable:l mechanical:l ebike:l is_renting is_returning nom_arrondissement_communes code_insee_commune lon lat"),
)
def _(spark, sf):
    stations = flatten_geo(scan_snapshot_json(spark, landing(spark, sf), lines=True))
    return stations.drop("duedate", "station_opening_hours", "poll_date", "operator")


@query("scan_warehouse_filtered", o.final("fact", "station_id snapshot_timestamp:t", "WHERE is_empty"))
def _(spark, sf):
    table = _empty_warehouse(spark).table("station_availability")
    assert scan_table(spark, table) is None
    writers.write_table(fact(spark, sf), table)
    return scan_table(spark, table, ["station_id", "snapshot_timestamp"], "is_empty")


@query("latest_readable_snapshot", "SELECT count(*) > 0 AS readable FROM events")
def _(spark, sf):
    newest = latest_readable_snapshot(spark, lake(spark, sf))
    return spark.read.parquet(newest).agg((F.count(F.lit(1)) > 0).alias("readable"))


@query("jdbc_balanced_splits", f"{o.chain('fact')} SELECT count(*) AS rows, count(*) AS covered_once, 8 AS parts, true AS balanced FROM fact")
def _(spark, sf):
    """The conditions of a balanced read, applied to the stored fact: complete, disjoint, and none with twice its share."""
    rows = stored_table(spark, sf, "station_availability")
    parts = jdbc.split_predicates("snapshot_timestamp", jdbc.split_bounds(rows, "snapshot_timestamp", 8))
    hits = [F.expr(p).cast("int") for p in parts]
    sizes = F.greatest(*[F.sum(h) for h in hits])
    once = F.count_if(sum(hits[1:], hits[0]) == 1)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), once.alias("covered_once"), F.lit(len(parts)).alias("parts"),
        (sizes * len(parts) <= F.count(F.lit(1)) * 2).alias("balanced"),
    )


@query(
    "scan_boundaries",
    """SELECT s_suppkey + 1 AS arr_number, 'Paris ' || (s_suppkey + 1) || CASE WHEN s_suppkey = 0 THEN 'er' ELSE 'e' END || ' Arrondissement' AS label,
              CASE WHEN s_suppkey % 3 = 2 THEN 2 ELSE 1 END AS polygon_count,
              CASE WHEN s_suppkey % 3 = 1 THEN 4 WHEN s_suppkey % 3 = 0 THEN 8 ELSE 8 END AS points,
              CASE WHEN s_suppkey % 7 <> 0 THEN CAST(225000 + (s_suppkey % 5) * 4000 + 2000 AS DOUBLE) / 100000 END AS centroid_lon,
              CASE WHEN s_suppkey % 7 <> 0 THEN CAST(4880000 + (s_suppkey // 5) * 2000 + 1000 AS DOUBLE) / 100000 END AS centroid_lat
       FROM supplier""",
)
def _(spark, sf):
    found = boundary_table(spark, sf, "supplier", "s_suppkey")
    return found.select(
        F.col("arr_number").cast("bigint").alias("arr_number"),
        "label",
        F.size("polygons").alias("polygon_count"),
        F.size(F.flatten(F.flatten("polygons"))).alias("points"),
        "centroid_lon",
        "centroid_lat",
    )


@query("list_partitions", f"{o.chain('bronze')} SELECT DISTINCT CAST(ingestion_date AS VARCHAR) AS ingestion_date FROM bronze")
def _(spark, sf):
    return lake_source.list_partitions(spark, lake(spark, sf))


@query("list_loaded_days", f"{o.chain('fact')} SELECT DISTINCT CAST(snapshot_date AS VARCHAR) AS day FROM fact ORDER BY day")
def _(spark, sf):
    days = stored_days(spark, silver_warehouse(spark, sf).table("station_availability"))
    return loaded_days(days, spark).orderBy("day")


@query(
    "partition_exists",
    f"{o.chain('bronze')} SELECT DISTINCT CAST(ingestion_date AS VARCHAR) AS ingestion_date, hour, true AS has_files FROM bronze",
)
def _(spark, sf):
    return lake_source.partition_files(spark, lake(spark, sf)).select(
        "ingestion_date", "hour", (F.col("files") > 0).alias("has_files")
    )


@query(
    "source_views",
    f"""{o.chain("stations", "fact")}
    SELECT s.district_municipality_names, count(*) AS measurements FROM fact a JOIN stations s ON a.station_id = s.station_id
    GROUP BY s.district_municipality_names""",
)
def _(spark, sf):
    register_views({"silver_stations": station_rows(spark, sf), "silver_station_availability": fact(spark, sf)})
    return spark.sql(
        """SELECT s.district_municipality_names, count(*) AS measurements
           FROM silver_station_availability a JOIN silver_stations s ON a.station_id = s.station_id
           GROUP BY s.district_municipality_names"""
    )


# Sinks


@query("write_bronze", o.final("bronze", LAKE_COLUMNS))
def _(spark, sf):
    """Written twice, as after a failure; nothing is doubled."""
    path = work_path(spark, "bronze-copy")
    writers.write_bronze(before_cutoff(bronze(spark, sf), "ingestion_date"), path)
    for _attempt in range(2):
        writers.write_bronze(bronze(spark, sf), path)
    return _lake_rows(lake_source.scan_bronze(spark, path))


@query("write_partitioned_clustered", o.final("fact", f"{o.FACT_COLUMNS} {o.CALENDAR_COLUMNS}"))
def _(spark, sf):
    """First write creates the partitioned table, the second appends to it."""
    table = _empty_warehouse(spark).table("station_availability")
    rows = fact(spark, sf)
    late = F.col("snapshot_timestamp") >= F.lit(CUTOFF).cast("timestamp_ntz")
    writers.write_table(rows.where(~late), table)
    writers.write_table(rows.where(late), table)
    return without(table.read(spark))


EARLY_STATIONS = f"""{o.chain("stations", "silver")},
    early AS (SELECT station_id, min(snapshot_timestamp) AS first_seen_at, max(snapshot_timestamp) AS last_seen_at
              FROM silver WHERE snapshot_timestamp < TIMESTAMP '{CUTOFF}' GROUP BY station_id)"""


@query(
    "load_dim_insert_only",
    f"""{EARLY_STATIONS}
    SELECT s.station_id, s.station_name, {o.KINDS["t"].format("coalesce(e.first_seen_at, s.first_seen_at)")} AS first_seen_at,
           {o.KINDS["t"].format("coalesce(e.last_seen_at, s.last_seen_at)")} AS last_seen_at
    FROM stations s LEFT JOIN early e ON s.station_id = e.station_id""",
)
def _(spark, sf):
    """The second load covers the whole period but must not touch stations of the first."""
    table = _empty_warehouse(spark).table("stations")
    rows = silver_rows(spark, sf)
    writers.load_dim_insert_only(spark, stations_dimension(before_cutoff(rows)), table)
    writers.load_dim_insert_only(spark, stations_dimension(rows), table)
    return table.read(spark).select("station_id", "station_name", "first_seen_at", "last_seen_at")


@query("load_fact_dedup", o.final("fact", f"{o.FACT_COLUMNS} {o.CALENDAR_COLUMNS}"))
def _(spark, sf):
    """An early load, then the whole period delivered twice: every key must end up stored once."""
    table = _empty_warehouse(spark).table("station_availability")
    rows = fact(spark, sf)
    writers.load_fact_dedup(spark, before_cutoff(rows), table)
    writers.load_fact_dedup(spark, rows.unionByName(rows), table)
    return without(table.read(spark))


@query("load_fact_by_bitmaps", o.final("fact", f"{o.FACT_COLUMNS} {o.CALENDAR_COLUMNS}"))
def _(spark, sf):
    """As above, through bitmaps of the stored keys: a table loaded without them, then the whole period twice, and once more."""
    warehouse = _empty_warehouse(spark)
    table, bitmaps = warehouse.table("station_availability"), writers.stored_key_bitmaps(work_path(spark, "key-bitmaps"))
    rows = fact(spark, sf)
    writers.load_fact_dedup(spark, before_cutoff(rows), table)
    writers.load_fact_by_bitmaps(spark, rows.unionByName(rows), table, bitmaps)
    bitmaps.compact(spark)
    writers.load_fact_by_bitmaps(spark, rows, table, bitmaps)
    return without(table.read(spark))


@query("materialize_full", o.final("dim", f"{o.STATION_COLUMNS} capacity_category city"))
def _(spark, sf):
    """The refresh replaces an earlier, smaller version."""
    table = _empty_warehouse(spark).table("dim_stations")
    rows = silver_rows(spark, sf)
    writers.materialize_full(gold.dim_stations(stations_dimension(before_cutoff(rows))), table)
    writers.materialize_full(gold.dim_stations(stations_dimension(rows)), table)
    return without(table.read(spark))


@query("incremental_replace", o.final("hourly", o.HOURLY_COLUMNS))
def _(spark, sf):
    """Start from the rows before the cut, then rebuild the tail of the table from all rows."""
    table = _empty_warehouse(spark).table("fact_hourly_availability")
    rows = staged(spark, sf)
    writers.incremental_replace(spark, gold.fact_hourly(before_cutoff(rows)), table, "station_id", "snapshot_date", "snapshot_hour")
    batch = gold.fact_hourly(filter_from(rows, rebuild_from(table.read(spark))))
    writers.incremental_replace(spark, batch, table, "station_id", "snapshot_date", "snapshot_hour")
    return table.read(spark)


@query(
    "incremental_source_filter",
    o.final(
        "staged",
        "station_id snapshot_timestamp:t",
        "WHERE snapshot_date >= (SELECT coalesce(max(snapshot_date) - 1, DATE '1900-01-01') FROM staged)",
    ),
)
def _(spark, sf):
    rows = gold.stg_availability(stored_table(spark, sf, "station_availability"))
    start = rebuild_from(stored_table(spark, sf, "fact_daily_station_stats"))
    return filter_from(rows, start).select("station_id", "snapshot_timestamp")


@query("staging_view", o.final("staged", "station_id snapshot_timestamp:t occupancy_rate:c"))
def _(spark, sf):
    register_views({"stg_station_availability": staged(spark, sf)})
    return spark.table("stg_station_availability").select("station_id", "snapshot_timestamp", "occupancy_rate")


@query(
    "write_dq_report",
    f"""{DQ_REPORT}
    SELECT snapshot_id, total_rows, substr(snapshot_id, 1, 4) || '-' || substr(snapshot_id, 5, 2) || '-' || substr(snapshot_id, 7, 2)
           AS report_date, CAST(substr(snapshot_id, 10, 2) AS INTEGER) AS hour, d.name AS "check", d.passed AS passed, d.message AS message
    FROM details""",
)
def _(spark, sf):
    path = work_path(spark, "quality-reports")
    rows = check_rows(bronze(spark, sf), F.lit(f"{AS_OF}+00:00").cast("timestamp"))
    writers.write_quality_report(rows, path, F.to_timestamp_ntz("snapshot_id", F.lit("yyyyMMdd_HHmmss")))
    return spark.read.parquet(path).withColumn("report_date", F.col("report_date").cast("string"))


@query(
    "update_dim_attr",
    f"""{o.chain("stations")}
    SELECT station_id, CASE WHEN district_municipality_names = 'Paris' THEN 'Paris ' || capacity ELSE district_municipality_names END
           AS district_municipality_names, district_municipality_names = 'Paris' AS changed FROM stations""",
)
def _(spark, sf):
    """Relabel the Paris stations; only their ``updated_at`` may move."""
    table = _empty_warehouse(spark).table("stations")
    writers.materialize_full(station_rows(spark, sf), table)
    rows = table.read(spark)
    updates = rows.select(
        "station_id",
        F.when(
            F.col("district_municipality_names") == "Paris", F.concat(F.lit("Paris "), F.col("capacity").cast("string"))
        )
        .otherwise(F.col("district_municipality_names"))
        .alias("district_municipality_names"),
    )
    moved = F.lit("2999-01-01").cast("timestamp_ntz")
    writers.materialize_full(update_attribute(rows, updates, now=moved), table)
    return table.read(spark).select("station_id", "district_municipality_names", (F.col("updated_at") == moved).alias("changed"))


@query("mirror_partitions", o.final("bronze", LAKE_COLUMNS))
def _(spark, sf):
    """A partly filled mirror is completed, and a second run copies nothing."""
    mirror = work_path(spark, "mirror")
    source = lake(spark, sf)
    early = lake_source.scan_bronze(spark, source).where(F.col("ingestion_date") < F.lit(CUTOFF).cast("date"))
    writers.write_bronze(early, mirror)
    writers.mirror_partitions(spark, source, mirror)
    writers.mirror_partitions(spark, source, mirror)
    return _lake_rows(lake_source.scan_bronze(spark, mirror))


@query(
    "mirror_null_ids",
    f"""{o.chain("bronze")} SELECT CAST(ingestion_date AS VARCHAR) AS ingestion_date,
        CASE WHEN numbikesavailable > 5 THEN snapshot_id END AS snapshot_id, count(*) AS rows FROM bronze GROUP BY ALL""",
)
def _(spark, sf):
    """Snapshots without an id are copied too, once."""
    source, mirror = work_path(spark, "mirror-source"), work_path(spark, "mirror")
    rows = bronze(spark, sf)
    writers.write_bronze(rows.withColumn("snapshot_id", F.when(F.col("numbikesavailable") > 5, F.col("snapshot_id"))), source)
    writers.write_bronze(before_cutoff(lake_source.scan_bronze(spark, source), "ingestion_date"), mirror)
    for _attempt in range(2):
        writers.mirror_partitions(spark, source, mirror)
    return lake_source.scan_bronze(spark, mirror).groupBy("ingestion_date", "snapshot_id").agg(F.count(F.lit(1)).alias("rows"))


@query("sink_by_target", f"{o.chain('stations')} SELECT 'parquet' AS kind, count(*) AS stations FROM stations")
def _(spark, sf):
    table = _empty_warehouse(spark).table("stations")
    writers.write_table(station_rows(spark, sf), table)
    return table.read(spark).agg(F.lit(table.kind).alias("kind"), F.count(F.lit(1)).alias("stations"))


@query(
    "ingest_payloads",
    f"""{o.chain("bronze")}
    SELECT strftime(ingestion_timestamp - INTERVAL 1 HOUR, '%Y%m%d_010000') AS snapshot_id, stationcode, name, is_installed, capacity,
           numdocksavailable, numbikesavailable, mechanical, ebike, is_renting, is_returning, CAST(NULL AS VARCHAR) AS duedate,
           nom_arrondissement_communes, code_insee_commune, lon, lat, CAST(NULL AS VARCHAR) AS station_opening_hours,
           strftime(ingestion_timestamp - INTERVAL 1 HOUR, '%Y-%m-%dT01:00:00.000000+01:00') AS ingestion_timestamp,
           'op-' || code_insee_commune AS operator
    FROM bronze""",
)
def _(spark, sf):
    """Landing texts to typed Bronze rows; the poll instant is the landing folder's UTC midnight."""
    stations = scan_snapshot_json(spark, landing(spark, sf), lines=True)
    typed = apply_type_contract(add_lineage(flatten_geo(stations), F.col("poll_date").cast("timestamp")))
    return with_bronze_partitions(typed).drop("poll_date", "ingestion_date", "hour")
