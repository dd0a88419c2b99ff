"""SQL text for the side-by-side check.

Two-place figures are carried as whole hundredths (BIGINT), so that rounding is exact half-up
integer arithmetic and does not depend on floating point; ``final`` turns them into doubles.
"""

from __future__ import annotations


def mean_c(total: str, count: str) -> str:
    """Half-up quotient; ``total`` is in hundredths already."""
    return f"CAST((2 * ({total}) + ({count})) // (2 * ({count})) AS BIGINT)"


def mean_int(column: str) -> str:
    return mean_c(f"sum({column}) * 100", f"count({column})")


def mean_cents(column: str) -> str:
    return mean_c(f"sum({column})", f"count({column})")


def share(part: str, whole: str) -> str:
    return mean_c(f"({part}) * 10000", whole)


def rate(part: str) -> str:
    return (
        f"CASE WHEN capacity > 0 THEN least(10000, greatest(0, (({part}) * 20000 + capacity) // (2 * capacity))) ELSE 0 END"
    )


def flag(column: str) -> str:
    return f"upper(trim(coalesce({column}, 'OUI'))) IN ('OUI', 'YES', 'TRUE', '1')"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "drawn": (
        (),
        """
        SELECT e.event_id, e.user_id, e.ts, e.event_type = 'error' AS is_error, c.c_name, c.c_nationkey, n.n_name,
               CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS draw,
               CAST(CASE WHEN e.event_id % 211 = 0 THEN 0 ELSE 10 + (e.user_id * 7) % 41 END AS BIGINT) AS capacity
        FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    ),
    "bronze": (
        ("drawn",),
        """
        SELECT CASE WHEN event_id % 5 = 0 THEN '  ' || CAST(user_id AS VARCHAR) || ' ' ELSE CAST(user_id AS VARCHAR) END AS stationcode,
               c_name AS name,
               CASE WHEN event_id % 97 = 0 THEN 'NON' WHEN event_id % 89 = 0 THEN NULL
                    WHEN event_id % 83 = 0 THEN 'oui ' ELSE 'OUI' END AS is_installed,
               capacity,
               CASE WHEN is_error THEN greatest(capacity - draw % (capacity + 1) - 1, 0)
                    ELSE capacity - draw % (capacity + 1) END AS numdocksavailable,
               draw % (capacity + 1) AS numbikesavailable,
               draw % (capacity + 1) - (draw % (capacity + 1)) // 3 AS mechanical,
               (draw % (capacity + 1)) // 3 AS ebike,
               CASE WHEN is_error THEN 'NON' ELSE 'YES' END AS is_renting,
               CASE WHEN is_error THEN 'NON' ELSE '1' END AS is_returning,
               CASE WHEN c_nationkey % 5 = 0 THEN 'Paris' ELSE n_name END AS nom_arrondissement_communes,
               CAST(c_nationkey + 75000 AS VARCHAR) AS code_insee_commune,
               CAST(2250 + (user_id % 25) * 8 AS DOUBLE) / 1000 AS lon,
               CAST(48800 + (user_id % 20) * 5 AS DOUBLE) / 1000 AS lat,
               ts AS ingestion_timestamp,
               strftime(ts, '%Y%m%d_%H%M%S') AS snapshot_id,
               CAST(ts AS DATE) AS ingestion_date,
               CAST(extract(hour FROM ts) AS INTEGER) AS hour
        FROM drawn""",
    ),
    "clean": (
        ("bronze",),
        f"""
        SELECT trim(stationcode) AS station_id, trim(name) AS station_name,
               coalesce(capacity, 0) AS capacity,
               coalesce(numbikesavailable, 0) AS num_bikes_available,
               coalesce(mechanical, 0) AS num_bikes_available_mechanical,
               coalesce(ebike, 0) AS num_bikes_available_ebike,
               coalesce(numdocksavailable, 0) AS num_docks_available,
               {flag('is_installed')} AS is_installed, {flag('is_renting')} AS is_renting,
               {flag('is_returning')} AS is_returning,
               lon AS longitude, lat AS latitude,
               trim(nom_arrondissement_communes) AS district_municipality_names,
               trim(code_insee_commune) AS insee_municipality_code,
               ingestion_timestamp, ingestion_timestamp AS snapshot_timestamp, snapshot_id
        FROM bronze""",
    ),
    "enriched": (
        ("clean",),
        f"""
        SELECT *, {rate('num_bikes_available')} AS occupancy_rate, {rate('num_docks_available')} AS availability_rate,
               {rate('num_docks_available + num_bikes_available')} AS service_rate,
               num_bikes_available = 0 AS is_empty, num_docks_available = 0 AS is_full,
               is_installed AND is_renting AND is_returning AS is_operational
        FROM clean""",
    ),
    "silver": (
        ("enriched",),
        """
        SELECT * FROM enriched
        WHERE station_id IS NOT NULL AND station_id <> '' AND capacity > 0 AND num_bikes_available >= 0
          AND num_docks_available >= 0 AND snapshot_timestamp IS NOT NULL""",
    ),
    "fact": (
        ("silver",),
        """
        SELECT *, CAST(snapshot_timestamp AS DATE) AS snapshot_date,
               CAST(extract(hour FROM snapshot_timestamp) AS INTEGER) AS snapshot_hour,
               CAST(extract(dow FROM snapshot_timestamp) AS INTEGER) AS snapshot_day_of_week
        FROM silver""",
    ),
    "stations": (
        ("silver",),
        """
        SELECT station_id, station_name, capacity, latitude, longitude, district_municipality_names,
               insee_municipality_code, first_seen_at, snapshot_timestamp AS last_seen_at, true AS is_active
        FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY snapshot_timestamp DESC, snapshot_id DESC) AS rn,
                     min(snapshot_timestamp) OVER (PARTITION BY station_id) AS first_seen_at FROM silver)
        WHERE rn = 1""",
    ),
    "stg_stations": (
        ("stations",),
        "SELECT * FROM stations WHERE station_id IS NOT NULL AND capacity > 0 AND is_active",
    ),
    "dim": (
        ("stg_stations",),
        """
        SELECT *, CASE WHEN capacity <= 10 THEN 'small' WHEN capacity <= 20 THEN 'medium'
                       WHEN capacity <= 35 THEN 'large' ELSE 'extra_large' END AS capacity_category,
               CASE WHEN lower(district_municipality_names) LIKE '%paris%' THEN 'Paris'
                    ELSE district_municipality_names END AS city
        FROM stg_stations""",
    ),
    "staged": (("fact",), "SELECT * FROM fact WHERE station_id IS NOT NULL AND is_installed"),
    "hourly": (
        ("staged",),
        f"""
        SELECT station_id, snapshot_date, snapshot_hour, snapshot_day_of_week,
               count(*) AS num_snapshots,
               {mean_int('num_bikes_available')} AS avg_bikes_available,
               {mean_int('num_bikes_available_mechanical')} AS avg_bikes_mechanical,
               {mean_int('num_bikes_available_ebike')} AS avg_bikes_ebike,
               {mean_int('num_docks_available')} AS avg_docks_available,
               {mean_cents('occupancy_rate')} AS avg_occupancy_rate,
               {mean_cents('availability_rate')} AS avg_availability_rate,
               {mean_cents('service_rate')} AS avg_service_rate,
               max(num_bikes_available) AS peak_bikes_available, min(num_bikes_available) AS trough_bikes_available,
               CAST(sum(CASE WHEN is_empty THEN 1 ELSE 0 END) AS BIGINT) AS minutes_empty,
               CAST(sum(CASE WHEN is_full THEN 1 ELSE 0 END) AS BIGINT) AS minutes_full,
               {share('sum(CASE WHEN is_operational THEN 1 ELSE 0 END)', 'count(*)')} AS operational_pct,
               min(snapshot_timestamp) AS hour_start, max(snapshot_timestamp) AS hour_end
        FROM staged GROUP BY station_id, snapshot_date, snapshot_hour, snapshot_day_of_week""",
    ),
    "daily": (
        ("hourly",),
        f"""
        SELECT station_id, snapshot_date, count(DISTINCT snapshot_hour) AS active_hours,
               CAST(sum(num_snapshots) AS BIGINT) AS total_snapshots,
               {mean_cents('avg_bikes_available')} AS avg_bikes_available,
               {mean_cents('avg_docks_available')} AS avg_docks_available,
               {mean_cents('avg_occupancy_rate')} AS avg_occupancy_rate,
               {mean_cents('avg_availability_rate')} AS avg_availability_rate,
               {mean_cents('avg_service_rate')} AS avg_service_rate,
               max(avg_bikes_available) AS peak_hourly_avg_bikes, min(avg_bikes_available) AS trough_hourly_avg_bikes,
               max(avg_occupancy_rate) AS peak_hourly_occupancy,
               list(snapshot_hour ORDER BY avg_occupancy_rate DESC, snapshot_hour)[1] AS peak_hour,
               CAST(sum(minutes_empty) AS BIGINT) AS total_minutes_empty,
               CAST(sum(minutes_full) AS BIGINT) AS total_minutes_full,
               {share('sum(minutes_empty)', 'sum(num_snapshots)')} AS pct_time_empty,
               {share('sum(minutes_full)', 'sum(num_snapshots)')} AS pct_time_full,
               {mean_cents('operational_pct')} AS daily_operational_pct
        FROM hourly GROUP BY station_id, snapshot_date""",
    ),
    "summary": (
        ("daily", "dim"),
        f"""
        SELECT d.station_id, s.station_name, s.district_municipality_names, s.city, s.capacity, s.capacity_category,
               s.latitude, s.longitude, count(DISTINCT d.snapshot_date) AS days_observed,
               CAST(sum(d.total_snapshots) AS BIGINT) AS total_snapshots,
               min(d.snapshot_date) AS first_data_date, max(d.snapshot_date) AS last_data_date,
               {mean_cents('d.avg_occupancy_rate')} AS avg_occupancy_rate,
               {mean_cents('d.avg_service_rate')} AS avg_service_rate,
               {mean_cents('d.avg_bikes_available')} AS avg_bikes_available,
               {mean_cents('d.avg_docks_available')} AS avg_docks_available,
               {mean_cents('d.daily_operational_pct')} AS avg_operational_pct,
               {mean_cents('d.pct_time_empty')} AS avg_pct_time_empty,
               {mean_cents('d.pct_time_full')} AS avg_pct_time_full,
               CAST(sum(d.total_minutes_empty) AS BIGINT) AS total_minutes_empty,
               CAST(sum(d.total_minutes_full) AS BIGINT) AS total_minutes_full,
               {mean_cents('d.peak_hourly_occupancy')} AS avg_peak_hourly_occupancy
        FROM daily d JOIN dim s ON d.station_id = s.station_id
        GROUP BY d.station_id, s.station_name, s.district_municipality_names, s.city, s.capacity, s.capacity_category,
                 s.latitude, s.longitude""",
    ),
    "performance": (
        ("summary",),
        """
        SELECT *, rank() OVER (ORDER BY avg_occupancy_rate DESC NULLS LAST) AS global_occupancy_rank,
               rank() OVER (ORDER BY avg_pct_time_empty DESC NULLS LAST) AS most_empty_rank,
               rank() OVER (ORDER BY avg_pct_time_full DESC NULLS LAST) AS most_full_rank,
               rank() OVER (ORDER BY avg_operational_pct ASC NULLS LAST) AS least_reliable_rank,
               rank() OVER (PARTITION BY district_municipality_names ORDER BY avg_occupancy_rate DESC NULLS LAST)
                   AS district_occupancy_rank
        FROM summary""",
    ),
    "district_hours": (
        ("hourly", "dim"),
        f"""
        SELECT s.district_municipality_names, s.city, h.snapshot_day_of_week, h.snapshot_hour,
               count(DISTINCT h.station_id) AS num_stations, CAST(sum(h.num_snapshots) AS BIGINT) AS total_snapshots,
               {mean_cents('h.avg_occupancy_rate')} AS avg_occupancy_rate,
               {mean_cents('h.avg_availability_rate')} AS avg_availability_rate,
               {mean_cents('h.avg_bikes_available')} AS avg_bikes_available,
               {mean_cents('h.avg_docks_available')} AS avg_docks_available,
               {share('sum(h.minutes_empty)', 'sum(h.num_snapshots)')} AS pct_station_minutes_empty,
               {share('sum(h.minutes_full)', 'sum(h.num_snapshots)')} AS pct_station_minutes_full
        FROM hourly h JOIN dim s ON h.station_id = s.station_id
        GROUP BY s.district_municipality_names, s.city, h.snapshot_day_of_week, h.snapshot_hour""",
    ),
    "peak_hours": (
        ("district_hours",),
        """
        SELECT *, rank() OVER (PARTITION BY district_municipality_names, snapshot_day_of_week
                               ORDER BY avg_occupancy_rate DESC NULLS LAST) AS peak_hour_rank
        FROM district_hours""",
    ),
    "snapshots": (
        ("drawn",),
        """
        SELECT 'lake/' || strftime(ts, 'ingestion_date=%Y-%m-%d/hour=%H') AS folder,
               'snapshot_' || strftime(ts, '%Y%m%d_%H%M%S') || '.parquet' AS file_name,
               date_trunc('second', ts) AS snapshot_timestamp, bool_and(NOT is_error) AS valid
        FROM drawn GROUP BY ALL""",
    ),
    # District grid: cell of a nation key, polygon corners by its remainder, closed edges.
    "cells": (
        (),
        "SELECT n_nationkey AS n, 225000 + (n_nationkey % 5) * 4000 AS l, 4880000 + (n_nationkey // 5) * 2000 AS b FROM nation",
    ),
    "corners": (
        (),
        """
        SELECT * FROM (VALUES
            (0, 1, 1, 1, 0, 0), (0, 1, 1, 2, 4000, 0), (0, 1, 1, 3, 4000, 2000), (0, 1, 1, 4, 0, 2000),
            (0, 1, 2, 1, 1000, 500), (0, 1, 2, 2, 3000, 500), (0, 1, 2, 3, 3000, 1500), (0, 1, 2, 4, 1000, 1500),
            (1, 1, 1, 1, 0, 0), (1, 1, 1, 2, 4000, 0), (1, 1, 1, 3, 0, 2000), (1, 1, 1, 4, 0, 0),
            (2, 1, 1, 1, 0, 0), (2, 1, 1, 2, 1700, 0), (2, 1, 1, 3, 1700, 900), (2, 1, 1, 4, 0, 900),
            (2, 2, 1, 1, 2200, 1000), (2, 2, 1, 2, 4000, 1000), (2, 2, 1, 3, 4000, 2000), (2, 2, 1, 4, 2200, 2000)
        ) AS v(shape, poly, ring, seq, dx, dy)""",
    ),
    "edges": (
        ("cells", "corners"),
        """
        SELECT c.n, a.poly, a.ring, CAST(c.l + a.dx AS DOUBLE) / 100000 AS x1, CAST(c.b + a.dy AS DOUBLE) / 100000 AS y1,
               CAST(c.l + z.dx AS DOUBLE) / 100000 AS x2, CAST(c.b + z.dy AS DOUBLE) / 100000 AS y2
        FROM cells c JOIN corners a ON c.n % 3 = a.shape
        JOIN corners z ON z.shape = a.shape AND z.poly = a.poly AND z.ring = a.ring AND z.seq = a.seq % 4 + 1""",
    ),
    "rings": (
        ("edges", "stations"),
        """
        SELECT p.station_id, e.n, e.poly, e.ring FROM stations p
        JOIN edges e ON (e.y1 > p.latitude) <> (e.y2 > p.latitude)
                    AND p.longitude < (e.x2 - e.x1) * (p.latitude - e.y1) / (e.y2 - e.y1) + e.x1
        GROUP BY p.station_id, e.n, e.poly, e.ring HAVING count(*) % 2 = 1""",
    ),
    "contained": (
        ("rings",),
        """
        SELECT s.station_id, min(s.n) + 1 AS arr_number FROM rings s
        LEFT JOIN rings h ON h.station_id = s.station_id AND h.n = s.n AND h.poly = s.poly AND h.ring > 1
        WHERE s.ring = 1 AND h.station_id IS NULL GROUP BY s.station_id""",
    ),
    "centroids": (
        ("cells",),
        """
        SELECT n + 1 AS arr_number, CAST(l + 2000 AS DOUBLE) / 100000 AS x, CAST(b + 1000 AS DOUBLE) / 100000 AS y
        FROM cells WHERE n % 7 <> 0""",
    ),
    "nearest": (
        ("centroids", "stations"),
        """
        SELECT station_id, arr_number FROM (
            SELECT p.station_id, c.arr_number, row_number() OVER (PARTITION BY p.station_id ORDER BY
                (c.x - p.longitude) * (c.x - p.longitude) + (c.y - p.latitude) * (c.y - p.latitude), c.arr_number) AS rn
            FROM stations p CROSS JOIN centroids c) WHERE rn = 1""",
    ),
    "districts": (
        ("stations", "contained", "nearest"),
        """
        SELECT p.* EXCLUDE (district_municipality_names),
               CASE WHEN lower(trim(p.district_municipality_names)) = 'paris' THEN
                    'Paris ' || coalesce(c.arr_number, q.arr_number)
                    || CASE WHEN coalesce(c.arr_number, q.arr_number) = 1 THEN 'er' ELSE 'e' END || ' Arrondissement'
               ELSE trim(p.district_municipality_names) END AS district_municipality_names
        FROM stations p LEFT JOIN contained c ON p.station_id = c.station_id
        LEFT JOIN nearest q ON p.station_id = q.station_id""",
    ),
}

# How a column leaves the check: hundredths, date, timestamp, 32-bit and 64-bit integers.
KINDS = {
    "c": "CAST({0} AS DOUBLE) / 100",
    "d": "CAST({0} AS VARCHAR)",
    "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
    "i": "CAST({0} AS INTEGER)",
    "l": "CAST({0} AS BIGINT)",
}


def _ordered(names: tuple[str, ...], done: list[str]) -> list[str]:
    for name in names:
        _ordered(CTES[name][0], done)
        if name not in done:
            done.append(name)
    return done


def chain(*names: str) -> str:
    """WITH clause that defines the named tables and everything they need."""
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in _ordered(names, []))


def columns(spec: str) -> str:
    """``name:kind`` items to a select list."""
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        out.append(f"{KINDS[kind].format(name)} AS {name}" if kind else name)
    return ", ".join(out)


def final(table: str, spec: str, tail: str = "") -> str:
    return f"{chain(table)}\nSELECT {columns(spec)} FROM {table} {tail}"


STATION_COLUMNS = (
    "station_id station_name capacity:i latitude longitude district_municipality_names insee_municipality_code "
    "first_seen_at:t last_seen_at:t is_active"
)
FACT_COLUMNS = (
    "station_id snapshot_timestamp:t num_bikes_available:i num_bikes_available_mechanical:i num_bikes_available_ebike:i "
    "num_docks_available:i is_installed is_renting is_returning occupancy_rate:c availability_rate:c service_rate:c "
    "is_empty is_full is_operational ingestion_timestamp:t"
)
CALENDAR_COLUMNS = "snapshot_date:d snapshot_hour:i snapshot_day_of_week:i"
HOURLY_COLUMNS = (
    "station_id snapshot_date:d snapshot_hour:i snapshot_day_of_week:i num_snapshots:l avg_bikes_available:c "
    "avg_bikes_mechanical:c avg_bikes_ebike:c avg_docks_available:c avg_occupancy_rate:c avg_availability_rate:c "
    "avg_service_rate:c peak_bikes_available:i trough_bikes_available:i minutes_empty:l minutes_full:l operational_pct:c "
    "hour_start:t hour_end:t"
)
DAILY_COLUMNS = (
    "station_id snapshot_date:d active_hours:l total_snapshots:l avg_bikes_available:c avg_docks_available:c "
    "avg_occupancy_rate:c avg_availability_rate:c avg_service_rate:c peak_hourly_avg_bikes:c trough_hourly_avg_bikes:c "
    "peak_hourly_occupancy:c peak_hour:i total_minutes_empty:l total_minutes_full:l pct_time_empty:c pct_time_full:c "
    "daily_operational_pct:c"
)
SUMMARY_COLUMNS = (
    "station_id station_name district_municipality_names city capacity:i capacity_category latitude longitude "
    "days_observed:l total_snapshots:l first_data_date:d last_data_date:d avg_occupancy_rate:c avg_service_rate:c "
    "avg_bikes_available:c avg_docks_available:c avg_operational_pct:c avg_pct_time_empty:c avg_pct_time_full:c "
    "total_minutes_empty:l total_minutes_full:l avg_peak_hourly_occupancy:c"
)
GLOBAL_RANK_COLUMNS = "global_occupancy_rank:i most_empty_rank:i most_full_rank:i least_reliable_rank:i"
DISTRICT_HOUR_COLUMNS = (
    "district_municipality_names city snapshot_day_of_week:i snapshot_hour:i num_stations:l total_snapshots:l "
    "avg_occupancy_rate:c avg_availability_rate:c avg_bikes_available:c avg_docks_available:c "
    "pct_station_minutes_empty:c pct_station_minutes_full:c"
)
BRONZE_COLUMNS = (
    "stationcode name is_installed capacity:l numdocksavailable:l numbikesavailable:l mechanical:l ebike:l is_renting "
    "is_returning nom_arrondissement_communes code_insee_commune lon lat snapshot_id"
)
