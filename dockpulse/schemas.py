"""Declared table schemas.  Parquet has no constraints, so rules live in ``operators.expectations``."""

from __future__ import annotations

from pyspark.sql import types as T

# Numeric types of the Silver and Gold contracts.
RATE = T.DecimalType(5, 2)
AMOUNT = T.DecimalType(12, 2)

_STR, _LONG, _INT, _DBL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_NTZ, _DATE, _BOOL = T.TimestampNTZType(), T.DateType(), T.BooleanType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# The 18-column snapshot contract; every extra input column is passed through.
BRONZE = _struct(
    stationcode=_STR,
    name=_STR,
    is_installed=_STR,
    capacity=_LONG,
    numdocksavailable=_LONG,
    numbikesavailable=_LONG,
    mechanical=_LONG,
    ebike=_LONG,
    is_renting=_STR,
    is_returning=_STR,
    duedate=_STR,
    nom_arrondissement_communes=_STR,
    code_insee_commune=_STR,
    lon=_DBL,
    lat=_DBL,
    station_opening_hours=_STR,
    ingestion_timestamp=_STR,
    snapshot_id=_STR,
)

BRONZE_PARTITIONS = _struct(ingestion_date=_DATE, hour=_INT)
BRONZE_LAKE = T.StructType(BRONZE.fields + BRONZE_PARTITIONS.fields)

# One station as the feed delivers it, before flattening.
STATION_PAYLOAD = T.StructType(
    [f for f in BRONZE.fields if f.name not in {"lon", "lat", "ingestion_timestamp", "snapshot_id"}]
    + [T.StructField("coordonnees_geo", _struct(lon=_DBL, lat=_DBL))]
)

STATIONS = _struct(
    station_id=_STR,
    station_name=_STR,
    capacity=_INT,
    latitude=_DBL,
    longitude=_DBL,
    district_municipality_names=_STR,
    insee_municipality_code=_STR,
    first_seen_at=_NTZ,
    last_seen_at=_NTZ,
    is_active=_BOOL,
    created_at=_NTZ,
    updated_at=_NTZ,
)

AVAILABILITY = _struct(
    station_id=_STR,
    snapshot_timestamp=_NTZ,
    num_bikes_available=_INT,
    num_bikes_available_mechanical=_INT,
    num_bikes_available_ebike=_INT,
    num_docks_available=_INT,
    is_installed=_BOOL,
    is_renting=_BOOL,
    is_returning=_BOOL,
    occupancy_rate=RATE,
    availability_rate=RATE,
    service_rate=RATE,
    is_empty=_BOOL,
    is_full=_BOOL,
    is_operational=_BOOL,
    ingestion_timestamp=_NTZ,
    processing_timestamp=_NTZ,
)

CALENDAR = _struct(snapshot_date=_DATE, snapshot_hour=_INT, snapshot_day_of_week=_INT)
AVAILABILITY_STORED = T.StructType(AVAILABILITY.fields + CALENDAR.fields)

FACT_HOURLY = _struct(
    station_id=_STR,
    snapshot_hour=_INT,
    snapshot_day_of_week=_INT,
    num_snapshots=_LONG,
    avg_bikes_available=AMOUNT,
    avg_bikes_mechanical=AMOUNT,
    avg_bikes_ebike=AMOUNT,
    avg_docks_available=AMOUNT,
    avg_occupancy_rate=RATE,
    avg_availability_rate=RATE,
    avg_service_rate=RATE,
    peak_bikes_available=_INT,
    trough_bikes_available=_INT,
    minutes_empty=_LONG,
    minutes_full=_LONG,
    operational_pct=RATE,
    hour_start=_NTZ,
    hour_end=_NTZ,
    snapshot_date=_DATE,
)

FACT_DAILY = _struct(
    station_id=_STR,
    active_hours=_LONG,
    total_snapshots=_LONG,
    avg_bikes_available=AMOUNT,
    avg_docks_available=AMOUNT,
    avg_occupancy_rate=RATE,
    avg_availability_rate=RATE,
    avg_service_rate=RATE,
    peak_hourly_avg_bikes=AMOUNT,
    trough_hourly_avg_bikes=AMOUNT,
    peak_hourly_occupancy=RATE,
    peak_hour=_INT,
    total_minutes_empty=_LONG,
    total_minutes_full=_LONG,
    pct_time_empty=RATE,
    pct_time_full=RATE,
    daily_operational_pct=RATE,
    snapshot_date=_DATE,
)

# GeoJSON file with district polygons.  Polygon and MultiPolygon nest their coordinates to
# different depths, so the array is read as text and parsed by type.
BOUNDARY_FILE = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "properties",
                            T.StructType(
                                [
                                    T.StructField("c_ar", _INT),
                                    T.StructField("geom_x_y", _struct(lon=_DBL, lat=_DBL)),
                                ]
                            ),
                        ),
                        T.StructField("geometry", _struct(type=_STR, coordinates=_STR)),
                    ]
                )
            ),
        )
    ]
)
RING = T.ArrayType(T.ArrayType(_DBL))
POLYGON = T.ArrayType(RING)
MULTIPOLYGON = T.ArrayType(POLYGON)

# Days that a backfill has read, with what came of them.
BACKFILLED_DAYS = T.StructType(
    [T.StructField("day", T.DateType()), T.StructField("rows_read", T.LongType()), T.StructField("rows_written", T.LongType())]
)
