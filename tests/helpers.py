"""Small Bronze rows for the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockpulse.schemas import BRONZE

DEFAULT = {
    "stationcode": "501",
    "name": "Old Mill",
    "is_installed": "OUI",
    "capacity": 20,
    "numdocksavailable": 15,
    "numbikesavailable": 5,
    "mechanical": 3,
    "ebike": 2,
    "is_renting": "OUI",
    "is_returning": "OUI",
    "duedate": None,
    "nom_arrondissement_communes": "Paris",
    "code_insee_commune": "75056",
    "lon": 2.31,
    "lat": 48.87,
    "station_opening_hours": None,
    "ingestion_timestamp": "2026-02-26T14:00:00+01:00",
    "snapshot_id": "20260226_140000",
}


def bronze(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [tuple((DEFAULT | change)[c] for c in BRONZE.fieldNames()) for change in changes]
    return spark.createDataFrame(rows, BRONZE)
