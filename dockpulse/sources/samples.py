"""Adapter: the driver's event tables seen as station snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.functions.clock import LOCAL_ZONE, snapshot_id
from dockpulse.schemas import BRONZE_LAKE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze_rows(events: DataFrame, spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """Event rows (batch or stream) with their station's attributes, in the Bronze contract.

    The events meet one stored table after the other, whose sizes Catalyst knows; joined among
    themselves first, the two small tables would look larger than the events.  ``by_day`` brings the rows of a day together
    while they are narrow, before the contract's texts are made of them.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    event, user = F.col("event_id"), F.col("user_id")
    draw = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    capacity = F.when(event % 211 == 0, 0).otherwise(10 + (user * 7) % 41).cast("bigint")
    error = F.col("event_type") == "error"
    narrow = events.select("event_id", "ts", "user_id", "event_type", "props", F.to_date("ts").alias("ingestion_date"))
    joined = narrow.join(customer, F.col("user_id") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    if by_day:
        joined = joined.hint("rebalance", "ingestion_date")
    raw = (
        joined.withColumns({"draw": draw, "capacity": capacity, "is_error": error})
        .withColumn("numbikesavailable", F.col("draw") % (F.col("capacity") + 1))
        .withColumn("ebike", F.call_function("div", F.col("numbikesavailable"), F.lit(3).cast("bigint")))
    )
    free = F.col("capacity") - F.col("numbikesavailable")
    columns = {
        "stationcode": F.when(event % 5 == 0, F.concat(F.lit("  "), user.cast("string"), F.lit(" "))).otherwise(
            user.cast("string")
        ),
        "name": F.col("c_name"),
        "is_installed": F.when(event % 97 == 0, "NON")
        .when(event % 89 == 0, F.lit(None))
        .when(event % 83 == 0, "oui ")
        .otherwise("OUI"),
        "numdocksavailable": F.when(F.col("is_error"), F.greatest(free - 1, F.lit(0).cast("bigint"))).otherwise(free),
        "mechanical": F.col("numbikesavailable") - F.col("ebike"),
        "is_renting": F.when(F.col("is_error"), "NON").otherwise("YES"),
        "is_returning": F.when(F.col("is_error"), "NON").otherwise("1"),
        "duedate": F.lit(None).cast("string"),
        "nom_arrondissement_communes": F.when(F.col("c_nationkey") % 5 == 0, "Paris").otherwise(F.col("n_name")),
        "code_insee_commune": (F.col("c_nationkey") + 75000).cast("string"),
        "lon": _thousandths(2250 + (user % 25) * 8),
        "lat": _thousandths(48800 + (user % 20) * 5),
        "station_opening_hours": F.lit(None).cast("string"),
        # The feed's clock is written as UTC text; Silver turns it back into the wall clock in ``ts``.
        "ingestion_timestamp": F.date_format(
            F.convert_timezone(F.lit(LOCAL_ZONE), F.lit("UTC"), F.col("ts").cast("timestamp_ntz")),
            "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'",
        ),
        "snapshot_id": snapshot_id("ts"),
        "hour": F.hour("ts"),
    }
    return raw.withColumns(columns).select(*BRONZE_LAKE.fieldNames())


def _thousandths(value: Column) -> Column:
    return value.cast("double") / 1000.0


def bronze(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    return bronze_rows(table(spark, sf_dir, "events"), spark, sf_dir, by_day)


def payloads(bronze: DataFrame) -> DataFrame:
    """Bronze snapshots as raw feed payloads, one JSON text per poll of a station.

    Even hours deliver a plain list, odd hours an object with ``results``.  Numbers come in three spellings, ``12``, ``12.0`` and
    ``"12"``, and one column beside the contract, ``operator``.
    """
    left_out = {"lon", "lat", "ingestion_timestamp", "snapshot_id", "ingestion_date", "hour"}
    station = F.struct(
        *[F.col(name) for name in BRONZE_LAKE.fieldNames() if name not in left_out],
        F.struct("lon", "lat").alias("coordonnees_geo"),
        F.concat(F.lit("op-"), "code_insee_commune").alias("operator"),
    )
    text, kind = F.to_json(station), F.col("numbikesavailable") % 3
    numbers = r'"(capacity|numdocksavailable|numbikesavailable|mechanical|ebike)":([0-9]+)'
    text = (
        F.when(kind == 1, F.regexp_replace(text, numbers, '"$1":$2.0'))
        .when(kind == 2, F.regexp_replace(text, numbers, '"$1":"$2"'))
        .otherwise(text)
    )
    listed = F.concat(F.lit("["), text, F.lit("]"))
    value = F.when(F.col("hour") % 2 == 0, listed).otherwise(F.concat(F.lit('{"results":'), listed, F.lit("}")))
    return bronze.select(value.alias("value"), F.try_to_timestamp("ingestion_timestamp").alias("poll"))


# Every so many events one of each kind of broken payload; ``%d`` is the event.
BROKEN_EVERY = 40
BROKEN_PAYLOADS = (
    ("no JSON", "not json %d"),
    ("no JSON", '[{"stationcode": "%d", "name": "cut'),
    ("no JSON", '{"results": [{"stationcode": "%d"}, {"sta'),
    ("no results", '{"error": "station %d"}'),
    ("no stations", '{"results": [1], "poll": %d}'),
    ("no stations", "[%d, 2]"),
    ("neither list nor object", "%d"),
)


def broken_payloads(events: DataFrame) -> DataFrame:
    """(value, poll): payloads that give no station, from the keys of a given table."""
    kind = F.col("event_id") % BROKEN_EVERY
    value = F.lit(None).cast("string")
    for i, (_, text) in enumerate(BROKEN_PAYLOADS):
        value = F.when(kind == i, F.format_string(text.replace("%d", "%s"), F.col("event_id").cast("string"))).otherwise(value)
    return events.select(value.alias("value"), F.col("ts").cast("timestamp").alias("poll")).where("value IS NOT NULL")


def boundary_features(numbers: DataFrame, number: str) -> DataFrame:
    """Synthetic district features, one per row of ``numbers``, on a 5-wide grid of cells.

    By remainder of the number: a square with a hole, a triangle, or two small squares.  Every
    seventh feature has no centroid.
    """
    n = F.col(number).cast("int")
    left, low = 225000 + (n % 5) * 4000, 4880000 + F.call_function("div", n, F.lit(5)).cast("int") * 2000

    def ring(*corners: tuple[int, int]) -> Column:
        points = [F.array((left + x) / F.lit(100000.0), (low + y) / F.lit(100000.0)) for x, y in corners]
        return F.array(*points)

    square = ring((0, 0), (4000, 0), (4000, 2000), (0, 2000))
    hole = ring((1000, 500), (3000, 500), (3000, 1500), (1000, 1500))
    triangle = ring((0, 0), (4000, 0), (0, 2000), (0, 0))
    first = ring((0, 0), (1700, 0), (1700, 900), (0, 900))
    second = ring((2200, 1000), (4000, 1000), (4000, 2000), (2200, 2000))
    coordinates = (
        F.when(n % 3 == 0, F.to_json(F.array(square, hole)))
        .when(n % 3 == 1, F.to_json(F.array(triangle)))
        .otherwise(F.to_json(F.array(F.array(first), F.array(second))))
    )
    centroid = F.when(
        n % 7 != 0,
        F.struct(
            ((left + 2000) / F.lit(100000.0)).alias("lon"), ((low + 1000) / F.lit(100000.0)).alias("lat")
        ),
    )
    return numbers.select(
        (n + 1).alias("arr_number"),
        F.when(n % 3 == 2, "MultiPolygon").otherwise("Polygon").alias("kind"),
        coordinates.alias("coordinates"),
        centroid.alias("centroid"),
    )


def geojson_text(features: DataFrame) -> DataFrame:
    """Features as GeoJSON documents, one feature collection per row."""
    centroid = F.coalesce(F.to_json("centroid"), F.lit("null"))
    return features.select(
        F.format_string(
            '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"c_ar":%d,"geom_x_y":%s},'
            '"geometry":{"type":"%s","coordinates":%s}}]}',
            "arr_number",
            centroid,
            "kind",
            "coordinates",
        ).alias("value")
    )


