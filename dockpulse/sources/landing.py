"""Raw station feed: JSON payloads in a landing folder, to typed Bronze rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.functions.clock import snapshot_id, wall_clock
from dockpulse.schemas import BRONZE, STATION_PAYLOAD

_STATIONS = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
_ENVELOPE = T.StructType([T.StructField("results", _STATIONS)])


def payload_stations(text: Column) -> Column:
    """Stations of one payload, each as a map of texts: either a list, or an object with a ``results`` list."""
    body = F.ltrim(text, F.lit(" \t\r\n"))
    return F.when(body.startswith("["), F.from_json(body, _STATIONS)).otherwise(
        F.from_json(body, _ENVELOPE)["results"]
    )


def payload_fault(text: Column) -> Column:
    """Why a payload cannot be read as stations, or NULL; a list that is empty has no fault."""
    body = F.ltrim(text, F.lit(" \t\r\n"))
    json, stations = F.try_parse_json(body), payload_stations(text)
    useful = (F.size(stations) == 0) | F.exists(stations, lambda station: station.isNotNull())
    # Stations come from a list or from ``results`` alone, so what gives some and is sound JSON needs no further look.
    sound = json.isNotNull() & F.coalesce(useful, F.lit(False))
    results = F.try_variant_get(json, "$.results", "variant")
    return (
        F.when(sound, F.lit(None).cast("string"))
        .when(F.coalesce(body, F.lit("")) == "", "empty")
        .when(json.isNull(), "no JSON")
        .when(~body.startswith("[") & ~body.startswith("{"), "neither list nor object")
        .when(body.startswith("{") & (results.isNull() | F.is_variant_null(results)), "no results")
        .otherwise("no stations")
    )


def quarantined(payloads: DataFrame, text: str = "value") -> DataFrame:
    """The payloads that cannot be read as stations, whole and with a ``reason``; other payload columns are kept.

    A payload is either here or in ``explode_payloads``, never in both and never in none.
    """
    return payloads.withColumn("reason", payload_fault(F.col(text))).where("reason IS NOT NULL")


def scan_payloads(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Landed payloads with the file they came in and where Spark's read of it began: (value, file, block_start)."""
    source = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start")]
    return spark.read.text(path, wholetext=not lines).select("*", *source)


def loose_number(text: Column, dtype: T.DataType) -> Column:
    """A number as feeds write it: ``12``, ``12.0`` or ``"12"``.  Whole columns take whole values only; the rest is NULL."""
    number = F.trim(text).try_cast("double")
    if isinstance(dtype, T.LongType):
        exact = F.coalesce(F.trim(text).try_cast(T.DecimalType(38, 10)), number.try_cast(T.DecimalType(38, 10)))
        return F.when(exact == F.floor(exact), exact).try_cast(dtype)
    return number


def _payload_column(field: T.StructField) -> Column:
    value = F.try_element_at("station", F.lit(field.name))
    if isinstance(field.dataType, T.StringType):
        return value.alias(field.name)
    if isinstance(field.dataType, T.StructType):
        parts = F.from_json(value, T.MapType(T.StringType(), T.StringType()))
        inner = [loose_number(F.try_element_at(parts, F.lit(f.name)), f.dataType).alias(f.name) for f in field.dataType]
        return F.when(parts.isNotNull(), F.struct(*inner)).alias(field.name)
    return loose_number(value, field.dataType).alias(field.name)


def extra_columns(payloads: DataFrame, text: str = "value") -> list[str]:
    """Names that the feed delivers beside the contract: one pass over the payloads, one row to the driver."""
    keys = F.explode(F.flatten(F.transform(payload_stations(F.col(text)), F.map_keys))).alias("key")
    found = payloads.select(keys).distinct().where(~F.col("key").isin(STATION_PAYLOAD.fieldNames()))
    return sorted(row["key"] for row in found.collect())


def explode_payloads(payloads: DataFrame, text: str = "value", extra: Sequence[str] = ()) -> DataFrame:
    """One row per station of every payload that can be read; other payload columns are kept, the rest is ``quarantined``.

    ``extra`` names columns of the feed beside the contract, which come out as text.
    """
    keep = [c for c in payloads.columns if c != text]
    given = F.filter(payload_stations(F.col(text)), lambda station: station.isNotNull())
    stations = payloads.where(payload_fault(F.col(text)).isNull()).select(*keep, F.explode(given).alias("station"))
    others = [F.try_element_at("station", F.lit(name)).alias(name) for name in extra]
    return stations.select(*keep, *[_payload_column(field) for field in STATION_PAYLOAD], *others)


def scan_snapshot_json(
    spark: SparkSession, path: str, lines: bool = False, extra: Sequence[str] | None = None
) -> DataFrame:
    """Stations of every payload in a landing folder: one payload per file, or one per line.

    Columns that the feed sends beside the contract pass through; they are looked up unless ``extra`` names them.
    """
    payloads = spark.read.text(path, wholetext=not lines)
    return explode_payloads(payloads, extra=extra_columns(payloads) if extra is None else extra)


def flatten_geo(df: DataFrame) -> DataFrame:
    """``coordonnees_geo{lon,lat}`` to two columns; anything but a struct gives NULL."""
    if "coordonnees_geo" not in df.columns:
        return df
    if not isinstance(df.schema["coordonnees_geo"].dataType, T.StructType):
        return df.withColumns({"lon": F.lit(None).cast("double"), "lat": F.lit(None).cast("double")}).drop(
            "coordonnees_geo"
        )
    return df.withColumns({"lon": F.col("coordonnees_geo.lon"), "lat": F.col("coordonnees_geo.lat")}).drop(
        "coordonnees_geo"
    )


def apply_type_contract(df: DataFrame) -> DataFrame:
    """Cast the contract columns that are present; keep every other column as it is."""
    present = {}
    for f in BRONZE:
        if f.name in df.columns:
            text = isinstance(df.schema[f.name].dataType, T.StringType) and not isinstance(f.dataType, T.StringType)
            present[f.name] = loose_number(F.col(f.name), f.dataType) if text else F.col(f.name).try_cast(f.dataType)
    return df.withColumns(present)


def add_lineage(df: DataFrame, instant: Column) -> DataFrame:
    """Stamp rows with the poll instant: ISO-8601 text with the local offset, and the snapshot id."""
    local = wall_clock(instant)
    offset = F.when(local == F.convert_timezone(None, F.lit("+01:00"), instant), "+01:00").otherwise("+02:00")
    text = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), offset)
    return df.withColumns({"ingestion_timestamp": text, "snapshot_id": snapshot_id(local)})


def to_bronze(stations: DataFrame, instant: Column) -> DataFrame:
    """Payload stations to Bronze rows with their partition columns."""
    typed = apply_type_contract(add_lineage(flatten_geo(stations), instant))
    return with_bronze_partitions(typed)


def with_bronze_partitions(df: DataFrame) -> DataFrame:
    local = wall_clock("ingestion_timestamp")
    return df.withColumns({"ingestion_date": F.to_date(local), "hour": F.hour(local)})
