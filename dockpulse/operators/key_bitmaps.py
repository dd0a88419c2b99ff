"""Exact bitmaps of fact keys: one bit for each second in which a station has a stored measurement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Seconds of a row of the bitmaps, in words of 64 bits.  Rows exist only where a key is stored: a station that is measured
# each minute has about nine keys a row, and one measured twice a day has two short rows.
WORDS = 8
SPAN = 64 * WORDS
KEYS = ("station_id", "snapshot_date", "bucket")
BITS = [f"bits_{i}" for i in range(WORDS)]

BITMAP_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        *[T.StructField(b, T.LongType()) for b in BITS],
        T.StructField("snapshot_date", T.DateType()),
    ]
)


def _second(timestamp: str = "snapshot_timestamp") -> Column:
    return F.hour(timestamp) * 3600 + F.minute(timestamp) * 60 + F.second(timestamp)


def _bucket(second: Column) -> Column:
    return F.floor(second / SPAN).cast("int")


def _place(second: Column) -> tuple[Column, Column]:
    """The word of a row that holds the second, and its bit as a mask."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (second % 64).cast("int"))
    return F.floor(second % SPAN / 64).cast("int"), bit


def key_bitmaps(rows: DataFrame) -> DataFrame:
    """(station_id, snapshot_date, bucket, bits_0, ...) of rows with ``station_id`` and ``snapshot_timestamp``.

    Rows without a station or a time have no bit.
    """
    placed = rows.where("station_id IS NOT NULL AND snapshot_timestamp IS NOT NULL").select(
        "station_id", F.to_date("snapshot_timestamp").alias("snapshot_date"), _second().alias("second")
    )
    word, bit = _place(F.col("second"))
    bits = [F.bit_or(F.when(word == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(b) for i, b in enumerate(BITS)]
    return placed.groupBy("station_id", "snapshot_date", _bucket(F.col("second")).alias("bucket")).agg(*bits)


def merged_bitmaps(states: DataFrame) -> DataFrame:
    return states.groupBy(*KEYS).agg(*[F.bit_or(b).alias(b) for b in BITS])


def with_maybe_stored(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``rows`` with ``maybe_stored``: whether the bit of the row's station and second is set.

    A clear bit proves that no such key is stored.  A set one may stand for another instant of that second, or for a load that was
    lost behind its bitmaps, so only the stored keys decide about those.
    """
    known = bitmaps.select(*[F.col(k).alias(f"_{k}") for k in KEYS], *[F.col(b).alias(f"_{b}") for b in BITS])
    own = rows.withColumns({"_day": F.to_date("snapshot_timestamp"), "_second": _second()})
    match = (F.col("station_id") == F.col("_station_id")) & (F.col("_day") == F.col("_snapshot_date"))
    joined = own.join(known, match & (_bucket(F.col("_second")) == F.col("_bucket")), "left")
    word, bit = _place(F.col("_second"))
    held = F.get(F.array(*[F.col(f"_{b}") for b in BITS]), word)
    is_set = held.bitwiseAND(bit) != 0
    return joined.withColumn("maybe_stored", F.coalesce(is_set, F.lit(False))).select(*rows.columns, "maybe_stored")
