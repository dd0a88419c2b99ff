"""Time helpers.  Silver stores Paris wall-clock time as TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The zone of the network, the floor of an empty incremental target, names of UTC.
LOCAL_ZONE = "Europe/Paris"
EMPTY_TARGET_DATE = "1900-01-01"
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _local(instant: Column) -> Column:
    """TIMESTAMP to local wall-clock TIMESTAMP_NTZ, whatever the session zone.

    In a UTC session the shift is a plain offset; other sessions need a conversion between zones.
    """
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        return F.from_utc_timestamp(instant, LOCAL_ZONE).cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit(LOCAL_ZONE), instant)


def wall_clock(instant: str | Column) -> Column:
    """An instant (TIMESTAMP, or ISO-8601 text with an offset) as local wall-clock time.

    Unreadable text gives NULL.
    """
    return _local(F.try_to_timestamp(_col(instant)))


def wall_clock_now() -> Column:
    return _local(F.current_timestamp())


def day_of_week(column: str | Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_col(column)) - 1


def hour_floor(column: str | Column) -> Column:
    return F.date_trunc("hour", _col(column)).cast("timestamp_ntz")


def with_calendar(df: DataFrame, column: str = "snapshot_timestamp") -> DataFrame:
    return df.withColumns(
        {
            "snapshot_date": F.to_date(column),
            "snapshot_hour": F.hour(column),
            "snapshot_day_of_week": day_of_week(column),
        }
    )


def previous_hour(instant: str | Column) -> tuple[Column, Column]:
    """Local date and two-digit hour of the last closed hour before an instant."""
    closed = wall_clock(_col(instant) - F.expr("interval 1 hour"))
    return F.date_format(closed, "yyyy-MM-dd"), F.date_format(closed, "HH")


def snapshot_id(column: str | Column) -> Column:
    return F.date_format(_col(column), "yyyyMMdd_HHmmss")


def partition_path(column: str | Column) -> Column:
    """Relative file path of a snapshot taken at a wall-clock time."""
    return F.date_format(
        _col(column), "'ingestion_date='yyyy-MM-dd'/hour='HH'/snapshot_'yyyyMMdd'_'HHmmss'.parquet'"
    )


def report_path(column: str | Column) -> Column:
    """Relative file path of a quality report written for a wall-clock minute."""
    return F.date_format(
        _col(column), "'report_date='yyyy-MM-dd'/hour='HH'/report-'yyyy-MM-dd'-'HH'-'mm'.txt'"
    )


def days_before(column: str | Column, days: int) -> Column:
    return F.date_sub(_col(column), days)


def lookback_start(column: str | Column, days: int) -> Column:
    """Aggregate: first day to rebuild, or a fixed floor when the target is empty."""
    return F.coalesce(days_before(F.max(column), days), F.lit(EMPTY_TARGET_DATE).cast("date"))
