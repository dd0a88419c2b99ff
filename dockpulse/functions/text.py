"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens read as true, and the token a missing status stands for.
TRUE_TOKENS = ("OUI", "YES", "TRUE", "1")
DEFAULT_TOKEN = "OUI"

# Fixed value: the file name of a snapshot.
SNAPSHOT_NAME = r"^snapshot_(\d{8})_(\d{6})\.parquet$"


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def status_token(column: str | Column) -> Column:
    return F.upper(F.trim(F.coalesce(_col(column), F.lit(DEFAULT_TOKEN))))


def token_bool(column: str | Column) -> Column:
    """Text status to boolean: missing is true, unknown text is false."""
    return status_token(column).isin(*TRUE_TOKENS)


def strip_all(column: str | Column) -> Column:
    """Strip every kind of leading and trailing white space (SQL ``trim`` strips spaces only)."""
    return F.regexp_replace(_col(column), r"(?U)^\s+|\s+$", "")


def file_name(path: str | Column) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def parse_snapshot_name(name: str | Column) -> Column:
    """Timestamp in a snapshot's file name; NULL for other names and impossible dates."""
    name = _col(name)
    digits = F.concat(F.regexp_extract(name, SNAPSHOT_NAME, 1), F.regexp_extract(name, SNAPSHOT_NAME, 2))
    return F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")


def district_label(number: str | Column) -> Column:
    number = _col(number)
    suffix = F.when(number == 1, "er").otherwise("e")
    return F.concat(F.lit("Paris "), number.cast("string"), suffix, F.lit(" Arrondissement"))


def city_label(district: str | Column) -> Column:
    """``Paris`` for every district that names it, else the district; NULL stays NULL."""
    district = _col(district)
    return F.when(F.lower(district).contains("paris"), F.lit("Paris")).otherwise(district)


def capacity_category(capacity: str | Column) -> Column:
    capacity = _col(capacity)
    return (
        F.when(capacity <= 10, "small").when(capacity <= 20, "medium").when(capacity <= 35, "large").otherwise("extra_large")
    )
