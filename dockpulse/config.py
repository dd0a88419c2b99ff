"""Where the layers live, and which sink stores them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from dockpulse import schemas
from dockpulse.sources.jdbc import JdbcSource
from dockpulse.sources.tables import StoredTable

# Settings each target needs before anything runs.
REQUIRED = {
    "parquet": ("root",),
    "catalog": ("silver_schema", "gold_schema"),
    "jdbc": ("url", "user", "password"),
    "bigquery": ("project", "silver_schema", "gold_schema", "temporary_bucket"),
}

_TABLES: dict[str, tuple[str, schemas.T.StructType, tuple[str, ...], tuple[str, ...]]] = {
    "stations": ("silver", schemas.STATIONS, (), ("station_id",)),
    "station_availability": (
        "silver",
        schemas.AVAILABILITY_STORED,
        ("snapshot_date",),
        ("station_id", "snapshot_timestamp"),
    ),
    "fact_hourly_availability": ("gold", schemas.FACT_HOURLY, ("snapshot_date",), ("station_id", "snapshot_hour")),
    "fact_daily_station_stats": ("gold", schemas.FACT_DAILY, ("snapshot_date",), ("station_id",)),
    "dim_stations": ("gold", None, (), ("station_id",)),
    "mart_station_performance": ("gold", None, (), ("station_id",)),
    "mart_peak_hours_by_district": ("gold", None, (), ()),
    "backfilled_days": ("silver", schemas.BACKFILLED_DAYS, (), ("day",)),
}


def resolve_schema(default: str, custom: str | None, split: bool) -> str:
    """Schema for a model: with ``split``, a custom schema is appended to the default one."""
    return f"{default}_{custom.strip()}" if split and custom else default


@dataclass(frozen=True)
class Warehouse:
    """Silver and Gold tables of one target: ``parquet``, ``catalog``, ``jdbc`` or ``bigquery``."""

    target: str
    settings: Mapping[str, str]

    def __post_init__(self) -> None:
        if self.target not in REQUIRED:
            raise ValueError(f"unknown target {self.target!r}, expected one of {sorted(REQUIRED)}")
        missing = [name for name in REQUIRED[self.target] if not str(self.settings.get(name, "")).strip()]
        if missing:
            raise ValueError(f"target {self.target!r} needs: {', '.join(missing)}")

    def require_file_tables(self, what: str) -> None:
        """Refuse a job, before any work, whose tables Spark itself has to rewrite."""
        if self.target not in ("parquet", "catalog"):
            raise ValueError(f"{what} rewrites rows, which a {self.target} target leaves to its own server")

    def table(self, name: str) -> StoredTable:
        layer, schema, partition_by, sort_by = _TABLES[name]
        if self.target == "parquet":
            return StoredTable("parquet", f"{self.settings['root']}/{layer}/{name}", schema, {}, partition_by, sort_by)
        # With a target schema, layers are told apart by a suffix; without one, each has its own schema.
        own = self.settings.get(f"{layer}_schema", layer)
        schema_name = resolve_schema(self.settings.get("schema", own), own, split="schema" in self.settings)
        if self.target == "catalog":
            return StoredTable("catalog", f"{schema_name}.{name}", schema, {}, partition_by, sort_by)
        if self.target == "jdbc":
            source = JdbcSource(self.settings["url"], self.settings["user"], self.settings["password"])
            return StoredTable("jdbc", f"{schema_name}.{name}", schema, {"url": source.url, **source.properties()})
        options = {"temporaryGcsBucket": self.settings["temporary_bucket"], "writeMethod": "indirect"}
        if partition_by:
            options |= {"partitionField": "snapshot_timestamp", "partitionType": "DAY"}
        if sort_by:
            options["clusteredFields"] = "station_id"
        return StoredTable("bigquery", f"{self.settings['project']}.{schema_name}.{name}", schema, options)


def parquet_warehouse(root: str) -> Warehouse:
    return Warehouse("parquet", {"root": root.rstrip("/")})
