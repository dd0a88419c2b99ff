"""Landing payloads to the Bronze lake, in batch."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession

from dockpulse.operators.quality import validate_ingest
from dockpulse.session import stage, staged_for_use
from dockpulse.sinks.writers import write_bronze
from dockpulse.sources.landing import explode_payloads, extra_columns, quarantined, scan_payloads, to_bronze


class PayloadError(ValueError):
    """Payloads that give no station, and no folder to set them aside in."""


def run(
    spark: SparkSession, landing: str, lake: str, instant: Column, lines: bool = False, quarantine: str | None = None
) -> int:
    """Type, validate and append the payloads of a folder; returns the number of rows.

    Payloads that give no station go to ``quarantine`` with their file and a reason, as Parquet.  Without that folder one of them
    fails the run before anything is written.
    """
    payloads = scan_payloads(spark, landing, lines)
    with staged_for_use(quarantined(payloads), "quarantine") as aside:
        rows = explode_payloads(payloads.drop("file", "block_start"), extra=extra_columns(payloads))
        rows = stage(to_bronze(rows, instant), "ingest")
        found = validate_ingest(rows, aside).first()
        if found["quarantined"] and quarantine is None:
            raise PayloadError(f"{found['quarantined']} payloads in {landing} give no station: {found['reasons']}")
        if not found["not_empty"] or not found["has_stationcode"]:
            raise ValueError(f"payloads in {landing} hold no stations")
        if found["quarantined"]:
            aside.write.mode("append").parquet(quarantine)
        write_bronze(rows, lake)
    return found["rows"]
