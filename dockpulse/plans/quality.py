"""Check the newest readable snapshot, store the report, apply the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from dockpulse.functions.clock import LOCAL_ZONE, wall_clock
from dockpulse.operators.quality import PASS_GATE_PCT, quality_report, report_text
from dockpulse.session import stage
from dockpulse.sinks.writers import write_quality_report
from dockpulse.sources.files import latest_readable_snapshot


class QualityGateError(RuntimeError):
    """The success rate is below the gate."""


def lake_report(bronze: DataFrame, as_of: Column) -> DataFrame:
    """Reports of all snapshots at once."""
    return quality_report(bronze, as_of)


def run(
    spark: SparkSession, lake: str, reports: str, as_of: Column | None = None, gate: float = PASS_GATE_PCT
) -> Row:
    """Report row of the newest readable snapshot file; raises ``QualityGateError`` below the gate."""
    as_of = F.current_timestamp() if as_of is None else as_of
    snapshot = spark.read.parquet(latest_readable_snapshot(spark, lake))
    local = wall_clock(as_of - F.expr("interval 1 minute"))
    stamp = F.concat(F.date_format(wall_clock(as_of), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(f" {LOCAL_ZONE}"))
    report = stage(report_text(quality_report(snapshot, as_of, group=()), stamp), "quality-report")
    write_quality_report(report, reports, local)
    row = report.first()
    if row["success_rate"] < gate:
        raise QualityGateError(f"success rate {row['success_rate']:.1f}% is below the gate")
    return row
