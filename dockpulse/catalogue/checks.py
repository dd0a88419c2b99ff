"""Queries: quality checks and lake hygiene."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockpulse.catalogue import oracle as o
from dockpulse.catalogue.analysis import FIRST_VALID, ORPHANS, snapshot_files
from dockpulse.catalogue.base import (
    CUTOFF,
    before_cutoff,
    broken_landing,
    bronze,
    dim,
    fact,
    hourly,
    lake,
    landing,
    mixed_lake,
    query,
    station_rows,
)
from dockpulse.operators import expectations as ex
from dockpulse.operators import hygiene, quality
from dockpulse.sources.files import validate_parquet_files
from dockpulse.sources.landing import explode_payloads, quarantined, scan_payloads, scan_snapshot_json
from dockpulse.sources.samples import BROKEN_EVERY, BROKEN_PAYLOADS

# Scenario value: the instant at which freshness is judged (local midnight after the period).
AS_OF = "2024-01-30 23:00:00"
AS_OF_LOCAL = "2024-01-31 00:00:00"


def _as_of():
    return F.lit(f"{AS_OF}+00:00").cast("timestamp")


BROKEN = f"""{o.chain("bronze")}, broken AS (
    SELECT *, CASE WHEN is_installed IS NULL THEN NULL ELSE numbikesavailable * 5 END AS bikes FROM bronze)"""


def _broken(spark, sf):
    """Bronze with faults: bikes multiplied (out of range), and missing where the status is missing."""
    bikes = F.when(F.col("is_installed").isNotNull(), F.col("numbikesavailable") * 5)
    return bronze(spark, sf).withColumn("numbikesavailable", bikes)


@query(
    "dq_schema",
    "SELECT column_name, column_name <> 'duedate' AS present, (SELECT count(*) FROM events) AS input_rows FROM (VALUES "
    + ", ".join(f"('{c}')" for c in quality.BRONZE.fieldNames())
    + ") AS v(column_name)",
)
def _(spark, sf):
    return quality.schema_diff(bronze(spark, sf).drop("duedate"))


def _long(columns: dict[str, str], value: str, head: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS column_name, {expression} AS {value} {head}" for name, expression in columns.items())


@query(
    "dq_nulls",
    f"""{BROKEN}, nulls AS ({_long({c: f"count(*) FILTER (WHERE {'bikes' if c == 'numbikesavailable' else c} IS NULL)"
                                  for c in quality.CRITICAL_COLUMNS}, "null_rows", "FROM broken")})
    SELECT column_name, (SELECT count(*) FROM broken) AS rows, null_rows,
           CAST(null_rows AS DOUBLE) / (SELECT count(*) FROM broken) AS null_share,
           CAST(null_rows AS DOUBLE) / (SELECT count(*) FROM broken) <= 0.05 AS passed FROM nulls""",
)
def _(spark, sf):
    return quality.null_shares(_broken(spark, sf))


@query(
    "dq_duplicates",
    f"{o.chain('bronze')} SELECT count(*) * 2 AS rows, count(*) AS duplicates FROM bronze",
)
def _(spark, sf):
    """Every snapshot row delivered twice."""
    rows = bronze(spark, sf)
    return quality.duplicate_counts(rows.unionByName(rows))


@query(
    "dq_freshness",
    f"""{o.chain("bronze")}, f AS (SELECT snapshot_id, max(ingestion_timestamp) AS latest FROM bronze GROUP BY 1)
    SELECT snapshot_id, CAST(date_diff('microsecond', latest, TIMESTAMP '{AS_OF_LOCAL}') AS DOUBLE) / 3600e6 AS age_hours,
           CAST(date_diff('microsecond', latest, TIMESTAMP '{AS_OF_LOCAL}') AS DOUBLE) / 3600e6 <= 24 AS passed FROM f""",
)
def _(spark, sf):
    return quality.freshness(bronze(spark, sf), _as_of(), 24, group=("snapshot_id",)).drop("latest")


@query(
    "dq_ranges",
    f"""{BROKEN} {_long({c: f"count(*) FILTER (WHERE {'bikes' if c == 'numbikesavailable' else c} < 0 OR {'bikes' if c == 'numbikesavailable' else c} > 110)"
                        for c in quality.RANGE_COLUMNS}, "out_of_range", "FROM broken")}""",
)
def _(spark, sf):
    return quality.range_counts(_broken(spark, sf))


@query(
    "dq_consistency",
    f"""{BROKEN} SELECT count(*) AS rows, count(*) FILTER (WHERE bikes + numdocksavailable <> capacity) AS inconsistent FROM broken""",
)
def _(spark, sf):
    return quality.consistency_counts(_broken(spark, sf))


def _null_items() -> str:
    """The columns with too many NULLs, as the report lists them."""
    share = "CAST(null_{0} AS DOUBLE) / total_rows"
    items = [f"CASE WHEN {share.format(c)} > 0.05 THEN printf('{c}: %.2f%%', {share.format(c)} * 100) END" for c in quality.CRITICAL_COLUMNS]
    return f"concat_ws(', ', {', '.join(items)})"


def _range_items() -> str:
    items = [f"CASE WHEN range_{c} > 0 THEN '{c}: ' || range_{c} || ' values out of [0, 110]' END" for c in quality.RANGE_COLUMNS]
    return f"concat_ws('; ', {', '.join(items)})"


def dq_report_sql(rows: str) -> str:
    """Common table expressions up to ``judged``: one report for each snapshot of ``rows``."""
    return f"""
    measured AS (
        SELECT snapshot_id, count(*) AS total_rows, max(ingestion_timestamp) AS latest,
               count(*) - count(DISTINCT (stationcode, ingestion_timestamp)) AS duplicates,
               {", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in quality.CRITICAL_COLUMNS)},
               {", ".join(f"count(*) FILTER (WHERE {c} NOT BETWEEN 0 AND 110) AS range_{c}" for c in quality.RANGE_COLUMNS)},
               count(*) FILTER (WHERE numbikesavailable + numdocksavailable <> capacity) AS inconsistent
        FROM {rows} GROUP BY snapshot_id),
    texts AS (
        SELECT *, CAST(date_diff('microsecond', latest, TIMESTAMP '{AS_OF_LOCAL}') AS DOUBLE) / 3600e6 AS age,
               {_null_items()} AS nulls, {_range_items()} AS ranges FROM measured),
    details AS (
        SELECT snapshot_id, total_rows, unnest([
            {{'name': 'consistency', 'passed': inconsistent = 0, 'message': CASE WHEN inconsistent = 0 THEN 'Data consistency check passed'
              ELSE 'Detected ' || inconsistent || ' inconsistent rows (numbikesavailable + numdocksavailable != capacity)' END}},
            {{'name': 'duplicates', 'passed': duplicates = 0, 'message': CASE WHEN duplicates = 0 THEN 'No duplicates detected'
              ELSE printf('Detected %d duplicates (%.2f%%)', duplicates, CAST(duplicates AS DOUBLE) / total_rows * 100) END}},
            {{'name': 'freshness', 'passed': age <= 1, 'message': CASE WHEN age <= 1 THEN printf('Data freshness is valid (%.1fh old)', age)
              ELSE printf('Data is too old: %.1fh (max=1h)', age) END}},
            {{'name': 'nulls', 'passed': nulls = '', 'message': CASE WHEN nulls = '' THEN 'Missing values are within threshold (< 5.0%)'
              ELSE 'Too many missing values: ' || nulls END}},
            {{'name': 'ranges', 'passed': ranges = '', 'message': CASE WHEN ranges = '' THEN 'All numeric values are within expected ranges'
              ELSE 'Out-of-range values found: ' || ranges END}},
            {{'name': 'schema', 'passed': true, 'message': 'Schema is valid (18 columns)'}}]) AS d FROM texts),
    judged AS (
        SELECT snapshot_id, total_rows, count(*) FILTER (WHERE d.passed) AS passed,
               string_agg((CASE WHEN d.passed THEN 'PASS ' ELSE 'FAIL ' END) || d.name || ': ' || d.message, chr(10) ORDER BY d.name) AS details
        FROM details GROUP BY snapshot_id, total_rows)"""


DQ_REPORT = f"{o.chain('bronze')}, {dq_report_sql('bronze')}"


@query(
    "dq_report",
    f"""{DQ_REPORT} SELECT snapshot_id, total_rows, passed AS tests_passed, 6 - passed AS tests_failed,
        CAST(passed AS DOUBLE) / 6 * 100 AS success_rate, CAST(passed AS DOUBLE) / 6 * 100 >= 80 AS gate_ok, passed < 6 AS alert, details
        FROM judged""",
)
def _(spark, sf):
    """One report per snapshot of the whole lake, with all six details."""
    report = quality.quality_report(bronze(spark, sf), _as_of())
    lines = F.transform(
        "details",
        lambda d: F.concat(F.when(d["passed"], "PASS ").otherwise("FAIL "), d["check"], F.lit(": "), d["message"]),
    )
    return report.withColumn("details", F.array_join(lines, "\n"))


@query(
    "validate_parquet_files",
    f"{o.chain('bronze')} SELECT DISTINCT strftime(ingestion_timestamp, 'ingestion_date=%Y-%m-%d/hour=%H') AS folder, true AS all_valid FROM bronze",
)
def _(spark, sf):
    checked = validate_parquet_files(spark, lake(spark, sf))
    folder = F.regexp_extract("path", r"(ingestion_date=[^/]+/hour=[^/]+)/", 1).alias("folder")
    return checked.groupBy(folder).agg(F.bool_and("valid").alias("all_valid"))


@query(
    "bronze_cleanup",
    f"""{o.chain("snapshots")}, {FIRST_VALID}
    SELECT count(*) FILTER (WHERE s.valid AND k.file_name IS NULL) AS duplicate_files, count(*) FILTER (WHERE NOT s.valid) AS corrupted_files,
           count(*) FILTER (WHERE k.file_name IS NULL) AS files_to_delete, count(*) FILTER (WHERE k.file_name IS NOT NULL) AS remaining_files,
           count(*) FILTER (WHERE k.file_name IS NOT NULL) AS remaining_valid_files
    FROM snapshots s LEFT JOIN kept k ON s.folder = k.folder AND s.file_name = k.file_name""",
)
def _(spark, sf):
    files = snapshot_files(spark, sf)
    return hygiene.cleanup_summary(files, hygiene.cleanup_plan(files))


@query("test_not_null", f"{o.chain('bronze')} SELECT stationcode, snapshot_id FROM bronze WHERE is_installed IS NULL")
def _(spark, sf):
    return ex.not_null(bronze(spark, sf), "is_installed").select("stationcode", "snapshot_id")


@query(
    "test_unique",
    f"{o.chain('fact')} SELECT station_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS n_records FROM fact GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(spark, sf):
    return ex.unique(fact(spark, sf), "station_id", "snapshot_date")


@query(
    "test_accepted_values",
    f"{o.chain('dim')} SELECT capacity_category AS value_field, count(*) AS n_records FROM dim GROUP BY 1 HAVING capacity_category NOT IN ('small', 'medium')",
)
def _(spark, sf):
    return ex.accepted_values(dim(spark, sf), "capacity_category", ["small", "medium"])


@query("test_accepted_hours", f"{o.chain('hourly')} SELECT snapshot_hour AS value_field, count(*) AS n_records FROM hourly WHERE snapshot_hour NOT IN (7, 8, 9) GROUP BY 1")
def _(spark, sf):
    return ex.accepted_values(hourly(spark, sf), "snapshot_hour", [7, 8, 9])


@query("test_relationships", ORPHANS.replace("is_full", "is_empty"))
def _(spark, sf):
    rows = fact(spark, sf)
    return ex.relationships(rows, "station_id", before_cutoff(rows).where("is_empty"), "station_id")


RULES = [f"{c}_not_null" for c in (
    "station_id", "snapshot_timestamp", "num_bikes_available", "num_docks_available", "is_installed", "is_renting",
    "is_returning", "is_empty", "is_full", "is_operational", "ingestion_timestamp")]
RULES += [f"{c}_not_negative" for c in (
    "num_bikes_available", "num_bikes_available_mechanical", "num_bikes_available_ebike", "num_docks_available")]
RULES += [f"{c}_0_to_100" for c in ("occupancy_rate", "availability_rate", "service_rate")]


@query(
    "check_constraints",
    f"""{o.chain("fact")} SELECT constraint_name, CASE WHEN constraint_name = 'num_docks_available_not_negative'
        THEN (SELECT count(*) FROM fact WHERE num_docks_available < 5) ELSE 0 END AS violations
        FROM (VALUES {", ".join(f"('{r}')" for r in RULES)}) AS v(constraint_name)""",
)
def _(spark, sf):
    """Docks are lowered by five, so that one rule is broken."""
    rows = fact(spark, sf).withColumn("num_docks_available", F.col("num_docks_available") - 5)
    return ex.violation_counts(rows, ex.availability_constraints())


@query("validate_ingest", "SELECT count(*) AS rows, true AS not_empty, true AS has_stationcode FROM events")
def _(spark, sf):
    return quality.validate_ingest(scan_snapshot_json(spark, landing(spark, sf), lines=True))


BROKEN_SQL = f"""SELECT CASE event_id % {BROKEN_EVERY} {" ".join(f"WHEN {i} THEN '{reason}'" for i, (reason, _) in enumerate(BROKEN_PAYLOADS))} END AS reason,
    CASE event_id % {BROKEN_EVERY} {" ".join(f"WHEN {i} THEN replace('{text}', '%d', event_id::VARCHAR)" for i, (_, text) in enumerate(BROKEN_PAYLOADS))} END AS value
    FROM events WHERE event_id % {BROKEN_EVERY} < {len(BROKEN_PAYLOADS)}"""


@query("quarantined_payloads", BROKEN_SQL)
def _(spark, sf):
    """Whole payloads that give no station, from a landing folder of good and broken ones."""
    return quarantined(scan_payloads(spark, broken_landing(spark, sf), lines=True)).select("reason", "value")


@query(
    "validate_ingest_quarantine",
    f"""WITH broken AS ({BROKEN_SQL}), counts AS (SELECT reason, count(*) AS n FROM broken GROUP BY 1)
        SELECT (SELECT count(*) FROM events) AS rows, true AS not_empty, true AS has_stationcode, CAST(sum(n) AS BIGINT) AS quarantined,
               string_agg(reason || '=' || n, ', ' ORDER BY reason) AS reasons,
               (SELECT count(*) FROM events) + CAST(sum(n) AS BIGINT) AS landed FROM counts""",
)
def _(spark, sf):
    """Each good payload holds one station, so rows and quarantined payloads are all that landed."""
    payloads = scan_payloads(spark, broken_landing(spark, sf), lines=True)
    landed = F.lit(payloads.where("trim(value) <> ''").count())
    found = quality.validate_ingest(explode_payloads(payloads.select("value")), quarantined(payloads))
    pairs = F.transform(F.array_sort(F.map_entries("reasons")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return found.withColumns({"reasons": F.array_join(pairs, ", "), "landed": landed})


@query(
    "validate_mixed_schemas",
    f"""{o.chain("bronze")}, days AS (SELECT DISTINCT CAST(ingestion_date AS DATE) AS day, hour FROM bronze),
    broken AS (SELECT max(day) AS day FROM days GROUP BY day >= DATE '{CUTOFF}')
    SELECT strftime(day, '%Y-%m-%d') AS day, bool_and(valid) AS all_valid, CAST(sum(rows) AS BIGINT) AS rows
    FROM (SELECT CAST(ingestion_date AS DATE) AS day, true AS valid, 2 * count(*) AS rows FROM bronze GROUP BY 1
          UNION ALL SELECT day, false, 0 FROM broken) GROUP BY 1""",
)
def _(spark, sf):
    """Every file has a verdict of its own, though files disagree about the types of two columns."""
    checked = validate_parquet_files(spark, mixed_lake(spark, sf))
    day = F.regexp_extract("path", r"ingestion_date=([^/]+)/", 1).alias("day")
    return checked.groupBy(day).agg(F.bool_and("valid").alias("all_valid"), F.sum("rows").alias("rows"))


@query("station_constraints", f"{o.chain('stations')} SELECT station_id, 'station_name_not_null' AS constraint_name FROM stations WHERE capacity > 35")
def _(spark, sf):
    """Names of large stations are removed, so that each of them breaks one rule."""
    rows = station_rows(spark, sf).withColumn("station_name", F.when(F.col("capacity") <= 35, F.col("station_name")))
    return ex.violations(rows, ex.station_constraints()).select("station_id", "constraint_name")

