"""Snapshot quality checks.  Every check is one aggregation over any number of snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.schemas import BRONZE

# Columns, limits and gate of the check suite.
CRITICAL_COLUMNS = ("stationcode", "name", "lon", "lat", "capacity", "numdocksavailable", "numbikesavailable")
RANGE_COLUMNS = ("capacity", "numbikesavailable", "numdocksavailable")
RANGE = (0, 110)
NULL_SHARE_LIMIT = 0.05
MAX_AGE_HOURS = 1
DUPLICATE_KEYS = ("stationcode", "ingestion_timestamp")
PASS_GATE_PCT = 80.0

# Texts of the check suite and of its report.
SCHEMA_OK = "Schema is valid (%d columns)"
SCHEMA_BAD = "Missing columns: %s"
NULLS_OK = "Missing values are within threshold (< 5.0%)"
NULLS_BAD = "Too many missing values: "
NULLS_ITEM = "%s: %.2f%%"
DUPLICATES_OK = "No duplicates detected"
DUPLICATES_BAD = "Detected %d duplicates (%.2f%%)"
DUPLICATES_NO_KEYS = "Cannot check duplicates because key columns are missing"
FRESHNESS_OK = "Data freshness is valid (%.1fh old)"
FRESHNESS_BAD = "Data is too old: %.1fh (max=1h)"
RANGES_OK = "All numeric values are within expected ranges"
RANGES_BAD = "Out-of-range values found: "
RANGES_ITEM = "%s: %d values out of [0, 110]"
CONSISTENCY_OK = "Data consistency check passed"
CONSISTENCY_BAD = "Detected %d inconsistent rows (numbikesavailable + numdocksavailable != capacity)"
CONSISTENCY_NO_COLUMNS = "Cannot check consistency because required columns are missing"
REPORT_ROWS = "Rows checked: %d"
REPORT_PASSED = "Tests passed: %d"
REPORT_FAILED = "Tests failed: %d"
REPORT_RATE = "Success rate: %.1f%%"
REPORT_PASS = "- [PASS] "
REPORT_FAIL = "- [FAIL] "


def missing_columns(df: DataFrame, expected: Sequence[str] = tuple(BRONZE.fieldNames())) -> list[str]:
    return sorted(set(expected) - set(df.columns))


def schema_diff(df: DataFrame, expected: Sequence[str] = tuple(BRONZE.fieldNames())) -> DataFrame:
    """One row per expected column, telling whether the input has it, with the input's row count."""
    rows = df.agg(F.count(F.lit(1)).alias("input_rows"))
    flags = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c in df.columns).alias("present")) for c in expected])
    return rows.select(F.explode(flags).alias("f"), "input_rows").select("f.*", "input_rows")


def null_shares(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS, group: Sequence[str] = ()) -> DataFrame:
    """Share of NULLs per critical column, in long form; absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    stats = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in present]
    )
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in present])
    share = F.col("null_rows") / F.nullif(F.col("rows"), F.lit(0).cast("bigint"))
    return (
        stats.select(*group, "rows", F.explode(entries).alias("e"))
        .select(*group, "rows", "e.*")
        .withColumns({"null_share": share, "passed": F.coalesce(share <= NULL_SHARE_LIMIT, F.lit(True))})
    )


def duplicate_counts(df: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS, group: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first per key; NULL keys equal each other."""
    per_key = df.groupBy(*dict.fromkeys((*group, *keys))).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(*group).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
    )


def age_hours(latest: Column, as_of: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", latest, as_of) / F.lit(3600e6)


def freshness(df: DataFrame, as_of: Column, max_age_hours: float = MAX_AGE_HOURS, group: Sequence[str] = ()) -> DataFrame:
    """Latest instant and its age at ``as_of`` (a TIMESTAMP)."""
    latest = F.max(F.try_to_timestamp(F.col("ingestion_timestamp")))
    found = df.groupBy(*group).agg(latest.alias("latest"))
    age = age_hours(F.col("latest"), as_of)
    return found.withColumns({"age_hours": age, "passed": F.coalesce(age <= max_age_hours, F.lit(False))})


def out_of_range(column: str, limits: tuple[float, float] = RANGE) -> Column:
    """Count of values outside the closed range; NULL never counts."""
    return F.count_if((F.col(column) < limits[0]) | (F.col(column) > limits[1]))


def range_counts(df: DataFrame, columns: Sequence[str] = RANGE_COLUMNS, limits: tuple[float, float] = RANGE) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    stats = df.agg(*[out_of_range(c, limits).alias(c) for c in present])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("out_of_range")) for c in present])
    return stats.select(F.explode(entries).alias("e")).select("e.*")


def inconsistent() -> Column:
    """Count of rows where bikes and docks do not add up to the capacity; NULL never counts."""
    return F.count_if(F.col("numbikesavailable") + F.col("numdocksavailable") != F.col("capacity"))


def consistency_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), inconsistent().alias("inconsistent"))


def snapshot_measures(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """All measures per snapshot, in one pass: the rows are first reduced to the duplicate keys, then to the snapshots."""
    measures = [F.count(F.lit(1)).alias("total_rows"), F.max(F.try_to_timestamp("ingestion_timestamp")).alias("latest")]
    measures += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL_COLUMNS if c in df.columns]
    measures += [out_of_range(c).alias(f"range_{c}") for c in RANGE_COLUMNS if c in df.columns]
    if not missing_columns(df, RANGE_COLUMNS):
        measures.append(inconsistent().alias("inconsistent"))
    if not missing_columns(df, DUPLICATE_KEYS):
        # A struct is never NULL, so keys with NULLs count like any other.
        measures.append((F.count(F.lit(1)) - F.count_distinct(F.struct(*DUPLICATE_KEYS))).alias("duplicates"))
    return df.groupBy(*group).agg(*measures)


def check_rows(df: DataFrame, as_of: Column, group: Sequence[str] = ("snapshot_id",)) -> DataFrame:
    """Six rows (check, passed, message) per snapshot."""
    details = _with_details(df, as_of, group)
    return details.select(*group, "total_rows", F.explode("details").alias("c")).select(*group, "total_rows", "c.*")


def _with_details(df: DataFrame, as_of: Column, group: Sequence[str]) -> DataFrame:
    """(group, total_rows, details): the six checks of a snapshot as an array, by name."""
    measures = snapshot_measures(df, group)
    total = F.nullif(F.col("total_rows"), F.lit(0).cast("bigint"))
    missing = missing_columns(df)
    shares = [(c, F.col(f"null_{c}") / total) for c in CRITICAL_COLUMNS if c in df.columns]
    too_null = _issues([(s > NULL_SHARE_LIMIT, F.format_string(NULLS_ITEM, F.lit(c), s * 100)) for c, s in shares], ", ")
    counts = [(c, F.col(f"range_{c}")) for c in RANGE_COLUMNS if c in df.columns]
    too_far = _issues([(n > 0, F.format_string(RANGES_ITEM, F.lit(c), n)) for c, n in counts], "; ")
    age = age_hours(F.col("latest"), as_of)
    checks = [
        _check("schema", F.lit(not missing), F.lit(SCHEMA_OK % len(BRONZE)), F.lit(SCHEMA_BAD % missing)),
        _check("nulls", too_null == "", F.lit(NULLS_OK), F.concat(F.lit(NULLS_BAD), too_null)),
        _impossible("duplicates", DUPLICATES_NO_KEYS),
        _check(
            "freshness",
            F.coalesce(age <= MAX_AGE_HOURS, F.lit(False)),
            F.format_string(FRESHNESS_OK, age),
            F.format_string(FRESHNESS_BAD, age),
        ),
        _check("ranges", too_far == "", F.lit(RANGES_OK), F.concat(F.lit(RANGES_BAD), too_far)),
        _impossible("consistency", CONSISTENCY_NO_COLUMNS),
    ]
    if "duplicates" in measures.columns:
        extra = F.col("duplicates")
        found = F.format_string(DUPLICATES_BAD, extra, extra / total * F.lit(100.0))
        checks[2] = _check("duplicates", extra == 0, F.lit(DUPLICATES_OK), found)
    if "inconsistent" in measures.columns:
        bad = F.col("inconsistent")
        checks[5] = _check("consistency", bad == 0, F.lit(CONSISTENCY_OK), F.format_string(CONSISTENCY_BAD, bad))

    return measures.select(*group, "total_rows", F.array_sort(F.array(*checks)).alias("details"))


def _check(name: str, passed: Column, good: Column, bad: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"), passed.alias("passed"), F.when(passed, good).otherwise(bad).alias("message")
    )


def _impossible(name: str, why: str) -> Column:
    return _check(name, F.lit(False), F.lit(""), F.lit(why))


def _issues(findings: list[tuple[Column, Column]], separator: str) -> Column:
    return F.concat_ws(separator, *[F.when(found, text) for found, text in findings])


def quality_report(df: DataFrame, as_of: Column, group: Sequence[str] = ("snapshot_id",)) -> DataFrame:
    """One report row per snapshot: counts, success rate, gate, alert, and the six details."""
    report = _with_details(df, as_of, group)
    passed = F.size(F.filter("details", lambda d: d["passed"])).cast("bigint")
    return (
        report.select(*group, "total_rows", passed.alias("tests_passed"), (F.size("details") - passed).alias("tests_failed"), "details")
        .withColumn("success_rate", F.col("tests_passed") / (F.col("tests_passed") + F.col("tests_failed")) * 100)
        .withColumns({"gate_ok": F.col("success_rate") >= PASS_GATE_PCT, "alert": F.col("tests_failed") > 0})
    )


def report_text(report: DataFrame, timestamp: Column) -> DataFrame:
    """Reports with a ``text`` column in the plain-text layout."""
    lines = F.transform(
        "details",
        lambda d: F.concat(
            F.when(d["passed"], REPORT_PASS).otherwise(REPORT_FAIL), d["check"], F.lit(": "), d["message"]
        ),
    )
    text = F.concat_ws(
        "\n",
        F.lit("DATA QUALITY REPORT"),
        F.concat(F.lit("Timestamp: "), timestamp),
        F.format_string(REPORT_ROWS, "total_rows"),
        F.format_string(REPORT_PASSED, "tests_passed"),
        F.format_string(REPORT_FAILED, "tests_failed"),
        F.format_string(REPORT_RATE, "success_rate"),
        F.lit(""),
        F.lit("Details:"),
        F.array_join(lines, "\n"),
    )
    return report.withColumn("text", text)


def validate_ingest(df: DataFrame, quarantined: DataFrame | None = None) -> DataFrame:
    """One row: is there data, is the station key there, and how many payloads were set aside, if those are given."""
    if quarantined is None:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            "rows", (F.col("rows") > 0).alias("not_empty"), F.lit("stationcode" in df.columns).alias("has_stationcode")
        )
    both = df.select(F.lit(None).cast("string").alias("reason")).union(quarantined.select("reason"))
    counts = both.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    given, aside = F.col("reason").isNull(), F.when(F.col("reason").isNotNull(), F.struct("reason", "n"))
    return counts.agg(
        F.coalesce(F.sum(F.when(given, F.col("n"))), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~given, F.col("n"))), F.lit(0)).alias("quarantined"),
        F.map_from_entries(F.sort_array(F.collect_list(aside))).alias("reasons"),
    ).select("rows", (F.col("rows") > 0).alias("not_empty"), F.lit("stationcode" in df.columns).alias("has_stationcode"), "quarantined", "reasons")
