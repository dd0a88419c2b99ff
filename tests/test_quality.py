from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import bronze
from pyspark.sql import functions as F

from dockpulse.config import parquet_warehouse
from dockpulse.operators import expectations as ex
from dockpulse.operators import hygiene, quality
from dockpulse.plans import cleanup
from dockpulse.plans import quality as quality_plan
from dockpulse.sinks.writers import write_bronze
from dockpulse.sources.landing import with_bronze_partitions
from dockpulse.sources import files
from dockpulse.sources.files import latest_readable_snapshot, validate_parquet_files


def at(text):
    return F.lit(text).cast("timestamp")


FRESH = "2026-02-26T13:30:00+00:00"


def details(report):
    return {d["check"]: (d["passed"], d["message"]) for d in report["details"]}


def test_clean_snapshot_passes(spark):
    report = quality.quality_report(bronze(spark, {}), at(FRESH)).first()
    assert (report["tests_passed"], report["tests_failed"], report["success_rate"], report["alert"]) == (6, 0, 100.0, False)
    assert details(report)["schema"] == (True, "Schema is valid (18 columns)")
    assert details(report)["freshness"] == (True, "Data freshness is valid (0.5h old)")


def test_gate_at_five_of_six_and_four_of_six(spark):
    old = quality.quality_report(bronze(spark, {}), at("2026-02-26T15:30:00+00:00")).first()
    assert (old["tests_passed"], old["gate_ok"], old["alert"]) == (5, True, True)
    assert details(old)["freshness"] == (False, "Data is too old: 2.5h (max=1h)")
    worse = quality.quality_report(bronze(spark, {"capacity": 19}), at("2026-02-26T15:30:00+00:00")).first()
    assert (worse["tests_passed"], worse["gate_ok"]) == (4, False)


def test_messages_of_failures(spark):
    rows = bronze(spark, {}, {}, {"lat": None, "numbikesavailable": 200}).drop("duedate")
    found = details(quality.quality_report(rows, at(FRESH), group=()).first())
    assert found["schema"] == (False, "Missing columns: ['duedate']")
    assert found["nulls"] == (False, "Too many missing values: lat: 33.33%")
    assert found["duplicates"] == (False, "Detected 2 duplicates (66.67%)")
    assert found["ranges"] == (False, "Out-of-range values found: numbikesavailable: 1 values out of [0, 110]")
    assert found["consistency"][1].startswith("Detected 1 inconsistent rows")


def test_nulls_are_neither_inconsistent_nor_out_of_range(spark):
    rows = bronze(spark, {"numbikesavailable": None})
    assert quality.consistency_counts(rows).first()["inconsistent"] == 0
    assert all(r["out_of_range"] == 0 for r in quality.range_counts(rows).collect())


def test_missing_key_columns(spark):
    found = details(quality.quality_report(bronze(spark, {}).drop("stationcode", "capacity"), at(FRESH), group=()).first())
    assert not found["duplicates"][0] and "key columns are missing" in found["duplicates"][1]
    assert not found["consistency"][0]


def test_reports_are_per_snapshot(spark):
    rows = bronze(spark, {}, {"snapshot_id": "other", "capacity": 5}, {"snapshot_id": None}, {"snapshot_id": None})
    reports = {r["snapshot_id"]: r["tests_failed"] for r in quality.quality_report(rows, at(FRESH)).collect()}
    assert reports == {"20260226_140000": 0, "other": 1, None: 1}


def test_empty_input(spark):
    report = quality.quality_report(bronze(spark, {}).where("stationcode = 'none'"), at(FRESH), group=()).first()
    assert (report["total_rows"], details(report)["freshness"][0], details(report)["duplicates"][0]) == (0, False, True)
    assert quality.validate_ingest(bronze(spark, {}).where("false")).first()["not_empty"] is False


def test_report_text(spark):
    text = quality.report_text(quality.quality_report(bronze(spark, {}), at(FRESH)), F.lit("now")).first()["text"]
    assert "Success rate: 100.0%" in text and "- [PASS] schema: Schema is valid (18 columns)" in text


def test_expectations(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "k string, v int")
    assert ex.not_null(rows, "k").count() == 1
    assert [tuple(r) for r in ex.unique(rows, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in ex.accepted_values(rows, "k", ["a"]).collect()] == [("b", 1)]
    assert [r[0] for r in ex.relationships(rows, "k", rows.where("k = 'a'"), "k").collect()] == ["b"]
    assert [tuple(r) for r in ex.orphan_counts(rows, "k", rows.where("k = 'b'"), "k").collect()] == [("a", 2)]
    broken = ex.violations(rows, [ex.Constraint("small", F.col("v") < 3), ex.Constraint("named", F.col("k").isNotNull())])
    assert sorted(r["constraint_name"] for r in broken.collect()) == ["named", "small"]


def write_snapshot(folder, name, rows=2):
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"stationcode": [str(i) for i in range(rows)]}), folder / name)
    return folder / name


@pytest.fixture
def hour(tmp_path):
    folder = tmp_path / "ingestion_date=2026-02-26" / "hour=14"
    write_snapshot(folder, "snapshot_20260226_140500.parquet")
    write_snapshot(folder, "snapshot_20260226_140530.parquet")
    write_snapshot(folder, "snapshot_20260226_140531.parquet")
    (folder / "snapshot_20260226_140700.parquet").write_bytes(b"PAR1 broken")
    write_snapshot(folder, "snapshot_20260226_140730.parquet")
    write_snapshot(folder, "notes.parquet")
    return folder


def names(df):
    return sorted(r["path"].rsplit("/", 1)[1] for r in df.collect())


def test_validation_finds_the_broken_file(spark, hour):
    bad = validate_parquet_files(spark, str(hour)).where("not valid").collect()
    assert [r["path"].rsplit("/", 1)[1] for r in bad] == ["snapshot_20260226_140700.parquet"]
    assert bad[0]["error"] == "no readable rows"


def test_truncated_pages_are_found(spark, tmp_path):
    path = write_snapshot(tmp_path / "t", "snapshot_20260226_140500.parquet", rows=5000)
    data = bytearray(path.read_bytes())
    data[100:2000] = b"\xff" * 1900
    path.write_bytes(bytes(data))
    assert not validate_parquet_files(spark, str(tmp_path / "t")).first()["valid"]


def test_first_valid_file_of_a_minute_is_kept(spark, hour):
    validated = validate_parquet_files(spark, str(hour))
    assert names(hygiene.files_to_delete(validated)) == [
        "snapshot_20260226_140530.parquet",
        "snapshot_20260226_140531.parquet",
        "snapshot_20260226_140700.parquet",
    ]


def test_cleanup_rewrites_only_when_asked(spark, hour):
    lake, before = str(hour.parent.parent), {p.name for p in hour.glob("*.parquet")}
    dry = cleanup.clean(spark, lake, "2026-02-26", 14)
    assert {p.name for p in hour.glob("*.parquet")} == before
    assert dry == cleanup.CleanupResult(1, 4, 1, 6)
    assert cleanup.clean(spark, lake, "2026-02-26", 14, dry_run=False) == dry
    assert not before & {p.name for p in hour.glob("*.parquet")}
    ids = sorted((r["snapshot_id"] or "", r["stationcode"]) for r in spark.read.parquet(lake).collect())
    assert ids == [(i, s) for i in ("", "20260226_140500", "20260226_140730") for s in ("0", "1")]
    assert cleanup.clean(spark, lake) == cleanup.CleanupResult(0, 0, 0, 6)


def test_cleanup_of_a_lake_of_rows(spark, tmp_path):
    """Snapshots stored by rows: a minute with two, a day written twice, and an extra column."""
    lake = str(tmp_path / "lake")
    at = "2026-02-26T14:00:{:02d}+01:00".format
    changes = [
        {"stationcode": str(i), "ingestion_timestamp": at(second), "snapshot_id": f"20260226_1400{second:02d}"}
        for second in (5, 40)
        for i in range(3)
    ]
    rows = with_bronze_partitions(bronze(spark, *changes)).withColumn("operator", F.lit("op"))
    for _attempt in range(2):
        write_bronze(rows, lake, skip_stored=False)
    found = cleanup.clean(spark, lake, dry_run=False)
    assert found == cleanup.CleanupResult(0, 9, 1, 3)
    stored = spark.read.parquet(lake).collect()
    assert sorted((r["snapshot_id"], r["stationcode"], r["operator"]) for r in stored) == [("20260226_140005", str(i), "op") for i in range(3)]


def test_cleanup_refuses_to_leave_nothing(spark, tmp_path):
    folder = tmp_path / "ingestion_date=2026-02-26" / "hour=14"
    folder.mkdir(parents=True)
    (folder / "snapshot_20260226_140700.parquet").write_bytes(b"x")
    with pytest.raises(ValueError):
        cleanup.clean(spark, str(tmp_path), dry_run=False)
    assert list(folder.glob("*.parquet"))


def test_latest_readable_skips_broken_files(spark, hour):
    import os

    os.utime(hour / "snapshot_20260226_140700.parquet", (2e9, 2e9))
    os.utime(hour / "snapshot_20260226_140531.parquet", (1.9e9, 1.9e9))
    assert latest_readable_snapshot(spark, str(hour), candidates=1).endswith("snapshot_20260226_140531.parquet")


def test_quality_job_stores_the_report_and_applies_the_gate(spark, tmp_path):
    lake, reports = str(tmp_path / "lake"), str(tmp_path / "reports")
    bronze(spark, {}).coalesce(1).write.parquet(lake)
    row = quality_plan.run(spark, lake, reports, at("2026-02-26T13:10:00+00:00"))
    assert row["tests_passed"] == 6
    stored = spark.read.parquet(reports).first()
    assert (str(stored["report_date"]), stored["hour"]) == ("2026-02-26", 14)
    with pytest.raises(quality_plan.QualityGateError):
        quality_plan.run(spark, lake, reports, at("2026-02-26T16:10:00+00:00"), gate=90)


def test_missing_days(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2026-03-01', DATE '2026-03-06')) AS day")
    loaded = hygiene.loaded_days(spark.sql("SELECT TIMESTAMP_NTZ '2026-03-02 10:00:00' AS snapshot_timestamp"), spark)
    left = hygiene.missing_days(days, loaded, "2026-03-02", "2026-03-04")
    assert sorted(str(r["day"]) for r in left.collect()) == ["2026-03-03", "2026-03-04"]
    assert hygiene.missing_days(days, hygiene.loaded_days(None, spark)).count() == 6


def test_cleanup_job_loads_the_cleaned_hour(spark, tmp_path):
    lake = tmp_path / "lake"
    folder = lake / "ingestion_date=2026-02-26" / "hour=14"
    folder.mkdir(parents=True)
    rows = bronze(spark, {}, {"stationcode": "2"}).toPandas()
    for name in ("snapshot_20260226_140000.parquet", "snapshot_20260226_140030.parquet"):
        rows.to_parquet(folder / name, index=False)
    (folder / "snapshot_20260226_140100.parquet").write_bytes(b"broken")
    warehouse = parquet_warehouse(str(tmp_path / "wh"))
    cleaned, run = cleanup.run(spark, warehouse, str(lake), "2026-02-26", 14)
    assert (cleaned.corrupted_files, cleaned.duplicate_rows, run.rows_read, run.facts.rows_written) == (1, 2, 2, 2)
    stored = warehouse.table("station_availability").read(spark).first()
    assert stored["snapshot_timestamp"] == datetime(2026, 2, 26, 14)


def odd_lake(spark, tmp_path):
    """Two files of an hour that disagree about the types of a contract column and another, one that lacks both, and a broken one."""
    lake = tmp_path / "lake"
    folder = lake / "ingestion_date=2026-02-26" / "hour=14"
    folder.mkdir(parents=True)
    rows = bronze(spark, {}, {"stationcode": "2"}).toPandas()
    rows.assign(x=[1, 2]).to_parquet(folder / "snapshot_20260226_140000.parquet", index=False)
    rows.assign(x=["a", "b"], capacity=["20", "21"]).to_parquet(folder / "snapshot_20260226_140100.parquet", index=False)
    rows.drop(columns="capacity").to_parquet(folder / "snapshot_20260226_140200.parquet", index=False)
    (folder / "snapshot_20260226_140300.parquet").write_bytes(b"PAR1 broken PAR1")
    return lake


def test_files_of_different_types_have_their_own_verdict(spark, tmp_path):
    lake = odd_lake(spark, tmp_path)
    found = {r["path"][-14:-8]: (r["valid"], r["rows"]) for r in validate_parquet_files(spark, str(lake)).collect()}
    assert found == {"140000": (True, 2), "140100": (True, 2), "140200": (True, 2), "140300": (False, 0)}
    schemas = {r["path"][-14:-8]: r["schema"] for r in files.footer_schemas(spark, str(lake)).collect()}
    assert schemas["140300"] is None and len(set(schemas.values())) == 4
    assert sorted(len(paths) for _, paths in files.schema_groups(spark, str(lake))) == [1, 2]
    damaged = lake / "ingestion_date=2026-02-26" / "hour=14" / "snapshot_20260226_140100.parquet"
    data = bytearray(damaged.read_bytes())
    data[4:120] = b"\xff" * 116
    damaged.write_bytes(bytes(data))
    assert [r["path"][-14:-8] for r in validate_parquet_files(spark, str(lake)).where("not valid").orderBy("path").collect()] == ["140100", "140300"]


def test_long_files_are_asked_one_by_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FOOTER_BYTES", 10)
    assert validate_parquet_files(spark, str(odd_lake(spark, tmp_path))).where("valid").count() == 3


def test_cleanup_of_files_of_different_types(spark, tmp_path):
    lake = odd_lake(spark, tmp_path)
    assert cleanup.clean(spark, str(lake), dry_run=False) == cleanup.CleanupResult(1, 0, 1, 6)
    stored = spark.read.parquet(str(lake))
    assert dict(stored.dtypes)["capacity"] == "bigint" and dict(stored.dtypes)["x"] == "string"
    rows = sorted(((r["snapshot_id"], r["stationcode"], r["capacity"], r["x"]) for r in stored.collect()), key=str)
    stations = sorted(r["stationcode"] for r in bronze(spark, {}, {"stationcode": "2"}).collect())
    assert {r[1] for r in rows} == set(stations) and len(rows) == 6
    assert sorted({(r[2], r[3]) for r in rows}, key=str) == sorted([(20, "1"), (20, "2"), (20, "a"), (21, "b"), (None, None)], key=str)


def test_dry_run_stores_coordinates_only(spark, hour):
    """Of the rows only snapshot and station are read, and what is stored of them does not grow with their columns."""
    lake = str(hour.parent.parent)
    groups = files.readable_rows(spark, [lake], basePath=lake)
    found = cleanup.coordinates(groups, validate_parquet_files(spark, lake))
    assert set(found.columns) == {
        "ingestion_date", "hour", "snapshot_id", "stationcode", "file", "row_index", "odd", "unit", "minute_first",
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    read = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    judged = [r for r in read if "row_index" in r]
    assert judged and not any("capacity" in r or "name" in r for r in judged)


def test_cleanup_drops_an_hour_of_broken_files(spark, tmp_path):
    lake = odd_lake(spark, tmp_path)
    other = lake / "ingestion_date=2026-02-26" / "hour=15"
    other.mkdir()
    (other / "snapshot_20260226_150000.parquet").write_bytes(b"broken")
    found = cleanup.clean(spark, str(lake))
    assert (found.corrupted_files, found.rewritten_partitions) == (2, 2) and other.exists()
    assert cleanup.clean(spark, str(lake), dry_run=False) == found
    assert not other.exists() and spark.read.parquet(str(lake)).count() == 6


def test_cleanup_judges_rows_once(spark, tmp_path, monkeypatch):
    names = []

    def staged(df, name, own=cleanup.staged_for_use):
        names.append(name)
        return own(df, name)

    monkeypatch.setattr(cleanup, "staged_for_use", staged)
    cleanup.clean(spark, str(odd_lake(spark, tmp_path)))
    assert names.count("cleanup-judged") == 1
