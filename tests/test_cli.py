"""Every job of the command line, with arguments."""

import pytest
from helpers import bronze

from dockpulse import cli
from dockpulse.sinks.writers import write_bronze
from dockpulse.sources.landing import with_bronze_partitions


def call(spark, *argv):
    return cli.run(spark, cli.parser().parse_args(argv))


def test_jobs(spark, tmp_path):
    lake, warehouse = str(tmp_path / "lake"), str(tmp_path / "warehouse")
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text('[{"stationcode":"9","name":"N","capacity":20,"numbikesavailable":5,"numdocksavailable":15}]')
    write_bronze(with_bronze_partitions(bronze(spark, {}, {"ingestion_timestamp": "2026-02-27T09:00:00+01:00", "snapshot_id": "20260227_090000"})), lake)
    assert call(spark, "ingest", str(landing), "--bronze", lake, "--instant", "2026-02-28T09:00:00+01:00") == 1
    loaded = call(spark, "silver", "2026-02-26", "14", "--bronze", lake, "--warehouse", warehouse)
    assert loaded.facts.rows_written == 1
    call(spark, "gold", "--warehouse", warehouse, "--full")
    dry = call(spark, "backfill", "--bronze", lake, "--warehouse", warehouse, "--from", "2026-02-27", "--dry-run")
    assert dry.pending == ["2026-02-27", "2026-02-28"] and not dry.loaded
    done = call(spark, "backfill", "--bronze", lake, "--warehouse", warehouse, "--to", "2026-02-27", "--skip-gold")
    assert list(done.loaded) == ["2026-02-27"] and not done.gold_built
    call(spark, "gold", "--warehouse", warehouse, "--days", "2026-02-27")
    assert call(spark, "cleanup", "--bronze", lake, "--dry-run").remaining_rows == 3
    report = call(spark, "quality", "--bronze", lake, "--reports", str(tmp_path / "reports"), "--gate", "0")
    assert report["tests_passed"] + report["tests_failed"] == 6
    boundaries = tmp_path / "districts.json"
    boundaries.write_text('{"features":[{"properties":{"c_ar":1,"geom_x_y":{"lon":2.3,"lat":48.8}},"geometry":{"type":"Polygon","coordinates":[[[2,48],[3,48],[3,49],[2,49]]]}}]}')
    assert call(spark, "enrich", str(boundaries), "--warehouse", warehouse)["to_update"] == 1


@pytest.mark.parametrize(
    "argv",
    [
        ["silver", "--bronze", "/b", "--warehouse", "/w"],
        ["silver", "26-02-2026", "--bronze", "/b", "--warehouse", "/w"],
        ["silver", "2026-02-26", "24", "--bronze", "/b", "--warehouse", "/w"],
        ["gold"],
        ["gold", "--target", "catalog", "--set", "silver_schema=s"],
        ["backfill", "--warehouse", "/w"],
        ["unknown"],
    ],
)
def test_wrong_calls_end_before_spark_starts(argv, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda *_: pytest.fail("started"))
    with pytest.raises(SystemExit):
        cli.main(argv)
