from datetime import datetime

import pytest
from helpers import bronze
from pyspark.sql import functions as F

from dockpulse.config import Warehouse, parquet_warehouse, resolve_schema
from dockpulse.operators import loading
from dockpulse.plans import backfill, enrich, gold, ingest, silver
from dockpulse.sinks import writers
from dockpulse.sources import bronze as lake_source
from dockpulse.sources import jdbc, landing
from dockpulse.session import child_folders
from dockpulse.sources.tables import StoredTable, scan_table, scan_window, window_options

HOURS = [f"2026-02-{day}T{hour:02d}:{minute:02d}:00+01:00" for day in (25, 26, 27) for hour in (8, 9) for minute in (0, 30)]


def network(spark, extra=()):
    changes = [
        {
            "stationcode": code,
            "name": f"S{code}",
            "numbikesavailable": (i * 3) % 21,
            "numdocksavailable": 20 - (i * 3) % 21,
            "ingestion_timestamp": at,
            "snapshot_id": at[:19].replace("-", "").replace(":", "").replace("T", "_"),
        }
        for code in ("1", "2")
        for i, at in enumerate(HOURS)
    ]
    return landing.with_bronze_partitions(bronze(spark, *changes, *extra))


@pytest.fixture
def lake(spark, folder):
    path = f"{folder}/lake"
    writers.write_bronze(network(spark), path)
    return path


@pytest.fixture
def warehouse(folder):
    return parquet_warehouse(f"{folder}/warehouse")


def table_rows(spark, warehouse, name):
    return sorted(map(tuple, warehouse.table(name).read(spark).drop("built_at").collect()), key=repr)


def test_lake_layout(spark, lake, tmp_path):
    folders = sorted(str(p.relative_to(tmp_path / "lake")) for p in (tmp_path / "lake").glob("*/*"))
    assert folders[0] == "ingestion_date=2026-02-25/hour=08" and len(folders) == 6
    assert lake_source.scan_bronze(spark, lake).count() == 24
    assert lake_source.scan_bronze(spark, lake, "2026-02-26").count() == 8
    assert lake_source.scan_bronze(spark, lake, "2026-02-26", "08").count() == 4
    assert lake_source.require_partition(spark, lake, "2026-02-26", "08") >= 1
    with pytest.raises(FileNotFoundError):
        lake_source.require_partition(spark, lake, "2026-02-26", 7)
    with pytest.raises(FileNotFoundError):
        lake_source.require_partition(spark, lake + "-none", "2026-02-26", 7)


def test_silver_is_idempotent(spark, lake, warehouse):
    first = silver.run(spark, warehouse, lake, "2026-02-26", 8)
    assert (first.rows_read, first.facts.rows_written, first.stations.rows_written) == (4, 4, 2)
    again = silver.run(spark, warehouse, lake, "2026-02-26", 8)
    assert (again.facts.rows_written, again.duplicates_skipped, again.stations.rows_written) == (0, 4, 0)
    whole = silver.run(spark, warehouse, lake)
    assert (whole.facts.rows_written, whole.duplicates_skipped) == (20, 4)
    assert silver.validate(spark, warehouse, "2026-02-26", 8)["total_rows"] == 4
    with pytest.raises(ValueError):
        silver.validate(spark, warehouse, "2026-02-26", 11)
    counts, hours = silver.summary(spark, warehouse, 2)
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {"stations": 2, "station_availability": 24}
    assert [r["snapshot_hour"] for r in hours.collect()] == [datetime(2026, 2, 27, 9), datetime(2026, 2, 27, 8)]


def test_batch_without_valid_rows(spark, warehouse):
    rows = bronze(spark, {"capacity": 0})
    run = silver.load_silver(spark, rows, warehouse)
    assert (run.rows_read, run.rows_rejected, run.facts.rows_written) == (1, 1, 0)


def test_known_stations_are_left_alone(spark, warehouse):
    silver.load_silver(spark, bronze(spark, {}), warehouse)
    silver.load_silver(spark, bronze(spark, {"name": "renamed", "ingestion_timestamp": "2026-02-27T14:00:00+01:00"}), warehouse)
    row = warehouse.table("stations").read(spark).first()
    assert (row["station_name"], row["last_seen_at"]) == ("Old Mill", datetime(2026, 2, 26, 14))


def test_gold_incremental_equals_full(spark, lake, folder):
    partial, full = parquet_warehouse(f"{folder}/partial"), parquet_warehouse(f"{folder}/full")
    silver.run(spark, partial, lake, "2026-02-25")
    gold.run(spark, partial)
    silver.run(spark, partial, lake)
    gold.run(spark, partial)
    silver.run(spark, full, lake)
    gold.run(spark, full, incremental=False)
    for name in ("fact_hourly_availability", "fact_daily_station_stats", "mart_station_performance", "mart_peak_hours_by_district"):
        assert table_rows(spark, partial, name) == table_rows(spark, full, name), name
    results = {r["test_name"]: r["violations"] for r in gold.check_results(spark, full).collect()}
    assert len(results) == 30 and not any(results.values())


def test_catalog_tables(spark, lake):
    """The same jobs with tables in the session catalog."""
    for schema in ("silver_t", "gold_t"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    warehouse = Warehouse("catalog", {"silver_schema": "silver_t", "gold_schema": "gold_t"})
    assert scan_table(spark, warehouse.table("stations")) is None
    for date in ("2026-02-25", "2026-02-26", None):
        run = silver.run(spark, warehouse, lake, date)
        gold.run(spark, warehouse)
    assert (run.facts.rows_written, run.duplicates_skipped) == (8, 16)
    assert spark.table("silver_t.station_availability").count() == 24
    assert spark.table("gold_t.fact_hourly_availability").count() == 12
    assert spark.table("gold_t.fact_daily_station_stats").agg(F.sum("total_snapshots")).first()[0] == 24
    assert not any(r["violations"] for r in gold.check_results(spark, warehouse).collect())


def test_replace_by_key_and_by_day(spark, warehouse):
    table = StoredTable("parquet", f"{warehouse.settings['root']}/t", None, {}, ("snapshot_date",), ("k",))
    old = spark.sql("SELECT * FROM VALUES ('a', 1, DATE '2026-03-01'), ('gone', 1, DATE '2026-03-02'), ('b', 1, DATE '2026-03-02') t(k, v, snapshot_date)")
    new = spark.sql("SELECT * FROM VALUES ('b', 2, DATE '2026-03-02'), ('c', 2, DATE '2026-03-03') t(k, v, snapshot_date)")
    writers.incremental_replace(spark, old, table, "k", "snapshot_date")
    writers.incremental_replace(spark, new, table, "k", "snapshot_date")
    assert sorted((r["k"], r["v"]) for r in table.read(spark).collect()) == [("a", 1), ("b", 2), ("c", 2), ("gone", 1)]
    writers.incremental_replace(spark, new, table, "k", "snapshot_date", replace_days=True)
    assert sorted((r["k"], r["v"]) for r in table.read(spark).collect()) == [("a", 1), ("b", 2), ("c", 2)]
    writers.incremental_replace(spark, new.where("v > 5"), table, "k", "snapshot_date")
    assert table.read(spark).count() == 3


def test_backfill(spark, lake, warehouse):
    silver.run(spark, warehouse, lake, "2026-02-26")
    dry = backfill.run(spark, warehouse, lake)
    assert dry.pending == ["2026-02-25", "2026-02-27"] and not dry.loaded
    assert backfill.run(spark, warehouse, lake, end="2026-02-25").pending == ["2026-02-25"]
    done = backfill.run(spark, warehouse, lake, apply=True)
    assert sorted(done.loaded) == dry.pending and done.gold_built
    assert backfill.run(spark, warehouse, lake).pending == []


def test_backfill_completes_gold_and_skips_unreadable_and_invalid_days(spark, folder, warehouse):
    path = f"{folder}/lake"
    extra = (
        {"ingestion_timestamp": "soon"},
        {"capacity": 0, "ingestion_timestamp": "2026-02-20T08:00:00+01:00", "snapshot_id": "20260220_080000"},
    )
    writers.write_bronze(network(spark, extra), path)
    silver.run(spark, warehouse, path, "2026-02-27")
    gold.run(spark, warehouse)
    done = backfill.run(spark, warehouse, path, apply=True)
    assert done.pending == ["2026-02-20", "2026-02-25", "2026-02-26"] and not done.failed and done.gold_built
    assert done.unreadable_rows == 1 and [str(d) for d in sorted(done.days)] == ["2026-02-25", "2026-02-26"]
    assert backfill.run(spark, warehouse, path).pending == []
    full = parquet_warehouse(f"{folder}/full")
    silver.run(spark, full, path)
    gold.run(spark, full, incremental=False)
    for name in ("fact_hourly_availability", "fact_daily_station_stats", "mart_station_performance", "mart_peak_hours_by_district"):
        assert table_rows(spark, warehouse, name) == table_rows(spark, full, name), name


def test_summary_reaches_over_gaps(spark, lake, warehouse):
    silver.run(spark, warehouse, lake)
    assert silver.summary(spark, warehouse, 100)[1].count() == 6
    assert silver.summary(spark, warehouse, 3)[1].count() == 3


def test_gold_refuses_targets_of_other_servers(spark):
    target = Warehouse("jdbc", {"url": "jdbc:postgresql://h/db", "user": "u", "password": "p"})
    for job in (lambda: gold.run(spark, target), lambda: backfill.run(spark, target, "/none", apply=True)):
        with pytest.raises(ValueError, match="its own server"):
            job()


def test_backfill_isolates_failures_and_skips_gold(spark, lake, warehouse, monkeypatch):
    real = backfill.load_silver
    calls = []

    def flaky(*args):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(backfill, "load_silver", flaky)
    result = backfill.run(spark, warehouse, lake, apply=True)
    assert list(result.failed) == ["2026-02-25"] and len(result.loaded) == 2 and not result.gold_built


def test_enrichment_job(spark, warehouse):
    silver.load_silver(spark, bronze(spark, {"lon": 0.5, "lat": 0.5}, {"stationcode": "9", "nom_arrondissement_communes": "Vincennes"}), warehouse)
    square = [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]]
    boundaries = spark.createDataFrame(
        [(7, "Paris 7e Arrondissement", square, 0.5, 0.5)],
        "arr_number int, label string, polygons array<array<array<array<double>>>>, centroid_lon double, centroid_lat double",
    )
    dry = enrich.run(spark, warehouse, boundaries, dry_run=True)
    assert (dry.checked, dry.to_update) == (1, 1)
    before = {r["station_id"]: r["updated_at"] for r in warehouse.table("stations").read(spark).collect()}
    done = enrich.run(spark, warehouse, boundaries)
    assert [tuple(r) for r in done.summary.collect()] == [("Paris 7e Arrondissement", 1)]
    after = {r["station_id"]: r["updated_at"] for r in warehouse.table("stations").read(spark).collect()}
    assert after["501"] > before["501"] and after["9"] == before["9"]
    assert enrich.run(spark, warehouse, boundaries).to_update == 0


def test_update_attribute_ignores_equal_and_missing_values(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', 'x', TIMESTAMP_NTZ '2026-01-01'), ('b', NULL, TIMESTAMP_NTZ '2026-01-01') t(station_id, district_municipality_names, updated_at)")
    updates = spark.createDataFrame([("a", "x"), ("b", "y")], "station_id string, district_municipality_names string")
    now = F.lit("2027-01-01").cast("timestamp_ntz")
    got = {r["station_id"]: (r["district_municipality_names"], r["updated_at"].year) for r in loading.update_attribute(rows, updates, now=now).collect()}
    assert got == {"a": ("x", 2026), "b": ("y", 2027)}


PAYLOAD = '{"stationcode":"1","name":"A","capacity":20,"numbikesavailable":5,"coordonnees_geo":{"lon":2.3,"lat":48.8}}'


def test_payload_forms(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "list.json").write_text(f"\n [{PAYLOAD},\n {PAYLOAD}]")
    (folder / "object.json").write_text('{"total_count":1,"results":[' + PAYLOAD + "]}")
    (folder / "empty.json").write_text('{"results":[]}')
    rows = landing.scan_snapshot_json(spark, str(folder))
    assert rows.count() == 3
    flat = landing.flatten_geo(rows).select("lon", "lat").distinct().collect()
    assert [tuple(r) for r in flat] == [(2.3, 48.8)]
    lake = str(tmp_path / "lake")
    assert ingest.run(spark, str(folder), lake, F.lit("2026-07-01T10:00:00Z").cast("timestamp")) == 3
    row = lake_source.scan_bronze(spark, lake, "2026-07-01", 12).first()
    assert (row["ingestion_timestamp"], row["snapshot_id"]) == ("2026-07-01T12:00:00.000000+02:00", "20260701_120000")


def test_loose_numbers_and_extra_columns(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.json").write_text(
        '[{"stationcode":1,"capacity":12.0,"numbikesavailable":"7","ebike":" 3 ","mechanical":2.5,"coordonnees_geo":{"lon":"2.5","lat":48},"new":true,"deep":{"x":1}},'
        '{"stationcode":"2","capacity":"many","coordonnees_geo":"none"}]'
    )
    one, two = landing.flatten_geo(landing.scan_snapshot_json(spark, str(folder))).orderBy("stationcode").collect()
    assert (one["stationcode"], one["capacity"], one["numbikesavailable"], one["ebike"], one["mechanical"]) == ("1", 12, 7, 3, None)
    assert (one["lon"], one["lat"], one["new"], one["deep"]) == (2.5, 48.0, "true", '{"x":1}')
    assert (two["capacity"], two["lon"], two["new"]) == (None, None, None)


def test_ingest_refuses_an_empty_feed(spark, tmp_path):
    (tmp_path / "empty.json").write_text("[]")
    with pytest.raises(ValueError):
        ingest.run(spark, str(tmp_path), str(tmp_path / "lake"), F.current_timestamp())


def test_type_contract(spark):
    rows = spark.createDataFrame([("x1", "12", "bad", "extra")], "stationcode string, capacity string, lon string, other string")
    typed = landing.apply_type_contract(rows)
    assert dict(typed.dtypes) == {"stationcode": "string", "capacity": "bigint", "lon": "double", "other": "string"}
    assert tuple(typed.first()) == ("x1", 12, None, "extra")
    odd = landing.flatten_geo(spark.createDataFrame([("text",)], "coordonnees_geo string"))
    assert tuple(odd.first()) == (None, None)


def test_mirror_is_incremental(spark, lake, folder):
    writers.mirror_partitions(spark, lake, f"{folder}/mirror")
    writers.mirror_partitions(spark, lake, f"{folder}/mirror")
    assert lake_source.scan_bronze(spark, f"{folder}/mirror").count() == 24


def test_targets_fail_fast():
    with pytest.raises(ValueError, match="unknown target"):
        Warehouse("somewhere", {})
    with pytest.raises(ValueError, match="gold_schema, temporary_bucket"):
        Warehouse("bigquery", {"project": "p", "silver_schema": "s"})
    with pytest.raises(ValueError, match="root"):
        Warehouse("parquet", {"root": " "})
    table = Warehouse("bigquery", {"project": "p", "silver_schema": "s", "gold_schema": "g", "temporary_bucket": "b"}).table("station_availability")
    assert table.location == "p.s.station_availability"
    assert table.options["partitionType"] == "DAY" and table.options["clusteredFields"] == "station_id"
    assert Warehouse("jdbc", {"url": "jdbc:postgresql://h/db", "user": "u", "password": "p"}).table("stations").location == "silver.stations"


def test_schema_names():
    assert resolve_schema("gold", "staging ", split=True) == "gold_staging"
    assert resolve_schema("gold", None, split=True) == "gold"
    assert resolve_schema("gold", "staging", split=False) == "gold"
    split = Warehouse("catalog", {"schema": "dev", "silver_schema": "silver", "gold_schema": "gold"})
    assert split.table("stations").location == "dev_silver.stations"
    assert split.table("dim_stations").location == "dev_gold.dim_stations"


def test_jdbc_reads_are_bounded_and_split():
    source = jdbc.JdbcSource("jdbc:postgresql://h:5432/db", "u", "secret")
    assert "secret" not in repr(source)
    query = jdbc.window_query("silver.t", ["a", "b"], "ts", datetime(2026, 1, 1), datetime(2026, 1, 2, 3))
    assert query == "SELECT a, b FROM silver.t WHERE ts >= TIMESTAMP '2026-01-01 00:00:00.000000' AND ts <= TIMESTAMP '2026-01-02 03:00:00.000000'"
    options = jdbc.table_options(source, "silver.t", "ts", "2026-01-01", "2026-01-02", 8)
    assert (options["numPartitions"], options["partitionColumn"], options["driver"]) == ("8", "ts", "org.postgresql.Driver")
    assert "partitionColumn" not in jdbc.table_options(source, "silver.t")
    with pytest.raises(ValueError):
        jdbc.table_options(source, "silver.t", "ts")
    assert jdbc.quote_literal("L'Haÿ") == "'L''Haÿ'"


def test_stored_keys_are_read_inside_the_batch_window(spark, folder):
    """A database evaluates the window itself; a stored table is pruned by day."""
    table = Warehouse("jdbc", {"url": "jdbc:postgresql://h/db", "user": "u", "password": "p"}).table("station_availability")
    options = window_options(table, ["station_id"], "snapshot_timestamp", datetime(2026, 1, 1), datetime(2026, 1, 2))
    assert options["dbtable"].startswith("(SELECT station_id FROM silver.station_availability WHERE snapshot_timestamp >= ")
    assert (options["partitionColumn"], options["numPartitions"], options["user"]) == ("snapshot_timestamp", "8", "u")
    stored = parquet_warehouse(folder)
    silver.load_silver(spark, network(spark), stored)
    keys = scan_window(
        spark,
        stored.table("station_availability"),
        ["station_id", "snapshot_timestamp"],
        "snapshot_timestamp",
        datetime(2026, 2, 26, 8, 30),
        datetime(2026, 2, 26, 9),
    )
    assert keys.count() == 4
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_date#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_refresh_may_read_its_own_table(spark, folder):
    table = parquet_warehouse(folder).table("dim_stations")
    writers.materialize_full(spark.range(5).selectExpr("cast(id as string) station_id"), table)
    writers.materialize_full(table.read(spark).where("station_id > 2"), table)
    assert sorted(r[0] for r in table.read(spark).collect()) == ["3", "4"]
    assert child_folders(spark, f"{folder}/gold", "*") == ["dim_stations"]


def test_missing_table_reads_as_none(spark, folder):
    assert scan_table(spark, StoredTable("parquet", f"{folder}/none")) is None
    assert scan_table(spark, StoredTable("catalog", "default.never_created")) is None


FAULTS = {
    "not json": "no JSON", '[{"stationcode":"1"': "no JSON", '{"results":[{"stationcode":"1"}': "no JSON", "[1, 2]": "no stations", "[null]": "no stations",
    '{"error":"x"}': "no results", '{"results":null}': "no results", '{"results":5}': "no stations", "12": "neither list nor object",
    '"text"': "neither list nor object", " \t ": "empty", "": "empty",
}
SOUND = {f"[{PAYLOAD}]": 1, f'  {{"results":[{PAYLOAD},{PAYLOAD}]}}': 2, "[]": 0, '{"results":[]}': 0, f"[{PAYLOAD},null]": 1}


def test_every_payload_is_read_or_set_aside(spark):
    payloads = spark.createDataFrame([(i, v) for i, v in enumerate([*FAULTS, *SOUND, None])], "id int, value string")
    aside = {r["value"]: r["reason"] for r in landing.quarantined(payloads).collect()}
    assert aside == FAULTS | {None: "empty"}
    counts = {r["id"]: r["count"] for r in landing.explode_payloads(payloads).groupBy("id").count().collect()}
    assert counts == {len(FAULTS) + i: n for i, n in enumerate(SOUND.values()) if n}


def test_ingest_sets_broken_payloads_aside(spark, tmp_path):
    folder, lake, aside = tmp_path / "landing", str(tmp_path / "lake"), str(tmp_path / "aside")
    folder.mkdir()
    (folder / "good.json").write_text(f"[{PAYLOAD}]")
    for i, text in enumerate(FAULTS):
        (folder / f"bad{i}.json").write_text(text)
    instant = F.lit("2026-07-01T10:00:00Z").cast("timestamp")
    with pytest.raises(ingest.PayloadError, match="no results"):
        ingest.run(spark, str(folder), lake, instant)
    assert not (tmp_path / "lake").exists()
    assert ingest.run(spark, str(folder), lake, instant, quarantine=aside) == 1
    stored = spark.read.parquet(aside).collect()
    names = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in stored}
    # Spark's text reader gives no row for a file without a byte.
    assert names == {f"bad{i}.json": reason for i, (text, reason) in enumerate(FAULTS.items()) if text}
    assert all(r["block_start"] == 0 for r in stored)


def test_balanced_splits_cover_every_row_once(spark):
    """Half of the rows lie in one minute of a week, some have no time."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 40 == 0, None)
        .when(F.col("id") % 2 == 0, F.expr("TIMESTAMP_NTZ '2026-02-03 08:00:00' + make_interval(0, 0, 0, 0, 0, 0, (id % 60) + 0.25)"))
        .otherwise(F.expr("TIMESTAMP_NTZ '2026-02-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 150)"))
        .alias("ts")
    )
    bounds = jdbc.split_bounds(rows, "ts", 8)
    parts = jdbc.split_predicates("ts", bounds)
    assert bounds == sorted(set(bounds)) and len(parts) == len(bounds) + 1 == 8
    marked = rows.select(*[F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{i}") for i, p in enumerate(parts)]).cache()
    assert marked.where(" + ".join(marked.columns) + " <> 1").count() == 0
    sizes = marked.agg(*[F.sum(c).alias(c) for c in marked.columns]).first()
    assert max(sizes) <= 1.35 * 4000 / 8
    same = spark.range(50).select(F.expr("TIMESTAMP_NTZ '2026-02-03 08:00:00'").alias("ts"))
    assert jdbc.split_predicates("ts", jdbc.split_bounds(same, "ts", 8)) == ["1 = 1"]
    assert jdbc.split_bounds(rows, "ts", 1) == [] == jdbc.split_bounds(rows.where("false"), "ts", 8)


def test_new_days_are_written_without_a_look_at_stored_ones(spark, lake, warehouse, monkeypatch):
    """A backfill replaces rows of the days alone that Gold holds, and finds those by their folders."""
    silver.run(spark, warehouse, lake, "2026-02-27")
    gold.run(spark, warehouse)
    real_replace, real_by_key, replaced, targets = gold.incremental_replace, writers.replace_by_key, [], []

    def replace(session, batch, table, *keys, **options):
        replaced.append(sorted({str(r["snapshot_date"]) for r in batch.select("snapshot_date").collect()}))
        real_replace(session, batch, table, *keys, **options)

    def by_key(target, batch, *keys):
        targets.append(target._jdf.queryExecution().executedPlan().toString())
        return real_by_key(target, batch, *keys)

    monkeypatch.setattr(gold, "incremental_replace", replace)
    monkeypatch.setattr(writers, "replace_by_key", by_key)
    assert backfill.run(spark, warehouse, lake, apply=True).gold_built
    assert replaced == [["2026-02-27"]] * 2
    assert len(targets) == 2 and not any("Join" in t for t in targets)
    assert all("snapshot_date#" in t.split("PartitionFilters: [")[1].split("]")[0] for t in targets)
    assert table_rows(spark, warehouse, "fact_hourly_availability")
    monkeypatch.undo()
    full = parquet_warehouse(f"{warehouse.settings['root']}-full")
    silver.run(spark, full, lake)
    gold.run(spark, full)
    for name in ("fact_hourly_availability", "fact_daily_station_stats", "mart_station_performance", "mart_peak_hours_by_district"):
        assert table_rows(spark, warehouse, name) == table_rows(spark, full, name), name


def test_ranks_read_a_stored_summary(spark, lake, warehouse, monkeypatch):
    real, plans = gold.gold.with_station_ranks, []

    def ranks(summary):
        plans.append(summary._jdf.queryExecution().executedPlan().toString())
        return real(summary)

    monkeypatch.setattr(gold.gold, "with_station_ranks", ranks)
    silver.run(spark, warehouse, lake)
    gold.run(spark, warehouse)
    assert len(plans) == 1 and "Aggregate" not in plans[0]
    assert warehouse.table("mart_station_performance").read(spark).count() == 2
