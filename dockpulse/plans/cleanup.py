"""Clean Bronze partitions, then load them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.config import Warehouse
from dockpulse.operators.hygiene import first_of_minute
from dockpulse.operators.loading import matching
from dockpulse.plans import silver
from dockpulse.schemas import BRONZE, BRONZE_LAKE, BRONZE_PARTITIONS
from dockpulse.session import hadoop_path, path_exists, staged_for_use
from dockpulse.sources.files import readable_rows, validate_parquet_files
from dockpulse.sources.landing import apply_type_contract

PARTITION = ("ingestion_date", "hour")


@dataclass(frozen=True)
class CleanupResult:
    corrupted_files: int
    duplicate_rows: int
    rewritten_partitions: int
    remaining_rows: int


def clean(
    spark: SparkSession, lake: str, date: str | None = None, hour: int | None = None, dry_run: bool = True
) -> CleanupResult:
    """Find (and with ``dry_run=False`` remove) unreadable files and repeated snapshots of an hour, a day or the whole lake.

    Of each minute the first snapshot stays, whether a file is named by its time or holds rows of many ``snapshot_id``s,
    and of each station one row of it.  Rows are judged by where they lie: only file, row number, snapshot and station are
    stored for that.  Partitions with something to remove, or with a file whose types are not the contract's, are written
    anew from what stays: their rows alone are read whole, and swapped in by Spark's own dynamic overwrite.  Raises before
    writing anything when no row would remain, or when not every readable row was read.  Extra columns of the feed stay; where
    files disagree about the type of one, it becomes text.
    """
    folder = lake if date is None else f"{lake}/ingestion_date={date}"
    if hour is not None:
        folder += f"/hour={int(hour):02d}"
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"no partition at {folder}")
    parts = F.regexp_extract_all(F.col("path"), F.lit(r"(ingestion_date|hour)=([^/]+)"), F.lit(2))
    places = {"ingestion_date": F.get(parts, F.lit(0)).try_cast("date"), "hour": F.get(parts, F.lit(1)).try_cast("int")}
    with staged_for_use(validate_parquet_files(spark, folder).withColumns(places), "file-validation") as files:
        if not files.where("valid").limit(1).count():
            raise ValueError(f"no valid Parquet file would remain in {folder}")
        groups = readable_rows(spark, [folder], basePath=lake)
        with (
            staged_for_use(coordinates(groups, files), "cleanup-coordinates") as rows,
            staged_for_use(_judged(rows), "cleanup-judged") as judged,
        ):
            touched = judged.where(~F.col("kept") | F.col("odd")).select(*PARTITION)
            touched = touched.unionByName(files.where("NOT valid").select(*PARTITION))
            with staged_for_use(touched.distinct(), "cleanup-partitions") as touched:
                counts = judged.agg(F.count_if(~F.col("kept")).alias("gone"), F.count_if("kept").alias("kept")).first()
                corrupted = files.agg(F.count_if(~F.col("valid"))).first()[0]
                result = CleanupResult(corrupted, counts["gone"], touched.count(), counts["kept"])
                promised = files.where("valid").agg(F.sum("rows")).first()[0]
                if promised != counts["gone"] + counts["kept"]:
                    raise RuntimeError(f"{promised} rows are readable, but {counts['gone'] + counts['kept']} were read")
                if not dry_run and result.rewritten_partitions:
                    _rewrite(groups, judged.where("kept"), touched, lake)
                    _drop_emptied(spark, judged.where("kept"), files.where("NOT valid"))
    return result


def coordinates(groups: Sequence[DataFrame], files: DataFrame) -> DataFrame:
    """Where each row of the valid files lies, with its snapshot, its station, and whether its snapshot is the first of its minute.

    ``odd`` says that the row's file does not have the contract's types.
    """
    contract = {f.name: f.dataType for f in BRONZE}

    def of_group(rows: DataFrame) -> DataFrame:
        texts = [(F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(c) for c in ("snapshot_id", "stationcode")]
        places = [F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_PARTITIONS]
        odd = any(contract.get(f.name, f.dataType) != f.dataType for f in rows.schema)
        spot = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index")]
        return rows.select(*places, *texts, *spot, F.lit(odd).alias("odd"))

    rows = reduce(DataFrame.union, map(of_group, groups))
    valid = files.where("valid").select(_local(F.col("path")).alias("_valid"))
    rows = rows.join(valid, _local(F.col("file")) == F.col("_valid"), "left_semi")
    return first_of_minute(rows, *PARTITION)


def _local(path: Column) -> Column:
    """The two spellings of local paths, ``file:/x`` and ``file:///x``, as one."""
    return F.regexp_replace(path, "^file:/+", "/")


def _judged(rows: DataFrame) -> DataFrame:
    """Coordinates with ``kept``: those of a minute's first snapshot, one for each station."""
    spot = ("file", "row_index")
    first = rows.where("minute_first AND unit IS NOT NULL AND stationcode IS NOT NULL")
    first = first.groupBy(*PARTITION, "unit", "snapshot_id", "stationcode").agg(F.min(F.struct(*spot)).alias("_one"))
    marked = rows.join(first.select("_one.*", F.lit(True).alias("_first")), list(spot), "left")
    loose = F.col("unit").isNull() | F.col("stationcode").isNull()
    return marked.withColumn("kept", F.col("minute_first") & (loose | F.col("_first").isNotNull())).drop("_first")


def _whole_rows(groups: Sequence[DataFrame], touched: DataFrame) -> DataFrame:
    """Rows of the touched partitions under the contract's types, with where they lie."""
    named = touched.select(*[F.col(c).alias(f"_{c}") for c in PARTITION])
    extra: dict[str, set] = {}
    for rows in groups:
        for field in rows.schema:
            if field.name not in BRONZE_LAKE.fieldNames():
                extra.setdefault(field.name, set()).add(field.dataType.simpleString())
    disputed = [name for name, kinds in extra.items() if len(kinds) > 1]

    def of_group(rows: DataFrame) -> DataFrame:
        typed = apply_type_contract(rows.withColumns({c: F.col(c).cast("string") for c in disputed if c in rows.columns}))
        contract = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in BRONZE.fields
        ]
        places = [F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_PARTITIONS]
        own = [F.col(f"`{c}`") for c in extra if c in rows.columns]
        spot = [F.col("_file").alias("file"), F.col("_row_index").alias("row_index")]
        same = F.lit(True)
        for key in PARTITION:
            same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
        return typed.select(*contract, *own, *places, *spot).join(named, same, "left_semi")

    located = [
        rows.withColumns({"_file": F.col("_metadata.file_path"), "_row_index": F.col("_metadata.row_index")}) for rows in groups
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(of_group, located))


def _rewrite(groups: Sequence[DataFrame], kept: DataFrame, touched: DataFrame, lake: str) -> None:
    spot = ["file", "row_index"]
    named = kept.select(*spot, F.col("snapshot_id").alias("_snapshot_id"))
    rows = _whole_rows(groups, touched).join(named, spot).withColumn("snapshot_id", F.col("_snapshot_id"))
    with staged_for_use(rows.drop(*spot, "_snapshot_id"), "cleanup-rows") as rows:
        arranged = (
            rows.withColumn("hour", F.lpad(F.col("hour").cast("string"), 2, "0"))
            .hint("rebalance", *PARTITION)
            .sortWithinPartitions(*PARTITION, "stationcode")
        )
        writer = arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*PARTITION).parquet(lake)


def _drop_emptied(spark: SparkSession, kept: DataFrame, broken: DataFrame) -> None:
    """Delete the folders of partitions that hold unreadable files alone: an overwrite without a row for them leaves them as they are."""
    left = matching(broken, kept, "left_anti", *PARTITION).select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()
    for row in left.collect():
        system, target = hadoop_path(spark, row["folder"])
        system.delete(target, True)


def run(
    spark: SparkSession, warehouse: Warehouse, lake: str, date: str | None = None, hour: int | None = None
) -> tuple[CleanupResult, silver.SilverRun]:
    """Clean an hour, a day or the whole lake for good and load it into Silver."""
    cleaned = clean(spark, lake, date, hour, dry_run=False)
    return cleaned, silver.run(spark, warehouse, lake, date, hour)
