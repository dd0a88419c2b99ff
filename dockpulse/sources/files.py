"""Choosing and checking snapshot files, whose schemas may differ."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.sources.bronze import list_files


# Files beyond this are not held by a task for their footer's sake; the driver asks Spark for their schemas one by one.
FOOTER_BYTES = 1 << 28


def _schema_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The schema that each footer holds, as text; NULL for what is no footer."""
    for batch in batches:
        texts = []
        for footer in batch.column("footer").to_pylist():
            try:
                whole = b"PAR1" + (footer or b"") + struct.pack("<I", len(footer or b"")) + b"PAR1"
                texts.append(pq.read_metadata(pa.BufferReader(whole)).schema.to_arrow_schema().remove_metadata().to_string())
            except (pa.ArrowException, OSError):
                texts.append(None)
        yield pa.record_batch({"path": batch.column("path"), "schema": pa.array(texts, pa.string())})


def footer_schemas(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, schema) of the files below the paths of up to ``FOOTER_BYTES``; only footers leave the tasks that read the files."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths))
        .where(F.col("length") <= FOOTER_BYTES)
    )
    size = F.length("content")
    tail = F.hex(F.substring("content", size - 7, F.lit(4)))
    count = F.conv(F.concat(*[F.substring(tail, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("int")
    sound = (size >= 12) & (count > 0) & (count <= size - 12)
    footer = F.when(sound, F.substring("content", size - 7 - count, count))
    return files.select("path", footer.alias("footer")).mapInArrow(_schema_texts, "path string, schema string")


def _agree(one: T.StructType, two: T.StructType) -> bool:
    types = {f.name: f.dataType for f in one}
    return all(types.get(f.name, f.dataType) == f.dataType for f in two)


def schema_groups(spark: SparkSession, *paths: str) -> list[tuple[T.StructType, list[str]]]:
    """Groups of files whose columns have one type each: the group's schema, and the paths of its files.

    Footers are read by tasks; of each different schema one file is opened by the driver.  What no footer describes is in no group.
    """
    found = footer_schemas(spark, *paths).where("schema IS NOT NULL").groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    kinds = [row["paths"] for row in found.orderBy("schema").collect()]
    kinds += [[row["path"]] for row in list_files(spark, *paths).where(F.col("length") > FOOTER_BYTES).orderBy("path").collect()]
    groups: list[tuple[T.StructType, list[str]]] = []
    for files in kinds:
        try:
            schema = spark.read.option("ignoreCorruptFiles", "true").parquet(files[0]).schema
        except AnalysisException:
            continue
        for i, (known, members) in enumerate(groups):
            if _agree(known, schema):
                more = [f for f in schema if f.name not in known.fieldNames()]
                groups[i] = (T.StructType(known.fields + more), members + files)
                break
        else:
            groups.append((schema, list(files)))
    return groups


def readable_rows(spark: SparkSession, paths: Sequence[str], **options: str) -> list[DataFrame]:
    """Rows of all files that Spark can read, skipping what it cannot: one frame where the files' schemas agree, else one a group.

    A column that is text in one file and a number in another has no common schema; such files are read apart, each under its
    own types, since under another's Spark would take a sound file for an unreadable one.
    """
    reader = spark.read.options(ignoreCorruptFiles="true", **options)
    try:
        return [reader.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").parquet(*paths)]
    except AnalysisException:  # no footer gives a schema
        return []
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    return [reader.schema(schema).parquet(*files) for schema, files in schema_groups(spark, *paths)]


def validate_parquet_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, modificationTime, length, rows, valid, error) of every file below the paths.

    Spark counts each file's rows twice: as the footers promise them, and while every column is decoded under the file's own types,
    with unreadable content skipped.  A file is valid when it has rows and both counts agree; a file without rows holds nothing to
    keep and does not count as valid.  Nothing but counts leaves the scans.
    """
    files = list_files(spark, *paths)
    groups = readable_rows(spark, paths, recursiveFileLookup="true")
    if not groups:
        nothing = {"rows": F.lit(0).cast("bigint"), "valid": F.lit(False), "error": F.lit("no readable rows")}
        return files.withColumns(nothing).drop("uri")
    uri = F.col("_metadata.file_path").alias("uri")

    def decoded_rows(rows: DataFrame) -> DataFrame:
        columns = [F.col(f"`{f.name}`") for f in rows.schema if not isinstance(f.dataType, T.MapType)]
        return rows.select(uri, F.xxhash64(*columns).alias("content"))

    promised = reduce(DataFrame.union, [rows.select(uri) for rows in groups]).groupBy("uri").agg(F.count(F.lit(1)).alias("promised"))
    decoded = reduce(DataFrame.union, map(decoded_rows, groups)).groupBy("uri")
    decoded = decoded.agg(F.count(F.lit(1)).alias("decoded"), F.bit_xor("content").alias("content"))
    counted = files.join(promised, "uri", "left").join(decoded, "uri", "left")
    valid = F.coalesce((F.col("promised") == F.col("decoded")) & F.col("content").isNotNull(), F.lit(False))
    read = F.format_string("%d of %d rows readable", F.coalesce("decoded", F.lit(0)), F.coalesce("promised", F.lit(0)))
    error = F.when(~valid, F.when(F.coalesce("promised", F.lit(0)) == 0, F.lit("no readable rows")).otherwise(read))
    found = F.coalesce("decoded", F.lit(0).cast("bigint")).alias("rows")
    return counted.select("path", "modificationTime", "length", found, valid.alias("valid"), error.alias("error"))


def newest_first(files: DataFrame) -> DataFrame:
    return files.orderBy(F.desc("modificationTime"), F.desc("path"))


def latest_readable_snapshot(spark: SparkSession, path: str, candidates: int = 16) -> str:
    """Path of the newest file that can be read completely.

    Only the newest files are read: ``candidates`` of them, and more as long as none of those is readable.
    """
    listed = newest_first(list_files(spark, path))
    skipped = 0
    while True:
        batch = [row["path"] for row in listed.offset(skipped).limit(candidates).collect()]
        if not batch:
            raise FileNotFoundError(f"no readable Parquet file below {path}")
        good = newest_first(validate_parquet_files(spark, *batch).where("valid")).first()
        if good is not None:
            return good["path"]
        skipped += len(batch)
        candidates *= 4
