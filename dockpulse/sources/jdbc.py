"""JDBC reads.  Nothing here opens a connection before an action runs."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcSource:
    """Connection of a warehouse."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"

    def properties(self) -> dict[str, str]:
        return {"user": self.user, "password": self.password, "driver": self.driver}


def quote_literal(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def table_options(
    source: JdbcSource,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a whole-table read, split into range queries when a column and bounds are given."""
    options = {"url": source.url, "dbtable": table, **source.properties()}
    if partition_column:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partitioned JDBC read needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(partitions),
        }
    return options


def window_query(table: str, columns: list[str], column: str, start: datetime, end: datetime) -> str:
    """Sub-query limited to a closed time window, evaluated by the database."""
    low, high = (quote_literal(t.strftime("%Y-%m-%d %H:%M:%S.%f")) for t in (start, end))
    return (
        f"SELECT {', '.join(columns)} FROM {table} "
        f"WHERE {column} >= TIMESTAMP {low} AND {column} <= TIMESTAMP {high}"
    )


def scan_jdbc(spark: SparkSession, source: JdbcSource, table: str, **split: object) -> DataFrame:
    return _reader(spark, table_options(source, table, **split)).load()


def scan_jdbc_pushdown(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    columns: list[str],
    column: str,
    start: datetime,
    end: datetime,
    partitions: int = 8,
) -> DataFrame:
    """Read only a time window, as ``partitions`` parallel range queries."""
    query = window_query(table, columns, column, start, end)
    options = table_options(source, f"({query}) AS bounded", column, str(start), str(end), partitions)
    return _reader(spark, options).load()


def _reader(spark: SparkSession, options: dict[str, str]) -> DataFrameReader:
    return spark.read.format("jdbc").options(**options)


# Rows of a batch that a split's bounds may be off by, in a thousandth of the batch.
BOUND_ERROR = 0.001


def split_bounds(batch: DataFrame, column: str, partitions: int) -> list[datetime]:
    """Ascending instants that cut the batch's rows into about equal parts; equal rows are never cut, so there may be fewer.

    They come from a quantile sketch, one pass and a few numbers to the driver.
    """
    micros = F.unix_micros(F.col(column).cast("timestamp"))
    shares = [i / partitions for i in range(1, partitions)]
    if not shares:
        return []
    found = batch.where(F.col(column).isNotNull()).agg(F.approx_percentile(micros, F.array(*map(F.lit, shares)), F.lit(int(1 / BOUND_ERROR))).alias("at"))
    cuts = sorted(set(found.first()["at"] or []))
    lowest = batch.agg(F.min(micros)).first()[0]
    stamps = batch.sparkSession.createDataFrame([(c,) for c in cuts if c > lowest], "micros bigint").orderBy("micros")
    # The session's zone, in which the column was read, also spells the bounds.
    return [row[0] for row in stamps.select(F.timestamp_micros("micros").cast("timestamp_ntz")).collect()]


def split_predicates(column: str, bounds: list[datetime]) -> list[str]:
    """Conditions, one a partition: each row of the table fits exactly one of them, rows without a time the first."""
    stamps = [quote_literal(t.strftime("%Y-%m-%d %H:%M:%S.%f")) for t in bounds]
    if not stamps:
        return ["1 = 1"]
    out = [f"{column} < TIMESTAMP {stamps[0]} OR {column} IS NULL"]
    out += [f"{column} >= TIMESTAMP {low} AND {column} < TIMESTAMP {high}" for low, high in zip(stamps, stamps[1:], strict=False)]
    return [*out, f"{column} >= TIMESTAMP {stamps[-1]}"]


def scan_jdbc_balanced(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    columns: list[str],
    column: str,
    batch: DataFrame,
    partitions: int = 8,
) -> DataFrame:
    """The time window of ``batch`` in parts that hold about as many of the batch's rows each.

    Equal widths would put a window's crowded hours into one query; these bounds follow the rows that are looked up.
    """
    start, end = batch.agg(F.min(column), F.max(column)).first()
    options = table_options(source, "unused")
    url = options.pop("url")
    options.pop("dbtable")
    query = f"({window_query(table, columns, column, start, end)}) AS bounded"
    return spark.read.jdbc(url, query, predicates=split_predicates(column, split_bounds(batch, column, partitions)), properties=options)
