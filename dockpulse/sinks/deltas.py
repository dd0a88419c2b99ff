"""A store of appended states: micro-batches add what they bring, readers merge, compaction folds by day."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dockpulse.session import child_folders, hadoop_path, path_exists

DAY = "snapshot_date"


def _numbers(spark: SparkSession, path: str, key: str) -> list[int]:
    """Numbers of the folders ``key=N`` whose job was committed."""
    if not path_exists(spark, path):
        return []
    found = [int(name.split("=", 1)[1]) for name in child_folders(spark, path, f"{key}=*")]
    return sorted(n for n in found if path_exists(spark, f"{path}/{key}={n}/_SUCCESS"))


@dataclass(frozen=True)
class DeltaStore:
    """Mergeable states below a folder, by day.

    ``pending/stream=S/batch=N`` holds what batch N of stream S brought: a replayed batch writes its folder again.  ``folded/version=K``
    holds whole days, and ``manifests/version=K`` says up to which batch of each stream they are merged.  A version counts from the
    moment its manifest is committed, so a compaction that is lost halfway changes nothing.
    """

    path: str
    schema: StructType
    merge: Callable[[DataFrame], DataFrame]

    def append(self, states: DataFrame, stream: str, batch: int) -> None:
        """Writes as much as the batch brings, whatever the size of its days.  A batch that is folded already adds nothing."""
        spark = states.sparkSession
        if batch <= self._folded(spark).get(stream, -1):
            return
        rows = states.select(*self.schema.fieldNames()).hint("rebalance", DAY)
        rows.write.mode("overwrite").partitionBy(DAY).parquet(f"{self.path}/pending/stream={stream}/batch={batch}")

    def last(self, spark: SparkSession, stream: str) -> int | None:
        """The last batch of a stream that the store holds, folded or pending."""
        numbers = [n for name, n, _ in self._pending(spark) if name == stream]
        return max(numbers, default=self._folded(spark).get(stream))

    def read(self, spark: SparkSession, low: str | None = None, high: str | None = None) -> DataFrame:
        """One state for each key; ``low`` and ``high`` (inclusive days) prune the folders that are read."""
        return self.merge(self._parts(spark, self._pending(spark), low, high))

    def compact(self, spark: SparkSession) -> int:
        """Merge all pending batches into their days; returns how many batches are pending no more.

        Only days with pending states are read and written.  Folded batches and overtaken versions are deleted after the commit.
        """
        folded, pending = self._folded(spark), self._pending(spark)
        if not pending:
            return 0
        number = max(_numbers(spark, f"{self.path}/manifests", "version"), default=0) + 1
        days = self._scan(spark, [f for _, _, f in pending]).select(F.col(DAY).alias("day")).distinct()
        rows = self.merge(self._parts(spark, pending).join(days, F.col(DAY).eqNullSafe(F.col("day")), "left_semi"))
        arranged = rows.select(*self.schema.fieldNames()).hint("rebalance", DAY).sortWithinPartitions(DAY, self.schema.fieldNames()[0])
        arranged.write.mode("overwrite").partitionBy(DAY).parquet(f"{self.path}/folded/version={number}")
        for stream, batch, _ in pending:
            folded[stream] = max(folded.get(stream, -1), batch)
        manifest = spark.createDataFrame(list(folded.items()), "stream string, batch bigint")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/version={number}")
        self._clean(spark, [f for _, _, f in pending])
        return len(pending)

    def _clean(self, spark: SparkSession, merged: list[str]) -> None:
        """What no reader needs any more: folded batches, days that a later version holds, manifests but the last."""
        versions = _numbers(spark, f"{self.path}/manifests", "version")
        gone, seen = list(merged), set()
        for number in reversed(versions):
            folder = f"{self.path}/folded/version={number}"
            for day in child_folders(spark, folder, f"{DAY}=*"):
                if day in seen:
                    gone.append(f"{folder}/{day}")
                seen.add(day)
        for folder in gone:
            system, target = hadoop_path(spark, folder)
            system.delete(target, True)

    def _folded(self, spark: SparkSession) -> dict[str, int]:
        """The last folded batch of each stream."""
        versions = _numbers(spark, f"{self.path}/manifests", "version")
        if not versions:
            return {}
        rows = spark.read.schema("stream string, batch bigint").parquet(f"{self.path}/manifests/version={versions[-1]}")
        return {row["stream"]: row["batch"] for row in rows.collect()}

    def _pending(self, spark: SparkSession) -> list[tuple[str, int, str]]:
        """(stream, batch, folder) of committed batches behind the last folded ones."""
        folded, out = self._folded(spark), []
        if path_exists(spark, f"{self.path}/pending"):
            for name in child_folders(spark, f"{self.path}/pending", "stream=*"):
                stream, folder = name.split("=", 1)[1], f"{self.path}/pending/{name}"
                out += [(stream, n, f"{folder}/batch={n}") for n in _numbers(spark, folder, "batch") if n > folded.get(stream, -1)]
        return out

    def _scan(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        """Rows of pending folders with days below; folders without a day are left out."""
        filled = [f for f in folders if child_folders(spark, f, f"{DAY}=*")]
        if not filled:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).option("basePath", f"{self.path}/pending").parquet(*filled)
        return rows.select(*self.schema.fieldNames())

    def _parts(
        self, spark: SparkSession, pending: list[tuple[str, int, str]], low: str | None = None, high: str | None = None
    ) -> DataFrame:
        """Pending states, and of each day the latest folded version."""
        days: dict[str, int] = {}
        for number in _numbers(spark, f"{self.path}/manifests", "version"):
            for name in child_folders(spark, f"{self.path}/folded/version={number}", f"{DAY}=*"):
                days[name.split("=", 1)[1]] = number
        out = self._scan(spark, [folder for *_, folder in pending])
        for number in sorted(set(days.values())):
            own = [d for d, n in days.items() if n == number]
            rows = spark.read.schema(self.schema).parquet(f"{self.path}/folded/version={number}")
            named = [F.lit(d).cast("date") for d in own if d != "__HIVE_DEFAULT_PARTITION__"]
            wanted = F.col(DAY).isin(named) if named else F.lit(False)
            if len(named) < len(own):
                wanted = wanted | F.col(DAY).isNull()
            out = out.unionByName(rows.where(wanted))
        if low is not None:
            out = out.where(F.col(DAY) >= F.lit(low).cast("date"))
        if high is not None:
            out = out.where(F.col(DAY) <= F.lit(high).cast("date"))
        return out
