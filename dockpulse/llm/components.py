"""Connected components of a large graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockpulse.session import hadoop_path, stage, work_path


class Written:
    """A table below the shared folder that is replaced step by step; the one before is deleted."""

    def __init__(self, spark, name: str):
        self.spark, self.name, self.path = spark, name, None

    def put(self, df: DataFrame) -> DataFrame:
        path, old = work_path(self.spark, self.name), self.path
        df.write.parquet(path)
        self.path = path
        if old:
            system, target = hadoop_path(self.spark, old)
            system.delete(target, True)
        return self.spark.read.schema(df.schema).parquet(path)


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; ``component`` is the smallest node of its component.

    ``links`` has longs ``a`` and ``b``.  Each step is an aggregate and a join that adaptive execution can split, so a node
    with a third of all links is no bottleneck; the number of steps grows with the logarithm of the longest chain.
    Only two numbers of each step reach the driver.
    """
    kept = Written(links.sparkSession, "links")
    edges = kept.put(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = kept.put(large)
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        edges = kept.put(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return stage(edges.union(roots).select(F.col("u").alias("node"), F.col("v").alias("component")), "components")
