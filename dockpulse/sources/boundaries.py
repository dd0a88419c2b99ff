"""District boundaries from GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.functions.text import district_label
from dockpulse.schemas import BOUNDARY_FILE, MULTIPOLYGON, POLYGON


def as_multipolygon(kind: Column, coordinates: Column) -> Column:
    """Both geometry types as a list of polygons (each a shell and its holes); others are NULL."""
    return F.when(kind == "Polygon", F.array(F.from_json(coordinates, POLYGON))).when(
        kind == "MultiPolygon", F.from_json(coordinates, MULTIPOLYGON)
    )


def scan_boundaries(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per feature: number, label, polygons, centroid.

    ``multi_line`` reads one document per file, otherwise one per line.
    """
    features = spark.read.schema(BOUNDARY_FILE).json(path, multiLine=multi_line).select(F.explode("features").alias("f"))
    number = F.col("f.properties.c_ar")
    return features.select(
        number.alias("arr_number"),
        district_label(number).alias("label"),
        as_multipolygon(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("polygons"),
        F.col("f.properties.geom_x_y.lon").alias("centroid_lon"),
        F.col("f.properties.geom_x_y.lat").alias("centroid_lat"),
    )
