"""Districts from coordinates: polygon containment, else the nearest centroid.  No UDF, no cross join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.functions.text import strip_all

# Grids double their cell size from CELL degrees on, level by level; the last level is one cell for everything.
CELL = 0.02
LEVELS = 16
# Cells that a boundary's box spans in each direction, at most; larger boxes use a coarser grid.
BOX_CELLS = 4


def _size(level: Column) -> Column:
    return F.lit(CELL) * F.pow(F.lit(2.0), level)


def _cell(value: Column, level: Column) -> Column:
    return F.when(level < LEVELS, F.floor(value / _size(level))).otherwise(F.lit(0).cast("bigint"))


def _all_levels() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level")


def _point_in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Even-odd ray casting against the closed ring; rings below three points contain nothing."""

    def crosses(point: Column, index: Column) -> Column:
        x1, y1 = point[0], point[1]
        following = F.get(ring, (index + 1) % F.size(ring))
        x2, y2 = following[0], following[1]
        at = (x2 - x1) * (lat - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1
        return F.when((y1 > lat) != (y2 > lat), F.coalesce(lon < at, F.lit(False))).otherwise(False)

    return (F.size(ring) >= 3) & (F.size(F.filter(ring, crosses)) % 2 == 1)


def contains(polygons: Column, lon: Column, lat: Column) -> Column:
    """Inside the shell of any polygon and inside none of that polygon's holes."""

    def inside(polygon: Column) -> Column:
        holes = F.slice(polygon, F.lit(2), F.greatest(F.size(polygon) - 1, F.lit(0)))
        return (
            (F.size(polygon) > 0)
            & _point_in_ring(lon, lat, F.get(polygon, F.lit(0)))
            & ~F.exists(holes, lambda hole: _point_in_ring(lon, lat, hole))
        )

    return F.exists(polygons, inside)


def _boundary_cells(boundaries: DataFrame) -> DataFrame:
    """(level, cell_x, cell_y, arr_number): the cells that each boundary's box touches.

    The level follows from the size of the box, so a box touches at most (``BOX_CELLS`` + 1)² cells, whatever it covers.
    """
    points = F.flatten(F.flatten(F.col("polygons")))
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    boxes = boundaries.where(F.size(points) > 0).select(
        "arr_number",
        *[f(c).alias(n) for n, f, c in (("x1", F.array_min, xs), ("x2", F.array_max, xs), ("y1", F.array_min, ys), ("y2", F.array_max, ys))],
    )
    span = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.lit(CELL))
    level = F.ceil(F.log2(span / F.lit(BOX_CELLS * CELL))).cast("int")
    boxes = boxes.withColumn("level", F.least(F.greatest(level, F.lit(0)), F.lit(LEVELS)))

    def cells(low: str, high: str) -> Column:
        return F.explode(F.sequence(_cell(F.col(low), F.col("level")), _cell(F.col(high), F.col("level"))))

    columns = boxes.select("*", cells("x1", "x2").alias("cell_x"))
    return columns.select("arr_number", "level", "cell_x", cells("y1", "y2").alias("cell_y")).distinct()


def _places(points: DataFrame, wanted: Column | None = None) -> DataFrame:
    """Distinct coordinates: however many points share them, they are resolved once."""
    known = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    return points.where(known if wanted is None else known & wanted).select("longitude", "latitude").distinct()


def _containing(places: DataFrame, boundaries: DataFrame) -> DataFrame:
    """(longitude, latitude, arr_number, label) of the places inside a boundary; the lowest number wins.

    Cells are matched by number alone; the geometry joins after that, once for each candidate.
    """
    lon, lat = F.col("longitude"), F.col("latitude")
    located = places.select("*", _all_levels())
    located = located.withColumns({"cell_x": _cell(lon, F.col("level")), "cell_y": _cell(lat, F.col("level"))})
    near = located.join(_boundary_cells(boundaries), ["level", "cell_x", "cell_y"]).select("longitude", "latitude", "arr_number")
    inside = near.join(boundaries.select("arr_number", "label", "polygons"), "arr_number").where(contains(F.col("polygons"), lon, lat))
    best = inside.groupBy("longitude", "latitude").agg(F.min(F.struct("arr_number", "label")).alias("hit"))
    return best.select("longitude", "latitude", "hit.arr_number", "hit.label")


def _nearest(places: DataFrame, boundaries: DataFrame) -> DataFrame:
    """(longitude, latitude, nearest_number, nearest_label): squared distance, ties to the lowest number.

    On every grid the cells of the centroids and the eight around each are marked.  A place first finds its finest grid
    with a mark in its cell.  That centroid is less than three cell sides away, so the grid two levels up, whose
    cells are four times as wide, has every nearer one in the same neighbourhood: the centroids of the place's cell there
    and of the eight around it are the candidates.  Cells are told apart before they are spread, and centroids never are.
    """
    centroids = boundaries.where(F.col("centroid_lon").isNotNull() & F.col("centroid_lat").isNotNull()).select(
        "arr_number", "label", "centroid_lon", "centroid_lat"
    )
    level = F.col("level")
    steps = F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x in (-1, 0, 1) for y in (-1, 0, 1)])
    none = F.array(F.struct(F.lit(0).alias("dx"), F.lit(0).alias("dy")))
    cells = ["level", "cell_x", "cell_y"]

    def in_cells(rows: DataFrame, lon: str, lat: str) -> DataFrame:
        return rows.withColumns({"cell_x": _cell(F.col(lon), level), "cell_y": _cell(F.col(lat), level)})

    def around(rows: DataFrame) -> DataFrame:
        spread = rows.withColumn("o", F.explode(F.when(level < LEVELS, steps).otherwise(none)))
        return spread.withColumns({"cell_x": F.col("cell_x") + F.col("o.dx"), "cell_y": F.col("cell_y") + F.col("o.dy")}).drop("o")

    entries = in_cells(centroids.select("*", _all_levels()), "centroid_lon", "centroid_lat")
    marks = around(entries.select(*cells).distinct()).distinct()
    finest = in_cells(places.select("*", _all_levels()), "longitude", "latitude").join(marks, cells, "left_semi")
    finest = finest.groupBy("longitude", "latitude").agg(F.least(F.min("level") + 2, F.lit(LEVELS)).alias("level"))
    wide = around(in_cells(finest, "longitude", "latitude"))
    d = _distance2(F.col("longitude"), F.col("latitude"), F.col("centroid_lon"), F.col("centroid_lat")).alias("d")
    best = wide.join(entries, cells).groupBy("longitude", "latitude").agg(F.min(F.struct(d, "arr_number", "label")).alias("best"))
    return best.select(
        "longitude", "latitude", F.col("best.arr_number").alias("nearest_number"), F.col("best.label").alias("nearest_label")
    )


def _back(points: DataFrame, found: DataFrame) -> DataFrame:
    """Points with what their coordinates found.  Every point comes out once, whatever its key."""
    found = found.withColumnsRenamed({"longitude": "_lon", "latitude": "_lat"})
    same = (F.col("longitude") == F.col("_lon")) & (F.col("latitude") == F.col("_lat"))
    return points.join(found, same, "left").drop("_lon", "_lat")


def point_in_polygon_join(points: DataFrame, boundaries: DataFrame, wanted: Column | None = None) -> DataFrame:
    """``points(longitude, latitude, ...)`` with the lowest-numbered boundary around each.

    Equi-joins on grid cells: Catalyst broadcasts the cells when their size allows it and shuffles otherwise, and
    adaptive execution splits crowded cells.  Points outside every boundary (or not ``wanted``) get NULLs.
    """
    found = _back(points, _containing(_places(points, wanted), boundaries))
    if wanted is None:
        return found
    return found.withColumns({c: F.when(wanted, F.col(c)) for c in ("arr_number", "label")})


def nearest_centroid_join(points: DataFrame, boundaries: DataFrame) -> DataFrame:
    """``points`` with the number and label of the nearest centroid, by one plan for any number of centroids."""
    return _back(points, _nearest(_places(points), boundaries))


def _distance2(lon: Column, lat: Column, to_lon: Column, to_lat: Column) -> Column:
    return (to_lon - lon) * (to_lon - lon) + (to_lat - lat) * (to_lat - lat)


def is_generic(name: str) -> Column:
    """The district name is just ``Paris``, in any case and with any surrounding white space."""
    return F.coalesce(F.lower(strip_all(name)) == "paris", F.lit(False))


def resolve_label(points: DataFrame, boundaries: DataFrame, wanted: Column | None = None) -> DataFrame:
    """``points`` with ``district_label``: containing district, else nearest centroid, else NULL.

    Places that are not ``wanted`` are not looked up.
    """
    places = _places(points, wanted)
    found = _back(_back(places, _containing(places, boundaries)), _nearest(places, boundaries))
    labels = found.select("longitude", "latitude", F.coalesce("label", "nearest_label").alias("district_label"))
    out = _back(points, labels)
    return out if wanted is None else out.withColumn("district_label", F.when(wanted, F.col("district_label")))


def enrich_district(stations: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Replace the generic ``Paris`` by the district of the station's coordinates.

    Other names are only stripped and NULL stays NULL.
    """
    name = "district_municipality_names"
    labelled = resolve_label(stations, boundaries, wanted=is_generic(name))
    district = F.when(is_generic(name), F.coalesce("district_label", strip_all(name))).otherwise(strip_all(name))
    return labelled.withColumn(name, district).select(*stations.columns)
