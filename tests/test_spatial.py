import json
import random

import pytest
from pyspark.sql import functions as F

from dockpulse.operators import spatial
from dockpulse.sources.boundaries import scan_boundaries

SQUARE = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]
HOLE = [[0.25, 0.25], [0.75, 0.25], [0.75, 0.75], [0.25, 0.75], [0.25, 0.25]]
TRIANGLE = [[1.0, 0.0], [2.0, 0.0], [1.0, 1.0]]
OVERLAP = [[0.5, 0.5], [1.5, 0.5], [1.5, 1.5], [0.5, 1.5]]
ISLAND = [[3.0, 3.0], [3.5, 3.0], [3.5, 3.5], [3.0, 3.5]]
FAR = [[9.0, 9.0], [10.0, 9.0], [10.0, 10.0], [9.0, 10.0]]
FEATURES = [
    (3, "MultiPolygon", [[OVERLAP], [ISLAND]], (1.0, 1.0)),
    (1, "Polygon", [SQUARE, HOLE], (0.5, 0.5)),
    (2, "Polygon", [TRIANGLE], (1.5, 0.4)),
    (4, "Polygon", [FAR], None),
    (5, "Point", [5.0, 5.0], (5.0, 5.0)),
]


def _ring(lon, lat, ring):
    inside = False
    for i, (x1, y1) in enumerate(ring):
        x2, y2 = ring[(i + 1) % len(ring)]
        if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def _expected(lon, lat):
    for number, kind, coordinates, _ in sorted(FEATURES, key=lambda f: f[0]):
        polygons = {"Polygon": [coordinates], "MultiPolygon": coordinates}.get(kind, [])
        if any(_ring(lon, lat, p[0]) and not any(_ring(lon, lat, h) for h in p[1:]) for p in polygons):
            return number
    return None


def _nearest(lon, lat, centroids):
    return min((((x - lon) ** 2 + (y - lat) ** 2), n) for n, (x, y) in centroids)[1]


@pytest.fixture(scope="module")
def boundaries(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("geo") / "districts.geojson"
    features = [
        {
            "type": "Feature",
            "properties": {"c_ar": n, "geom_x_y": None if c is None else {"lon": c[0], "lat": c[1]}},
            "geometry": {"type": kind, "coordinates": coordinates},
        }
        for n, kind, coordinates, c in FEATURES
    ]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    return scan_boundaries(spark, str(path))


def points(spark, places):
    rows = [(str(i), float(x), float(y)) for i, (x, y) in enumerate(places)]
    return spark.createDataFrame(rows, "station_id string, longitude double, latitude double")


def places():
    draw = random.Random(11)
    # Random points, and a grid that hits vertices, edges and vertex latitudes exactly.
    return [(draw.uniform(-1, 4), draw.uniform(-1, 4)) for _ in range(600)] + [
        (x / 4, y / 4) for x in range(-2, 16) for y in range(-2, 16)
    ]


def test_scan(boundaries):
    rows = {r["arr_number"]: r for r in boundaries.collect()}
    assert rows[1]["label"] == "Paris 1er Arrondissement"
    assert rows[3]["label"] == "Paris 3e Arrondissement"
    assert len(rows[1]["polygons"][0]) == 2 and len(rows[3]["polygons"]) == 2
    assert rows[4]["centroid_lon"] is None and rows[5]["polygons"] is None


def test_containment_equals_ray_casting(spark, boundaries):
    where = places()
    got = {int(r["station_id"]): r["arr_number"] for r in spatial.point_in_polygon_join(points(spark, where), boundaries).collect()}
    assert got == {i: _expected(x, y) for i, (x, y) in enumerate(where)}


def test_nearest_equals_brute_force(spark, boundaries):
    where = places() + [(50.0, -80.0), (-5000.0, 9000.0)]
    centroids = [(n, c) for n, _, _, c in FEATURES if c]
    got = {int(r["station_id"]): r["nearest_number"] for r in spatial.nearest_centroid_join(points(spark, where), boundaries).collect()}
    assert got == {i: _nearest(x, y, centroids) for i, (x, y) in enumerate(where)}


def test_grid_search_with_many_centroids(spark):
    draw = random.Random(5)
    centroids = [(i, (draw.uniform(0, 10) ** 2, draw.uniform(0, 10))) for i in range(700)]
    rows = [(n, f"L{n}", x, y) for n, (x, y) in centroids]
    table = spark.createDataFrame(rows, "arr_number int, label string, centroid_lon double, centroid_lat double")
    where = [(draw.uniform(-5, 120), draw.uniform(-5, 15)) for _ in range(300)]
    got = {int(r["station_id"]): r["nearest_number"] for r in spatial.nearest_centroid_join(points(spark, where), table).collect()}
    assert got == {i: _nearest(x, y, centroids) for i, (x, y) in enumerate(where)}


def test_every_point_comes_out_once(spark, boundaries):
    """Repeated and NULL keys, and one place shared by many points."""
    rows = [("a", 0.1, 0.1), ("a", 0.4, 0.4), (None, 0.1, 0.1), (None, 9.5, 9.5)] + [("b", 0.1, 0.1)] * 50
    df = spark.createDataFrame(rows, "station_id string, longitude double, latitude double")
    got = spatial.point_in_polygon_join(df, boundaries).collect()
    assert len(got) == 54 and sum(r["arr_number"] == 1 for r in got) == 52
    assert spatial.nearest_centroid_join(df, boundaries).count() == spatial.resolve_label(df, boundaries).count() == 54


def test_large_and_small_boxes(spark):
    """A polygon of continental size touches few cells."""
    large = [[[[-120.0, -60.0], [120.0, -60.0], [120.0, 60.0], [-120.0, 60.0]]]]
    small = [[[[0.0, 0.0], [0.001, 0.0], [0.001, 0.001], [0.0, 0.001]]]]
    rows = [(9, "large", large, None, None), (2, "small", small, None, None)]
    table = spark.createDataFrame(
        rows, "arr_number int, label string, polygons array<array<array<array<double>>>>, centroid_lon double, centroid_lat double"
    )
    assert spatial._boundary_cells(table).count() <= 2 * (spatial.BOX_CELLS + 1) ** 2
    where = points(spark, [(0.0005, 0.0005), (50.0, 20.0), (-119.9, 59.9), (130.0, 0.0)])
    got = {r["station_id"]: r["label"] for r in spatial.point_in_polygon_join(where, table).collect()}
    assert got == {"0": "small", "1": "large", "2": "large", "3": None}


def test_points_without_position(spark, boundaries):
    rows = spark.createDataFrame([("a", None, 0.1), ("b", 0.1, 0.1)], "station_id string, longitude double, latitude double")
    got = {r["station_id"]: r["district_label"] for r in spatial.resolve_label(rows, boundaries).collect()}
    assert got == {"a": None, "b": "Paris 1er Arrondissement"}


def test_enrichment_rules(spark, boundaries):
    rows = [
        ("in", " paris ", 0.1, 0.1),
        ("hole", "Paris", 0.4, 0.4),
        ("out", "PARIS\t", 5.2, 5.2),
        ("other", "Montreuil ", 0.1, 0.1),
        ("labelled", "Paris 9e Arrondissement", 0.1, 0.1),
        ("null", None, 0.1, 0.1),
        ("lost", "Paris ", None, None),
    ]
    df = spark.createDataFrame(rows, "station_id string, district_municipality_names string, longitude double, latitude double")
    got = {r["station_id"]: r["district_municipality_names"] for r in spatial.enrich_district(df, boundaries).collect()}
    assert got == {
        "in": "Paris 1er Arrondissement",
        "hole": "Paris 1er Arrondissement",
        "out": "Paris 5e Arrondissement",
        "other": "Montreuil",
        "labelled": "Paris 9e Arrondissement",
        "null": None,
        "lost": "Paris",
    }


def test_no_boundaries_keep_the_name(spark, boundaries):
    df = spark.createDataFrame([("a", "Paris", 0.1, 0.1)], "station_id string, district_municipality_names string, longitude double, latitude double")
    assert spatial.enrich_district(df, boundaries.where(F.lit(False))).first()["district_municipality_names"] == "Paris"
