"""Repair of polygons, the hierarchical grid and containment on the sphere."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import spatial


def polygon(*rings):
    return {"type": "Polygon", "coordinates": [[list(p) for p in (*r, r[0])] for r in rings]}


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def matches(spark, geometries, points, **how):
    """{(point number, geometry number)} of the join."""
    g = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(geometries)], "pid int, geo_json string")
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)],
                              "area_id int, longitude double, latitude double")
    polys = spatial.polygons_from_geojson(g, distinct=False, keep=("pid",), geodesic=how.pop("geodesic", False))
    got = [(r.area_id, r.pid) for r in spatial.spatial_join(p, polys, **how).select("area_id", "pid").collect()]
    return got


def inside(spark, geometry, points, **how):
    got = matches(spark, [geometry], points, **how)
    assert len(got) == len(set(got))
    return [(i, 0) in got for i in range(len(points))]


BOWTIE = polygon([(0, 0), (2, 2), (2, 0), (0, 2)])


@pytest.mark.parametrize("geometry, points, expected", [
    # two lobes, the crossing and what lies above and below it outside
    (BOWTIE, [(0.5, 1), (1.5, 1), (1, 1), (1, 1.5), (1, 0.5)], [True, True, False, False, False]),
    # a spike and a seam that the ring goes along twice bound nothing
    (polygon([(0, 0), (4, 0), (4, 4), (2, 4), (2, 2), (2, 4), (0, 4)]), [(2, 3), (2, 2), (1, 1), (2, 4)],
     [True, True, True, False]),
    # a hole that shares part of an edge with the outer ring
    (polygon(box(0, 0, 4, 4), box(0, 1, 2, 3)), [(1, 2), (0, 2), (3, 2), (2, 2), (1, 3.5)],
     [False, False, True, False, True]),
    # two rings that cross: where both are is outside
    (polygon(box(0, 0, 3, 3), box(2, 1, 5, 2)), [(1, 1.5), (2.5, 1.5), (4, 1.5), (3, 1.5)],
     [True, False, True, False]),
    # across the antimeridian, on both sides of it and on it
    (polygon(box(179, 0, -179, 2)), [(179.5, 1), (-179.5, 1), (180, 1), (-180, 1), (0, 1), (0.5, 0.5), (178.5, 1), (179, 1)],
     [True, True, True, True, False, False, False, False]),
    # its hole lies on the other side
    (polygon([(170, 0), (-170, 0), (-170, 10), (170, 10)], box(-178, 4, -176, 6)), [(-177, 5), (175, 5), (-175, 5)],
     [False, True, True]),
    # a ring round the north pole holds the pole
    (polygon([(-120, 70), (0, 70), (120, 70)]), [(17, 89), (-179, 80), (0, 60), (90, 70.5)], [True, True, False, True]),
    # a collection, nested; lines and points have no interior
    ({"type": "GeometryCollection", "geometries": [
        {"type": "Point", "coordinates": [9, 9]}, polygon(box(0, 0, 1, 1)),
        {"type": "GeometryCollection", "geometries": [
            {"type": "MultiPolygon", "coordinates": [polygon(box(5, 5, 6, 6))["coordinates"], polygon(box(5.5, 5.5, 7, 7))["coordinates"]]},
            {"type": "LineString", "coordinates": [[0, 0], [9, 9]]}]}]},
     [(0.5, 0.5), (5.75, 5.75), (6.5, 6.5), (9, 9), (3, 3)], [True, True, True, False, False]),
    ({"type": "LineString", "coordinates": [[0, 0], [9, 9]]}, [(1, 1)], [False]),
    ({"type": "Polygon", "coordinates": [[[0, 0], [1, 1]]]}, [(0.5, 0.5)], [False]),
])
def test_repaired_polygons(spark, geometry, points, expected):
    if geometry.get("type") == "GeometryCollection":  # parts overlap: one row each
        got = set(matches(spark, [geometry], points))
        assert [(i, 0) in got for i in range(len(points))] == expected
    else:
        assert inside(spark, geometry, points) == expected


def test_texts_that_are_no_geometry(spark):
    df = spark.createDataFrame([("nonsense",), (None,), ('{"type":"Point","coordinates":[1,2]}',), ("{}",)], "geo_json string")
    assert spatial.polygons_from_geojson(df).count() == 0
    deep = {"type": "Point", "coordinates": [0, 0]}
    for _ in range(6):
        deep = {"type": "GeometryCollection", "geometries": [deep]}
    with pytest.raises(Exception, match="nested too deep"):
        spatial.polygons_from_geojson(spark.createDataFrame([(json.dumps(deep),)], "geo_json string")).collect()


def even_odd(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def test_noding_keeps_the_interior_of_tangled_rings(spark):
    rnd = random.Random(3)
    rings = [[(rnd.uniform(0, 8), rnd.uniform(0, 8)) for _ in range(n)] for n in (4, 7, 12, 40, 90)]
    points = [(rnd.uniform(-1, 9), rnd.uniform(-1, 9)) for _ in range(400)]
    got = set(matches(spark, [polygon(r) for r in rings], points))
    assert got == {(i, k) for i, p in enumerate(points) for k, r in enumerate(rings) if even_odd(r, *p)}
    # no two pieces cross or overlap any more
    df = spark.createDataFrame([(json.dumps(polygon(rings[2])),)], "geo_json string")
    pieces = [tuple(e) for e in spatial.polygons_from_geojson(df).first().edges]

    def side(a, x, y):
        return (a[2] - a[0]) * (y - a[1]) - (a[3] - a[1]) * (x - a[0])
    tiny = 1e-9
    for a in pieces:
        for b in pieces:
            s = [side(a, *b[:2]), side(a, *b[2:]), side(b, *a[:2]), side(b, *a[2:])]
            if min(map(abs, s)) > tiny:
                assert not (s[0] * s[1] < 0 and s[2] * s[3] < 0)


def test_polygons_of_unlike_size_have_few_cells(spark):
    rnd = random.Random(5)
    shapes = [polygon([(x, y), (x + w, y + w / 9), (x + w / 3, y + w)]) for x, y, w in
              [(rnd.uniform(-4, 4), rnd.uniform(-4, 4), 0.001) for _ in range(50)] + [(-4, -4, 7.9), (-90, -80, 150.0)]]
    shapes.append(polygon([(-30, 0), (30, 0.001), (30, 0.002), (-30, 0.001)]))  # long and thin
    df = spark.createDataFrame([(i, json.dumps(g)) for i, g in enumerate(shapes)], "pid int, geo_json string")
    polys = spatial.polygons_from_geojson(df, distinct=False, keep=("pid",))
    cells = spatial.cover(polys)
    most = cells.groupBy("pid").count().agg(F.max("count")).first()[0]
    assert most <= 4 ** (spatial.REFINE + 1)
    assert cells.where("_inside").count() > 0
    points = [(rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for _ in range(300)]
    points += [(g["coordinates"][0][0][0] + 0.0004, g["coordinates"][0][0][1] + 0.0003) for g in shapes[:50]]
    points += [(x / 7, 0.001 + x / 7 * 0.001 / 60 - 0.00049) for x in range(-100, 100)]
    got = set(matches(spark, shapes, points))
    want = {(i, k) for i, p in enumerate(points) for k, g in enumerate(shapes)
            if even_odd([tuple(v) for v in g["coordinates"][0][:-1]], *p)}
    assert got == want and len({k for _, k in want}) == len(shapes)


def test_sphere_differs_from_the_plane(spark):
    """The northern edge of a wide box runs over higher latitudes as an arc."""
    wide = polygon(box(-30, 50, 30, 60))
    arc = math.degrees(math.atan(math.tan(math.radians(60)) / math.cos(math.radians(30))))  # at longitude 0
    points = [(0, 60.5), (0, arc - 0.01), (0, arc + 0.01), (0, 50.5), (0, 55), (29, 60.01), (31, 55), (-30, 55), (0, 54)]
    assert inside(spark, wide, points) == [False, False, False, True, True, False, False, False, True]
    # the southern edge rises as well, to 53.99 degrees
    assert inside(spark, wide, points, geodesic=True) == [True, True, False, False, True, True, False, False, True]


def test_sphere_at_poles_and_antimeridian(spark):
    cap = polygon([(-120, 70), (0, 70), (120, 70)])
    low = math.degrees(math.atan(math.tan(math.radians(70)) / math.cos(math.radians(60))))  # between two vertices
    assert inside(spark, cap, [(17, 89), (60, low + 0.1), (60, low - 0.1), (0, 69.9), (0, 70.1)], geodesic=True) == \
        [True, True, False, False, True]
    south = polygon([(-120, -70), (0, -70), (120, -70)])
    assert inside(spark, south, [(17, -89), (60, -low - 0.1), (60, -low + 0.1), (0, 0)], geodesic=True) == \
        [True, True, False, False]
    across = polygon(box(170, 50, -170, 60))
    assert inside(spark, across, [(180, 60.1), (-180, 60.1), (175, 55), (-175, 55), (0, 55), (180, 50.1)], geodesic=True) == \
        [True, True, True, True, False, False]


def test_salted_bridge_and_cells(spark):
    cells = spark.createDataFrame([("g", 0, 0, json.dumps(polygon(box(0, 0, 2, 2))))],
                                  "grid_id string, grid_x int, grid_y int, geo_json string")
    areas = spark.createDataFrame([(f"a{i}", 1.0, i / 50) for i in range(150)], "id string, latitude double, longitude double")
    want = sorted(f"a{i}" for i in range(1, 100))
    for salt in (1, 5):
        assert sorted(r.area_id for r in spatial.assign_cells(areas, cells, salt=salt).collect()) == want
        assert sorted(r.area_id for r in spatial.area_polygons(areas, cells, salt=salt).collect()) == want


def test_pairs_are_distinct_without_a_shuffle_of_them(spark):
    overlapping = {"type": "MultiPolygon", "coordinates": [[box(0, 0, 2, 2)], [box(1, 1, 3, 3)]]}
    shapes = [(1, polygon(box(0, 0, 2, 2))), (2, overlapping), (3, polygon(box(0, 0, 1, 1))), (3, polygon(box(0, 0, 2, 2))),
              (4, polygon(box(179, 0, -179, 2))), (None, polygon(box(0, 0, 9, 9))), (None, polygon(box(0, 0, 9, 9)))]
    points = [(1, 1.5, 1.5), (1, 1.5, 1.5), (2, 0.5, 0.5), (2, 0.25, 0.5), (3, 1.5, 1.75), (4, 179.5, 1.0), (5, -179.5, 1.0),
              (6, None, 1.0), (None, 1.25, 1.5), (None, 0.5, 0.75)]
    polys = spatial.polygons_from_geojson(spark.createDataFrame([(i, json.dumps(g)) for i, g in shapes], "polygon_id int, geo_json string"),
                                          distinct=False, keep=("polygon_id",))
    pts = spark.createDataFrame(points, "point_id int, longitude double, latitude double")
    for salt in (1, 4):
        want = spatial.spatial_join(pts, polys).select("point_id", "polygon_id").distinct().collect()
        got = spatial.distinct_pairs(pts, polys, salt=salt).collect()
        assert len(got) == len(want) and set(map(tuple, got)) == set(map(tuple, want))
    single = [x for x in shapes if x[0] in (1, 4)]
    polys = spatial.polygons_from_geojson(spark.createDataFrame([(i, json.dumps(g)) for i, g in single], "polygon_id int, geo_json string"),
                                          distinct=False, keep=("polygon_id",))
    plan = spatial.distinct_pairs(pts.filter("point_id > 3"), polys, salt=4)
    assert "Aggregate" not in plan._jdf.queryExecution().executedPlan().toString()
