"""Hand-written edge rows per Column function (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from ridgeline.functions import (bbox, climb_score, edges, is_axis_rectangle, json_scalar,
                                 normalize_article, parent_of, parse_wind, point_in_polygon,
                                 point_in_rings, ramp, rings_from_geojson, safe_get)


def test_parse_wind(spark):
    df = spark.createDataFrame([("10 mph",), ("10 to 15 mph",), ("10.5 mph",), ("calm",), (None,),
                                ("gusts 30 km/h",)], "s string")
    got = [tuple(r) for r in df.select(parse_wind("s").alias("w")).select("w.*").collect()]
    assert got == [(10.0, 10.0, "mph"), (10.0, 15.0, "mph"), (10.0, 5.0, "mph"),
                   (None, None, "calm"), (None, None, None), (None, 30.0, "h")]


def test_ramp(spark):
    df = spark.createDataFrame([(20.0,), (25.0,), (30.0,), (35.0,), (40.0,), (None,)], "x double")
    got = [r[0] for r in df.select(ramp("x", 35, 25)).collect()]
    assert got == [1.0, 1.0, 0.5, 0.0, 0.0, None]
    with pytest.raises(ValueError):
        ramp("x", 25, 25)


def test_ramp_bounds_and_monotone(spark):
    df = spark.range(0, 200).select((F.col("id") / 2 - 20).alias("x"))
    vals = [r[0] for r in df.orderBy("x").select(ramp("x", 30, 40)).collect()]
    assert all(0.0 <= v <= 1.0 for v in vals)
    assert vals == sorted(vals)


@pytest.mark.parametrize("row,expected", [
    ((55, 0, 25, 0), 100.4),
    ((55, 20, 14, 30), 80.2),
    ((75, 0, 25, 0), 0.4),
    ((35, 0, 25, 0), 0.4),
    ((55, None, 25, 0), 100.4),
    ((None, 0, 25, 0), None),
    ((55, 0, None, 0), None),
    ((55, 0, 25, None), None),
])
def test_climb_score_reference(spark, row, expected):
    df = spark.createDataFrame([tuple(None if v is None else float(v) for v in row)], "t double, p double, w double, h double")
    got = df.select(F.round(climb_score("t", "p", "w", "h"), 6)).collect()[0][0]
    assert got == expected


def test_climb_score_weighted(spark):
    df = spark.createDataFrame([(55.0, 0.0, 25.0, 0.0), (75.0, 0.0, 25.0, 0.0)], "t double, p double, w double, h double")
    got = [r[0] for r in df.select(F.round(climb_score("t", "p", "w", "h", variant="weighted"), 6)).collect()]
    assert got == [100.0, 70.0]


def test_hierarchy_arrays(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b"],), (None,)], "anc array<string>")
    assert [r[0] for r in df.select(parent_of("anc")).collect()] == [None, None, "a", None]
    df2 = spark.createDataFrame([([],), (["c"],), (["c", "r", "x"],)], "p array<string>")
    got = [tuple(r) for r in df2.select(safe_get("p", 0), safe_get("p", 1)).collect()]
    assert got == [(None, None), ("c", None), ("c", "r")]


def test_normalize_article(spark):
    df = spark.createDataFrame([("Gorge, The",), ("The Gorge",), ("gorge, the",), ("X, The Y",), (None,)], "n string")
    got = [r[0] for r in df.select(normalize_article("n")).collect()]
    assert got == ["The Gorge", "The Gorge", "gorge, the", "X, The Y", None]


def test_json_scalar(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}, "c": null, "d": 5, "e": [1], "f": "[Patchy] fog", "g": "[1]", '
                                 '"h": "{x}", "i": 1.5, "j": true, "k": ""}',)], "j string")
    names = "acdefghijkm"
    df = df.select(F.from_json("j", ", ".join(f"{n} variant" for n in names)).alias("s"))
    got = df.select(*(json_scalar(f"s.{n}") for n in names)).collect()[0]
    assert tuple(got) == (None, None, "5", None, "[Patchy] fog", "[1]", "{x}", "1.5", "true", "", None)


SQUARE = '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}'
NOTCH = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[2,1],[0,4],[0,0]]]}'


@pytest.mark.parametrize("geo,x,y,expected", [
    (SQUARE, 1.0, 1.0, True),      # inside
    (SQUARE, 3.0, 1.0, False),     # outside
    (SQUARE, 2.0, 1.0, False),     # on edge
    (SQUARE, 0.0, 0.0, False),     # on vertex
    (SQUARE, None, 1.0, False),    # NULL coordinate
    (NOTCH, 2.0, 2.0, False),      # concave notch
    (NOTCH, 1.0, 0.5, True),
    (NOTCH, 3.0, 1.0, True),
    (NOTCH, 2.0, 1.0, False),      # notch vertex
])
def test_point_in_polygon(spark, geo, x, y, expected):
    df = spark.createDataFrame([(geo, x, y)], "g string, x double, y double").select(
        rings_from_geojson("g").alias("r"), "x", "y")
    df = df.select("*", edges("r").alias("e"), bbox("r").alias("b"), is_axis_rectangle("r").alias("rect"))
    row = df.select(point_in_polygon("e", "b", "rect", "x", "y"), point_in_rings("r", "x", "y")).collect()[0]
    assert row[0] == expected
    assert row[1] == expected


def test_unclosed_ring_is_repaired(spark):
    geo = '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2]]]}'
    df = spark.createDataFrame([(geo,)], "g string").select(rings_from_geojson("g").alias("r"))
    r = df.collect()[0][0]
    assert r[0][0] == r[0][-1]
    df = df.select("*", F.lit(1.0).alias("x"), F.lit(1.0).alias("y"))
    assert df.select(point_in_rings("r", "x", "y")).collect()[0][0] is True


@pytest.mark.parametrize("x,y,expected", [
    (0.5, 0.5, True),    # first part
    (5.5, 5.5, True),    # second part
    (4.0, 4.0, False),   # between the parts
    (1.5, 1.5, False),   # inside the hole of the first part
])
def test_multipolygon_and_hole(spark, x, y, expected):
    geo = ('{"type":"MultiPolygon","coordinates":['
           '[[[0,0],[3,0],[3,3],[0,3],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]],'
           '[[[5,5],[6,5],[6,6],[5,6],[5,5]]]]}')
    df = spark.createDataFrame([(geo, x, y)], "g string, x double, y double").select(
        rings_from_geojson("g").alias("r"), "x", "y")
    assert df.select(point_in_rings("r", "x", "y")).collect()[0][0] == expected
    assert df.select(F.size("r")).collect()[0][0] == 3
