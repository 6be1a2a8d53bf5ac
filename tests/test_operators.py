"""Property layer: bucketed spatial join equals a brute-force nested loop on
a small fixture, newest-per-key is unique and picks the newest, checks
return zero rows on good data and the planted rows on bad data, the read
queries keep their edge cases."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from sf_paths import SF001
from ridgeline.functions.geo import point_in_rings, rings_from_geojson
from ridgeline.operators import checks, forecast, serve, snapshots, spatial, staging
from ridgeline.plans import bindings as B
from ridgeline.plans import catalog as C


def _poly(pts):
    ring = ",".join(f"[{x},{y}]" for x, y in pts + [pts[0]])
    return '{"type":"Polygon","coordinates":[[' + ring + "]]}"


def test_bucketed_join_equals_brute_force(spark):
    rnd = random.Random(7)
    polys = []
    for i in range(30):
        x, y = rnd.uniform(-5, 5), rnd.uniform(-5, 5)
        w, h = rnd.uniform(0.2, 2.5), rnd.uniform(0.2, 2.5)
        # skewed quads and a concave notch, plus exact squares
        if i % 3 == 0:
            pts = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        elif i % 3 == 1:
            pts = [(x, y), (x + w, y + 0.1), (x + w + 0.2, y + h), (x + 0.1, y + h - 0.1)]
        else:
            pts = [(x, y), (x + w, y), (x + w, y + h), (x + w / 2, y + h / 3), (x, y + h)]
        polys.append((i, _poly(pts)))
    points = [(f"p{j}", rnd.uniform(-6, 6), rnd.uniform(-6, 6)) for j in range(400)]
    points += [("null_x", None, 1.0), ("edge", polys[0][1] and None, None)]
    pdf = spark.createDataFrame(polys, "pid int, geo_json string")
    ptdf = spark.createDataFrame(points, "area_id string, longitude double, latitude double")

    polygons = spatial.polygons_from_geojson(pdf, distinct=False, keep=("pid",))
    # levels found by a job, or named beforehand (with some that are not used)
    for levels in (None, range(-6, 4)):
        got = spatial.spatial_join(ptdf, polygons, levels=levels).select("area_id", "pid")
        got_salted = spatial.spatial_join(ptdf, polygons, levels=levels, salt=4).select("area_id", "pid")
        # brute force: every pair, the plain ray cast (test fixture only)
        brute = (ptdf.crossJoin(pdf).select("*", rings_from_geojson("geo_json").alias("r"))
                     .filter(point_in_rings("r", "longitude", "latitude"))
                     .select("area_id", "pid"))
        a = sorted(map(tuple, got.collect()))
        assert a == sorted(map(tuple, brute.collect()))
        assert a == sorted(map(tuple, got_salted.collect()))
    assert len(a) > 20


def test_latest_per_key_unique_and_newest(spark):
    rows = [("k1", "2024-01-01T01:00:00+00:00", dt.datetime(2024, 1, 1, 2), 1.0),
            ("k1", "2024-01-01T02:00:00+00:00", dt.datetime(2024, 1, 1, 3), 2.0),
            ("k2", "2024-01-01T02:00:00+00:00", dt.datetime(2024, 1, 1, 3), 3.0),
            ("k2", "2024-01-01T02:00:00+00:00", dt.datetime(2024, 1, 1, 3), 4.0),  # exact tie
            ("k3", None, dt.datetime(2024, 1, 1, 3), 5.0),
            ("k3", "2024-01-01T00:00:00+00:00", dt.datetime(2024, 1, 1, 1), 6.0)]
    df = spark.createDataFrame(rows, "key string, generated_at string, extracted_at_ts timestamp, v double")
    out = {r["key"]: r for r in snapshots.latest_per_key(df, ["key"]).collect()}
    assert len(out) == 3
    assert out["k1"]["v"] == 2.0
    assert out["k2"]["v"] in (3.0, 4.0)
    assert out["k3"]["v"] == 6.0  # NULL generated_at sorts last
    again = {r["key"]: r["v"] for r in snapshots.latest_per_key(df.repartition(3), ["key"]).collect()}
    assert again["k2"] == out["k2"]["v"]  # deterministic tie-break


def test_checks_zero_on_good_planted_on_bad(spark):
    good = C.stg_areas(spark, SF001)
    expr = F.try_element_at("ancestors", F.lit(-1)) == F.col("id")
    assert checks.check_expression(good, expr).count() == 0
    bad = C.stg_areas(spark, SF001, plant_bad=True)
    failing = [r["id"] for r in checks.check_expression(bad, expr).collect()]
    assert failing and all(int(i[1:]) % 83 == 0 for i in failing)
    s = C.stg(spark, SF001)
    assert checks.check_not_null(s, ["start_time", "temperature_value"]).count() == 0
    hourly = C.hourly(spark, SF001)
    assert checks.check_unique(hourly, ["area_id", "start_time"]).count() == 0
    assert checks.check_not_null(hourly, ["area_id", "start_time"]).count() == 0


def test_null_expression_passes_unless_flagged(spark):
    df = spark.createDataFrame([("a", None), ("b", ["x", "b"]), ("c", ["c", "x"])], "id string, anc array<string>")
    expr = F.try_element_at("anc", F.lit(-1)) == F.col("id")
    assert sorted(r["id"] for r in checks.check_expression(df, expr).collect()) == ["c"]
    assert sorted(r["id"] for r in checks.check_expression(df, expr, null_fails=True).collect()) == ["a", "c"]


def test_recent_is_strict(spark):
    as_of = F.lit("2024-01-15 12:00:00").cast("timestamp")
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 15, 11)), ("a", dt.datetime(2024, 1, 15, 11, 0, 1))],
                               "area_id string, start_time timestamp")
    got = serve.recent(df, as_of).collect()
    assert [r["start_time"].second for r in got] == [1]


def test_series_empty_area_gets_six_empty_series(spark):
    fact = C.fact(spark, SF001)
    ids = spark.createDataFrame([("R0",), ("nope",)], "area_id string")
    out = serve.series_for_areas(fact, B.as_of(), ids).collect()
    assert len(out) == 12
    assert all(r["points"] == [] and r["unit"] is None for r in out)
    assert sorted({(r["metric"], r["label"]) for r in out}) == sorted({(m, lbl) for m, lbl, _, _ in serve.METRICS})


def test_area_card_unknown_and_leaf(spark):
    d = C.dim(spark, SF001)
    assert serve.area_card(d, "does-not-exist").count() == 0
    leaf = serve.area_card(d, "C1").collect()
    assert len(leaf) == 1 and leaf[0]["child_id"] is None
    kids = serve.area_card(d, "N1").collect()
    names = [r["child_name"] for r in kids]
    assert names == sorted(names) and len(names) > 1


def test_start_time_offset_normalizes_to_utc(spark):
    df = spark.createDataFrame([("2026-07-13T15:00:00-07:00",)], "s string")
    assert df.select(F.col("s").cast("timestamp")).collect()[0][0] == dt.datetime(2026, 7, 13, 22, 0)


def test_hourly_by_area_overlapping_polygons_matches_brute_force(spark):
    """Areas inside two polygons: the newest snapshot across both wins."""
    import datetime as _dt

    from pyspark.sql import Window

    from ridgeline import schemas
    from ridgeline.operators import forecast

    sq = {"A": _poly([(0, 0), (2, 0), (2, 2), (0, 2)]), "B": _poly([(1, 1), (3, 1), (3, 3), (1, 3)])}
    h1, h2 = _dt.datetime(2024, 1, 1, 6), _dt.datetime(2024, 1, 1, 7)
    rows = [("A", h1, "2024-01-01T01:00:00+00:00", 10.0), ("A", h2, "2024-01-01T01:00:00+00:00", 11.0),
            ("A", h1, "2024-01-01T00:30:00+00:00", 9.0), ("B", h1, "2024-01-01T02:00:00+00:00", 20.0),
            ("B", h2, "2024-01-01T00:00:00+00:00", 21.0)]
    cols = schemas.STG_FORECAST_COLUMNS
    data = []
    for p, st, gen, temp in rows:
        r = dict.fromkeys(cols)
        r.update(geo_json=sq[p], start_time=st, generated_at=gen, temperature_value=temp,
                 extracted_at_ts=_dt.datetime(2024, 1, 1, 3))
        data.append(tuple(r[c] for c in cols))
    ddl = ", ".join(f"{c} {'timestamp' if c in ('start_time', 'end_time', 'extracted_at_ts') else 'double' if c.endswith(('_value', '_low', '_high')) else 'string'}" for c in cols)
    stg = spark.createDataFrame(data, ddl)
    areas = spark.createDataFrame([("a1", 1.5, 1.5), ("a2", 0.5, 0.5), ("a3", 2.5, 2.5), ("a4", 5.0, 5.0)],
                                  "id string, longitude double, latitude double")
    got = forecast.forecast_hourly_by_area(stg, areas)
    got = sorted((r["area_id"], r["start_time"].hour, r["temperature_value"]) for r in got.collect())
    # brute force: containment on every row, then newest per (area, hour)
    brute = (areas.crossJoin(stg).select("*", rings_from_geojson("geo_json").alias("r"))
                  .filter(point_in_rings("r", "longitude", "latitude"))
                  .withColumn("rn", F.row_number().over(Window.partitionBy("id", "start_time")
                                                        .orderBy(F.col("generated_at").desc())))
                  .filter("rn = 1"))
    want = sorted((r["id"], r["start_time"].hour, r["temperature_value"]) for r in brute.collect())
    assert got == want
    assert got == [("a1", 6, 20.0), ("a1", 7, 11.0), ("a2", 6, 10.0), ("a2", 7, 11.0), ("a3", 6, 20.0), ("a3", 7, 21.0)]
    # per-polygon rollup, including the multi-polygon area a1, equals the
    # aggregate of the hourly rows
    stg = stg.fillna({"relative_humidity_value": 30.0, "wind_speed_high": 10.0})
    daily = forecast.daily_score_by_area(stg, areas)
    plain = forecast.daily_score(forecast.fact_hourly(forecast.forecast_hourly_by_area(stg, areas)))
    cols = ["area_id", "day", "avg_score", "min_score", "max_score", "n_hours", "n_scored"]
    a = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in daily.select(*cols).collect())
    b = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in plain.select(*cols).collect())
    assert a == b and len(a) == 3
    as_of = F.lit("2024-01-01 00:00:00").cast("timestamp")
    fact = forecast.fact_hourly(forecast.forecast_hourly_by_area(stg, areas))
    x = serve.series_digest(serve.series_nested_by_area(stg, areas, as_of))
    y = serve.series_digest(serve.series_nested(fact, as_of))
    assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.select(*x.columns).collect()))
    assert x.filter("area_id = 'a1'").count() == 6


def test_check_unique_by_area_equals_plain_check(spark):
    s = C.stg(spark, SF001)
    bridge = spatial.area_cells(C.dim(spark, SF001), s)
    s = spatial.keyed_by_cell(s)
    plain = checks.check_unique(spatial.forecast_by_area(s, bridge), ["area_id", "start_time"])
    fast = checks.check_unique_by_area(s, bridge, ["start_time"])
    a = sorted(map(tuple, plain.select("area_id", "start_time", "n_rows").collect()))
    assert a and a == sorted(map(tuple, fast.select("area_id", "start_time", "n_rows").collect()))


def test_rollups_before_fanout_equal_fact_aggregates(spark):
    from ridgeline.operators import forecast

    s, d = C.stg(spark, SF001), C.dim(spark, SF001)
    f = C.fact(spark, SF001)

    def rows(df, cols):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())

    dcols = ["area_id", "day", "avg_score", "min_score", "max_score", "n_hours", "n_scored"]
    assert rows(forecast.daily_score_by_area(s, d), dcols) == rows(forecast.daily_score(f), dcols)
    wcols = ["weekend", "parent_id", "rank", "area_id", "avg_score", "n_hours"]
    assert rows(forecast.weekend_ranking_by_area(s, d), wcols) == rows(forecast.weekend_ranking(f, d), wcols)


def test_series_by_polygon_equals_series_from_fact(spark):
    s, d = C.stg(spark, SF001), C.dim(spark, SF001)
    a = serve.series_digest(serve.series_nested_by_area(s, d, B.as_of()))
    b = serve.series_digest(serve.series_nested(C.fact(spark, SF001), B.as_of()))
    ra, rb = sorted(map(tuple, a.collect())), sorted(map(tuple, b.select(*a.columns).collect()))
    assert ra and ra == rb


def test_standardize_units_f_to_c_and_kmh_to_mph(spark):
    from ridgeline.functions import parse_wind
    from ridgeline.operators import forecast

    df = spark.createDataFrame([(212.0, "F", "16.09344 km/h"), (20.0, "C", "10 mph"), (None, "F", None)],
                               "temperature_value double, temperature_unit string, wind string")
    w = df.select("*", parse_wind("wind").alias("w")).select(
        "temperature_value", "temperature_unit", F.col("w.low").alias("wind_speed_low"),
        F.col("w.high").alias("wind_speed_high"), F.col("w.unit").alias("wind_speed_unit"))
    got = [tuple(r) for r in forecast.standardize_units(w).collect()]
    assert got[0][0] == 100.0 and got[0][1] == "C" and got[0][4] == "mph"
    assert abs(got[0][2] - 16 / 1.609344) < 1e-9 and abs(got[0][3] - 9344 / 1.609344) < 1e-6
    assert got[1] == (20.0, "C", 10.0, 10.0, "mph")
    assert got[2][0] is None and got[2][1] == "C"


def test_target_areas_list_and_dataframe_forms_agree(spark):
    from ridgeline.operators import hierarchy

    d = C.dim(spark, SF001)
    by_list = hierarchy.target_areas(d, ["N1", "N2"])
    by_df = hierarchy.target_areas(d, spark.createDataFrame([("N1",), ("N2",)], "parent string"))
    a = sorted(map(tuple, by_list.collect()))
    assert a and a == sorted(map(tuple, by_df.collect()))
    # a NULL name and an excluded name are dropped
    extra = spark.createDataFrame([("x1", None, 1.0, 1.0, "N1", "c", "r", True),
                                   ("x2", "Beaches", 1.0, 1.0, "N1", "c", "r", True)], d.schema)
    ids = {r["area_id"] for r in hierarchy.target_areas(d.unionByName(extra), ["N1"]).collect()}
    assert "x1" not in ids and "x2" not in ids


def test_publish_view_and_table(spark):
    from ridgeline.session import scratch_path
    from ridgeline.sources import tables

    d = C.dim(spark, SF001)
    v = tables.publish(d, "dim_area_view", kind="view")
    assert spark.table("dim_area_view").count() == v.count() == d.count()
    t = tables.publish(d, "dim_area_table", kind="table", path=scratch_path(spark, "dim"),
                       partition_by=["country"], sort_within=["id"])
    assert sorted(map(tuple, t.select(*d.columns).collect())) == sorted(map(tuple, d.collect()))


def test_complete_ranking_equals_a_window(spark):
    rng = np.random.default_rng(5)
    wk = spark.createDataFrame([("2024-01-06", f"A{k}", float(rng.integers(0, 40)) / 10 if k % 9 else None, 0.0, 1.0, 2)
                                for k in range(300)],
                               "weekend string, area_id string, avg_score double, min_score double, max_score double, "
                               "n_hours long")
    dim = spark.createDataFrame([(f"A{k}", f"a{k}", "P" if k < 200 else None, True) for k in range(300)],
                                "id string, area_name string, parent_id string, is_leaf boolean")
    got = {r.area_id: r["rank"] for r in forecast.rank_weekends(wk, dim).collect()}
    want = {r.area_id: r["rank"] for r in forecast.rank_weekends(wk, dim, top_k=10 ** 6).collect()}
    assert got == want and len(got) == 300


def test_crags_that_all_tie_are_ranked_in_many_tasks(spark):
    n = 2000
    wk = spark.createDataFrame([("2024-01-06", f"A{k}", 0.5, 0.0, 1.0, 2) for k in range(n)],
                               "weekend string, area_id string, avg_score double, min_score double, max_score double, "
                               "n_hours long")
    dim = spark.createDataFrame([(f"A{k}", f"a{k}", "P", True) for k in range(n)],
                                "id string, area_name string, parent_id string, is_leaf boolean")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = forecast.rank_weekends(wk, dim).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r.area_id for r in sorted(got, key=lambda r: r["rank"])] == sorted(f"A{k}" for k in range(n))
    assert sorted(r["rank"] for r in got) == list(range(1, n + 1))
    assert len({r.task for r in got}) > 2


def test_fan_out_spreads_one_cell_with_a_long_history(spark):
    rows = spark.range(20_000).selectExpr("'c' AS geo_json", "id AS start_time")
    bridge = spark.createDataFrame([("c", f"A{k}") for k in range(3)], "geo_json string, area_id string")
    out = spatial.forecast_by_area(rows, bridge, partitions=16)
    assert out.count() == 60_000
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 8


def test_units_of_wind_and_temperature(spark):
    df = spark.createDataFrame([(50.0, "F", 10.0, 10.0, "mph"), (10.0, "wmoUnit:degC", 16.09344, 16.09344, "km/h"),
                                (1.0, "K", 10.0, 10.0, "m/s"), (32.0, "F", 10.0, 10.0, "mi/h"),
                                (0.0, "C", 5.0, 5.0, "furlong")],
                               "temperature_value double, temperature_unit string, wind_speed_low double, "
                               "wind_speed_high double, wind_speed_unit string")
    got = [(round(r[0], 4), r[1], round(r[3], 4), r[4]) for r in forecast.standardize_units(df).collect()]
    assert got == [(10.0, "C", 10.0, "mph"), (10.0, "C", 10.0, "mph"), (1.0, "K", 22.3694, "mph"),
                   (0.0, "C", 10.0, "mph"), (0.0, "C", 5.0, "furlong")]


def test_every_event_is_staged(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        events = spark.read.parquet(f"{sf}/events.parquet").count()
        assert staging.stage_forecast(B.raw_forecast_docs(spark, sf)).count() == events


def test_overlapping_parts_are_a_union(spark):
    geo = ('{"type":"MultiPolygon","coordinates":[[[[0,0],[3,0],[3,3],[0,3],[0,0]]],'
           '[[[2,2],[5,2],[5,5],[2,5],[2,2]],[[3.5,3.5],[4.5,3.5],[4.5,4.5],[3.5,4.5],[3.5,3.5]]]]}')
    cells = spark.createDataFrame([(geo,)], "geo_json string")
    points = [(1.0, 1.0, True), (2.5, 2.5, True), (4.0, 4.0, False), (4.75, 4.75, True), (4.0, 1.0, False)]
    areas = spark.createDataFrame([(f"A{k}", y, x) for k, (x, y, _) in enumerate(points)],
                                  "id string, latitude double, longitude double")
    got = sorted(r.area_id for r in spatial.area_polygons(areas, cells).collect())
    assert got == [f"A{k}" for k, p in enumerate(points) if p[2]]
