"""The second source, checks while writing, fixed point, nested reads and the
stored side of the by-area join."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sf_paths import SF001
from ridgeline.functions.numeric import climb_score_numeric, nanos, numeric, times
from ridgeline.functions.scoring import ScoreParams
from ridgeline.operators import checks, serve, spatial, staging
from ridgeline.plans import catalog as C
from ridgeline.session import scratch_path


def points(spark, *docs):
    return spark.createDataFrame([("a", json.dumps(d), "2024-01-01 03:00:00") for d in docs],
                                 "area_id string, data string, at string").select(
        "area_id", "data", F.col("at").cast("timestamp").alias("extracted_at_ts"))


def test_point_forecast_arrays(spark):
    doc = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, None]},
           "hourly_units": {"temperature_2m": "°C"}}
    rows = staging.stage_point_forecast(points(spark, doc, {"hourly": None}, {"hourly": {"time": []}})).collect()
    assert [(r.start_time.hour, r.temperature_value, r.temperature_unit, r.dewpoint_value, r.wind_speed_unit) for r in rows] == \
        [(0, 1.5, "°C", None, None), (1, None, "°C", None, None)]
    doc["hourly"]["temperature_2m"] = [1.5]
    with pytest.raises(Exception, match="unlike length"):
        staging.stage_point_forecast(points(spark, doc)).collect()
    assert [r.temperature_value for r in staging.stage_point_forecast(points(spark, doc), strict=False).collect()] == [1.5, None]


def test_checks_are_counted_by_the_write(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (3, None), (4, "z")], "a int, b string")
    rules = checks.required(["a", "b"]) | checks.holds("small", F.col("a") < 4) | checks.holds("strict", F.col("a") < 4, True)
    watched, seen = checks.observed(df, rules)
    watched.write.parquet(scratch_path(spark, "observed"))
    assert seen.get == {"rows": 4, "required:a": 1, "required:b": 1, "expression:small": 1, "expression:strict": 2}
    bad = {r.b: r.rules for r in checks.failing(df, rules).collect()}
    assert bad == {"y": ["required:a", "expression:strict"], None: ["required:b"], "z": ["expression:small", "expression:strict"]}


def test_fixed_point_rounds_halves_away_from_zero(spark):
    df = spark.sql("SELECT 0.000000005 AS a, -0.000000005 AS b, CAST(NULL AS DOUBLE) AS n")
    half = numeric(0.5)
    row = df.select(times(numeric("a"), half).alias("x"), times(numeric("b"), half).alias("y"),
                    nanos(times(numeric("a"), half)).alias("z"), climb_score_numeric("n", "a", "a", "a").alias("s")).first()
    assert (row.x, row.y, row.z, row.s) == (Decimal("0.000000003"), Decimal("-0.000000003"), 3, None)
    df = spark.sql("SELECT 50.0 AS t, 10 AS p, 30 AS w, 59 AS h")
    score = df.select(climb_score_numeric("t", "p", "w", "h", ScoreParams(w_humid=0.5))).first()[0]
    assert score == Decimal("90.108333334")  # 90 + 0.2 * 0.5 + 0.5 * 0.016666667


def test_nested_cards_in_chunks_keep_the_order(spark):
    rows = [("P", "p", None)] + [(f"c{i:03d}", f"n{i % 7}", "P") for i in range(53)] + [(None, "lost", "P"), ("lone", "x", None)]
    dim = spark.createDataFrame(rows, "id string, area_name string, parent_id string").repartition(4)
    cards = serve.area_cards_nested(dim, chunk=10).collect()
    chunks = sorted((c.chunk, [(k.child_name, k.child_id) for k in c.children]) for c in cards if c.id == "P")
    assert all(len(k) <= 10 for _, k in chunks) and [n for n, _ in chunks] == list(range(len(chunks)))
    assert [k for _, part in chunks for k in part] == sorted((n, i) for i, n, p in rows if p == "P" and i)
    assert [c.children for c in cards if c.id in ("lone", "c000")] == [[], []]
    assert serve.area_cards_nested(dim.where("false")).count() == 0


def test_a_line_without_label_has_the_name_of_its_source(spark):
    df = spark.createDataFrame([("low", "nws"), (None, "points"), (None, None)], "label string, source string")
    assert [r[0] for r in df.select(serve.line_name()).collect()] == ["low", "points", None]


def test_the_stored_side_is_not_shuffled(spark):
    s = C.stg(spark, SF001)
    bridge = spatial.area_cells(C.dim(spark, SF001), s).checkpoint()
    path = scratch_path(spark, "stored")
    stored = spatial.store_forecast(s, "stored_" + path[-32:], path, 6)
    joined = spatial.stored_forecast_by_area(stored, bridge, 6)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "Scan parquet" in line or "FileScan" in line]
    assert len(scan) == 1 and "Bucketed: true" in scan[0] and "geo_json" not in plan
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan" in line or "Scan parquet" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789"))
    above = [line for line in lines[:at] if len(line) - len(line.lstrip(" :+-*()0123456789")) < depth]
    # no exchange between the scan and the join
    assert not any("Exchange" in line for line in above)
    assert joined.count() == spatial.forecast_by_area(spatial.keyed_by_cell(s), bridge).count()


def test_two_polygons_with_one_key_fail(spark, monkeypatch):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "geo_json string")
    assert spatial.cell_dictionary(df).count() == 2
    monkeypatch.setattr(spatial.F, "xxhash64", lambda *_: F.lit(1).cast("long"))
    with pytest.raises(Exception, match="one cell key"):
        spatial.cell_dictionary(df).collect()
