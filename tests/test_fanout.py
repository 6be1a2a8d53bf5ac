"""The forms that shuffle what is small: fan-out in the order of areas,
checks per cell, accuracy on observed hours, one pass over staged rows."""

import datetime as dt

from pyspark.sql import functions as F

from sf_paths import SF001
from ridgeline.operators import accuracy, checks, forecast, serve, spatial
from ridgeline.plans import bindings as B
from ridgeline.plans import catalog as C
from ridgeline.session import scratch_path


def _rows(df):
    return sorted(map(str, df.collect()))


def _forecast(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(k, t + dt.timedelta(hours=h), float(h * k)) for k in (1, 2) for h in range(50)] + [(1, None, 5.0)]
    bridge = [(f"a{i:02d}", i % 3) for i in range(20)] + [("a01", 2)]
    return spark.createDataFrame(rows, "cell_key long, start_time timestamp, v double"), \
        spark.createDataFrame(bridge, "area_id string, cell_key long")


def test_few_rows_are_fanned_out_alike_and_by_area(spark):
    rows, bridge = _forecast(spark)
    want = spatial.forecast_by_area(rows, bridge)
    got = spatial.forecast_by_area(rows, bridge, few=True)
    assert got.columns == want.columns and _rows(got) == _rows(want)
    seen = got.withColumn("p", F.spark_partition_id()).groupBy("area_id").agg(F.count_distinct("p").alias("n"))
    assert seen.filter("n > 1").count() == 0
    # what groups by area needs no shuffle of the rows, nor a sort
    plan = got.groupBy("area_id").agg(F.collect_list("v").alias("v"))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ObjectHashAggregate" not in text and text.count("Exchange hashpartitioning(area_id") == 1


def test_rows_spread_by_day_come_in_order(spark):
    rows, bridge = _forecast(spark)
    bridge = bridge.filter("area_id != 'a01'")  # areas of one cell, as in the marts
    want = _rows(spatial.forecast_by_area(rows, bridge))
    for few in (False, True):
        got = spatial.forecast_by_area(rows, bridge, spread_by="to_date(start_time)", few=few)
        assert _rows(got) == want
        place = got.select("*", F.to_date("start_time").alias("d"), F.spark_partition_id().alias("p"),
                           F.pmod(F.xxhash64("area_id"), F.lit(spatial.ROW_SALTS)).alias("b"))
        by = {}
        for r in place.collect():
            by.setdefault((r.p, r.d, r.b if few else 0), []).append((r.area_id, r.start_time or dt.datetime.min))
        assert all(x == sorted(x) for x in by.values())


def test_check_by_area_sums_only_areas_of_several_cells(spark):
    rows, bridge = _forecast(spark)
    rows = rows.union(rows.filter("cell_key = 1 AND v < 3"))
    want = _rows(checks.check_unique(spatial.forecast_by_area(rows, bridge), ["area_id", "start_time"]))
    assert want and _rows(checks.check_unique_by_area(rows, bridge)) == want
    counted = checks.counted(rows, ["cell_key", "start_time"])
    assert _rows(checks.check_unique_by_area(counted, bridge, n_rows="n_rows")) == want


def test_accuracy_on_observed_hours_is_that_on_all(spark):
    a, d = accuracy.stage_actuals(B.raw_actuals(spark, SF001)), C.dim(spark, SF001)
    s = C.stg(spark, SF001, B.SOURCE_A_TYPES)
    bridge = spatial.area_cells(d, s)
    every = spatial.forecast_by_area(spatial.keyed_by_cell(s), bridge)
    want = accuracy.forecast_accuracy(accuracy.forecast_union({"a": every}), a, d)
    met = C._all_snapshots(s, accuracy.observed_areas(d, a), accuracy.observed_hours(a, d))
    got = accuracy.forecast_accuracy(accuracy.forecast_union({"a": met}))
    cols = ["horizon_h", "region", F.round("mae", 6), "n_pairs"]
    assert _rows(got.select(*cols)) == _rows(want.select(*cols)) and met.count() < every.count()


def test_series_of_an_area_without_rows_is_empty(spark):
    fact = spark.createDataFrame(
        [("a", B.AS_OF, 1.0)], "area_id string, start_time string, temperature_value double").selectExpr(
        "area_id", "CAST(start_time AS TIMESTAMP) AS start_time", "temperature_value", *(
            f"CAST(NULL AS DOUBLE) AS {c}" for c in ("wind_speed_low", "wind_speed_high", "precipitation_probability_value",
                                                     "relative_humidity_value", "dewpoint_value")),
        *(f"'u' AS {c}" for c in ("temperature_unit", "wind_speed_unit", "precipitation_probability_unit",
                                  "relative_humidity_unit", "dewpoint_unit")))
    ids = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "area_id string")
    out = serve.series_for_areas(fact, B.as_of(), ids).selectExpr("area_id", "unit", "size(points) AS n", "source").collect()
    assert len(out) == 18 and {(r.area_id, r.unit, r.n, r.source) for r in out} == {
        ("a", "u", 1, "nws"), ("b", None, 0, "nws"), (None, None, 0, "nws")}


def test_two_texts_with_one_key_both_stay(spark, monkeypatch):
    s = C.stg(spark, SF001)
    rows, few = forecast.newest_by_cell(s)
    assert few and rows.count() == s.select("geo_json", "start_time").distinct().count()
    monkeypatch.setattr(forecast, "FEW_ROWS", 1)
    assert not forecast.newest_by_cell(s)[1]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_made_in_all_partitions(spark):
    docs = B.raw_forecast_docs(spark, SF001)
    assert docs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_days_of_few_rows_are_broadcast_to_areas(spark):
    d = forecast.daily_score_by_area(C.stg(spark, SF001), C.dim(spark, SF001))
    assert "_row_salt" not in _plan(d) and "BroadcastHashJoin" in _plan(d)


def test_series_by_metric_per_polygon_are_those_of_the_fact(spark):
    want = C._metric_digest(serve.series_by_metric(C.fact(spark, SF001), B.as_of()))
    got = serve.series_by_metric_by_area(C.stg(spark, SF001), C.dim(spark, SF001), B.as_of(), each=C._metric_digest)
    assert got.columns == want.columns and got.count() and _rows(got) == _rows(want)
    # the query groups hours by polygon, not by area
    plan = _plan(C.q_series_by_metric(spark, SF001))
    lists = [line for line in plan.splitlines() if "collect_list" in line]
    assert lists and all("keys=[cell_key" in line for line in lists)


def test_doubled_hours_are_fanned_out_once(spark):
    assert "Union" not in _plan(C.q_check_unique_fact(spark, SF001))


def test_rows_along_the_curve_are_placed_before_the_fan_out(spark):
    t = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(k, t + dt.timedelta(hours=h), float(h * k)) for k in (1, 2) for h in range(300)]
                                 + [(1, None, 5.0), (1, t, 0.0), (3, t, 1.0)], "cell_key long, start_time timestamp, v double")
    bridge = spark.createDataFrame([(f"a{i:03d}", 1 + i % 2) for i in range(400)] + [("a000", 1), (None, 2), ("x", 9)],
                                   "area_id string, cell_key long")
    got = spatial.forecast_by_area_clustered(rows, bridge, 16)
    want = spatial.forecast_by_area(rows, bridge)
    assert got.columns == want.columns and _rows(got) == _rows(want)
    placed = got.withColumn("p", F.spark_partition_id()).checkpoint()
    assert placed.select("p").distinct().count() == 16
    sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
    assert max(sizes) < 2 * sum(sizes) / 16
    for c in ("area_id", "start_time"):
        files = placed.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count_distinct("p").alias("n"))
        assert files.agg(F.avg("n")).first()[0] <= 0.4 * 16
    # no wide row is shuffled after the fan-out
    assert "Exchange" not in _plan(got).split("Generate inline")[0]
    assert spatial.forecast_by_area_clustered(rows.where("false"), bridge, 4).count() == 0


def test_clustered_fact_is_the_fact(spark, monkeypatch):
    s, d = C.stg(spark, SF001), C.dim(spark, SF001)
    want = _rows(forecast.fact_hourly_by_area(s, d))
    assert _rows(forecast.fact_clustered_by_area(s, d, 5)) == want
    monkeypatch.setattr(forecast, "FEW_ROWS", 1)
    assert _rows(forecast.fact_clustered_by_area(s, d, 5)) == want


def _shuffled(plan):
    """Rows written to the shuffles of a plan that has run."""
    own = plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(_shuffled(plan.children().apply(i)) for i in range(plan.children().size()))


def _crowded(spark, n_rows, n_areas):
    """One cell with many areas, two of them alike and one without an id."""
    rows = spark.range(n_rows).selectExpr("'c' AS geo_json", "id AS start_time")
    bridge = spark.range(n_areas).selectExpr("'c' AS geo_json", "CASE WHEN id > 1 THEN concat('A', id) WHEN id = 1 THEN 'A2' END AS area_id")
    return rows, bridge


def _areas_seen_first(df, n):
    """The most areas among the first ``n`` rows of a task."""
    at = df.select("area_id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("i"))
    return max(r.n for r in at.filter(F.col("i") < n).groupBy("p").agg(F.count_distinct("area_id").alias("n")).collect())


def test_rows_are_not_shuffled_for_every_list_of_areas(spark):
    rows, bridge = _crowded(spark, 400, 5000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = spatial.forecast_by_area(rows, bridge.union(bridge.limit(0)), partitions=16)
        assert out.count() == 400 * 5000
        run = out._jdf.queryExecution()
        run.toRdd().count()
        assert 400 < _shuffled(run.executedPlan()) < 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert out.filter("area_id IS NULL").count() == 400 and out.filter("area_id = 'A2'").count() == 800
    assert _areas_seen_first(out, 1000) < 800


def test_the_stored_join_comes_list_by_list(spark):
    rows, bridge = _crowded(spark, 320, 3000)
    path = scratch_path(spark, "stored")
    stored = spatial.store_forecast(rows, "stored_" + path[-32:], path, 4)
    out = spatial.stored_forecast_by_area(stored, spatial.keyed_by_cell(bridge), 4)
    assert out.columns == ["start_time", "cell_key", "area_id"]
    want = rows.crossJoin(bridge.select("area_id")).select("start_time", "area_id")
    got = out.select("start_time", "area_id")
    assert got.count() == 320 * 3000 and got.exceptAll(want).count() == 0
    assert _areas_seen_first(out, 1000) < 800
