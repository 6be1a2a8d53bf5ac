"""Landing round trips and batch/stream equality."""

import json

import pytest
from pyspark.sql import functions as F

from sf_paths import SF001
from ridgeline.operators import snapshots, staging
from ridgeline.plans import bindings as B
from ridgeline.session import scratch_path
from ridgeline.sources import landing, tables, versioned
from ridgeline.streaming import ingest, run_forecast_stream

COLS = ["geo_json", "start_time", "generated_at", "temperature_value", "wind_speed_high"]


def test_periods_missing_null_empty_give_no_rows(spark):
    docs = ['{"properties":{"generatedAt":"x"}}', '{"properties":{"periods":null}}',
            '{"properties":{"periods":[]}}', None]
    raw = spark.createDataFrame([(d,) for d in docs], "data string").withColumn(
        "extracted_at_ts", F.current_timestamp())
    assert staging.stage_forecast(raw).count() == 0


def test_fixture_sample_document(spark):
    doc = ('{"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]]]},"properties":'
           '{"generatedAt":"2024-01-01T00:00:00+00:00","validTimes":"2024-01-01T00:00:00+00:00/P1D",'
           '"elevation":{"unitCode":"wmoUnit:m","value":10.5},"periods":[{"startTime":"2024-01-01T06:00:00+00:00",'
           '"endTime":"2024-01-01T07:00:00+00:00","temperature":55,"temperatureUnit":"F",'
           '"probabilityOfPrecipitation":{"unitCode":"wmoUnit:percent","value":null},'
           '"dewpoint":{"unitCode":"wmoUnit:degC","value":4.5},"relativeHumidity":{"unitCode":"wmoUnit:percent",'
           '"value":30},"windSpeed":"10 to 15 mph","windDirection":"NW","shortForecast":"Sunny"}]}}')
    raw = spark.createDataFrame([(doc,)], "data string").withColumn(
        "extracted_at_ts", F.lit("2024-01-01 01:00:00").cast("timestamp"))
    r = staging.stage_forecast(raw).collect()[0]
    assert r["geo_json"] == '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]]]}'
    assert (r["temperature_value"], r["precipitation_probability_value"], r["dewpoint_value"]) == (55.0, None, 4.5)
    assert (r["wind_speed_low"], r["wind_speed_high"], r["wind_speed_unit"]) == (10.0, 15.0, "mph")
    assert r["elevation_value"] == 10.5 and r["short_forecast"] == "Sunny"


def test_envelope_keeps_payload_text(spark):
    base = scratch_path(spark, "t-landing")
    raw = B.raw_forecast_docs(spark, SF001)
    env = landing.stamp_envelope(raw, "data", F.col("extracted_at_ts"))
    landing.write_landing(env, base, "nws", "ingest_nws_hourly_forecast", "r1")
    back = landing.read_forecast_landing(spark, base, run_ts="r1")
    # the envelope's time format has whole seconds
    want = raw.select("data", F.date_trunc("second", "extracted_at_ts"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))


def test_latest_run_only(spark):
    base = scratch_path(spark, "t-areas")
    raw = B.raw_areas(spark, SF001)
    landing.write_landing(raw, base, "graph_ql", "ingest_graphql_areas", "2024", json_cols=["children", "metadata"])
    landing.write_landing(raw, base, "graph_ql", "ingest_graphql_areas", "2023", json_cols=["children", "metadata"])
    n = raw.count()
    assert landing.read_area_landing(spark, base, latest_only=True).count() == n
    assert landing.read_area_landing(spark, base, latest_only=False).count() == 2 * n


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    base = scratch_path(spark, "t-stream")
    raw = B.raw_forecast_docs(spark, SF001)
    # two runs, the second re-lands a slice of the first (a replayed load)
    landing.write_landing(raw, base, "nws", "ingest_nws_hourly_forecast", "r1", json_cols=["data"])
    landing.write_landing(raw.filter(F.hour("extracted_at_ts") < 6), base, "nws", "ingest_nws_hourly_forecast",
                          "r2", json_cols=["data"])
    table, ckpt = scratch_path(spark, "t-table"), scratch_path(spark, "t-ckpt")
    run_forecast_stream(spark, base, table, ckpt)
    streamed = tables.read_table(spark, table).select(*COLS)
    batch = snapshots.latest_per_key(staging.stage_forecast(raw), ["geo_json", "start_time"]).select(*COLS)
    a = sorted(map(tuple, streamed.collect()))
    assert a == sorted(map(tuple, batch.collect()))
    # a new run arrives later: only new files are read, the table stays right
    landing.write_landing(raw, base, "nws", "ingest_nws_hourly_forecast", "r3", json_cols=["data"])
    run_forecast_stream(spark, base, table, ckpt)
    assert sorted(map(tuple, tables.read_table(spark, table).select(*COLS).collect())) == a


def _one_doc(hour, generated, temp):
    return json.dumps({"geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]},
                       "properties": {"generatedAt": generated, "periods": [
                           {"startTime": hour, "endTime": hour, "temperature": temp, "windSpeed": "5 mph",
                            "shortForecast": "[Patchy] fog"}]}})


@pytest.mark.parametrize("form", ["upsert", "state"])
def test_stream_adds_late_documents_and_survives_a_repeat(spark, form):
    """A run that is ten days older than the table still adds its hours, a
    newer snapshot replaces an hour, an older one does not, and landing a run
    again changes nothing."""
    base, table, ckpt = (scratch_path(spark, n) for n in ("late-landing", "late-table", "late-ckpt"))
    runs = [("r1", [("2024-01-20T05:00:00Z", "2024-01-20T00:00:00Z", 50)]),
            ("r2", [("2024-01-10T05:00:00Z", "2024-01-10T00:00:00Z", 40)]),
            ("r3", [("2024-01-20T05:00:00Z", "2024-01-20T01:00:00Z", 55),
                    ("2024-01-10T05:00:00Z", "2024-01-09T00:00:00Z", 1)]),
            ("r4", [("2024-01-20T05:00:00Z", "2024-01-20T00:00:00Z", 50)])]
    for run, docs in runs:
        rows = [(_one_doc(*d), d[1]) for d in docs]
        df = spark.createDataFrame(rows, "data string, at string").select(
            "data", F.col("at").cast("timestamp").alias("extracted_at_ts"))
        landing.write_landing(df, base, "nws", "ingest_nws_hourly_forecast", run, json_cols=["data"])
        ingest.run_forecast_stream(spark, base, table, ckpt, form=form)
    read = ingest.read_newest if form == "state" else tables.read_table
    got = read(spark, table).orderBy("start_time").collect()
    assert [(str(r.start_time), r.temperature_value) for r in got] == [
        ("2024-01-10 05:00:00", 40.0), ("2024-01-20 05:00:00", 55.0)]
    assert {r.short_forecast for r in got} == {"[Patchy] fog"}
    if form == "state":  # a batch appends what it touched; older days keep their files
        assert len(versioned.current(spark, table).loads()) == len(runs)
        snapshots.compact(table, spark, ingest.KEYS, ["start_day"])
        assert read(spark, table).orderBy("start_time").collect() == got
        assert len(versioned.current(spark, table).loads()) == 1


def test_upsert_reads_the_touched_partitions_only(spark):
    path = scratch_path(spark, "upsert-table")

    def rows(*r):
        return spark.createDataFrame(r, "k long, day string, generated_at string, extracted_at_ts string, v long") \
            .select("k", F.col("day").cast("date"), "generated_at", F.col("extracted_at_ts").cast("timestamp"), "v")

    snapshots.upsert_partitions(path, rows((1, "2024-01-01", "2024-01-01", "2024-01-01", 1),
                                           (2, "2024-01-02", "2024-01-01", "2024-01-01", 1)), ["k", "day"], "day")
    before = {f for f in tables.read_table(spark, path).inputFiles() if "2024-01-01" in f}
    for _ in range(2):
        snapshots.upsert_partitions(path, rows((2, "2024-01-02", "2024-01-03", "2024-01-03", 2),
                                               (3, "2024-01-02", "2024-01-03", "2024-01-03", 3)), ["k", "day"], "day")
        got = tables.read_table(spark, path)
        assert sorted((r.k, r.v) for r in got.collect()) == [(1, 1), (2, 2), (3, 3)]
        assert before == {f for f in got.inputFiles() if "2024-01-01" in f}


def test_newest_run_is_found_by_folder_name(spark):
    base = scratch_path(spark, "runs")
    for run in ("20240101T000000", "20240103T000000", "20240102T000000"):
        landing.write_landing(spark.createDataFrame([(run,)], "areaName string"), base, "graph_ql",
                              "ingest_graphql_countries", run)
    df = landing.read_country_landing(spark, base)
    assert [r.areaName for r in df.collect()] == ["20240103T000000"]
    assert all("run_ts=20240103T000000" in f for f in df.inputFiles())


def test_malformed_json_fails_when_strict(spark):
    bad = spark.createDataFrame([('{"data": {"areas": [{"uuid": "x"',)], "page string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        landing.flatten_pages(bad, "areas", "uuid:string").collect()
    assert landing.flatten_pages(bad, "areas", "uuid:string", strict=False).collect() == []
    doc = spark.createDataFrame([('{"geometry": ', None)], "data string, extracted_at_ts timestamp")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        staging.stage_forecast(doc).collect()


def test_records_embed_payloads_with_any_text(spark):
    df = spark.createDataFrame([("@@ridgeline-json-1@@", '{"x":"@@ridgeline-json-0@@"}', None)],
                               "a string, b string, c string")
    line = landing.to_records(df, json_cols=["b", "c"]).first().value
    assert json.loads(line) == {"a": "@@ridgeline-json-1@@", "b": {"x": "@@ridgeline-json-0@@"}, "c": None}
