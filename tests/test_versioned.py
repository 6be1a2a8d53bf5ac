"""Loads that become visible at once, also when their job dies on the way."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ridgeline.operators import snapshots
from ridgeline.session import child_names, scratch_path
from ridgeline.sources import tables, versioned


def rows(spark, *r):
    return spark.createDataFrame(r, "k long, day string, generated_at string, extracted_at_ts string, v long").select(
        "k", F.col("day").cast("date"), "generated_at", F.col("extracted_at_ts").cast("timestamp"), "v")


OLD = [(1, "2024-01-01", "2024-01-01", "2024-01-01", 1), (2, "2024-01-02", "2024-01-01", "2024-01-01", 1),
       (3, "2024-01-02", "2024-01-01", "2024-01-01", 1), (4, "2024-01-03", "2024-01-01", "2024-01-01", 1)]
NEW = [(2, "2024-01-02", "2024-01-02", "2024-01-02", 2), (4, "2024-01-03", "2024-01-02", "2024-01-02", 2)]


def held(spark, path):
    return sorted((r.k, r.v) for r in tables.read_table(spark, path).collect())


def stored(spark):
    path = scratch_path(spark, "versioned")
    snapshots.upsert_partitions(path, rows(spark, *OLD), ["k", "day"], "day")
    return path


def test_a_job_that_dies_between_two_partitions_loses_nothing(spark):
    path = stored(spark)
    broken = rows(spark, *NEW).withColumn("v", F.when(F.col("day") == "2024-01-03", F.raise_error(F.lit("killed")).cast("long"))
                                          .otherwise(F.col("v")))
    before = held(spark, path)
    with pytest.raises(Exception, match="killed"):
        # the second day's rows kill the job after the first day may have been written
        versioned.load(broken.coalesce(1).sortWithinPartitions("day"), path, ["day"], mode="partitions")
    assert held(spark, path) == before
    snapshots.upsert_partitions(path, rows(spark, *NEW), ["k", "day"], "day")
    assert held(spark, path) == [(1, 1), (2, 2), (3, 1), (4, 2)]


def test_a_driver_that_dies_before_or_in_the_manifest_loses_nothing(spark, monkeypatch):
    path = stored(spark)
    before = held(spark, path)
    with monkeypatch.context() as m:
        def die(*_):
            raise KeyboardInterrupt
        m.setattr(versioned, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            snapshots.upsert_partitions(path, rows(spark, *NEW), ["k", "day"], "day")
    assert held(spark, path) == before
    # half a manifest
    fs, p = versioned._fs(spark, f"{path}/_manifests/v{2:012d}.json")
    out = fs.create(p, False)
    out.write(bytearray(b'{"number": 2, "schema"'))
    out.close()
    assert held(spark, path) == before
    snapshots.upsert_partitions(path, rows(spark, *NEW), ["k", "day"], "day")
    assert held(spark, path) == [(1, 1), (2, 2), (3, 1), (4, 2)]
    assert versioned.current(spark, path).number == 3


def test_replacing_a_table_keeps_the_old_rows_until_the_end(spark):
    path = scratch_path(spark, "replaced")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    tables.replace_table(spark.range(5), path)
    with pytest.raises(Exception, match="killed"):
        tables.replace_table(spark.range(9).withColumn("id", F.when(F.col("id") > 6, F.raise_error(F.lit("killed")).cast("long"))
                                                       .otherwise(F.col("id"))), path)
    assert tables.read_table(spark, path).count() == 5
    tables.replace_table(spark.range(0), path)
    assert tables.read_table(spark, path).count() == 0 and tables.read_table(spark, path).columns == ["id"]


def test_two_writers_from_one_version(spark):
    path = stored(spark)
    now = versioned.current(spark, path)
    versioned.load(rows(spark, *NEW), path, ["day"], mode="append", base=now)
    with pytest.raises(RuntimeError, match="changed since"):
        versioned.load(rows(spark, *NEW), path, ["day"], mode="append", base=now)
    assert len(held(spark, path)) == 6


def test_a_batch_counts_once(spark):
    path = stored(spark)
    for number in (0, 1, 1, 0):
        versioned.load(rows(spark, *NEW), path, ["day"], mode="append", batch=("w", number))
    assert len(held(spark, path)) == 8
    assert sorted((r.k, r.v) for r in snapshots.newest_of(path, spark, ["k", "day"]).collect()) == \
        [(1, 1), (2, 2), (3, 1), (4, 2)]


def test_vacuum_removes_what_no_kept_version_names(spark):
    path = stored(spark)
    for _ in range(3):
        snapshots.upsert_partitions(path, rows(spark, *NEW), ["k", "day"], "day")
    before = held(spark, path)
    assert len(child_names(spark, f"{path}/data")) == 4
    assert len(versioned.vacuum(spark, path, keep=1)) == 2  # the first load still holds a day
    assert held(spark, path) == before and versioned.vacuum(spark, path, keep=1) == []


def test_by_area_upsert_equals_the_whole_and_repairs_itself(spark, monkeypatch):
    """Three runs, the last a repeat of the second; the driver dies once
    between the polygons' table and the areas'."""
    from sf_paths import SF001

    from ridgeline.operators import forecast
    from ridgeline.plans import catalog as C
    s, d = C.stg(spark, SF001), C.dim(spark, SF001)
    cells, areas = scratch_path(spark, "cells"), scratch_path(spark, "areas")
    early = F.col("extracted_at_ts") < F.lit("2024-01-16").cast("timestamp")
    forecast.upsert_hourly_by_area(s.filter(early), d, cells, areas)
    first = tables.read_table(spark, areas).count()
    with monkeypatch.context() as m:
        def die(*_, **__):
            raise KeyboardInterrupt
        m.setattr(forecast, "forecast_hourly_by_area", die)
        with pytest.raises(KeyboardInterrupt):
            forecast.upsert_hourly_by_area(s.filter(~early), d, cells, areas)
    assert tables.read_table(spark, areas).count() == first
    want = sorted(map(str, forecast.forecast_hourly_by_area(s, d).collect()))
    for _ in range(2):
        forecast.upsert_hourly_by_area(s.filter(~early), d, cells, areas)
        got = tables.read_table(spark, areas).drop("start_day")
        assert sorted(map(str, got.collect())) == want


def test_clustered_layout_skips_row_groups(spark):
    """A read by either column meets a small share of the files, and an hour a
    small share of the row groups by their statistics."""
    path = scratch_path(spark, "clustered")
    df = spark.range(40_000).selectExpr(
        "concat('A', id % 400) AS area_id", "timestamp_seconds(1704067200 + (id div 400) * 3600) AS start_time")
    laid = tables.clustered(df, ["area_id"], ["start_time"], files=32)
    t = tables.publish(laid, "clustered_layout", kind="table", path=path, lookup=["area_id"])
    assert sorted(t.collect()) == sorted(df.collect())
    files = glob.glob(f"{path.removeprefix('file://')}/*.parquet")

    def files_with(condition):
        return t.where(condition).select(F.input_file_name()).distinct().count() / len(files)
    assert len(files) == 32
    assert files_with("area_id = 'A7'") <= 0.3
    assert files_with("start_time = timestamp'2024-01-02 05:00:00'") <= 0.3
    groups = [pq.ParquetFile(f).metadata.row_group(g) for f in files for g in range(pq.ParquetFile(f).num_row_groups)]
    at = t.columns.index("start_time")
    when = dt.datetime(2024, 1, 2, 5, tzinfo=dt.timezone.utc)
    met = [g for g in groups if g.column(at).statistics.min <= when <= g.column(at).statistics.max]
    assert len(met) <= 0.3 * len(groups)
    assert spark.catalog.tableExists("clustered_layout")


def test_clustered_takes_nulls_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None), ("a", 1.0), ("a", 1.0), (None, 2.0)], "k string, v double")
    assert sorted(map(str, tables.clustered(df, ["k"], ["v"], 3).collect())) == sorted(map(str, df.collect()))
    assert tables.clustered(df.where("false"), ["k"], ["v"], 3).count() == 0
