"""Structured Streaming over the append-only forecast landing (ST1-ST3).

ST1: the landing folder is a file stream; each file is processed once,
tracked by the checkpoint. ST3: the newest snapshot per (polygon, hour), in two
forms: each micro-batch merged into the days it touches (``upsert``), or the
newest snapshots held in the stream's state, of which a batch appends the ones
that it changed (``state``). ST2: both are safe against repeats: a re-landed
envelope leaves the same table (newest wins, equal rows collapse), a replayed
batch is known by its number, and a late document for an hour that the table
lacks is added however late it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.snapshots import newest_of, upsert_partitions
from ..operators.staging import stage_forecast
from ..sources import versioned
from ..sources.landing import path_glob

KEYS = ["geo_json", "start_time"]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def forecast_stream(spark: SparkSession, landing_base: str, source: str = "nws",
                    task: str = "ingest_nws_hourly_forecast",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """ST1: streaming envelopes, every file of every run once."""
    r = spark.readStream.schema(schemas.RAW_NWS + ", run_ts string")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(path_glob(landing_base, source, task)).select("data", "extracted_at_ts")


def upsert_batch(batch: DataFrame, table_path: str, number: int | None = None) -> None:
    """ST3 / D6: merge one micro-batch into the newest-snapshot table (only
    the days it touches are read and rewritten)."""
    staged = stage_forecast(batch).withColumn("start_day", F.to_date("start_time"))
    upsert_partitions(table_path, staged, KEYS, "start_day", batch=None if number is None else ("stream", number))


def newest_snapshots(stream: DataFrame) -> DataFrame:
    """ST3 as state: the newest row per (polygon, hour) of all documents so
    far, by the order of :func:`~ridgeline.operators.snapshots.latest_per_key`.
    A streaming aggregate without a watermark, so no document is too late; in
    update mode it gives the keys that a batch has touched. The state has one
    row per key and lies in RocksDB, on disk."""
    staged = stage_forecast(stream)
    others = [c for c in staged.columns if c not in KEYS]
    version = F.struct(F.try_to_timestamp("generated_at").alias("i"), F.col("generated_at").alias("g"),
                       F.col("extracted_at_ts").alias("x"), F.bitwise_not(F.xxhash64(*others)).alias("h"),
                       F.struct(*others).alias("row"))
    newest = staged.groupBy(F.xxhash64("geo_json").alias("cell_key"), *KEYS).agg(F.max(version).alias("v"))
    return newest.select(*KEYS, "v.row.*").select(*staged.columns)


def append_changes(changed: DataFrame, table_path: str, number: int) -> None:
    """The changed keys of one batch, by day; a batch that the table has is skipped."""
    rows = changed.withColumn("start_day", F.to_date("start_time"))
    versioned.load(rows, table_path, ["start_day"], mode="append", batch=("stream", number))


def read_newest(spark: SparkSession, table_path: str) -> DataFrame:
    """The table of either form: one row per (polygon, hour)."""
    return newest_of(table_path, spark, KEYS)


def run_forecast_stream(spark: SparkSession, landing_base: str, table_path: str, checkpoint_path: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None, form: str = "upsert"):
    """Ingest all files present now and return when that is done, or raise
    what stopped the stream (``available_now=False``: keep it running)."""
    stream = forecast_stream(spark, landing_base, max_files_per_trigger=max_files_per_trigger)
    if form == "state":
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        w = (newest_snapshots(stream).writeStream.outputMode("update")
             .foreachBatch(lambda df, n: append_changes(df, table_path, n)))
    elif form == "upsert":
        w = stream.writeStream.foreachBatch(lambda df, n: upsert_batch(df, table_path, n))
    else:
        raise ValueError(f"unknown form {form!r}")
    w = w.option("checkpointLocation", checkpoint_path)
    if not available_now:
        return w.start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q
