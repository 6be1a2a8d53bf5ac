"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every ridgeline job relies on: UTC wall clock (forecast times are
# instants), ANSI casts (a bad value fails the job, as in the warehouse), AQE
# for runtime re-planning (partition coalescing, skew-join splitting, and
# broadcast only after the runtime size of a side is known).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # times with statistics in the footer, so that row groups can be skipped
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "ridgeline",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the ridgeline defaults.

    On a cluster, pass ``master=None`` and let spark-submit decide; locally
    pass ``local[N]``. ``shuffle_partitions`` should be sized so one shuffle
    partition stays well under executor memory at the target scale (AQE
    coalesces small ones at runtime).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and landing round trips.

    Reads ``spark.checkpoint.dir`` from the session (or the context's
    checkpoint dir). When neither is set, a local session (master
    ``local[...]``, as in tests) gets a private folder; on a cluster that
    folder would be another one on every machine, so it is refused.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - connect sessions
            path = None
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        # spark.checkpoint.dir is a core setting (read-only at runtime); the
        # context's checkpoint dir is what Dataset.checkpoint() uses
        path = tempfile.mkdtemp(prefix="ridgeline-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


# what scratch_path has given out: all of it, and within each open scope
_SCOPES: list[list[str]] = [[]]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared dir for one job's output."""
    path = f"{shared_dir(spark)}/ridgeline/{name}-{uuid.uuid4().hex}"
    for made in _SCOPES:
        made.append(path)
    return path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside it go when the write is
    done, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Removes one scratch folder, when nothing reads from it any more."""
    _delete(spark, path)
    for made in _SCOPES:
        if path in made:
            made.remove(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the scratch folders made inside it: for work whose
    result has been written to a folder made before."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES[:] = [s for s in _SCOPES if s is not made]
        for path in made:
            _delete(spark, path)
        _SCOPES[0][:] = [p for p in _SCOPES[0] if p not in made]


def clear_scratch(spark: SparkSession) -> None:
    """Removes all scratch folders that this process has made: when its results
    are written elsewhere, since a DataFrame may still read from them."""
    base = f"{shared_dir(spark)}/"
    for path in [p for p in _SCOPES[0] if p.startswith(base)]:
        _delete(spark, path)
        _SCOPES[0].remove(path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty when it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
