"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.session import scratch_path, scratch_scope, shuffles_removed

# the white space of every contract: [\x20\x09-\x0D]
BLANKS = " \t\n\x0b\x0c\r"

# An Arrow batch handed to a Python worker holds at most this many rows and
# about this many bytes, so a worker's memory does not grow with the input.
BATCH_ROWS = 2000
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def squeeze(text: Column) -> Column:
    """The text without any character of ``[\\x20\\x09-\\x0D]`` (null stays null)."""
    for c in BLANKS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a row without an id is
    never learned from, so it counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per context
    (they may have no copy of the repository). The archive lies on the driver,
    which serves it to the executors; nothing else reads it."""
    sc = spark.sparkContext
    if getattr(sc, "_ridgeline_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ridgeline-package-"), "ridgeline-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._ridgeline_shipped = True


def bound_batches(spark: SparkSession) -> None:
    """Settings under which Python workers get bounded Arrow batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with bounded batches."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def located(docs: DataFrame, file: str = "file", row: str = "row") -> DataFrame:
    """Adds the locator of a row's content: file and row number. A DataFrame
    that is not read from files is written to the shared folder first."""
    try:
        return docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    except AnalysisException:  # no file metadata
        path = scratch_path(docs.sparkSession, "located")
        docs.write.parquet(path)
        docs = docs.sparkSession.read.schema(docs.schema).parquet(path)
        return docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))


def kept_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder (to ``path``, if given) and read
    back: cuts the lineage in a way that survives the loss of executors. Its
    shuffle files go with the write."""
    path = path or scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def result_kept(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, as a :func:`kept_table`; the tables that it has
    kept on its way are removed."""
    path = scratch_path(spark, name)
    with scratch_scope(spark):
        return kept_table(make(), name, path)
