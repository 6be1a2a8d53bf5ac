"""Newest snapshot per key (W1) and incremental upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import versioned


def snapshot_order(generated_col: str = "generated_at", extracted_col: str = "extracted_at_ts") -> list[Column]:
    """Default "newest wins" order, newest first.

    ``generated_at`` is kept as text upstream; ordering by its parsed instant
    first and the text second is the same order for a single ISO form, and
    stays right when offsets differ. NULLs sort last, as in the warehouse.
    """
    g = F.col(generated_col)
    return [F.try_to_timestamp(g).desc_nulls_last(), g.desc_nulls_last(),
            F.col(extracted_col).desc_nulls_last()]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None,
                   tie_break: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first row per key under ``order_by`` (newest first).

    ``row_number() = 1``; Catalyst turns the filter into a ``WindowGroupLimit`` that keeps one row per key inside each map task
    before the shuffle, so a hot key ships one row per task, not all of them.
    (:func:`latest_by_max` is the aggregate form for a single version column.)

    Ties under ``order_by`` are broken by ``tie_break`` and finally by a hash
    of the whole row, so the result is deterministic (the reference leaves
    ties open).
    """
    order_by = list(order_by) if order_by is not None else snapshot_order()
    others = [c for c in df.columns if c not in keys]
    row_hash = F.xxhash64(*[F.col(c) for c in others]) if others else F.lit(0)
    full_order = order_by + list(tie_break or []) + [row_hash.asc()]
    w = Window.partitionBy(*keys).orderBy(*full_order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_by_max(df: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """W1 (aggregate form): newest row per key by a single sortable version
    column (larger is newer, NULL oldest), ties broken by the row's hash.
    A ``max`` over ``struct(version, hash, row)`` is one aggregate with
    map-side partial aggregation."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(F.col(version_col).alias("_v"), F.xxhash64(*[F.col(c) for c in others]).alias("_h"),
                      F.struct(*[F.col(c) for c in others]).alias("_row"))
    return (df.groupBy(*keys).agg(F.max(packed).alias("_best"))
              .select(*keys, "_best._row.*").select(*df.columns))


def incremental_upsert(stored: DataFrame, new_rows: DataFrame, keys: Sequence[str],
                       order_by: Sequence[Column] | None = None) -> DataFrame:
    """D6 as a DataFrame: stored and new rows, newest snapshot per key.
    For a stored table use :func:`upsert_partitions`."""
    return latest_per_key(stored.unionByName(new_rows.select(*stored.columns)), keys, order_by)


def upsert_partitions(path: str, new_rows: DataFrame, keys: Sequence[str], partition_col: str,
                      order_by: Sequence[Column] | None = None, batch: tuple[str, int] | None = None) -> list[str]:
    """D6 on a table partitioned by ``partition_col`` (derived from the keys,
    e.g. the day of ``start_time``): only the partitions that ``new_rows``
    touch are read (their values are a literal filter on the scan) and
    written anew; all others keep their files.

    The touched partitions change together when the load is complete
    (:mod:`ridgeline.sources.versioned`): a job that dies before that leaves
    the table as it was. The merge is idempotent, so a replayed batch leaves
    the same table; one that is named by ``batch`` is skipped. The new rows
    are cut with ``checkpoint()`` when a stored table is merged, as they are
    used twice then. Gives the partition folders that were written.
    """
    spark = new_rows.sparkSession
    new_rows = latest_per_key(new_rows, keys, order_by)
    now = versioned.current(spark, path)
    if now is not None:
        if batch and now.batches.get(batch[0], -1) >= batch[1]:
            return []
        shared_dir(spark)
        new_rows = new_rows.checkpoint(eager=True)
        values = [r[0] for r in new_rows.select(partition_col).distinct().collect()]  # partitions of one batch
        stored = versioned.read(spark, path, now).where(F.col(partition_col).isin(values)).select(*new_rows.columns)
        new_rows = latest_per_key(stored.unionByName(new_rows), keys, order_by)
    return versioned.load(new_rows, path, [partition_col], mode="partitions", batch=batch, base=now)


def newest_of(path: str, spark, keys: Sequence[str], order_by: Sequence[Column] | None = None) -> DataFrame:
    """The newest row per key of a table to which changed rows are appended."""
    return latest_per_key(versioned.read(spark, path), keys, order_by)


def compact(path: str, spark, keys: Sequence[str], partition_by: list[str],
            order_by: Sequence[Column] | None = None) -> None:
    """Such a table rewritten with its newest rows alone, as one load."""
    now = versioned.current(spark, path)
    versioned.load(latest_per_key(versioned.read(spark, path, now), keys, order_by), path, partition_by, base=now)
