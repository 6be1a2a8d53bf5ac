"""Places of rows within groups, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import kept_table


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``tree`` (the group's place among the groups, null first),
    ``pos`` (the row's place in its group, nulls first, ties by a number of
    the row) and ``n`` (rows of the group), all from 0.

    ``rows`` are dealt to ranges of (group, order), so a hot group, a hot
    value and rows that are all equal spread over many tasks; a place is the
    rows of the group in earlier ranges plus the place within the range. The
    only windows over a whole group run on one row per range.
    """
    keys = [group, *order, "_no"]
    dealt = kept_table(rows.withColumn("_no", F.monotonically_increasing_id()), "numbered")
    dealt = dealt.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    dealt = kept_table(dealt, "ranges")
    own = dealt.withColumnRenamed(group, "_group")
    counts = own.groupBy("_range", "_group").agg(F.count(F.lit(1)).alias("_n"))
    in_group = Window.partitionBy("_group").orderBy("_range")
    counts = counts.select(
        "*", F.coalesce(F.sum("_n").over(in_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("_group")).alias("n"),
        F.min("_range").over(Window.partitionBy("_group")).alias("_first"))
    counts = kept_table(counts, "counts")
    # a group's place: the groups that begin in earlier ranges, and within its first
    begins = counts.where(F.col("_first") == F.col("_range"))
    per_range = begins.groupBy("_range").agg(F.count(F.lit(1)).alias("_groups"))
    earlier = per_range.select("_range", F.coalesce(F.sum("_groups").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))
    trees = begins.join(earlier, "_range").select(
        "_group", (F.col("_earlier") + F.row_number().over(Window.partitionBy("_range").orderBy("_group")) - 1).alias("tree"))
    placed = counts.alias("c").join(trees.alias("t"), F.col("c._group").eqNullSafe(F.col("t._group"))).select(
        F.col("_range").alias("_r"), F.col("c._group").alias("_g"), "_before", "n", "tree")
    here = Window.partitionBy("_range", "_group").orderBy(*(F.col(c).asc_nulls_first() for c in [*order, "_no"]))
    numbered = own.withColumn("_place", F.row_number().over(here) - 1)
    out = numbered.join(placed, (F.col("_range") == F.col("_r")) & F.col("_group").eqNullSafe(F.col("_g")))
    return out.select(F.col("_group").alias(group), *(c for c in rows.columns if c != group), "tree",
                      (F.col("_before") + F.col("_place")).alias("pos"), "n")
