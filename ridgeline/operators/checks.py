"""Data checks (DQ1-DQ5). Each returns the failing rows; zero rows is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def check_required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ1: REQUIRED columns (file readers do not enforce nullability)."""
    return df.filter(_any_null(cols))


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ2/DQ5: ``not_null`` column tests."""
    return df.filter(_any_null(cols))


def check_expression(df: DataFrame, expr: Column, null_fails: bool = False) -> DataFrame:
    """DQ3: ``expression_is_true``: rows where ``NOT expr``. A NULL
    expression passes unless ``null_fails``."""
    bad = ~expr
    if null_fails:
        bad = bad | expr.isNull()
    return df.filter(bad)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ4: key combinations that occur more than once, with their count
    (partial aggregation on the map side)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key combination (``n_rows``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def check_unique_by_area(forecast: DataFrame, bridge: DataFrame, keys: Sequence[str] = ("start_time",),
                         on: str | None = None, n_rows: str | None = None) -> DataFrame:
    """DQ4 on the by-area model without building it: rows are counted per
    (cell key, keys) first, the counts (not the rows) are fanned out to the
    areas of each cell. An area in one cell has that cell's counts, so only
    those above one are fanned out to it; those of an area in several cells are
    summed per (area, keys). ``n_rows`` names a column with the number of rows
    that a row of ``forecast`` stands for (:func:`counted`). Same result as
    ``check_unique(forecast_by_area(forecast, bridge), ["area_id", *keys])``
    with one row per cell-hour, instead of one per area-hour-snapshot,
    going through the fan-out join."""
    from .forecast import by_number_of_cells
    from .spatial import _cell_column, forecast_by_area

    on = on or _cell_column(forecast)
    keys = list(keys)
    per_cell = forecast.groupBy(on, *keys).agg((F.sum(n_rows) if n_rows else F.count(F.lit(1))).alias("_n"))
    one, many = by_number_of_cells(bridge.select("area_id", on))
    names = ["area_id", *keys, F.col("_n").alias("n_rows")]
    out = forecast_by_area(per_cell.filter(F.col("_n") > 1), one, on=(on,)).select(*names)
    if many is not None:
        summed = forecast_by_area(per_cell, many, on=(on,)).groupBy("area_id", *keys).agg(F.sum("_n").alias("_n"))
        out = out.unionByName(summed.filter(F.col("_n") > 1).select(*names))
    return out


def required(cols: Sequence[str]) -> dict[str, Column]:
    """DQ1/DQ2/DQ5 as rules for :func:`observed`: one per column."""
    return {f"required:{c}": F.col(c).isNull() for c in cols}


def holds(name: str, expr: Column, null_fails: bool = False) -> dict[str, Column]:
    """DQ3 as a rule: rows where ``NOT expr`` (a NULL passes unless ``null_fails``)."""
    bad = ~expr
    return {f"expression:{name}": (bad | expr.isNull()) if null_fails else F.coalesce(bad, F.lit(False))}


def observed(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """DQ1-DQ3, DQ5 in the pass that writes a table: ``df`` unchanged, and the
    counts of its rows (``rows``) and of those that fail each rule, which are
    there when an action on it (the write) is over. All rules cost one scan;
    :func:`failing` gives the rows, when a count asks for them."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *(F.count(F.when(bad, 1)).alias(name) for name, bad in rules.items())]
    return df.observe(seen, *counts), seen


def failing(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows that fail a rule, with ``rules``: the names of those they fail."""
    names = F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules.items())), lambda x: x.isNotNull())
    return df.withColumn("rules", names).filter(F.size("rules") > 0)
