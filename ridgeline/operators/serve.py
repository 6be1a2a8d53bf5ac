"""Read queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

# Chart metrics as (metric, label, value column, unit column);
# wind speed draws two lines on one chart. Every series has source "nws".
METRICS = [
    ("temperature", "nws", "temperature_value", "temperature_unit"),
    ("wind_speed", "low", "wind_speed_low", "wind_speed_unit"),
    ("wind_speed", "high", "wind_speed_high", "wind_speed_unit"),
    ("precip_probability", "nws", "precipitation_probability_value", "precipitation_probability_unit"),
    ("humidity", "nws", "relative_humidity_value", "relative_humidity_unit"),
    ("dewpoint", "nws", "dewpoint_value", "dewpoint_unit"),
]
SERIES_SOURCE = "nws"


def recent(fact: DataFrame, as_of: Column, lookback_hours: int = 1, area_id: str | None = None) -> DataFrame:
    """Rows with ``start_time > as_of - lookback`` (strict), optionally for
    one area. ``as_of`` is a parameter so results are repeatable; pass
    ``current_timestamp()`` at the caller for live reads."""
    out = fact.filter(F.col("start_time") > as_of - F.make_interval(hours=F.lit(lookback_hours)))
    if area_id is not None:
        out = out.filter(F.col("area_id") == F.lit(area_id))
    return out


def series_long(fact: DataFrame, as_of: Column, area_id: str | None = None) -> DataFrame:
    """V2 (long form): one row per (area, metric line, hour); NULL values are
    kept (a point's value may be null). Narrow: an inline generator, no join."""
    r = recent(fact, as_of, area_id=area_id)
    specs = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(lbl).alias("label"),
                               F.col(v).cast("double").alias("v"), F.col(u).alias("unit"))
                      for m, lbl, v, u in METRICS])
    return r.select("area_id", F.col("start_time").alias("t"), F.inline(specs)).select(
        "area_id", "metric", "label", F.lit(SERIES_SOURCE).alias("source"), "unit", "t", "v")


def line_name(label: str = "label", source: str = "source") -> Column:
    """F-C5: the name of a chart line: its label, without one its source."""
    return F.coalesce(F.col(label), F.col(source))


def series_by_source(union: DataFrame, as_of: Column) -> DataFrame:
    """V2 over the union of sources (D1): a line per (area, metric, source),
    in long form. A metric that has one line per source carries no label; the
    two wind lines do. ``line`` is the name that a chart shows."""
    r = union.filter(F.col("start_time") > as_of - F.make_interval(hours=F.lit(1)))
    label = {lbl: F.lit(lbl) if m == "wind_speed" else F.lit(None).cast("string") for m, lbl, _, _ in METRICS}
    specs = F.array(*[F.struct(F.lit(m).alias("metric"), label[lbl].alias("label"), F.col(v).cast("double").alias("v"),
                               F.col(u).alias("unit")) for m, lbl, v, u in METRICS])
    return r.select("area_id", "source", F.col("start_time").alias("t"), F.inline(specs)).select(
        "area_id", "metric", "label", "source", line_name().alias("line"), "unit", "t", "v")


def series_by_metric(fact: DataFrame, as_of: Column, area_id: str | None = None) -> DataFrame:
    """V2 in the shape that a chart page reads: per area ``metrics``, a map
    from the metric to the list of its series (label, source, unit, points
    newest first). Cut from the same lists as :func:`series_nested`."""
    return _metric_maps(_series_lists(recent(fact, as_of, area_id=area_id), "area_id"), "area_id")


def _metric_maps(lists: DataFrame, key: str) -> DataFrame:
    names = list(dict.fromkeys(m for m, _, _, _ in METRICS))
    entries = []
    for name in names:
        lines = [_series_struct(lbl, v, u) for m, lbl, v, u in METRICS if m == name]
        entries += [F.lit(name), F.array(*lines)]
    return lists.select(F.col(key).alias("area_id"), F.create_map(*entries).alias("metrics"))


def series_nested(fact: DataFrame, as_of: Column, area_id: str | None = None) -> DataFrame:
    """V2 + A2: per (area, metric line) the unit of the latest hour and the
    points newest first.

    The hours of an area are grouped once (one list of wide rows per area,
    newest first) and the six series are cut from that list with
    ``transform``; the long form would shuffle six rows per hour instead.
    A list holds one entry per future hour of one area, so its size is
    bounded by the forecast horizon.
    """
    return _series_columns(_series_lists(recent(fact, as_of, area_id=area_id), "area_id"), "area_id")


def _series_lists(rows: DataFrame, key: str) -> DataFrame:
    """Per ``key``: the hours newest first (time and the six values) and the
    units of the newest hour (a struct keeps a NULL unit NULL)."""
    value_cols = list(dict.fromkeys(v for _, _, v, _ in METRICS))
    unit_cols = list(dict.fromkeys(u for _, _, _, u in METRICS))
    point = F.struct(F.col("start_time").alias("t"), *[F.col(c).cast("double").alias(c) for c in value_cols])
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(point), asc=False).alias("_rows"),
                                 F.max_by(F.struct(*unit_cols), "start_time").alias("_units"))


def _series_columns(lists: DataFrame, key: str) -> DataFrame:
    series = F.array(*[F.struct(F.lit(m).alias("metric"), *_series_fields(lbl, v, u)) for m, lbl, v, u in METRICS])
    return lists.select(F.col(key).alias("area_id"), F.inline(series))


def _series_fields(label: str, value_col: str, unit_col: str) -> list[Column]:
    def point(x):
        return F.struct(x["t"].alias("t"), x[value_col].alias("v"))
    return [F.lit(label).alias("label"), F.lit(SERIES_SOURCE).alias("source"), F.col("_units")[unit_col].alias("unit"),
            F.transform("_rows", point).alias("points")]


def _series_struct(label: str, value_col: str, unit_col: str) -> Column:
    return F.struct(*_series_fields(label, value_col, unit_col))


def series_nested_by_area(stg: DataFrame, areas: DataFrame, as_of: Column,
                          each: Callable[[DataFrame], DataFrame] = lambda nested: nested) -> DataFrame:
    """V2 + A2 straight from staged forecasts: the series are built once
    per polygon from its newest hours and fanned out to the areas inside it
    (an area in one polygon has exactly its polygon's hours), instead of
    grouping every area-hour row. Areas inside several polygons take the
    exact hourly path. Same rows as ``each(series_nested(fact, as_of))``.

    ``each`` (such as :func:`series_digest`) makes a row of every series and
    keeps its ``area_id``; it is worked out per polygon, so that its results,
    not the point lists, are copied to the areas."""
    return _lists_by_area(stg, areas, as_of, _series_columns, each)


def series_by_metric_by_area(stg: DataFrame, areas: DataFrame, as_of: Column,
                             each: Callable[[DataFrame], DataFrame] = lambda nested: nested) -> DataFrame:
    """:func:`series_by_metric` straight from staged forecasts, built once per
    polygon like :func:`series_nested_by_area`: same rows as
    ``each(series_by_metric(fact, as_of))``. ``each`` works on a row at a time
    and keeps its ``area_id``."""
    return _lists_by_area(stg, areas, as_of, _metric_maps, each)


def _lists_by_area(stg: DataFrame, areas: DataFrame, as_of: Column, cut: Callable[[DataFrame, str], DataFrame],
                   each: Callable[[DataFrame], DataFrame]) -> DataFrame:
    from .forecast import newest_by_cell, newest_in_several_polygons, split_bridge
    from .spatial import CELL_KEY, forecast_by_area

    rows, few = newest_by_cell(stg)
    one, many = split_bridge(rows, areas)
    newest = recent(rows.drop("geo_json"), as_of)
    # within the next steps the polygon's key stands for the area
    per_cell = each(cut(_series_lists(newest, CELL_KEY), CELL_KEY))
    names = per_cell.columns
    out = forecast_by_area(per_cell.withColumnRenamed("area_id", CELL_KEY), one, few=few).select(*names)
    if many is not None:
        multi = newest_in_several_polygons(newest, many)
        out = out.unionByName(each(cut(_series_lists(multi, "area_id"), "area_id")))
    return out


def series_digest(nested: DataFrame) -> DataFrame:
    """Flatten nested points to comparable numbers: the point count and an
    order-sensitive checksum ``sum(position * (epoch_seconds + round(v *
    1e6)))`` (-1 for a NULL value), exact integer arithmetic in any engine."""
    terms = F.transform("points", lambda p, i: (i + 1).cast("long") * (
        F.unix_timestamp(p["t"]) + F.coalesce(F.round(p["v"] * 1000000).cast("long"), F.lit(-1).cast("long"))))
    return nested.select("area_id", "metric", "label", "source", "unit",
                         F.size("points").cast("long").alias("n_points"),
                         F.aggregate(terms, F.lit(0).cast("long"), lambda acc, x: acc + x).alias("points_checksum"))


def series_for_areas(fact: DataFrame, as_of: Column, area_ids: DataFrame) -> DataFrame:
    """V3: every asked area gets all six series; an area with no rows gets
    empty point lists and a NULL unit. The lists of hours are joined to the ids,
    one row per area, and the six series are cut after that, so that no point
    list is shuffled six times."""
    wanted = area_ids.select("area_id").distinct()
    asked = recent(fact, as_of).join(wanted.hint("shuffle_hash"), "area_id", "left_semi")
    lists = wanted.join(_series_lists(asked, "area_id"), "area_id", "left")
    # an area without rows has no list and no units
    rows = lists.withColumn("_rows", F.coalesce("_rows", F.array().cast(lists.schema["_rows"].dataType)))
    return _series_columns(rows, "area_id").select("area_id", "metric", "label", "source", "unit", "points")


def area_children(dim: DataFrame, area_id: str | None = None) -> DataFrame:
    """Direct children as ``(parent_id, child_id, child_name)``.

    For one id this is a filter sorted by name (then id). For all ids it is a
    plain projection of rows with a parent: each child row already names its
    parent, so no self-join and no per-parent list is needed.
    """
    out = dim.filter(F.col("parent_id").isNotNull()).select(
        "parent_id", F.col("id").alias("child_id"), F.col("area_name").alias("child_name"))
    if area_id is not None:
        out = out.filter(F.col("parent_id") == F.lit(area_id)).orderBy("child_name", "child_id")
    return out


def area_card(dim: DataFrame, area_id: str | None = None) -> DataFrame:
    """V1: node plus its direct children, one row per (node, child); a node
    without children gets one row with NULL child columns; an unknown id
    gives no rows.

    Children stay in long form: a parent may hold a large share of all
    areas, and a list per parent would put that share in one task. Built as
    an inner join (both sides splittable by AQE's skew handling) plus an
    anti-join for childless nodes.
    """
    nodes = dim if area_id is None else dim.filter(F.col("id") == F.lit(area_id))
    kids = dim.select(F.col("parent_id").alias("id"), F.col("id").alias("child_id"),
                      F.col("area_name").alias("child_name")).filter(F.col("id").isNotNull())
    with_kids = nodes.join(kids, "id", "inner")
    childless = nodes.join(kids.select("id").distinct(), "id", "left_anti").select(
        *nodes.columns, F.lit(None).cast("string").alias("child_id"), F.lit(None).cast("string").alias("child_name"))
    out = with_kids.unionByName(childless)
    if area_id is not None:
        out = out.orderBy(F.col("child_name").asc_nulls_last(), "child_id")
    return out


CARD_CHUNK = 1000


def area_cards_nested(dim: DataFrame, chunk: int = CARD_CHUNK) -> DataFrame:
    """V1 + O1 for all nodes with their children in lists: ``id, area_name,
    parent_id, chunk, children`` (id and name, sorted by name, then id). A list
    holds at most ``chunk`` children; the chunks of a node in their order are
    the whole sorted list. A node without children has one empty list.

    Children are dealt to ranges of (parent, name, id), so a parent with a
    large share of all areas is several tasks; a chunk's number is that of the
    node's chunks in earlier ranges plus its own within the range.
    """
    shared_dir(dim.sparkSession)
    kids = dim.filter(F.col("parent_id").isNotNull() & F.col("id").isNotNull()).select(
        "parent_id", F.col("id").alias("child_id"), F.col("area_name").alias("child_name"))
    dealt = (kids.repartitionByRange("parent_id", "child_name", "child_id")
             .withColumn("_range", F.spark_partition_id()).checkpoint(eager=True))
    here = Window.partitionBy("_range", "parent_id").orderBy("child_name", "child_id")
    numbered = dealt.withColumn("_c", F.floor((F.row_number().over(here) - 1) / chunk).cast("int"))
    lists = numbered.groupBy("_range", "parent_id", "_c").agg(F.sort_array(F.collect_list(
        F.struct("child_name", "child_id"))).alias("children"))
    # one row per range and parent
    ranges = lists.groupBy("_range", "parent_id").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("parent_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    chunks = lists.join(offsets, ["_range", "parent_id"]).select(
        F.col("parent_id").alias("id"), (F.col("_before") + F.col("_c")).alias("chunk"), "children")
    nodes = dim.select("id", "area_name", "parent_id")
    none = F.array().cast(chunks.schema["children"].dataType)
    return nodes.join(chunks, "id", "left").select("id", "area_name", "parent_id", F.coalesce("chunk", F.lit(0)).alias("chunk"),
                                                   F.coalesce("children", none).alias("children"))
