"""Forecast marts: hourly forecast by area (C5), scored fact (P10), daily
score (D4), the weekend ranking (D5) and unit standardization (D7), plus the
shared area-polygon bridge and per-polygon rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scoring import DEFAULT_PARAMS, ScoreParams, climb_score
from ..session import shared_dir
from ..sources import versioned
from ..sources.tables import clustered
from .snapshots import latest_per_key, upsert_partitions
from .spatial import CELL_KEY, area_cells, forecast_by_area, forecast_by_area_clustered


# Rows of cells and hours up to so many are held in memory once per executor.
FEW_ROWS = 250_000


def newest_by_cell(stg: DataFrame) -> tuple[DataFrame, bool]:
    """The newest row per polygon and hour, with ``cell_key`` beside the
    polygon text, checkpointed: the staged rows are read once, for the rows and
    for the polygons of the bridge. And whether the rows are few (one small
    job), so that :func:`~.spatial.forecast_by_area` needs no shuffle of them.

    The text is one of the keys: of two texts with one key both stay, for
    :func:`~.spatial.cell_dictionary` to find."""
    shared_dir(stg.sparkSession)
    keyed = stg.withColumn(CELL_KEY, F.xxhash64("geo_json"))
    newest = latest_per_key(keyed, [CELL_KEY, "start_time", "geo_json"]).checkpoint(eager=True)
    return newest, newest.limit(FEW_ROWS + 1).count() <= FEW_ROWS


def forecast_hourly_by_area(stg: DataFrame, areas: DataFrame, bridge: DataFrame | None = None,
                            spread_by: str | None = None) -> DataFrame:
    """Hourly forecast rows per area, newest snapshot per (area, hour).

    Same bag as "contains-join every hourly row, then row_number per
    (area, hour)", planned for scale:

    1. containment is resolved once per (area, distinct polygon) -> bridge;
    2. the newest snapshot is kept per (polygon, hour) *before* the fan-out
       to areas (a map-side top-1, so repeated daily snapshots shrink before
       any shuffle and a hot cell ships one row per task and hour);
    3. forecast rows join the area-grain bridge on the cell key, a long that
       stands for the polygon text from the first shuffle on;
    4. only areas inside more than one polygon need a second newest-per-
       (area, hour) pass; areas with a single polygon skip that shuffle, and
       the branch is left out of the plan when no such area exists.
       Exact: the newest row over a union of polygon groups is the newest
       among each group's newest.

    Runs jobs while building the plan: checkpointing the newest rows per
    polygon and hour (:func:`newest_by_cell`) and the area-grain bridge, and
    looking for one multi-polygon area.
    """
    newest_cell, few = newest_by_cell(stg)
    one, many = split_bridge(newest_cell, areas, bridge)
    cols = schemas.HOURLY_BY_AREA_COLUMNS
    newest_cell = newest_cell.drop("geo_json")
    single = forecast_by_area(newest_cell, one, spread_by=spread_by, few=few).select(*cols)
    if many is None:
        return single
    return single.unionByName(_in_order(newest_in_several_polygons(newest_cell, many).select(*cols), spread_by))


def upsert_hourly_by_area(stg: DataFrame, areas: DataFrame, cell_table: str, area_table: str) -> list[str]:
    """D6 on the by-area model: new staged rows are merged per (polygon, hour)
    into ``cell_table``, before the fan-out, and the days they touch are fanned
    out anew into ``area_table``. Both tables have day folders; the rows of an
    area and hour are those of merging per (area, hour), without reading them.

    Each table changes at once. A job that dies between the two leaves the
    by-area model a batch behind; running it again brings it up to date.
    Gives the day folders written."""
    spark, day = stg.sparkSession, F.to_date("start_time")
    days = upsert_partitions(cell_table, stg.withColumn("start_day", day), ["geo_json", "start_time"], "start_day")
    touched = versioned.read(spark, cell_table, only=days).drop("start_day")
    rows = forecast_hourly_by_area(touched, areas, spread_by="to_date(start_time)")
    return versioned.load(rows.withColumn("start_day", day), area_table, ["start_day"], mode="partitions", in_order=True)


def split_bridge(stg: DataFrame, areas: DataFrame, bridge: DataFrame | None = None):
    """(single-polygon bridge, multi-polygon bridge or None).

    Distinct polygons come straight from the staged rows (a partial
    aggregate on one column; when ``stg`` is a published table this reads
    only the dictionary-encoded geo_json column). Polygons per area are a
    window over the small area-grain bridge (a few rows per area). The
    bridge feeds several branches, so it is checkpointed once (this also
    cuts the spatial join out of the lineage), and one tiny job tells
    whether any area lies in more than one polygon.
    """
    return by_number_of_cells(area_cells(areas, stg) if bridge is None else bridge)


def by_number_of_cells(bridge: DataFrame):
    """A bridge in two: the areas with one row, and those with more (or None)."""
    shared_dir(bridge.sparkSession)
    bridge = bridge.withColumn("_n_poly", F.count(F.lit(1)).over(Window.partitionBy("area_id")))
    bridge = bridge.checkpoint(eager=True)
    one = bridge.filter(F.col("_n_poly") == 1).drop("_n_poly")
    many = bridge.filter(F.col("_n_poly") > 1).drop("_n_poly")
    return one, (many if many.take(1) else None)


def newest_in_several_polygons(newest_cell: DataFrame, many: DataFrame) -> DataFrame:
    """Hourly rows of areas inside several polygons: newest per (area, hour)."""
    return latest_per_key(forecast_by_area(newest_cell, many).drop(CELL_KEY), ["area_id", "start_time"])


def _score(params: ScoreParams, variant: str):
    return climb_score("temperature_value", "precipitation_probability_value", "wind_speed_high",
                       "relative_humidity_value", params, variant).alias("climb_score")


def rollup_by_area(stg: DataFrame, areas: DataFrame, by: dict, aggs: list,
                   params: ScoreParams = DEFAULT_PARAMS, variant: str = "reference") -> DataFrame:
    """Aggregates of the scored hourly rows per (area, ``by`` columns),
    computed per polygon *before* the fan-out to areas.

    The score depends only on the forecast row, so for an area inside a
    single polygon its hours are exactly the polygon's newest hours and any
    aggregate over them is the polygon's aggregate: the polygon aggregates
    (one row per polygon and group) are fanned out instead of the hourly
    rows. Areas inside several polygons take the exact hourly path.
    ``by`` maps output names to Column expressions over ``start_time``; a
    group whose ``by`` value is NULL is dropped (use it as a filter).
    """
    newest_cell, few = newest_by_cell(stg)
    one, many = split_bridge(newest_cell, areas)
    newest_cell = newest_cell.drop("geo_json")
    names = list(by)

    def grouped(rows, key):
        keyed = rows.select(key, *[c.alias(n) for n, c in by.items()], _score(params, variant))
        keyed = keyed.filter(" AND ".join(f"`{n}` IS NOT NULL" for n in names)) if names else keyed
        return keyed.groupBy(key, *names).agg(*aggs)

    per_cell = grouped(newest_cell, CELL_KEY)
    # a polygon has no more groups than hours
    out = forecast_by_area(per_cell, one, few=few).drop(CELL_KEY)
    if many is not None:
        out = out.unionByName(grouped(newest_in_several_polygons(newest_cell, many), "area_id").select(*out.columns))
    return out


def fact_hourly_by_area(stg: DataFrame, areas: DataFrame, params: ScoreParams = DEFAULT_PARAMS, variant: str = "reference",
                        spread_by: str | None = None) -> DataFrame:
    """P10 straight from staged forecasts: rows are scored per polygon, before
    the fan-out to areas, so a score is worked out once per cell and hour. Same
    rows as ``fact_hourly(forecast_hourly_by_area(stg, areas))``. ``spread_by``
    (a SQL expression) is passed to :func:`~.spatial.forecast_by_area`."""
    newest_cell, few = newest_by_cell(stg)
    one, many = split_bridge(newest_cell, areas)
    newest_cell = newest_cell.drop("geo_json")
    cols = [*schemas.HOURLY_BY_AREA_COLUMNS, "climb_score"]
    scored = newest_cell.withColumn("climb_score", _score(params, variant))
    single = forecast_by_area(scored, one, spread_by=spread_by, few=few).select(*cols)
    if many is None:
        return single
    return single.unionByName(_in_order(fact_hourly(newest_in_several_polygons(newest_cell, many), params, variant), spread_by))


def fact_clustered_by_area(stg: DataFrame, areas: DataFrame, files: int, params: ScoreParams = DEFAULT_PARAMS,
                           variant: str = "reference") -> DataFrame:
    """The rows of :func:`fact_hourly_by_area` along a Z-order curve over area
    and hour, in ``files`` files. Few rows per polygon and hour take their
    places before the fan-out; many, and areas in several polygons, after it."""
    newest_cell, few = newest_by_cell(stg)
    one, many = split_bridge(newest_cell, areas)
    newest_cell = newest_cell.drop("geo_json")
    cols = [*schemas.HOURLY_BY_AREA_COLUMNS, "climb_score"]
    scored = newest_cell.withColumn("climb_score", _score(params, variant))
    single = forecast_by_area_clustered(scored, one, files) if few else clustered(
        forecast_by_area(scored, one), ["area_id"], ["start_time"], files)
    if many is None:
        return single.select(*cols)
    several = fact_hourly(newest_in_several_polygons(newest_cell, many), params, variant)
    return single.select(*cols).unionByName(clustered(several, ["area_id"], ["start_time"], files))


def _in_order(rows: DataFrame, spread_by: str | None) -> DataFrame:
    return rows.sortWithinPartitions(F.expr(spread_by), "area_id", "start_time") if spread_by else rows


def fact_hourly(hourly: DataFrame, params: ScoreParams = DEFAULT_PARAMS, variant: str = "reference") -> DataFrame:
    """P10: the hourly rows plus ``climb_score`` (a narrow projection)."""
    return hourly.select(*schemas.HOURLY_BY_AREA_COLUMNS, _score(params, variant))


def _daily_aggs():
    return [F.avg("climb_score").alias("avg_score"), F.min("climb_score").alias("min_score"),
            F.max("climb_score").alias("max_score"), F.count(F.lit(1)).alias("n_hours"),
            F.count("climb_score").alias("n_scored")]


def daily_score(fact: DataFrame) -> DataFrame:
    """Condition score per area and day (UTC) from a (published) fact
    table, with partial aggregation on the map side."""
    return fact.groupBy("area_id", F.to_date("start_time").alias("day")).agg(*_daily_aggs())


def daily_score_by_area(stg: DataFrame, areas: DataFrame,
                        params: ScoreParams = DEFAULT_PARAMS, variant: str = "reference") -> DataFrame:
    """D4 straight from staged forecasts: days aggregated per polygon, then
    fanned out to areas (:func:`rollup_by_area`); same rows as
    ``daily_score(fact_hourly(forecast_hourly_by_area(stg, areas)))``."""
    return rollup_by_area(stg, areas, {"day": F.to_date("start_time")}, _daily_aggs(), params=params, variant=variant)


def weekend_start(ts_col: str = "start_time"):
    """Saturday of the weekend a Saturday/Sunday time belongs to (else NULL)."""
    d = F.to_date(F.col(ts_col))
    dow = F.dayofweek(F.col(ts_col))  # 1 = Sunday, 7 = Saturday
    return F.when(dow == 7, d).when(dow == 1, F.date_sub(d, 1))


def weekend_ranking(fact: DataFrame, dim: DataFrame, top_k: int | None = None, leaves_only: bool = True) -> DataFrame:
    """D5: "climbable this weekend": rank crags within their parent area by
    mean Saturday+Sunday score: all of them, or the top ``top_k`` per
    (weekend, parent). Weekend hours are aggregated per (weekend, area) with
    partial aggregation. Ties rank by area id.
    """
    wk = (fact.select("area_id", weekend_start().alias("weekend"), "climb_score")
              .filter(F.col("weekend").isNotNull())
              .groupBy("weekend", "area_id").agg(*_weekend_aggs()))
    return rank_weekends(wk, dim, top_k, leaves_only)


def _weekend_aggs():
    return [F.avg("climb_score").alias("avg_score"), F.min("climb_score").alias("min_score"),
            F.max("climb_score").alias("max_score"), F.count(F.lit(1)).alias("n_hours")]


def weekend_ranking_by_area(stg: DataFrame, dim: DataFrame, top_k: int | None = None, leaves_only: bool = True,
                            params: ScoreParams = DEFAULT_PARAMS,
                            variant: str = "reference") -> DataFrame:
    """D5 straight from staged forecasts: weekend hours aggregated per
    polygon, fanned out to the areas, then ranked (:func:`rank_weekends`)."""
    wk = rollup_by_area(stg, dim, {"weekend": weekend_start()}, _weekend_aggs(), params=params, variant=variant)
    return rank_weekends(wk, dim, top_k, leaves_only)


# Ranks are counted in steps of this score within a (weekend, parent), equal
# scores in at most so many ranges of ids.
RANK_STEP = 0.01
RANK_RANGES = 1000


def _id_range(areas: DataFrame):
    """Number of the range that an area_id lies in, in the order of ids: one
    range per shuffle partition, between ids drawn by hash. Any bounds give the
    same ranks."""
    n = min(RANK_RANGES, int(areas.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = areas.select("area_id").orderBy(F.xxhash64("area_id")).limit(max(1, n - 1)).collect()
    if not drawn:
        return F.lit(0)
    return F.size(F.filter(F.array(*(F.lit(r.area_id) for r in drawn)), lambda bound: bound <= F.col("area_id")))


def rank_weekends(wk: DataFrame, dim: DataFrame, top_k: int | None = None, leaves_only: bool = True) -> DataFrame:
    """Crags ranked per (weekend, parent) from per-(weekend, area) aggregates
    (see :func:`weekend_ranking`).

    With ``top_k`` the rank filter becomes a ``WindowGroupLimit`` that keeps
    ``top_k`` rows per group inside each task before the shuffle. The complete
    ranking is counted in score steps, so a parent with a large share of all
    crags is no single task: a crag's rank is the number of crags in better
    steps, plus that of crags before its cell within the step (a cell holds the
    crags of one score and one range of ids), plus its place within the cell.
    Crags that all tie, as those of one polygon do, are as many cells as there
    are ranges."""
    areas = dim.select(F.col("id").alias("area_id"), "area_name", "parent_id", "is_leaf")
    if leaves_only:
        areas = areas.filter(F.col("is_leaf"))
    group = ["weekend", "parent_id"]
    best = [F.round("avg_score", 6).desc_nulls_last(), F.col("area_id").asc()]
    ranked_in = wk.join(areas.drop("is_leaf"), "area_id")
    if top_k is not None:
        ranked = (ranked_in.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*best)))
                  .filter(F.col("rank") <= top_k))
    else:
        step = F.coalesce(F.floor(F.round("avg_score", 6) / RANK_STEP), F.lit(-(1 << 40)))
        ranged = areas.filter(F.col("area_id").isNotNull()).drop("is_leaf")
        stepped = wk.join(ranged.withColumn("_range", _id_range(ranged)), "area_id").withColumns(
            {"_step": step, "_score": F.round("avg_score", 6)})
        cell = [*group, "_step", "_score", "_range"]
        cells = stepped.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(*group, "_step").orderBy(F.col("_score").desc_nulls_last(), "_range") \
            .rowsBetween(Window.unboundedPreceding, -1)
        better = Window.partitionBy(*group).orderBy(F.col("_step").desc()).rowsBetween(Window.unboundedPreceding, -1)
        steps = (cells.groupBy(*group, "_step").agg(F.sum("_n").alias("_n"))
                 .select(*group, "_step", F.coalesce(F.sum("_n").over(better), F.lit(0)).alias("_before"))
                 .toDF("_w", "_p", "_s", "_before"))
        # parents and scores may be null: the joins compare them as equal
        same = (F.col("weekend").eqNullSafe(F.col("_w")) & F.col("parent_id").eqNullSafe(F.col("_p"))
                & (F.col("_step") == F.col("_s")))
        counts = (cells.withColumn("_earlier", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(steps, same)
                  .select(*cell, F.col("_before") + F.col("_earlier")).toDF("_w", "_p", "_s", "_c", "_r", "_before"))
        place = F.row_number().over(Window.partitionBy(*cell).orderBy("area_id"))
        left = stepped.withColumn("_place", place)
        same = same & F.col("_score").eqNullSafe(F.col("_c")) & (F.col("_range") == F.col("_r"))
        ranked = left.join(counts, same).withColumn("rank", F.col("_before") + F.col("_place"))
    return ranked.select("weekend", "parent_id", "rank", "area_id", "area_name",
                         "avg_score", "min_score", "max_score", "n_hours")


# Miles per hour in one of each unit. The staged unit is the
# trailing letters of the wind text, so "km/h" arrives as "h".
MPH = {"h": 1 / 1.609344, "mph": 1.0, "mi/h": 1.0, "mp/h": 1.0, "km/h": 1 / 1.609344, "kmh": 1 / 1.609344, "kph": 1 / 1.609344,
       "m/s": 3600 / 1609.344, "kt": 1852 / 1609.344, "kn": 1852 / 1609.344, "knots": 1852 / 1609.344}


def celsius(value: str = "temperature_value", unit: str = "temperature_unit"):
    """A reading in degrees C; NULL when its unit is neither F nor C."""
    u = F.lower(F.regexp_replace(unit, "^(wmoUnit:deg|°)", ""))
    return F.when(u == "f", (F.col(value) - 32) * 5 / 9).when(u == "c", F.col(value))


def standardize_units(df: DataFrame) -> DataFrame:
    """Temperature to degrees C and wind speed to mph, units relabelled.
    A unit that is not known keeps its value and its label."""
    known_t = F.lower(F.regexp_replace("temperature_unit", "^(wmoUnit:deg|°)", "")).isin("f", "c")
    factor = F.element_at(F.create_map(*(F.lit(x) for pair in MPH.items() for x in pair)),
                          F.lower("wind_speed_unit"))
    out = df.withColumns({
        "temperature_value": F.when(known_t, celsius()).otherwise(F.col("temperature_value")),
        "temperature_unit": F.when(known_t, F.lit("C")).otherwise(F.col("temperature_unit")),
        **{c: F.col(c) * F.coalesce(factor, F.lit(1.0)) for c in ("wind_speed_low", "wind_speed_high")},
    })
    return out.withColumn("wind_speed_unit", F.when(factor.isNotNull(), F.lit("mph"))
                          .otherwise(F.col("wind_speed_unit")))
