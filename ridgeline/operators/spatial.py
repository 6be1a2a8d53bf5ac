"""Spatial join of points to polygons (J1, J3, J4, DQ6).

The join is an equi-join on cells of a hierarchical grid whose sizes are the
powers of two. A polygon is covered by few cells of mixed sizes: it begins with
the at most four cells of its own extent, and cells that its boundary runs
through are divided a fixed number of times; cells outside are dropped, and a
point in a cell that lies inside needs no test. A point goes to its one cell
of every size in use. So a polygon has at most ``4 ** (REFINE + 1)`` rows
whatever its extent, and Spark plans a hash join (broadcast when AQE sees a
small side at runtime, shuffle otherwise) instead of a nested loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.geo import bbox, edges, is_axis_rectangle, parts_from_geojson, point_in_rings, repaired, rings_from_geojson
from ..session import shared_dir
from ..sources.tables import point_place, range_places, store_bucketed, z_order

REFINE = 2
# sizes 2 ** -30 to 2 ** 40 degrees
LEVELS = (-30, 40)


def polygons_from_geojson(df: DataFrame, geo_col: str = "geo_json", distinct: bool = True,
                          keep: tuple[str, ...] = (), geodesic: bool = False) -> DataFrame:
    """Distinct GeoJSON polygons made valid, one row per part: ``rings``,
    ``edges``, ``bbox``, ``is_rect``, and with ``geodesic`` also ``arcs``.

    Geometry collections are flattened to their polygons. Open rings are
    closed; an edge over 180 degrees wide takes the shorter way, across the
    antimeridian, and such a part is given on both sides of it; a ring round a
    pole is closed over the pole. Edges are cut where they meet (planar noding)
    and pieces that are gone along twice removed, so that the interior is what
    an odd number of rings encloses. Axis-parallel rectangles need none of it.

    GeoJSON edges are straight in longitude and latitude; ``geodesic`` takes
    them as great-circle arcs. ``distinct`` dedups the text first (a partial
    hash aggregate: each map task ships one row per distinct polygon), so rings
    are parsed once per polygon, not once per forecast row.
    """
    src = df.select(geo_col, *keep).filter(F.col(geo_col).isNotNull())
    if distinct:
        src = src.distinct()
    # a row per part: a point is inside when it is inside any part
    parts = src.select("*", F.explode(parts_from_geojson(geo_col)).alias("_part"))
    whole = parts.select("*", repaired("_part").alias("_closed")).drop("_part").filter(F.size("_closed") > 0)
    whole = whole.select("*", F.expr(geo.unwrapped_sql("_closed")).alias("_rings")).drop("_closed")
    sides = whole.select("*", bbox("_rings").alias("_box")).select("*", F.explode(F.expr(geo.shifts_sql("_box"))).alias("_by"))
    rings = sides.select("*", F.expr(geo.shifted_sql("_rings", "_by")).alias("rings")).drop("_rings", "_box", "_by")
    out = rings.select("*", F.expr(geo.solid_edges_sql("rings")).alias("_edges"), bbox("rings").alias("bbox"),
                       is_axis_rectangle("rings").alias("is_rect"))
    if geodesic:
        out = out.select("*", F.expr(geo.arcs_sql("_edges")).alias("arcs")).drop("bbox", "is_rect")
        return out.select("*", F.expr(geo.arc_box_sql("arcs")).alias("bbox"), F.lit(False).alias("is_rect"),
                          F.col("_edges").alias("edges")).drop("_edges")
    # CASE is lazy: rectangles are not noded
    out = out.select("*", F.expr(f"CASE WHEN NOT is_rect THEN {geo.slabs_sql('_edges', 'bbox')} END").alias("_slabs"))
    out = out.select("*", F.expr(f"CASE WHEN NOT is_rect THEN {geo.pieces_sql('_edges', '_slabs', 'bbox')} END")
                     .alias("_pieces")).drop("_slabs")
    return out.select("*", F.expr(f"CASE WHEN is_rect THEN _edges ELSE {geo.odd_sql('_pieces')} END").alias("edges")
                      ).drop("_edges", "_pieces")


def cover(polygons: DataFrame, refine: int = REFINE) -> DataFrame:
    """Polygons by the grid cells that cover them: ``_level`` (the cell is
    ``2 ** _level`` degrees wide), ``_bx``, ``_by`` and ``_inside`` (the cell
    lies in the polygon). A rectangle is one comparison anyway and an arc is
    not straight, so both stay at their first, at most four, cells."""
    b = F.col("bbox")
    extent = F.greatest(b["xmax"] - b["xmin"], b["ymax"] - b["ymin"])
    level = F.when(extent > 0, F.ceil(F.log2(extent))).otherwise(LEVELS[0])
    out = polygons.withColumn("_level", F.least(F.greatest(level, F.lit(LEVELS[0])), F.lit(LEVELS[1])).cast("int"))
    size = "pow(2D, _level)"
    for axis in "xy":
        first, last = (f"CAST(floor(bbox.{axis}{end} / {size}) AS bigint)" for end in ("min", "max"))
        out = out.select("*", F.explode(F.expr(f"sequence({first}, {last})")).alias(f"_b{axis}"))
    if "arcs" in polygons.columns:
        return out.withColumn("_inside", F.lit(False))
    names = [c for c in out.columns if c not in ("_level", "_bx", "_by")]
    out = out.withColumn("_state", F.lit(1))
    for step in range(refine + 1):
        children = ("transform(array((0, 0), (0, 1), (1, 0), (1, 1)), c -> struct(_level - 1 AS l, 2 * _bx + c.col1 AS x, "
                    "2 * _by + c.col2 AS y, 1 AS s))")
        own = "array(struct(_level AS l, _bx AS x, _by AS y, _state AS s))"
        cells = f"CASE WHEN is_rect OR _state = 2 THEN {own} ELSE {children} END" if step else own
        # 0 outside, 1 on the boundary, 2 inside
        here = ("(_c.x * pow(2D, _c.l))", "(_c.y * pow(2D, _c.l))", "pow(2D, _c.l)")
        parity = geo.point_in_edges_sql("edges", f"({here[0]} + {here[2]} / 2)", f"({here[1]} + {here[2]} / 2)")
        state = (f"CASE WHEN is_rect THEN 1 WHEN _c.s = 2 THEN 2 WHEN {geo.cell_meets_sql('edges', *here)} THEN 1 "
                 f"WHEN {parity} THEN 2 ELSE 0 END")
        out = (out.select(*names, F.explode(F.expr(cells)).alias("_c")).select("*", F.expr(state).alias("_state"))
               .filter("_state > 0").select(*names, F.col("_c.l").alias("_level"), F.col("_c.x").alias("_bx"),
                                            F.col("_c.y").alias("_by"), "_state"))
    return out.withColumn("_inside", F.col("_state") == 2).drop("_state")


def spatial_join(points: DataFrame, polygons: DataFrame, x_col: str = "longitude", y_col: str = "latitude",
                 salt: int = 1, levels: Sequence[int] | None = None) -> DataFrame:
    """All (point, polygon) pairs with the point strictly inside.

    ``polygons`` come from :func:`polygons_from_geojson`, or have ``rings``
    only, from which ``edges``, ``bbox`` and ``is_rect`` are computed; with
    ``arcs`` containment is that of the sphere. Points with a NULL coordinate
    never match. ``salt > 1`` spreads a hot cell (one dense place holding a
    large share of points) over ``salt`` join keys: points pick a salt from
    their own hash, polygons are replicated once per salt value. AQE skew-join
    splitting covers the shuffled case automatically as well.

    Points go to one cell per level in use. The levels are read from the
    covering cells, which are checkpointed for that (a row per polygon and
    cell; one job); ``levels`` names them beforehand and saves that job.
    """
    for name, make in (("edges", edges), ("bbox", bbox), ("is_rect", is_axis_rectangle)):
        if name not in polygons.columns:
            polygons = polygons.withColumn(name, make("rings"))
    on_sphere = "arcs" in polygons.columns
    cells = cover(polygons)
    # what an inside cell and a rectangle never look at need not be shuffled
    cells = cells.withColumns({c: F.when(~F.col("_inside") & ~F.col("is_rect"), F.col(c))
                               for c in ("edges", "arcs") if c in cells.columns}).drop("rings")
    if levels is None:
        shared_dir(cells.sparkSession)
        cells = cells.checkpoint(eager=True)
        levels = sorted(r[0] for r in cells.select("_level").distinct().collect())
    px, py = F.col(x_col).cast("double"), F.col(y_col).cast("double")
    pts = points.filter(F.col(x_col).isNotNull() & F.col(y_col).isNotNull()).select(
        "*", px.alias("_px"), py.alias("_py"),
        F.explode(F.array(*(F.lit(int(v)) for v in levels)).cast("array<int>")).alias("_level"))
    pts = pts.select("*", *(F.expr(f"CAST(floor({p} / pow(2D, _level)) AS bigint)").alias(c)
                            for p, c in (("_px", "_bx"), ("_py", "_by"))))
    if on_sphere:
        pts = pts.withColumn("_unit", F.expr(geo.unit_sql("_px", "_py")))
    keys = ["_level", "_bx", "_by"]
    if salt > 1:
        pts = pts.withColumn("_salt", F.pmod(F.xxhash64(*points.columns), F.lit(salt)))
        cells = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<long>")).alias("_salt"))
        keys.append("_salt")
        # the output, not the few bytes that meet, is to be spread
        n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pts, cells = pts.repartition(n, *keys), cells.repartition(n, *keys)
    joined = pts.join(cells, keys, "inner")
    exact = geo.point_in_arcs_sql("arcs", "bbox", "_px", "_py", "_unit") if on_sphere else \
        geo.point_in_polygon_sql("edges", "bbox", "is_rect", "_px", "_py")
    return joined.filter(F.expr(f"_inside OR {exact}")).drop(*keys, "_px", "_py", "_inside", "_unit")


def distinct_pairs(points: DataFrame, polygons: DataFrame, point_id: str = "point_id", polygon_id: str = "polygon_id",
                   salt: int = 1) -> DataFrame:
    """Distinct pairs of ids of :func:`spatial_join`, without a shuffle of the
    pairs where none can come twice: a point id with one place and a polygon id
    with one part, or parts that lie side by side, meet once. Only pairs of ids
    with several places, or with parts whose boxes may overlap, are compared.

    ``points`` have ``longitude`` and ``latitude``, ``polygons`` come from
    :func:`polygons_from_geojson`. Both are checkpointed with what was found
    about their ids (rows of the inputs, not pairs); a branch of the plan that
    no row would take is left out."""
    shared_dir(points.sparkSession)
    points = points.select(point_id, "longitude", "latitude").distinct()
    several = F.count(F.lit(1)).over(Window.partitionBy(point_id)) > 1
    points = points.withColumn("_several", several).checkpoint(eager=True)
    west = Window.partitionBy(polygon_id).orderBy("bbox.xmin")
    # NaN is greater than any number, so a box that has it counts as overlapping
    reach = F.max("bbox.xmax").over(west.rowsBetween(Window.unboundedPreceding, -1))
    polygons = polygons.withColumn("_meets", F.coalesce(reach >= F.col("bbox.xmin"), F.lit(False)))
    polygons = polygons.withColumn("_several", F.max("_meets").over(Window.partitionBy(polygon_id))).drop("_meets")
    polygons = polygons.checkpoint(eager=True)

    def side(df: DataFrame, several: bool) -> DataFrame:
        return df.filter(F.col("_several") == several).drop("_several")

    def pairs(pts: DataFrame, polys: DataFrame) -> DataFrame:
        return spatial_join(pts, polys, salt=salt).select(point_id, polygon_id)
    out = pairs(side(points, False), side(polygons, False))
    twice = []
    if side(polygons, True).take(1):
        twice.append(pairs(points.drop("_several"), side(polygons, True)))
    if side(points, True).take(1):
        twice.append(pairs(side(points, True), side(polygons, False)))
    return reduce(DataFrame.unionByName, [out, *(t.distinct() for t in twice)])


def assign_cells(areas: DataFrame, cells: DataFrame, salt: int = 1) -> DataFrame:
    """Resolve each area's point to its forecast cell(s), once per area.

    ``areas``: ``id, latitude, longitude``; ``cells``: ``grid_id, grid_x,
    grid_y, geo_json``. Returns ``area_id, grid_id, grid_x, grid_y``."""
    polys = polygons_from_geojson(cells, distinct=False, keep=("grid_id", "grid_x", "grid_y"))
    pts = areas.select(F.col("id").alias("area_id"), "latitude", "longitude")
    return spatial_join(pts, polys, salt=salt).select("area_id", "grid_id", "grid_x", "grid_y").distinct()


def area_polygons(areas: DataFrame, forecast: DataFrame, salt: int = 1) -> DataFrame:
    """Bridge ``(area_id, geo_json)``: which forecast polygons contain each
    area (containment evaluated once per area and distinct polygon)."""
    polys = polygons_from_geojson(forecast, "geo_json", distinct=True)
    pts = areas.select(F.col("id").alias("area_id"), "latitude", "longitude")
    # parts may overlap: one row per area and polygon
    return spatial_join(pts, polys, salt=salt).select("area_id", "geo_json").distinct()


CELL_KEY = "cell_key"


def keyed_by_cell(df: DataFrame, geo_col: str = "geo_json") -> DataFrame:
    """``df`` with ``cell_key`` (a long) in place of the polygon text, so that
    no shuffle carries the text. :func:`cell_dictionary` checks that no two
    texts have one key."""
    return df.withColumn(CELL_KEY, F.xxhash64(geo_col)).drop(geo_col)


def cell_dictionary(forecast: DataFrame, geo_col: str = "geo_json") -> DataFrame:
    """``cell_key, geo_json``, one row per polygon; two texts with the same key
    fail the job (a chance of about n * n / 2 ** 65 for n polygons)."""
    texts = forecast.filter(F.col(geo_col).isNotNull()).select(F.xxhash64(geo_col).alias(CELL_KEY), geo_col).distinct()
    checked = texts.groupBy(CELL_KEY).agg(F.min(geo_col).alias(geo_col), F.max(geo_col).alias("_other"))
    return checked.select(CELL_KEY, F.when(F.col(geo_col) == F.col("_other"), F.col(geo_col)).otherwise(
        F.raise_error(F.lit("two polygons have one cell key"))).alias(geo_col))


def area_cells(areas: DataFrame, forecast: DataFrame, salt: int = 1) -> DataFrame:
    """The bridge by key: ``(area_id, cell_key)`` (see :func:`area_polygons`)."""
    polys = polygons_from_geojson(cell_dictionary(forecast), distinct=False, keep=(CELL_KEY,)).drop("geo_json")
    pts = areas.select(F.col("id").alias("area_id"), "latitude", "longitude")
    return spatial_join(pts, polys, salt=salt).select("area_id", CELL_KEY).distinct()


AREAS_PER_SALT = 256
AREA_PARTS = 4
ROW_SALTS = 16


def _cell_column(df: DataFrame) -> str:
    return CELL_KEY if CELL_KEY in df.columns else "geo_json"


def _area_lists(area_cells: DataFrame, keys: list[str], areas_per_list: int) -> tuple[DataFrame, DataFrame]:
    """The bridge with the areas of a key in lists ``_areas`` of bounded length,
    dealt to the parts ``_part`` of the key, and the parts ``_n_part`` per key."""
    n_lists = F.ceil(F.col("_n") / F.lit(areas_per_list))
    counts = area_cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(*keys, n_lists.alias("_n_lists"))
    parts = counts.select(*keys, F.least("_n_lists", F.lit(AREA_PARTS)).cast("int").alias("_n_part"))
    block = F.pmod(F.xxhash64("area_id"), F.col("_n_lists"))
    areas = F.struct(*(c for c in area_cells.columns if c not in keys))
    lists = (area_cells.join(counts, keys).groupBy(*keys, block.alias("_block"))
             .agg(F.collect_list(areas).alias("_areas")))
    return lists.select(*keys, "_areas", F.pmod("_block", F.lit(AREA_PARTS)).cast("int").alias("_part")), parts


def forecast_by_area(forecast: DataFrame, area_cells: DataFrame, on=None,
                     areas_per_salt: int = AREAS_PER_SALT, row_salts: int = ROW_SALTS,
                     partitions: int | None = None, spread_by: str | None = None, few: bool = False) -> DataFrame:
    """Equi-join of forecast rows to areas on the cell key (``on``; without
    it ``cell_key``, or the polygon text where there is none).

    This join fans out: every forecast row of a cell is copied to every area
    inside it, so the output is (rows per cell) x (areas per cell) and both
    inputs can be tiny next to it. A cell is therefore a grid of blocks:

    * by area: the areas of a cell are dealt to lists of about
      ``areas_per_salt``, its lists to at most ``AREA_PARTS`` parts; a forecast
      row is copied to each part, so the rows shuffled grow with the input,
      not with the output;
    * by row: a forecast row picks one of ``row_salts``, a list is copied to
      each, so the long history of one cell spreads as well;
    * both sides are hash-partitioned on (cell key, part, salt) into
      ``partitions`` (default ``spark.sql.shuffle.partitions``, sized for the
      cluster), so output parallelism follows the output, not the small input.

    The lists are the left side, so a merge join keeps the rows of one block
    and passes them by every list. A file of the result so meets few areas at a
    time, over and over, and packs them into a small part of a byte.

    ``spread_by`` (a SQL expression over the forecast row, such as its day)
    makes rows of equal value share a row salt, so that few values meet in a
    task and a table in folders by that value is written without a shuffle;
    within a task the rows of a value (and range of areas) come by area and
    ``start_time``.

    ``few`` says that the forecast rows are few (the caller has counted them):
    they are broadcast, and the bridge alone is shuffled, by area. The output
    is then partitioned and sorted by area, so that what groups it by area
    shuffles and sorts nothing. With ``spread_by`` the bridge has a row per
    area and value instead, shuffled by the value and ranges of areas; the rows
    of a value come together, by area, then in the order of ``start_time``.

    For a table stored in buckets see :func:`stored_forecast_by_area`.
    """
    keys = list(on or [_cell_column(forecast)])
    spark = forecast.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out_cols = forecast.columns + [c for c in area_cells.columns if c not in keys]
    if few:
        # only where the rows come in the order of the groups
        spark.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")
    if few and not spread_by:
        # a window, since the optimizer drops a plain sort below a join
        n_cells = F.count(F.lit(1)).over(Window.partitionBy("area_id"))
        areas = area_cells.repartition(n, "area_id").withColumn("_n_cells", n_cells).filter("_n_cells > 0")
        return areas.join(F.broadcast(forecast), keys).select(*out_cols)
    if few:
        lists = forecast.select("*", F.expr(spread_by).alias("_spread")).groupBy(*keys, "_spread").agg(
            F.sort_array(F.collect_list(F.struct("start_time", *(c for c in forecast.columns if c not in ("start_time", *keys))))
                         ).alias("_rows"))
        values = lists.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), F.col("_spread").alias("_value"), "_rows")
        days = area_cells.join(F.broadcast(lists.drop("_rows")), keys)
        days = days.withColumn("_block", F.pmod(F.xxhash64("area_id"), F.lit(row_salts)))
        in_order = Window.partitionBy("_spread", "_block").orderBy("area_id").rowsBetween(Window.unboundedPreceding, 0)
        days = days.repartition(n, "_spread", "_block").withColumn("_nth", F.count(F.lit(1)).over(in_order)).filter("_nth > 0")
        same = reduce(and_, (F.col(k) == F.col(f"_key{i}") for i, k in enumerate(keys)), F.col("_spread").eqNullSafe(F.col("_value")))
        return days.join(F.broadcast(values), same).select(*area_cells.columns, F.inline("_rows")).select(*out_cols)
    lists, parts = _area_lists(area_cells, keys, areas_per_salt)
    bridge = lists.select("*", F.explode(F.sequence(F.lit(0), F.lit(row_salts - 1))).alias("_row_salt"))
    rows = forecast.join(parts, keys).select(
        *forecast.columns, F.explode(F.sequence(F.lit(0), F.col("_n_part") - 1)).alias("_part"),
        F.pmod(F.xxhash64(F.expr(spread_by) if spread_by else F.struct(*forecast.columns)), F.lit(row_salts)).cast("int")
        .alias("_row_salt"))
    part = keys + ["_part", "_row_salt"]
    met = bridge.repartition(n, *part).join(rows.repartition(n, *part), part)
    out = met.select(*forecast.columns, F.inline("_areas")).select(*out_cols)
    return out.sortWithinPartitions(F.expr(spread_by), "area_id", "start_time") if spread_by else out


CURVE_BITS = 8


def forecast_by_area_clustered(forecast: DataFrame, area_cells: DataFrame, files: int, bits: int = CURVE_BITS) -> DataFrame:
    """J4 for few forecast rows, laid out as :func:`~..sources.tables.clustered`
    lays out the result by area and ``start_time``, but placed before the
    fan-out: what is shuffled is an area once per file that it is in (about the
    root of ``files``), not its wide rows.

    The rows of every place on the curve are counted from the areas per (cell,
    area's place) and the rows per (cell, hour's place), and the curve is cut
    into ``files`` parts of about equal numbers. Within a file rows come by the
    area's place and area, then hour's place and time."""
    hours = forecast.withColumn("_q", range_places(forecast, ["start_time"], bits)[0])
    areas = area_cells.withColumn("_p", point_place("area_id", bits))
    rows = areas.groupBy(CELL_KEY, "_p").agg(F.count(F.lit(1)).alias("_a")).join(
        hours.groupBy(CELL_KEY, "_q").agg(F.count(F.lit(1)).alias("_h")), CELL_KEY)
    # at most 4 ** bits rows from here on
    counts = rows.groupBy("_p", "_q").agg(F.sum(F.col("_a") * F.col("_h")).alias("_n"))
    along = Window.orderBy(z_order([F.col("_p"), F.col("_q")], bits))
    before = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    total = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    placed = counts.select("_p", "_q", F.floor(before * files / total).cast("int").alias("_file"))
    strips = placed.groupBy("_p", "_file").agg(F.sort_array(F.collect_list("_q")).alias("_qs")).localCheckpoint()
    columns = [c for c in forecast.columns if c != CELL_KEY]
    lists = hours.groupBy(F.col(CELL_KEY).alias("_cell"), F.col("_q").alias("_hour")).agg(
        F.sort_array(F.collect_list(F.struct("start_time", *(c for c in columns if c != "start_time")))).alias("_rows"))
    # a window, since the optimizer drops a plain sort below a join
    in_order = Window.partitionBy("_file").orderBy("_p", "area_id").rowsBetween(Window.unboundedPreceding, 0)
    dealt = (areas.join(F.broadcast(strips.drop("_qs")), "_p").repartitionById(files, "_file")
             .withColumn("_nth", F.count(F.lit(1)).over(in_order)).filter("_nth > 0"))
    at = dealt.join(F.broadcast(strips), ["_p", "_file"]).select(*area_cells.columns, F.explode("_qs").alias("_q"))
    met = at.join(F.broadcast(lists), (F.col(CELL_KEY) == F.col("_cell")) & (F.col("_q") == F.col("_hour")))
    return met.select(*area_cells.columns, F.inline("_rows")).select(
        *forecast.columns, *(c for c in area_cells.columns if c != CELL_KEY))


ROW_SALT = "row_salt"


def store_forecast(forecast: DataFrame, name: str, path: str, buckets: int, row_salts: int = ROW_SALTS,
                   geo_col: str = "geo_json") -> DataFrame:
    """J4, stored side: the forecast as a catalog table in ``buckets`` of
    (cell key, row salt), sorted by them and the hour. The salt spreads a cell
    with a long history over as many buckets; the polygon text is left to
    :func:`cell_dictionary`."""
    rows = keyed_by_cell(forecast, geo_col)
    salted = rows.withColumn(ROW_SALT, F.pmod(F.xxhash64(*rows.columns), F.lit(row_salts)).cast("int"))
    return store_bucketed(salted, name, path, [CELL_KEY, ROW_SALT], buckets, ["start_time"])


def stored_forecast_by_area(stored: DataFrame, area_cells: DataFrame, buckets: int, row_salts: int = ROW_SALTS,
                            areas_per_row: int = AREAS_PER_SALT) -> DataFrame:
    """J4 on a table of :func:`store_forecast`: only the bridge is shuffled, to
    the table's buckets, with the areas of a cell in lists of bounded length
    (a crowded cell has several), so the stored rows meet it where they lie.
    A task hashes the rows of its bucket (the columns that are read) and passes
    the lists by them, so that a file of the result meets few areas at a time;
    a bucket has to fit in the memory of a task."""
    lists, _ = _area_lists(area_cells, [CELL_KEY], areas_per_row)
    bridge = lists.select(CELL_KEY, "_areas", F.explode(F.sequence(F.lit(0), F.lit(row_salts - 1))).alias(ROW_SALT))
    met = stored.hint("shuffle_hash").join(bridge.repartition(buckets, CELL_KEY, ROW_SALT), [CELL_KEY, ROW_SALT])
    return met.select(*(c for c in stored.columns if c != ROW_SALT), F.inline("_areas"))


def check_containment(joined: DataFrame, geo_col: str = "geo_json", x_col: str = "longitude",
                      y_col: str = "latitude") -> DataFrame:
    """DQ6: rows of a cell-key join whose point is not inside the cell's
    polygon (zero rows is a pass)."""
    with_rings = joined.select("*", rings_from_geojson(geo_col).alias("_rings"))
    return with_rings.filter(~point_in_rings("_rings", x_col, y_col)).drop("_rings")
