"""Bindings: the driver's parquet tables expressed in the domain's landing
shapes. Every binding is a Spark plan over the given tables, so its work
grows with them.

* cells: nation ``g`` is the unit square with lower-left ``(g % 5, g div 5)``.
* areas: regions ``R{r}`` (no coordinates), nations ``N{n}`` (cell centre),
  customers ``C{c}`` (leaves) at dyadic points that are never on an edge.
* forecast documents: one per (cell ``user_id % 25``, hour of ``ts``, block of
  24 event ids); every event is the period of its ``event_id % 24`` slot. The
  block shows in the milliseconds of the extraction time, so (generated,
  extracted) orders all documents of a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import iso_utc
from ..sources.landing import to_records

# Fixed values of the bindings.
N_CELLS = 25
GRID_COLS = 5
N_SLOTS = 24
GRID_ID = "CELL"
AS_OF = "2024-01-15 12:00:00"
SOURCE_A_TYPES = ("view", "click")
SOURCE_B_TYPES = ("signup", "error")
ACTUAL_TYPES = ("purchase",)


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's parquet table; the resolved relation is reused within a
    session (the input files are read-only), which saves a file listing and
    footer read every time a query is built."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _square(x0: Column, y0: Column) -> Column:
    x0, y0 = x0.cast("double"), y0.cast("double")
    x1, y1 = x0 + F.lit(1.0), y0 + F.lit(1.0)
    ring = F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """b_cells: ``grid_id, grid_x, grid_y, geo_json`` from ``nation``."""
    n = table(spark, sf_dir, "nation")
    g = F.col("n_nationkey").cast("long")
    gx, gy = g % GRID_COLS, F.floor(g / GRID_COLS).cast("long")
    return n.select(F.lit(GRID_ID).alias("grid_id"), gx.alias("grid_x"), gy.alias("grid_y"),
                    F.to_json(_square(gx, gy)).alias("geo_json"))


def _customer_point(c: Column):
    lng = ((c * 7) % 80) / F.lit(16.0) + F.lit(1 / 32)
    lat = ((c * 13) % 80) / F.lit(16.0) + F.lit(1 / 32)
    return lat, lng


def _metadata(lat: Column, lng: Column, leaf: Column) -> Column:
    return F.to_json(F.struct(lat.alias("lat"), lng.alias("lng"), leaf.alias("leaf")), {"ignoreNullFields": "false"})


def raw_areas(spark: SparkSession, sf_dir: str, plant_bad: bool = False) -> DataFrame:
    """b_area as the raw area table: ``uuid, area_name, areaName,
    pathTokens, ancestors, children (JSON), metadata (JSON)``.

    ``plant_bad`` replaces the last ancestor of every 83rd customer by ``X``
    and nulls the metadata of every 89th.
    """
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    null_d = F.lit(None).cast("double")

    rid = F.concat(F.lit("R"), F.col("r_regionkey").cast("string"))
    nid = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    cid = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))

    nation_children = (n.groupBy("n_regionkey")
                        .agg(F.to_json(F.sort_array(F.collect_list(F.struct(F.col("n_name").alias("area_name"),
                                                                               nid.alias("uuid"))))).alias("children")))
    regions = r.join(nation_children, r["r_regionkey"] == nation_children["n_regionkey"], "left").select(
        rid.alias("uuid"), F.col("r_name").alias("area_name"), F.col("r_name").alias("areaName"),
        F.array(F.col("r_name")).alias("pathTokens"), F.array(rid).alias("ancestors"),
        F.col("children"), _metadata(null_d, null_d, F.lit(False)).alias("metadata"))

    g = F.col("n_nationkey").cast("long")
    nations = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        nid.alias("uuid"), F.col("n_name").alias("area_name"), F.col("n_name").alias("areaName"),
        F.array("r_name", "n_name").alias("pathTokens"), F.array(rid, nid).alias("ancestors"),
        F.lit(None).cast("string").alias("children"),
        _metadata(F.floor(g / GRID_COLS) + F.lit(0.5), (g % GRID_COLS) + F.lit(0.5), F.lit(False)).alias("metadata"))

    ck = F.col("c_custkey")
    lat, lng = _customer_point(ck)
    name = F.when(ck % 5 == 0, F.concat(F.col("c_name"), F.lit(", The"))).otherwise(F.col("c_name"))
    last = F.when(F.lit(plant_bad) & (ck % 83 == 0), F.lit("X")).otherwise(cid)
    nr = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    customers = c.join(nr, c["c_nationkey"] == nr["n_nationkey"]).select(
        cid.alias("uuid"), name.alias("area_name"), name.alias("areaName"),
        F.array(F.col("r_name"), F.col("n_name"), name).alias("pathTokens"),
        F.array(rid, nid, last).alias("ancestors"),
        F.lit("[]").alias("children"),
        F.when(~(F.lit(plant_bad) & (ck % 89 == 0)), _metadata(lat, lng, F.lit(True))).alias("metadata"))
    return regions.unionByName(nations).unionByName(customers)


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries are the region names."""
    return table(spark, sf_dir, "region").select(F.col("r_name").alias("areaName"))


def _events(spark, sf_dir, types=None) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    if types is not None:
        ev = ev.filter(F.col("event_type").isin(list(types)))
    return ev


def raw_forecast_docs(spark: SparkSession, sf_dir: str, types=None, plant_bad: bool = False) -> DataFrame:
    """b_docs as the raw forecast table ``(data JSON text, extracted_at_ts)``.

    Every event is one period. A document holds the events of one block of
    event ids, at most 24, so no group grows with the data.
    """
    ev = _events(spark, sf_dir, types)
    picked = ev.select(
        (F.col("user_id") % N_CELLS).alias("g"), F.date_trunc("hour", "ts").alias("hr"),
        F.floor(F.col("event_id") / N_SLOTS).alias("blk"), (F.col("event_id") % N_SLOTS).alias("slot"),
        F.struct("event_id", "event_type", "value", "props").alias("e"))

    e = F.col("e")
    eid = e["event_id"]
    start = F.date_trunc("day", "hr") + F.make_interval(hours=F.col("slot").cast("int"))
    m20 = (eid % 20).cast("string")
    wind = (F.when(eid % 13 == 0, F.lit("calm"))
             .when(eid % 2 == 0, F.concat(m20, F.lit(" mph")))
             .otherwise(F.concat(m20, F.lit(" to "), (eid % 20 + 5).cast("string"), F.lit(" mph"))))
    temp = F.floor(e["value"]).cast("long")
    if plant_bad:
        temp = F.when(eid % 97 == 0, F.lit(None).cast("long")).otherwise(temp)
    period = F.struct(
        iso_utc(start, True).alias("startTime"),
        iso_utc(start + F.expr("INTERVAL 1 HOUR"), True).alias("endTime"),
        temp.alias("temperature"),
        F.lit("F").alias("temperatureUnit"),
        F.struct(F.lit("wmoUnit:percent").alias("unitCode"),
                 F.when(eid % 7 == 0, F.lit(None).cast("long")).otherwise(eid % 101).alias("value")
                 ).alias("probabilityOfPrecipitation"),
        F.struct(F.lit("wmoUnit:degC").alias("unitCode"), (e["value"] / 4).alias("value")).alias("dewpoint"),
        F.struct(F.lit("wmoUnit:percent").alias("unitCode"),
                 F.get_json_object(e["props"], "$.k").cast("long").alias("value")).alias("relativeHumidity"),
        wind.alias("windSpeed"),
        F.lit("NW").alias("windDirection"),
        e["event_type"].alias("shortForecast"),
    )
    # making a document costs far more than its few bytes, by which AQE would
    # merge the partitions into a task or so more than there are cores
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = (picked.repartition(n, "g", "hr", "blk").groupBy("g", "hr", "blk")
                  .agg(F.sort_array(F.collect_list(F.struct(F.col("slot"), period.alias("p")))).alias("ps")))
    g = F.col("g").cast("long")
    gx, gy = g % GRID_COLS, F.floor(g / GRID_COLS).cast("long")
    gen = iso_utc(F.col("hr"), True)
    data = F.struct(
        _square(gx, gy).alias("geometry"),
        F.struct(gen.alias("generatedAt"), F.concat(gen, F.lit("/P1D")).alias("validTimes"),
                 F.struct(F.lit("wmoUnit:m").alias("unitCode"), (g * F.lit(10.5)).alias("value")).alias("elevation"),
                 F.transform("ps", lambda x: x["p"]).alias("periods")).alias("properties"))
    return docs.select(F.to_json(data, {"ignoreNullFields": "false"}).alias("data"),
                       F.timestamp_millis(F.unix_millis("hr") + 3_600_000 + F.col("blk")).alias("extracted_at_ts"))


def raw_gridpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only resolutions: every customer area is resolved on two run
    days, and again on the days its user (``user_id = c_custkey``) has events."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    days = F.array(F.lit("2024-01-01").cast("date"), F.lit("2024-01-20").cast("date"))
    runs = c.select("c_custkey", F.explode(days).alias("run_day"))
    again = _events(spark, sf_dir).select(F.col("user_id"), F.to_date("ts").alias("run_day")).distinct()
    runs = runs.union(again.join(c, again["user_id"] == c["c_custkey"]).select("c_custkey", "run_day"))
    lat, lng = _customer_point(F.col("c_custkey"))
    gx, gy = F.floor(lng).cast("long"), F.floor(lat).cast("long")
    return runs.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("area_id"),
        F.lit(GRID_ID).alias("grid_id"), gx.alias("grid_x"), gy.alias("grid_y"), "run_day")


def gridpoint_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-lookup responses per customer area, as JSON text."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    lat, lng = _customer_point(F.col("c_custkey"))
    props = F.struct(F.lit(GRID_ID).alias("gridId"), F.floor(lng).cast("long").alias("gridX"),
                     F.floor(lat).cast("long").alias("gridY"),
                     F.concat(F.lit("urn:cell:"), F.col("c_custkey").cast("string")).alias("forecastOffice"))
    return c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("area_id"),
                    F.to_json(F.struct(F.lit("Feature").alias("type"), props.alias("properties"))).alias("response"))


def area_pages(spark: SparkSession, sf_dir: str, page_size: int = 500) -> DataFrame:
    """Area records grouped into API pages of ``page_size`` (a bounded
    collect: page ids are ranges of a dense key), plus one page with no
    ``areas`` key, which must flatten to nothing."""
    raw = raw_areas(spark, sf_dir)
    key = F.when(F.col("uuid").startswith("C"), F.substring("uuid", 2, 20).cast("long")).otherwise(F.lit(-1))
    page_id = F.floor(key / page_size)
    recs = to_records(raw.select(page_id.alias("page_id"), "uuid", "area_name", "areaName", "ancestors",
                                 "pathTokens", "children", "metadata"),
                      json_cols=["children", "metadata"], keep=["page_id"])
    pages = (recs.groupBy("page_id")
                 .agg(F.concat(F.lit('{"data":{"areas":['), F.array_join(F.collect_list("value"), ","),
                               F.lit("]}}")).alias("page")))
    empty = raw.limit(1).select(F.lit(-99).cast("long").alias("page_id"), F.lit('{"data": {}}').alias("page"))
    return pages.unionByName(empty)


def raw_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations: ``purchase`` events as readings of area ``C{user_id}``, in
    F (even event ids) or C."""
    ev = _events(spark, sf_dir, ACTUAL_TYPES)
    return ev.select(F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("area_id"),
                     F.col("ts").alias("observed_at"), F.floor("value").cast("double").alias("temperature_value"),
                     F.when(F.col("event_id") % 2 == 0, "F").otherwise("C").alias("temperature_unit"))


def raw_point_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second source in its own shape, ``(area_id, data, extracted_at_ts)``:
    the events of its types as point forecasts of area ``C{user_id}``, one
    document per (user, hour of ``ts``, block of 24 event ids), measures in
    parallel arrays and units by the user's id."""
    ev = _events(spark, sf_dir, SOURCE_B_TYPES)
    eid = F.col("event_id")
    hr = F.date_trunc("hour", "ts")
    hour = F.date_trunc("day", hr) + F.make_interval(hours=(eid % N_SLOTS).cast("int"))
    reading = F.struct((eid % N_SLOTS).alias("slot"), eid.alias("event_id"), F.date_format(hour, "yyyy-MM-dd'T'HH:mm").alias("time"),
                       F.col("value").alias("t"), F.get_json_object("props", "$.k").cast("double").alias("h"),
                       F.when(eid % 7 == 0, F.lit(None)).otherwise(eid % 101).cast("double").alias("p"),
                       (eid % 20).cast("double").alias("w"))
    docs = ev.groupBy("user_id", hr.alias("hr"), F.floor(eid / N_SLOTS).alias("blk")).agg(
        F.sort_array(F.collect_list(reading)).alias("r"))

    def each(c):
        return F.transform("r", lambda x: x[c])
    fahrenheit, unit = F.col("user_id") % 2 == 0, F.element_at(F.array(*map(F.lit, ("km/h", "m/s", "mp/h"))),
                                                               (F.col("user_id") % 3 + 1).cast("int"))
    degree = F.when(fahrenheit, "°F").otherwise("°C")
    data = F.struct(
        (F.col("user_id") * F.lit(0.5)).alias("elevation"),
        F.struct(each("time").alias("time"), each("t").alias("temperature_2m"), each("h").alias("relative_humidity_2m"),
                 each("p").alias("precipitation_probability"), each("w").alias("wind_speed_10m")).alias("hourly"),
        F.struct(degree.alias("temperature_2m"), F.lit("%").alias("relative_humidity_2m"),
                 F.lit("%").alias("precipitation_probability"), unit.alias("wind_speed_10m")).alias("hourly_units"))
    return docs.select(F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("area_id"),
                       F.to_json(data, {"ignoreNullFields": "false"}).alias("data"),
                       F.timestamp_millis(F.unix_millis("hr") + 3_600_000 + F.col("blk")).alias("extracted_at_ts"))


# Vertices of the shapes of the mixed polygons, in parts of their width from
# their corner; the last kind is a box across the antimeridian.
SHAPES = (
    ("Polygon", [[[(0, 0), (1, 0), (1, 1), (0, 1)]]]),
    ("Polygon", [[[(0, 0), (1, 0), (0, 1)]]]),
    ("Polygon", [[[(0, 0), (1, 0), (1, 1), (0, 1)], [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75)]]]),
    ("MultiPolygon", [[[(0, 0), (0.75, 0), (0.75, 0.75), (0, 0.75)]], [[(0.5, 0.5), (1, 0.5), (1, 1), (0.5, 1)]]]),
    ("Polygon", [[[(0, 0), (1, 1), (1, 0), (0, 1)]]]),
    ("GeometryCollection", [[[(0.5, 0), (1, 0.5), (0.5, 1), (0, 0.5)]]]),
)
MIXED_X = "((s_suppkey * 53) % 320) / 8D - 20"
MIXED_Y = "((s_suppkey * 29) % 320) / 8D - 20"
MIXED_WIDTH = "pow(2D, s_suppkey % 11 - 6)"


def _shape_sql(kind: str, parts: list) -> str:
    def point(p):
        return f"'[', x0 + w * {p[0]}D, ',', y0 + w * {p[1]}D, ']'"

    def ring(points):
        return "'[', " + ", ',', ".join(point(p) for p in (*points, points[0])) + ", ']'"

    def polygon(rings):
        return "'[', " + ", ',', ".join(ring(r) for r in rings) + ", ']'"
    if kind == "GeometryCollection":
        return ("concat('{\"type\":\"GeometryCollection\",\"geometries\":[{\"type\":\"Point\",\"coordinates\":[0,0]},"
                f"{{\"type\":\"Polygon\",\"coordinates\":', {polygon(parts[0])}, '}}]}}')")
    body = polygon(parts[0]) if kind == "Polygon" else "'[', " + ", ',', ".join(polygon(p) for p in parts) + ", ']'"
    return f"concat('{{\"type\":\"{kind}\",\"coordinates\":', {body}, '}}')"


def mixed_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon per supplier: seven shapes, eleven widths from 1/64 to 16 degrees."""
    s = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS polygon_id", "s_suppkey % 7 AS kind", f"{MIXED_X} AS x0", f"{MIXED_Y} AS y0", f"{MIXED_WIDTH} AS w")
    across = ("concat('{\"type\":\"Polygon\",\"coordinates\":[[[', 180 - w / 2, ',', y0, '],[', w / 2 - 180, ',', y0, '],[', "
              "w / 2 - 180, ',', y0 + w, '],[', 180 - w / 2, ',', y0 + w, '],[', 180 - w / 2, ',', y0, ']]]}')")
    cases = " ".join(f"WHEN {i} THEN {_shape_sql(*shape)}" for i, shape in enumerate(SHAPES))
    return s.selectExpr("polygon_id", f"CASE kind {cases} ELSE {across} END AS geo_json")


def world_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point per customer, about the prime meridian or (every fourth) the
    antimeridian."""
    x = "((c_custkey * 7) % 640) / 16D - 20 + 1 / 64D"
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS point_id", f"CASE WHEN c_custkey % 4 != 0 THEN {x} WHEN {x} < 0 THEN {x} + 180 ELSE {x} - 180 END "
        "AS longitude", "((c_custkey * 13) % 640) / 16D - 20 + 1 / 128D AS latitude")


def wide_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box per supplier, 30 to 70 degrees wide, between latitudes 40 to 59."""
    s = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS polygon_id", "(s_suppkey * 37) % 280 - 160 AS a", "30 + (s_suppkey % 5) * 10 AS w",
        "40 + s_suppkey % 10 AS y").selectExpr("*", "CASE WHEN a + w > 180 THEN a + w - 360 ELSE a + w END AS b")
    return s.selectExpr("polygon_id", "concat('{\"type\":\"Polygon\",\"coordinates\":[[[', a, ',', y, '],[', b, ',', y, '],[', "
                        "b, ',', y + 10, '],[', a, ',', y + 10, '],[', a, ',', y, ']]]}') AS geo_json")


def northern_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS point_id", "((c_custkey * 37) % 5760) / 16D - 180 + 1 / 64D AS longitude",
        "40 + ((c_custkey * 11) % 512) / 16D + 1 / 128D AS latitude")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")
