"""DuckDB oracle SQL for the query catalog.

Each oracle reads the driver's base tables by a *different route* than the
Spark plan: no JSON round trip (document fields come straight from
``events`` arithmetic), bounding-box range comparisons in place of the ray
cast, and ``QUALIFY``/``arg_max`` on base rows in place of the staged
window. Column names and types match :mod:`.catalog`.
"""

from __future__ import annotations

from types import SimpleNamespace

from . import bindings as B

# Literal values, not taken from the code under test.
P = SimpleNamespace(temp_cutoff_low=30.0, temp_ideal_low=40.0, temp_ideal_high=70.0, temp_cutoff_high=80.0,
                    wind_cutoff=35.0, wind_low_cutoff=3.0, wind_ideal=25.0, humidity_cutoff=60.0, humidity_ideal=0.0,
                    w_temp=0.6, w_wind=0.2, w_humid=0.2)
METRICS = [
    ("temperature", "nws", "temperature_value", "temperature_unit"),
    ("wind_speed", "low", "wind_speed_low", "wind_speed_unit"),
    ("wind_speed", "high", "wind_speed_high", "wind_speed_unit"),
    ("precip_probability", "nws", "precipitation_probability_value", "precipitation_probability_unit"),
    ("humidity", "nws", "relative_humidity_value", "relative_humidity_unit"),
    ("dewpoint", "nws", "dewpoint_value", "dewpoint_unit"),
]
AS_OF = f"TIMESTAMP '{B.AS_OF}'"
ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"


def _d(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def _ramp(x: str, cutoff: float, ideal: float) -> str:
    return (f"(CASE WHEN {x} IS NOT NULL THEN greatest({_d(0)}, least({_d(1)}, "
            f"({x} - {_d(cutoff)}) / {_d(float(ideal) - float(cutoff))})) END)")


def _tf_reference(t: str) -> str:
    return (f"(CASE WHEN {t} BETWEEN {_d(P.temp_ideal_low)} AND {_d(P.temp_ideal_high)} THEN {_d(1)} "
            f"WHEN {t} <= {_d(P.temp_cutoff_low)} OR {_d(P.temp_cutoff_high)} >= {t} THEN {_d(0)} "
            f"WHEN {t} < {_d(P.temp_ideal_low)} THEN {_ramp(t, P.temp_cutoff_low, P.temp_ideal_low)} "
            f"WHEN {t} > {_d(P.temp_ideal_high)} THEN {_ramp(t, P.temp_cutoff_high, P.temp_ideal_high)} END)")


def _tf_weighted(t: str) -> str:
    return (f"(CASE WHEN {t} BETWEEN {_d(P.temp_ideal_low)} AND {_d(P.temp_ideal_high)} THEN {_d(1)} "
            f"WHEN {t} <= {_d(P.temp_cutoff_low)} OR {t} >= {_d(P.temp_cutoff_high)} THEN {_d(0)} "
            f"WHEN {t} < {_d(P.temp_ideal_low)} THEN {_ramp(t, P.temp_cutoff_low, P.temp_ideal_low)} "
            f"WHEN {t} > {_d(P.temp_ideal_high)} THEN {_ramp(t, P.temp_cutoff_high, P.temp_ideal_high)} END)")


def _wf(w: str) -> str:
    a, b = _ramp(w, P.wind_cutoff, P.wind_ideal), _ramp(w, P.wind_low_cutoff, P.wind_ideal)
    return f"(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN least({a}, {b}) END)"


def _pf(p: str) -> str:
    return f"({_d(1)} - coalesce({p}, {_d(0)}) / {_d(100)})"


def score_sql(t="temperature_value", p="precipitation_probability_value", w="wind_speed_high",
              h="relative_humidity_value", variant="reference") -> str:
    hf = _ramp(h, P.humidity_cutoff, P.humidity_ideal)
    if variant == "reference":
        return f"({_d(100)} * {_pf(p)} * {_tf_reference(t)} + {_d(P.w_wind)} * {_wf(w)} + {_d(P.w_humid)} * {hf})"
    return (f"({_d(100)} * {_pf(p)} * ({_d(P.w_temp)} * {_tf_weighted(t)} + {_d(P.w_wind)} * {_wf(w)} "
            f"+ {_d(P.w_humid)} * {hf}))")


def _geo(g: str) -> str:
    x, y = f"(({g}) % 5)", f"(({g}) // 5)"

    def pt(a, b):
        return f"printf('%d.0,%d.0', {a}, {b})"
    return ("('{\"type\":\"Polygon\",\"coordinates\":[[[' || " + pt(x, y) + " || '],[' || " + pt(f"{x}+1", y)
            + " || '],[' || " + pt(f"{x}+1", f"{y}+1") + " || '],[' || " + pt(x, f"{y}+1") + " || '],[' || "
            + pt(x, y) + " || ']]]}')")


def _types(types) -> str:
    if not types:
        return ""
    return "WHERE event_type IN (" + ", ".join(f"'{t}'" for t in types) + ")"


def ctes_stg(types=None, plant_bad=False, name="stg", pk="pk") -> str:
    temp = "CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE floor(e.value) END" if plant_bad else "floor(e.value)"
    return f"""
{pk} AS (
  SELECT user_id % 25 AS g, date_trunc('hour', ts) AS hr, event_id // 24 AS blk, event_id % 24 AS slot,
         event_id AS eid
  FROM events {_types(types)}
),
{name} AS (
  SELECT k.g, k.hr, k.blk, k.slot, e.event_id,
    k.hr + INTERVAL 1 HOUR + to_milliseconds(k.blk) AS extracted_at_ts,
    strftime(k.hr, {ISO}) AS generated_at,
    {_geo('k.g')} AS geo_json,
    CAST(k.g AS DOUBLE) * {_d(10.5)} AS elevation_value,
    'wmoUnit:m' AS elevation_unit,
    strftime(k.hr, {ISO}) || '/P1D' AS valid_period,
    date_trunc('day', k.hr) + to_hours(k.slot) AS start_time,
    date_trunc('day', k.hr) + to_hours(k.slot + 1) AS end_time,
    CAST({temp} AS DOUBLE) AS temperature_value,
    'F' AS temperature_unit,
    CAST(CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE e.event_id % 101 END AS DOUBLE) AS precipitation_probability_value,
    'wmoUnit:percent' AS precipitation_probability_unit,
    e.value / 4 AS dewpoint_value,
    'wmoUnit:degC' AS dewpoint_unit,
    CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS DOUBLE) AS relative_humidity_value,
    'wmoUnit:percent' AS relative_humidity_unit,
    CAST(CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE e.event_id % 20 END AS DOUBLE) AS wind_speed_low,
    CAST(CASE WHEN e.event_id % 13 = 0 THEN NULL WHEN e.event_id % 2 = 0 THEN e.event_id % 20
              ELSE e.event_id % 20 + 5 END AS DOUBLE) AS wind_speed_high,
    CASE WHEN e.event_id % 13 = 0 THEN 'calm' ELSE 'mph' END AS wind_speed_unit,
    'NW' AS wind_direction,
    e.event_type AS short_forecast
  FROM {pk} k JOIN events e ON e.event_id = k.eid
)"""


STG_COLS = ("extracted_at_ts, generated_at, geo_json, elevation_value, elevation_unit, valid_period, start_time, "
            "end_time, temperature_value, temperature_unit, precipitation_probability_value, "
            "precipitation_probability_unit, dewpoint_value, dewpoint_unit, relative_humidity_value, "
            "relative_humidity_unit, wind_speed_low, wind_speed_high, wind_speed_unit, wind_direction, short_forecast")
HOURLY_COLS = "area_id, " + STG_COLS.replace("geo_json, ", "")

LNG = "(((c.c_custkey * 7) % 80) / CAST(16.0 AS DOUBLE) + 1 / CAST(32.0 AS DOUBLE))"
LAT = "(((c.c_custkey * 13) % 80) / CAST(16.0 AS DOUBLE) + 1 / CAST(32.0 AS DOUBLE))"

CTE_AREAS = f"""
pts AS (
  SELECT 'C' || c.c_custkey AS area_id, {LNG} AS lng, {LAT} AS lat FROM customer c
  UNION ALL
  SELECT 'N' || n_nationkey, n_nationkey % 5 + CAST(0.5 AS DOUBLE), n_nationkey // 5 + CAST(0.5 AS DOUBLE) FROM nation
),
area_cell AS (
  SELECT p.area_id, n.n_nationkey AS g
  FROM pts p JOIN nation n
    ON p.lng > n.n_nationkey % 5 AND p.lng < n.n_nationkey % 5 + 1
   AND p.lat > n.n_nationkey // 5 AND p.lat < n.n_nationkey // 5 + 1
)"""

CTE_HIER = f"""
hier AS (
  SELECT 'R' || r_regionkey AS id, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
         r_name AS area_name, CAST(NULL AS VARCHAR) AS parent_id, r_name AS country,
         CAST(NULL AS VARCHAR) AS region, false AS is_leaf
  FROM region
  UNION ALL
  SELECT 'N' || n.n_nationkey, n.n_nationkey // 5 + CAST(0.5 AS DOUBLE), n.n_nationkey % 5 + CAST(0.5 AS DOUBLE),
         n.n_name, 'R' || n.n_regionkey, r.r_name, n.n_name, false
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT 'C' || c.c_custkey, {LAT}, {LNG},
         CASE WHEN c.c_custkey % 5 = 0 THEN c.c_name || ', The' ELSE c.c_name END,
         'N' || c.c_nationkey, r.r_name, n.n_name, true
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim AS (
  SELECT id, CASE WHEN area_name LIKE '%, The' THEN 'The ' || regexp_replace(area_name, ', The$', '')
                  ELSE area_name END AS area_name,
         latitude, longitude, parent_id, country, region, is_leaf
  FROM hier
)"""

CTE_RAW_AREAS = """
raw_areas AS (
  SELECT 'R' || r_regionkey AS uuid, r_name AS area_name, r_name AS areaName, r_name AS path_text,
         'R' || r_regionkey AS ancestors_text, r_regionkey AS rk, CAST(NULL AS BIGINT) AS ck, 'R' AS kind
  FROM region
  UNION ALL
  SELECT 'N' || n.n_nationkey, n.n_name, n.n_name, r.r_name || '|' || n.n_name,
         'R' || n.n_regionkey || '|N' || n.n_nationkey, n.n_regionkey, NULL, 'N'
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT 'C' || c.c_custkey, nm, nm, r.r_name || '|' || n.n_name || '|' || nm,
         'R' || n.n_regionkey || '|N' || n.n_nationkey || '|C' || c.c_custkey, n.n_regionkey, c.c_custkey, 'C'
  FROM (SELECT *, CASE WHEN c_custkey % 5 = 0 THEN c_name || ', The' ELSE c_name END AS nm FROM customer) c
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def ctes_hourly(types=None, name="hourly", suffix="") -> str:
    return f"""{ctes_stg(types, name='stg' + suffix, pk='pk' + suffix)},
latest{suffix} AS (
  SELECT * FROM stg{suffix} QUALIFY row_number() OVER (PARTITION BY g, start_time ORDER BY hr DESC, blk DESC) = 1
),
{name} AS (
  SELECT ac.area_id, l.* EXCLUDE (g, hr, blk, slot, event_id, geo_json)
  FROM latest{suffix} l JOIN area_cell ac ON ac.g = l.g
)"""


def ctes_fact() -> str:
    return f"""{CTE_AREAS},
{ctes_hourly()},
fact AS (SELECT hourly.*, {score_sql()} AS climb_score FROM hourly)"""


SERIES_LONG = " UNION ALL ".join(
    f"SELECT area_id, '{m}' AS metric, '{lbl}' AS label, 'nws' AS source, {u} AS unit, start_time AS t, "
    f"CAST({v} AS DOUBLE) AS v FROM rec"
    for m, lbl, v, u in METRICS)

SPECS = " UNION ALL ".join(f"SELECT '{m}' AS metric, '{lbl}' AS label" for m, lbl, _, _ in METRICS)


def _w(body: str) -> str:
    return "WITH " + body.strip().lstrip(",")


ORACLE: dict[str, str] = {}

ORACLE["load_forecast_docs"] = _w(f"""
pk AS (SELECT user_id % 25 AS g, date_trunc('hour', ts) AS hr, event_id // 24 AS blk FROM events)
SELECT hr + INTERVAL 1 HOUR + to_milliseconds(blk) AS extracted_at_ts, strftime(hr, {ISO}) AS generated_at,
       CAST(g AS DOUBLE) * {_d(10.5)} AS elevation_value, CAST(count(*) AS BIGINT) AS n_periods
FROM pk GROUP BY g, hr, blk""")

ORACLE["envelope_roundtrip"] = _w(f"""
docs AS (SELECT DISTINCT user_id % 25 AS g, date_trunc('hour', ts) AS hr, event_id // 24 AS blk FROM events)
SELECT CAST(g AS DOUBLE) * {_d(10.5)} AS elevation_value, CAST(count(*) AS BIGINT) AS n_docs,
       date_trunc('second', min(hr + INTERVAL 1 HOUR + to_milliseconds(blk))) AS first_extracted,
       date_trunc('second', max(hr + INTERVAL 1 HOUR + to_milliseconds(blk))) AS last_extracted
FROM docs GROUP BY g""")

ORACLE["load_areas"] = _w(f"""{CTE_RAW_AREAS}
SELECT uuid, area_name, areaName, path_text, ancestors_text,
       CAST(CASE kind WHEN 'R' THEN (SELECT count(*) FROM nation WHERE n_regionkey = rk)
                      WHEN 'C' THEN 0 END AS BIGINT) AS n_children,
       CASE kind WHEN 'N' THEN CAST(substr(uuid, 2) AS BIGINT) // 5 + CAST(0.5 AS DOUBLE)
                 WHEN 'C' THEN ((ck * 13) % 80) / CAST(16.0 AS DOUBLE) + 1 / CAST(32.0 AS DOUBLE) END AS lat,
       CASE kind WHEN 'N' THEN CAST(substr(uuid, 2) AS BIGINT) % 5 + CAST(0.5 AS DOUBLE)
                 WHEN 'C' THEN ((ck * 7) % 80) / CAST(16.0 AS DOUBLE) + 1 / CAST(32.0 AS DOUBLE) END AS lng
FROM raw_areas""")

ORACLE["flatten_pages"] = _w(f"""{CTE_RAW_AREAS}
SELECT uuid, area_name, ancestors_text, path_text FROM raw_areas""")

ORACLE["project_gridpoints"] = f"""
SELECT 'C' || c.c_custkey AS area_id, '{B.GRID_ID}' AS grid_id, CAST(floor({LNG}) AS BIGINT) AS grid_x,
       CAST(floor({LAT}) AS BIGINT) AS grid_y
FROM customer c"""

ORACLE["distinct_gridpoints"] = f"""
SELECT DISTINCT '{B.GRID_ID}' AS grid_id, CAST(floor({LNG}) AS BIGINT) AS grid_x, CAST(floor({LAT}) AS BIGINT) AS grid_y
FROM customer c"""

ORACLE["stage_countries"] = "SELECT r_name AS country FROM region"

ORACLE["stage_areas"] = _w(f"""{CTE_HIER},
{CTE_RAW_AREAS.strip()}
SELECT h.id, h.area_name, h.latitude, h.longitude, h.is_leaf, r.path_text, r.ancestors_text
FROM hier h JOIN raw_areas r ON r.uuid = h.id""")

ORACLE["area_hierarchy"] = _w(f"""{CTE_HIER}
SELECT * FROM hier""")

ORACLE["dim_area"] = _w(f"""{CTE_HIER}
SELECT * FROM dim""")

ORACLE["area_kind"] = _w(f"""{CTE_HIER}
SELECT id, CASE WHEN is_leaf THEN 'crag' ELSE 'branch' END AS area_kind FROM dim""")

ORACLE["target_areas"] = _w(f"""{CTE_HIER}
SELECT id AS area_id, latitude, longitude FROM dim
WHERE parent_id IN ('N1', 'N2') AND area_name <> 'Beaches'""")

ORACLE["target_areas_text"] = _w(f"""{CTE_HIER}
SELECT id AS area_id, CAST(latitude AS VARCHAR) AS lat, CAST(longitude AS VARCHAR) AS long FROM dim
WHERE parent_id IN ('N1', 'N2') AND area_name <> 'Beaches'""")

ORACLE["area_node"] = _w(f"""{CTE_HIER}
SELECT * FROM dim WHERE id = 'N1'""")

ORACLE["area_children"] = _w(f"""{CTE_HIER}
SELECT parent_id, id AS child_id, area_name AS child_name FROM dim WHERE parent_id IS NOT NULL""")

ORACLE["area_card"] = _w(f"""{CTE_HIER}
SELECT p.*, c.id AS child_id, c.area_name AS child_name
FROM dim p LEFT JOIN dim c ON c.parent_id = p.id""")

ORACLE["explode_periods"] = _w(f"""{ctes_stg()}
SELECT extracted_at_ts, strftime(start_time, {ISO}) AS start_text, short_forecast FROM stg""")

ORACLE["stage_forecast"] = _w(f"""{ctes_stg()}
SELECT {STG_COLS} FROM stg""")

ORACLE["parse_wind"] = _w(f"""{ctes_stg()}
SELECT generated_at, start_time, wind_speed_low, wind_speed_high, wind_speed_unit FROM stg""")

ORACLE["spatial_join"] = _w(f"""{CTE_AREAS}
SELECT area_id, {_geo('g')} AS geo_json FROM area_cell
WHERE g IN (SELECT DISTINCT user_id % 25 FROM events)""")

ORACLE["spatial_join_mixed"] = """
WITH pt AS (
  SELECT c_custkey AS point_id, ((c_custkey * 7) % 640) / 16.0::DOUBLE - 20 + 1 / 64.0::DOUBLE AS x,
         ((c_custkey * 13) % 640) / 16.0::DOUBLE - 20 + 1 / 128.0::DOUBLE AS lat FROM customer),
p AS (SELECT point_id, lat, CASE WHEN point_id % 4 != 0 THEN x WHEN x < 0 THEN x + 180 ELSE x - 180 END AS lng FROM pt),
g AS (SELECT s_suppkey AS polygon_id, s_suppkey % 7 AS kind, ((s_suppkey * 53) % 320) / 8.0::DOUBLE - 20 AS x0,
             ((s_suppkey * 29) % 320) / 8.0::DOUBLE - 20 AS y0, pow(2.0::DOUBLE, s_suppkey % 11 - 6) AS w FROM supplier),
uv AS (SELECT point_id, polygon_id, kind, w, lng, (lng - x0) / w AS u, (lat - y0) / w AS v
       FROM p JOIN g ON lat > y0 AND lat < y0 + w)
SELECT point_id, polygon_id FROM uv WHERE CASE kind
  WHEN 0 THEN u > 0 AND u < 1
  WHEN 1 THEN u > 0 AND u + v < 1
  WHEN 2 THEN u > 0 AND u < 1 AND NOT (u >= 0.25 AND u <= 0.75 AND v >= 0.25 AND v <= 0.75)
  WHEN 3 THEN (u > 0 AND u < 0.75 AND v < 0.75) OR (u > 0.5 AND u < 1 AND v > 0.5)
  WHEN 4 THEN (u > 0 AND u < least(v, 1 - v)) OR (u < 1 AND u > greatest(v, 1 - v))
  WHEN 5 THEN abs(u - 0.5) + abs(v - 0.5) < 0.5
  ELSE lng > 180 - w / 2 OR lng < w / 2 - 180 END"""

# the latitude of the arc between two points of one latitude
ORACLE["spatial_join_sphere"] = """
WITH p AS (
  SELECT c_custkey AS point_id, ((c_custkey * 37) % 5760) / 16.0::DOUBLE - 180 + 1 / 64.0::DOUBLE AS x,
         40 + ((c_custkey * 11) % 512) / 16.0::DOUBLE + 1 / 128.0::DOUBLE AS lat FROM customer),
g AS (SELECT s_suppkey AS polygon_id, (s_suppkey * 37) % 280 - 160 AS a, 30 + (s_suppkey % 5) * 10 AS w,
             40 + s_suppkey % 10 AS y FROM supplier),
uv AS (SELECT point_id, polygon_id, w, y, lat, CASE WHEN x < a THEN x + 360 - a ELSE x - a END AS u FROM p, g)
SELECT point_id, polygon_id FROM uv WHERE u > 0 AND u < w
  AND lat > degrees(atan(tan(radians(y)) * (sin(radians(w - u)) + sin(radians(u))) / sin(radians(w))))
  AND lat < degrees(atan(tan(radians(y + 10)) * (sin(radians(w - u)) + sin(radians(u))) / sin(radians(w))))"""

ORACLE["assign_cells"] = _w(f"""{CTE_AREAS}
SELECT area_id, '{B.GRID_ID}' AS grid_id, CAST(g % 5 AS BIGINT) AS grid_x, CAST(g // 5 AS BIGINT) AS grid_y
FROM area_cell""")

ORACLE["check_containment"] = f"""
SELECT 'C' || c.c_custkey AS area_id, CAST((floor({LNG}) + 1) % 5 AS BIGINT) AS grid_x,
       CAST(floor({LAT}) AS BIGINT) AS grid_y
FROM customer c
WHERE c.c_custkey % 83 = 0"""

ORACLE["forecast_by_area"] = _w(f"""{CTE_AREAS},
{ctes_stg()}
SELECT ac.area_id, s.generated_at, s.start_time, s.temperature_value
FROM stg s JOIN area_cell ac ON ac.g = s.g""")

_LATEST = _w(f"""{ctes_stg()}
SELECT geo_json, start_time, generated_at, temperature_value, wind_speed_high
FROM stg QUALIFY row_number() OVER (PARTITION BY g, start_time ORDER BY hr DESC, blk DESC) = 1""")
ORACLE["forecast_by_area_stored"] = ORACLE["forecast_by_area"]

ORACLE["latest_snapshot"] = _LATEST
ORACLE["latest_snapshot_max"] = _LATEST
ORACLE["stream_ingest"] = _LATEST

ORACLE["forecast_hourly_by_area"] = _w(f"""{CTE_AREAS},
{ctes_hourly()}
SELECT {HOURLY_COLS} FROM hourly""")

ORACLE["fact_hourly"] = _w(f"""{ctes_fact()}
SELECT {HOURLY_COLS}, round(climb_score, 6) AS climb_score FROM fact""")

ORACLE["publish_fact"] = _w(f"""{ctes_fact()}
SELECT area_id, start_time, generated_at, round(climb_score, 6) AS climb_score FROM fact""")

ORACLE["check_unique_fact"] = _w(f"""{ctes_fact()}
SELECT area_id, start_time, CAST(2 AS BIGINT) AS n_rows FROM fact WHERE CAST(substr(area_id, 2) AS BIGINT) % 50 = 1""")

ORACLE["incremental_upsert"] = _w(f"""{CTE_AREAS},
{ctes_hourly()}
SELECT area_id, start_time, generated_at, temperature_value FROM hourly""")

ORACLE["ramp"] = _w(f"""{ctes_stg(plant_bad=True)}
SELECT elevation_value, generated_at, start_time,
       round({_ramp('wind_speed_high', P.wind_cutoff, P.wind_ideal)}, 6) AS ramp_wind,
       round({_ramp('relative_humidity_value', P.humidity_cutoff, P.humidity_ideal)}, 6) AS ramp_humid,
       round({_ramp('temperature_value', P.temp_cutoff_low, P.temp_ideal_low)}, 6) AS ramp_temp
FROM stg""")

ORACLE["climb_score"] = _w(f"""{ctes_stg(plant_bad=True)}
SELECT elevation_value, generated_at, start_time, round({score_sql()}, 6) AS climb_score FROM stg""")

ORACLE["climb_score_weighted"] = _w(f"""{ctes_stg(plant_bad=True)}
SELECT elevation_value, generated_at, start_time, round({score_sql(variant='weighted')}, 6) AS climb_score
FROM stg""")

ORACLE["daily_score"] = _w(f"""{ctes_fact()}
SELECT area_id, CAST(start_time AS DATE) AS day, round(avg(climb_score), 6) AS avg_score,
       round(min(climb_score), 6) AS min_score, round(max(climb_score), 6) AS max_score,
       CAST(count(*) AS BIGINT) AS n_hours, CAST(count(climb_score) AS BIGINT) AS n_scored
FROM fact GROUP BY ALL""")

ORACLE["weekend_ranking"] = _w(f"""{ctes_fact()},
{CTE_HIER.strip()},
wk AS (
  SELECT CASE WHEN dayofweek(start_time) = 6 THEN CAST(start_time AS DATE)
              ELSE CAST(start_time AS DATE) - 1 END AS weekend,
         area_id, avg(climb_score) AS avg_score, min(climb_score) AS min_score, max(climb_score) AS max_score,
         count(*) AS n_hours
  FROM fact WHERE dayofweek(start_time) IN (0, 6) GROUP BY ALL
),
ranked AS (
  SELECT wk.weekend, d.parent_id, wk.area_id, d.area_name, wk.avg_score, wk.min_score, wk.max_score, wk.n_hours,
         row_number() OVER (PARTITION BY wk.weekend, d.parent_id
                            ORDER BY round(wk.avg_score, 6) DESC NULLS LAST, wk.area_id) AS rnk
  FROM wk JOIN dim d ON d.id = wk.area_id WHERE d.is_leaf
)
SELECT weekend, parent_id, CAST(rnk AS BIGINT) AS rank, area_id, area_name, round(avg_score, 6) AS avg_score,
       round(min_score, 6) AS min_score, round(max_score, 6) AS max_score, CAST(n_hours AS BIGINT) AS n_hours
FROM ranked""")

ORACLE["weekend_top_ten"] = ORACLE["weekend_ranking"] + " WHERE rnk <= 10"

ORACLE["standardize_units"] = _w(f"""{ctes_stg()}
SELECT elevation_value, generated_at, start_time,
       round((temperature_value - 32) * 5 / 9, 6) AS temperature_value, 'C' AS temperature_unit,
       wind_speed_high, wind_speed_unit
FROM stg""")

ORACLE["forecast_recent"] = _w(f"""{ctes_fact()}
SELECT area_id, start_time, round(climb_score, 6) AS climb_score FROM fact
WHERE start_time > {AS_OF} - INTERVAL 1 HOUR""")

ORACLE["series_long"] = _w(f"""{ctes_fact()},
rec AS (SELECT * FROM fact WHERE start_time > {AS_OF} - INTERVAL 1 HOUR)
{SERIES_LONG}""")

ORACLE["series_nested"] = _w(f"""{ctes_fact()},
rec AS (SELECT * FROM fact WHERE start_time > {AS_OF} - INTERVAL 1 HOUR),
long AS ({SERIES_LONG}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY area_id, metric, label ORDER BY t DESC) AS pos FROM long)
SELECT area_id, metric, label, source, arg_max(unit, t) AS unit, CAST(count(*) AS BIGINT) AS n_points,
       CAST(sum(pos * (CAST(epoch(t) AS BIGINT) + coalesce(CAST(round(v * 1000000) AS BIGINT), -1))) AS BIGINT)
         AS points_checksum
FROM ranked GROUP BY area_id, metric, label, source""")

ORACLE["series_empty"] = _w(f"""{ctes_fact()},
{CTE_HIER.strip()},
rec AS (SELECT * FROM fact WHERE start_time > {AS_OF} - INTERVAL 1 HOUR),
long AS ({SERIES_LONG}),
agg AS (SELECT area_id, metric, label, arg_max(unit, t) AS unit, count(*) AS n FROM long GROUP BY ALL),
specs AS ({SPECS})
SELECT d.id AS area_id, s.metric, s.label, 'nws' AS source, a.unit, CAST(coalesce(a.n, 0) AS BIGINT) AS n_points
FROM dim d JOIN specs s ON true
LEFT JOIN agg a ON a.area_id = d.id AND a.metric = s.metric AND a.label = s.label""")

ORACLE["check_required"] = _w(f"""{CTE_RAW_AREAS}
SELECT uuid, area_name FROM raw_areas WHERE ck % 89 = 0""")

ORACLE["check_not_null"] = _w(f"""{ctes_stg(plant_bad=True)}
SELECT elevation_value, generated_at, start_time, temperature_value FROM stg
WHERE start_time IS NULL OR temperature_value IS NULL""")

ORACLE["check_not_null_by_area"] = _w(f"""{CTE_AREAS},
{ctes_hourly()}
SELECT area_id, start_time FROM hourly WHERE area_id IS NULL OR start_time IS NULL""")

ORACLE["check_expression"] = """
SELECT 'C' || c.c_custkey AS id, 'R' || n.n_regionkey || '|N' || n.n_nationkey || '|X' AS ancestors_text
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_custkey % 83 = 0"""

ORACLE["check_unique"] = _w(f"""{CTE_AREAS},
{ctes_stg()}
SELECT ac.area_id, s.start_time, CAST(count(*) AS BIGINT) AS n_rows
FROM stg s JOIN area_cell ac ON ac.g = s.g
GROUP BY ALL HAVING count(*) > 1""")

_UNION = f"""{CTE_AREAS},
{ctes_hourly(B.SOURCE_A_TYPES, name='hourly_a', suffix='_a')},
{ctes_hourly(B.SOURCE_B_TYPES, name='hourly_b', suffix='_b')},
fu AS (
  SELECT 'source_a' AS source, * FROM hourly_a
  UNION ALL
  SELECT 'source_b' AS source, * FROM hourly_b
)"""

ORACLE["forecast_union"] = _w(f"""{_UNION}
SELECT source, area_id, start_time, generated_at, temperature_value FROM fu""")

_ACTUALS = """
act AS (
  SELECT 'C' || user_id AS area_id, date_trunc('hour', ts) AS observed_hour,
         avg(CASE WHEN event_id % 2 = 0 THEN (CAST(floor(value) AS DOUBLE) - 32) * 5 / 9
                  ELSE CAST(floor(value) AS DOUBLE) END) AS temperature_value, count(*) AS n_readings
  FROM events WHERE event_type = 'purchase' GROUP BY ALL
)"""

ORACLE["stage_actuals"] = _w(f"""{_ACTUALS}
SELECT area_id, observed_hour, round(temperature_value, 6) AS temperature_value,
       CAST(n_readings AS BIGINT) AS n_readings FROM act""")

ORACLE["forecast_accuracy"] = _w(f"""{CTE_AREAS},
{ctes_stg(B.SOURCE_A_TYPES, name='stg_a', pk='pk_a')},
{ctes_stg(B.SOURCE_B_TYPES, name='stg_b', pk='pk_b')},
fu AS (
  SELECT 'source_a' AS source, ac.area_id, s.hr, s.start_time, (s.temperature_value - 32) * 5 / 9 AS c
  FROM stg_a s JOIN area_cell ac ON ac.g = s.g
  UNION ALL
  SELECT 'source_b', ac.area_id, s.hr, s.start_time, (s.temperature_value - 32) * 5 / 9
  FROM stg_b s JOIN area_cell ac ON ac.g = s.g
),
{_ACTUALS.strip()},
{CTE_HIER.strip()}
SELECT fu.source,
       CAST(floor(date_diff('second', fu.hr, fu.start_time) / CAST(3600 AS DOUBLE)) AS BIGINT) AS horizon_h,
       d.region, round(avg(abs(fu.c - act.temperature_value)), 6) AS mae,
       CAST(count(*) AS BIGINT) AS n_pairs
FROM fu JOIN act ON act.area_id = fu.area_id AND act.observed_hour = fu.start_time
LEFT JOIN dim d ON d.id = fu.area_id
GROUP BY ALL""")

ORACLE["stream_newest"] = ORACLE["stream_ingest"]
ORACLE["publish_clustered"] = ORACLE["publish_fact"]

_POINTS = f"""
points AS (
  SELECT 'C' || user_id AS area_id, hr + INTERVAL 1 HOUR + to_milliseconds(event_id // 24) AS extracted_at_ts,
         date_trunc('day', hr) + to_hours(event_id % 24) AS start_time, user_id * {_d(0.5)} AS elevation_value,
         value AS temperature_value, CASE WHEN user_id % 2 = 0 THEN '°F' ELSE '°C' END AS temperature_unit,
         CAST(CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 101 END AS DOUBLE) AS precipitation_probability_value,
         '%' AS precipitation_probability_unit, CAST(NULL AS DOUBLE) AS dewpoint_value, CAST(NULL AS VARCHAR) AS dewpoint_unit,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS DOUBLE) AS relative_humidity_value,
         '%' AS relative_humidity_unit, CAST(event_id % 20 AS DOUBLE) AS wind_speed_low,
         CAST(event_id % 20 AS DOUBLE) AS wind_speed_high,
         CASE user_id % 3 WHEN 0 THEN 'km/h' WHEN 1 THEN 'm/s' ELSE 'mp/h' END AS wind_speed_unit
  FROM (SELECT *, date_trunc('hour', ts) AS hr FROM events {_types(B.SOURCE_B_TYPES)})
)"""

ORACLE["stage_point_forecast"] = _w(f"""{_POINTS}
SELECT area_id, strftime(extracted_at_ts, {ISO}) AS generated_at, start_time, elevation_value, temperature_value,
       temperature_unit, precipitation_probability_value, relative_humidity_value, dewpoint_value, wind_speed_high,
       wind_speed_unit FROM points""")

ORACLE["forecast_union_shapes"] = _w(f"""{CTE_AREAS},
{ctes_hourly(B.SOURCE_A_TYPES)},
{_POINTS.strip()}
SELECT 'source_a' AS source, area_id, start_time, generated_at, valid_period, short_forecast,
       round((temperature_value - 32) * 5 / 9, 6) AS temperature_value, 'C' AS temperature_unit, dewpoint_value,
       round(wind_speed_high, 6) AS wind_speed_high, wind_speed_unit FROM hourly
UNION ALL
SELECT 'points', area_id, start_time, strftime(extracted_at_ts, {ISO}), NULL, NULL,
       round(CASE temperature_unit WHEN '°F' THEN (temperature_value - 32) * 5 / 9 ELSE temperature_value END, 6), 'C',
       dewpoint_value, round(wind_speed_high * CASE wind_speed_unit WHEN 'km/h' THEN {_d(1 / 1.609344)}
         WHEN 'm/s' THEN {_d(3600 / 1609.344)} ELSE 1 END, 6), 'mph' FROM points""")

ORACLE["series_by_source"] = _w(f"""{CTE_AREAS},
{ctes_hourly(B.SOURCE_A_TYPES)},
{_POINTS.strip()},
both_sources AS (
  SELECT 'source_a' AS source, area_id, start_time, {', '.join(dict.fromkeys(c for _, _, v, u in METRICS for c in (v, u)))} FROM hourly
  UNION ALL
  SELECT 'points', area_id, start_time, {', '.join(dict.fromkeys(c for _, _, v, u in METRICS for c in (v, u)))} FROM points),
rec AS (SELECT * FROM both_sources WHERE start_time > {AS_OF} - INTERVAL 1 HOUR)
""" + " UNION ALL ".join(
    f"SELECT area_id, '{m}' AS metric, {repr(lbl) if m == 'wind_speed' else 'CAST(NULL AS VARCHAR)'} AS label, source, "
    f"{repr(lbl) if m == 'wind_speed' else 'source'} AS line, {u} AS unit, start_time AS t, CAST({v} AS DOUBLE) AS v FROM rec"
    for m, lbl, v, u in METRICS))

ORACLE["check_not_null_by_area_planted"] = _w(f"""{CTE_AREAS},
{ctes_stg(plant_bad=True)},
latest AS (SELECT * FROM stg QUALIFY row_number() OVER (PARTITION BY g, start_time ORDER BY hr DESC, blk DESC) = 1)
SELECT ac.area_id, l.start_time FROM latest l JOIN area_cell ac ON ac.g = l.g WHERE l.temperature_value IS NULL""")

ORACLE["checks_in_one_pass"] = """
WITH areas AS (SELECT (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) AS n),
again AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
c AS (
  SELECT 'areas' AS table_name, 'rows' AS rule, n FROM areas
  UNION ALL SELECT 'areas', unnest(['required:uuid', 'required:area_name', 'required:areaName']), 0
  UNION ALL SELECT 'areas', 'required:metadata', count(*) FROM customer WHERE c_custkey % 89 = 0
  UNION ALL SELECT 'countries', 'rows', count(*) FROM region
  UNION ALL SELECT 'countries', 'required:areaName', 0
  UNION ALL SELECT 'gridpoints', 'rows', 2 * (SELECT count(*) FROM customer)
                   + (SELECT count(*) FROM again JOIN customer ON c_custkey = user_id)
  UNION ALL SELECT 'gridpoints', unnest(['required:area_id', 'required:grid_id', 'required:grid_x', 'required:grid_y']), 0
  UNION ALL SELECT 'forecasts', 'rows', count(*) FROM (
    SELECT DISTINCT user_id % 25, date_trunc('hour', ts), event_id // 24 FROM events)
  UNION ALL SELECT 'forecasts', unnest(['required:data', 'required:extracted_at_ts']), 0
  UNION ALL SELECT 'staged_areas', 'rows', n FROM areas
  UNION ALL SELECT 'staged_areas', 'required:id', 0
  UNION ALL SELECT 'staged_areas', 'expression:last ancestor', count(*) FROM customer WHERE c_custkey % 83 = 0
  UNION ALL SELECT 'staged_forecast', 'rows', count(*) FROM events
  UNION ALL SELECT 'staged_forecast', 'required:start_time', 0
  UNION ALL SELECT 'staged_forecast', 'required:temperature_value', count(*) FROM events WHERE event_id % 97 = 0)
SELECT table_name, rule, CAST(n AS BIGINT) AS n FROM c"""


# fixed point in whole billionths, halves away from zero
def _nanos_times(a, b):
    return f"(sign({a}) * sign({b}) * ((abs({a}) * abs({b}) + 500000000) // 1000000000))"


def _nanos_over(a, b):
    return f"(sign({a}) * sign({b}) * ((2 * abs({a}) * 1000000000 + abs({b})) // (2 * abs({b}))))"


def _nanos_ramp(x, cutoff, ideal):
    n = 1_000_000_000
    return (f"(CASE WHEN {x} IS NOT NULL THEN greatest(0::HUGEINT, least({n}::HUGEINT, "
            f"{_nanos_over(f'({x} - {int(cutoff * n)})', f'({int((ideal - cutoff) * n)})')})) END)")


ORACLE["climb_score_numeric"] = _w(f"""{ctes_stg(plant_bad=True)},
n AS (
  SELECT elevation_value, generated_at, start_time, CAST(temperature_value AS HUGEINT) * 1000000000 AS t,
         CAST(coalesce(precipitation_probability_value, 0) AS HUGEINT) * 1000000000 AS p,
         CAST(wind_speed_high AS HUGEINT) * 1000000000 AS w, CAST(relative_humidity_value AS HUGEINT) * 1000000000 AS h FROM stg),
f AS (
  SELECT *, CASE WHEN t BETWEEN 40000000000 AND 70000000000 THEN 1000000000 WHEN t <= 80000000000 THEN 0
                 WHEN t > 70000000000 THEN {_nanos_ramp('t', P.temp_cutoff_high, P.temp_ideal_high)} END AS warm,
         {_nanos_ramp('w', P.wind_cutoff, P.wind_ideal)} AS falling, {_nanos_ramp('w', P.wind_low_cutoff, P.wind_ideal)} AS rising,
         {_nanos_ramp('h', P.humidity_cutoff, P.humidity_ideal)} AS humid,
         1000000000 - {_nanos_over('p', '100000000000')} AS dry FROM n),
g AS (SELECT *, CASE WHEN falling IS NOT NULL AND rising IS NOT NULL THEN least(falling, rising) END AS blow FROM f)
SELECT elevation_value, generated_at, start_time,
       CAST({_nanos_times(_nanos_times('100000000000', 'dry'), 'warm')} + {_nanos_times('250000000', 'blow')}
            + {_nanos_times('500000000', 'humid')} AS BIGINT) AS climb_score_nanos FROM g""")

ORACLE["series_by_metric"] = _w(f"""{ctes_fact()},
rec AS (SELECT * FROM fact WHERE start_time > {AS_OF} - INTERVAL 1 HOUR),
m AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{m}', '{lbl}')" for i, (m, lbl, _, _) in enumerate(METRICS))}) AS v(i, metric, label)),
a AS (SELECT area_id, count(*) AS n, max(start_time) AS newest FROM rec GROUP BY area_id),
s AS (SELECT metric, count(*) AS n_series, string_agg(label, '|' ORDER BY i) AS labels FROM m GROUP BY metric)
SELECT area_id, metric, CAST(n_series AS BIGINT) AS n_series, labels, CAST(n * n_series AS BIGINT) AS n_points,
       strftime(newest, '%Y-%m-%d %H:%M:%S') AS newest FROM a, s""")

ORACLE["area_cards_nested"] = _w(f"""{CTE_HIER}
SELECT d.id, d.area_name, d.parent_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, coalesce(k.children, '') AS children
FROM dim d LEFT JOIN (
  SELECT parent_id, count(*) AS n, string_agg(id || ':' || area_name, '|' ORDER BY area_name, id) AS children
  FROM dim WHERE parent_id IS NOT NULL GROUP BY parent_id) k ON k.parent_id = d.id""")
