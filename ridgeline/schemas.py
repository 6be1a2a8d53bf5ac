"""Declared schemas: landings are read with these (no inference), and JSON
columns are parsed once with an explicit schema whose scalar leaves are
variants, so each field keeps its JSON type and the warehouse's
``json_value``-then-``CAST`` semantics."""

# Landing files (newline-delimited JSON).
RAW_NWS = "data string, extracted_at_ts timestamp"
RAW_GRIDPOINTS = "area_id string, grid_id string, grid_x long, grid_y long"
RAW_AREAS = ("uuid string, area_name string, areaName string, pathTokens array<string>, "
             "ancestors array<string>, children string, metadata string")
RAW_COUNTRIES = "areaName string"

# Required (REQUIRED mode at load) columns per landing, checked by DQ1.
REQUIRED = {
    "raw_nws": ["data", "extracted_at_ts"],
    "raw_gridpoints": ["area_id"],
    "raw_graph_ql_areas": ["uuid", "area_name", "areaName", "metadata"],
    "raw_graph_ql_countries": ["areaName"],
}

_VALUE_UNIT = "struct<value:variant,unitCode:variant>"

PERIOD = (
    "struct<startTime:variant,endTime:variant,temperature:variant,temperatureUnit:variant,"
    f"probabilityOfPrecipitation:{_VALUE_UNIT},dewpoint:{_VALUE_UNIT},relativeHumidity:{_VALUE_UNIT},"
    "windSpeed:variant,windDirection:variant,shortForecast:variant>"
)

# One parse of the whole forecast document. ``geometry`` is a string leaf on
# an object, which keeps the sub-document's JSON text.
FORECAST_DOC = (
    "struct<geometry:string,properties:struct<generatedAt:variant,validTimes:variant,"
    f"elevation:{_VALUE_UNIT},periods:array<{PERIOD}>>>"
)

# A point forecast of the second source: one array per measure beside the array
# of times, and the unit of each measure.
_HOURLY = ("temperature_2m", "relative_humidity_2m", "precipitation_probability", "dew_point_2m", "wind_speed_10m")
POINT_FORECAST_DOC = (
    "struct<elevation:double,hourly:struct<time:array<string>," + ",".join(f"{c}:array<double>" for c in _HOURLY)
    + ">,hourly_units:struct<" + ",".join(f"{c}:string" for c in _HOURLY) + ">>"
)

AREA_METADATA = "struct<lat:variant,lng:variant,leaf:variant>"
AREA_CHILD = "struct<area_name:string,uuid:string>"
GRIDPOINT_RESPONSE = "struct<properties:struct<gridId:string,gridX:long,gridY:long>>"

# Staged hourly forecast, in model order.
STG_FORECAST_COLUMNS = [
    "extracted_at_ts", "generated_at", "geo_json", "elevation_value", "elevation_unit", "valid_period",
    "start_time", "end_time", "temperature_value", "temperature_unit",
    "precipitation_probability_value", "precipitation_probability_unit",
    "dewpoint_value", "dewpoint_unit", "relative_humidity_value", "relative_humidity_unit",
    "wind_speed_low", "wind_speed_high", "wind_speed_unit", "wind_direction", "short_forecast",
]

# Hourly forecast by area (no geometry), the fact adds climb_score.
HOURLY_BY_AREA_COLUMNS = ["area_id"] + [c for c in STG_FORECAST_COLUMNS if c != "geo_json"]
