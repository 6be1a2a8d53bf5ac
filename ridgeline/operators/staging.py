"""Staging: raw landings to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import iso_utc, json_scalar_sql, wind_sql
from ..sources.landing import json_mode


def _cast_sql(expr: str, to: str, strict: bool) -> str:
    """Warehouse CAST(... AS NUMERIC/TIMESTAMP/BOOL): strict fails the job on
    a bad value, lenient gives NULL."""
    return f"{'CAST' if strict else 'TRY_CAST'}({expr} AS {to})"


def parse_documents(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Forecast envelopes to one row per document with the parsed struct
    ``doc`` (a single JSON parse per document); malformed JSON fails the job,
    or with ``strict=False`` gives NULL fields."""
    return raw.select("extracted_at_ts", F.from_json("data", schemas.FORECAST_DOC, json_mode(strict)).alias("doc"))


def explode_periods(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per forecast period. A NULL, missing or empty periods
    array yields no row (inner unnest)."""
    keep = keep if keep is not None else [c for c in docs.columns if c != "doc"]
    return docs.select(*keep, "doc", F.explode(F.col("doc.properties.periods")).alias("period"))


def stage_forecast(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Forecast envelopes ``(data, extracted_at_ts)`` to typed hourly rows.

    Document-level fields (generated time, elevation, valid period, geometry)
    are extracted once per document before the explode and copied to each
    period row. ``generated_at`` stays text, like the model it mirrors.
    Written as two SQL projections over one ``from_json`` parse.
    """
    def js(path):
        return json_scalar_sql(path)

    def num(path):
        return _cast_sql(js(path), "DOUBLE", strict)

    def ts(path):
        return _cast_sql(js(path), "TIMESTAMP", strict)

    per_doc = parse_documents(raw, strict).selectExpr(
        "extracted_at_ts",
        f"{js('doc.properties.generatedAt')} AS generated_at",
        "doc.geometry AS geo_json",
        f"{num('doc.properties.elevation.value')} AS elevation_value",
        f"{js('doc.properties.elevation.unitCode')} AS elevation_unit",
        f"{js('doc.properties.validTimes')} AS valid_period",
        "explode(doc.properties.periods) AS p",
    )
    return per_doc.selectExpr(
        "extracted_at_ts", "generated_at", "geo_json", "elevation_value", "elevation_unit", "valid_period",
        f"{ts('p.startTime')} AS start_time",
        f"{ts('p.endTime')} AS end_time",
        f"{num('p.temperature')} AS temperature_value",
        f"{js('p.temperatureUnit')} AS temperature_unit",
        f"{num('p.probabilityOfPrecipitation.value')} AS precipitation_probability_value",
        f"{js('p.probabilityOfPrecipitation.unitCode')} AS precipitation_probability_unit",
        f"{num('p.dewpoint.value')} AS dewpoint_value",
        f"{js('p.dewpoint.unitCode')} AS dewpoint_unit",
        f"{num('p.relativeHumidity.value')} AS relative_humidity_value",
        f"{js('p.relativeHumidity.unitCode')} AS relative_humidity_unit",
        f"{js('p.windSpeed')} AS _wind_text",
        f"{js('p.windDirection')} AS wind_direction",
        f"{js('p.shortForecast')} AS short_forecast",
    ).selectExpr(*schemas.STG_FORECAST_COLUMNS[:16], "wind_direction", "short_forecast", f"{wind_sql('_wind_text')} AS _wind",
    ).selectExpr(*schemas.STG_FORECAST_COLUMNS[:16], "_wind.low AS wind_speed_low", "_wind.high AS wind_speed_high",
                 "_wind.unit AS wind_speed_unit", "wind_direction", "short_forecast")


def stage_point_forecast(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Point forecasts ``(area_id, data, extracted_at_ts)`` of the second
    source to hourly rows per area. A document holds parallel arrays, one per
    measure, which are zipped and unnested; units stand beside them. It has
    neither a polygon nor a time of its own making: it belongs to the area it
    was asked for, and counts as made when it was extracted. Arrays of unlike
    length fail the job, or with ``strict=False`` are filled with NULL."""
    names = schemas._HOURLY
    doc = raw.select("area_id", "extracted_at_ts",
                     F.from_json("data", schemas.POINT_FORECAST_DOC, json_mode(strict)).alias("doc"))
    h, u = F.col("doc.hourly"), F.col("doc.hourly_units")
    zipped = F.arrays_zip(h["time"].alias("time"), *(F.coalesce(h[c], F.array().cast("array<double>")).alias(c) for c in names))
    if strict:
        unlike = F.exists(F.array(*(F.coalesce(F.size(h[c]), F.lit(0)) for c in names)),
                          lambda n: (n != 0) & (n != F.size(h["time"])))
        zipped = F.when(unlike, F.raise_error(F.lit("arrays of unlike length in a point forecast"))).otherwise(zipped)
    rows = doc.select("area_id", "extracted_at_ts", F.col("doc.elevation").alias("elevation_value"), u.alias("u"),
                      F.explode(zipped).alias("p"))
    start = F.expr(_cast_sql("p.time", "TIMESTAMP", strict))
    return rows.select(
        "area_id", "extracted_at_ts", iso_utc(F.col("extracted_at_ts"), True).alias("generated_at"), "elevation_value",
        start.alias("start_time"), (start + F.expr("INTERVAL 1 HOUR")).alias("end_time"),
        F.col("p.temperature_2m").alias("temperature_value"), F.col("u.temperature_2m").alias("temperature_unit"),
        F.col("p.precipitation_probability").alias("precipitation_probability_value"),
        F.col("u.precipitation_probability").alias("precipitation_probability_unit"),
        F.col("p.dew_point_2m").alias("dewpoint_value"), F.col("u.dew_point_2m").alias("dewpoint_unit"),
        F.col("p.relative_humidity_2m").alias("relative_humidity_value"),
        F.col("u.relative_humidity_2m").alias("relative_humidity_unit"),
        F.col("p.wind_speed_10m").alias("wind_speed_low"), F.col("p.wind_speed_10m").alias("wind_speed_high"),
        F.col("u.wind_speed_10m").alias("wind_speed_unit"))


def stage_countries(raw: DataFrame) -> DataFrame:
    """``areaName`` as ``country`` (names match case-insensitively)."""
    return raw.select(F.col("areaname").alias("country"))


def stage_areas(raw: DataFrame, strict: bool = True) -> DataFrame:
    """P1 + P2: typed area staging; lat/lng/leaf come out of the metadata
    JSON with one parse per row."""
    parsed = raw.select("*", F.from_json(F.col("metadata"), schemas.AREA_METADATA, json_mode(strict)).alias("_md"))
    return parsed.selectExpr(
        "uuid AS id",
        "area_name",
        f"{_cast_sql(json_scalar_sql('_md.lat'), 'DOUBLE', strict)} AS latitude",
        f"{_cast_sql(json_scalar_sql('_md.lng'), 'DOUBLE', strict)} AS longitude",
        "children",
        "ancestors",
        "pathtokens AS path_array",
        f"{_cast_sql(json_scalar_sql('_md.leaf'), 'BOOLEAN', strict)} AS is_leaf",
    )
