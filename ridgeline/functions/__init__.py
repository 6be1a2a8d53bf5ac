"""Column-level functions: score, parsing, arrays, geometry."""

from .arrays import parent_of, safe_get
from .geo import (bbox, edges, is_axis_rectangle, point_in_polygon, point_in_rings,
                  rings_from_geojson)
from .numeric import climb_score_numeric, nanos, numeric
from .scoring import DEFAULT_PARAMS, ScoreParams, climb_score, ramp
from .text import iso_utc, json_scalar, normalize_article, parse_wind

__all__ = [
    "climb_score_numeric", "numeric", "nanos",
    "ScoreParams", "DEFAULT_PARAMS", "climb_score", "ramp",
    "parse_wind", "json_scalar", "normalize_article", "iso_utc",
    "safe_get", "parent_of",
    "rings_from_geojson", "edges", "bbox", "is_axis_rectangle", "point_in_rings", "point_in_polygon",
]
