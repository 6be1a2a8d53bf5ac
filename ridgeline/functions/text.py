"""String and JSON scalar helpers (all built-in Spark expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the reference's wind-speed parse and name rule.
WIND_LOW_PATTERN = r"^\d+"
WIND_NUMBER_PATTERN = r"\d+"
WIND_UNIT_PATTERN = r"([a-zA-Z]+)\s*$"
TRAILING_ARTICLE_LIKE = "%, The"
TRAILING_ARTICLE_REGEX = ", The$"
LEADING_ARTICLE = "The "


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def sql_str(value: str) -> str:
    """A SQL string literal for ``value`` (backslashes and quotes escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def json_scalar_sql(expr: str) -> str:
    """Warehouse ``json_value`` semantics on a variant (a leaf of
    ``from_json``, or ``parse_json``): a scalar as text, JSON null and an
    object or array as NULL. A string keeps its text whatever it begins with;
    the type is looked at only where the text could be an object's or array's."""
    text = f"variant_get({expr}, '$', 'string')"
    nested = f"(startswith({text}, '{{') OR startswith({text}, '['))"
    return f"(CASE WHEN NOT ({nested} AND schema_of_variant({expr}) <> 'STRING') THEN {text} END)"


def wind_sql(expr: str) -> str:
    """``named_struct(low, high, unit)`` parsed from a wind-speed text."""
    low = f"CAST(regexp_substr({expr}, {sql_str(WIND_LOW_PATTERN)}) AS DOUBLE)"
    high = f"CAST(try_element_at(regexp_extract_all({expr}, {sql_str(WIND_NUMBER_PATTERN)}, 0), -1) AS DOUBLE)"
    unit = f"nullif(regexp_extract({expr}, {sql_str(WIND_UNIT_PATTERN)}, 1), '')"
    return f"named_struct('low', {low}, 'high', {high}, 'unit', {unit})"


def json_scalar(expr: str) -> Column:
    """Column form of :func:`json_scalar_sql`; ``expr`` is a column name or
    a nested field path such as ``doc.properties.generatedAt``."""
    return F.expr(json_scalar_sql(expr))


def parse_wind(expr: str) -> Column:
    """Parse a wind-speed text like ``"10 to 15 mph"`` to
    ``struct(low double, high double, unit string)``.

    low = leading digits, high = last digit run, unit = trailing letters.
    ``"10 mph"`` gives 10/10/mph, ``"10.5 mph"`` gives 10/5/mph (kept quirk),
    ``"calm"`` gives NULL/NULL/calm. No match gives NULL, never ``''``.
    ``expr`` is a column name or field path.
    """
    return F.expr(wind_sql(expr))


def normalize_article(name) -> Column:
    """``"Gorge, The"`` becomes ``"The Gorge"``; anything else is unchanged
    (case-sensitive, like the warehouse LIKE)."""
    n = _c(name)
    return F.when(n.like(TRAILING_ARTICLE_LIKE),
                  F.concat(F.lit(LEADING_ARTICLE), F.regexp_replace(n, TRAILING_ARTICLE_REGEX, ""))
                  ).otherwise(n)


def iso_utc(ts, offset_style: bool = False) -> Column:
    """Format a timestamp as ISO-8601 UTC text: ``...Z`` or ``...+00:00``."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss'+00:00'" if offset_style else "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return F.date_format(_c(ts), fmt)
