"""Fixed-point arithmetic with nine decimals (F-M2): the results of the
warehouse's NUMERIC, digit for digit.

Spark's decimals widen with every operation and lose decimals when 38 digits
are used up. Here every value is a ``decimal(18, 9)``, so a product fits 38
digits with all its decimals, and each step is rounded back at once, halves
away from zero. Values beyond nine digits before the point fail the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scoring import DEFAULT_PARAMS, ScoreParams

NUMERIC = "decimal(18,9)"
NANOS = 1_000_000_000


def numeric(x) -> Column:
    """A column, column name or number as NUMERIC."""
    if isinstance(x, Column):
        return x.cast(NUMERIC)
    return F.col(x).cast(NUMERIC) if isinstance(x, str) else F.lit(f"{x:.9f}").cast(NUMERIC)


def times(a: Column, b: Column) -> Column:
    return (a * b).cast(NUMERIC)


def over(a: Column, b: Column) -> Column:
    return (a / b).cast(NUMERIC)


def less(a: Column, b: Column) -> Column:
    return (a - b).cast(NUMERIC)


def plus(a: Column, b: Column) -> Column:
    return (a + b).cast(NUMERIC)


def nanos(x: Column) -> Column:
    """A NUMERIC as whole billionths (a long)."""
    return (x * F.lit(NANOS)).cast("decimal(38,0)").cast("long")


def ramp_numeric(x, cutoff: float, ideal: float) -> Column:
    """As :func:`~ridgeline.functions.scoring.ramp`."""
    v = numeric(x)
    r = over(less(v, numeric(cutoff)), numeric(ideal - cutoff))
    return F.when(v.isNotNull(), F.greatest(numeric(0), F.least(numeric(1), r)))


def climb_score_numeric(temp, precip, wind, humid, params: ScoreParams = DEFAULT_PARAMS) -> Column:
    """The published score in NUMERIC, rounded after every operation."""
    p, t = params, numeric(temp)
    warm = (F.when(t.between(numeric(p.temp_ideal_low), numeric(p.temp_ideal_high)), numeric(1))
            .when((t <= numeric(p.temp_cutoff_low)) | (numeric(p.temp_cutoff_high) >= t), numeric(0))
            .when(t < numeric(p.temp_ideal_low), ramp_numeric(temp, p.temp_cutoff_low, p.temp_ideal_low))
            .when(t > numeric(p.temp_ideal_high), ramp_numeric(temp, p.temp_cutoff_high, p.temp_ideal_high)))
    falling, rising = ramp_numeric(wind, p.wind_cutoff, p.wind_ideal), ramp_numeric(wind, p.wind_low_cutoff, p.wind_ideal)
    blow = F.when(falling.isNotNull() & rising.isNotNull(), F.least(falling, rising))
    dry = less(numeric(1), over(F.coalesce(numeric(precip), numeric(0)), numeric(100)))
    score = times(times(numeric(100), dry), warm)
    score = plus(score, times(numeric(p.w_wind), blow))
    return plus(score, times(numeric(p.w_humid), ramp_numeric(humid, p.humidity_cutoff, p.humidity_ideal)))
