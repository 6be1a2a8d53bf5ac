"""Array helpers with warehouse ``SAFE_OFFSET`` semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def safe_get(arr, index) -> Column:
    """0-based element; NULL when out of range, negative or the array is
    NULL (``get``; ``element_at`` would raise under ANSI)."""
    idx = index if isinstance(index, Column) else F.lit(index)
    return F.get(_c(arr), idx)


def parent_of(ancestors) -> Column:
    """Second-from-last ancestor: the list ends with the node itself."""
    a = _c(ancestors)
    return safe_get(a, F.size(a) - F.lit(2))
