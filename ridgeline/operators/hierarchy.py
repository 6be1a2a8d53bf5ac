"""Area hierarchy, dimension and area filters (P3-P7, V4). All narrow: no
shuffle anywhere in this module."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import parent_of, safe_get
from ..functions.text import normalize_article


def area_hierarchy(stg_areas: DataFrame) -> DataFrame:
    """Parent (second-from-last ancestor), country and region (first
    two path tokens). A root has a NULL parent."""
    return stg_areas.select(
        "id", "latitude", "longitude", "area_name",
        parent_of("ancestors").alias("parent_id"),
        safe_get("path_array", 0).alias("country"),
        safe_get("path_array", 1).alias("region"),
        "is_leaf",
    )


def dim_area(hierarchy: DataFrame) -> DataFrame:
    """Area dimension with ``"Gorge, The"`` written as ``"The Gorge"``."""
    return hierarchy.select("id", normalize_article("area_name").alias("area_name"), "latitude", "longitude",
                            "parent_id", "country", "region", "is_leaf")


def target_areas(dim: DataFrame, parents: Iterable[str] | DataFrame,
                 excluded_names: Iterable[str] = ("Beaches",), as_text: bool = False) -> DataFrame:
    """Areas under the given parents, minus excluded names (a NULL
    name is dropped too, as ``<>`` is NULL there).

    ``parents`` may be a list (an ``IN`` filter pushed to the scan) or a
    one-column DataFrame of ids (a semi-join: the parent list can grow)."""
    out = dim
    for name in excluded_names:
        out = out.filter(F.col("area_name") != F.lit(name))
    if isinstance(parents, DataFrame):
        pid = parents.select(F.col(parents.columns[0]).alias("_pid"))
        out = out.join(pid, out["parent_id"] == pid["_pid"], "left_semi")
    else:
        out = out.filter(F.col("parent_id").isin(list(parents)))
    if as_text:
        return out.select(F.col("id").cast("string").alias("area_id"), F.col("latitude").cast("string").alias("lat"),
                          F.col("longitude").cast("string").alias("long"))
    return out.select(F.col("id").alias("area_id"), "latitude", "longitude")


def area_node(dim: DataFrame, area_id: str) -> DataFrame:
    """Bound-parameter point lookup (the literal is pushed to the scan)."""
    return dim.filter(F.col("id") == F.lit(area_id))


def area_kind(dim: DataFrame) -> DataFrame:
    """V4: leaf areas render as a crag page, others as a branch page."""
    return dim.withColumn("area_kind", F.when(F.col("is_leaf"), F.lit("crag")).otherwise(F.lit("branch")))
