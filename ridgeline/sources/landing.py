"""Landing readers and writers (newline-delimited JSON).

Landing layout is Hive-style: ``{base}/source=<s>/task=<t>/run_ts=<ts>/part-*``.
A run is read back by partition pruning on ``run_ts`` instead of a file-name
glob, and every record can be traced to its file with ``_metadata``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import iso_utc
from ..session import child_names


def path_glob(base: str, source: str, task: str, run_ts: str | None = None) -> str:
    """Folder (or glob) holding one source/task, optionally one run."""
    p = f"{base.rstrip('/')}/source={source}/task={task}"
    return f"{p}/run_ts={run_ts}" if run_ts else p


def _reader(spark: SparkSession, schema: str):
    # Explicit schema: no inference pass over the files; no multiLine so the
    # reader splits large files across tasks.
    return spark.read.schema(schema).option("mode", "FAILFAST")


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The newest run below a source/task folder, from the folder names alone."""
    runs = [n.partition("=")[2] for n in child_names(spark, root) if n.startswith("run_ts=")]
    return max(runs, default=None)


def _read_partitioned(spark, base, source, task, schema, run_ts=None, latest_only=False):
    """One run's folder when a run is given or the newest is asked for, else all runs."""
    root = path_glob(base, source, task)
    if latest_only and run_ts is None:
        run_ts = latest_run(spark, root)
    path = root if run_ts is None else path_glob(base, source, task, str(run_ts))
    return _reader(spark, schema + ", run_ts string").option("basePath", root).json(path)


def read_forecast_landing(spark: SparkSession, base: str, run_ts: str | None = None,
                          source: str = "nws", task: str = "ingest_nws_hourly_forecast") -> DataFrame:
    """Forecast envelopes ``{data, extracted_at_ts}``; ``data`` stays JSON text."""
    df = _read_partitioned(spark, base, source, task, schemas.RAW_NWS, run_ts)
    return df.select("data", "extracted_at_ts")


def read_gridpoint_landing(spark: SparkSession, base: str, run_ts: str | None = None,
                           source: str = "nws", task: str = "resolve_gridpoints") -> DataFrame:
    """Area-to-cell resolutions, four typed fields."""
    df = _read_partitioned(spark, base, source, task, schemas.RAW_GRIDPOINTS, run_ts)
    return df.select("area_id", "grid_id", "grid_x", "grid_y")


def read_area_landing(spark: SparkSession, base: str, latest_only: bool = True,
                      source: str = "graph_ql", task: str = "ingest_graphql_areas") -> DataFrame:
    """S3: area records. ``latest_only=False`` reads every past run, which is
    what a truncate-and-reload of all files does (duplicates per run)."""
    df = _read_partitioned(spark, base, source, task, schemas.RAW_AREAS, latest_only=latest_only)
    return df.select("uuid", "area_name", "areaName", "pathTokens", "ancestors", "children", "metadata")


def read_country_landing(spark: SparkSession, base: str, latest_only: bool = True,
                         source: str = "graph_ql", task: str = "ingest_graphql_countries") -> DataFrame:
    """Country names."""
    df = _read_partitioned(spark, base, source, task, schemas.RAW_COUNTRIES, latest_only=latest_only)
    return df.select("areaName")


def stamp_envelope(df: DataFrame, payload_col: str = "data", as_of=None) -> DataFrame:
    """Wrap a JSON payload as ``{"data": <payload>, "extracted_at_ts": "<UTC ISO>Z"}``.

    ``as_of`` is a timestamp Column (per-row extraction time) or a literal;
    the payload is embedded as JSON, not as a quoted string.
    """
    ts = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    env = df.select(F.col(payload_col).alias("data"), iso_utc(ts).alias("extracted_at_ts"))
    return to_records(env, json_cols=["data"])


def to_records(df: DataFrame, json_cols: Iterable[str] = (), keep: Iterable[str] = ()) -> DataFrame:
    """Rows to NDJSON text in column ``value``. ``json_cols`` hold JSON text
    that is embedded verbatim (not re-encoded: key order and number text of
    the source document survive the landing), NULL as ``null``. ``keep``
    columns are passed through beside ``value`` and left out of the record."""
    json_cols, keep = set(json_cols), list(keep)
    fields = []
    for c in [c for c in df.columns if c not in keep]:
        if c in json_cols:
            name = json.dumps(c, ensure_ascii=False)
            fields.append(F.concat(F.lit(f"{name}:"), F.coalesce(F.col(c), F.lit("null"))))
        else:  # {"c":...} without its braces
            one = F.to_json(F.struct(F.col(c)), {"ignoreNullFields": "false"})
            fields.append(F.substr(one, F.lit(2), F.char_length(one) - 2))
    return df.select(*keep, F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")).alias("value"))


def write_landing(df: DataFrame, base: str, source: str, task: str, run_ts: str,
                  json_cols: Iterable[str] = ()) -> str:
    """Land records as NDJSON under one run folder.

    A frame with a single string column ``value`` is written as is (already
    NDJSON lines); anything else is serialized with :func:`to_records`.
    Overwrite of the run folder makes a retried run idempotent.
    """
    if df.columns != ["value"]:
        df = to_records(df, json_cols)
    out = path_glob(base, source, task, run_ts)
    df.write.mode("overwrite").text(out)
    return out


def json_mode(strict: bool) -> dict[str, str]:
    """Parser options: malformed JSON fails the job, or becomes NULL."""
    return {"mode": "FAILFAST" if strict else "PERMISSIVE"}


def flatten_pages(pages: DataFrame, key: str, element_schema: str, page_col: str = "page",
                  strict: bool = True) -> DataFrame:
    """One row per element of ``data.<key>[]`` in each API page; a
    missing or NULL key gives no rows, and a malformed page fails the job
    (``strict=False``: gives none). ``element_schema`` is the struct's DDL;
    JSON-valued members should be declared ``string`` to keep their text."""
    arr = F.from_json(F.col(page_col), f"struct<data:struct<{key}:array<struct<{element_schema}>>>>",
                      json_mode(strict))
    return pages.select(F.inline(F.coalesce(arr["data"][key],
                                            F.array().cast(f"array<struct<{element_schema}>>"))))


def project_gridpoints(responses: DataFrame, id_col: str = "area_id", body_col: str = "response",
                       strict: bool = True) -> DataFrame:
    """Point-lookup responses to ``(area_id, grid_id, grid_x, grid_y)``."""
    p = F.from_json(F.col(body_col), schemas.GRIDPOINT_RESPONSE, json_mode(strict))["properties"]
    return responses.select(F.col(id_col).alias("area_id"), p["gridId"].alias("grid_id"),
                            p["gridX"].alias("grid_x"), p["gridY"].alias("grid_y"))
