"""Sources and sinks: NDJSON landings, API-page flattening, table sinks."""

from .landing import (flatten_pages, path_glob, project_gridpoints, read_area_landing,
                      read_country_landing, read_forecast_landing, read_gridpoint_landing,
                      stamp_envelope, to_records, write_landing)
from .tables import append_table, clustered, publish, read_table, replace_table, store_bucketed

__all__ = [
    "path_glob", "read_forecast_landing", "read_gridpoint_landing", "read_area_landing",
    "read_country_landing", "stamp_envelope", "to_records", "write_landing", "flatten_pages",
    "project_gridpoints", "append_table", "replace_table", "read_table", "publish", "clustered",
    "store_bucketed",
]
