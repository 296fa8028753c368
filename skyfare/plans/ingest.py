"""Monthly ingest into the lake table, as one job over the whole month range.

The trips of every month in the range and the weather of every month are read
at once (one scan each); the nearest-station join pairs trips only with
readings of their own date, so months never mix.  Rows get a deterministic key,
rows left incomplete are dropped, and the result is appended to the table
partitioned by (year, month).  Re-running a month appends again (bulk insert,
as the lake table did); use ``upsert_table`` on the key to replace instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.operators import clean
from skyfare.plans.merge import merge_trips_weather
from skyfare.sources.lake import append_partitioned

def prepare_ingest(trips: DataFrame, zones: DataFrame, zone_geocodes: DataFrame,
                   station_rows: DataFrame, station_geocodes: DataFrame,
                   key_cols: Sequence[str] | None = None, required: Sequence[str] | None = None) -> DataFrame:
    """Merged rows with a key, year and month.

    ``key_cols``: what makes a trip's key (default: all its columns).
    ``required``: columns that must not be null after the fill (default: all);
    name them when trip kinds with different columns are ingested together,
    since each kind has nulls in the columns of the others.
    """
    merged = merge_trips_weather(trips, zones, zone_geocodes, station_rows, station_geocodes)
    # the key is never null, so keying after the drop keeps the same rows
    keyed = clean.surrogate_id(clean.fill_zero_and_drop(merged, required), key_cols or trips.columns)
    return keyed.withColumns({"year": F.year("date"), "month": F.month("date")})


def ingest(trips: DataFrame, zones: DataFrame, zone_geocodes: DataFrame, station_rows: DataFrame,
           station_geocodes: DataFrame, table_path: str, key_cols: Sequence[str] | None = None,
           required: Sequence[str] | None = None) -> None:
    rows = prepare_ingest(trips, zones, zone_geocodes, station_rows, station_geocodes, key_cols, required)
    append_partitioned(rows, table_path, ["year", "month"])
