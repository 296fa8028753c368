"""Date helpers for trip timestamps kept as text in the source files."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date given to trips whose pickup time does not parse, and the
# timestamp layout of the trip files.
UNPARSED_PICKUP_DATE = _dt.date(1970, 1, 1)
TRIP_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pickup_date(c) -> Column:
    """ISO date/time text -> calendar date; anything unparseable -> 1970-01-01."""
    parsed = _col(c).cast("string").try_cast("timestamp_ntz")
    return F.coalesce(F.to_date(parsed), F.lit(UNPARSED_PICKUP_DATE))


def trip_duration_seconds(start, end, fmt: str = TRIP_TS_FORMAT) -> Column:
    """Seconds from start to end, both text in ``fmt``; 0.0 if either fails to parse.

    Negative when the dropoff precedes the pickup, as in the source data.  The
    difference is taken between wall-clock (time-zone-free) values, so it does
    not depend on the session time zone or its daylight-saving rules.
    """
    def wall(c):
        text = _col(c).cast("string")
        ok = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
        # only rows that match ``fmt`` reach the (raising) parser
        return F.when(ok, F.to_timestamp_ntz(text, F.lit(fmt)))

    diff = F.timestamp_diff("SECOND", wall(start), wall(end)).cast("double")
    return F.coalesce(diff, F.lit(0.0))


def month_str(c) -> Column:
    """Month number -> two-digit text ('1' -> '01')."""
    return F.lpad(_col(c).cast("string"), 2, "0")


def month_key(date_col) -> Column:
    """Date -> 'YYYY_MM', the name of a monthly weather file."""
    return F.date_format(_col(date_col), "yyyy_MM")
