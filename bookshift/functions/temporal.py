"""Date and time column functions.

Values stay ``TIMESTAMP_NTZ`` (wall-clock time without a zone), so results do
not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone the target API expects wall-clock times in.
DEFAULT_ZONE = "Australia/Sydney"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tz_stamp(c: str | Column, zone: str = DEFAULT_ZONE) -> Column:
    """Naive local time -> ISO-8601 text with the zone's offset, seconds precision.

    ``2022-12-07 00:00`` -> ``2022-12-07T00:00:00+11:00``.  In the autumn
    overlap (a wall time that occurs twice) the standard offset is used; in
    the spring gap (a wall time that never occurs) the wall time is kept and
    the standard offset is used.  Null stays null.

    The wall time's microseconds are carried into a TIMESTAMP unchanged and
    shifted with ``to_utc_timestamp`` (the zone is resolved once per task,
    not per row); the offset is the shift.  An ambiguous wall time resolves
    to the earlier (daylight) instant; it is ambiguous exactly when the same
    wall time comes back one hour later, and then one hour is taken off.
    No step reads the session time zone.
    """
    ts = _c(c).cast("timestamp_ntz")
    micros = wall_micros(ts)
    wall = F.timestamp_micros(micros)
    instant = F.to_utc_timestamp(wall, zone)
    again = F.from_utc_timestamp(instant + F.expr("INTERVAL 1 HOUR"), zone) == wall
    minutes = ((micros - F.unix_micros(instant)) / 60_000_000).cast("bigint") - F.when(again, 60).otherwise(0)
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    hh = F.lpad((F.abs(minutes) / 60).cast("int").cast("string"), 2, "0")
    mm = F.lpad((F.abs(minutes) % 60).cast("int").cast("string"), 2, "0")
    text = F.substring(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), 1, 19)
    return F.concat(text, sign, hh, F.lit(":"), mm)


def wall_micros(c: str | Column) -> Column:
    """Microseconds of a wall-clock time counted as if it were UTC.

    Built from the date and time fields, which read the same in every session
    zone.  (``timestamp_diff`` on wall-clock values passes through the session
    zone and moves a wall time that falls in that zone's spring gap.)
    """
    ts = _c(c).cast("timestamp_ntz")
    seconds = F.extract(F.lit("SECOND"), ts)  # seconds with microsecond fraction
    return (F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000_000
            + F.hour(ts).cast("bigint") * 3_600_000_000 + F.minute(ts).cast("bigint") * 60_000_000
            + (seconds * 1_000_000).cast("bigint"))


def parse_iso(c: str | Column) -> Column:
    """ISO text -> TIMESTAMP_NTZ."""
    return _c(c).cast("timestamp_ntz")


def add_months_keep_time(c: str | Column, months: int = 1) -> Column:
    """Month arithmetic that keeps the time of day and clamps to month end.

    ``2023-01-31 10:00 + 1 month`` -> ``2023-02-28 10:00``.  ``add_months``
    would return a date and lose the time.
    """
    return F.timestamp_add("MONTH", F.lit(months), _c(c))


def years_to_months(c: str | Column) -> Column:
    """Term in years -> number of monthly instalments."""
    return _c(c) * F.lit(12)
