"""Time expressions (Column -> Column) over epoch seconds.

Readings carry their time as whole epoch seconds. Every function here works on
that number or on instants derived from it, never through a zone-less string,
so the result does not move with ``spark.sql.session.timeZone`` (the reference
converts through ``from_unixtime``, which is an hour off in a DST fold).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_instant(seconds) -> Column:
    """H1/H2: epoch seconds -> ``timestamp`` (an instant; UTC by definition)."""
    return F.timestamp_seconds(_c(seconds))


def to_utc(ts_wall, zone: str) -> Column:
    """H2: a wall-clock time of ``zone`` -> the instant (UTC). For readings already in epoch
    seconds this is not needed: ``epoch_to_instant`` is UTC by construction."""
    return F.to_utc_timestamp(_c(ts_wall), zone)


def epoch_to_wall(seconds) -> Column:
    """Epoch seconds -> ``timestamp_ntz`` holding the UTC wall-clock time."""
    return F.timestamp_add("SECOND", _c(seconds), F.expr(_EPOCH_NTZ))


def instant_to_wall(ts) -> Column:
    """``timestamp`` -> ``timestamp_ntz`` of its UTC wall clock, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), F.expr(_EPOCH_NTZ))


def wall_to_epoch(ts_ntz) -> Column:
    """``timestamp_ntz`` read as UTC wall time -> whole epoch seconds (floor)."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts_ntz))
    whole = micros - F.pmod(micros, F.lit(1_000_000))
    return (whole / F.lit(1_000_000)).cast("bigint")


def hour_floor(seconds) -> Column:
    """H3: epoch seconds of the start of the UTC hour."""
    s = _c(seconds)
    return s - F.pmod(s, F.lit(SECONDS_PER_HOUR))


def event_date(seconds) -> Column:
    """UTC calendar date of a reading; the partition column of raw and staging."""
    return F.date_from_unix_date(F.floor(_c(seconds) / F.lit(SECONDS_PER_DAY)).cast("int"))


def local_wall(seconds, offset_seconds) -> Column:
    """H8: wall-clock time at the city, from UTC epoch seconds and the city's offset."""
    return epoch_to_wall(_c(seconds) + _c(offset_seconds))


def hour_midpoint_local(hour_seconds, offset_seconds) -> Column:
    """The middle of an hourly bucket (start + 30 min) in the city's wall time."""
    return epoch_to_wall(_c(hour_seconds) + F.lit(30 * 60) + _c(offset_seconds))


def hours_before(now: Column, hours: int) -> Column:
    """``now`` minus a number of hours, on an instant column."""
    return now - F.make_dt_interval(F.lit(0), F.lit(hours))
