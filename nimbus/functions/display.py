"""Display expressions of the conditions card (Column -> Column, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbus.functions.timecols import _c, local_wall

# Fixed values that must equal the reference's output.
# Compass points, indexed by round-half-even(degrees / 45); the ninth entry closes the circle.
COMPASS_POINTS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW", "N"]
# Image address of a weather icon code: prefix + code + suffix.
ICON_URL_PREFIX = "http://openweathermap.org/img/wn/"
ICON_URL_SUFFIX = "@2x.png"
# Text layouts: "%A %-d %B, %I:%M %p" (last updated) and "%I:%M %p" (clock), English names.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
               "October", "November", "December"]


def wind_octant(degrees) -> Column:
    """H7: degrees -> 8-point compass name.

    Half-even rounding of degrees/45 (22.5 -> N, 67.5 -> E, 112.5 -> E), as the
    reference's Python ``round``. Degrees are first folded into [0, 360) so values
    past 382.5 or below zero give a direction instead of an error.
    """
    idx = F.bround(F.pmod(_c(degrees).cast("double"), F.lit(360.0)) / F.lit(45.0)).cast("int")
    return F.try_element_at(F.array(*[F.lit(p) for p in COMPASS_POINTS]), idx + F.lit(1))


def _names(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _clock(wall: Column) -> Column:
    """"03:04 PM" from a wall time. Built from its fields (``hour``/``minute`` of a
    ``timestamp_ntz`` read no zone), not with ``date_format``, which converts through
    the session zone and would move wall times that fall in a DST gap of that zone."""
    h = F.hour(wall)
    return F.format_string("%02d:%02d %s", F.pmod(h + F.lit(11), F.lit(12)) + F.lit(1), F.minute(wall),
                           F.when(h < 12, F.lit("AM")).otherwise(F.lit("PM")))


def updated_text(seconds, offset_seconds) -> Column:
    """H9: "Sunday 7 January, 03:04 PM" in the city's local time."""
    wall = local_wall(seconds, offset_seconds)
    return F.format_string("%s %d %s, %s", F.element_at(_names(DAY_NAMES), F.dayofweek(wall)),
                           F.dayofmonth(wall), F.element_at(_names(MONTH_NAMES), F.month(wall)), _clock(wall))


def clock_text(seconds, offset_seconds) -> Column:
    """H10: "06:12 AM" in the city's local time (sunrise, sunset)."""
    return _clock(local_wall(seconds, offset_seconds))


def daylight_hours(sunrise, sunset) -> Column:
    """Whole hours of daylight."""
    return F.floor((_c(sunset) - _c(sunrise)) / F.lit(3600)).cast("int")


def daylight_minutes(sunrise, sunset) -> Column:
    """Remaining whole minutes of daylight."""
    return F.floor(F.pmod(_c(sunset) - _c(sunrise), F.lit(3600)) / F.lit(60)).cast("int")


def daylight_text(sunrise, sunset) -> Column:
    """H11: "12 hours, 05 minutes" (minutes two digits, as a clock duration prints)."""
    return F.concat(daylight_hours(sunrise, sunset).cast("string"), F.lit(" hours, "),
                    F.lpad(daylight_minutes(sunrise, sunset).cast("string"), 2, "0"), F.lit(" minutes"))


def km(metres) -> Column:
    """Metres -> kilometres with one decimal."""
    return F.round(_c(metres) / F.lit(1000.0), 1)


def metric_text(value, unit: str) -> Column:
    """One decimal (half-up) followed by a unit, e.g. "12.5°C"; -0.04 shows as "0.0"."""
    rounded = F.round(_c(value).cast("double"), 1)
    # as a decimal, so that large values are written out and there is no negative zero
    return F.concat(F.coalesce(rounded.try_cast("decimal(38,1)").cast("string"), rounded.cast("string")), F.lit(unit))


def plain_text(value) -> Column:
    """A double as text without an exponent."""
    v = _c(value).cast("double")
    digits = F.regexp_replace(F.regexp_replace(v.try_cast("decimal(38,12)").cast("string"), "0+$", ""), r"\.$", ".0")
    usual = (v == 0) | F.abs(v).between(1e-3, 9_999_999.0)
    return F.when(usual | v.isNull(), v.cast("string")).otherwise(F.coalesce(digits, v.cast("string")))


def icon_url(code) -> Column:
    """Image address of an icon code such as "01d"."""
    return F.concat(F.lit(ICON_URL_PREFIX), _c(code), F.lit(ICON_URL_SUFFIX))
