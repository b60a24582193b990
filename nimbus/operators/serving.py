"""Serving queries of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.functions import display as D
from nimbus.functions.timecols import event_date, hour_midpoint_local, hours_before, local_wall
from nimbus.operators.series import latest_per_city


def newest(df: DataFrame, ts: str = "timestamp_utc") -> Column:
    """Scalar subquery: the newest instant of a table (a reproducible "now" for tests)."""
    return df.agg(F.max(ts)).scalar()


def last_hours(df: DataFrame, hours: int = 24, now: Column | None = None, ts: str = "timestamp_utc") -> DataFrame:
    """Rows of the trailing ``hours`` up to ``now`` (default: the current time).

    Tables partitioned by ``event_date`` also get a partition bound, so only the
    last day or two of files are opened.
    """
    now = F.current_timestamp() if now is None else now
    cutoff = hours_before(now, hours)
    cond = F.col(ts) >= cutoff
    if "event_date" in df.columns:
        cond = cond & (F.col("event_date") >= event_date(F.unix_seconds(cutoff)))
    return df.filter(cond)


def for_city(df: DataFrame, city_id) -> DataFrame:
    """Readings of one city (pushed to the scan / the database)."""
    return df.filter(F.col("city_id") == F.lit(city_id))


def find_city(cities: DataFrame, name: str, country: str) -> DataFrame:
    """The city with this name and country (at most one row, lowest id)."""
    return (cities.filter((F.col("name") == F.lit(name)) & (F.col("country") == F.lit(country)))
            .orderBy("id").limit(1))


def for_named_city(df: DataFrame, cities: DataFrame, name: str, country: str) -> DataFrame:
    """Readings of the city looked up by name and country, without a driver round trip.

    The looked-up side is at most one row (``limit 1``), so broadcasting it is safe.
    """
    city = find_city(cities, name, country).select(F.col("id").alias("city_id"))
    return df.join(F.broadcast(city), "city_id", "left_semi")


def latest(df: DataFrame) -> DataFrame:
    """the single newest reading (top-1: ``TakeOrderedAndProject``, no full sort)."""
    return df.orderBy(F.col("timestamp").desc_nulls_last(), F.col("id").desc_nulls_last()).limit(1)


def with_city(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Readings with their city's name (as ``city``), country and position (left join).

    The reading keeps its own ``id``; the dimension's key is dropped.
    """
    dim = cities.select(F.col("id").alias("_city_key"), F.col("name").alias("city"),
                        "country", "latitude", "longitude")
    joined = df.join(dim, df["city_id"] == dim["_city_key"], "left")
    return joined.drop("_city_key")


def city_offsets(staging: DataFrame) -> DataFrame:
    """Each city's UTC offset, from its newest reading (one row per city)."""
    return latest_per_city(staging).select("city_id", F.col("timezone").alias("city_timezone"))


# The dashboard's record of the newest reading, (record field, source column).
WEATHER_RECORD_FIELDS = [
    ("city_id", "city_id"), ("city", "city"), ("country", "country"), ("latitude", "latitude"),
    ("longitude", "longitude"), ("temperature", "temperature"), ("feels_like", "feels_like"),
    ("humidity", "humidity"), ("wind_speed", "wind_speed"), ("wind_deg", "wind_direction"),
    ("clouds", "cloud_coverage"), ("visibility", "visibility"), ("weather", "weather_description"),
    ("weather_icon", "weather_icon"), ("sunrise", "sunrise"), ("sunset", "sunset"), ("timestamp", "timestamp"),
    ("timezone_offset", "timezone"),
]


def weather_record(readings_with_city: DataFrame) -> DataFrame:
    """The 18-field record the card is drawn from (renames included)."""
    return readings_with_city.select(*[F.col(src).alias(name) for name, src in WEATHER_RECORD_FIELDS])


def latest_records(staging: DataFrame, cities: DataFrame) -> DataFrame:
    """B15 + E1 + C2: every city's newest reading as a dashboard record."""
    return weather_record(with_city(latest_per_city(staging), cities))


def conditions_card(staging: DataFrame, cities: DataFrame) -> DataFrame:
    """The current-conditions card of every city, from its newest reading.

    One row per city: the dashboard's card for one city is this filtered by
    ``city_id``. All text is built with JVM expressions.
    """
    cur = with_city(latest_per_city(staging), cities)
    tz = F.col("timezone")
    return cur.select(
        "city_id", "city", "country", "latitude", "longitude",
        "timestamp",
        D.updated_text("timestamp", tz).alias("updated_text"),
        D.metric_text("temperature", "°C").alias("temperature_text"),
        F.concat(F.lit("Feels like "), D.metric_text("feels_like", "°C")).alias("feels_like_text"),
        F.concat(F.col("humidity").cast("string"), F.lit("%")).alias("humidity_text"),
        F.concat(D.plain_text("wind_speed"), F.lit(" m/s "),
                 D.wind_octant("wind_direction")).alias("wind_text"),
        F.col("weather_description").alias("weather"),
        D.icon_url("weather_icon").alias("icon_url"),
        F.concat(F.col("cloud_coverage").cast("string"), F.lit("%")).alias("clouds_text"),
        F.concat(D.km("visibility").cast("string"), F.lit(" km")).alias("visibility_text"),
        D.clock_text("sunrise", tz).alias("sunrise_text"),
        D.clock_text("sunset", tz).alias("sunset_text"),
        D.daylight_hours("sunrise", "sunset").alias("daylight_hours"),
        D.daylight_minutes("sunrise", "sunset").alias("daylight_minutes"),
        D.daylight_text("sunrise", "sunset").alias("daylight_text"),
    )


def city_series(staging: DataFrame, cities: DataFrame, name: str, country: str, hours: int = 24,
                now: Column | None = None, sort: bool = True) -> DataFrame:
    """The named city's readings of the trailing hours, with local wall time, newest first."""
    rows = last_hours(for_named_city(staging, cities, name, country), hours, now)
    rows = rows.withColumn("local_time", local_wall("timestamp", "timezone"))
    return rows.orderBy(F.col("timestamp").desc(), F.col("id").desc()) if sort else rows


def hourly_overlay(hourly: DataFrame, staging: DataFrame) -> DataFrame:
    """H15 + D12: each hourly bucket's midpoint in its city's local time.

    The offset is the city's own (joined by ``city_id``), not the offset of
    whatever reading happens to sit at the same row position.
    """
    joined = hourly.join(city_offsets(staging), "city_id", "left")
    return joined.withColumn("local_time", hour_midpoint_local(F.unix_seconds("timestamp_hour"),
                                                               F.col("city_timezone")))
