"""Schemas of the message payload and of the four tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The message contract (field names and types of the weather service's
# current-conditions document) and the raw table's column names below.
# One current-weather reading as published on the message bus. Every field is
# nullable. ``dt`` is epoch seconds as a 64-bit integer (a 32-bit float would
# snap it to multiples of 128 s near 1.7e9).
PAYLOAD = T.StructType([
    T.StructField("coord", T.StructType([
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
    ])),
    T.StructField("weather", T.ArrayType(T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("main", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("icon", T.StringType()),
    ]))),
    T.StructField("base", T.StringType()),
    T.StructField("main", T.StructType([
        T.StructField("temp", T.DoubleType()),
        T.StructField("feels_like", T.DoubleType()),
        T.StructField("temp_min", T.DoubleType()),
        T.StructField("temp_max", T.DoubleType()),
        T.StructField("pressure", T.IntegerType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("sea_level", T.IntegerType()),
        T.StructField("grnd_level", T.IntegerType()),
    ])),
    T.StructField("visibility", T.IntegerType()),
    T.StructField("wind", T.StructType([
        T.StructField("speed", T.DoubleType()),
        T.StructField("deg", T.IntegerType()),
        T.StructField("gust", T.DoubleType()),
    ])),
    T.StructField("clouds", T.StructType([
        T.StructField("all", T.IntegerType()),
    ])),
    T.StructField("dt", T.LongType()),
    T.StructField("sys", T.StructType([
        T.StructField("type", T.IntegerType()),
        T.StructField("id", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("sunrise", T.LongType()),
        T.StructField("sunset", T.LongType()),
    ])),
    T.StructField("timezone", T.IntegerType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("code", T.IntegerType()),
])

CORRUPT_COLUMN = "_corrupt_record"

# Flattened reading: (name, payload path). ``weather`` paths refer to the exploded element.
READING_FIELDS = [
    ("longitude", "coord.lon"),
    ("latitude", "coord.lat"),
    ("weather_main", "w.main"),
    ("weather_description", "w.description"),
    ("weather_icon", "w.icon"),
    ("temperature", "main.temp"),
    ("feels_like", "main.feels_like"),
    ("temp_min", "main.temp_min"),
    ("temp_max", "main.temp_max"),
    ("pressure", "main.pressure"),
    ("humidity", "main.humidity"),
    ("sea_level", "main.sea_level"),
    ("grnd_level", "main.grnd_level"),
    ("visibility", "visibility"),
    ("wind_speed", "wind.speed"),
    ("wind_direction", "wind.deg"),
    ("wind_gust", "wind.gust"),
    ("cloud_coverage", "clouds.all"),
    ("timestamp", "dt"),
    ("country", "sys.country"),
    ("sunrise", "sys.sunrise"),
    ("sunset", "sys.sunset"),
    ("timezone", "timezone"),
    ("city_id", "id"),
    ("city", "name"),
]

READING_COLUMNS = [name for name, _ in READING_FIELDS]

# raw: surrogate id + the 25 reading columns + position in the weather list + partition column.
RAW_COLUMNS = ["id", *READING_COLUMNS, "weather_pos", "event_date"]

CITY_TEXT_COLUMNS = ["city", "country", "latitude", "longitude"]

# staging: raw without the city's descriptive columns, plus the reading time as an instant.
STAGING_COLUMNS = (["id"] + [c for c in READING_COLUMNS if c not in CITY_TEXT_COLUMNS]
                   + ["timestamp_utc", "weather_pos", "event_date"])

CITY_COLUMNS = ["id", "name", "country", "latitude", "longitude"]

HOURLY_COLUMNS = ["city_id", "timestamp_hour", "avg_temp", "avg_humidity", "avg_wind_speed",
                  "avg_cloud_coverage"]

# Averages of the hourly table and the measures they are of.
HOURLY_MEASURES = dict(zip(HOURLY_COLUMNS[2:], ("temperature", "humidity", "wind_speed", "cloud_coverage")))

# Table constraints the database enforced in the reference; audited here (nimbus.operators.audit).
PRIMARY_KEYS = {
    "raw": ["id"],
    "staging": ["id"],
    "staging_reading": ["city_id", "timestamp"],
    "cities": ["id"],
    "hourly": ["city_id", "timestamp_hour"],
}
NOT_NULL = {"cities": ["name", "latitude", "longitude"]}
MAX_LENGTH = {"raw": {"country": 5}, "cities": {"country": 5}}
