"""Hourly averages per city (D-a, H2, H3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.functions.timecols import epoch_to_instant, event_date, hour_floor
from nimbus.schemas import HOURLY_COLUMNS, HOURLY_MEASURES


def hourly_avg(df: DataFrame) -> DataFrame:
    """D-a: averages of temperature, humidity, wind speed and cloud cover per (city, UTC hour).

    Works on staging (one row per reading) or on raw (every copy counted, as the
    reference's rollup does). The hour is cut on epoch seconds, so it is the UTC
    hour in any session zone. Hash aggregation with a partial (map-side) step:
    a city holding a third of all readings is folded to one row per hour in
    every map task before the shuffle. ``avg`` skips nulls.
    """
    hour = hour_floor("timestamp").alias("_hour")
    return (df.groupBy("city_id", hour)
            .agg(F.avg("temperature").alias("avg_temp"),
                 F.avg("humidity").alias("avg_humidity"),
                 F.avg("wind_speed").alias("avg_wind_speed"),
                 F.avg("cloud_coverage").alias("avg_cloud_coverage"))
            .withColumn("timestamp_hour", epoch_to_instant("_hour"))
            .select(*HOURLY_COLUMNS))


def hourly_parts(df: DataFrame) -> DataFrame:
    """D-a in parts that add up: sum and count of each measure per (city, UTC hour) of these rows alone.

    Readings are only ever inserted, so the parts of every increment together are those of the whole table:
    no reading is read a second time, however late another one of its hour comes.
    """
    parts = [f(m).alias(f"{name}_{m}") for m in HOURLY_MEASURES.values()
             for name, f in (("sum", lambda c: F.sum(F.col(c).cast("double"))), ("n", F.count))]
    return (df.groupBy("city_id", hour_floor("timestamp").alias("hour")).agg(*parts)
            .withColumn("event_date", event_date("hour")))


def merge_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same (city, hour) added up: one row each."""
    sums = [F.sum(f"{name}_{m}").alias(f"{name}_{m}") for m in HOURLY_MEASURES.values() for name in ("sum", "n")]
    return parts.groupBy("city_id", "hour", "event_date").agg(*sums).select(*parts.columns)


def averages_of(parts: DataFrame) -> DataFrame:
    """D-a from parts: the hourly averages (null where no reading of the hour has the measure)."""
    return merge_parts(parts).select(
        "city_id", epoch_to_instant("hour").alias("timestamp_hour"),
        *(F.try_divide(f"sum_{m}", F.col(f"n_{m}").cast("double")).alias(avg) for avg, m in HOURLY_MEASURES.items()), "event_date")
