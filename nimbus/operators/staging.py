"""raw -> staging and the cities dimension (B8, D-b, D-d, D-e, C1, A9, H1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbus.functions.timecols import epoch_to_instant, event_date
from nimbus.schemas import CITY_COLUMNS, MAX_LENGTH, NOT_NULL, STAGING_COLUMNS

KEY = ["city_id", "timestamp"]

GLOBAL = "global"
ANTI = "anti"


def high_water(staging: DataFrame) -> DataFrame:
    """D-b: newest reading time already staged, 0 for an empty table (one row)."""
    return staging.agg(F.coalesce(F.max("timestamp"), F.lit(0).cast("bigint")).alias("high_water"))


def violation() -> Column:
    """Why a raw reading cannot be staged, null if it can: no key, or a city row the dimension may not hold."""
    missing = [F.col("city" if c == "name" else c).isNull() for c in NOT_NULL["cities"]]
    return (F.when(F.col("city_id").isNull() | F.col("timestamp").isNull(), F.lit("null_key"))
            .when(reduce(lambda a, b: a | b, missing), F.lit("city_not_null"))
            .when(F.length("country") > MAX_LENGTH["cities"]["country"], F.lit("country_length")))


def set_aside(raw: DataFrame) -> DataFrame:
    """B12 at staging: the violating readings as quarantine rows (they are in raw: no ``msg_id`` to replay)."""
    return (raw.withColumn("reason", violation()).filter(F.col("reason").isNotNull())
            .select("city_id", "timestamp", "reason", F.to_json(F.struct(*raw.columns)).alias("value"),
                    F.lit(None).cast("bigint").alias("msg_id")))


def since(df: DataFrame, seconds: Column, strict: bool = False) -> DataFrame:
    """Rows with ``timestamp`` at or after (after when ``strict``) a bound.

    The same bound is also put on ``event_date`` when the table has it, so the
    scan skips whole partitions, including when the bound is a scalar subquery
    (evaluated before the scan starts).
    """
    cond = F.col("timestamp") > seconds if strict else F.col("timestamp") >= seconds
    if "event_date" in df.columns:
        cond = cond & (F.col("event_date") >= event_date(seconds))
    return df.filter(cond)


def increment(raw: DataFrame, staging: DataFrame, mode: str = ANTI,
              dedupe_first: bool = False, dates: list | None = None) -> DataFrame:
    """Raw readings not yet in staging.

    ``global``: readings newer than staging's single high-water mark (the
    reference's rule: a late city's older readings are never staged).
    ``anti``: readings whose (city_id, timestamp) is not in staging, late ones
    included, however late. ``raw`` is what arrived since the last run (the staging
    stream's new files), so a run is proportional to new data; ``dates``, the dates
    of ``raw``, open only those partitions of staging.
    ``dedupe_first`` returns one row per key (``dedupe``) and applies it before
    the anti join - the two commute, as both act per key - so replayed copies
    are folded map-side before any shuffle and the join reuses the
    de-duplication's partitioning.
    Rows with a null key are left out here (``set_aside`` gives them to the quarantine).
    """
    keyed = raw.filter(F.col("city_id").isNotNull() & F.col("timestamp").isNotNull())
    if mode == GLOBAL:
        new = since(keyed, high_water(staging).scalar(), strict=True)
        return dedupe(new) if dedupe_first else new
    if mode != ANTI:
        raise ValueError(f"unknown increment mode {mode!r}")
    if dates is not None:
        staged = staging.filter(F.col("event_date").isin(dates))
    else:
        # Exact bound: staged rows older than the oldest candidate cannot match any of them.
        staged = since(staging, keyed.agg(F.min("timestamp")).scalar())
    rows = dedupe(keyed) if dedupe_first else keyed
    return rows.join(staged.select(*KEY), KEY, "left_anti")


def dedupe(df: DataFrame, keys=tuple(KEY), order: list[Column] | None = None) -> DataFrame:
    """D-d: one row per key, the first under a total order.

    Default order: position in the weather list, then id, so the first listed
    condition of a message wins and the choice never depends on scheduling.
    ``row_number() == 1`` plans a partial group limit before the shuffle: each
    map task keeps one row per key, so a key repeated a billion times (a replay
    storm) still sends one row per task over the network.
    """
    order = order or [F.col("weather_pos").asc_nulls_last(), F.col("id").asc_nulls_last()]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def to_staging(deduped: DataFrame) -> DataFrame:
    """H1 + B4: add the reading time as an instant and drop the city's text columns."""
    out = deduped.withColumn("timestamp_utc", epoch_to_instant("timestamp"))
    if "event_date" not in out.columns:
        out = out.withColumn("event_date", event_date("timestamp"))
    if "weather_pos" not in out.columns:
        out = out.withColumn("weather_pos", F.lit(0))
    return out.select(*STAGING_COLUMNS)


def stage(increment_rows: DataFrame) -> DataFrame:
    """De-duplicated staging rows of an increment."""
    return to_staging(dedupe(increment_rows))


def city_candidates(df: DataFrame) -> DataFrame:
    """D-e: one row per city_id with the attributes of its newest reading (ties: lowest id)."""
    newest_first = [F.col("timestamp").desc_nulls_last(), F.col("id").asc_nulls_last()]
    return dedupe(df, keys=("city_id",), order=newest_first).select(
        "city_id", "city", "country", "latitude", "longitude")


def as_city_rows(candidates: DataFrame) -> DataFrame:
    """Candidate columns renamed to the cities table's."""
    return candidates.select(F.col("city_id").cast("int").alias("id"), F.col("city").alias("name"),
                             "country", "latitude", "longitude")


def new_cities(candidates: DataFrame, cities: DataFrame) -> DataFrame:
    """Candidate cities not yet in the dimension (anti join on id).

    No broadcast hint: the dimension's size is not known before it is read, so
    AQE chooses a broadcast from the measured size, or keeps the sort-merge join.
    """
    return as_city_rows(candidates).join(cities.select("id"), "id", "left_anti").select(*CITY_COLUMNS)


def insert_absent(new: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    """Rows to append so that ``existing`` gains the keys it lacks (never updates).

    Same as INSERT ... ON CONFLICT DO NOTHING: the new rows are first reduced to
    one per key (lowest values win, deterministic), then anti-joined.
    """
    first = dedupe(new, keys=(key,), order=[F.col(c).asc_nulls_last() for c in new.columns if c != key])
    return first.join(existing.select(key), key, "left_anti").select(*new.columns)

