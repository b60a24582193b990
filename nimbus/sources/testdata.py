"""Weather tables derived from the driver's generic test tables.

The test data has no weather readings, so ``events`` plays the readings and
``customer`` plays the cities. Each weather column is plain arithmetic on the
event's columns that DuckDB evaluates to the same value (the oracle SQL in
``nimbus.plans.oracle`` mirrors every expression here). Every derived table
grows with the source table; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions.timecols import event_date, wall_to_epoch
from nimbus.schemas import CITY_COLUMNS, RAW_COLUMNS

# Scenario constants (shared with the oracle SQL).
REPLAY_EVERY = 10            # every tenth event is delivered twice, the copy at a new id
LATE_CITY_EVERY = 10          # cities with city_id % 10 = 0 report late
KNOWN_CITY_EVERY = 3          # customers with id % 3 <> 0 are already in the dimension
NAMED_CITY = ("Customer#000000007", "N17")  # the dashboard's configured city


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lat(key: Column) -> Column:
    return (key % 180).cast("double") - F.lit(89.5)


def _lon(key: Column) -> Column:
    return ((key * 7) % 360).cast("double") - F.lit(179.5)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table: one reading per event, ``id`` = ``event_id``."""
    e = table(spark, sf_dir, "events").withColumn("_t", wall_to_epoch("ts"))
    eid, uid, t = F.col("event_id"), F.col("user_id"), F.col("_t")
    day = t - F.pmod(t, F.lit(86400))
    minute_shift = (uid % 60) * 60
    pressure = (F.lit(1010) + eid % 7)
    cols = {
        "id": eid,
        "longitude": _lon(uid),
        "latitude": _lat(uid),
        "weather_main": F.col("event_type"),
        "weather_description": F.concat(F.col("event_type"), F.lit(" sky")),
        "weather_icon": F.when(eid % 101 < 20, F.lit("01d")).otherwise(F.lit("03d")),
        "temperature": F.col("value"),
        "feels_like": F.col("value") - F.lit(1.5),
        "temp_min": F.col("value") - F.lit(2.0),
        "temp_max": F.col("value") + F.lit(2.0),
        "pressure": pressure.cast("int"),
        "humidity": F.get_json_object("props", "$.k").cast("int"),
        "sea_level": (pressure + 2).cast("int"),
        "grnd_level": (pressure + 5).cast("int"),
        "visibility": ((eid * 13) % 10001).cast("int"),
        "wind_speed": F.col("value") / F.lit(10),
        "wind_direction": ((eid * 37) % 361).cast("int"),
        "wind_gust": F.when(eid % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("value") / 10 + 1.25),
        "cloud_coverage": (eid % 101).cast("int"),
        "timestamp": t,
        "country": F.concat(F.lit("N"), (uid % 25).cast("string")),
        "sunrise": day + 21600 + minute_shift,
        "sunset": day + 64800 - minute_shift,
        "timezone": ((uid % 25 - 12) * 3600).cast("int"),
        "city_id": uid.cast("int"),
        "city": F.concat(F.lit("Customer#"), F.lpad(uid.cast("string"), 9, "0")),
        "weather_pos": F.lit(0),
        "event_date": event_date(t),
    }
    return e.select(*[cols[c].alias(c) for c in RAW_COLUMNS])


def replay_shift(spark: SparkSession, sf_dir: str) -> Column:
    """What a copy's id is larger by: beyond every original, whatever the size of the table."""
    return table(spark, sf_dir, "events").agg(F.max("event_id") + 1).scalar()


def replayed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw as a restarted stream leaves it: every tenth reading delivered again under a new id."""
    r = readings(spark, sf_dir)
    copies = r.filter(F.col("id") % REPLAY_EVERY == 0).withColumn("id", F.col("id") + replay_shift(spark, sf_dir))
    return r.unionByName(copies)


def staging_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging table as of the middle of the event range, late cities not yet arrived.

    The cut is the midpoint between the first and the last reading time.
    """
    from nimbus.operators.staging import stage
    r = readings(spark, sf_dir)
    bounds = r.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    mid = bounds.select(((F.col("lo") + F.col("hi")) / 2).alias("m")).scalar()
    early = r.filter((F.col("timestamp") < mid) & (F.col("city_id") % LATE_CITY_EVERY != 0))
    return stage(early)


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a city; country = 'N' + nation key (fits VARCHAR(5))."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.cast("int").alias("id"), F.col("c_name").alias("name"),
                    F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
                    _lat(k).alias("latitude"), _lon(k).alias("longitude")).select(*CITY_COLUMNS)


def known_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension before this run: customers with id % 3 <> 0."""
    return cities(spark, sf_dir).filter(F.col("id") % KNOWN_CITY_EVERY != 0)


def cities_with_nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities whose country is the nation's full name (too long for VARCHAR(5)).

    ``nation`` is a fixed 25-row table, so broadcasting it is bounded.
    """
    n = table(spark, sf_dir, "nation")
    c = table(spark, sf_dir, "customer")
    j = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"], "left")
    k = F.col("c_custkey")
    return j.select(k.cast("int").alias("id"), F.col("c_name").alias("name"), F.col("n_name").alias("country"),
                    _lat(k).alias("latitude"), _lon(k).alias("longitude"))


# --- messages: the readings as JSON text on a message bus -------------------------------------

def _weather_list(r: Column) -> Column:
    """``event_id % 3`` conditions: 0 -> missing (id % 6 = 0) or empty list, 2 -> two conditions."""
    eid = F.col("id")
    first = F.struct(F.lit(800).alias("id"), F.col("weather_main").alias("main"),
                     F.col("weather_description").alias("description"), F.col("weather_icon").alias("icon"))
    second = F.struct(F.lit(801).alias("id"), F.lit("Clouds").alias("main"),
                      F.lit("few clouds").alias("description"), F.lit("02d").alias("icon"))
    n = eid % 3
    return (F.when(n == 1, F.array(first))
            .when(n == 2, F.array(first, second))
            .when(eid % 6 == 3, F.slice(F.array(first), 1, 0)))


def payload_json(r: DataFrame) -> Column:
    """One reading rendered as the bus message (H6: ``to_json``); null fields are omitted."""
    return F.to_json(F.struct(
        F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")).alias("coord"),
        _weather_list(r).alias("weather"),
        F.lit("stations").alias("base"),
        F.struct(F.col("temperature").alias("temp"), "feels_like", "temp_min", "temp_max", "pressure",
                 "humidity", "sea_level", "grnd_level").alias("main"),
        F.col("visibility"),
        F.struct(F.col("wind_speed").alias("speed"), F.col("wind_direction").alias("deg"),
                 F.col("wind_gust").alias("gust")).alias("wind"),
        F.struct(F.col("cloud_coverage").alias("all")).alias("clouds"),
        F.col("timestamp").alias("dt"),
        F.struct(F.lit(1).alias("type"), F.lit(4610).alias("id"), "country", "sunrise",
                 "sunset").alias("sys"),
        F.col("timezone"),
        F.col("city_id").alias("id"),
        F.col("city").alias("name"),
        F.lit(200).alias("code"),
    ))


def as_messages(r: DataFrame) -> DataFrame:
    """Readings as bus messages with Kafka-style coordinates; ``offset`` is the reading's id."""
    return r.select(F.lit("readings").alias("topic"), F.lit(0).alias("partition"),
                    F.col("id").alias("offset"), payload_json(r).alias("value"))


def replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth message delivered again at a new offset (same text), as after a producer retry."""
    m = as_messages(readings(spark, sf_dir).filter(F.col("id") % REPLAY_EVERY == 0))
    return m.withColumn("offset", F.col("offset") + replay_shift(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str, replay: bool = False) -> DataFrame:
    """Bus messages; with ``replay`` the redelivered ones too."""
    m = as_messages(readings(spark, sf_dir))
    return m.unionByName(replays(spark, sf_dir)) if replay else m


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bus with every kind of message that gives no reading: no city (id % 20 = 0), no time (id % 20 = 10),
    no conditions, and text cut in the middle (id % 20 = 5)."""
    r = readings(spark, sf_dir)
    r = (r.withColumn("city_id", F.when(F.col("id") % 20 != 0, F.col("city_id")))
         .withColumn("timestamp", F.when(F.col("id") % 20 != 10, F.col("timestamp"))))
    cut = F.when(F.col("offset") % 20 == 5, F.expr("left(value, 40)")).otherwise(F.col("value"))
    return as_messages(r).withColumn("value", cut)
