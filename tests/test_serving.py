"""Display expressions (H7-H16) and serving queries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import raw_df, raw_row
from nimbus.functions import display as D
from nimbus.functions.timecols import instant_to_wall, local_wall
from nimbus.operators import serving, staging


@pytest.mark.parametrize("deg,exp", [(0, "N"), (22.5, "N"), (22.6, "NE"), (67.5, "E"), (112.5, "E"),
                                     (157.5, "S"), (180, "S"), (337.5, "N"), (337.4, "NW"), (359, "N"),
                                     (360, "N"), (382.5, "N"), (400, "NE"), (-45, "NW"), (None, None)])
def test_wind_octant_half_even(spark, deg, exp):
    df = spark.createDataFrame([(None if deg is None else float(deg),)], "d double")
    assert df.select(D.wind_octant("d").alias("o")).first().o == exp


def test_text_expressions(spark):
    df = spark.createDataFrame([(0.25, 0.35, -0.04, 8049, 1704639840, 3600, 1704607200, 1704652380)],
                               "a double, b double, c double, vis int, ts long, tz int, rise long, set long")
    r = df.select(D.metric_text("a", "°C").alias("a"), D.metric_text("b", "°C").alias("b"),
                  D.metric_text("c", "°C").alias("c"), D.km("vis").alias("km"),
                  D.updated_text("ts", "tz").alias("u"), D.clock_text("rise", "tz").alias("rise"),
                  D.daylight_hours("rise", "set").alias("h"), D.daylight_minutes("rise", "set").alias("m"),
                  D.daylight_text("rise", "set").alias("dl"),
                  D.icon_url(F.lit("01d")).alias("icon")).first()
    assert (r.a, r.b, r.c) == ("0.3°C", "0.4°C", "0.0°C")
    assert r.km == 8.0
    assert r.u == "Sunday 7 January, 04:04 PM"
    assert r.rise == "07:00 AM"
    assert (r.h, r.m) == (12, 33) and r.dl == "12 hours, 33 minutes"
    assert r.icon.endswith("01d@2x.png")


def test_local_wall_is_zone_free(spark):
    df = spark.createDataFrame([(1704067200, -18000)], "ts long, tz int")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ["UTC", "Australia/Melbourne"]:
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = df.select(local_wall("ts", "tz").alias("w"),
                          instant_to_wall(F.timestamp_seconds(F.col("ts"))).alias("u")).first()
            assert r.w == dt.datetime(2023, 12, 31, 19, 0) and r.u == dt.datetime(2024, 1, 1, 0, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def cities(spark):
    return spark.createDataFrame([(1, "London", "UK", 51.5, -0.1), (2, "London", "CA", 43.0, -81.2),
                                  (3, "Paris", "FR", 48.9, 2.35)],
                                 "id int, name string, country string, latitude double, longitude double")


def test_find_city_and_series(spark):
    now = 1_744_600_000
    rows = [raw_row(id=i, city_id=1 + i % 2, timestamp=now - i * 3600) for i in range(40)]
    stg = staging.stage(raw_df(spark, rows))
    c = cities(spark)
    assert serving.find_city(c, "London", "CA").first().id == 2
    assert serving.find_city(c, "London", "XX").count() == 0
    nowc = F.timestamp_seconds(F.lit(now))
    ser = serving.city_series(stg, c, "London", "UK", 24, now=nowc).collect()
    # city 1 owns even i; i*3600 <= 24h -> i in 0..24 even
    assert [r.id for r in ser] == list(range(0, 25, 2))
    top = serving.latest(serving.for_named_city(stg, c, "London", "UK")).collect()
    assert [r.id for r in top] == [0]
    empty = serving.latest(serving.for_named_city(stg, c, "Nowhere", "ZZ"))
    assert empty.count() == 0                       # no error on an empty result


def test_last_hours_prunes_partitions(spark, tmp):
    rows = [raw_row(id=i, timestamp=1_744_600_000 - i * 86400) for i in range(10)]
    staging.stage(raw_df(spark, rows)).write.partitionBy("event_date").parquet(f"{tmp}/stg")
    stg = spark.read.parquet(f"{tmp}/stg")
    out = serving.last_hours(stg, 24, now=serving.newest(stg))
    assert out.count() == 2   # the newest reading and the one exactly 24 h before
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan


def test_with_city_left_join_and_card(spark):
    stg = staging.stage(raw_df(spark, [raw_row(id=1, city_id=1), raw_row(id=2, city_id=9, timestamp=5)]))
    j = {r.id: r for r in serving.with_city(stg, cities(spark)).collect()}
    assert j[1].city == "London" and j[1].country == "UK" and j[2].city is None
    card = {r.city_id: r for r in serving.conditions_card(stg, cities(spark)).collect()}
    assert card[1].temperature_text == "12.5°C" and card[1].wind_text == "8.5 m/s S"
    assert card[1].humidity_text == "60%" and card[1].visibility_text == "8.0 km"
    assert card[1].feels_like_text == "Feels like 11.9°C"


def test_hourly_overlay_uses_city_offset(spark):
    stg = staging.stage(raw_df(spark, [raw_row(id=1, city_id=1, timezone=3600),
                                       raw_row(id=2, city_id=2, timezone=-7200)]))
    hourly = spark.createDataFrame([(1, 1744502400), (2, 1744502400)], "city_id int, h long") \
        .select("city_id", F.timestamp_seconds("h").alias("timestamp_hour"))
    got = {r.city_id: r.local_time for r in serving.hourly_overlay(hourly, stg).collect()}
    assert got[1] == dt.datetime(2025, 4, 13, 1, 30) and got[2] == dt.datetime(2025, 4, 12, 22, 30)


def test_to_utc_from_zone_wall_time(spark):
    from nimbus.functions.timecols import to_utc
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12, 0),)], "w timestamp_ntz")
    r = df.select(F.unix_seconds(to_utc(F.col("w").cast("string"), "Europe/London")).alias("s")).first()
    assert r.s == 1719831600        # 12:00 BST = 11:00 UTC


def test_texts_ignore_session_zone_even_in_dst_gaps(spark):
    # 2024-03-10 02:30 does not exist in New York; the city's wall clock still reads it
    ts = 1710037800          # 2024-03-10 02:30 UTC
    df = spark.createDataFrame([(ts, 0, 1704067200, 0)], "ts long, tz int, mid long, z int")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ["UTC", "America/New_York", "Asia/Kolkata"]:
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = df.select(D.updated_text("ts", "tz").alias("u"), D.clock_text("ts", "tz").alias("c"),
                          D.clock_text("mid", "z").alias("m")).first()
            assert (r.u, r.c, r.m) == ("Sunday 10 March, 02:30 AM", "02:30 AM", "12:00 AM"), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_wind_octant_matches_python_half_even_rounding(spark):
    import random
    rng = random.Random(9)
    degs = [rng.uniform(0, 360) for _ in range(2000)] + [22.5 * k for k in range(17)] + [float(k) for k in range(361)]
    df = spark.createDataFrame([(d,) for d in degs], "d double")
    got = [r.o for r in df.select(D.wind_octant("d").alias("o")).collect()]
    expected = [D.COMPASS_POINTS[round((d % 360) / 45)] for d in degs]
    assert got == expected
