"""Hourly averages (D-a), latest per city (E1), change detection (E2), snapshot diff (G1)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import raw_df, raw_row
from nimbus.operators import diff, rollup, series, staging
from nimbus.plans.catalog import comparable


def test_hourly_avg_groups_and_ignores_nulls(spark):
    h0 = 1_704_067_200
    rows = [raw_row(id=1, city_id=1, timestamp=h0 + 10, temperature=10.0, humidity=50),
            raw_row(id=2, city_id=1, timestamp=h0 + 3599, temperature=20.0, humidity=None),
            raw_row(id=3, city_id=1, timestamp=h0 + 3600, temperature=5.0),
            raw_row(id=4, city_id=2, timestamp=h0 + 20, temperature=1.0)]
    out = {(r.city_id, r.timestamp_hour): r for r in comparable(rollup.hourly_avg(raw_df(spark, rows))).collect()}
    assert len(out) == 3
    first = [r for (c, _), r in out.items() if c == 1 and r.avg_temp == 15.0]
    assert first and first[0].avg_humidity == 50.0


def test_hourly_avg_same_in_any_session_zone(spark):
    rng = random.Random(3)
    rows = [raw_row(id=i, city_id=rng.randrange(3), timestamp=1_711_846_800 + rng.randrange(0, 86400 * 3),
                    temperature=float(rng.randrange(40))) for i in range(300)]
    df = raw_df(spark, rows)
    before = spark.conf.get("spark.sql.session.timeZone")
    results = []
    try:
        for zone in ["UTC", "Asia/Kolkata", "Australia/Melbourne", "America/New_York"]:
            spark.conf.set("spark.sql.session.timeZone", zone)
            res = rollup.hourly_avg(df).select("city_id", F.unix_seconds("timestamp_hour").alias("h"), "avg_temp")
            results.append(sorted(tuple(r) for r in res.collect()))
            st = staging.stage(df).select(F.unix_seconds("timestamp_utc").alias("s"), "timestamp")
            assert all(r.s == r.timestamp for r in st.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert all(r == results[0] for r in results)
    assert all(h % 3600 == 0 for _, h, _ in results[0])


def test_hourly_avg_within_group_bounds(spark):
    rng = random.Random(5)
    rows = [raw_row(id=i, city_id=rng.randrange(3), timestamp=rng.randrange(0, 7200),
                    temperature=rng.uniform(-5, 30)) for i in range(200)]
    df = raw_df(spark, rows).withColumn("h", F.col("timestamp") - F.col("timestamp") % 3600)
    bounds = df.groupBy("city_id", "h").agg(F.min("temperature").alias("lo"), F.max("temperature").alias("hi"))
    avg = rollup.hourly_avg(df).withColumn("h", F.unix_seconds("timestamp_hour"))
    j = avg.join(bounds, ["city_id", "h"])
    assert j.count() == avg.count()
    assert j.filter((F.col("avg_temp") < F.col("lo") - 1e-9) | (F.col("avg_temp") > F.col("hi") + 1e-9)).count() == 0


def test_latest_per_city_ties_highest_id(spark):
    rows = [raw_row(id=1, city_id=1, timestamp=5), raw_row(id=2, city_id=1, timestamp=9),
            raw_row(id=3, city_id=1, timestamp=9), raw_row(id=4, city_id=2, timestamp=1)]
    got = {r.city_id: r.id for r in series.latest_per_city(raw_df(spark, rows)).collect()}
    assert got == {1: 3, 2: 4}


def test_detect_changes_equals_lag_rule(spark):
    rng = random.Random(11)
    rows = [raw_row(id=i, city_id=rng.randrange(5), timestamp=rng.randrange(20)) for i in range(400)]
    df = raw_df(spark, rows)
    w = Window.partitionBy("city_id").orderBy("timestamp", "id")
    ref = df.select("id", (~F.lag("timestamp").over(w).eqNullSafe(F.col("timestamp"))).alias("exp"))
    got = series.detect_changes(df).select("id", "is_change")
    j = got.join(ref, "id")
    assert j.count() == 400
    assert j.filter(F.col("is_change") != F.col("exp")).count() == 0


def test_detect_changes_with_repeated_and_null_ids(spark):
    df = raw_df(spark, [raw_row(id=7, city_id=1, timestamp=5), raw_row(id=7, city_id=1, timestamp=5),
                        raw_row(id=None, city_id=2, timestamp=9), raw_row(id=3, city_id=2, timestamp=9),
                        raw_row(id=None, city_id=3, timestamp=1)])
    got = sorted((r.city_id, r.id is None, r.is_change) for r in series.detect_changes(df).collect())
    assert got == [(1, False, False), (1, False, True), (2, False, False), (2, True, True), (3, True, True)]


def test_snapshot_diff_replicates_a_million_copies(spark):
    many = spark.range(1_000_000).selectExpr("1 k", "'a' v")
    none = many.limit(0)
    out = diff.snapshot_diff(none, many)
    assert out.count() == 1_000_000 and out.distinct().count() == 1


def test_snapshot_diff_bag_semantics(spark):
    prev = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    out = sorted(tuple(r) for r in diff.snapshot_diff(prev, cur).collect())
    assert out == [(1, "a", "removed"), (3, "c", "added")]
    assert diff.has_changed(prev, cur)
    assert not diff.has_changed(cur, cur)
