"""raw -> staging, cities (D5, D7, B8, D-b, D-d, D-e, C1, A9)."""

import random

from pyspark.sql import functions as F

from conftest import raw_df, raw_row
from nimbus.operators import staging as st
from nimbus.schemas import STAGING_COLUMNS


def keyset(df, cols=("city_id", "timestamp")):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_high_water_empty_and_full(spark):
    empty = raw_df(spark, [])
    assert st.high_water(empty).first().high_water == 0
    df = raw_df(spark, [raw_row(id=1, timestamp=100), raw_row(id=2, timestamp=300), raw_row(id=3, timestamp=None)])
    assert st.high_water(df).first().high_water == 300


def test_increment_global_loses_late_city_anti_keeps_it(spark):
    staged = st.stage(raw_df(spark, [raw_row(id=1, city_id=1, timestamp=1000),
                                     raw_row(id=2, city_id=2, timestamp=5000)]))
    raw = raw_df(spark, [raw_row(id=1, city_id=1, timestamp=1000), raw_row(id=2, city_id=2, timestamp=5000),
                         raw_row(id=3, city_id=1, timestamp=2000),   # late reading of city 1
                         raw_row(id=4, city_id=2, timestamp=6000),
                         raw_row(id=5, city_id=None, timestamp=7000),
                         raw_row(id=6, city_id=3, timestamp=None)])
    assert keyset(st.increment(raw, staged, "global")) == [(2, 6000)]
    assert keyset(st.increment(raw, staged, "anti")) == [(1, 2000), (2, 6000)]
    aside = st.set_aside(raw).collect()
    assert sorted(r.reason for r in aside) == ["null_key", "null_key"] and all('"id":' in r.value for r in aside)


def test_increment_against_empty_staging(spark):
    raw = raw_df(spark, [raw_row(id=1, timestamp=10), raw_row(id=2, timestamp=20)])
    empty = raw_df(spark, [])
    assert st.increment(raw, empty, "global").count() == 2
    assert st.increment(raw, empty, "anti").count() == 2


def test_increment_keeps_a_reading_months_late(spark):
    staged = st.stage(raw_df(spark, [raw_row(id=1, city_id=1, timestamp=20_000_000)]))
    raw = raw_df(spark, [raw_row(id=2, city_id=1, timestamp=10), raw_row(id=3, city_id=1, timestamp=20_000_000)])
    assert keyset(st.increment(raw, staged, "anti")) == [(1, 10)]
    dates = [r.event_date for r in raw.select("event_date").distinct().collect()]
    assert keyset(st.increment(raw, staged, "anti", dedupe_first=True, dates=dates)) == [(1, 10)]


def test_violating_readings_have_a_reason(spark):
    raw = raw_df(spark, [raw_row(id=1), raw_row(id=2, city=None), raw_row(id=3, latitude=None),
                         raw_row(id=4, country="TOOLONG"), raw_row(id=5, city_id=None, city=None), raw_row(id=6, country=None)])
    assert sorted(r.reason for r in st.set_aside(raw).collect()) == ["city_not_null", "city_not_null", "country_length", "null_key"]


def test_dedupe_first_condition_then_lowest_id(spark):
    rows = [raw_row(id=9, weather_pos=1, weather_main="Clouds"), raw_row(id=9, weather_pos=0, weather_main="Clear"),
            raw_row(id=3, weather_pos=1, weather_main="Rain"), raw_row(id=20, timestamp=1744502521)]
    out = st.dedupe(raw_df(spark, rows)).collect()
    got = {r.timestamp: (r.id, r.weather_main) for r in out}
    assert got == {1744502461: (9, "Clear"), 1744502521: (20, "Clear")}


def test_dedupe_idempotent_and_order_free(spark):
    rng = random.Random(7)
    rows = [raw_row(id=i, city_id=rng.randrange(4), timestamp=rng.randrange(6), weather_pos=rng.randrange(2),
                    temperature=float(i)) for i in range(200)]
    once = st.dedupe(raw_df(spark, rows))
    twice = st.dedupe(once)
    shuffled = list(rows)
    rng.shuffle(shuffled)
    other = st.dedupe(raw_df(spark, shuffled).repartition(7))
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    assert a == sorted(tuple(r) for r in other.collect())
    assert once.count() == once.select("city_id", "timestamp").distinct().count()


def test_dedupe_plans_partial_group_limit(spark):
    df = st.dedupe(raw_df(spark, [raw_row()]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_to_staging_columns_and_time(spark):
    out = st.stage(raw_df(spark, [raw_row()]))
    assert out.columns == STAGING_COLUMNS
    r = out.select(F.unix_seconds("timestamp_utc").alias("s")).first()
    assert r.s == 1744502461


def test_city_candidates_newest_wins(spark):
    rows = [raw_row(id=1, city_id=7, timestamp=10, city="Old"), raw_row(id=2, city_id=7, timestamp=30, city="New"),
            raw_row(id=3, city_id=7, timestamp=30, city="Newer-id"), raw_row(id=4, city_id=8, city="Paris")]
    got = {r.city_id: r.city for r in st.city_candidates(raw_df(spark, rows)).collect()}
    assert got == {7: "New", 8: "Paris"}


def test_new_cities_and_insert_absent(spark):
    cities = spark.createDataFrame([(7, "Known", "UK", 1.0, 2.0)], "id int, name string, country string, "
                                                                   "latitude double, longitude double")
    cands = st.city_candidates(raw_df(spark, [raw_row(id=1, city_id=7), raw_row(id=2, city_id=8, city="Paris")]))
    new = st.new_cities(cands, cities)
    assert [(r.id, r.name) for r in new.collect()] == [(8, "Paris")]
    add = st.insert_absent(st.as_city_rows(cands), cities)
    after = cities.unionByName(add)
    add2 = st.insert_absent(st.as_city_rows(cands), after)
    assert add2.count() == 0                      # twice = once
    assert sorted(r.id for r in after.collect()) == [7, 8]
    assert after.filter("id = 7").first().name == "Known"   # never updates


def test_dedupe_first_equals_dedupe_after(spark):
    rng = random.Random(2)
    rows = [raw_row(id=i, city_id=rng.randrange(4), timestamp=rng.randrange(30), weather_pos=rng.randrange(2))
            for i in range(300)]
    raw = raw_df(spark, rows)
    staged = st.stage(raw_df(spark, [r for r in rows if r["timestamp"] < 10]))
    for mode in ("anti", "global"):
        a = st.dedupe(st.increment(raw, staged, mode))
        b = st.increment(raw, staged, mode, dedupe_first=True)
        assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_dates_open_only_their_partitions_of_staging(spark, tmp):
    rows = [raw_row(id=i, city_id=1, timestamp=1_744_500_000 + i * 86400) for i in range(6)]
    st.stage(raw_df(spark, rows[:4])).write.partitionBy("event_date").parquet(f"{tmp}/stg")
    new = raw_df(spark, rows[3:])
    dates = [r.event_date for r in new.select("event_date").distinct().collect()]
    inc = st.increment(new, spark.read.parquet(f"{tmp}/stg"), "anti", dedupe_first=True, dates=dates)
    assert sorted(r.id for r in inc.collect()) == [4, 5]
    plan = inc._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "/stg" in ln]
    assert scans and all("PartitionFilters: [" in ln and "PartitionFilters: []" not in ln for ln in scans)
