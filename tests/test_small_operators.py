"""Small operators without a registered query of their own: A10, B10, D-c, I8's aggregation."""

from pyspark.sql import functions as F

from conftest import raw_df, raw_row
from nimbus.functions.timecols import epoch_to_instant
from nimbus.operators.metrics import counted, rows
from nimbus.operators.rollup import hourly_avg
from nimbus.operators.serving import for_city
from nimbus.operators.staging import to_staging
from nimbus.sinks.batch import preview
from nimbus.sinks.manifest import Manifest
from nimbus.sources.tables import read_table
from nimbus.streaming.hourly import compact_hourly, hourly_batch, read_hourly


def test_preview_is_bounded(spark):
    df = spark.range(100)
    assert preview(df, 7).count() == 7
    assert preview(df.limit(3)).count() == 3


def test_for_city_filters_on_the_key(spark):
    df = raw_df(spark, [raw_row(id=1, city_id=10), raw_row(id=2, city_id=11), raw_row(id=3, city_id=10)])
    assert sorted(r.id for r in for_city(df, 10).collect()) == [1, 3]
    assert for_city(df, 99).isEmpty()


def test_counted_reads_the_count_from_the_one_action(spark, tmp):
    df = spark.range(1234).withColumn("event_date", F.lit("2024-01-01"))
    out, obs = counted(df.filter(F.col("id") % 2 == 0), "even")
    out.write.parquet(f"{tmp}/even")
    assert rows(obs) == 617 == spark.read.parquet(f"{tmp}/even").count()


def test_hourly_batch_adds_only_its_own_rows(spark, tmp):
    """I8: a micro-batch adds the parts of its rows; late rows of an hour count, a retry does not count twice."""
    base = 1744502400   # an hour start
    rs = [raw_row(id=i, city_id=c, timestamp=base + off, temperature=t, humidity=h, wind_speed=w, cloud_coverage=k)
          for i, (c, off, t, h, w, k) in enumerate([
              (1, 0, 10.0, 50, 1.0, 10), (1, 3599, 12.0, None, 3.0, 20), (1, 3600, 5.0, 40, 2.0, 30),
              (2, 10, -1.5, 90, 0.5, 0), (3, 20, None, None, None, None)])]
    late = to_staging(raw_df(spark, rs[:1] + [raw_row(id=9, city_id=5, timestamp=base + 5 * 86400)]))
    first = to_staging(raw_df(spark, rs[1:]))
    for n, batch in enumerate((first, late, late)):
        hourly_batch(batch, min(n, 1), f"{tmp}/state", "w")
    log = Manifest(spark, f"{tmp}/state").state()
    assert log.version == 2 and len(log.live) == 3
    want = hourly_avg(first.unionByName(late))
    got = read_hourly(spark, f"{tmp}/state").drop("event_date")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert compact_hourly(spark, f"{tmp}/state", [first.first().event_date]) == 2
    assert read_table(spark, f"{tmp}/state", "hourly_state").count() == want.count()
    got = read_hourly(spark, f"{tmp}/state").drop("event_date")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    one = [r for r in got.collect() if r.city_id == 1 and r.timestamp_hour ==
           first.select(epoch_to_instant(F.lit(base)).alias("t")).first().t][0]
    assert (one.avg_temp, one.avg_humidity, one.avg_wind_speed, one.avg_cloud_coverage) == (11.0, 50.0, 2.0, 15.0)


def test_a_micro_batch_of_the_hourly_state_reads_its_own_rows_only(spark, tmp, monkeypatch):
    """Read volume: neither staging nor the state is opened, whatever they hold; the parts are those of the batch."""
    from nimbus.sources import tables
    from nimbus.streaming import hourly
    batches = [to_staging(raw_df(spark, [raw_row(id=10 * n + j, city_id=j, timestamp=1744502461 + n) for j in range(4)])) for n in range(3)]
    hourly_batch(batches[0], 0, f"{tmp}/state", "w")

    def closed(*_, **__):
        raise AssertionError("a table was read")
    with monkeypatch.context() as m:
        for module in (hourly, tables):
            m.setattr(module, "read_table", closed)
        m.setattr(tables, "read_folders", closed)
        for n in (1, 2):
            hourly_batch(batches[n], n, f"{tmp}/state", "w")
    parts = [x[2][0] for x in Manifest(spark, f"{tmp}/state").state().live.values()]
    assert parts == [4, 4, 4] and read_hourly(spark, f"{tmp}/state").count() == 4
