"""Connectors and table helpers."""

import pytest
from pyspark.sql import functions as F

from conftest import raw_df, raw_row
from nimbus.sinks.batch import compact, write_batch
from nimbus.sinks.manifest import Manifest
from nimbus.sinks.tables import replace_table
from nimbus.operators.audit import ConstraintViolation, pk_violations
from nimbus.sources import jdbc, kafka
from nimbus.sources.tables import provision, read_current, read_table, read_table_or_none


def test_kafka_options_and_missing_connector(spark):
    o = kafka.kafka_source_options("b:9092", "weather", maxOffsetsPerTrigger=1000)
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "weather", "startingOffsets": "earliest",
                 "maxOffsetsPerTrigger": "1000"}
    with pytest.raises(Exception) as e:
        kafka.read_kafka(spark, "b:9092", "weather")
    assert "kafka" in str(e.value).lower()


def test_to_messages_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "k int, s string, x double")
    m = kafka.to_messages(df, key="k").first()
    assert m.key == "1" and m.value == '{"k":1,"s":"a","x":2.5}'


def test_jdbc_option_shapes():
    o = jdbc.jdbc_options("jdbc:postgresql://h/db", "raw", {"user": "u", "driver": "org.postgresql.Driver"})
    assert o["dbtable"] == "raw" and o["user"] == "u"
    p = jdbc.partition_options("id", 0, 1000, 8)
    assert p == {"partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8"}


def test_write_batch_is_idempotent(spark, tmp):
    df = raw_df(spark, [raw_row(id=1), raw_row(id=2)])
    write_batch(df, 0, f"{tmp}/raw")
    write_batch(df, 0, f"{tmp}/raw")                 # a retried batch replaces itself
    write_batch(df.limit(0), 1, f"{tmp}/raw")        # an empty one writes no row
    back = spark.read.parquet(f"{tmp}/raw")
    assert back.count() == 2 and set(back.columns) >= {"batch_id", "event_date"}


def test_compaction_bounds_the_files_of_closed_dates(spark, tmp):
    import os
    for n in range(50):
        write_batch(raw_df(spark, [raw_row(id=n, city_id=n, timestamp=1744502461 + n)]).coalesce(1), n, f"{tmp}/raw")
    before = sorted(tuple(r) for r in read_table(spark, f"{tmp}/raw", "raw").select("id", "city_id", "timestamp").collect())
    dates = [r.event_date for r in read_table(spark, f"{tmp}/raw", "raw").select("event_date").distinct().collect()]
    assert compact(spark, f"{tmp}/raw", "raw", dates) == 50
    assert Manifest(spark, f"{tmp}/raw").vacuum(grace=0) == 50 and compact(spark, f"{tmp}/raw", "raw", dates) == 0
    files = [f for _, _, fs in os.walk(f"{tmp}/raw") for f in fs if f.endswith(".parquet")]
    assert len(files) <= 4
    after = sorted(tuple(r) for r in read_table(spark, f"{tmp}/raw", "raw").select("id", "city_id", "timestamp").collect())
    assert before == after and len(after) == 50


def test_old_generations_are_removed(spark, tmp):
    import os
    for n in range(150):
        Manifest(spark, f"{tmp}/many").commit([(f"generation={n}", None, 0, 0, 0)], removed=[f"generation={n - 1}"] if n else [], kind="compact")
    for n in range(4):
        replace_table(spark.createDataFrame([(n,)], "id int"), f"{tmp}/t", grace=0)
    assert len([d for d in os.listdir(f"{tmp}/t") if d.startswith("generation=")]) == 1
    assert [tuple(r) for r in read_current(spark, f"{tmp}/t").collect()] == [(3,)]
    replace_table(spark.createDataFrame([(4,)], "id int"), f"{tmp}/t")                    # readers of the old one go on
    assert len([d for d in os.listdir(f"{tmp}/t") if d.startswith("generation=")]) == 2
    for n in range(100):                                                               # the log is folded, not only read
        Manifest(spark, f"{tmp}/many").commit([(f"generation=x{n}", None, 0, 0, 0)], kind="compact")
    replace_table(spark.createDataFrame([(5,)], "id int"), f"{tmp}/many", grace=0)
    assert len(os.listdir(f"{tmp}/many/_log")) <= 2 * 202 and [tuple(r) for r in read_current(spark, f"{tmp}/many").collect()] == [(5,)]


def test_catalog_table_follows_the_generations(spark, tmp):
    """Readers by name see one generation as a whole, the new one at once; a failed refresh leaves the old."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS nimbus_gen LOCATION '{tmp}/wh'")
    name = "nimbus_gen.t"
    assert read_table_or_none(spark, name) is None
    replace_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), f"{tmp}/t", name=name)
    reader = read_table_or_none(spark, name)
    assert sorted(r.id for r in reader.collect()) == [1, 2]
    replace_table(spark.createDataFrame([(3, "c")], "id int, v string"), f"{tmp}/t", name=name)
    assert [r.id for r in read_table_or_none(spark, name).collect()] == [3]
    assert sorted(r.id for r in reader.collect()) == [1, 2]                             # resolved before the switch
    bad = spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string")
    with pytest.raises(ConstraintViolation):
        replace_table(bad, f"{tmp}/t", audits={"pk": pk_violations(bad, ["id"])}, name=name)
    assert [r.id for r in read_table_or_none(spark, name).collect()] == [3]
    spark.sql("DROP DATABASE nimbus_gen CASCADE")


def test_jobs_on_provisioned_tables(spark, tmp):
    """A12 then L2 and L3: the catalog tables give the rows that the jobs wrote."""
    from conftest import SF_SMALL
    from nimbus.plans import jobs
    from nimbus.sources import testdata as td
    provision(spark, "nimbus_jobs", f"{tmp}/wh")
    paths = jobs.Paths(f"{tmp}/wh", database="nimbus_jobs")
    write_batch(td.readings(spark, SF_SMALL), 0, paths.raw)
    jobs.update_staging(spark, paths)
    jobs.rollup_hourly(spark, paths)
    from nimbus.sources.tables import register
    from nimbus.streaming.hourly import read_hourly
    register(spark, "nimbus_jobs", paths.root, "raw")
    for again in (False, True):
        for name in ("raw", "staging", "cities"):
            stored = read_table(spark, getattr(paths, name), name)
            assert read_table_or_none(spark, f"nimbus_jobs.{name}").count() == stored.count() > 0, name
        by_name, by_path = read_table_or_none(spark, "nimbus_jobs.hourly"), read_hourly(spark, paths.hourly_state)
        assert sorted(map(tuple, by_name.select(*by_path.columns).collect()), key=repr) == sorted(map(tuple, by_path.collect()), key=repr)
        # more readings in other folders, then one folder a date: the catalog follows the log
        if not again:
            more = raw_df(spark, [raw_row(id=-1, city_id=1, city="Customer#000000001", country="N1")])
            write_batch(more, 1, paths.raw)
            jobs.update_staging(spark, paths)
            jobs.rollup_hourly(spark, paths)
            dates = [r.event_date for r in read_table(spark, paths.staging, "staging").select("event_date").distinct().collect()]
            compact(spark, paths.staging, "staging", dates)
            register(spark, "nimbus_jobs", paths.root, "raw", "staging")
            Manifest(spark, paths.staging).vacuum(grace=0)
    assert not [k for k, v in jobs.constraint_audits(spark, paths).items() if not v.isEmpty()]
    spark.sql("DROP DATABASE nimbus_jobs CASCADE")


def test_replace_table_is_guarded(spark, tmp):
    good = spark.createDataFrame([(1, "a")], "id int, v string")
    replace_table(good, f"{tmp}/t")
    bad = spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string")
    with pytest.raises(ConstraintViolation):
        replace_table(bad, f"{tmp}/t", audits={"pk": pk_violations(bad, ["id"])})
    assert [tuple(r) for r in read_current(spark, f"{tmp}/t").collect()] == [(1, "a")]
    replace_table(spark.createDataFrame([(2, "b")], "id int, v string"), f"{tmp}/t")
    assert [tuple(r) for r in read_current(spark, f"{tmp}/t").collect()] == [(2, "b")]
    assert read_current(spark, f"{tmp}/none", "hourly").count() == 0


def test_provision_and_read_helpers(spark, tmp):
    made = provision(spark, "nimbus_test", f"{tmp}/wh")
    assert made == [f"nimbus_test.{t}" for t in ("raw", "staging", "cities", "hourly_state", "hourly")]
    provision(spark, "nimbus_test", f"{tmp}/wh")        # if not exists: second call is a no-op
    assert read_table_or_none(spark, "nimbus_test.cities") is None           # empty
    assert read_table_or_none(spark, "nimbus_test.nope") is None             # missing
    spark.createDataFrame([(1, "x", "UK", 1.0, 2.0, "w", 0)], "id int, name string, country string, latitude double, "
                          "longitude double, writer string, batch_id long").write.insertInto("nimbus_test.cities")
    assert read_table_or_none(spark, "nimbus_test.cities").count() == 1
    raw = spark.table("nimbus_test.raw")
    assert raw.schema["event_date"].dataType.simpleString() == "date"
    empty = read_table(spark, f"{tmp}/absent", "staging")
    assert empty.count() == 0 and "timestamp_utc" in empty.columns
    spark.sql("DROP DATABASE nimbus_test CASCADE")
