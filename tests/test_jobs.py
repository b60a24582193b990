"""Batch jobs L1-L5 end to end on the sf0.001 tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from nimbus.operators.audit import ConstraintViolation
from nimbus.operators.rollup import hourly_avg
from nimbus.plans import jobs
from nimbus.plans.catalog import comparable
from nimbus.sources import testdata as td
from nimbus.sources.files import write_messages
from nimbus.sources.tables import read_table
from nimbus.streaming.hourly import read_hourly
from nimbus.streaming.latest import BUCKETS


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files_of(path):
    import os
    return {os.path.join(p, f) for p, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_pipeline_jobs(spark, tmp):
    paths = jobs.Paths(f"{tmp}/tables")
    write_messages(td.messages(spark, SF_SMALL, replay=True), f"{tmp}/messages")
    assert jobs.ingest_files(spark, f"{tmp}/messages", paths) >= 1
    raw = read_table(spark, paths.raw, "raw")
    events = td.readings(spark, SF_SMALL)
    valid = events.filter(F.col("id") % 3 != 0)
    assert read_table(spark, paths.quarantine, "quarantine").count() == events.count() - valid.count() + \
        events.filter((F.col("id") % 3 == 0) & (F.col("id") % 10 == 0)).count()
    n_raw = raw.count()
    assert jobs.ingest_files(spark, f"{tmp}/messages", paths) == 0          # the same folder again adds nothing
    assert read_table(spark, paths.raw, "raw").count() == n_raw

    jobs.update_staging(spark, paths)
    stg = read_table(spark, paths.staging, "staging")
    n = stg.count()
    assert n == valid.count() == stg.select("city_id", "timestamp").distinct().count()
    cities = read_table(spark, paths.cities, "cities")
    assert cities.count() == raw.select("city_id").distinct().count()
    jobs.rollup_hourly(spark, paths)
    hourly = read_hourly(spark, paths.hourly_state)
    assert sorted_rows(comparable(hourly.drop("event_date"))) == sorted_rows(comparable(hourly_avg(stg)))

    # a second run over an unchanged table opens no raw folder and adds nothing to the hourly state
    before = files_of(paths.staging), files_of(paths.hourly_state)
    assert jobs.update_staging(spark, paths) == 0 and jobs.rollup_hourly(spark, paths) == 0
    assert (files_of(paths.staging), files_of(paths.hourly_state)) == before

    name = cities.orderBy("id").first()
    jobs.update_latest(spark, paths)
    top = F.timestamp_seconds(F.lit(stg.filter(F.col("city_id") == name["id"]).agg(F.max("timestamp")).first()[0]))
    card = jobs.current_card(spark, paths, name["name"], name["country"], now=top).collect()
    assert len(card) == 1 and card[0].city_id == name["id"]
    assert jobs.current_card(spark, paths, name["name"], name["country"]).isEmpty()     # nothing in the last 24 h of now
    series, overlay = jobs.day_view(spark, paths, name["name"], name["country"], 24 * 40, top)
    own = stg.filter(F.col("city_id") == name["id"]).count()
    assert 0 < series.count() <= own and 0 < overlay.count() <= own
    assert jobs.refreshed(None, series) is series and jobs.refreshed(series, series) is None

    assert jobs.current_card(spark, paths, "x", "y", now=top).isEmpty()
    # the card opens one bucket of the latest readings, and every scan of staging and hourly is bounded by date
    opened = [f for f in jobs.current_card(spark, paths, name["name"], name["country"], now=top).inputFiles() if "/latest/" in f]
    assert opened and {f.split("bucket=")[1].split("/")[0] for f in opened} == {str(name["id"] % BUCKETS)}
    for df in jobs.day_view(spark, paths, "x", "y", now=top):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and ("/staging" in ln or "/hourly" in ln)]
        assert scans and all("event_date" in ln.split("PartitionFilters: [")[1].split("]")[0] for ln in scans)


def test_bad_rows_are_set_aside_and_the_run_goes_on(spark, tmp):
    """A reading without a city name: the same staging, cities and quarantine from the job and from the batch function."""
    from conftest import raw_df, raw_row
    from nimbus.sinks.batch import write_batch
    from nimbus.streaming.staging import staging_batch
    rows = raw_df(spark, [raw_row(id=1, city_id=1), raw_row(id=2, city_id=2, city=None), raw_row(id=3, city_id=3, country="TOOLONG")])
    paths = jobs.Paths(f"{tmp}/a")
    write_batch(rows, 0, paths.raw)
    jobs.update_staging(spark, paths)
    staging_batch(rows, 0, f"{tmp}/b/staging", f"{tmp}/b/cities", f"{tmp}/b/quarantine", "w")
    for name, expected in (("staging", 1), ("cities", 1), ("quarantine", 2)):
        one, two = (read_table(spark, f"{tmp}/{x}/{name}", name) for x in "ab")
        assert sorted_rows(one) == sorted_rows(two) and one.count() == expected, name


def test_staging_refuses_unknown_cities_violation(spark, tmp):
    paths = jobs.Paths(f"{tmp}/tables")
    # a hand-made cities table whose country is too long must stop the new-city insert
    spark.createDataFrame([(1, "X", "TOOLONG", 0.0, 0.0)],
                          "id int, name string, country string, latitude double, longitude double") \
        .write.parquet(f"{tmp}/bad_new")
    bad = spark.read.parquet(f"{tmp}/bad_new")
    from nimbus.sinks.tables import append_table
    from nimbus.operators import audit
    with pytest.raises(ConstraintViolation):
        append_table(bad, paths.cities, partition_by=(),
                     audits={"len": audit.length_violations(bad, "country", 5, ["id"])})


def test_backfill_write_is_clustered_by_date(spark, tmp):
    """An increment is range-clustered before the partitioned write: each task writes one or two date folders, not one
    file per (task, date)."""
    from nimbus.sinks.tables import clustered_by_date
    r = td.readings(spark, SF_SMALL)
    wide = r.repartition(4, "city_id", "timestamp")          # as after the de-duplication shuffle
    clustered_by_date(wide).write.partitionBy("event_date").parquet(f"{tmp}/clustered")
    wide.write.partitionBy("event_date").parquet(f"{tmp}/hashed")
    assert len(files_of(f"{tmp}/clustered")) < len(files_of(f"{tmp}/hashed"))
    assert sorted_rows(spark.read.parquet(f"{tmp}/clustered")) == sorted_rows(r)


def planted(spark, tmp, change):
    """A staging run whose increment is tampered with before it is written."""
    from conftest import raw_df, raw_row
    from nimbus.sinks.batch import write_batch
    from nimbus.streaming import staging as S
    paths = jobs.Paths(tmp)
    write_batch(raw_df(spark, [raw_row(id=1, city_id=1)]), 0, paths.raw)
    jobs.update_staging(spark, paths)
    before = sorted_rows(read_table(spark, paths.staging, "staging"))
    write_batch(raw_df(spark, [raw_row(id=2, city_id=2), raw_row(id=3, city_id=3)]), 1, paths.raw)
    plain = S.to_staging
    S.to_staging = lambda rows: change(plain(rows))
    try:
        with pytest.raises(Exception) as e:
            jobs.update_staging(spark, paths)
        assert "constraint violations" in str(e.value) or "ConstraintViolation" in str(e.value)
    finally:
        S.to_staging = plain
    assert sorted_rows(read_table(spark, paths.staging, "staging")) == before
    jobs.update_staging(spark, paths)                       # the same micro-batch again, untampered
    assert read_table(spark, paths.staging, "staging").count() == 3


def test_planted_duplicate_stops_the_publication(spark, tmp):
    planted(spark, tmp, lambda rows: rows.unionByName(rows.filter("id = 2")))


def test_planted_orphan_stops_the_publication(spark, tmp):
    planted(spark, tmp, lambda rows: rows.withColumn("id", F.when(F.col("id") == 2, F.lit(99)).otherwise(F.col("id"))))


def test_planted_key_of_an_earlier_commit_stops_the_publication(spark, tmp):
    planted(spark, tmp, lambda rows: rows.withColumn("city_id", F.lit(1)).withColumn("id", F.col("id")))


def test_maintenance_beside_the_jobs(spark, tmp):
    """Folders of closed dates are folded, replaced files go, and every job reads on as before."""
    from conftest import raw_df, raw_row
    from nimbus.sinks.batch import write_batch
    from nimbus.sinks.manifest import Manifest
    paths = jobs.Paths(tmp)
    for n in range(3):
        write_batch(raw_df(spark, [raw_row(id=10 * n + j, city_id=j, timestamp=1744502461 + 60 * n) for j in range(3)]), n, paths.raw)
        for job in (jobs.update_staging, jobs.update_latest, jobs.rollup_hourly):
            job(spark, paths)
    day = [r.event_date for r in read_table(spark, paths.staging, "staging").select("event_date").distinct().collect()]
    read = {t: sorted_rows(read_table(spark, getattr(paths, t), t)) for t in ("raw", "staging")}
    hours = sorted_rows(comparable(read_hourly(spark, paths.hourly_state)))
    assert jobs.maintain(spark, paths, day, grace=0) == {"raw": 3, "staging": 3, "hourly_state": 3}
    assert {t: sorted_rows(read_table(spark, getattr(paths, t), t)) for t in read} == read
    assert sorted_rows(comparable(read_hourly(spark, paths.hourly_state))) == hours
    assert all(len(Manifest(spark, getattr(paths, t)).state().live) == 1 for t in ("raw", "staging", "hourly_state"))
    assert jobs.update_staging(spark, paths) == jobs.rollup_hourly(spark, paths) == 1 and read == {
        t: sorted_rows(read_table(spark, getattr(paths, t), t)) for t in read}
