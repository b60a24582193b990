"""Streaming forms (L1, I1-I9): stream = batch, restarts add nothing, retries overwrite."""

import os

from pyspark.sql import functions as F

from nimbus.operators.decode import messages_to_raw
from nimbus.operators.rollup import hourly_avg
from nimbus.operators.staging import stage
from nimbus.plans.catalog import comparable
from nimbus.sources import testdata as td
from nimbus.sources.files import read_messages, write_messages
from nimbus.streaming.dedupe import start_dedupe
from nimbus.streaming.hourly import read_hourly, staging_stream, start_hourly
from nimbus.streaming.ingest import start_ingest
from nimbus.streaming.staging import raw_stream, start_staging
from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end
from conftest import SF_SMALL


def publish(spark, root):
    write_messages(td.messages(spark, SF_SMALL).repartitionByRange(3, "offset"), f"{root}/messages")
    write_messages(td.replays(spark, SF_SMALL).coalesce(1), f"{root}/messages")
    with open(f"{root}/messages/part-zz-bad.txt", "w") as f:
        f.write('{"coord": {"lon": 1.0,\n{"dt": 5, "id": 1}\n')


def ingest(spark, root, ck="ingest"):
    src = read_messages(spark, f"{root}/messages", stream=True, max_files_per_trigger=2)
    q = start_ingest(src, f"{root}/raw", f"{root}/quarantine", f"{root}/_ck/{ck}", AVAILABLE_NOW)
    run_to_end(q)
    return q


def rows(df, drop=()):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=repr)


def test_ingest_stream_equals_batch_and_restarts_add_nothing(spark, tmp):
    publish(spark, tmp)
    q = ingest(spark, tmp)
    seen = sum(p.observedMetrics["messages"]["rows"] for p in q.recentProgress
               if "messages" in (p.observedMetrics or {}))
    assert seen == read_messages(spark, f"{tmp}/messages", stream=False).count()
    streamed = spark.read.parquet(f"{tmp}/raw").drop("writer", "batch_id")
    batch_raw, batch_bad = messages_to_raw(read_messages(spark, f"{tmp}/messages", stream=False))
    assert rows(streamed.select(*batch_raw.columns)) == rows(batch_raw)
    bad = spark.read.parquet(f"{tmp}/quarantine").drop("writer", "batch_id")
    assert rows(bad.select(*batch_bad.columns)) == rows(batch_bad)
    assert {r.reason for r in bad.collect()} == {"malformed", "no_weather"}
    folders = spark.read.parquet(f"{tmp}/raw").select("writer", "batch_id").distinct().collect()
    assert len(folders) >= 2 and len({r.writer for r in folders}) == 1
    n = streamed.count()
    # restart on the same checkpoint: nothing new
    ingest(spark, tmp)
    assert spark.read.parquet(f"{tmp}/raw").count() == n
    # a retried batch (same query, same id) replaces its folder
    from nimbus.streaming.ingest import ingest_batch
    from nimbus.sinks.batch import writer_tag
    again = read_messages(spark, f"{tmp}/messages", stream=False).limit(50)
    ingest_batch(again, 7, f"{tmp}/raw", f"{tmp}/quarantine", writer_tag(f"{tmp}/_ck/ingest"))
    ingest_batch(again, 7, f"{tmp}/raw", f"{tmp}/quarantine", writer_tag(f"{tmp}/_ck/ingest"))
    tag = writer_tag(f"{tmp}/_ck/ingest")
    mine = spark.read.parquet(f"{tmp}/raw").filter((F.col("writer") == tag) & (F.col("batch_id") == 7))
    assert mine.count() == messages_to_raw(again)[0].count()


def test_staging_hourly_dedupe_streams_equal_batch(spark, tmp):
    publish(spark, tmp)
    ingest(spark, tmp)
    raw = spark.read.parquet(f"{tmp}/raw").drop("writer", "batch_id")
    run_to_end(start_staging(raw_stream(spark, f"{tmp}/raw", max_files_per_trigger=1), f"{tmp}/staging",
                             f"{tmp}/cities", f"{tmp}/quarantine", f"{tmp}/_ck/staging", AVAILABLE_NOW))
    stg = spark.read.parquet(f"{tmp}/staging").drop("writer", "batch_id")
    expected = stage(raw)
    n = stg.count()
    assert n == expected.count()
    assert rows(stg.select(*expected.columns), drop=("id",)) == rows(expected, drop=("id",))
    cities = spark.read.parquet(f"{tmp}/cities").drop("writer", "batch_id")
    assert cities.count() == raw.select("city_id").distinct().count() == cities.select("id").distinct().count()
    expected_hourly = rows(comparable(hourly_avg(stg)))
    # a second staging query (new checkpoint) over the same raw adds nothing
    run_to_end(start_staging(raw_stream(spark, f"{tmp}/raw"), f"{tmp}/staging", f"{tmp}/cities", f"{tmp}/quarantine",
                             f"{tmp}/_ck/staging2", AVAILABLE_NOW))
    assert spark.read.parquet(f"{tmp}/staging").count() == n

    run_to_end(start_hourly(staging_stream(spark, f"{tmp}/staging", 1), f"{tmp}/hourly_state", f"{tmp}/_ck/hourly", AVAILABLE_NOW))
    assert rows(comparable(read_hourly(spark, f"{tmp}/hourly_state").drop("event_date"))) == expected_hourly

    run_to_end(start_dedupe(raw_stream(spark, f"{tmp}/raw", 1), f"{tmp}/keys", f"{tmp}/_ck/dedupe", AVAILABLE_NOW))
    got = spark.read.parquet(f"{tmp}/keys").select("city_id", "timestamp")
    assert got.count() == got.distinct().count() == raw.select("city_id", "timestamp").distinct().count()


def test_replay_under_new_checkpoint_adds_no_staging_rows(spark, tmp):
    publish(spark, tmp)
    ingest(spark, tmp)
    run_to_end(start_staging(raw_stream(spark, f"{tmp}/raw"), f"{tmp}/staging", f"{tmp}/cities", f"{tmp}/quarantine",
                             f"{tmp}/_ck/staging", AVAILABLE_NOW))
    n_raw = spark.read.parquet(f"{tmp}/raw").count()
    n_stg = spark.read.parquet(f"{tmp}/staging").count()
    ingest(spark, tmp, ck="replay")                      # the whole topic again, new checkpoint
    assert spark.read.parquet(f"{tmp}/raw").count() == 2 * n_raw
    run_to_end(start_staging(raw_stream(spark, f"{tmp}/raw"), f"{tmp}/staging", f"{tmp}/cities", f"{tmp}/quarantine",
                             f"{tmp}/_ck/staging", AVAILABLE_NOW))   # same staging query resumes
    assert spark.read.parquet(f"{tmp}/staging").count() == n_stg


def test_a_micro_batch_is_held_in_no_cache(spark, tmp, monkeypatch):
    """The parsed rows of a micro-batch go to a folder: splits of any size and number, no cached block of a split, nothing left behind."""
    import os
    from pyspark.sql import DataFrame
    from nimbus.streaming import ingest as I
    publish(spark, tmp)
    want_raw, want_bad = messages_to_raw(read_messages(spark, f"{tmp}/messages", stream=False))
    want_raw, want_bad = rows(want_raw), rows(want_bad)
    work = []

    def no_cache(*_, **__):
        raise AssertionError("a micro-batch is cached")
    monkeypatch.setattr(DataFrame, "persist", no_cache)
    monkeypatch.setattr(DataFrame, "cache", no_cache)
    monkeypatch.setattr(I, "run_dir", lambda _, name: work.append(f"{tmp}/work-{name}-{len(work)}") or work[-1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")          # many splits a file
    try:
        ingest(spark, tmp)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(work) >= 2 and not any(os.path.exists(w) for w in work)
    raw, bad = (spark.read.parquet(f"{tmp}/{t}").drop("writer", "batch_id") for t in ("raw", "quarantine"))
    assert rows(raw.select(*messages_to_raw(read_messages(spark, f"{tmp}/messages", stream=False))[0].columns)) == want_raw
    assert rows(bad.select("city_id", "timestamp", "reason", "value", "msg_id")) == want_bad


def test_checkpoint_is_mandatory(spark, tmp):
    import pytest
    from nimbus.streaming.triggers import start
    src = read_messages(spark, tmp, stream=True)
    with pytest.raises(ValueError):
        start(src.writeStream.format("noop"), "", AVAILABLE_NOW)
