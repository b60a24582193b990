"""E2 on the stream: a change event for every reading whose time differs from the city's previous one, at insertion.

The reference's database trigger fires on each inserted row and compares it with the row before. Here the time last seen
of each city is the query's state: a bucketed table beside its checkpoint, to which a micro-batch adds the times of its own
cities. Events and state go to batch tables with the micro-batch's id, so a restart repeats none.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbus.functions.timecols import event_date
from nimbus.operators.decode import messages_to_raw
from nimbus.operators.staging import KEY
from nimbus.sinks.batch import committed, compact, write_batch, writer_tag
from nimbus.sinks.manifest import Manifest
from nimbus.sources.files import number_lines
from nimbus.sources.tables import read_table
from nimbus.streaming.triggers import start

BUCKETS = 64
FOLD = 16               # live folders of a bucket before they are merged: bounds what a micro-batch opens


def last_seen(state: DataFrame) -> DataFrame:
    """Of each city the time of the newest micro-batch that had it."""
    return (state.groupBy("city_id", "bucket").agg(F.max(F.struct("seq", "last")).alias("s"))
            .select("city_id", "s.last", "s.seq", "bucket"))


def change_events(readings: DataFrame, seen: DataFrame) -> DataFrame:
    """Change events of one micro-batch (``id``, ``city_id``, ``timestamp``), with the time before, and after ``seen``.

    The readings of a city are taken in the order (time, id); copies are folded to the first id of each time before
    any row is ordered.
    """
    first = readings.groupBy(*KEY).agg(F.min("id").alias("id"))
    before = F.lag("timestamp").over(Window.partitionBy("city_id").orderBy("timestamp"))
    return (first.withColumn("before", before).join(seen.select("city_id", "last"), "city_id", "left")
            .withColumn("previous", F.coalesce("before", "last")).filter(~F.col("timestamp").eqNullSafe(F.col("previous")))
            .select("id", "city_id", "timestamp", "previous", event_date("timestamp").alias("event_date")))


def changes_batch(batch: DataFrame, batch_id: int, path: str, state_path: str, writer: str) -> None:
    """Events of a micro-batch against the state before it, then its last times into the state.

    What is added to the state depends on the micro-batch alone, and only once the events are there: a run that dies in
    between is run again, passes over the events and adds it then.
    """
    spark = batch.sparkSession
    if committed(spark, state_path, writer, batch_id):
        return
    readings = messages_to_raw(number_lines(batch))[0].select("id", *KEY).persist()
    try:
        write_batch(change_events(readings, last_seen(read_table(spark, state_path, "seen"))), batch_id, path, writer=writer)
        last = readings.groupBy("city_id").agg(F.max("timestamp").alias("last"))
        write_batch(last.select("city_id", "last", F.lit(batch_id).cast("long").alias("seq"),
                                F.pmod("city_id", F.lit(BUCKETS)).cast("int").alias("bucket")),
                    batch_id, state_path, partition_by=("bucket",), writer=writer)
    finally:
        readings.unpersist()
    held = Counter(part for part, *_ in Manifest(spark, state_path).state().live.values())
    full = [part for part, n in held.items() if n > FOLD]
    if full:
        compact(spark, state_path, "seen", full, fold=last_seen, by="bucket")
        log = Manifest(spark, state_path)
        log.vacuum(grace=0)         # no other query reads it
        log.expire()


def start_changes(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Change events of the messages of a stream, written exactly once; the state is kept in the checkpoint's folder."""
    tag = writer_tag(checkpoint)
    state_path = f"{checkpoint.rstrip('/')}/seen"
    return start(messages.writeStream.outputMode("append").foreachBatch(lambda df, bid: changes_batch(df, bid, path, state_path, tag)),
                 checkpoint, trigger)
