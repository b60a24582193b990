"""Corrected messages of the quarantine enter raw once, under the identity they had."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.operators.decode import parse_messages, raw_and_quarantine
from nimbus.operators.staging import dedupe
from nimbus.session import run_dir
from nimbus.sinks.batch import append_new, remove
from nimbus.sources.tables import read_folders, read_table
from nimbus.streaming.triggers import dates_of

WRITER = "replay"


def replay(corrections: DataFrame, raw_path: str, quarantine_path: str, ledger_path: str) -> DataFrame:
    """Ingest ``corrections`` (``msg_id``, ``value``: the corrected text) of set-aside messages.

    Taken are messages that are in the quarantine and not yet in the ledger of replayed ones (of several corrections
    of one message the first in the order of their texts). Readings enter raw under the ids that the message
    would have had, only if raw lacks them; then the ledger takes the messages that gave readings. A run that dies
    in between is simply run again: what is in raw stays as it is. Messages that are still bad stay in the
    quarantine; they are returned with their reason.
    """
    spark = corrections.sparkSession
    work = run_dir(spark, "replay")
    held = read_table(spark, quarantine_path, "quarantine").select("msg_id").filter("msg_id IS NOT NULL").distinct()
    done = read_table(spark, ledger_path, "replayed").select("msg_id")
    first = dedupe(corrections.select("msg_id", "value"), keys=("msg_id",), order=[F.col("value").asc_nulls_last()])
    (parse_messages(first.join(held, "msg_id", "left_semi").join(done, "msg_id", "left_anti"))
     .write.parquet(f"{work}/parsed"))
    parsed = spark.read.parquet(f"{work}/parsed")
    good, bad = raw_and_quarantine(parsed)
    dates = dates_of(good)
    if dates:
        def absent(now):
            return good.join(read_folders(spark, raw_path, "raw", now.folders(dates)).select("id"), "id", "left_anti").select(*good.columns)
        append_new(spark, raw_path, absent, None, WRITER)
        taken = parsed.filter(F.col("weather_pos").isNotNull()).select(F.col("_msg.msg_id").alias("msg_id")).distinct()
        append_new(spark, ledger_path, lambda now: taken.join(
            read_folders(spark, ledger_path, "replayed", now.folders()), "msg_id", "left_anti"), None, WRITER, partition_by=())
    bad.write.parquet(f"{work}/bad")
    remove(spark, f"{work}/parsed")
    return spark.read.schema(bad.schema).parquet(f"{work}/bad")
