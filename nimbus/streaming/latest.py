"""The latest reading of every city as a maintained table, bucketed by city."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.operators.series import latest_per_city
from nimbus.schemas import STAGING_COLUMNS
from nimbus.sinks.batch import compact, write_batch, writer_tag
from nimbus.sinks.manifest import Conflict, Manifest, TableStream
from nimbus.sources.tables import read_table

BUCKETS = 64
FOLD = 16               # live folders of a bucket before they are merged: bounds what a reader opens


def latest_batch(batch: DataFrame, batch_id: int, path: str, writer: str) -> None:
    """Merge a micro-batch of staging rows into the state: its own latest rows are added, nothing is read.

    The latest of the latest is the latest, so readers reduce the few folders of a bucket, and a late reading or a
    retried batch changes nothing that it should not. Full buckets are merged to one row a city.
    """
    rows = latest_per_city(batch.filter(F.col("city_id").isNotNull())).select(*STAGING_COLUMNS)
    write_batch(rows.withColumn("bucket", F.pmod("city_id", F.lit(BUCKETS)).cast("int")), batch_id, path,
                partition_by=("bucket",), writer=writer)
    spark = batch.sparkSession
    held = Counter(part for part, *_ in Manifest(spark, path).state().live.values())
    full = [part for part, n in held.items() if n > FOLD]
    if full:
        try:
            compact(spark, path, "latest", full, fold=latest_per_city, by="bucket")
        except Conflict:
            pass                    # another writer merged them


def read_latest(spark: SparkSession, path: str, city_id: int | None = None) -> DataFrame:
    """The newest reading of every city, or of one (of whose bucket alone a file is opened)."""
    if city_id is None:
        rows = read_table(spark, path, "latest")
    else:
        rows = read_table(spark, path, "latest", [city_id % BUCKETS]).filter(F.col("city_id") == city_id)
    return latest_per_city(rows).select(*STAGING_COLUMNS)


def start_latest(staging: TableStream, path: str, checkpoint: str, trigger: dict | None = None):
    tag = writer_tag(checkpoint)
    return staging.start_each(lambda df, bid: latest_batch(df, bid, path, tag), checkpoint, tag, trigger)
