"""Kafka source and sink.

The Kafka connector is a separate Spark package (``spark-sql-kafka``); it is not
part of a plain PySpark install, so these functions build the reader/writer and
fail at ``load()``/``save()`` when the jar is absent. The message transform
(``nimbus.operators.decode``) is the same for Kafka and for the file source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.streaming.triggers import MAX_OFFSETS


def kafka_source_options(servers: str, topic: str, starting: str = "earliest", **extra) -> dict:
    """A1/I4: subscribe to one topic; ``starting`` applies only to a fresh checkpoint."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
               stream: bool = True, **extra) -> DataFrame:
    """A1: messages with their coordinates (topic, partition, offset) and ``value`` (binary).

    Each Kafka partition is read by its own task; ``maxOffsetsPerTrigger`` (``MAX_OFFSETS`` unless given in
    ``extra``) bounds a micro-batch after a long pause.
    """
    reader = spark.readStream if stream else spark.read
    if stream:
        extra.setdefault("maxOffsetsPerTrigger", MAX_OFFSETS)
    opts = kafka_source_options(servers, topic, starting, **extra)
    return reader.format("kafka").options(**opts).load().select("topic", "partition", "offset", "value")


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """H6: every row as one JSON message (``value``), optionally keyed by a column."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def publish(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    """Publish rows as JSON messages to a topic (batch write, one producer per task)."""
    (to_messages(df, key).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
