"""I8 / L3: hourly averages kept up to date from new staging rows (same result as the batch rollup)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.operators.audit import null_violations, pk_violations, require_clean
from nimbus.operators.rollup import averages_of, hourly_parts, merge_parts
from nimbus.sinks.batch import compact, write_batch, writer_tag
from nimbus.sinks.manifest import TableStream
from nimbus.sources.tables import read_table, stream_table
from nimbus.streaming.triggers import MAX_FILES

STATE_KEY = ["city_id", "hour"]


def staging_stream(spark: SparkSession, staging_path: str, max_files_per_trigger: int = MAX_FILES) -> TableStream:
    """New rows of the staging table as a stream."""
    return stream_table(spark, staging_path, "staging", max_files_per_trigger)


def audit_parts(parts: DataFrame) -> None:
    """J1 and J3 on the parts of one increment: one row a city and hour, no key missing."""
    require_clean(hourly_pk=pk_violations(parts, STATE_KEY), hourly_not_null=null_violations(parts, STATE_KEY, STATE_KEY))


def hourly_batch(batch: DataFrame, batch_id: int, state_path: str, writer: str) -> None:
    """The parts of the new readings, added to the state as one commit: a micro-batch reads its own rows only.

    Nothing is replaced, so a reader sees an hour before or after a commit and never without its readings, and a
    retried batch is passed over by its id.
    """
    write_batch(hourly_parts(batch.filter(F.col("city_id").isNotNull() & F.col("timestamp").isNotNull())),
                batch_id, state_path, writer=writer, check=audit_parts)


def read_hourly(spark: SparkSession, state_path: str, dates: list | None = None) -> DataFrame:
    """The hourly table: the parts of all commits (of some dates) added up."""
    return averages_of(read_table(spark, state_path, "hourly_state", dates))


def compact_hourly(spark: SparkSession, state_path: str, dates: list) -> int:
    """Add up the parts of these dates for good: one row a city and hour, one folder a date."""
    return compact(spark, state_path, "hourly_state", dates, fold=merge_parts)


def start_hourly(staging: TableStream, state_path: str, checkpoint: str, trigger: dict | None = None):
    """Each micro-batch of new staging rows adds its parts."""
    tag = writer_tag(checkpoint)
    return staging.start_each(lambda df, bid: hourly_batch(df, bid, state_path, tag), checkpoint, tag, trigger)
