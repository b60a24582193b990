"""Table writes guarded by the constraint audits (A8, A9 publishing, D9)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.operators.audit import require_clean
from nimbus.sinks.manifest import COMPACT, GRACE_SECONDS, Manifest


def append_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("event_date",),
                 audits: dict[str, DataFrame] | None = None) -> None:
    """Append after the audits pass. On a store without atomic renames a reader may see part of a running append."""
    require_clean(**(audits or {}))
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_table(df: DataFrame, path: str, audits: dict[str, DataFrame] | None = None,
                  partition_by: tuple[str, ...] = (), grace: float = GRACE_SECONDS, name: str | None = None) -> str:
    """Full refresh of a derived table, published only when the audits pass.

    The reference truncates first and loads second, so a failed load leaves the table empty. Here the new content
    goes to a folder of its own; one record of the table's commit log then puts it in place of the old one, and
    readers (``read_current``) take the folder that the log names. A failed refresh leaves the previous generation
    current; a reader that resolved the old one keeps reading intact files for ``grace`` seconds, then they go.
    Of two refreshes at once the later is refused. With ``name`` the catalog table of that name is pointed at the
    new folder after the record is there, so its readers see the one or the other generation as a whole.
    """
    require_clean(**(audits or {}))
    spark = df.sparkSession
    log = Manifest(spark, path)
    before = log.state()
    folder = f"generation={before.version + 1}-{uuid.uuid4().hex[:12]}"
    target = f"{path.rstrip('/')}/{folder}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    log.commit([(folder, None, 0, 0, 0)], removed=before.folders(), writer="refresh", kind=COMPACT, expected=before.version)
    if name:
        publish(spark, name, target)
    log.vacuum(grace)
    log.expire()
    return target


def publish(spark: SparkSession, name: str, target: str) -> None:
    """Make ``target`` the location of the catalog table ``name`` (A12), created on its first publication."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{target}'")


def clustered_by_date(df: DataFrame, keys=("city_id", "timestamp")) -> DataFrame:
    """Lay rows out for a write partitioned by ``event_date``.

    Rows arriving hash-partitioned on a key put every date in every task, so a partitioned write opens (tasks x
    dates) files: millions of small files for a backfill over years. Range-partitioned and sorted on
    ``(event_date, *keys)``, each task holds a contiguous slice of one or two dates (a hot city's day is split by
    time), AQE sizes the tasks, and file statistics on the keys let readers skip.
    """
    order = [F.col("event_date"), *[F.col(k) for k in keys]]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
