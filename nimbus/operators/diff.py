"""Snapshot comparison (G1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADDED = "added"
REMOVED = "removed"


def snapshot_diff(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """G1: rows added to and removed from a result between two snapshots (bag semantics).

    The two bag differences: each is one aggregate per distinct row (partial, map-side: repeated identical rows are
    summed before the shuffle), and a row with net count n is replicated n times one by one, never as an array.
    """
    cols = cur.columns
    prev = prev.select(*cols)
    return (cur.exceptAll(prev).withColumn("change", F.lit(ADDED))
            .unionByName(prev.exceptAll(cur).withColumn("change", F.lit(REMOVED))))


def has_changed(prev: DataFrame, cur: DataFrame) -> bool:
    """True when the two snapshots differ; stops at the first differing row."""
    return not snapshot_diff(prev, cur).isEmpty()
