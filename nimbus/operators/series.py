"""Per-city time-series operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_city(df: DataFrame) -> DataFrame:
    """The newest reading of every city (ties: highest id).

    ``row_number() == 1`` gets a partial group limit before the shuffle, so each
    map task sends at most one row per city however hot the city is.
    """
    w = Window.partitionBy("city_id").orderBy(F.col("timestamp").desc_nulls_last(),
                                              F.col("id").desc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def detect_changes(df: DataFrame) -> DataFrame:
    """Flag readings whose time differs from the city's previous reading.

    In the total order (timestamp, id nulls first, other columns) a row's predecessor has the same time unless the row
    is the first of its (city_id, timestamp) key. The first row of every key comes from an aggregate (partial,
    map-side: a key repeated a billion times is folded in every map task); the rest is the bag difference of all rows
    and those first rows, which sums equal rows map-side too and replicates them row by row. So neither a hot city
    nor a hot key nor a repeated or null id lands in one task or counts twice. (A ``lag`` window partitioned by city
    would put a hot city in one task; a join back on the id miscounts ids that repeat or are null.)
    """
    others = [c for c in df.columns if c not in ("city_id", "timestamp", "id")]
    first = (df.groupBy("city_id", "timestamp").agg(F.min(F.struct("id", *others)).alias("_f"))
             .select(*[F.col(c) if c in ("city_id", "timestamp") else F.col(f"_f.{c}").alias(c) for c in df.columns]))
    return (first.withColumn("is_change", F.lit(True))
            .unionByName(df.exceptAll(first).withColumn("is_change", F.lit(False))))
