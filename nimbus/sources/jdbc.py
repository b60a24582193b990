"""JDBC tables.

No database runs in this repository's tests; these functions only shape the
reader and writer. Credentials always come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, props: dict | None = None) -> dict:
    opts = {"url": url, "dbtable": table}
    opts.update({k: str(v) for k, v in (props or {}).items()})
    return opts


def partition_options(column: str, lower: int, upper: int, num_partitions: int) -> dict:
    """Parallel scan: ``num_partitions`` range queries on a numeric/date column."""
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(num_partitions)}


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict | None = None,
              partition: tuple[str, int, int, int] | None = None, fetch_size: int = 10_000) -> DataFrame:
    """A4: scan a table; filters and column pruning are pushed into the remote query.

    Without ``partition`` the whole table is read by one task, as in the
    reference; pass ``(column, lower, upper, n)`` to split it into ``n`` queries.
    ``fetch_size`` streams rows in batches (some drivers otherwise buffer the
    whole result in the executor's memory).
    """
    opts = jdbc_options(url, table, props)
    opts.setdefault("fetchsize", str(fetch_size))
    if partition:
        opts.update(partition_options(*partition))
    return spark.read.format("jdbc").options(**opts).load()


def jdbc_writer(df: DataFrame, url: str, table: str, props: dict | None = None, mode: str = "append",
                batch_size: int = 10_000):
    w = df.write.format("jdbc").options(**jdbc_options(url, table, props)).option("batchsize", str(batch_size))
    if mode == "replace":
        return w.mode("overwrite").option("truncate", "true")
    return w.mode(mode)


def append_jdbc(df: DataFrame, url: str, table: str, props: dict | None = None) -> None:
    """Append rows; each task writes its partition in batched inserts."""
    jdbc_writer(df, url, table, props, "append").save()


def replace_jdbc(df: DataFrame, url: str, table: str, props: dict | None = None) -> None:
    """Truncate-and-load keeping the table's definition (keys, grants)."""
    jdbc_writer(df, url, table, props, "replace").save()
