"""Constraint audits (J1-J4): the checks the reference's database enforced.

Each returns the violating rows; an empty result means the constraint holds.
``require_clean`` turns them into a publishing guard.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ConstraintViolation(RuntimeError):
    pass


DUPLICATE = "duplicate"
NULL_KEY = "null_key"


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, and keys with a null part.

    One hash aggregate with a partial step, so a key repeated a billion times
    is counted map-side. Output: the key columns, ``n_rows``, ``violation``.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return (counted.filter((F.col("n_rows") > 1) | any_null)
            .withColumn("violation", F.when(any_null, F.lit(NULL_KEY)).otherwise(F.lit(DUPLICATE))))


def fk_violations(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null ``key`` is absent from ``parent.parent_key`` (left anti join)."""
    ref = parent.select(F.col(parent_key).alias(key))
    return df.filter(F.col(key).isNotNull()).join(ref, key, "left_anti")


def null_violations(df: DataFrame, cols: list[str], id_cols: list[str]) -> DataFrame:
    """(row id, column) for every null in a NOT NULL column; one scan for all columns."""
    names = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return (df.select(*id_cols, F.explode(F.filter(names, lambda x: x.isNotNull())).alias("column")))


def length_violations(df: DataFrame, col: str, max_len: int, id_cols: list[str]) -> DataFrame:
    """Rows whose text in ``col`` is longer than ``max_len`` characters (VARCHAR(n))."""
    return (df.filter(F.length(col) > max_len)
            .select(*id_cols, F.col(col), F.length(col).alias("length")))


def require_clean(**violations: DataFrame) -> None:
    """Raise if any audit found a violating row; each check stops at its first row."""
    bad = [name for name, v in violations.items() if not v.isEmpty()]
    if bad:
        raise ConstraintViolation("constraint violations: " + ", ".join(bad))
