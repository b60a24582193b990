"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.session import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write ``df`` once below ``root`` (in the shared folder) and go on from the written table.

    Ends the lineage without a local copy: a lost executor costs no recomputation of what came before.
    """
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_folder(spark: SparkSession, name: str) -> str:
    return run_dir(spark, name)


def parts(batches, column: int, most: int = 1 << 20):
    """Arrow batches in runs of rows with about ``most`` bytes in the string ``column``; a longer text stands alone.

    Bounds what a task holds as Python strings by bytes, whatever number of rows a batch has.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def held_out(doc_id: str, mod: int, rest: int):
    """Whether a row belongs to the fold ``crc32(doc_id as text) mod m = rest`` (a null id never does)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == rest, F.lit(False))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would (once a session)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[2]
    to = Path(tempfile.mkdtemp(prefix="nimbus-py-")) / "nimbus_package.zip"      # on the driver; Spark serves it
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted((top / "nimbus").rglob("*.py")):
            z.write(f, f.relative_to(top))
    sc.addPyFile(str(to))
    _shipped.add(sc.applicationId)
