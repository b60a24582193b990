"""Micro-batch sinks (A7, A10, I3): tables of batch folders whose commit log says which are live."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.sinks.manifest import COMPACT, Conflict, Manifest, State, combined, exists, remove  # noqa: F401

# Partition columns added by batch-folder tables.
BATCH_COLUMNS = ("writer", "batch_id")
COMPACTED = "compacted"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def writer_tag(checkpoint: str) -> str:
    """Stable name of one streaming query: derived from its checkpoint location."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def committed(spark: SparkSession, root: str, writer: str, batch_id: int) -> bool:
    return Manifest(spark, root).state().writers.get(writer, -1) >= batch_id


def _digest(rows: DataFrame, by: str | None) -> list:
    """(part, rows, exclusive or, sum of the row hashes): equal for the same rows in any order and any files."""
    part = F.col(by).cast("string") if by else F.lit(None).cast("string")
    h = F.xxhash64(*sorted(rows.columns))
    return rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
                                                F.sum(h.cast("decimal(38,0)")).alias("s")).collect()     # a row a day (or bucket)


def _write(df: DataFrame, root: str, folder: str, partition_by: tuple[str, ...],
           check: Callable[[DataFrame], None] | None) -> list[tuple]:
    """Write rows to a folder of the table that no record names yet; its entries for the record."""
    path, by = f"{root.rstrip('/')}/{folder}", partition_by[0] if partition_by else None
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(by) if by else w).parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    if check:
        check(rows)
    return [(f"{folder}/{by}={NO_DATE if r.part is None else r.part}" if by else folder, r.part, r.n, r.x, int(r.s))
            for r in _digest(rows, by)]


def write_batch(df: DataFrame, batch_id: int, root: str, partition_by: tuple[str, ...] = ("event_date",),
                writer: str = "batch", check: Callable[[DataFrame], None] | None = None) -> int | None:
    """Add a micro-batch to a table, exactly once; returns its version, None if it was there already.

    The rows go to ``root/writer=W/batch_id=N[/event_date=D]`` and become visible with one record of the commit log. A
    batch that is run again after a failure (same query, same id, same offsets) overwrites the folder if its record
    is missing and is passed over if it is there; ids of one writer only grow. ``writer`` keeps two queries
    (two checkpoints) apart. ``check`` sees the written rows before they are visible and stops the
    publication by raising.
    """
    spark = df.sparkSession
    if committed(spark, root, writer, batch_id):
        return None
    entries = _write(df, root, f"writer={writer}/batch_id={int(batch_id)}", partition_by, check)
    return Manifest(spark, root).commit(entries, writer=writer, batch_id=int(batch_id))


def append_new(spark: SparkSession, root: str, build: Callable[[State], DataFrame], batch_id: int | None, writer: str,
               partition_by: tuple[str, ...] = ("event_date",), check: Callable[[DataFrame], None] | None = None) -> int | None:
    """Add rows that depend on what the table holds, although others write to it too.

    ``build`` makes the rows (an anti join, say) from one version of the table, and they are committed only as the
    next version: if another commit came first, they are made again from what it left. So two writers that
    insert the same new key leave one row. The rows of a lost try are overwritten by the next. Without a
    ``batch_id`` the call is one of its own: running it again is up to ``build``.
    """
    table = Manifest(spark, root)
    folder = f"writer={writer}/batch_id={uuid.uuid4().int >> 65 if batch_id is None else int(batch_id)}"
    while True:
        now = table.state()
        if batch_id is not None and now.writers.get(writer, -1) >= batch_id:
            return None
        entries = _write(build(now), root, folder, partition_by, check)
        try:
            return table.commit(entries, writer=writer, batch_id=-1 if batch_id is None else int(batch_id), expected=now.version)
        except Conflict:
            continue


def compact(spark: SparkSession, root: str, table: str, parts: list, fold: Callable[[DataFrame], DataFrame] | None = None,
            by: str = "event_date") -> int:
    """Fold the live folders of some dates (or other ``parts``) into one each; returns how many they were.

    One record removes the old folders and adds the new one, so a reader sees the one or the other, and a crash
    before it changes nothing. The new folder must hold the same rows by their digest, unless ``fold`` merges rows
    (a table of partial sums). The old files stay for those who read them until ``Manifest.vacuum``.
    """
    from nimbus.sources.tables import read_folders
    log = Manifest(spark, root)
    now = log.state()
    old = now.folders(parts)
    if len(old) <= len({now.live[f][0] for f in old}):
        return 0                            # one folder each already
    rows = read_folders(spark, root, table, old)
    order = [c for c in (by, "city_id", "timestamp") if c in rows.columns]
    rows = fold(rows) if fold else rows
    # a name of its own for every try: nothing of a crashed or lost one is ever read
    entries = _write(rows.repartitionByRange(*order).sortWithinPartitions(*order), root,
                     f"writer={COMPACTED}/batch_id={uuid.uuid4().int >> 65}", (by,), None)
    if fold is None:
        new: dict = {}
        for _, part, *digest in entries:
            new[part] = combined(new.get(part, (0, 0, 0)), tuple(digest))
        if new != now.digests(old):
            raise RuntimeError(f"{root}: the compacted rows are not those of the folders they replace")
    log.commit(entries, removed=old, writer=COMPACTED, kind=COMPACT)
    return len(old)


def verify(spark: SparkSession, root: str, table: str, parts: list | None = None, by: str | None = "event_date") -> list:
    """Parts whose stored rows are not the rows that were committed (lost, altered or added files); reads those only."""
    from nimbus.sources.tables import read_folders
    now = Manifest(spark, root).state()
    folders = now.folders(parts)
    found = {r.part: (r.n, r.x, int(r.s)) for r in _digest(read_folders(spark, root, table, folders), by)}
    want = now.digests(folders)
    return sorted(d or "" for d in {*found, *want} if found.get(d) != want.get(d))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """A10: the first ``n`` rows of a batch for a log (bounded; off unless asked for)."""
    return df.limit(n)
