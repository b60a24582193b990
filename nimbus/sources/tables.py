"""Parquet tables of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.schemas import HOURLY_COLUMNS, HOURLY_MEASURES, PAYLOAD, RAW_COLUMNS, READING_FIELDS, STAGING_COLUMNS
from nimbus.sinks.batch import BATCH_COLUMNS
from nimbus.sinks.manifest import Manifest, TableStream, exists, record_stream

# Column types of the four tables. Readings take theirs from the payload; the partition columns of
# batch-folder tables (``writer``, ``batch_id``) name the micro-batch that wrote a row.
def _payload_type(path: str) -> str:
    t = T.StructType(list(PAYLOAD.fields) + [T.StructField("w", PAYLOAD["weather"].dataType.elementType)])
    for part in path.split("."):
        t = t[part].dataType
    return t.simpleString()


_READING = {name: _payload_type(path) for name, path in READING_FIELDS}
_TYPES = _READING | {"weather_pos": "int", "event_date": "date", "timestamp_utc": "timestamp"}
_COLUMNS = {
    "raw": {"id": "bigint"} | {c: _TYPES[c] for c in RAW_COLUMNS if c != "id"},
    "staging": {"id": "bigint"} | {c: _TYPES[c] for c in STAGING_COLUMNS if c != "id"},
    "cities": {"id": "int", "name": "string", "country": "string", "latitude": "double", "longitude": "double"},
    "hourly": {"city_id": "int", "timestamp_hour": "timestamp"} | {c: "double" for c in HOURLY_COLUMNS[2:]} | {"event_date": "date"},
    "hourly_state": ({"city_id": "int", "hour": "bigint"} | {f"{part}_{m}": t for m in HOURLY_MEASURES.values()
                                                              for part, t in (("sum", "double"), ("n", "bigint"))} | {"event_date": "date"}),
    "quarantine": {"city_id": "int", "timestamp": "bigint", "reason": "string", "value": "string", "msg_id": "bigint"},
    "replayed": {"msg_id": "bigint"},
    "latest": {"id": "bigint"} | {c: _TYPES[c] for c in STAGING_COLUMNS if c != "id"} | {"bucket": "int"},
    "changes": {"id": "bigint", "city_id": "int", "timestamp": "bigint", "previous": "bigint", "event_date": "date"},
    "seen": {"city_id": "int", "last": "bigint", "seq": "bigint", "bucket": "int"},
}
_BATCHED = ("raw", "staging", "cities", "quarantine", "hourly_state", "replayed", "latest", "changes", "seen")
CATALOG_TABLES = ("raw", "staging", "cities", "hourly_state")


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in _COLUMNS[table].items()))


def batch_table_schema(table: str) -> T.StructType:
    """Schema of a batch-folder table, with its ``writer`` and ``batch_id`` folder columns."""
    return schema_of(table).add("writer", "string").add("batch_id", "long")


def partitions_of(table: str) -> list[str]:
    return (list(BATCH_COLUMNS) if table in _BATCHED else []) + [c for c in ("event_date",) if c in _COLUMNS[table]]


def provision(spark: SparkSession, database: str, location: str) -> list[str]:
    """Create the database, its tables partitioned as the jobs write them, and the hourly averages as a view."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    made = []
    for name in CATALOG_TABLES:
        schema = batch_table_schema(name) if name in _BATCHED else schema_of(name)
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet "
                  f"PARTITIONED BY ({', '.join(partitions_of(name))}) LOCATION '{location}/{name}'")
        made.append(f"{database}.{name}")
    averages = ", ".join(f"try_divide(sum(sum_{m}), sum(n_{m})) AS {avg}" for avg, m in HOURLY_MEASURES.items())
    spark.sql(f"CREATE VIEW IF NOT EXISTS {database}.hourly AS SELECT city_id, timestamp_seconds(hour) AS timestamp_hour, "
              f"{averages}, event_date FROM {database}.hourly_state GROUP BY city_id, hour, event_date")
    return [*made, f"{database}.hourly"]


def register(spark: SparkSession, database: str | None, path: str, *tables: str) -> None:
    """Bring the catalog tables up to the commit logs below ``path`` (nothing without a database).

    Only what was committed since the last call is told to the catalog, which is a consumer of the log; no folder of
    the table is listed. A compaction drops the partitions it replaced and adds its own.
    """
    for name in tables if database else ():
        full = f"{database}.{name}"
        if name not in CATALOG_TABLES or not spark.catalog.tableExists(full):
            continue
        log, me = Manifest(spark, f"{path.rstrip('/')}/{name}"), f"catalog-{database}"
        if not log.there():
            continue
        log.register(me)
        for r in log.records(log.position(me)):
            for verb, folders in (("ADD IF NOT EXISTS", [f for f, *_ in r["add"]]), ("DROP IF EXISTS", r["remove"])):
                for at in range(0, len(folders), 100):
                    specs = [", ".join(f"{k}='{v}'" for k, v in (part.split("=", 1) for part in f.split("/")))
                             for f in folders[at:at + 100]]
                    glue = ", " if verb.startswith("DROP") else " "
                    spark.sql(f"ALTER TABLE {full} {verb} " + glue.join(f"PARTITION ({x})" for x in specs))
            log.advance(me, [r["version"]])
        spark.catalog.refreshTable(full)


def read_folders(spark: SparkSession, path: str, table: str, folders: list[str]) -> DataFrame:
    """Some folders of a batch table, without its batch columns."""
    if not folders:
        return spark.createDataFrame([], schema_of(table))
    root = path.rstrip("/")
    return (spark.read.schema(batch_table_schema(table)).option("basePath", root)
            .parquet(*(f"{root}/{f}" for f in folders)).drop(*BATCH_COLUMNS))


def read_table(spark: SparkSession, path: str, table: str | None = None, dates: list | None = None) -> DataFrame:
    """A parquet table by path, without its batch-folder columns; an absent folder reads as an empty table.

    A table with a commit log is read through it: its live folders, with ``dates`` those of some dates only, and
    nothing is listed besides. Other parquet folders are read as they are. A known table is read with its
    schema, so no file is opened to infer one.
    """
    log = Manifest(spark, path)
    if table and log.there():
        return read_folders(spark, path, table, log.state().folders(dates))
    if table and not exists(spark, path):
        return spark.createDataFrame([], schema_of(table))
    reader = spark.read.schema(batch_table_schema(table)) if table else spark.read
    rows = reader.parquet(path).drop(*BATCH_COLUMNS)
    return rows if dates is None else rows.filter(F.col("event_date").isin(dates))


def stream_table(spark: SparkSession, path: str, table: str, max_files_per_trigger: int) -> TableStream:
    """New rows of a table: the commits of its log, or the files of a folder that has none (a listed file that is gone
    fails the batch). ``max_files_per_trigger`` bounds commits or files of a micro-batch."""
    log = Manifest(spark, path)
    if not exists(spark, path):
        log.create()                        # the table's first commit is yet to come
    if log.there():
        return TableStream(record_stream(spark, log, max_files_per_trigger), log,
                           lambda folders: read_folders(spark, path, table, folders))
    return TableStream(spark.readStream.schema(batch_table_schema(table)).option("maxFilesPerTrigger", str(max_files_per_trigger))
                       .parquet(path).drop(*BATCH_COLUMNS))


def current_generation(spark: SparkSession, path: str) -> str | None:
    """Folder of the current generation of a replace-style table (None if never written)."""
    live = Manifest(spark, path).state().folders()
    return f"{path.rstrip('/')}/{live[0]}" if live else None


def read_current(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """The current content of a replace-style table (empty with the known schema if never written)."""
    gen = current_generation(spark, path)
    if gen is None:
        if table is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema_of(table))
    return spark.read.parquet(gen)


def read_table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """A5: a catalog table, or None when it does not exist or has no row.

    ``isEmpty`` stops at the first row, so the test does not scan the table.
    """
    if not spark.catalog.tableExists(name):
        return None
    df = spark.table(name).drop(*BATCH_COLUMNS)
    return None if df.isEmpty() else df
