"""New raw rows start the staging update - a second streaming query over the raw table.

Replaces the reference's database trigger -> socket -> scheduler chain: the raw table's new commits are the
stream (its checkpoint is the ledger of what was processed), and each micro-batch runs the batch staging
operators against what is already staged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from nimbus.operators.audit import fk_violations, length_violations, null_violations, pk_violations, require_clean
from nimbus.operators.staging import ANTI, KEY, as_city_rows, city_candidates, increment, insert_absent, set_aside, to_staging, violation
from nimbus.schemas import CITY_COLUMNS, MAX_LENGTH, NOT_NULL, PRIMARY_KEYS
from nimbus.session import run_dir
from nimbus.sinks.batch import append_new, committed, remove, write_batch, writer_tag
from nimbus.sinks.manifest import Manifest, State, TableStream
from nimbus.sinks.tables import clustered_by_date
from nimbus.sources.tables import read_folders, read_table, stream_table
from nimbus.streaming.triggers import MAX_FILES, dates_of


def raw_stream(spark: SparkSession, raw_path: str, max_files_per_trigger: int = MAX_FILES) -> TableStream:
    """New rows of the raw table as a stream (schema fixed)."""
    return stream_table(spark, raw_path, "raw", max_files_per_trigger)


def audit_cities(rows: DataFrame) -> None:
    """J1, J3, J4 on the cities of one increment, before they are visible."""
    require_clean(cities_pk=pk_violations(rows, PRIMARY_KEYS["cities"]),
                  cities_not_null=null_violations(rows, NOT_NULL["cities"], ["id"]),
                  **{f"cities_{c}_length": length_violations(rows, c, most, ["id"]) for c, most in MAX_LENGTH["cities"].items()})


def audit_staging(rows: DataFrame, source: DataFrame, cities: DataFrame, staged: DataFrame) -> None:
    """J1 and J2 on the written rows of one increment, before they are visible.

    ``source`` is what the increment was made of, ``cities`` the dimension, ``staged`` the rows already visible of the
    same dates. An id is the hash of where its message was read, so rows of one id are of one date: a key that is
    already staged is found there, and no other date is opened.
    """
    old = staged.select("id", *KEY)
    require_clean(
        staging_pk=pk_violations(rows, PRIMARY_KEYS["staging"]),
        staging_reading_pk=pk_violations(rows, PRIMARY_KEYS["staging_reading"]),
        staging_pk_again=rows.select("id").join(old, "id", "left_semi"),
        staging_reading_pk_again=rows.select(*KEY).join(old, KEY, "left_semi"),
        staging_raw_fk=fk_violations(rows, "id", source, "id"),
        staging_city_fk=fk_violations(rows, "city_id", cities, "id"))


def staging_batch(batch: DataFrame, batch_id: int, staging_path: str, cities_path: str, quarantine_path: str,
                  writer: str) -> None:
    """Violating readings to the quarantine, new cities to the dimension, then the increment to staging.

    Cities and readings are added only if absent, whoever else writes to the tables (``append_new``), and only after
    the audits of what was written: cost is that of the increment and of the staging rows of its dates.
    """
    spark = batch.sparkSession
    if committed(spark, staging_path, writer, batch_id):
        return
    work = run_dir(spark, "increment")
    # the micro-batch is read once; the rest is made from its cut
    batch.withColumn("violation", violation()).write.parquet(f"{work}/batch")
    try:
        cut = (spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("violation", T.StringType())]))
               .parquet(f"{work}/batch"))
        good = cut.filter("violation IS NULL").drop("violation")
        write_batch(set_aside(cut.filter("violation IS NOT NULL").drop("violation")), batch_id, quarantine_path,
                    partition_by=(), writer=writer)
        dates = dates_of(good)
        if not dates:
            return
        made: dict[int, DataFrame] = {}

        def staged(now: State) -> DataFrame:
            return read_folders(spark, staging_path, "staging", now.folders(dates))

        def new_rows(now: State) -> DataFrame:
            """The increment against one version of staging, made once for cities and readings."""
            if now.version not in made:
                made.clear()
                path = f"{work}/version-{now.version}"
                increment(good, staged(now), mode=ANTI, dedupe_first=True, dates=dates).write.parquet(path)
                made[now.version] = spark.read.schema(batch.schema).parquet(path)
                at.append(now)
            return made[now.version]

        at: list[State] = []
        candidates = as_city_rows(city_candidates(new_rows(Manifest(spark, staging_path).state())))
        append_new(spark, cities_path, lambda now: insert_absent(
            candidates, read_folders(spark, cities_path, "cities", now.folders())).select(*CITY_COLUMNS),
            batch_id, writer, partition_by=(), check=audit_cities)
        append_new(spark, staging_path, lambda now: clustered_by_date(to_staging(new_rows(now))), batch_id, writer,
                   check=lambda rows: audit_staging(rows, good, read_table(spark, cities_path, "cities"), staged(at[-1])))
    finally:
        remove(spark, work)


def start_staging(raw: TableStream, staging_path: str, cities_path: str, quarantine_path: str, checkpoint: str,
                  trigger: dict | None = None):
    tag = writer_tag(checkpoint)
    return raw.start_each(lambda df, bid: staging_batch(df, bid, staging_path, cities_path, quarantine_path, tag),
                          checkpoint, tag, trigger)
