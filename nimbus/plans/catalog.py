"""Registered queries: each builds one operator (or job) of the pipeline over the test tables.

Every query reads the driver's tables through ``nimbus.sources.testdata`` and
returns a DataFrame; nothing is collected. Instants are returned as UTC wall
time (``timestamp_ntz``) and averages rounded to 6 places, so results compare
one to one with the DuckDB twins in ``nimbus.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.functions import display as D
from nimbus.functions.timecols import hours_before, instant_to_wall, local_wall
from nimbus.operators import audit, decode, diff, rollup, series, serving, staging
from nimbus.schemas import READING_COLUMNS
from nimbus.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time; hourly averages rounded to 6 places."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = instant_to_wall(c)
        elif f.name.startswith("avg_"):
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _staging(spark, d):
    """staging built from the replayed raw table."""
    return staging.stage(td.replayed_readings(spark, d))


def _table(spark, d, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived test table in the shared folder (partitioned by ``event_date`` like the real
    tables), for queries that reference it several times (scalar subqueries included): they
    then scan a table instead of recomputing its lineage. The queries only read it, so it is
    written once per session and scale (``_session_fixture``)."""
    path = _session_fixture(spark, d, name,
                            lambda p: build().write.mode("overwrite").partitionBy("event_date").parquet(p))
    return spark.read.parquet(path)


def _staging_table(spark, d):
    return _table(spark, d, "staging", lambda: _staging(spark, d))


def _staging_before_table(spark, d):
    return _table(spark, d, "staging_before", lambda: td.staging_before(spark, d))


def q_flatten_explode(spark, d):
    raw, _ = decode.messages_to_raw(td.messages(spark, d))
    return raw.select(*READING_COLUMNS, "weather_pos", "event_date")


def q_quarantine_rows(spark, d):
    _, bad = decode.messages_to_raw(td.messages(spark, d))
    return bad.select("city_id", "timestamp", "reason")


def q_quarantine_null_key(spark, d):
    _, bad = decode.messages_to_raw(td.broken_messages(spark, d))
    return bad.select("city_id", "timestamp", "reason")


def q_raw_pk_audit(spark, d):
    """J1 on the surrogate ids (B13) of messages with Kafka coordinates: no violation."""
    raw, _ = decode.messages_to_raw(td.messages(spark, d, replay=True))
    return audit.pk_violations(raw, ["id"])


def q_staging_raw_fk_audit(spark, d):
    """J2 staging.id -> raw.id: no violation."""
    raw = td.replayed_readings(spark, d)
    return audit.fk_violations(staging.stage(raw), "id", raw, "id").select("id")


def q_high_water(spark, d):
    return staging.high_water(td.staging_before(spark, d))


def q_increment_global(spark, d):
    return staging.increment(td.readings(spark, d), _staging_before_table(spark, d), mode=staging.GLOBAL)


def q_increment_anti(spark, d):
    return staging.increment(td.readings(spark, d), _staging_before_table(spark, d), mode=staging.ANTI)


def q_staging_dedupe(spark, d):
    return comparable(_staging(spark, d))


def _candidates(spark, d):
    return staging.city_candidates(staging.dedupe(td.replayed_readings(spark, d)))


def q_city_candidates(spark, d):
    return _candidates(spark, d)


def q_new_cities(spark, d):
    return staging.new_cities(_candidates(spark, d), td.known_cities(spark, d))


def q_insert_absent(spark, d):
    known = td.known_cities(spark, d)
    added = staging.insert_absent(staging.as_city_rows(_candidates(spark, d)), known)
    return known.unionByName(added)


def q_hourly_avg_staging(spark, d):
    return comparable(rollup.hourly_avg(_staging(spark, d)))


def q_hourly_avg_raw(spark, d):
    return comparable(rollup.hourly_avg(td.replayed_readings(spark, d)))


def q_last_24h(spark, d):
    s = _staging_table(spark, d)
    return comparable(serving.last_hours(s, 24, now=serving.newest(s)))


def q_city_series(spark, d):
    s = _staging_table(spark, d)
    name, country = td.NAMED_CITY
    return comparable(serving.city_series(s, td.cities(spark, d), name, country, 24, now=serving.newest(s)))


def q_latest_per_city(spark, d):
    return comparable(series.latest_per_city(_staging(spark, d)))


def q_detect_changes(spark, d):
    return series.detect_changes(td.replayed_readings(spark, d)).select("id", "city_id", "timestamp", "is_change")


def q_with_city(spark, d):
    return comparable(serving.with_city(_staging(spark, d), td.known_cities(spark, d)))


def q_top1_latest(spark, d):
    name, country = td.NAMED_CITY
    return comparable(serving.latest(serving.for_named_city(_staging(spark, d), td.cities(spark, d), name, country)))


def q_snapshot_diff(spark, d):
    s = _staging_table(spark, d)
    now = serving.newest(s)
    earlier = hours_before(now, 6)
    cur = serving.last_hours(s, 24, now=now)
    prev = serving.last_hours(s.filter(F.col("timestamp_utc") <= earlier), 24, now=earlier)
    return comparable(diff.snapshot_diff(prev, cur))


def q_wind_octant(spark, d):
    r = td.readings(spark, d)
    deg = ((F.col("id") * 37) % 721).cast("double") / F.lit(2.0)
    return r.select("id", deg.alias("wind_deg"), D.wind_octant(deg).alias("octant"))


def q_local_time(spark, d):
    return td.readings(spark, d).select("id", "city_id", local_wall("timestamp", "timezone").alias("local_time"))


def q_hour_midpoint_local(spark, d):
    s = _staging_table(spark, d)
    out = serving.hourly_overlay(rollup.hourly_avg(s), s)
    return comparable(out.select("city_id", "timestamp_hour", "city_timezone", "local_time"))


def q_daylight(spark, d):
    r = td.readings(spark, d)
    return r.select("id",
                    D.clock_text("sunrise", "timezone").alias("sunrise_text"),
                    D.clock_text("sunset", "timezone").alias("sunset_text"),
                    D.daylight_hours("sunrise", "sunset").alias("daylight_hours"),
                    D.daylight_minutes("sunrise", "sunset").alias("daylight_minutes"))


def q_conditions_card(spark, d):
    return serving.conditions_card(_staging(spark, d), td.cities(spark, d))


def q_weather_record(spark, d):
    return serving.latest_records(_staging(spark, d), td.cities(spark, d))


def q_pk_audit(spark, d):
    return audit.pk_violations(td.replayed_readings(spark, d), ["city_id", "timestamp"])


def q_fk_audit(spark, d):
    return comparable(audit.fk_violations(_staging(spark, d), "city_id", td.known_cities(spark, d), "id"))


def q_null_audit(spark, d):
    return audit.null_violations(td.readings(spark, d), ["city", "latitude", "longitude", "wind_gust"], ["id"])


def q_city_readings(spark, d):
    """The readings of one city, given by id."""
    return comparable(serving.for_city(_staging_table(spark, d), 7))


def q_row_counts(spark, d):
    """D-c: rows of each date's readings as counted by the write itself, beside a count of the result."""
    from nimbus.operators.metrics import counted, rows
    from nimbus.session import run_dir
    path = run_dir(spark, "counted")
    out, seen = counted(td.replayed_readings(spark, d), "readings")
    out.write.parquet(path)
    return spark.read.parquet(path).agg(F.lit(rows(seen)).cast("bigint").alias("observed"), F.count("*").alias("n_rows"))


def q_length_audit(spark, d):
    return audit.length_violations(td.cities_with_nation_names(spark, d), "country", 5, ["id"])


BATCH_QUERIES: dict[str, Query] = {
    "flatten_explode": q_flatten_explode,
    "quarantine_rows": q_quarantine_rows,
    "quarantine_null_key": q_quarantine_null_key,
    "raw_pk_audit": q_raw_pk_audit,
    "staging_raw_fk_audit": q_staging_raw_fk_audit,
    "high_water": q_high_water,
    "increment_global": q_increment_global,
    "increment_anti": q_increment_anti,
    "staging_dedupe": q_staging_dedupe,
    "city_candidates": q_city_candidates,
    "new_cities": q_new_cities,
    "insert_absent": q_insert_absent,
    "hourly_avg_staging": q_hourly_avg_staging,
    "hourly_avg_raw": q_hourly_avg_raw,
    "last_24h": q_last_24h,
    "city_series": q_city_series,
    "latest_per_city": q_latest_per_city,
    "detect_changes": q_detect_changes,
    "with_city": q_with_city,
    "top1_latest": q_top1_latest,
    "snapshot_diff": q_snapshot_diff,
    "wind_octant": q_wind_octant,
    "local_time": q_local_time,
    "hour_midpoint_local": q_hour_midpoint_local,
    "daylight": q_daylight,
    "conditions_card": q_conditions_card,
    "weather_record": q_weather_record,
    "pk_audit": q_pk_audit,
    "fk_audit": q_fk_audit,
    "null_audit": q_null_audit,
    "length_audit": q_length_audit,
    "city_readings": q_city_readings,
    "row_counts": q_row_counts,
}


def q_flagship(spark, d):
    """Bus messages -> decode -> flatten -> de-duplicate -> hourly averages."""
    raw, _ = decode.messages_to_raw(td.messages(spark, d, replay=True))
    return comparable(rollup.hourly_avg(staging.stage(raw)))


ALL_QUERIES: dict[str, Query] = dict(BATCH_QUERIES)


# --- streaming and connector queries --------------------------------------------------------
# Each run writes under a fresh folder of the shared checkpoint folder: the messages
# (the "topic"), the tables the streams write and their checkpoints.

_FIXTURES: dict[tuple, str] = {}
TOPIC_FILES, REPLAY_FILES, FILES_A_BATCH = 16, 4, 6        # of the test topic, a share: four micro-batches at any size
FILES_OF_RUN = ("part-????[02468]-*", "part-????[13579]-*")  # of a topic that is ingested in two runs: each file in one
SHARE = 1_600_000                                          # readings of a share: a file has up to 100,000 of the topic


def _shares(spark, d) -> int:
    """By how much the files of a topic are more than those of a small one, as a bus rolls them over by size."""
    return -(-td.table(spark, d, "events").count() // SHARE) or 1


def _session_fixture(spark, d, name, write) -> str:
    """A read-only input derived from the test tables, written once per session and scale.

    Queries only read it (each writes its outputs under its own fresh folder), so sharing it changes no result.
    ``prepare`` writes all of them, so that a query's time does not depend on which ran before.
    """
    from nimbus.session import run_dir
    key = (_session_id(spark), d, name)
    if key not in _FIXTURES:
        path = run_dir(spark, f"fixture-{name}")
        write(path)
        _FIXTURES[key] = path
    return _FIXTURES[key]


def _session_id(spark):
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        return id(spark)


def prepare(spark, d) -> None:
    """Write the shared inputs of the queries."""
    _publish_messages(spark, d)
    _publish_late(spark, d)
    _publish_ordered(spark, d)
    _publish_broken(spark, d)
    _staging_table(spark, d)
    _staging_before_table(spark, d)
    _raw_table(spark, d)


def _publish_messages(spark, d):
    """The bus: original messages first, then the redelivered copies in later files. Streams only read it."""
    from nimbus.sources.files import write_messages

    def publish(path):
        write_messages(td.messages(spark, d).repartitionByRange(TOPIC_FILES * _shares(spark, d), "offset"), path)
        write_messages(td.replays(spark, d).repartitionByRange(REPLAY_FILES * _shares(spark, d), "offset"), path)
    return _session_fixture(spark, d, "topic", publish)


def _publish_late(spark, d):
    """The bus of a station whose readings arrive newest first: every file after the first is late."""
    from nimbus.sources.files import write_messages

    def publish(path):
        r, files = td.readings(spark, d), FILES_A_BATCH * _shares(spark, d)
        for odd in (0, 1, 2):            # three deliveries, each older than the one before
            bounds = r.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
            third = bounds.select(((F.col("hi") - F.col("lo") + 1) / 3).alias("w")).scalar()
            back = (bounds.select("hi").scalar() - F.col("timestamp")) / third
            write_messages(td.as_messages(r.filter(F.floor(back) == odd)).repartition(files), path)
    return _session_fixture(spark, d, "late-topic", publish)


def _ingest(spark, d, topic=_publish_messages, root=None, files=""):
    """Raw from a topic, or from those of its ``files`` (a pattern) in addition to what ``root`` has from others."""
    from nimbus.session import run_dir
    from nimbus.sources.files import read_messages
    from nimbus.streaming.ingest import start_ingest
    from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end
    root, path = root or run_dir(spark, "stream"), topic(spark, d)
    src = read_messages(spark, f"{path}/{files}" if files else path, stream=True, max_files_per_trigger=FILES_A_BATCH * _shares(spark, d))
    checkpoint = f"{root}/_ck/ingest" + (f"-{FILES_OF_RUN.index(files)}" if files else "")
    run_to_end(start_ingest(src, f"{root}/raw", f"{root}/quarantine", checkpoint, AVAILABLE_NOW))
    return root


def _a_third_of_the_commits(spark, path) -> int:
    """Commits per trigger that make at least three micro-batches of a written table."""
    from nimbus.sinks.manifest import names
    return max(1, len(names(spark, f"{path}/_log")) // 3)


def _stage_stream(spark, root):
    from nimbus.streaming.staging import raw_stream, start_staging
    from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end
    src = raw_stream(spark, f"{root}/raw", _a_third_of_the_commits(spark, f"{root}/raw"))
    run_to_end(start_staging(src, f"{root}/staging", f"{root}/cities", f"{root}/quarantine", f"{root}/_ck/staging", AVAILABLE_NOW))


def q_stream_raw(spark, d):
    from nimbus.sources.tables import read_table
    root = _ingest(spark, d)
    return read_table(spark, f"{root}/raw", "raw").select(*READING_COLUMNS, "weather_pos", "event_date")


def q_stream_staging(spark, d):
    root = _ingest(spark, d)
    _stage_stream(spark, root)
    return _staged(spark, root)


def _staged(spark, root):
    from nimbus.sources.tables import read_table
    return comparable(read_table(spark, f"{root}/staging", "staging").drop("id"))


def _dates(spark, root, table):
    from nimbus.sources.tables import read_table
    from nimbus.streaming.triggers import dates_of
    return dates_of(read_table(spark, f"{root}/{table}", table))


def q_compact_raw(spark, d):
    """Raw compacted between two runs of the staging stream and after them: the same rows, read once each."""
    from nimbus.session import run_dir
    from nimbus.sinks.batch import compact
    from nimbus.sinks.manifest import Manifest
    from nimbus.sources.tables import read_table
    root = run_dir(spark, "stream")
    for files in FILES_OF_RUN:          # the second run of staging continues the first under its checkpoint
        _ingest(spark, d, root=root, files=files)
        _stage_stream(spark, root)
        compact(spark, f"{root}/raw", "raw", _dates(spark, root, "raw"))
    log = Manifest(spark, f"{root}/raw")
    log.expire(keep=0)
    log.vacuum(grace=0)
    return read_table(spark, f"{root}/raw", "raw").select(*READING_COLUMNS, "weather_pos", "event_date")


def q_compact_crash(spark, d):
    """A compaction of raw that dies before its record, another that ends, both before staging has read a row."""
    from nimbus.sinks.batch import COMPACTED, compact
    from nimbus.sources.tables import read_table
    root = _ingest(spark, d)
    (read_table(spark, f"{root}/raw", "raw").write.partitionBy("event_date")
     .parquet(f"{root}/raw/writer={COMPACTED}/batch_id=1"))                 # what the first one leaves
    compact(spark, f"{root}/raw", "raw", _dates(spark, root, "raw"))
    _stage_stream(spark, root)
    compact(spark, f"{root}/staging", "staging", _dates(spark, root, "staging"))
    return _staged(spark, root)


def _hourly_stream(spark, root):
    from nimbus.streaming.hourly import read_hourly, staging_stream, start_hourly
    from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end
    stg = f"{root}/staging"
    run_to_end(start_hourly(staging_stream(spark, stg, _a_third_of_the_commits(spark, stg)), f"{root}/hourly_state",
                            f"{root}/_ck/hourly", AVAILABLE_NOW))
    return comparable(read_hourly(spark, f"{root}/hourly_state").drop("event_date"))


def q_stream_hourly(spark, d):
    root = _ingest(spark, d)
    _stage_stream(spark, root)
    return _hourly_stream(spark, root)


def q_stream_hourly_late(spark, d):
    """Readings arrive newest first: all but the first micro-batch are late by up to the whole range."""
    root = _ingest(spark, d, _publish_late)
    _stage_stream(spark, root)
    return _hourly_stream(spark, root)


def q_stream_hourly_state(spark, d):
    """Late readings, with the state merged half way: parts of later commits add to the merged ones."""
    from nimbus.streaming.hourly import compact_hourly
    root = _ingest(spark, d, _publish_late)
    _stage_stream(spark, root)
    _hourly_stream(spark, root)
    compact_hourly(spark, f"{root}/hourly_state", _dates(spark, root, "hourly_state"))
    return _hourly_stream(spark, root)


def q_stream_latest(spark, d):
    """E1 kept up to date: readings that arrive newest first leave the newest of every city."""
    from nimbus.streaming.hourly import staging_stream
    from nimbus.streaming.latest import read_latest, start_latest
    from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end
    root = _ingest(spark, d, _publish_late)
    _stage_stream(spark, root)
    run_to_end(start_latest(staging_stream(spark, f"{root}/staging", 1), f"{root}/latest", f"{root}/_ck/latest", AVAILABLE_NOW))
    return comparable(read_latest(spark, f"{root}/latest").drop("id"))


def _publish_ordered(spark, d):
    """The bus in the order of time, in four deliveries; the last repeats the newest reading of every city."""
    from nimbus.sources.files import write_messages

    def publish(path):
        r, files = td.readings(spark, d), FILES_A_BATCH * _shares(spark, d)
        bounds = r.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
        third = bounds.select(((F.col("hi") - F.col("lo") + 1) / 3).alias("w")).scalar()
        on = F.floor((F.col("timestamp") - bounds.select("lo").scalar()) / third)
        for part in (0, 1, 2):
            write_messages(td.as_messages(r.filter(on == part)).repartition(files), path)
        newest = series.latest_per_city(r.filter(F.col("id") % 3 != 0))
        write_messages(td.as_messages(newest).repartition(files), path)
    return _session_fixture(spark, d, "ordered-topic", publish)


def q_stream_changes(spark, d):
    """E2 at insertion, over a restart: half of the deliveries, then the rest under the same checkpoint."""
    from nimbus.session import run_dir
    from nimbus.sources.files import read_messages
    from nimbus.sources.tables import read_table
    from nimbus.streaming.changes import start_changes
    from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end
    root, topic = run_dir(spark, "changes"), _publish_ordered(spark, d)
    for _ in range(2):          # the second start finds nothing new
        run_to_end(start_changes(read_messages(spark, topic, stream=True, max_files_per_trigger=FILES_A_BATCH * _shares(spark, d)),
                                 f"{root}/changes", f"{root}/_ck/changes", AVAILABLE_NOW))
    return read_table(spark, f"{root}/changes", "changes").select("city_id", "timestamp", "previous")


def _publish_broken(spark, d):
    from nimbus.sources.files import write_messages
    return _session_fixture(spark, d, "broken-topic", lambda path: write_messages(
        td.broken_messages(spark, d).repartitionByRange(FILES_A_BATCH * _shares(spark, d), "offset"), path))


def q_quarantine_replay(spark, d):
    """Messages without conditions get one and are replayed, twice: raw holds each once, under its first id.

    Those that lack their city or time as well stay set aside.
    """
    from nimbus.schemas import PAYLOAD
    from nimbus.sources.tables import read_table
    from nimbus.streaming.replay import replay
    root = _ingest(spark, d, _publish_broken)
    held = read_table(spark, f"{root}/quarantine", "quarantine").filter(F.col("reason") == decode.NO_WEATHER)
    clear = F.array(F.struct(F.lit(800).alias("id"), F.lit("Clear").alias("main"), F.lit("clear sky").alias("description"),
                             F.lit("01d").alias("icon")))
    fixed = held.select("msg_id", F.to_json(F.from_json("value", PAYLOAD).withField("weather", clear)).alias("value"))
    for _ in range(2):
        replay(fixed, f"{root}/raw", f"{root}/quarantine", f"{root}/replayed")
    return read_table(spark, f"{root}/raw", "raw").select("city_id", "timestamp", "weather_main", "temperature", "weather_pos")


def q_raw_line_ids(spark, d):
    """Every message stands twice in its file: twice the readings, and no id twice."""
    from nimbus.session import run_dir
    from nimbus.sources.files import read_messages, write_messages
    path = run_dir(spark, "twice")
    m = td.messages(spark, d).repartitionByRange(FILES_A_BATCH * _shares(spark, d), "offset")
    write_messages(m.select(F.explode(F.array("value", "value")).alias("value")), path)
    raw, _ = decode.messages_to_raw(read_messages(spark, path, stream=False))
    return raw.agg(F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"))


def q_stream_dedupe(spark, d):
    from nimbus.streaming.dedupe import start_dedupe
    from nimbus.streaming.staging import raw_stream
    from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end
    root = _ingest(spark, d)
    src = raw_stream(spark, f"{root}/raw", _a_third_of_the_commits(spark, f"{root}/raw"))
    run_to_end(start_dedupe(src, f"{root}/keys", f"{root}/_ck/dedupe", AVAILABLE_NOW))
    from nimbus.sources.tables import read_table
    return read_table(spark, f"{root}/keys", "raw").select("city_id", "timestamp")


def q_json_publish(spark, d):
    """Hourly rows published as JSON messages (file form of the bus) and read back."""
    from nimbus.session import run_dir
    from nimbus.sources.files import read_messages, write_messages
    from nimbus.sources.kafka import to_messages
    from nimbus.sources.tables import schema_of
    root = run_dir(spark, "publish")
    write_messages(to_messages(rollup.hourly_avg(_staging(spark, d)), key="city_id"), f"{root}/hourly")
    back = read_messages(spark, f"{root}/hourly", stream=False)
    parsed = back.select(F.from_json("value", schema_of("hourly")).alias("h")).select("h.*")
    return comparable(parsed.drop("event_date"))


STREAM_QUERIES: dict[str, Query] = {
    "stream_raw": q_stream_raw,
    "stream_staging": q_stream_staging,
    "stream_hourly": q_stream_hourly,
    "stream_hourly_late": q_stream_hourly_late,
    "stream_hourly_state": q_stream_hourly_state,
    "stream_latest": q_stream_latest,
    "stream_changes": q_stream_changes,
    "compact_raw": q_compact_raw,
    "compact_crash": q_compact_crash,
    "quarantine_replay": q_quarantine_replay,
    "raw_line_ids": q_raw_line_ids,
    "stream_dedupe": q_stream_dedupe,
    "json_publish": q_json_publish,
}

ALL_QUERIES.update(STREAM_QUERIES)


# --- composite jobs (L2-L5) over table folders ------------------------------------------------
# Each run provisions the tables as a deployment has them before the run - raw holding every
# (replayed) reading, staging as of the middle of the range with the late cities missing, the
# cities known so far - then runs the job functions of ``nimbus.plans.jobs`` (audited writes,
# table generations) and reads the resulting table back.

def _raw_table(spark, d) -> str:
    # raw is only read by the jobs: one copy per session serves every job key
    return _session_fixture(spark, d, "raw", lambda path: td.replayed_readings(spark, d)
                            .repartitionByRange("event_date", "city_id").write.partitionBy("event_date").parquet(path))


def _job_tables(spark, d):
    from nimbus.plans import jobs
    from nimbus.session import run_dir
    from nimbus.sinks.batch import write_batch
    paths = jobs.Paths(run_dir(spark, "tables"), locations={"raw": _raw_table(spark, d)})
    write_batch(_staging_before_table(spark, d), 0, paths.staging, writer="before")
    write_batch(td.known_cities(spark, d), 0, paths.cities, partition_by=(), writer="before")
    return paths


def _after_staging_job(spark, d):
    """Tables after L2 (late-safe increment)."""
    from nimbus.plans import jobs
    paths = _job_tables(spark, d)
    jobs.update_staging(spark, paths)
    return paths


def _after_hourly_job(spark, d):
    """Tables after L2 then L3 (the touched dates of hourly)."""
    from nimbus.plans import jobs
    paths = _after_staging_job(spark, d)
    jobs.rollup_hourly(spark, paths)
    return paths


def q_job_ingest_files(spark, d):
    """L1 as a batch job over the topic's message files: the raw table it writes."""
    from nimbus.plans import jobs
    from nimbus.session import run_dir
    from nimbus.sources.tables import read_table
    paths = jobs.Paths(run_dir(spark, "tables"))
    jobs.ingest_files(spark, _publish_messages(spark, d), paths)
    return read_table(spark, paths.raw, "raw").select(*READING_COLUMNS, "weather_pos", "event_date")


def q_increment_late(spark, d):
    """L2 stages readings of cities that report late, months before the newest staged one."""
    from nimbus.schemas import STAGING_COLUMNS
    from nimbus.sources.tables import read_table
    paths = _after_staging_job(spark, d)
    mark = staging.high_water(_staging_before_table(spark, d)).scalar()
    late = read_table(spark, paths.staging, "staging").filter(
        (F.col("city_id") % td.LATE_CITY_EVERY == 0) & (F.col("timestamp") < mark))
    return comparable(late.select(*STAGING_COLUMNS))


def q_job_update_staging(spark, d):
    from nimbus.schemas import STAGING_COLUMNS
    from nimbus.sources.tables import read_table
    paths = _after_staging_job(spark, d)
    return comparable(read_table(spark, paths.staging, "staging").select(*STAGING_COLUMNS))


def q_job_cities(spark, d):
    from nimbus.schemas import CITY_COLUMNS
    from nimbus.sources.tables import read_table
    paths = _after_staging_job(spark, d)
    return read_table(spark, paths.cities, "cities").select(*CITY_COLUMNS)


def q_job_rollup_hourly(spark, d):
    from nimbus.streaming.hourly import read_hourly
    paths = _after_hourly_job(spark, d)
    return comparable(read_hourly(spark, paths.hourly_state).drop("event_date"))


def q_job_refresh_hourly(spark, d):
    """Full refresh of the hourly table, published as an audited generation."""
    from nimbus.plans import jobs
    from nimbus.sources.tables import read_current
    paths = _after_staging_job(spark, d)
    jobs.refresh_hourly(spark, paths, f"{paths.root}/hourly_full")
    return comparable(read_current(spark, f"{paths.root}/hourly_full", "hourly"))


def _card(spark, d, seconds_later):
    """L4 as of some time after the configured city's newest reading."""
    from nimbus.plans import jobs
    from nimbus.sources.tables import read_table
    paths = _after_staging_job(spark, d)
    name, country = td.NAMED_CITY
    own = serving.for_named_city(read_table(spark, paths.staging, "staging"), td.cities(spark, d), name, country)
    newest = own.agg((F.max(F.unix_seconds("timestamp_utc")) + seconds_later).alias("s")).scalar()
    jobs.update_latest(spark, paths)
    return jobs.current_card(spark, paths, name, country, 24, now=F.timestamp_seconds(newest))


def q_job_current_card(spark, d):
    return _card(spark, d, 3600)


def q_job_current_card_stale(spark, d):
    """A city silent for 25 hours: no card."""
    return _card(spark, d, 90000)


def _day_view(spark, d):
    from nimbus.plans import jobs
    from nimbus.sources.tables import read_table
    paths = _after_hourly_job(spark, d)
    name, country = td.NAMED_CITY
    now = serving.newest(read_table(spark, paths.staging, "staging"))
    return jobs.day_view(spark, paths, name, country, 24, now=now)


def q_job_day_series(spark, d):
    return comparable(_day_view(spark, d)[0])


def q_job_day_overlay(spark, d):
    return comparable(_day_view(spark, d)[1])


JOB_QUERIES: dict[str, Query] = {
    "job_ingest_files": q_job_ingest_files,
    "job_update_staging": q_job_update_staging,
    "job_cities": q_job_cities,
    "increment_late": q_increment_late,
    "job_rollup_hourly": q_job_rollup_hourly,
    "job_refresh_hourly": q_job_refresh_hourly,
    "job_current_card": q_job_current_card,
    "job_current_card_stale": q_job_current_card_stale,
    "job_day_series": q_job_day_series,
    "job_day_overlay": q_job_day_overlay,
}

ALL_QUERIES.update(JOB_QUERIES)
