"""User-level jobs (L1-L5): read tables, run the operators, write tables.

L1-L3 are the streaming queries run to the end of what is there (``availableNow``): the checkpoint is the ledger of
processed files, so a run is proportional to new data, a second run over the same input adds nothing, and batch
and stream forms are one code with one rule for bad rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.operators import audit
from nimbus.operators.diff import has_changed
from nimbus.operators.rollup import hourly_avg
from nimbus.operators.serving import city_series, conditions_card, find_city, hourly_overlay, last_hours
from nimbus.schemas import MAX_LENGTH, NOT_NULL, PRIMARY_KEYS
from nimbus.sinks.batch import compact
from nimbus.sinks.manifest import GRACE_SECONDS, Manifest
from nimbus.sinks.tables import replace_table
from nimbus.sources.files import read_messages
from nimbus.sources.tables import read_table, register
from nimbus.streaming.hourly import compact_hourly, read_hourly, staging_stream, start_hourly
from nimbus.streaming.ingest import start_ingest
from nimbus.streaming.latest import read_latest, start_latest
from nimbus.streaming.replay import replay
from nimbus.streaming.staging import raw_stream, start_staging
from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end

TABLES = ("raw", "staging", "cities", "hourly_state", "quarantine", "latest", "changes", "replayed")


@dataclass
class Paths:
    """Locations of the four tables (the hourly one as the state it is read from) and of the quarantine under one root.

    ``locations`` places single tables elsewhere, e.g. raw in the landing zone the ingest writes to while the
    derived tables live under ``root``. With a ``database`` the jobs keep its catalog tables up to date.
    """
    root: str
    locations: dict[str, str] = field(default_factory=dict)
    database: str | None = None

    def __getattr__(self, name: str) -> str:
        if name in TABLES:
            return self.locations.get(name) or f"{self.root.rstrip('/')}/{name}"
        raise AttributeError(name)

    def checkpoint(self, job: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{job}"


def ingest_files(spark: SparkSession, messages_path: str, paths: Paths) -> int:
    """L1: the message files not yet ingested become raw rows and quarantine rows; returns the micro-batches run."""
    q = start_ingest(read_messages(spark, messages_path, stream=True), paths.raw, paths.quarantine,
                     paths.checkpoint("ingest"), AVAILABLE_NOW)
    run_to_end(q)
    register(spark, paths.database, paths.root, "raw")
    return _batches(q)


def update_staging(spark: SparkSession, paths: Paths) -> int:
    """L2: raw files not yet staged -> quarantine, new cities, then de-duplicated staging rows."""
    q = start_staging(raw_stream(spark, paths.raw), paths.staging, paths.cities, paths.quarantine,
                      paths.checkpoint("staging"), AVAILABLE_NOW)
    run_to_end(q)
    register(spark, paths.database, paths.root, "cities", "staging")
    return _batches(q)


def rollup_hourly(spark: SparkSession, paths: Paths) -> int:
    """L3: the parts of new staging rows are added to the hourly state."""
    q = start_hourly(staging_stream(spark, paths.staging), paths.hourly_state, paths.checkpoint("hourly"), AVAILABLE_NOW)
    run_to_end(q)
    register(spark, paths.database, paths.root, "hourly_state")
    return _batches(q)


def update_latest(spark: SparkSession, paths: Paths) -> int:
    """New staging rows are merged into the table of latest readings."""
    q = start_latest(staging_stream(spark, paths.staging), paths.latest, paths.checkpoint("latest"), AVAILABLE_NOW)
    run_to_end(q)
    return _batches(q)


def replay_quarantine(spark: SparkSession, paths: Paths, corrections: DataFrame) -> DataFrame:
    """Corrected messages (``msg_id``, ``value``) enter raw once; returns those that are still bad."""
    still = replay(corrections, paths.raw, paths.quarantine, paths.replayed)
    register(spark, paths.database, paths.root, "raw")
    return still


def maintain(spark: SparkSession, paths: Paths, closed: list, grace: float = GRACE_SECONDS) -> dict[str, int]:
    """Keep the tables short: folders of ``closed`` dates into one each, old records folded, replaced files deleted.

    Safe at any time and beside every other job; returns the folders that were folded.
    """
    folded = {name: compact(spark, getattr(paths, name), name, closed) for name in ("raw", "staging")
              if Manifest(spark, getattr(paths, name)).there()}
    if Manifest(spark, paths.hourly_state).there():
        folded["hourly_state"] = compact_hourly(spark, paths.hourly_state, closed)
    for name in TABLES:
        log = Manifest(spark, getattr(paths, name))
        if log.there():
            log.vacuum(grace)
            log.expire()
    return folded


def _batches(query) -> int:
    last = query.lastProgress
    return 0 if last is None else sum(1 for p in query.recentProgress if p["numInputRows"] > 0)


def refresh_hourly(spark: SparkSession, paths: Paths, target: str, source: str = "staging", name: str | None = None) -> str:
    """The whole hourly table anew as an audited generation of ``target`` (and of the catalog table ``name``)."""
    out = hourly_avg(read_table(spark, getattr(paths, source), source))
    cities = read_table(spark, paths.cities, "cities")
    return replace_table(out, target, audits={"hourly_pk": audit.pk_violations(out, PRIMARY_KEYS["hourly"]),
                                              "hourly_city_fk": audit.fk_violations(out, "city_id", cities, "id")}, name=name)


def constraint_audits(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """J1-J4 over the stored tables: every key, reference, not-null and length rule of the schemas."""
    t = {name: read_table(spark, getattr(paths, name), name) for name in ("raw", "staging", "cities")}
    t["hourly"] = read_hourly(spark, paths.hourly_state)
    out = {f"{name}_pk": audit.pk_violations(t[name.split("_")[0]], keys) for name, keys in PRIMARY_KEYS.items()}
    out |= {f"{name}_not_null": audit.null_violations(t[name], cols, ["id"]) for name, cols in NOT_NULL.items()}
    out |= {f"{name}_{col}_length": audit.length_violations(t[name], col, most, ["id"])
            for name, cols in MAX_LENGTH.items() for col, most in cols.items()}
    out["staging_raw_fk"] = audit.fk_violations(t["staging"], "id", t["raw"], "id")
    out["staging_city_fk"] = audit.fk_violations(t["staging"], "city_id", t["cities"], "id")
    out["hourly_city_fk"] = audit.fk_violations(t["hourly"], "city_id", t["cities"], "id")
    return out


def _of_city(df: DataFrame, cities: DataFrame, name: str, country: str) -> DataFrame:
    city = find_city(cities, name, country).select(F.col("id").alias("city_id"))
    return df.join(F.broadcast(city), "city_id", "left_semi")            # at most one row


def current_card(spark: SparkSession, paths: Paths, name: str, country: str, hours: int = 24,
                 now: Column | None = None) -> DataFrame:
    """L4: the conditions card of the configured city if it has a reading of the last ``hours`` (one row, or none).

    The city is looked up first (at most one row comes to the driver); then its bucket of the table of latest
    readings is all that is opened.
    """
    cities = read_table(spark, paths.cities, "cities")
    city = find_city(cities, name, country).first()
    latest = read_latest(spark, paths.latest, -1 if city is None else city.id)
    if city is None:
        latest = latest.limit(0)
    return conditions_card(last_hours(latest, hours, now), cities)


def day_view(spark: SparkSession, paths: Paths, name: str, country: str, hours: int = 24,
             now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The city's last 24 h of readings and of hourly averages (with local times).

    Both tables are opened for the dates of the window only; the offset is that of the city's newest reading in it
    (an hour of the window has a reading in the window).
    """
    staged = read_table(spark, paths.staging, "staging")
    cities = read_table(spark, paths.cities, "cities")
    series = city_series(staged, cities, name, country, hours, now)
    hourly = last_hours(read_hourly(spark, paths.hourly_state), hours, now, ts="timestamp_hour")
    hourly = _of_city(hourly, cities, name, country).drop("event_date")
    overlay = hourly_overlay(hourly, _of_city(last_hours(staged, hours, now), cities, name, country))
    return series, overlay.orderBy(F.col("timestamp_hour").desc())


def refreshed(previous: DataFrame | None, current: DataFrame) -> DataFrame | None:
    """The new result if it differs from the one on display, else None (nothing to draw)."""
    return current if previous is None or has_changed(previous, current) else None
