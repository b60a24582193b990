"""Message decoding: JSON text -> payload struct -> flat reading rows.

All narrow transformations: they run inside the scan's stage, with no shuffle,
so their cost grows linearly with the messages and spreads over every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.functions.timecols import event_date
from nimbus.schemas import CORRUPT_COLUMN, PAYLOAD, READING_FIELDS, RAW_COLUMNS
from nimbus.sources.files import SPLIT, line_number, split_shifts

MSG = "_msg"

# Quarantine reasons.
MALFORMED = "malformed"
NO_WEATHER = "no_weather"
NULL_KEY = "null_key"


def message_text(df: DataFrame) -> DataFrame:
    """A2/H4: message body as text. Kafka gives ``value`` as binary, file sources as string."""
    return df.withColumn("value", F.col("value").cast("string"))


def decode(messages: DataFrame, schema: T.StructType = PAYLOAD) -> DataFrame:
    """A3/B1: parse ``value`` with an explicit schema, PERMISSIVE.

    Output: the payload's top-level fields, ``_corrupt_record`` (the text when the
    line did not parse cleanly) and ``_msg``, a struct with every input column
    (source coordinates and the original text) for stable ids and quarantine.
    A field of the wrong type becomes null while the rest of the line survives.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), full,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    return messages.select(F.struct(*[F.col(c) for c in messages.columns]).alias(MSG),
                           parsed.alias("_d")).select(MSG, "_d.*")


def explode_weather(decoded: DataFrame) -> DataFrame:
    """One row per (message, weather condition); ``weather_pos`` null for a message without any.

    ``posexplode_outer`` keeps the messages a plain explode would drop, so the
    readings and the quarantine are two filters on the generated position. A
    filter on a generated column stays above the generator: the JSON is parsed
    once. (With ``posexplode`` the optimizer infers ``size(weather) > 0`` and
    pushes it below the decode, parsing every message twice.)
    """
    # a message without a city or a time gives no reading either: it keeps one row, for the quarantine
    keyed = F.when(F.col("id").isNotNull() & F.col("dt").isNotNull(), F.col("weather"))
    return decoded.select("*", F.posexplode_outer(keyed).alias("weather_pos", "w"))


def quarantine_reason() -> Column:
    """Why an exploded message gives no reading: unreadable text, no weather condition, no city or no time."""
    return (F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(MALFORMED))
            .when(F.coalesce(F.size("weather"), F.lit(0)) > 0, F.lit(NULL_KEY)).otherwise(F.lit(NO_WEATHER)))


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(exploded readings, messages set aside with a reason).

    The reference drops the second group silently (explode of a null or empty
    list); here it is kept so it can be inspected and replayed.
    """
    return split_exploded(explode_weather(decoded))


def split_exploded(ex: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B12 on an already exploded frame (``parse_messages``): two filters on the position."""
    valid = ex.filter(F.col("weather_pos").isNotNull())
    bad = ex.filter(F.col("weather_pos").isNull()).select(
        F.col("id").alias("city_id"), F.col("dt").alias("timestamp"),
        quarantine_reason().alias("reason"), F.col(f"{MSG}.value").cast("string").alias("value"),
        message_id(source_coordinates(ex)).alias("msg_id"))
    return valid, bad


def source_coordinates(decoded: DataFrame) -> list[str]:
    """Columns of ``_msg`` that identify a message where it was read.

    Kafka: (topic, partition, offset). Files: (file_path, line), or (file_path, value) if lines are not
    numbered - two identical lines in one file then share an id, which the primary-key audit reports. A message
    that is replayed keeps the identity it had (``msg_id``).
    """
    fields = decoded.schema[MSG].dataType.fieldNames()
    for group in (("msg_id",), ("topic", "partition", "offset"), ("file_path", "line"), ("file_path", "value")):
        if all(f in fields for f in group):
            return list(group)
    return fields


def message_id(coords: list[str]) -> Column:
    """Identity of a message: a 64-bit hash of where it was read, or the one it was given."""
    if coords == ["msg_id"]:
        return F.col(f"{MSG}.msg_id")
    return F.xxhash64(*[F.col(f"{MSG}.{c}") for c in coords])


def row_id(coords: list[str], pos: Column) -> Column:
    """Surrogate key of one reading: its message's identity and the position in the weather list, hashed.

    Deterministic: re-reading the same offset (a restarted stream) gives the same
    id, so a replayed batch overwrites instead of duplicating.
    """
    return F.xxhash64(message_id(coords), pos)


def project_readings(valid: DataFrame, coords: list[str] | None = None) -> DataFrame:
    """B2 + B13: exploded readings -> the raw table's columns, with the surrogate id."""
    coords = coords or source_coordinates(valid)
    cols = [F.col(path).alias(name) for name, path in READING_FIELDS]
    out = valid.select(row_id(coords, F.col("weather_pos")).alias("id"), *cols,
                       F.col("weather_pos").cast("int").alias("weather_pos"))
    return out.withColumn("event_date", event_date("timestamp")).select(*RAW_COLUMNS)


def flatten(decoded: DataFrame, coords: list[str] | None = None) -> DataFrame:
    """One row per (message, weather condition) with the raw table's columns."""
    return project_readings(split_valid(decoded)[0], coords)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message text -> decoded and exploded rows: the one JSON parse of a message.

    A caller with two outputs (readings and quarantine) writes this frame (or its ``flat_rows``) first, so
    each message is parsed once, not once per output.
    """
    return explode_weather(decode(message_text(messages)))


def flat_rows(parsed: DataFrame) -> DataFrame:
    """``parse_messages`` output as flat rows, readings and set-aside messages alike, to be written once and read often.

    The raw table's columns but ``id``; ``reason`` and ``value`` of what is set aside; and ``msg_id``, or, for lines of
    splits (``placed``), where each was read.
    """
    apart = F.col("weather_pos").isNull()
    placed = "at" in parsed.schema[MSG].dataType.fieldNames()
    where = [F.col(f"{MSG}.{c}") for c in (*SPLIT, "at")] if placed else [message_id(source_coordinates(parsed)).alias("msg_id")]
    return parsed.select(*where, *(F.col(path).alias(name) for name, path in READING_FIELDS), F.col("weather_pos").cast("int").alias("weather_pos"),
                         F.when(apart, quarantine_reason()).alias("reason"),
                         F.when(apart, F.col(f"{MSG}.value").cast("string")).alias("value")).withColumn("event_date", event_date("timestamp"))


def identified(rows: DataFrame) -> DataFrame:
    """Written ``flat_rows`` with ``msg_id``: lines of splits get the number of each in its file as its coordinate.

    ``rows`` is read twice. One row a split comes to the driver, which planned them.
    """
    if "msg_id" in rows.columns:
        return rows
    # of the conditions of a message the first stands for it
    shifts = split_shifts(rows.filter(F.coalesce("weather_pos", F.lit(0)) == 0).select(*SPLIT, "at"))
    known = rows.sparkSession.createDataFrame(shifts.collect(), shifts.schema)
    return rows.join(F.broadcast(known), list(SPLIT)).withColumn("msg_id", F.xxhash64("path", line_number()))


def readings_and_set_aside(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(raw rows, quarantined messages) of ``identified`` rows: as ``raw_and_quarantine`` of the parsed ones."""
    raw = rows.filter(F.col("weather_pos").isNotNull()).withColumn("id", F.xxhash64("msg_id", "weather_pos"))
    return raw.select(*RAW_COLUMNS), rows.filter(F.col("weather_pos").isNull()).select("city_id", "timestamp", "reason", "value", "msg_id")


def raw_and_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(raw rows, quarantined messages) of ``parse_messages`` output."""
    valid, bad = split_exploded(parsed)
    return project_readings(valid), bad


def messages_to_raw(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L1 transform: message text -> (raw rows, quarantined messages), one parse per message."""
    return raw_and_quarantine(parse_messages(messages))
