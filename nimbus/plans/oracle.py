"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on the driver's parquet views (``events``, ``customer``,
``nation``) and computes, with plain SQL, what the Spark query computes with
the package's operators. The common table expressions mirror
``nimbus.sources.testdata`` expression by expression.
"""

from __future__ import annotations

from nimbus.schemas import READING_COLUMNS, STAGING_COLUMNS

READINGS = """
e AS (SELECT *, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS t FROM events),
r AS (
  SELECT event_id AS id,
    CAST((user_id * 7) % 360 AS DOUBLE) - 179.5 AS longitude,
    CAST(user_id % 180 AS DOUBLE) - 89.5 AS latitude,
    event_type AS weather_main,
    event_type || ' sky' AS weather_description,
    CASE WHEN event_id % 101 < 20 THEN '01d' ELSE '03d' END AS weather_icon,
    value AS temperature,
    value - 1.5 AS feels_like,
    value - 2.0 AS temp_min,
    value + 2.0 AS temp_max,
    CAST(1010 + event_id % 7 AS INTEGER) AS pressure,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
    CAST(1012 + event_id % 7 AS INTEGER) AS sea_level,
    CAST(1015 + event_id % 7 AS INTEGER) AS grnd_level,
    CAST((event_id * 13) % 10001 AS INTEGER) AS visibility,
    value / 10 AS wind_speed,
    CAST((event_id * 37) % 361 AS INTEGER) AS wind_direction,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / 10 + 1.25 END AS wind_gust,
    CAST(event_id % 101 AS INTEGER) AS cloud_coverage,
    t AS timestamp,
    'N' || CAST(user_id % 25 AS VARCHAR) AS country,
    t - t % 86400 + 21600 + (user_id % 60) * 60 AS sunrise,
    t - t % 86400 + 64800 - (user_id % 60) * 60 AS sunset,
    CAST((user_id % 25 - 12) * 3600 AS INTEGER) AS timezone,
    CAST(user_id AS INTEGER) AS city_id,
    'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS city,
    CAST(0 AS INTEGER) AS weather_pos,
    CAST(make_timestamp(t * 1000000) AS DATE) AS event_date
  FROM e),
rp AS (SELECT * FROM r UNION ALL SELECT * REPLACE (id + (SELECT max(event_id) + 1 FROM events) AS id) FROM r WHERE id % 10 = 0)"""

CITIES = """
cities AS (
  SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name, 'N' || CAST(c_nationkey AS VARCHAR) AS country,
    CAST(c_custkey % 180 AS DOUBLE) - 89.5 AS latitude,
    CAST((c_custkey * 7) % 360 AS DOUBLE) - 179.5 AS longitude
  FROM customer),
known AS (SELECT * FROM cities WHERE id % 3 <> 0)"""

_STG_SELECT = ", ".join(
    "make_timestamp(timestamp * 1000000) AS timestamp_utc" if c == "timestamp_utc" else c
    for c in STAGING_COLUMNS)

STAGING = f"""
s AS (
  SELECT {_STG_SELECT} FROM rp
  QUALIFY row_number() OVER (PARTITION BY city_id, timestamp ORDER BY weather_pos, id) = 1),
sb AS (
  SELECT {_STG_SELECT} FROM r
  WHERE timestamp < (SELECT (min(timestamp) + max(timestamp)) / 2 FROM r) AND city_id % 10 <> 0)"""

NAMED_CITY = """(SELECT id FROM cities WHERE name = 'Customer#000000007' AND country = 'N17' ORDER BY id LIMIT 1)"""

HOURLY = """
h AS (
  SELECT city_id, timestamp - timestamp % 3600 AS hour_s,
    avg(temperature) AS avg_temp, avg(humidity) AS avg_humidity,
    avg(wind_speed) AS avg_wind_speed, avg(cloud_coverage) AS avg_cloud_coverage
  FROM {src} GROUP BY city_id, timestamp - timestamp % 3600)"""

HOURLY_OUT = """SELECT city_id, make_timestamp(hour_s * 1000000) AS timestamp_hour,
  round(avg_temp, 6) AS avg_temp, round(avg_humidity, 6) AS avg_humidity,
  round(avg_wind_speed, 6) AS avg_wind_speed, round(avg_cloud_coverage, 6) AS avg_cloud_coverage FROM h"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_READING_LIST = ", ".join(READING_COLUMNS)
_FLAT_SELECT = ", ".join(
    {"weather_main": "CASE WHEN p.pos = 0 THEN weather_main ELSE 'Clouds' END AS weather_main",
     "weather_description": "CASE WHEN p.pos = 0 THEN weather_description ELSE 'few clouds' END AS weather_description",
     "weather_icon": "CASE WHEN p.pos = 0 THEN weather_icon ELSE '02d' END AS weather_icon"}.get(c, c)
    for c in READING_COLUMNS)
_FLAT = f"""SELECT {_FLAT_SELECT}, CAST(p.pos AS INTEGER) AS weather_pos, event_date
  FROM {{src}} JOIN (VALUES (0), (1)) AS p(pos) ON p.pos < {{src}}.id % 3"""


def _octant_sql(deg: str) -> str:
    d = f"CAST({deg} AS DOUBLE)"
    return (f"(['N','NE','E','SE','S','SW','W','NW','N'])"
            f"[CAST(round_even((({d}) % 360 + 360) % 360 / CAST(45 AS DOUBLE), 0) AS INTEGER) + 1]")


def _local(sec: str, tz: str) -> str:
    return f"make_timestamp(({sec} + {tz}) * 1000000)"


SQL: dict[str, str] = {}

SQL["flatten_explode"] = _with(READINGS) + _FLAT.format(src="r")

SQL["quarantine_rows"] = _with(READINGS) + """SELECT city_id, timestamp, 'no_weather' AS reason FROM r WHERE id % 3 = 0"""

# Text cut after 40 characters holds no complete field but the first: nothing of the message is known.
SQL["quarantine_null_key"] = _with(READINGS) + """SELECT
  CASE WHEN id % 20 = 5 OR id % 20 = 0 THEN NULL ELSE city_id END AS city_id,
  CASE WHEN id % 20 = 5 OR id % 20 = 10 THEN NULL ELSE timestamp END AS timestamp,
  CASE WHEN id % 20 = 5 THEN 'malformed' WHEN id % 3 = 0 THEN 'no_weather' ELSE 'null_key' END AS reason
FROM r WHERE id % 3 = 0 OR id % 20 IN (0, 5, 10)"""

SQL["high_water"] = _with(READINGS, STAGING) + """SELECT coalesce(max(timestamp), 0) AS high_water FROM sb"""

SQL["increment_global"] = _with(READINGS, STAGING) + """SELECT * FROM r WHERE timestamp > (SELECT coalesce(max(timestamp), 0) FROM sb)"""

SQL["increment_anti"] = _with(READINGS, STAGING) + """SELECT * FROM r
WHERE NOT EXISTS (SELECT 1 FROM sb WHERE sb.city_id = r.city_id AND sb.timestamp = r.timestamp)"""

SQL["staging_dedupe"] = _with(READINGS, STAGING) + "SELECT * FROM s"

_CAND = """
cand AS (
  SELECT city_id, city, country, latitude, longitude FROM rp
  QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY timestamp DESC, id) = 1)"""

SQL["city_candidates"] = _with(READINGS, _CAND) + "SELECT * FROM cand"

SQL["new_cities"] = _with(READINGS, _CAND, CITIES) + """SELECT city_id AS id, city AS name, country, latitude, longitude
FROM cand WHERE city_id NOT IN (SELECT id FROM known)"""

SQL["insert_absent"] = _with(READINGS, _CAND, CITIES) + """SELECT * FROM known UNION ALL
SELECT city_id AS id, city AS name, country, latitude, longitude FROM cand WHERE city_id NOT IN (SELECT id FROM known)"""

SQL["hourly_avg_staging"] = _with(READINGS, STAGING, HOURLY.format(src="s")) + HOURLY_OUT

SQL["hourly_avg_raw"] = _with(READINGS, HOURLY.format(src="rp")) + HOURLY_OUT

SQL["last_24h"] = _with(READINGS, STAGING) + """SELECT * FROM s WHERE timestamp >= (SELECT max(timestamp) FROM s) - 86400"""

SQL["city_series"] = _with(READINGS, STAGING, CITIES) + f"""SELECT *, {_local('timestamp', 'timezone')} AS local_time FROM s
WHERE city_id = {NAMED_CITY} AND timestamp >= (SELECT max(timestamp) FROM s) - 86400"""

SQL["latest_per_city"] = _with(READINGS, STAGING) + """SELECT * FROM s
QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY timestamp DESC, id DESC) = 1"""

SQL["detect_changes"] = _with(READINGS) + """SELECT id, city_id, timestamp,
  (lag(timestamp) OVER (PARTITION BY city_id ORDER BY timestamp, id)) IS DISTINCT FROM timestamp AS is_change
FROM rp"""

SQL["with_city"] = _with(READINGS, STAGING, CITIES) + """SELECT s.*, k.name AS city, k.country, k.latitude, k.longitude
FROM s LEFT JOIN known k ON s.city_id = k.id"""

SQL["top1_latest"] = _with(READINGS, STAGING, CITIES) + f"""SELECT * FROM s WHERE city_id = {NAMED_CITY}
ORDER BY timestamp DESC, id DESC LIMIT 1"""

SQL["snapshot_diff"] = _with(READINGS, STAGING) + """, mx AS (SELECT max(timestamp) AS m FROM s),
cur AS (SELECT * FROM s WHERE timestamp >= (SELECT m FROM mx) - 86400),
prev AS (SELECT * FROM s WHERE timestamp >= (SELECT m FROM mx) - 21600 - 86400
                           AND timestamp <= (SELECT m FROM mx) - 21600)
SELECT *, 'added' AS change FROM (SELECT * FROM cur EXCEPT ALL SELECT * FROM prev)
UNION ALL
SELECT *, 'removed' AS change FROM (SELECT * FROM prev EXCEPT ALL SELECT * FROM cur)"""

_DEG = "CAST((id * 37) % 721 AS DOUBLE) / 2"
SQL["wind_octant"] = _with(READINGS) + f"""SELECT id, {_DEG} AS wind_deg, {_octant_sql(_DEG)} AS octant FROM r"""

SQL["local_time"] = _with(READINGS) + f"""SELECT id, city_id, {_local('timestamp', 'timezone')} AS local_time FROM r"""

SQL["hour_midpoint_local"] = _with(READINGS, STAGING, HOURLY.format(src="s")) + """, off AS (
  SELECT city_id, timezone AS city_timezone FROM s
  QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY timestamp DESC, id DESC) = 1)
SELECT h.city_id, make_timestamp(h.hour_s * 1000000) AS timestamp_hour, off.city_timezone,
  make_timestamp((h.hour_s + 1800 + off.city_timezone) * 1000000) AS local_time
FROM h LEFT JOIN off ON h.city_id = off.city_id"""

SQL["daylight"] = _with(READINGS) + f"""SELECT id,
  strftime({_local('sunrise', 'timezone')}, '%I:%M %p') AS sunrise_text,
  strftime({_local('sunset', 'timezone')}, '%I:%M %p') AS sunset_text,
  CAST(floor((sunset - sunrise) / 3600) AS INTEGER) AS daylight_hours,
  CAST(floor(((sunset - sunrise) % 3600 + 3600) % 3600 / 60) AS INTEGER) AS daylight_minutes
FROM r"""

SQL["conditions_card"] = _with(READINGS, STAGING, CITIES) + f""", lat AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY timestamp DESC, id DESC) = 1)
SELECT lat.city_id, k.name AS city, k.country, k.latitude, k.longitude, lat.timestamp,
  strftime({_local('lat.timestamp', 'lat.timezone')}, '%A %-d %B, %I:%M %p') AS updated_text,
  CAST(round(temperature, 1) + 0.0 AS VARCHAR) || '°C' AS temperature_text,
  'Feels like ' || CAST(round(feels_like, 1) + 0.0 AS VARCHAR) || '°C' AS feels_like_text,
  CAST(humidity AS VARCHAR) || '%' AS humidity_text,
  CAST(wind_speed AS VARCHAR) || ' m/s ' || {_octant_sql('wind_direction')} AS wind_text,
  weather_description AS weather,
  'http://openweathermap.org/img/wn/' || weather_icon || '@2x.png' AS icon_url,
  CAST(cloud_coverage AS VARCHAR) || '%' AS clouds_text,
  CAST(round(CAST(visibility AS DOUBLE) / 1000, 1) AS VARCHAR) || ' km' AS visibility_text,
  strftime({_local('sunrise', 'lat.timezone')}, '%I:%M %p') AS sunrise_text,
  strftime({_local('sunset', 'lat.timezone')}, '%I:%M %p') AS sunset_text,
  CAST(floor((sunset - sunrise) / 3600) AS INTEGER) AS daylight_hours,
  CAST(floor(((sunset - sunrise) % 3600 + 3600) % 3600 / 60) AS INTEGER) AS daylight_minutes,
  CAST(CAST(floor((sunset - sunrise) / 3600) AS INTEGER) AS VARCHAR) || ' hours, '
    || lpad(CAST(CAST(floor(((sunset - sunrise) % 3600 + 3600) % 3600 / 60) AS INTEGER) AS VARCHAR), 2, '0')
    || ' minutes' AS daylight_text
FROM lat LEFT JOIN cities k ON lat.city_id = k.id"""

SQL["weather_record"] = _with(READINGS, STAGING, CITIES) + """, lat AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY timestamp DESC, id DESC) = 1)
SELECT lat.city_id, k.name AS city, k.country, k.latitude, k.longitude, temperature, feels_like, humidity,
  wind_speed, wind_direction AS wind_deg, cloud_coverage AS clouds, visibility, weather_description AS weather,
  weather_icon, sunrise, sunset, timestamp, timezone AS timezone_offset
FROM lat LEFT JOIN cities k ON lat.city_id = k.id"""

SQL["pk_audit"] = _with(READINGS) + """SELECT city_id, timestamp, count(*) AS n_rows,
  CASE WHEN city_id IS NULL OR timestamp IS NULL THEN 'null_key' ELSE 'duplicate' END AS violation
FROM rp GROUP BY city_id, timestamp HAVING count(*) > 1 OR city_id IS NULL OR timestamp IS NULL"""

SQL["fk_audit"] = _with(READINGS, STAGING, CITIES) + """SELECT * FROM s
WHERE city_id IS NOT NULL AND city_id NOT IN (SELECT id FROM known)"""

SQL["null_audit"] = _with(READINGS) + """SELECT id, col AS "column" FROM (
  SELECT id, 'city' AS col FROM r WHERE city IS NULL
  UNION ALL SELECT id, 'latitude' FROM r WHERE latitude IS NULL
  UNION ALL SELECT id, 'longitude' FROM r WHERE longitude IS NULL
  UNION ALL SELECT id, 'wind_gust' FROM r WHERE wind_gust IS NULL)"""

SQL["length_audit"] = """SELECT CAST(c_custkey AS INTEGER) AS id, n_name AS country, CAST(length(n_name) AS INTEGER) AS length
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE length(n_name) > 5"""

SQL["json_publish"] = SQL["hourly_avg_staging"]

SQL["stream_raw"] = (_with(READINGS) + _FLAT.format(src="r") + "\nUNION ALL\n"
                     + _FLAT.format(src="r") + " WHERE r.id % 10 = 0")

SQL["stream_staging"] = _with(READINGS) + f"""SELECT {", ".join(c for c in STAGING_COLUMNS if c not in ("id", "timestamp_utc"))},
  make_timestamp(timestamp * 1000000) AS timestamp_utc FROM r WHERE id % 3 <> 0"""

SQL["stream_hourly"] = _with(READINGS, HOURLY.format(src="(SELECT * FROM r WHERE id % 3 <> 0)")) + HOURLY_OUT

SQL["stream_hourly_late"] = SQL["stream_hourly"]

SQL["stream_dedupe"] = _with(READINGS) + """SELECT DISTINCT city_id, timestamp FROM r WHERE id % 3 <> 0"""

SQL["stream_hourly_state"] = SQL["stream_hourly"]

SQL["stream_latest"] = SQL["stream_staging"] + """
QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY timestamp DESC) = 1"""

SQL["stream_changes"] = _with(READINGS) + """, k AS (SELECT DISTINCT city_id, timestamp FROM r WHERE id % 3 <> 0)
SELECT city_id, timestamp, lag(timestamp) OVER (PARTITION BY city_id ORDER BY timestamp) AS previous FROM k"""

SQL["compact_raw"] = SQL["stream_raw"]

SQL["compact_crash"] = SQL["stream_staging"]

SQL["quarantine_replay"] = _with(READINGS) + """
SELECT city_id, timestamp, CASE WHEN id % 3 = 0 THEN 'Clear' ELSE weather_main END AS weather_main, temperature, 0 AS weather_pos
FROM r WHERE id % 20 NOT IN (0, 5, 10)
UNION ALL
SELECT city_id, timestamp, 'Clouds' AS weather_main, temperature, 1 AS weather_pos
FROM r WHERE id % 3 = 2 AND id % 20 NOT IN (0, 5, 10)"""

SQL["raw_line_ids"] = _with(READINGS) + """
SELECT (sum(2 * (id % 3)))::BIGINT AS n_rows, (sum(2 * (id % 3)))::BIGINT AS n_ids FROM r"""

SQL["city_readings"] = _with(READINGS, STAGING) + """SELECT * FROM s WHERE city_id = 7"""

SQL["row_counts"] = _with(READINGS) + """SELECT count(*) AS observed, count(*) AS n_rows FROM rp"""

# Sanity: every READING column is in the flatten select list.
assert all(c in _FLAT for c in READING_COLUMNS), _READING_LIST

# --- composite jobs -----------------------------------------------------------------------------
# The batch ingest reads the same topic files as the ingest stream: the same raw rows.
SQL["job_ingest_files"] = SQL["stream_raw"]

# After L2 staging holds, for every key of the replayed raw table, the row with the lowest id:
# the rows staged before the run are such rows (their keys are unique in ``r``) and the run adds
# the first row of every other key. So staging after the job is ``s``.
SQL["job_update_staging"] = SQL["staging_dedupe"]

# New cities come from the run's increment (keys not staged before), newest reading first.
SQL["job_cities"] = _with(READINGS, STAGING, CITIES) + """, inc AS (
  SELECT * FROM rp WHERE NOT EXISTS (SELECT 1 FROM sb WHERE sb.city_id = rp.city_id AND sb.timestamp = rp.timestamp)),
cand AS (
  SELECT city_id, city, country, latitude, longitude FROM inc
  QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY timestamp DESC, id) = 1)
SELECT * FROM known UNION ALL
SELECT city_id AS id, city AS name, country, latitude, longitude FROM cand WHERE city_id NOT IN (SELECT id FROM known)"""

SQL["job_rollup_hourly"] = SQL["job_refresh_hourly"] = SQL["hourly_avg_staging"]

# The late cities' readings, up to months before what staging knew, are staged by the run.
SQL["increment_late"] = _with(READINGS, STAGING) + """SELECT * FROM s
WHERE city_id % 10 = 0 AND timestamp < (SELECT max(timestamp) FROM sb)"""

# Every message has its own coordinates, so no raw id repeats or is null; every staged reading has its raw row.
SQL["raw_pk_audit"] = _with(READINGS) + """SELECT id, count(*) AS n_rows, 'duplicate' AS violation
FROM rp GROUP BY id HAVING count(*) > 1"""

SQL["staging_raw_fk_audit"] = _with(READINGS, STAGING) + """SELECT id FROM s WHERE id NOT IN (SELECT id FROM rp)"""

_CARD = SQL["conditions_card"].replace(
    "SELECT * FROM s QUALIFY", f"""SELECT * FROM s WHERE timestamp >= {{now}} - 86400
  AND city_id = {NAMED_CITY} QUALIFY""")
_NEWEST = f"(SELECT max(timestamp) FROM s WHERE city_id = {NAMED_CITY})"
SQL["job_current_card"] = _CARD.replace("{now}", f"({_NEWEST} + 3600)")
# a city that has been silent for more than a day has no card
SQL["job_current_card_stale"] = _CARD.replace("{now}", f"({_NEWEST} + 90000)")

SQL["job_day_series"] = SQL["city_series"]

SQL["job_day_overlay"] = _with(READINGS, STAGING, CITIES, HOURLY.format(src="s")) + f""", off AS (
  SELECT city_id, timezone AS city_timezone FROM s
  QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY timestamp DESC, id DESC) = 1)
SELECT h.city_id, make_timestamp(h.hour_s * 1000000) AS timestamp_hour,
  round(avg_temp, 6) AS avg_temp, round(avg_humidity, 6) AS avg_humidity,
  round(avg_wind_speed, 6) AS avg_wind_speed, round(avg_cloud_coverage, 6) AS avg_cloud_coverage,
  off.city_timezone, make_timestamp((h.hour_s + 1800 + off.city_timezone) * 1000000) AS local_time
FROM h LEFT JOIN off ON h.city_id = off.city_id
WHERE h.city_id = {NAMED_CITY} AND h.hour_s >= (SELECT max(timestamp) FROM s) - 86400"""
