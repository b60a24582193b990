"""Decode / flatten / quarantine on the edge lines of the payload."""

import json

from nimbus.operators import decode as dec
from nimbus.schemas import RAW_COLUMNS

SAMPLE = {"coord": {"lon": -0.1257, "lat": 51.5085},
          "weather": [{"id": 800, "main": "Clear", "description": "clear sky", "icon": "01d"}],
          "base": "stations",
          "main": {"temp": 12.5, "feels_like": 11.9, "temp_min": 11.0, "temp_max": 13.2, "pressure": 1013,
                   "humidity": 60, "sea_level": 1015, "grnd_level": 1018},
          "visibility": 8000, "wind": {"speed": 8.5, "deg": 180, "gust": 10.1}, "clouds": {"all": 10},
          "dt": 1744502461, "sys": {"type": 1, "id": 4610, "country": "UK", "sunrise": 1744524000,
                                    "sunset": 1744567200},
          "timezone": 0, "id": 5128581, "name": "London", "code": 200}


def variant(**changes):
    d = json.loads(json.dumps(SAMPLE))
    for k, v in changes.items():
        if v is KeyError:
            d.pop(k, None)
        else:
            d[k] = v
    return json.dumps(d)


def edge_lines():
    two = [{"id": 800, "main": "Clear", "description": "clear sky", "icon": "01d"},
           {"id": 801, "main": "Clouds", "description": "few clouds", "icon": "02d"}]
    no_gust = json.loads(variant())
    del no_gust["wind"]["gust"]
    wrong_type = json.loads(variant(dt=1744502521))
    wrong_type["main"]["humidity"] = 10.5
    return [
        ("ok", variant()),
        ("malformed", '{"coord": {"lon": 1.0, '),
        ("weather_missing", variant(weather=KeyError, dt=1744502462)),
        ("weather_null", variant(weather=None, dt=1744502463)),
        ("weather_empty", variant(weather=[], dt=1744502464)),
        ("weather_two", variant(weather=two, dt=1744502465)),
        ("gust_missing", json.dumps(no_gust)),
        ("humidity_float", json.dumps(wrong_type)),
        ("dt_missing", variant(dt=KeyError)),
        ("sixty_later", variant(dt=1744502521 + 60)),
    ]


def messages(spark, lines, offset0=0):
    rows = [("readings", 0, offset0 + i, v) for i, (_, v) in enumerate(lines)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, value string")


def test_flatten_and_quarantine(spark):
    lines = edge_lines()
    raw, bad = dec.messages_to_raw(messages(spark, lines))
    assert raw.columns == RAW_COLUMNS
    rows = raw.collect()
    # ok, two conditions (2 rows), gust missing, humidity float, sixty later; the one without a time is set aside
    assert len(rows) == 6
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["malformed", "no_weather", "no_weather", "no_weather", "null_key"]
    by_ts = {}
    for r in rows:
        by_ts.setdefault(r.timestamp, []).append(r)
    assert [r.weather_pos for r in sorted(by_ts[1744502465], key=lambda r: r.weather_pos)] == [0, 1]
    assert sorted(r.weather_main for r in by_ts[1744502465]) == ["Clear", "Clouds"]
    # a wrong-typed scalar becomes null, the rest of the reading survives
    hum = [r for r in rows if r.timestamp == 1744502521]
    assert len(hum) == 1 and hum[0].humidity is None and hum[0].temperature == 12.5
    assert all(r.timestamp is not None for r in rows)
    assert any(r.wind_gust is None for r in rows)            # gust missing
    # every reading gets its own id; city columns are renamed
    assert len({r.id for r in rows}) == 6
    ok = by_ts[1744502461]
    assert {r.city for r in ok} == {"London"} and {r.city_id for r in ok} == {5128581}
    assert all(r.event_date is not None for r in rows if r.timestamp is not None)


def test_ids_follow_source_coordinates(spark):
    lines = [("ok", variant())]
    first, _ = dec.messages_to_raw(messages(spark, lines, 0))
    again, _ = dec.messages_to_raw(messages(spark, lines, 0))      # same offset re-read
    moved, _ = dec.messages_to_raw(messages(spark, lines, 7))      # same text, new offset
    a, b, c = first.first().id, again.first().id, moved.first().id
    assert a == b and a != c


def test_file_source_ids_use_path_and_text(spark):
    m = spark.createDataFrame([("f1", variant()), ("f2", variant())], "file_path string, value string")
    raw, _ = dec.messages_to_raw(m)
    assert raw.select("id").distinct().count() == 2


def test_binary_value_is_decoded(spark):
    from pyspark.sql import functions as F
    m = messages(spark, [("ok", variant())]).withColumn("value", F.col("value").cast("binary"))
    raw, bad = dec.messages_to_raw(m)
    assert raw.count() == 1 and bad.count() == 0


def test_decode_parses_once(spark):
    """The explode must not get an inferred size() filter pushed under the JSON parse."""
    raw, _ = dec.messages_to_raw(messages(spark, edge_lines()))
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_dt_is_exact_seconds(spark):
    """A 32-bit float would snap 1744502465 to 1744502528; the 64-bit field keeps it."""
    raw, _ = dec.messages_to_raw(messages(spark, [("a", variant(dt=1744502465)), ("b", variant(dt=1744502461))]))
    assert sorted(r.timestamp for r in raw.collect()) == [1744502461, 1744502465]
