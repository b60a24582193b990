import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from nimbus.session import build_session
    s = build_session("local[4]", app="nimbus-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="nimbus-ck-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def raw_row(**kw):
    """A raw-table row with defaults; override any column."""
    base = dict(id=1, longitude=-0.1257, latitude=51.5085, weather_main="Clear", weather_description="clear sky",
                weather_icon="01d", temperature=12.5, feels_like=11.9, temp_min=11.0, temp_max=13.2,
                pressure=1013, humidity=60, sea_level=1015, grnd_level=1018, visibility=8000, wind_speed=8.5,
                wind_direction=180, wind_gust=10.1, cloud_coverage=10, timestamp=1744502461, country="UK",
                sunrise=1744524000, sunset=1744567200, timezone=0, city_id=5128581, city="London", weather_pos=0)
    base.update(kw)
    return base


def raw_df(spark, rows):
    import datetime as dt

    from nimbus.sources.tables import schema_of
    schema = schema_of("raw")
    out = []
    for r in rows:
        r = dict(r)
        ts = r.get("timestamp")
        r["event_date"] = None if ts is None else dt.date(1970, 1, 1) + dt.timedelta(days=ts // 86400)
        out.append(tuple(r.get(f.name) for f in schema.fields))
    return spark.createDataFrame(out, schema)
