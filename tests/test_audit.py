"""Constraint audits (J1-J4) and the publishing guard."""

import pytest

from conftest import raw_df, raw_row
from nimbus.operators import audit


def test_pk_violations(spark):
    df = raw_df(spark, [raw_row(id=1), raw_row(id=1), raw_row(id=2), raw_row(id=3, city_id=None)])
    got = sorted((r.id, r.n_rows, r.violation) for r in audit.pk_violations(df, ["id"]).collect())
    assert got == [(1, 2, "duplicate")]
    got2 = {(r.city_id, r.violation) for r in audit.pk_violations(df, ["city_id", "timestamp"]).collect()}
    assert (None, "null_key") in got2 and (5128581, "duplicate") in got2


def test_fk_null_length(spark):
    df = raw_df(spark, [raw_row(id=1, city_id=1, country="UK"), raw_row(id=2, city_id=2, country="TOOLONG"),
                        raw_row(id=3, city_id=None, city=None, latitude=None)])
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r.id for r in audit.fk_violations(df, "city_id", parent, "id").collect()] == [2]
    nulls = sorted((r.id, r.column) for r in audit.null_violations(df, ["city", "latitude"], ["id"]).collect())
    assert nulls == [(3, "city"), (3, "latitude")]
    long = audit.length_violations(df, "country", 5, ["id"]).collect()
    assert [(r.id, r.length) for r in long] == [(2, 7)]
    with pytest.raises(audit.ConstraintViolation):
        audit.require_clean(ok=audit.fk_violations(df.filter("id = 1"), "city_id", parent, "id"),
                            bad=audit.length_violations(df, "country", 5, ["id"]))
    audit.require_clean(ok=audit.length_violations(df.filter("id = 1"), "country", 5, ["id"]))
