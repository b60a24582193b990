"""The commit log of batch tables: crashes, compaction, concurrent writers, streams, maintenance."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import raw_df, raw_row
from nimbus.sinks import batch as B
from nimbus.sinks import manifest as M
from nimbus.sinks.batch import append_new, compact, verify, write_batch
from nimbus.sinks.manifest import Conflict, Manifest, create_once
from nimbus.sources.tables import read_table, stream_table
from nimbus.streaming.staging import raw_stream, staging_batch, start_staging
from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end

T0, DAY = 1744502461, 86400


def fill(spark, root, n=6, first=0, writer="w"):
    for k in range(first, first + n):
        write_batch(raw_df(spark, [raw_row(id=10 * k + j, city_id=j, timestamp=T0 + k + j * DAY) for j in range(2)]).coalesce(1),
                    k, root, writer=writer)


def ids(spark, root, **kw):
    return sorted(r.id for r in read_table(spark, root, "raw", **kw).collect())


def dates(spark, root):
    return sorted({r.event_date for r in read_table(spark, root, "raw").select("event_date").collect()})


def test_a_batch_without_its_record_is_no_part_of_the_table(spark, tmp, monkeypatch):
    root = f"{tmp}/raw"
    fill(spark, root, 2)
    before = ids(spark, root)

    def die(*_, **__):
        raise RuntimeError("crash")
    for step in ("_digest", ):
        with monkeypatch.context() as m:
            m.setattr(B, step, die)
            with pytest.raises(RuntimeError):
                fill(spark, root, 1, 2)
        assert ids(spark, root) == before
    with monkeypatch.context() as m:
        m.setattr(M, "create_once", die)
        with pytest.raises(RuntimeError):
            fill(spark, root, 1, 2)
    assert ids(spark, root) == before
    fill(spark, root, 1, 2)
    fill(spark, root, 1, 2)                      # and again, after its record: passed over
    assert ids(spark, root) == sorted(before + [20, 21])


@pytest.mark.parametrize("step", ["_write", "_digest", "commit"])
def test_a_crash_at_any_step_of_a_compaction_changes_no_result(spark, tmp, monkeypatch, step):
    root = f"{tmp}/raw"
    fill(spark, root)
    before, days = ids(spark, root), dates(spark, root)

    def die(*_, **__):
        raise RuntimeError("crash")
    with monkeypatch.context() as m:
        m.setattr(Manifest if step == "commit" else B, step, die)
        with pytest.raises(RuntimeError):
            compact(spark, root, "raw", days)
    assert ids(spark, root) == before
    assert compact(spark, root, "raw", days) == 12 and ids(spark, root) == before
    assert Manifest(spark, root).vacuum() == 0                   # within the grace of readers
    assert Manifest(spark, root).vacuum(grace=0) == 12 and ids(spark, root) == before
    assert verify(spark, root, "raw") == []


def test_compaction_is_no_new_stream_input_and_may_run_between(spark, tmp):
    """Raw compacted before, between and after the staging runs: the staging stream reads each row once."""
    raw, out = f"{tmp}/raw", [f"{tmp}/{t}" for t in ("staging", "cities", "quarantine")]

    def stage():
        q = start_staging(raw_stream(spark, raw, 2), *out, f"{tmp}/_ck", AVAILABLE_NOW)
        run_to_end(q)
        return sum(p["numInputRows"] for p in q.recentProgress)
    bad = raw_df(spark, [raw_row(id=77, city_id=7, city=None)])
    write_batch(bad, 0, raw, writer="bad")
    fill(spark, raw, 3)
    assert stage() == 4
    compact(spark, raw, "raw", dates(spark, raw))
    assert stage() == 1                                       # the record, which gives no row
    assert read_table(spark, out[2], "quarantine").count() == 1
    fill(spark, raw, 3, 3)
    compact(spark, raw, "raw", dates(spark, raw))             # files that the stream has not read yet are replaced
    assert Manifest(spark, raw).vacuum(grace=0) < 12           # and stay until it has
    stage()
    staged = read_table(spark, out[0], "staging")
    assert sorted(r.id for r in staged.collect()) == [i for i in ids(spark, raw) if i != 77]
    assert staged.count() == 12 and read_table(spark, out[2], "quarantine").count() == 1


def test_compaction_refuses_other_rows_and_verify_finds_them(spark, tmp):
    root = f"{tmp}/raw"
    fill(spark, root, 3)
    days = dates(spark, root)
    folder = Manifest(spark, root).state().folders(days[:1])[0]
    raw_df(spark, [raw_row(id=999, timestamp=T0)]).drop("event_date").write.mode("append").parquet(f"{root}/{folder}")
    assert verify(spark, root, "raw") == [str(days[0])] and verify(spark, root, "raw", days[1:]) == []
    with pytest.raises(RuntimeError):
        compact(spark, root, "raw", days)


def test_two_compactions_at_once_leave_one(spark, tmp, monkeypatch):
    root = f"{tmp}/raw"
    fill(spark, root, 3)
    before, days = ids(spark, root), dates(spark, root)
    write, once = B._write, []

    def other_first(*a, **kw):
        if not once:
            once.append(1)
            compact(spark, root, "raw", days)
        return write(*a, **kw)
    monkeypatch.setattr(B, "_write", other_first)
    with pytest.raises(Conflict):
        compact(spark, root, "raw", days)
    assert ids(spark, root) == before


def test_overlapping_writers_insert_a_key_once(spark, tmp):
    """Two staging batches over the same readings at the same time: one row a city, one row a reading."""
    rows = [raw_row(id=i, city_id=i % 5, timestamp=T0 + i // 2) for i in range(20)]
    out = [f"{tmp}/{t}" for t in ("staging", "cities", "quarantine")]
    failed = []

    def run(k):
        try:
            staging_batch(raw_df(spark, [dict(r, id=r["id"] + 100 * k) for r in rows]), 0, *out, f"w{k}")
        except Exception as e:  # noqa: BLE001 - shown by the assertion
            failed.append(e)
    threads = [threading.Thread(target=run, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert sorted(r.id for r in read_table(spark, out[1], "cities").collect()) == list(range(5))
    staged = [(r.city_id, r.timestamp) for r in read_table(spark, out[0], "staging").collect()]
    assert sorted(staged) == sorted({(r["city_id"], r["timestamp"]) for r in rows})


def test_append_new_decides_again_after_a_lost_race(spark, tmp):
    root, seen = f"{tmp}/cities", []

    def build(now):
        known = {r.id for r in read_table(spark, root, "cities").collect()}
        seen.append(known)
        if len(seen) == 1:                              # another writer commits while this one decides
            write_batch(spark.createDataFrame([(1, "a", "N1", 0.0, 0.0)], cols), 0, root, partition_by=(), writer="other")
        return spark.createDataFrame([(i, "b", "N2", 0.0, 0.0) for i in (1, 2) if i not in known], cols)
    cols = "id int, name string, country string, latitude double, longitude double"
    append_new(spark, root, build, 0, "me", partition_by=())
    assert seen == [set(), {1}]
    assert sorted((r.id, r.name) for r in read_table(spark, root, "cities").collect()) == [(1, "a"), (2, "b")]


def test_a_record_is_created_once(spark, tmp):
    wins = []

    def run(k):
        wins.append(create_once(spark, f"{tmp}/log/1.json", str(k)))
    threads = [threading.Thread(target=run, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(wins) == 1


def test_expire_waits_for_consumers_and_serves_new_ones(spark, tmp):
    root = f"{tmp}/raw"
    fill(spark, root, 4)
    log = Manifest(spark, root)

    def drain(consumer):
        got = []
        q = stream_table(spark, root, "raw", 1).start_each(
            lambda df, _: got.extend(r.id for r in df.collect()), f"{tmp}/_ck-{consumer}", consumer, AVAILABLE_NOW)
        run_to_end(q)
        return sorted(got)
    assert drain("a") == ids(spark, root)
    log.register("slow")
    assert log.expire(keep=0) == 0                                        # held back
    log.forget("slow")
    compact(spark, root, "raw", dates(spark, root))
    before = ids(spark, root)
    assert log.expire(keep=1) == 3 and ids(spark, root) == before         # "a" has passed version 4
    fill(spark, root, 2, 4)
    assert drain("a") == [40, 41, 50, 51] and drain("a") == []            # the base is no new input for it
    assert drain("b") == ids(spark, root)                                 # a new one starts from the base
    assert log.expire(keep=0) == 7 and log.expire(keep=0) == 7
    assert ids(spark, root) == sorted(before + [40, 41, 50, 51]) and drain("a") == [] and drain("b") == []
    assert len(M.names(spark, log.log)) == 1
    fill(spark, root, 1, 5)                                               # a batch that the base knows is passed over
    assert len(ids(spark, root)) == len(before) + 4


def test_listing_does_not_grow_with_history(spark, tmp, monkeypatch):
    """5,000 folders of other dates: a read of one date opens its folder and lists the log only."""
    root = f"{tmp}/raw"
    fill(spark, root, 1)
    log = Manifest(spark, root)
    day = dates(spark, root)[0]
    base = log.state()
    for k in range(5000):
        base.live[f"writer=old/batch_id={k}/event_date=2001-01-01"] = ("2001-01-01", 1, (1, 0, 0))
    base.writers["old"] = 4999
    import json
    create_once(spark, log._name(1, M.BASE), json.dumps(
        {"version": 1, "kind": M.BASE, "folders": [[f, d, v, *x] for f, (d, v, x) in base.live.items()], "dead": [], "writers": base.writers}))
    listed = []
    names = M.names
    monkeypatch.setattr(M, "names", lambda s, p: listed.append(p) or names(s, p))
    rows = read_table(spark, root, "raw", dates=[day])
    assert listed == [log.log] and len(rows.inputFiles()) == 1 and rows.count() == 1


def test_an_error_is_not_taken_for_an_absent_table(spark, tmp):
    """Only a missing path reads as empty."""
    assert read_table(spark, f"{tmp}/absent", "raw").count() == 0
    spark.range(3).write.json(f"{tmp}/notparquet")
    with pytest.raises(Exception):
        read_table(spark, f"{tmp}/notparquet", "raw").select(F.sum("id")).collect()


def test_compact_raw_compacts_between_two_runs_of_staging_and_after_them(spark, monkeypatch):
    """Half of the topic's files a run: both runs of staging read rows, each row once, and raw is compacted after both."""
    from conftest import SF_SMALL
    from nimbus.plans import catalog
    from nimbus.streaming import staging as S
    done, read = [], []
    real_compact, real_batch = B.compact, S.staging_batch

    def compacted(spark, root, table, *a, **kw):
        done.append(("compact", table))
        return real_compact(spark, root, table, *a, **kw)

    def staged(batch, *a, **kw):
        done.append("stage")
        read.extend(r.id for r in batch.select("id").collect())
        return real_batch(batch, *a, **kw)
    monkeypatch.setattr(B, "compact", compacted)
    monkeypatch.setattr(S, "staging_batch", staged)
    n = catalog.q_compact_raw(spark, SF_SMALL).count()
    order = [x for k, x in enumerate(done) if not k or x != done[k - 1]]
    assert order == ["stage", ("compact", "raw")] * 2
    assert len(read) == len(set(read)) == n


def test_every_delivery_of_the_late_topic_is_a_micro_batch(spark):
    """Newest first in three deliveries: as many files as a micro-batch takes each, whatever partitions the events are read in."""
    from conftest import SF_SMALL
    from nimbus.plans import catalog
    path = catalog._publish_late(spark, SF_SMALL).removeprefix("file:")
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 3 * catalog.FILES_A_BATCH
